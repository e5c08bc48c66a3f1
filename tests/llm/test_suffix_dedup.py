"""Copies of byte strings against brute force."""

import random

import numpy as np
import pytest

from civicframe.llm import suffix_dedup as sfx
from tests.llm.fixtures import awkward, empty, rows_of

LAST = 1 << 63


def brute(rows, length):
    """The rule in plain Python: texts in the order of their ids, a null id last; a string seen before is a copy."""
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda r: LAST if r[0] is None else r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            if data[i:i + length] in seen:
                gone[i:i + length] = True
            seen.add(data[i:i + length])
        spans = int(np.sum(gone[:-1] & ~np.concatenate([[False], gone[:-2]])))
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out.append((key, len(data), int(gone.sum()), spans, kept))
    return sorted(out, key=str)


def texts(seed=4):
    rng = random.Random(seed)
    draw = lambda n: "".join(rng.choice("abcdefgh éß漢 ") for _ in range(n))
    passage, short = draw(300), draw(60)
    made = []
    for n in (0, 1, 5, 99, 100, 101, 180, 500):
        made += [draw(n), draw(n) + passage[rng.randrange(40):] + draw(7), short + draw(n) + short, passage[:rng.randrange(300)] + draw(n)]
    return made + made[3:9] + ["la " * 200, passage * 3, "a" * 700, "ab" * 150 + "a" * 90]


def got(df):
    return sorted(((*r[:4], bytes(r[4])) for r in df.collect()), key=str)


def one_by_one(docs):
    """Rows with different ids, as the order under one id is a hash's."""
    return docs.where("doc_id is null or doc_id <> 7")


@pytest.mark.parametrize("length", [2, 9, 40, 100])
def test_brute_force(spark, length):
    docs = one_by_one(awkward(spark, texts(), extra=True))
    df = sfx.remove_copies(docs, length)
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    assert got(df) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], length)


@pytest.mark.parametrize("rows_a_batch, block, crowd", [(3, 1 << 20, 0), (7, 1 << 7, 16), (1, 1 << 9, 1), (1000, 1 << 20, 1)])
def test_batches_blocks_and_crowded_triggers(spark, monkeypatch, rows_a_batch, block, crowd):
    """The result does not depend on how texts are batched and cut, nor on which strings are compared one by one."""
    rng = random.Random(7)
    line = " every page of this site ends with the same long line of text, which no one reads but all of them carry along "
    rows = [(i, "".join(rng.choice("abcdef ") for _ in range(rng.randrange(150))) + line + "".join(rng.choice("abcdef ") for _ in range(150)))
            for i in range(60)] + list(enumerate(texts(9), 100))
    monkeypatch.setattr(sfx, "BLOCK", block)
    monkeypatch.setattr(sfx, "CROWD", crowd)
    monkeypatch.setattr(sfx, "SORTED", 500)
    schema = "doc_id bigint, text string"
    docs = spark.createDataFrame(rows, schema)
    # the settings belong to this process: run the steps of the tasks here, with batches of the given size
    assert local_run(docs, rows_a_batch, 100) == brute(rows, 100)


def local_run(docs, rows_a_batch, length):
    """The operator's own batch steps, run in this process on batches of a few rows (workers do not see patched settings)."""
    import pyarrow as pa

    captured = {}

    def take(df, schema, make):
        captured["step"], captured["schema"] = make(), schema

    rows = docs.toArrow().select(["doc_id", "text"])
    ids = rows["doc_id"].to_pylist()
    keyed = pa.table({"id": pa.array(ids, pa.int64()), "salt": pa.array([0] * len(ids), pa.int64()), "text": rows["text"]})
    original = sfx.arrow_pass
    try:
        sfx.arrow_pass = take
        sfx._parsed(docs, length, 5)
        parse = captured["step"]
        sfx._dictionary(docs, length, 5)
        dictionary = captured["step"]
    finally:
        sfx.arrow_pass = original

    def slices(table, step):
        found = {}
        for batch in table.combine_chunks().to_batches(max_chunksize=rows_a_batch):
            out = step(batch)
            kinds = [pa.int32()] + [pa.binary()] * (len(out) - 1)
            sent = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))
            for i, s in enumerate(sent["slice"].to_pylist()):
                found.setdefault(s, []).append(sent.slice(i, 1))
        return [sfx._Slice(rows) for rows in found.values()]

    runs, is_open = {}, {}
    for answer in map(sfx._judged, slices(keyed, parse)):
        for r in answer.to_pylist():
            runs.setdefault(r["id"], []).append(r["runs"])
            is_open[r["id"]] = is_open.get(r["id"], False) or r["open"]
    at = [i for i, k in enumerate(ids) if is_open.get(k)]
    asked = keyed.take(at).append_column("runs", pa.array([runs[ids[i]] for i in at], pa.list_(pa.binary())))
    for s in slices(asked, dictionary):
        for r in sfx._compared(s, length).to_pylist():
            runs.setdefault(r["id"], []).append(r["runs"])
    out = []
    for key, text in zip(ids, rows["text"].to_pylist(), strict=True):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for packed in runs.get(key, []):
            for start, n, verdict in np.frombuffer(packed, sfx.RUN).tolist():
                if verdict == sfx.IS_COPY:
                    gone[start:start + n - 1 + length] = True
        spans = int(np.sum(gone & ~np.concatenate([[False], gone[:-1]]))) if len(data) else 0
        out.append((key, len(data), int(gone.sum()), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return sorted(out, key=str)


def test_one_line_in_many_documents(spark):
    line = "".join(f"<p{i}>" for i in range(40))
    rows = [(i, f"u{i * 37} v{i * i} {line} z{i * 11}" * (1 + i % 2)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    assert got(sfx.remove_copies(docs)) == brute(rows, 100)


def test_equal_rows_and_one_id(spark):
    """Of equal rows one stays; texts under one id are copies of each other in some fixed order."""
    a, b = "".join(f"{i}-" for i in range(90)), "".join(f"{i * i}+" for i in range(90))
    rows = [(1, a)] * 5 + [(1, b), (None, a), (2, "short")] + [(2, "short")] * 2 + [(3, b)] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = [(r[0], r[2], r[3], bytes(r[4])) for r in sfx.remove_copies(docs.repartition(4)).collect()]
    whole = [r for r in left if r[3] in (a.encode(), b.encode())]
    assert sorted(r[0] for r in whole) == [1, 1] and len(left) == len(rows)
    assert sorted(map(str, left)) == sorted(map(str, [(1, 0, 0, a.encode()), (1, 0, 0, b.encode())] + [(1, len(a), 1, b"")] * 4
                                                + [(None, len(a), 1, b"")] + [(2, 0, 0, b"short")] * 3 + [(3, len(b), 1, b"")] * 3))


def test_suffix_ranks_follow_the_bytes():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 3, 500).astype(np.uint8)
    for depth in (1, 2, 3, 7, 8, 9, 13, 16, 30, 100):
        ranks = sfx.suffix_ranks(data, depth)
        strings = [data[i:i + depth].tobytes() for i in range(len(data) - depth + 1)]
        order = {s: k for k, s in enumerate(sorted(set(strings)))}
        assert ranks.tolist() == [order[s] for s in strings]


def test_empty_table_and_ids(spark):
    assert rows_of(sfx.remove_copies(empty(spark))) == []
    with pytest.raises(ValueError, match="whole numbers"):
        sfx.remove_copies(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_a_slice_answers_homes_not_documents(spark, monkeypatch):
    """The rows that slices answer with follow the number of slices, however many documents share strings, and each document gets one row."""
    rng = random.Random(3)
    draw = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passages = [draw(150) for _ in range(40)]
    rows = [(i, " ".join(draw(20) + rng.choice(passages) for _ in range(6))) for i in range(400)]
    keyed = sfx._keyed(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7), "doc_id", "text").select("id", "salt", "text")
    slices, seen, kept = sfx.shuffle_partitions(spark), [], sfx._by_document
    monkeypatch.setattr(sfx, "_by_document", lambda replies: seen.append(replies) or kept(replies))
    found = sfx._by_slice(sfx._parsed(keyed, 100, slices), sfx._judged).select("id", "salt").collect()
    assert seen[0].count() <= slices * slices
    assert len(found) == len(set(found)) and len(found) > 300
