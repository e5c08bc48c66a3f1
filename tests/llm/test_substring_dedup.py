"""Repeated windows against brute force."""

import random
import re
from collections import Counter

import pytest

from civicframe.llm import substring_dedup as sub
from tests.llm.fixtures import awkward, empty, rows_of


def brute(rows, length):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    windows = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (key, _), w in zip(rows, words, strict=True):
        gone = {p for i in range(len(w) - length + 1) if windows[tuple(w[i:i + length])] > 1 for p in range(i, i + length)}
        kept = [x for p, x in enumerate(w) if p not in gone]
        out.append((key, len(w), len(gone), " ".join(kept)))
    return sorted(out, key=str)


def texts():
    rng = random.Random(4)
    draw = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(n)]
    passage, short = draw(60), draw(20)
    made = []
    for n in (0, 1, 5, 34, 35, 36, 80, 200):
        made.append(" ".join(draw(n)))
        made.append(" ".join(draw(n) + passage[rng.randrange(10):] + draw(7)))
        made.append(" ".join(short + draw(n) + short))
    return made + made[3:9] + [" ".join(["la"] * 100), " ".join(passage * 3)]


@pytest.mark.parametrize("length", [2, 7, 35])
def test_brute_force(spark, length):
    docs = awkward(spark, texts(), extra=True)
    got = sub.remove_repeats(docs, length)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert rows_of(got) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], length)


def test_one_passage_in_many_documents_and_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        passage = " ".join(f"p{i}" for i in range(40))
        docs = spark.createDataFrame([(i, f"u{i} v{i} {passage} z{i}") for i in range(300)], "doc_id bigint, text string").repartition(9)
        assert rows_of(sub.remove_repeats(docs)) == brute([tuple(r) for r in docs.collect()], 35)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table(spark):
    assert rows_of(sub.remove_repeats(empty(spark))) == []


def test_levels_go_on_until_none_survives(spark):
    docs = awkward(spark, texts())
    words = [(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()]
    expected = {i: 0 for i in range(len(words))}
    length = 7
    while True:
        windows = Counter(tuple(w[i:i + length]) for _, w in words for i in range(len(w) - length + 1))
        hit = [k for k, (_, w) in enumerate(words) if any(windows[tuple(w[i:i + length])] > 1 for i in range(len(w) - length + 1))]
        if not hit:
            break
        expected |= dict.fromkeys(hit, length)
        length *= 2
    assert max(expected.values()) >= 56
    assert rows_of(sub.longest_repeats(docs, 7)) == sorted(((words[k][0], n) for k, n in expected.items()), key=str)
