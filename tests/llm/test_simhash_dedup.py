"""SimHash near-duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import xxhash

from civicframe.llm import simhash_dedup as sd
from tests.llm.fixtures import awkward, empty, rows_of

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    root = {f: f for _, f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    values = list(root)
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    lowest = {}
    for i, f in prints:
        if i is not None:
            lowest[find(f)] = min(i, lowest.get(find(f), i))
    return sorted(((i, f"{f:016x}", lowest.get(find(f))) for i, f in prints), key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    got = sd.near_duplicates(docs).collect()
    assert sorted((tuple(r) for r in got), key=str) == slow_components(rows)


def test_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in rows])


def test_edge_cases(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    near = []
    for k in range(40):
        other = list(base)
        other[rng.randrange(300)] = "x"
        near.append((k + 100, " ".join(other)))
    check(spark, [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "two words"), (6, "two words"), (None, "lonely text here"),
                  (None, " ".join(base)), (7, " ".join(base * 300)), *near])


def test_awkward_rows(spark):
    docs = awkward(spark, extra=True)
    got = sd.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert rows_of(got) == slow_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sd.keep_one(docs).columns == docs.columns
    assert sd.keep_one(empty(spark)).count() == 0


def test_empty_table(spark):
    check(spark, [])


def test_position_sets_hold_one_of_any_five():
    import itertools
    sets = sd.position_sets(3)
    assert len(sets) == 14
    assert all(sum(set(s) <= set(five) for s in sets) == 1 for five in itertools.combinations(range(8), 5))


def test_long_lists_are_cut_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(sd, "CHUNK", 7)
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63)
    prints = [int(centre)]
    for _ in range(120):
        f = prints[rng.integers(len(prints))]
        for b in rng.integers(0, 24, rng.integers(1, 6)):
            f ^= 1 << int(b)
        prints.append(f)
    distinct = sorted(set(prints))
    found = sd.connected_components(sd.links(spark.createDataFrame([(f,) for f in distinct], "fp bigint"), 3)).collect()
    root = {r["id"]: r["root"] for r in found}
    seen = {f: f for f in distinct}
    changed = True
    while changed:
        changed = False
        for a in distinct:
            for b in distinct:
                if (a ^ b).bit_count() <= 3 and seen[a] != seen[b]:
                    seen[a] = seen[b] = min(seen[a], seen[b])
                    changed = True
    assert {f: root.get(f, f) for f in distinct} == seen


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d", "en", "s", 7), (1, "a b c d", "en", "s", 7), (1, "a b c d", "en", "s", 7), (9, "quite another text", "de", "t", 18),
            (None, "a b c d", "en", "s", 7), (None, "no id at all here", "en", "s", 1)]
    got = sd.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[1], rows[3], rows[5]], key=str)
