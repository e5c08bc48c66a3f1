"""Resampling against features that are built as strings."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from civicframe.llm import importance_resampling as ir
from tests.llm.fixtures import awkward, empty, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, low, high):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, [" ".join(words[i:i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, low, high, buckets, percent, least_words):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    found = [(k, *grams(t, low, high)) for k, t in docs]
    s = Counter(bucket(g) for _, _, gs in found for g in gs)
    t = Counter(bucket(g) for x in target for g in grams(x, low, high)[1])
    up, down = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * up / ((s[b] + 1) * down)))
    rows = []
    for k, words, gs in found:
        weight = sum(gain(bucket(g)) for g in gs)
        h = int(hashlib.sha256(f"2024:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append((k, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least_words))
    drawn = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    size = percent * len(drawn) // 100
    out = [(*r[:4], i + 1 if i < size else None) for i, r in enumerate(drawn)] + [(*r[:4], None) for r in rows if not r[4]]
    return sorted(out, key=str)


TEXTS = ["The quick Brown fox, the LAZY dog! " * k for k in range(1, 9)] + ["größe 漢字 naïve " * 9, "a-b_c d9 \x7f x`y{z " * 7, "İK straße " * 12]
AIMED = ["the lazy dog sleeps", "Größe und Straße", None, "", "fox fox"]


@pytest.mark.parametrize("low, high, buckets, percent", [(1, 1, 10_000, 10), (1, 3, 50, 50), (2, 2, 70_000, 100), (3, 5, 7, 30)])
def test_same_rows_as_with_strings(spark, low, high, buckets, percent):
    docs = awkward(spark, TEXTS, extra=True)
    target = spark.createDataFrame([(t,) for t in AIMED], "text string")
    got = ir.resample(docs, target, low, high, buckets, percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows_of(got) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], AIMED, low, high, buckets, percent, 20)


def test_crcs_of_runs_from_two_prefixes():
    words = [bytes([97 + i % 26]) * n for i, n in enumerate([1, 2, 3, 700, 1, 255, 256, 9, 70_000, 4])]
    got = ir.NgramCrcs(1, 4)(words)
    assert got.tolist() == [zlib.crc32(b" ".join(words[i:i + n])) for n in range(1, 5) for i in range(len(words) - n + 1)]
    assert ir.NgramCrcs(2, 3)(words[:1]).tolist() == [] == ir.NgramCrcs(1, 1)([]).tolist()


def test_shift_equals_zero_bytes():
    shift, rng = ir.Shift(), np.random.default_rng(2)
    crcs, lengths = rng.integers(0, 1 << 32, 50).astype(np.uint32), rng.integers(0, 5000, 50)
    assert ((shift(crcs, lengths) ^ shift(np.zeros(50, np.uint32), lengths)) == shift(crcs, lengths)).all()
    a, b = b"some prefix", b"the run itself"
    assert zlib.crc32(a + b) == int(shift(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)]))[0]) ^ zlib.crc32(b)


def test_the_draw_leans_towards_the_target(spark):
    docs = spark.createDataFrame([(i, ("apple pear plum " if i % 10 == 0 else "bolt nut screw ") * 10) for i in range(1000)], "doc_id bigint, text string")
    target = spark.createDataFrame([("apple pear plum " * 40,)], "text string")
    drawn = [r["doc_id"] for r in ir.resample(docs, target).where("rank is not null").collect()]
    assert len(drawn) == 100 and sum(k % 10 == 0 for k in drawn) > 95


def test_empty_tables_and_equal_scores(spark):
    none = spark.createDataFrame([], "text string")
    assert rows_of(ir.resample(empty(spark), none)) == []
    docs = spark.createDataFrame([(5, "w " * 30)] * 4, "doc_id bigint, text string").repartition(3)
    ranks = sorted(str(r["rank"]) for r in ir.resample(docs, none, percent=50).collect())
    assert ranks == ["1", "2", "None", "None"]
