"""Exact search against brute force."""

import numpy as np
import pytest

from civicframe.llm import exact_topk

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k=5, every=50):
    taken = []
    for i, (key, v) in enumerate(rows):
        if key is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            taken.append((key, i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]))
    out = []
    for key, i, q in taken:
        if key % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), other) for other, j, v in taken if j != i)
            out += [(key, rank + 1, other, -s) for rank, (s, other) in enumerate(scored[:k])]
    return sorted(out)


def check(spark, rows, k=5):
    frame = spark.createDataFrame([(key, v, 1) for key, v in rows], SCHEMA).withColumnRenamed("label", "row")
    got = exact_topk.top_k(frame, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, k)


def vectors(n, dims, seed):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, 0.3, dims).astype(np.float32)]) for i in range(n)]


@pytest.mark.parametrize("k", [1, 5, 400])
def test_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(exact_topk, "VECTORS_PER_BLOCK", 40)
    monkeypatch.setattr(exact_topk, "QUERIES_PER_BLOCK", 2)
    check(spark, vectors(300, 8, 1), k)


def test_tasks_that_hold_little(spark, monkeypatch):
    for name, value in (("VECTORS_PER_BLOCK", 40), ("QUERIES_PER_BLOCK", 2), ("HELD_BLOCKS", 1), ("HELD_QUERIES", 1)):
        monkeypatch.setattr(exact_topk, name, value)
    check(spark, vectors(300, 8, 3) + [(400 + i, [0.5] * 8) for i in range(60)])


def test_ties_repeats_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "VECTORS_PER_BLOCK", 16)
    rows = vectors(60, 4, 2) + [(100 + i, [0.5, 0.25, 0.0, 0.125]) for i in range(120)]
    rows += [(50, [0.5, 0.25, 0.0, 0.125]), (150, [0.5, 0.25, 0.0, 0.125]), (150, [0.5, 0.25, 0.0, 0.125]), (None, [1.0, 1.0, 1.0, 1.0]),
             (200 * 50, None), (201 * 50, [1.0, None, 0.0, 0.0]), (202 * 50, [1.0, float("nan"), 0.0, 0.0]), (203 * 50, [float("inf")] * 4),
             (-50, [0.1, 0.2]), (204 * 50, []), (205 * 50, [-1.0, -2.0, 3.0, 100.0])]
    check(spark, rows)


def test_large_components_take_integer_arithmetic(spark):
    check(spark, [(i, [float(2**14 * (i + 1) + 1), float(i), -float(2**14)]) for i in range(60)])
    with pytest.raises(ValueError):
        exact_topk.top_k(spark.createDataFrame([(0, [1e30], 1)], SCHEMA))


def test_few_rows(spark):
    check(spark, [])
    check(spark, [(0, [1.0])])
    check(spark, [(0, [1.0]), (1, [2.0])])
    check(spark, [(1, [1.0]), (2, [2.0])])


def test_blocks_of_empty_vectors_only(spark):
    """Empty vectors score 0, also when a block holds nothing else."""
    check(spark, [(i, []) for i in range(0, 120, 10)])
    check(spark, [(i, []) for i in range(0, 60, 10)] + vectors(5, 3, 2))
