"""Product codes against a plain run of the rule."""

import hashlib

import numpy as np
import pytest

from civicframe.llm import product_codes as pc

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, parts, entries, rounds):
    """rows: (vec_id, vector, label) of kept rows; every distance is evaluated."""
    longest = max((len(v) for _, v, _ in rows), default=0)
    size = -(-longest // parts)
    rows = sorted(((k, [int(np.floor(np.float64(np.float32(x)) * 4096)) for x in v], c) for k, v, c in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([v + [0] * (size * parts - len(v)) for _, v, _ in rows], np.int64).reshape(len(rows), parts, size)
    books = x[:entries].copy()  # entries x parts x size
    for turn in range(rounds + 1):
        d = ((x[:, None] - books[None]) ** 2).sum(axis=3)
        code = d.argmin(axis=1)
        if turn < rounds:
            for p in range(parts):
                for e in range(len(books)):
                    own = x[code[:, p] == e, p]
                    if len(own):
                        books[e, p] = [int(s) // len(own) for s in own.sum(axis=0)]
    error = d.min(axis=1).sum(axis=1)
    labels = {}
    for (_, _, c), n in zip(rows, error, strict=True):
        labels[c] = labels.get(c, 0) + int(n)
    out = [(k, "".join(f"{i:02x}" for i in row), int(n), labels[c]) for (k, _, c), row, n in zip(rows, code, error, strict=True)]
    text = ",".join(str(n) for p in range(parts) for e in range(len(books)) for n in books[e, p])
    return sorted(out, key=str), hashlib.sha256(text.encode()).hexdigest()


def result(df, **options):
    codes, books = pc.compress(df, **options)
    rows = pc.with_label_error(codes).select("vec_id", "code", "error", "label_error").collect()
    return sorted(map(tuple, rows), key=str), pc.digest(books)


def vectors(n, dims, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (7, dims))
    return [(int(i) * 3 % 101, [float(x) for x in np.float32(centres[i % 7] + rng.normal(0, 0.05, dims))], None if i % 5 == 0 else i % 3) for i in range(n)]


@pytest.mark.parametrize("parts, entries, dims", [(8, 16, 64), (4, 5, 12), (8, 16, 20)])
def test_same_codes_as_every_distance(spark, parts, entries, dims):
    rows = vectors(90, dims)
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5), parts=parts, entries=entries) == brute(rows, parts, entries, 6)


def test_awkward_vectors(spark):
    """Null, non-finite and ragged vectors, equal rows, ties, null ids and labels, columns with clashing names."""
    good = [(4, [0.5] * 8, 1), (4, [0.5] * 8, 1), (2, [], None), (3, [-1.0, 1.0], 2), (None, [0.25] * 16, None), (9, [0.0] * 16, 7), (9, [1e-9] * 8, 7)]
    bad = [(1, None, 1), (5, [1.0, None], 1), (6, [float("nan")] * 8, 2), (7, [float("inf")], 3)]
    rows = [(*r, 1, "x", 2.0) for r in good + bad]
    df = spark.createDataFrame(rows, SCHEMA + ", code int, `error` string, v double")
    assert result(df) == brute(good, 8, 16, 6)
    assert result(df, entries=2, rounds=3) == brute(good, 8, 2, 3)


def test_no_vector_and_empty_vectors(spark):
    empty = hashlib.sha256(b"").hexdigest()
    assert result(spark.createDataFrame([], SCHEMA)) == ([], empty)
    assert result(spark.createDataFrame([(1, None, 1)], SCHEMA)) == ([], empty)
    assert result(spark.createDataFrame([(1, [], 1), (2, [], 1)], SCHEMA))[0] == [(1, "00" * 8, 0, 0), (2, "00" * 8, 0, 0)]
    with pytest.raises(ValueError, match="64 bits"):
        pc.compress(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA))


def test_cells_drop_only_dominated_entries():
    """Every point gets its nearest entry with the lowest index, most distances are never evaluated, and forgetting cells changes nothing."""
    rng = np.random.default_rng(5)
    entries = rng.integers(-900, 900, (16, 4))
    entries[7] = entries[3]  # a tie everywhere
    points = np.concatenate([entries, rng.integers(-1200, 1200, (4000, 4)), np.repeat(entries[:1], 500, axis=0)])
    distance = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    for remembered in (pc.REMEMBERED, 3):
        cells = pc.GridCells(entries, remembered)
        for at in range(0, len(points), 700):
            index, best = cells.nearest(points[at:at + 700])
            assert (index == distance[at:at + 700].argmin(axis=1)).all() and (best == distance[at:at + 700].min(axis=1)).all()
        assert cells.evaluated < 0.75 * distance.size
