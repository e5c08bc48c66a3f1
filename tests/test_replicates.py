"""Replicates in accumulators against plain numpy, and that no row is copied for a replicate."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicframe.operators import experiments as ex
from civicframe.operators import replicates as rp

SPACE = 1 << 48


def hashes(seed, key):
    text = hashlib.md5(f"{seed}:{key}".encode()).hexdigest()
    return int(text[:12], 16), int(text[12:24], 16)


def numbers(seed, keys, rep):
    return [(a + rep * b) % SPACE for a, b in (hashes(seed, k) for k in keys)]


@pytest.fixture(scope="module")
def units(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(rng.normal(3, 1)) if i % 9 else None, int(rng.random() < 0.4), float(rng.normal()), "abc"[i % 3] if i % 10 else None)
            for i in range(400)]
    return rows, spark.createDataFrame(rows, "id int, y double, d int, c double, g string").repartition(5)


def lowest(seed, keys, rep, take):
    order = sorted(zip(numbers(seed, keys, rep), keys, strict=True))
    return {k for _, k in order[:take]}


@pytest.mark.parametrize("ranked", [1_000_000, 50, 0])
def test_half_splits(units, monkeypatch, ranked):
    """Whether all rows are ranked, or the cut is narrowed down to a few rows or to the last bit."""
    monkeypatch.setattr(rp, "RANKED", ranked)
    rows, df = units
    got = {r["rep"]: r["aa_effect"] for r in ex.aa_test(df, "id", "y", 12, "aa").collect()}
    for rep in range(1, 13):
        first = lowest("aa", [r[0] for r in rows], rep, 200)
        a = [r[1] for r in rows if r[1] is not None and r[0] in first]
        b = [r[1] for r in rows if r[1] is not None and r[0] not in first]
        assert got[rep] == pytest.approx(np.mean(a) - np.mean(b), abs=1e-9)


@pytest.mark.parametrize("within, cuts", [([], 20_000), (["g"], 20_000), (["g"], 1)])
def test_permuted_effects(units, monkeypatch, within, cuts):
    """Also with so many blocks that the rows are expanded."""
    monkeypatch.setattr(rp, "MOST_CUTS", cuts)
    rows, df = units
    got = {r["rep"]: r["tau"] for r in ex.permutation_effects(df, "id", "y", "d", 6, "p", within=within).collect()}
    adjusted = {r["rep"]: r["tau"] for r in ex.permutation_effects(df, "id", "y", "d", 6, "p", within=within, controls=["c"]).collect()}
    for rep in range(1, 7):
        treated = set()
        for g in ({r[4] for r in rows} if within else {"all"}):
            block = [r for r in rows if not within or r[4] == g]
            treated |= lowest("p", [r[0] for r in block], rep, sum(r[2] for r in block))
        seen = [r for r in rows if r[1] is not None]
        d = np.array([r[0] in treated for r in seen], float)
        y, c = np.array([r[1] for r in seen]), np.array([r[3] for r in seen])
        assert got[rep] == pytest.approx(y[d == 1].mean() - y[d == 0].mean(), abs=1e-9)
        beta = np.linalg.lstsq(np.column_stack([np.ones_like(d), d, c]), y, rcond=None)[0]
        assert adjusted[rep] == pytest.approx(beta[1], abs=1e-9)


def test_bootstrap_and_noise(units):
    rows, df = units
    seen = [r for r in rows if r[1] is not None]
    boot = {r["rep"]: r for r in ex.bootstrap_moments(df, "id", "c", "y", 5, "b").collect()}
    x, y = np.array([r[3] for r in seen]), np.array([r[1] for r in seen])
    for rep in range(1, 6):
        w = np.searchsorted(ex.POISSON_ONE, np.array(numbers("b", [r[0] for r in seen], rep)) / SPACE, side="right").astype(float)
        slope = (w.sum() * (w * x * y).sum() - (w * x).sum() * (w * y).sum()) / (w.sum() * (w * x * x).sum() - (w * x).sum() ** 2)
        assert boot[rep]["n"] == w.sum() and boot[rep]["slope"] == pytest.approx(slope)
    sweep = {r["sigma"]: r for r in ex.noise_sweep(df, "id", "y", "d", "c", [0.0, 2.0], 4, "n").collect()}
    d = np.array([r[2] for r in seen], float)
    for sigma in (0.0, 2.0):
        fits = []
        for rep in range(1, 5):
            u = np.array([hashes("n", f"{rep}:{r[0]}") for r in seen]) / SPACE
            noisy = x + sigma * np.sqrt(-2 * np.log(1 - u[:, 0])) * np.cos(2 * np.pi * u[:, 1])
            fits.append(np.linalg.lstsq(np.column_stack([np.ones_like(d), d, noisy]), y, rcond=None)[0][1])
        assert sweep[sigma]["n_fits"] == 4 and sweep[sigma]["mean_estimate"] == pytest.approx(np.mean(fits), abs=1e-9)


def test_no_row_is_copied(units):
    _, df = units
    for out in (ex.aa_test(df, "id", "y", 50, "aa"), ex.permutation_effects(df, "id", "y", "d", 50, "p", within=["g"]),
                ex.bootstrap_moments(df, "id", "c", "y", 50, "b")):
        assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_take_all_or_none(spark):
    df = spark.createDataFrame([(i, i % 2, float(i)) for i in range(40)], "id int, g int, y double")
    rows = rp.prepared(df, "id", "s", [F.lit(1.0), F.col("y")], F.col("g"))
    for ranked in (10, 1_000_000):
        rp.RANKED, before = ranked, rp.RANKED
        try:
            got = {r["rep"]: list(r["s"]) for r in rp.sums_of_lowest(rows, np.array([0, 20]), np.array([20, 20]), 3, 2).collect()}
        finally:
            rp.RANKED = before
        assert got == {k: [20.0, float(sum(range(1, 40, 2)))] for k in (1, 2, 3)}
