"""Least squares against numpy, robust errors against their formulas, tail probabilities."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicframe.functions import distributions as dist
from civicframe.functions.hashing import hash_normal, hash_unit
from civicframe.operators import experiments as ex
from civicframe.operators import models
from civicframe.operators import regression as reg


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 8).alias("block"), (F.col("id") % 23).alias("cluster"),
        (hash_unit("t", "id") < 0.5).cast("int").alias("treat"), hash_normal("x", "id").alias("x"))
    y = 2 + 1.5 * F.col("treat") - 0.7 * F.col("x") + 0.2 * F.col("block") + hash_normal("e", "id")
    df = df.withColumn("y", y).cache()
    return df, df.toPandas()


def lstsq(x, y):
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    return beta, y - x @ beta, np.linalg.inv(x.T @ x)


def table(df):
    return {r["term"]: r for r in df.collect()}


def test_ols(data):
    df, pdf = data
    x = np.c_[np.ones(len(pdf)), pdf.treat, pdf.x, pdf.x**2]
    beta, e, inv = lstsq(x, pdf.y.to_numpy())
    se = np.sqrt(np.diag(inv) * (e @ e) / (len(pdf) - 4))
    terms = {"treat": F.col("treat"), "x": F.col("x"), "x2": F.col("x") * F.col("x")}
    got = table(reg.ols(df, "y", terms))
    assert [got[t]["estimate"] for t in ("Intercept", *terms)] == pytest.approx(list(beta), rel=1e-9)
    assert [got[t]["std_error"] for t in ("Intercept", *terms)] == pytest.approx(list(se), rel=1e-9)
    assert reg.coefficients(df, "y", terms)["x2"] == pytest.approx(beta[3])


def test_many_terms_and_groups(data):
    df, pdf = data
    terms = {**reg.factor("block", reg.levels(df, "block")), "treat": F.col("treat"), "x": F.col("x")}
    x = np.c_[np.ones(len(pdf)), *[(pdf.block == b) for b in range(1, 8)], pdf.treat, pdf.x].astype(float)
    beta, _, _ = lstsq(x, pdf.y.to_numpy())
    assert table(reg.ols(df, "y", terms))["treat"]["estimate"] == pytest.approx(beta[8], rel=1e-8)
    by = reg.ols(df, "y", {"x": F.col("x")}, ["block"]).filter("term = 'x' AND block = 3").first()
    part = pdf[pdf.block == 3]
    beta, _, _ = lstsq(np.c_[np.ones(len(part)), part.x], part.y.to_numpy())
    assert by["estimate"] == pytest.approx(beta[1], rel=1e-9)


def test_cluster_and_hc2(data):
    df, pdf = data
    x = np.c_[np.ones(len(pdf)), pdf.treat, pdf.x].astype(float)
    beta, e, inv = lstsq(x, pdf.y.to_numpy())
    scores = np.array([(x * e[:, None])[pdf.cluster == c].sum(0) for c in range(23)])
    n, k, g = len(pdf), 3, 23
    v = inv @ (scores.T @ scores) @ inv * g / (g - 1) * (n - 1) / (n - k)
    terms = {"treat": F.col("treat"), "x": F.col("x")}
    assert table(reg.ols_cluster(df, "y", terms, "cluster"))["treat"]["std_error"] == pytest.approx(np.sqrt(v[1, 1]), rel=1e-8)
    h = np.einsum("ij,jk,ik->i", x, inv, x)
    v = inv @ ((x * (e**2 / (1 - h))[:, None]).T @ x) @ inv
    assert table(reg.ols_hc2(df, "y", terms))["x"]["std_error"] == pytest.approx(np.sqrt(v[2, 2]), rel=1e-8)


def test_absorbed_factor_equals_dummies(data):
    df, _ = data
    terms = {"x": F.col("x"), "treat": F.col("treat")}
    dummies = {**reg.factor("block", reg.levels(df, "block")), **terms}
    for name, full, absorbed in (
        ("classic", reg.ols(df, "y", dummies), reg.ols_absorbed(df, "y", terms, "block")),
        ("cluster", reg.ols_cluster(df, "y", dummies, "cluster"), reg.ols_absorbed(df, "y", terms, "block", "cluster", "cluster")),
        ("hc2", reg.ols_hc2(df, "y", dummies), reg.ols_absorbed(df, "y", terms, "block", cov="hc2")),
    ):
        a, b = table(full)["treat"], table(absorbed)["treat"]
        assert b["estimate"] == pytest.approx(a["estimate"], rel=1e-8), name
        assert b["std_error"] == pytest.approx(a["std_error"], rel=1e-7), name


def test_leave_one_out_grid_and_ridge(data):
    df, pdf = data
    got = {r["block"]: r["estimate"] for r in reg.leave_one_period_out(df, "y", {"x": F.col("x")}, "block").filter("term = 'x'").collect()}
    for b in range(8):
        rest = pdf[pdf.block != b]
        assert got[b] == pytest.approx(lstsq(np.c_[np.ones(len(rest)), rest.x], rest.y.to_numpy())[0][1], rel=1e-9)
    grid = {r["spec"]: r["estimate"] for r in reg.specification_grid(df, "y", "treat", {"x": F.col("x")}, {"none": [], "x": ["x"]}).collect()}
    assert grid["x"] == pytest.approx(reg.coefficients(df, "y", {"treat": F.col("treat"), "x": F.col("x")})["treat"])
    x = np.c_[pdf.treat, pdf.x].astype(float)
    xc, yc = x - x.mean(0), pdf.y - pdf.y.mean()
    want = np.linalg.solve(xc.T @ xc + 5 * np.eye(2), xc.T @ yc)
    assert reg.ridge(df, "y", {"treat": F.col("treat"), "x": F.col("x")}, 5.0)["x"] == pytest.approx(want[1])
    arrays = df.withColumn("f", F.array(F.col("treat").cast("double"), "x"))
    assert models.vector_ridge(arrays, "y", "f", 5.0)[1] == pytest.approx(list(want))


def test_tail_probabilities():
    assert dist.student_two_sided(2.228138851964939, 10) == pytest.approx(0.05, rel=1e-9)
    assert dist.student_two_sided(-12.706204736432095, 1) == pytest.approx(0.05, rel=1e-9)
    assert dist.student_two_sided(0.0, 5) == 1.0
    assert dist.normal_two_sided(1.959963984540054) == pytest.approx(0.05, rel=1e-9)


def test_calibration_moves_towards_truth(data):
    df, _ = data
    noisy = df.withColumn("obs", F.col("x") + hash_normal("n", "id")).withColumn("d", (F.col("x") + hash_normal("m", "id") > 0).cast("int"))
    noisy = noisy.withColumn("out", 1.0 * F.col("d") + 2.0 * F.col("x") + 0.1 * hash_normal("o", "id"))
    rows = ex.regression_calibration(noisy, "out", "d", "x", "obs", F.col("id") % 5 == 0).filter("term = 'd'").collect()
    est = {r["model"]: r["estimate"] for r in rows}
    assert abs(est["true"] - 1.0) < 0.1 < abs(est["naive"] - 1.0)


def test_large_offsets_do_not_cancel(spark):
    """Five columns with offsets far above their spread, as times in seconds have."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = x @ np.arange(1.0, 6.0) + 0.1 * rng.normal(size=400)
    cols = [f"c{i}" for i in range(5)]
    df = spark.createDataFrame([(*(1.7e9 + row).tolist(), float(1e9 + v)) for row, v in zip(x, y)], ", ".join(f"{c} double" for c in cols) + ", y double")
    got = {r["term"]: r["estimate"] for r in reg.ols(df, "y", {c: F.col(c) for c in cols}).collect()}
    assert [got[c] for c in cols] == pytest.approx([1, 2, 3, 4, 5], abs=0.05)
