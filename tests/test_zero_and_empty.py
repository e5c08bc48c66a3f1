"""Zero divisors and empty tables give values, never errors."""

import math

import pytest
from pyspark.sql import functions as F

from civicframe.operators import experiments as ex
from civicframe.operators import regression as reg
from civicframe.operators import relational as rel
from civicframe.operators import textual as tx
from civicframe.operators import timeseries as ts


def test_growth_after_zero(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 0.0), (4, 0.0), (5, -1.0), (6, None), (7, 2.0)], "t int, v double")
    got = {r["t"]: r["g"] for r in rel.growth(df, [], ["t"], "v", 1, "g").collect()}
    assert got[1] is None and got[2] == math.inf and got[3] == -1 and math.isnan(got[4]) and got[5] == -math.inf
    assert got[6] is None and got[7] is None


def test_share_of_a_zero_total(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", -1.0), ("c", None)], "k string, v double")
    assert {r["percentage"] for r in rel.share_of_total(df, ["k"], "v").collect()} == {None}
    assert rel.share_of_total(df.limit(0), ["k"], "v").count() == 0
    half = {r["k"]: r["percentage"] for r in rel.share_of_total(df.filter("v > 0").union(df.filter("v > 0")), ["k"], "v").collect()}
    assert half == {"a": 100.0}


def test_histogram_without_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    for rows in (df, df.limit(0)):
        assert [tuple(r) for r in rel.histogram(rows, "v", 2).orderBy("bin").collect()] == [(0, None, 0), (1, None, 0)]


def test_constant_series(spark):
    df = spark.createDataFrame([("c", i, 3.0) for i in range(6)] + [("v", i, float(i % 2)) for i in range(6)], "s string, t int, y double")
    acf = {(r["s"], r["lag"]): r["acf"] for r in ts.autocorrelation(df, ["s"], "t", "y", 2).collect()}
    assert all(math.isnan(acf["c", k]) for k in range(3)) and acf["v", 0] == 1.0 and acf["v", 1] < 0


def test_kappa_of_one_class(spark):
    one = ex.agreement(spark.createDataFrame([("x", "x")] * 3, "a string, b string"), "a", "b").first()
    assert one["agreement"] == 1.0 and math.isnan(one["kappa"])
    none = ex.agreement(spark.createDataFrame([], "a string, b string"), "a", "b").first()
    assert tuple(none) == (None, None, None)


def test_scores_of_constant_values(spark):
    df = spark.createDataFrame([("off", 2.0, 1.0), ("off", 2.0, 2.0), ("on", 2.0, 2.0), ("on", 2.0, 2.0)], "k string, y double, p double")
    r2 = {r["k"]: r["r2"] for r in reg.score_metrics(df, "y", "p", ["k"]).collect()}
    assert r2["off"] == -math.inf and math.isnan(r2["on"])


def test_models_and_tests_without_rows(spark):
    df = spark.createDataFrame([], "id int, y double, d int, c double, g string")
    assert reg.ols(df, "y", {"c": F.col("c")}).count() == 0
    assert math.isnan(reg.coefficients(df, "y", {"c": F.col("c")})["c"])
    for controls in ([], ["c"]):
        assert tuple(ex.permutation_test(df, "id", "y", "d", 20, "s", controls=controls).first()) == (None, 0, None)
    assert ex.permutation_effects(df, "id", "y", "d", 20, "s", within=["g"]).count() == 0
    assert ex.aa_test(df, "id", "y", 10, "s").count() == 0
    assert ex.bootstrap_moments(df, "id", "c", "y", 10, "s").count() == 0
    assert ex.noise_sweep(df, "id", "y", "d", "c", [0.0, 1.0], 5, "s").count() == 0
    assert ex.subgroup_effects(df, "d", "y", "g").count() == 0


def test_ratios_with_nothing_below(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (1, 2.0, 0.0), (0, 3.0, 0.0), (0, 3.0, 0.0)], "d int, y double, taken double")
    assert ex.wald(df, "d", "taken", "y").first()["tot"] == -math.inf
    assert math.isnan(ex.smd(df, "d", ["taken"]).first()["smd"])


def test_vectors_without_direction(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [2.0, 0.0, 0.0]), (4, [1.0, None]), (5, None), (6, [float("inf"), 1.0]), (7, []),
            (8, [1.0, 0.05]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    got = {(r["id_a"], r["id_b"]): (r["n_a"], r["n_b"]) for r in tx.cosine_pairs(df, "id", "v", 0.99).collect()}
    assert got == {(1, 8): (2, 1)}  # 3 has the direction of 1
    for recall in (None, 0.99):
        assert tx.cosine_pairs(df.filter("id in (2, 4, 5)"), "id", "v", 0.9, recall=recall).count() == 0
    pairs = df.alias("a").join(df.alias("b"), F.col("a.id") < F.col("b.id")).select(tx.cosine(F.col("a.v"), F.col("b.v")).alias("c"))
    assert pairs.where("c is not null and c > 0.99 and not isnan(c)").count() == 1
    similar = tx.class_similarity(df.filter("id in (1, 2, 8)").withColumn("label", F.lit("x")), "id", "v", "label")
    assert {r["id"]: r["similarity"] is None for r in similar.collect()} == {1: False, 2: True, 8: False}


def test_division(spark):
    from civicframe.functions.division import float_divide

    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(float_divide(F.col("a"), F.col("b"))).collect()]
    assert got[:3] == [0.5, math.inf, -math.inf] and math.isnan(got[3]) and got[4:] == [None, None]
    assert got[0] == pytest.approx(0.5)
