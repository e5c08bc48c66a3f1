"""The paths for large groups give the same rows as plain windows, on any partitioning."""

import pytest
from pyspark.sql import functions as F

from civicframe.functions.hashing import hash48, replicate_hash, hash48_second, to_unit
from civicframe.operators import experiments as ex
from civicframe.operators import relational as rel
from civicframe.operators import scalable as sc
from civicframe.operators import timeseries as ts


@pytest.fixture(scope="module")
def rows(spark):
    """One group holds a third of the rows; another key is null."""
    base = spark.range(3000).withColumn("h", hash48("rows", "id"))
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("h") % 50 == 0, None).otherwise(F.concat(F.lit("k"), (F.col("h") % 20).cast("string")))
    return base.select("id", key.alias("g"), (F.col("h") % 97).cast("double").alias("v"), (F.col("h") % 11).cast("int").alias("t"))


def same(a, b, cols):
    left = sorted(map(tuple, a.select(*cols).collect()), key=str)
    right = sorted(map(tuple, b.select(*cols).collect()), key=str)
    assert len(left) == len(right)
    for x, y in zip(left, right):
        for u, v in zip(x, y):
            assert u == v or abs(u - v) < 1e-9


@pytest.mark.parametrize("by", [["g"], []])
def test_row_number(rows, by):
    plain = sc.row_number_by(rows, by, ["t", "id"], limit=sc.BOUNDED)
    same(plain, sc.row_number_by(rows, by, ["t", "id"], limit=0), ["id", "rn"])


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("how", ["sum", "min"])
def test_running_totals(rows, inclusive, how):
    def run(limit):
        return sc.running_totals(rows, ["g"], ["t", "id"], {"r": F.col("v")}, inclusive, limit, how)

    same(run(sc.BOUNDED), run(0), ["id", "r"])


def test_running_sum_with_peers(rows):
    def run(limit):
        return sc.running_sum_with_peers(rows, ["g"], ["t"], "v", "r", limit)

    same(run(sc.BOUNDED), run(0), ["id", "r"])


def test_moving_average_and_lag(rows):
    plain = sc.moving_average(rows, ["g"], ["t", "id"], "v", 30, "m", limit=sc.BOUNDED)
    same(plain, sc.moving_average(rows, ["g"], ["t", "id"], "v", 30, "m", limit=0, chunk=40), ["id", "m"])
    plain = sc.lagged(rows, ["g"], ["t", "id"], "v", 3, "m", limit=sc.BOUNDED)
    same(plain, sc.lagged(rows, ["g"], ["t", "id"], "v", 3, "m", limit=0, chunk=10), ["id", "m"])


@pytest.mark.parametrize("by", [["g"], []])
def test_quantiles(rows, by):
    probs = {"a": 0.025, "b": 0.5, "c": 0.9}
    plain = sc.exact_quantiles(rows, by, "v", probs, limit=sc.BOUNDED)
    same(plain, sc.exact_quantiles(rows, by, "v", probs, limit=0), [*by, "a", "b", "c"])


def test_lowest_by_hash_is_exact(rows):
    hashed = rows.withColumn("x", hash48("pick", "id"))
    for buckets in (4, 4096):
        got = sc.flag_lowest_by_hash(hashed, "x", F.floor(F.col("group_n") / 2), "low", ["g"], ["id"], buckets=buckets)
        assert got.count() == 3000
        for r in got.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.count_if("low").alias("k")).collect():
            assert r["k"] == r["n"] // 2
        edges = got.groupBy("g").agg(F.max(F.when(F.col("low"), F.col("x"))).alias("a"), F.min(F.when(~F.col("low"), F.col("x"))).alias("b"))
        assert edges.filter("a >= b").count() == 0
    assert sc.lowest_by_hash(hashed, "x", F.lit(0)).count() == 0


def test_salted_join(rows):
    right = rows.groupBy("g").agg(F.sum("v").alias("s"))
    plain = rows.join(right, "g")
    same(plain, sc.salted_join(rows, right, ["g"], rows_per_salt=50), ["id", "s"])
    other = rows.select("g", F.col("id").alias("id2")).filter("id2 % 5 = 0")
    both = rows.select("g", "id").join(other, "g")
    same(both, sc.salted_join(rows.select("g", "id"), other, ["g"], rows_per_salt=40), ["id", "id2"])


def test_ntiles(rows):
    plain = rel.rank_ntile(rows, ["v", "id"], 10, "d")
    same(plain, rel.rank_ntile(rows, ["v", "id"], 10, "d", limit=0), ["id", "d"])
    sizes = [r["n"] for r in plain.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sizes == [300] * 10


def test_series_operators_on_large_series(rows):
    series = rows.select("g", F.col("id").alias("t"), "v").filter("g IS NOT NULL")
    same(ts.autocorrelation(series, ["g"], "t", "v", 4), ts.autocorrelation(series, ["g"], "t", "v", 4, limit=0, chunk=25), ["g", "lag", "acf"])
    same(ts.decompose(series, ["g"], "t", "v", 7), ts.decompose(series, ["g"], "t", "v", 7, limit=0, chunk=25), ["g", "t", "trend", "seasonal"])


def test_hashes_do_not_depend_on_partitions(spark, rows):
    def split(n):
        out = rel.random_split(rows.repartition(n), "id", {"a": 0.6, "b": 0.4}, "s")
        return sorted((r["id"], r["split"]) for r in out.collect())

    assert split(1) == split(17)
    assert sum(s == "a" for _, s in split(4)) == 1800


def test_replicates_look_uniform(rows):
    h = replicate_hash(hash48("s", "id"), hash48_second("s", "id"), F.lit(7).cast("bigint"))
    mean, low = rows.agg(F.avg(to_unit(h)), F.count_if(to_unit(h) < 0.1)).first()
    assert abs(mean - 0.5) < 0.03 and abs(low - 300) < 70


def test_aa_test_and_permutations(rows):
    effects = ex.aa_test(rows, "id", "v", 40, "aa").collect()
    assert len(effects) == 40
    assert abs(sum(r["aa_effect"] for r in effects) / 40) < 1.0
    treated = rows.withColumn("d", (F.col("id") % 4 == 0).cast("int"))
    perms = ex.permutations(treated.select("id", "g", "d"), "id", "d", 5, "p", within=["g"])
    want = treated.groupBy("g").agg(F.sum("d").alias("n1"))
    got = perms.groupBy("rep", "g").agg(F.sum("d_perm").alias("k"))
    assert sc.null_safe_join(got, want, ["g"]).filter("k <> n1").count() == 0
    test = ex.permutation_test(treated, "id", "v", "d", 99, "p").first()
    assert test["n_permutations"] == 99 and 0.01 <= test["p_value"] <= 1


def test_bh_adjust_matches_definition(spark):
    p = [0.001, 0.008, 0.039, 0.041, 0.042, 0.06, 0.074, 0.205, 0.212, 0.216]
    df = spark.createDataFrame(list(enumerate(p)), "i int, p double")
    m, want, low = len(p), {}, 1.0
    for rank in range(m, 0, -1):
        low = min(low, p[rank - 1] * m / rank)
        want[rank - 1] = low
    for limit in (None, 0):
        got = {r["i"]: r["p_adjusted"] for r in ex.bh_adjust(df, "p", tie=["i"], limit=limit).collect()}
        assert got == pytest.approx(want)


def test_stages_are_removed(spark, tmp_path):
    from civicframe.plans import catalog
    from civicframe.session import stages

    with stages(spark, str(tmp_path)) as folder:
        assert catalog.queries()["j4_tfidf"](spark, "/root/testdata/sf0.001").count() > 0
        assert any(tmp_path.iterdir()) and folder.startswith(str(tmp_path))
    assert not any(tmp_path.iterdir())
