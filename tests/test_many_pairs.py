"""Joins whose result outgrows their input, and term counts cut once."""

import math

import pytest
from pyspark.sql import functions as F

from civicframe.operators import linkage, models, scalable, spatial, textual
from civicframe.operators import relational as rel
from civicframe.plans import catalog


def test_left_rows_of_a_full_key_are_dealt(spark):
    """Each chunk has a share of a key's left rows and all of its right rows; unmatched and null keys stay."""
    a = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 40), (None, 41), (3, 42)], "k int, x int")
    b = spark.createDataFrame([(1, i) for i in range(30)] + [(3, 30), (None, 31), (4, 32)], "k int, y int")
    left, right, on = scalable.chunked_by_pairs(a, b, ["k"], pairs_per_chunk=150)
    assert on == ["k", "__chunk"]
    assert left.filter("k = 1").groupBy("__chunk").count().count() > 4
    assert left.count() == 43 and right.filter("k = 1").count() == 30 * 8
    for how in ("left", "inner"):
        got = left.join(right, on, how).select("k", "x", "y").collect()
        assert sorted(got, key=str) == sorted(a.join(b, ["k"], how).collect(), key=str)


def test_many_to_many_pairs_meet_in_many_tasks(spark):
    a = spark.range(3000).select((F.col("id") < 0).cast("int").alias("k"), F.col("id").alias("x")).coalesce(1)
    b = spark.range(3000).select((F.col("id") < 0).cast("int").alias("k"), F.col("id").alias("y")).coalesce(1)
    joined = rel.related_join(a, b, ["k"], "many-to-many")
    assert joined.count() == 9_000_000
    assert joined.groupBy(F.spark_partition_id()).count().count() > 1


@pytest.mark.parametrize("rows", [3, 2000])
@pytest.mark.parametrize("weight", [None, "wa", "wb"])
def test_neighbourhood_of_crowded_cells(spark, monkeypatch, rows, weight):
    """Counts, sums and minima against every pair: crowded cells, repeated and null keys, null and undefined places."""
    monkeypatch.setattr(spatial, "ROWS_PER_SALT", rows)
    odd = [(100, None, 1.0, 1.0), (101, float("nan"), 1.0, 1.0), (None, 0.5, 0.5, 1.0), (103, 90.0, 90.0, 1.0)]
    one = [(i % 17, (i * 37 % 50) / 10, (i * 53 % 40) / 10, None if i % 5 == 0 else float(i)) for i in range(25)] + odd
    other = [(((i * 29) % 45) / 10, ((i * 31) % 38) / 10, None if i % 4 == 0 else i + 1) for i in range(25)]
    other += [(None, 1.0, 1), (float("nan"), 0.0, 1)]
    a = spark.createDataFrame(one, "k int, ax double, ay double, wa double")
    b = spark.createDataFrame(other, "bx double, by double, wb int")
    near = {}
    for k, ax, ay, wa in one:
        for bx, by, wb in other:
            if k is not None and None not in (ax, ay, bx, by) and (gap := math.sqrt((ax - bx) ** 2 + (ay - by) ** 2)) <= 1.5:
                w = {None: 1.0, "wa": wa, "wb": wb}[weight] or 0.0
                n, e, m = near.get(k, (0, 0.0, math.inf))
                near[k] = n + 1, e + w / (1 + gap), min(m, gap)
    got = spatial.neighbourhood(a, "k", b, 1.5, weight).collect()
    assert sorted(r["k"] or -1 for r in got) == sorted(k or -1 for k, *_ in one)
    for r in got:
        n, e, m = near.get(r["k"], (0, 0.0, None))
        assert r["n_near"] == n and r["exposure"] == pytest.approx(e) and r["nearest"] == (None if m is None else pytest.approx(m))


def test_distance_join_spreads_rows_of_one_task(spark):
    a = spark.range(2000).select("id", (F.col("id") % 100 / 10).alias("ax"), (F.col("id") % 7).cast("double").alias("ay")).coalesce(1)
    b = a.select(F.col("id").alias("other"), F.col("ax").alias("bx"), F.col("ay").alias("by"))
    pairs = spatial.distance_join(a, b, 1.0)
    assert pairs.groupBy(F.spark_partition_id()).count().count() > 1
    assert pairs.count() == a.crossJoin(b).where("(ax - bx) * (ax - bx) + (ay - by) * (ay - by) <= 1").count()


def test_pairs_of_a_block_meet_in_many_tasks(spark):
    rows = spark.range(5000).select("id", (F.col("id") < 0).cast("int").alias("block"), (F.col("id") % 9).alias("x")).coalesce(1)
    pairs = linkage.candidate_pairs(rows, rows, "id", ["block"], ["x"])
    assert pairs.columns == ["block", "id_a", "x_a", "id_b", "x_b"]
    assert pairs.groupBy(F.spark_partition_id()).count().count() > 1
    assert pairs.count() == 25_000_000


def test_texts_are_cut_once(spark):
    """Both sides of the filter on document numbers read one exchange, and counts may carry those numbers."""
    df = spark.createDataFrame([(1, "aa bb aa"), (1, "bb cc"), (2, "aa dd"), (None, "dd ee"), (3, None)], "d int, t string")
    counts = textual.dtm(df, "d", "t")
    assert sorted(map(tuple, counts.select("d", "term", "n").collect()), key=str) == sorted([(1, "aa", 2), (2, "aa", 1), (2, "dd", 1), (None, "dd", 1)], key=str)
    counts.collect()
    assert "ReusedExchange" in counts._jdf.queryExecution().executedPlan().toString()
    with_df = textual.dtm(df, "d", "t", with_df=True)
    assert {r["term"]: r["df"] for r in with_df.collect()} == {"aa": 2, "dd": 2}
    assert sorted(textual.tfidf(with_df, "d", 4).select("d", "term", "tfidf").collect(), key=str) == sorted(
        textual.tfidf(counts, "d", 4).select("d", "term", "tfidf").collect(), key=str)


def test_propagated_vectors_are_written_once(spark, monkeypatch, tmp_path):
    """The split and the training read a table, not the joins along the links."""
    made = {
        "lineitem": ([(i, i % 7, float(i % 5)) for i in range(200)], "l_orderkey long, l_suppkey long, l_quantity double"),
        "orders": ([(i, i % 40) for i in range(200)], "o_orderkey long, o_custkey long"),
        "customer": ([(i,) for i in range(40)], "c_custkey long"),
        "supplier": ([(i,) for i in range(7)], "s_suppkey long")}
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    seen, accuracy = [], models.logistic_accuracy
    monkeypatch.setattr(models, "logistic_accuracy", lambda rows, *names: seen.append(rows) or accuracy(rows, *names))
    found = catalog.queries()["l11_propagated_classifier"](spark, str(tmp_path))
    assert sum(r["n"] for r in found.collect()) == 47
    assert "dim#" not in seen[0]._jdf.queryExecution().analyzed().toString()
