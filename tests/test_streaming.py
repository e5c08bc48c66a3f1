"""Streams over several files give the batch result; late rows are dropped."""

from pyspark.sql import functions as F

from civicframe.streaming import monitor as mo


def events(spark, first, last):
    ts = (F.lit("2024-01-01").cast("timestamp").cast("long") + F.col("id") * 1800).cast("timestamp")
    rows = spark.range(first, last).select("id", (F.col("id") % 17).alias("user"), ts.alias("ts"), (F.col("id") % 5).cast("double").alias("v"))
    return rows.withColumn("treat", mo.arm("user", "s"))


def test_daily_and_first_seen(spark, tmp_path):
    path = str(tmp_path / "in")
    for lo in range(0, 300, 100):
        events(spark, lo, lo + 100).coalesce(1).write.mode("append").parquet(path)
    batch = events(spark, 0, 300)
    want = {(r["w"]["start"], r["treat"]): r["n"] for r in mo.daily_by_arm(batch, "ts", "v", "treat").collect()}
    stream = mo.event_stream(spark, path, batch.schema, files_per_trigger=1)
    got = mo.run_available(mo.daily_by_arm(stream, "ts", "v", "treat", delay="30 days"), "daily", "complete")
    assert {(r["w"]["start"], r["treat"]): r["n"] for r in got.collect()} == want
    once = mo.run_available(mo.first_seen(stream, "user", "ts", "s"), "seen", "append").collect()
    assert sorted(r["user"] for r in once) == list(range(17))


def test_no_unit_comes_twice_after_a_restart(spark, tmp_path):
    """Later files, a restart from the checkpoint, and a batch whose result was written before its commit was lost."""
    path, folder = str(tmp_path / "in"), str(tmp_path / "out")
    batch = events(spark, 0, 300)
    first = batch.filter("id < 60 and user < 9").unionByName(batch.filter("id < 5").withColumn("user", F.lit(None).cast("long")))
    first.repartition(3).write.mode("append").parquet(path)
    stream = mo.event_stream(spark, path, batch.schema, files_per_trigger=1)
    got = mo.assign_first_seen(stream, "user", "s", folder).collect()
    assert sorted((r["user"] is None, r["user"] or 0) for r in got) == [(False, i) for i in range(9)] + [(True, 0)]
    batch.filter("id >= 60").repartition(2).write.mode("append").parquet(path)
    mo.assign_first_seen(stream, "user", "s", folder)
    last = max(int(p.name) for p in (tmp_path / "out" / "state" / "commits").iterdir() if p.name.isdigit())
    for p in (tmp_path / "out" / "state" / "commits").glob(f"*{last}*"):
        p.unlink()  # the last batch has to run again
    again = mo.assign_first_seen(stream, "user", "s", folder).collect()
    arms = {r["user"]: r["treat"] for r in batch.select("user", mo.arm("user", "s").alias("treat")).distinct().collect()}
    assert len(again) == 18 and {r["user"]: r["treat"] for r in again if r["user"] is not None} == arms


def test_drift_of_very_many_levels(spark):
    rows = spark.range(6000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.when(F.col("id") < 3000, 0).otherwise(86400)).alias("ts"),
        F.when(F.col("id") % 3 == 0, F.lit("common")).otherwise(F.concat(F.lit("l"), (F.col("id") % 2000).cast("string"))).alias("level"))
    baseline = spark.createDataFrame([("common", 0.4), ("gone", 0.2), ("rare", 0.01)] + [(f"l{i}", 0.0002) for i in range(2000)], "level string, share double")
    alerts = {(str(r["w"]["start"])[:10], r["level"]): round(r["difference"], 6) for r in mo.drift_alerts(
        mo.level_counts(rows, "ts", "level"), baseline, 0.05).collect()}
    assert alerts == {(d, k): v for d in ("2024-01-01", "2024-01-02") for k, v in (("common", -0.066667), ("gone", -0.2))}
