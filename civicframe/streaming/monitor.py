"""Live monitoring of an experiment with Structured Streaming, on the batch expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicframe.functions.hashing import hash_unit
from civicframe.session import scratch_path


def event_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 64) -> DataFrame:
    """New Parquet files below a path, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def event_time(df: DataFrame, col: str) -> DataFrame:
    """Zone-free event times as instants, as watermarks need them."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def arm(key: str, seed: str, p: float = 0.5) -> Column:
    """Sticky assignment by hash: no state, the same arm whenever the unit is seen."""
    return (hash_unit(seed, key) < p).cast("int")


def daily_by_arm(events: DataFrame, ts: str, value: str, treat: str, delay: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Count, mean and missing share by window and arm; late rows beyond ``delay`` are dropped."""
    marked = events.withWatermark(ts, delay) if events.isStreaming else events
    return marked.groupBy(F.window(ts, window).alias("w"), treat).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"),
        F.avg(F.col(value).isNull().cast("int")).alias("missing_share"))


def level_counts(events: DataFrame, ts: str, level: str, delay="1 hour", window="1 day") -> DataFrame:
    """Rows by window and level, however many levels there are: (w, level, n)."""
    marked = events.withWatermark(ts, delay) if events.isStreaming else events
    return marked.groupBy(F.window(ts, window).alias("w"), F.col(level).alias("level")).agg(F.count(F.lit(1)).alias("n"))


def drift_alerts(counts: DataFrame, baseline: DataFrame, limit: float) -> DataFrame:
    """Windows in which the share of a level differs from its baseline share by more than ``limit`` (> 0).

    ``counts`` is the table that :func:`level_counts` keeps. A level that a window lacks has the share 0 there; that is
    an alert only if its baseline share exceeds the limit, which holds for fewer than 1 / limit levels, so only those meet every window.
    """
    if limit <= 0:
        raise ValueError("alerts need a limit above 0")
    totals = counts.groupBy("w").agg(F.sum("n").alias("total"))
    expected = baseline.select("level", F.col("share").alias("baseline_share"))
    frequent = expected.filter(F.col("baseline_share") > limit)
    lacking = totals.crossJoin(F.broadcast(frequent)).join(counts, ["w", "level"], "left_anti").select(
        "w", "level", "total", F.lit(0.0).alias("share"), "baseline_share")
    present = counts.join(totals, "w").join(expected, "level").select(
        "w", "level", "total", (F.col("n") / F.col("total")).alias("share"), "baseline_share")
    rows = present.unionByName(lacking).withColumnRenamed("total", "n")
    return rows.withColumn("difference", F.col("share") - F.col("baseline_share")).filter(F.abs("difference") > limit)


def first_seen(events: DataFrame, key: str, ts: str, seed: str, within: str | None = None) -> DataFrame:
    """Each unit once, with its arm, when it is first seen.

    A stream remembers every unit that it has seen in its state; :func:`assign_first_seen` keeps them in a table instead.
    ``within`` bounds the state: a unit may then come again after that time.
    """
    once = events.select(key, ts)
    if within is not None and events.isStreaming:
        once = once.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])
    else:
        once = once.select(key).dropDuplicates([key])
    return once.select(key, arm(key, seed).alias("treat"))


def assign_first_seen(stream: DataFrame, key: str, seed: str, folder: str) -> DataFrame:
    """Process all files that are there now; each unit gets its arm once, in the batch that first brings it: (key, treat, batch).

    The units of earlier batches are a table below ``folder``, not state in the executors' memory; a batch keeps what is not in it.
    The checkpoint is there too, so a later call with the same folder goes on where this one ended. A batch that is run again
    after a failure compares with the batches before it and overwrites its own part, so no unit comes twice or is lost.
    """
    spark, units = stream.sparkSession, f"{folder.rstrip('/')}/units"
    kind = stream.schema[key].dataType
    table = T.StructType([T.StructField(key, kind), T.StructField("treat", T.IntegerType()), T.StructField("batch", T.LongType())])

    def keep(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.select(key).distinct()
        if batch_id:
            known = spark.read.schema(table).parquet(units).filter(F.col("batch") < batch_id).select(F.col(key).alias("__known"))
            fresh = fresh.join(known, F.col(key).eqNullSafe(F.col("__known")), "left_anti")
        fresh.select(key, arm(key, seed).alias("treat")).write.mode("overwrite").parquet(f"{units}/batch={batch_id}")

    query = stream.writeStream.option("checkpointLocation", f"{folder.rstrip('/')}/state").trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
    return spark.read.schema(table).parquet(units)


def run_available(stream: DataFrame, name: str, mode: str = "append", finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Process all files that are there now, write to a table, and read the table back.

    Append writes each finished row once. Complete and update rewrite a (small) result per batch;
    the newest batch wins.
    """
    spark = stream.sparkSession
    out, state = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    if finish is not None:
        stream = finish(stream)
    writer = stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True)
    if mode == "append":
        query = writer.outputMode("append").format("parquet").option("path", out).start()
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = writer.outputMode(mode).foreachBatch(keep).start()
    query.awaitTermination()
    table = spark.read.parquet(out)
    last = table.agg(F.max("batch")).first()[0]
    return table.filter(F.col("batch") == last).drop("batch")
