"""Text, CSV and JSON files in; tables out; a log of what each run did."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ZONES = ("raw", "processed", "outputs")


def zone_path(base: str, zone: str, name: str) -> str:
    """raw, processed and outputs below one base folder."""
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone}")
    return f"{base.rstrip('/')}/{zone}/{name}"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header row and a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_platform_csv(spark: SparkSession, path: str, schema: T.StructType, skip: int = 2) -> DataFrame:
    """Survey export: drop the first ``skip`` records of each file and the header record after them.

    The leading records sit in the first split of a file, so each task counts them on its own.
    """
    names = schema.fieldNames()
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(text).csv(path).select(
        *names, F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
    )

    def drop_leading(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for batch in batches:
            place = batch.groupby("__file").cumcount() + batch["__file"].map(seen).fillna(0)
            yield batch.loc[(batch["__start"] > 0) | (place > skip), names]
            for file, n in batch["__file"].value_counts().items():
                seen[file] = seen.get(file, 0) + n

    body = raw.mapInPandas(drop_leading, text)
    return body.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Overwrite; no index column; CSV gets a header."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def create_table(spark: SparkSession, name: str, columns: str, path: str) -> None:
    """Drop and create a Parquet table at a path."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")


def append_rows(df: DataFrame, name: str) -> None:
    """Append to a table in parallel write tasks; columns are matched by name."""
    target = df.sparkSession.table(name).columns
    df.select(*target).write.mode("append").insertInto(name)


# ---------------------------------------------------------------- JSON

def flatten_records(df: DataFrame, text: str, schema: str, fields: Sequence[str]) -> DataFrame:
    """Parse nested JSON once per row and select dotted paths as columns of the same dotted name."""
    record = F.from_json(F.col(text), schema)
    others = [c for c in df.columns if c != text]
    parsed = df.select(*others, F.explode(F.array(record)).alias("__json"))
    return parsed.select(*others, *[F.col(f"__json.{f}").alias(f) for f in fields])


def map_to_rows(df: DataFrame, entity: str, mapping: str, key: str, value: str) -> DataFrame:
    return df.select(entity, F.explode(mapping).alias(key, value))


def land_responses(df: DataFrame, path: str) -> None:
    """Append raw responses as JSON lines; a landed body is never rewritten."""
    df.write.mode("append").json(path)


RESPONSE_SCHEMA = "endpoint string, params string, page bigint, fetched_at timestamp_ntz, body string"


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSE_SCHEMA).json(path)


def latest_responses(landed: DataFrame) -> DataFrame:
    """The newest body per (endpoint, params, page): a maximum of structs, combined map-side."""
    newest = F.max(F.struct("fetched_at", "body")).alias("newest")
    return landed.groupBy("endpoint", "params", "page").agg(newest).select(
        "endpoint", "params", "page", "newest.*")


def provenance(landed: DataFrame) -> DataFrame:
    return landed.groupBy("endpoint", "params").agg(
        F.count_distinct("page").alias("n_pages"), F.count(F.lit(1)).alias("n_fetches"),
        F.min("fetched_at").alias("first_fetch"), F.max("fetched_at").alias("last_fetch"))


def series_window(observations: DataFrame, series: Sequence[str], start: str, end: str) -> DataFrame:
    """Cached observations (series_id, date, value) of some series between two dates."""
    return observations.filter(F.col("series_id").isin(list(series)) & F.col("date").between(start, end))


# ---------------------------------------------------------------- run log

LOG_SCHEMA = "step string, rows bigint, path string, seed string, started_at double, finished_at double"


class RunLog:
    """Row counts per step, taken while the steps run, and written next to the outputs."""

    def __init__(self, spark: SparkSession, seed: str):
        self.spark, self.seed, self.started = spark, seed, time.time()
        self.steps: list[tuple[str, Observation]] = []

    def step(self, name: str, df: DataFrame, *metrics: Column) -> DataFrame:
        seen = Observation(f"{name}-{len(self.steps)}")
        self.steps.append((name, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics)

    def rows(self, path: str) -> DataFrame:
        """The log as a frame; call after the observed output was written."""
        now = time.time()
        records = [(n, o.get["rows"], path, self.seed, self.started, now) for n, o in self.steps]
        return self.spark.createDataFrame(records, LOG_SCHEMA)
