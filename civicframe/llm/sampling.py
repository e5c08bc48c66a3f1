"""Bounded, repeatable samples of labelled rows, on which classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicframe.functions.hashing import hash_unit
from civicframe.session import materialise


def crc_of(doc_id: Column) -> Column:
    """CRC-32 of an id written as text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def bounded_sample(rows: DataFrame, label: str, per_label: int, seed: str, *ids: str) -> DataFrame:
    """At most ``per_label`` rows of each label: those with the smallest hash of their ids.

    A first cut by the hash, at twice the share that is needed, runs without a shuffle; only what it leaves is ranked.
    """
    counts = materialise(rows.groupBy(F.col(label).alias("of")).agg(F.count(F.lit(1)).alias("n")))
    drawn = rows.withColumn("u", hash_unit(seed, *ids)).join(counts, F.col(label) == F.col("of"))
    near = drawn.where(F.col("u") * F.col("n") < 2 * per_label + 20)
    place = F.row_number().over(Window.partitionBy(label).orderBy("u", *ids))
    return near.withColumn("place", place).where(F.col("place") <= per_label).drop("u", "of", "n", "place")
