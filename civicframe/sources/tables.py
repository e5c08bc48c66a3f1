"""Parquet tables and the relations derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Attribute access to the Parquet tables below a directory, read lazily."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def register(self, *names: str) -> None:
        """Make temp views, for operators written as SQL text."""
        for name in names or TABLES:
            getattr(self, name).createOrReplaceTempView(name)

    def sql(self, text: str, *names: str) -> DataFrame:
        """SQL text to a frame."""
        self.register(*names)
        return self.spark.sql(text)
