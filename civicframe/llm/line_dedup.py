"""Line dedup by a log-template tree: lines that are instances of a template found in several documents are dropped.

The tree has a fixed depth: number of tokens, then the leading tokens; a token with a digit is a variable field
from the start. The lines of one leaf share a template: up to FIELDS runs of tokens, each constant if more than half of the
leaf's different lines agree on it, else variable. A line is an instance if at least half of its fields beyond the leading
tokens are the template's constants; a line that is no instance is a template by itself. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import WORD_PATTERN, pick, reused
from civicframe.session import materialise

LEADING = 3
FIELDS = 8
VARIABLE = "<*>"


def _tokens(line: Column) -> Column:
    tokens = F.regexp_extract_all(line, F.lit(f"({WORD_PATTERN})"))
    return F.when(line.rlike("[0-9]"), F.transform(
        tokens, lambda t: F.when(t.rlike("[0-9]"), F.lit(VARIABLE)).otherwise(t))).otherwise(tokens)


def parse_lines(keyed: DataFrame) -> DataFrame:
    """Lines with a token: doc_id, text_hash, line, exact (hash of the tokens), leaf, and the hashes of the fields."""
    lines = keyed.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("line", "body"))
    tokens = lines.select("doc_id", "text_hash", "line", _tokens(F.col("body")).alias("tokens")).where(F.size("tokens") > 0)
    n = F.size("tokens")
    many = F.least(n, F.lit(FIELDS))

    def field(j: Column) -> Column:
        first, last = F.floor(j * n / many).cast("int"), F.floor((j + 1) * n / many).cast("int")
        return F.xxhash64(F.slice("tokens", first + 1, last - first))

    return tokens.select(
        "doc_id", "text_hash", "line", F.xxhash64("tokens").alias("exact"), n.alias("n"),
        F.xxhash64(n, F.slice("tokens", 1, LEADING)).alias("leaf"),
        F.transform(F.sequence(F.lit(0), many - 1), field).alias("fields"))


def instances(lines: DataFrame) -> DataFrame:
    """(exact, leaf) of the lines that are instances of their leaf's template, in leaves with several different lines."""
    leaves = lines.groupBy("leaf").agg(F.min("exact").alias("low"), F.max("exact").alias("high"))
    several = reused(leaves.where("low <> high").select("leaf"))
    different = materialise(lines.join(several, "leaf").groupBy("leaf", "exact").agg(
        F.any_value("fields").alias("fields"), F.any_value("n").alias("n")))
    size = different.groupBy("leaf").agg(F.count(F.lit(1)).alias("lines"))
    cells = different.select("leaf", "exact", "n", F.size("fields").alias("many"), F.posexplode("fields").alias("field", "value"))
    beyond = cells.where(F.floor((F.col("field") + 1) * F.col("n") / F.col("many")) > LEADING)
    votes = beyond.groupBy("leaf", "field", "value").agg(F.count(F.lit(1)).alias("votes")).where("votes > 1")
    constant = votes.join(size, "leaf").where("2 * votes > lines").select("leaf", "field", "value", F.lit(1).alias("same"))
    alike = beyond.join(constant, ["leaf", "field", "value"], "left").groupBy("leaf", "exact").agg(
        F.count("same").alias("same"), F.count(F.lit(1)).alias("all"))
    return alike.where("2 * same >= all").select("exact", "leaf")


def recurring_lines(keyed: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line) of every line to drop: instances of a template that several documents have, but
    for the first of them by doc_id (null last), text hash and line."""
    lines = materialise(parse_lines(keyed))
    document = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "line")
    exact = lines.groupBy("exact").agg(F.min(place).alias("first"), F.min(document).alias("low"), F.max(document).alias("high"))
    general = instances(lines).withColumnRenamed("leaf", "template")
    known = materialise(exact.join(general, "exact", "left").select(
        "exact", "first", "low", "high", F.struct(F.col("template").isNotNull().alias("general"),
                                                  F.coalesce("template", "exact").alias("key")).alias("template")))
    shared = known.groupBy("template").agg(
        F.min("first").alias("first"), F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high")
    dropped = known.select("exact", "template").join(shared.select("template", "first"), "template").select("exact", "first")
    return lines.select("doc_id", "text_hash", "line", "exact").join(dropped, "exact").where(
        ~place.eqNullSafe(F.col("first"))).select("doc_id", "text_hash", "line")


def _marked(docs: DataFrame, doc_id: str, text: str, others: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``others`` of every row, its lines and the numbers of the lines to drop (null: none)."""
    keyed = pick(docs, doc_id=doc_id, text=text).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    gone = recurring_lines(keyed).groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("gone")).withColumnsRenamed(
        {"doc_id": "d", "text_hash": "h"})
    rows = pick(docs, doc_id=doc_id, text=text, **{f"o{i}": c for i, c in enumerate(others)})
    rows = rows.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit("")))).withColumn("lines", F.split("text", "\n")).drop("text")
    return rows.join(gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")


def _kept() -> Column:
    at = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    return F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(at, lambda i: F.get("lines", i)), "\n"))


def drop_recurring_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped and the remaining text of every row of ``docs``.

    The first line of each recurring template stays, so that what copies share is kept once. Blank lines stay. Null
    texts stay null with 0 lines; an empty text is one blank line; a text may end up empty. Rows with equal id and text are one
    document and keep the same lines. An empty table gives an empty table; other columns are not read.
    """
    return _marked(docs, doc_id, text).select(
        "doc_id", F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("bigint").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint").alias("n_dropped"), _kept().alias("text"))


def clean_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with the remaining texts, same columns; ``length`` names the column with the text's length, if there is one."""
    names = list(docs.columns)
    rows = _marked(docs, doc_id, text, tuple(names))
    out = {n: F.col(f"o{i}") for i, n in enumerate(names)} | {text: F.when(F.col("gone").isNull(), F.col(f"o{names.index(text)}")).otherwise(_kept())}
    if length in names:
        out[length] = F.when(F.col("gone").isNull(), F.col(f"o{names.index(length)}")).otherwise(
            F.length(_kept()).cast(docs.schema[length].dataType))
    return rows.select(*[out[n].alias(f"c{i}") for i, n in enumerate(names)]).toDF(*names)
