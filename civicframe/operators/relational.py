"""Joins and their audit, grouped aggregation, reshaping, bins, ordered and random selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicframe.functions.division import float_divide
from civicframe.functions.hashing import hash48
from civicframe.operators import scalable


# ---------------------------------------------------------------- joins

def suffixed_join(a: DataFrame, b: DataFrame, keys: Sequence[str], how="inner",
                  suffixes=("_a", "_b")) -> DataFrame:
    """Equi-join in which clashing non-key columns get a suffix."""
    clash = (set(a.columns) & set(b.columns)) - set(keys)
    a = a.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    b = b.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return a.join(b, list(keys), how)


RELATIONSHIPS = ("one-to-one", "one-to-many", "many-to-one", "many-to-many")


def related_join(a: DataFrame, b: DataFrame, keys: Sequence[str], relationship: str, how: str = "left") -> DataFrame:
    """Equi-join that declares how often a key may occur on each side; an error when a side that says one has a key twice.

    Null keys match nothing and are not checked.
    """
    if relationship not in RELATIONSHIPS:
        raise ValueError(f"unknown relationship {relationship}")
    for frame, side, once in ((a, "left", relationship.startswith("one")), (b, "right", relationship.endswith("one"))):
        if once and not frame.na.drop(subset=list(keys)).groupBy(*keys).count().filter("count > 1").isEmpty():
            raise ValueError(f"{relationship}: a key occurs more than once on the {side}")
    if relationship == "many-to-many" and how in ("inner", "left"):
        a, b, on = scalable.chunked_by_pairs(a, b, keys)
        if len(on) > len(keys):
            a, b = scalable.dealt_out(a, b, on)
            return a.join(b, on, how).drop(*on[len(keys):])
    return a.join(b, list(keys), how)


def full_join_chain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer joins on a composite key, keys coalesced."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.join(frame, list(keys), "full")
    return out


def units_by_days(units: DataFrame, start: str, days: int, out: str = "date") -> DataFrame:
    """Every unit on every day of a period: each row is expanded in place, nothing is joined."""
    offsets = F.sequence(F.lit(0), F.lit(days - 1))
    expanded = units.withColumn("day", F.explode(offsets))
    return expanded.withColumn(out, F.date_add(F.lit(start).cast("date"), F.col("day")))


def key_audit(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Duplicate keys, null keys, orphans and fan-out of a join, from one row per key."""
    l_keys = left.groupBy(F.col(left_key).alias("k")).agg(F.count(F.lit(1)).alias("nl"))
    r_keys = right.groupBy(F.col(right_key).alias("rk")).agg(F.count(F.lit(1)).alias("nr"))
    keys = l_keys.join(r_keys, F.col("k") == F.col("rk"), "full")
    nl, nr = F.coalesce("nl", F.lit(0)), F.coalesce("nr", F.lit(0))
    return keys.agg(
        F.sum(nl).alias("rows_left"),
        F.sum(nr).alias("rows_right"),
        F.sum(nl * nr).alias("rows_joined"),
        F.count_if(nl > 1).alias("left_duplicate_keys"),
        F.count_if(nr > 1).alias("right_duplicate_keys"),
        F.sum(F.when(F.col("k").isNull() & F.col("rk").isNull(), nl).otherwise(0)).alias("left_null_keys"),
        F.sum(F.when(F.col("k").isNotNull() & F.col("rk").isNull(), nl).otherwise(0)).alias("left_orphan_rows"),
        F.sum(F.when(F.col("rk").isNotNull() & F.col("k").isNull(), nr).otherwise(0)).alias("right_unused_rows"),
    ).withColumn("fan_out", F.try_divide("rows_joined", "rows_left"))


# ---------------------------------------------------------------- aggregation

def sum_skip_null(col: str | Column) -> Column:
    """Sum over present values; 0 when all are missing."""
    return F.coalesce(F.sum(col), F.lit(0))


def observed_rollup(df: DataFrame, by: Sequence[str], sums: Sequence[str], probe: str) -> DataFrame:
    """Sums that skip nulls, with the observed count and missing share of ``probe``."""
    return df.groupBy(*by).agg(
        *[sum_skip_null(c).alias(c) for c in sums],
        F.count(probe).alias("days_observed"),
        F.avg(F.col(probe).isNull().cast("int")).alias("missing_share"),
    )


def share_of_total(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Group sum with its percentage of the overall sum, a scalar subquery; null where that sum is 0."""
    grouped = df.groupBy(*by).agg(F.sum(value).alias("total"))
    return grouped.withColumn("percentage", F.try_divide(F.col("total") * 100.0, df.agg(F.sum(value)).scalar()))


def value_counts(df: DataFrame, cols: Sequence[str], at_least: int = 1) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= at_least)


def pivot_first(df: DataFrame, keys: Sequence[str], by: str, by_values: Sequence, values: Sequence[str],
                name: str = "{value}_{by}") -> DataFrame:
    """Wide table of the first present value per cell (smallest, so that the choice is fixed)."""
    cells = [
        F.min(F.when(F.col(by) == v, F.col(c))).alias(name.format(value=c, by=v))
        for c in values for v in by_values
    ]
    return df.groupBy(*keys).agg(*cells)


def crosstab(df: DataFrame, rows: str, cols: str, levels: Sequence) -> DataFrame:
    cells = [F.count_if(F.col(cols) == v).alias(str(v)) for v in levels]
    return df.groupBy(rows).agg(*cells)


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width counts between minimum and maximum; the last bin is closed; no empty bin lost.

    The two bounds are read first, so the counting pass is one aggregation. Without a value, all bins are empty and have no edge.
    """
    lo, hi = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    if lo is None:
        return df.sparkSession.range(bins).select(
            F.col("id").cast("int").alias("bin"), F.lit(None).cast("double").alias("left_edge"), F.lit(0).cast("bigint").alias("n"))
    width = (hi - lo) / bins or 1.0
    bin_id = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(F.col(col).isNotNull()).groupBy(bin_id.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left_edge"), F.coalesce("n", F.lit(0)).alias("n")
    )


def cut(col: str | Column, edges: Sequence[float]) -> Column:
    """0-based bin of right-closed intervals; null outside them (the lowest edge is outside)."""
    x = F.col(col) if isinstance(col, str) else col
    out = F.lit(None).cast("int")
    for i, (lo, hi) in reversed(list(enumerate(zip(edges, edges[1:])))):
        out = F.when((x > lo) & (x <= hi), i).otherwise(out)
    return out


def bin_table(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str],
              aggs: Sequence[Column]) -> DataFrame:
    """Aggregates per bin, with a row for every bin."""
    spark = df.sparkSession
    frame = spark.createDataFrame(list(enumerate(labels)), "bin int, label string")
    grouped = df.withColumn("bin", cut(col, edges)).groupBy("bin").agg(*aggs)
    return frame.join(grouped, "bin", "left")


def threshold_curve(df: DataFrame, score: str, steps: int = 100) -> DataFrame:
    """Rows with score >= t for t = 0, 1/steps, ..., 1.

    One pass counts rows per step; the running total then covers ``steps + 1`` rows.
    """
    spark = df.sparkSession
    x = F.col(score)
    base = F.floor(x * steps).cast("int")
    # The product may round across an edge, so compare with the neighbouring edges themselves.
    level = F.when((base + 1) / F.lit(float(steps)) <= x, base + 1)
    level = level.when(base / F.lit(float(steps)) > x, base - 1).otherwise(base)
    level = F.least(level, F.lit(steps))
    counts = df.filter(x >= 0).groupBy(level.alias("step")).agg(F.count(F.lit(1)).alias("c"))
    grid = spark.range(steps + 1).select(F.col("id").cast("int").alias("step"))
    joined = grid.join(counts, "step", "left")
    above = W.partitionBy().orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, W.currentRow)
    return joined.select(
        (F.col("step") / float(steps)).alias("threshold"),
        F.sum(F.coalesce("c", F.lit(0))).over(above).alias("n"),
    )


def resample_quarters(df: DataFrame, date: str, by: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*by, F.year(date).alias("year"), F.quarter(date).alias("quarter")).agg(
        F.avg(value).alias(value)
    )


def citation_indices(df: DataFrame, entity: str, count: str) -> DataFrame:
    """Total and h-index per entity.

    Items with equal counts are merged before ranking: within an entity at most
    ``min(distinct counts, h + 1)`` values matter, so ordered work stays small.
    """
    merged = df.groupBy(entity, F.col(count).cast("bigint").alias("c")).agg(F.count(F.lit(1)).alias("m"))
    ranked = scalable.running_totals(merged, [entity], [F.desc("c")], {"upto": F.col("m")})
    # With `upto` items of at least c citations, min(upto, c) is the best h seen at this value.
    return ranked.groupBy(entity).agg(
        F.sum(F.col("c") * F.col("m")).alias("total_cites"),
        F.max(F.least(F.col("upto"), F.col("c"))).alias("h_index"),
    )


# ---------------------------------------------------------------- windows and order

def rank_ntile(df: DataFrame, order: Sequence, k: int, out: str, limit=None) -> DataFrame:
    """Equal-sized groups by rank (larger groups first, as ntile does)."""
    n = df.count()
    ranked = scalable.row_number_by(df, [], order, "__rn", limit)
    size, extra = divmod(n, k)
    pos = F.col("__rn") - 1
    big = extra * (size + 1)
    bucket = F.when(pos < big, F.floor(pos / (size + 1))).otherwise(
        F.floor((pos - big) / max(size, 1)) + extra
    )
    return ranked.withColumn(out, (bucket + 1).cast("int")).drop("__rn")


def value_ntile(df: DataFrame, col: str, k: int, out: str, limit=None) -> DataFrame:
    """Groups by value quantile: k - 1 cut points, right-closed; equal values stay together."""
    probs = {f"q{i}": i / k for i in range(1, k)}
    cuts = scalable.exact_quantiles(df, [], col, probs, limit).first()
    bucket = F.lit(1)
    for c in cuts:
        bucket = bucket + (F.col(col) > F.lit(c)).cast("int")
    return df.withColumn(out, bucket)


def top_k_per_group(df: DataFrame, by: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """First k rows per group; Spark keeps k per group before the shuffle as well as after it."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def growth(df: DataFrame, by: Sequence[str], order: Sequence, value: str, k: int, out: str) -> DataFrame:
    """value / value k rows earlier - 1; infinite after 0, not a number from 0 to 0."""
    prior = scalable.lagged(df, by, order, value, k, "__prior")
    return prior.withColumn(out, float_divide(F.col(value), F.col("__prior")) - 1).drop("__prior")


# ---------------------------------------------------------------- random selection and splits

def exact_sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """Exactly n rows, the ones with the lowest hash of their key."""
    hashed = df.withColumn("__h", hash48(seed, key))
    return scalable.lowest_by_hash(hashed, "__h", F.least(F.lit(n), F.col("group_n")), tie=[key]).drop("__h")


def random_split(df: DataFrame, key: str, shares: Mapping[str, float], seed: str, out="split") -> DataFrame:
    """Exact shares by hash rank: the first floor(share * n) rows of the hash order, and so on.

    Hash buckets of equal expected size, about the square root of the rows many, are ranked separately and
    shifted by the bucket totals.
    """
    bits = scalable.hash_buckets(df.count()).bit_length() - 1
    hashed = df.withColumn("__h", hash48(seed, key))
    hashed = hashed.withColumn("__b", F.shiftright("__h", 48 - bits).cast("bigint"))
    sizes = hashed.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    earlier = W.partitionBy().orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__b", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
                           F.sum("__n").over(W.partitionBy()).alias("__total"))
    local = F.row_number().over(W.partitionBy("__b").orderBy("__h", key))
    ranked = hashed.withColumn("__r", local).join(offsets, "__b")
    rank = F.col("__r") + F.col("__before")
    names, label, upto = list(shares), F.lit(None).cast("string"), 0.0
    edges = []
    for name in names[:-1]:
        upto += shares[name]
        edges.append((name, F.floor(F.lit(round(upto, 12)) * F.col("__total"))))
    label = F.lit(names[-1])
    for name, edge in reversed(edges):
        label = F.when(rank <= edge, F.lit(name)).otherwise(label)
    return ranked.withColumn(out, label).drop("__h", "__b", "__r", "__before", "__total")


def time_split(df: DataFrame, date: str, cut_at: str, out="split") -> DataFrame:
    return df.withColumn(out, F.when(F.col(date) < F.lit(cut_at).cast("timestamp_ntz"), "train").otherwise("test"))


def union_dedupe(frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Stack frames and keep the first row per key."""
    from civicframe.operators.prep import first_per_key

    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return first_per_key(out, keys, order)
