"""Ordered computations that stay correct and spread out when one group holds most rows.

A plain window sorts each group inside one task. Every function here first counts the largest
group; up to ``GROUP_ROWS`` it uses the plain window, beyond that it range-partitions the rows on
(group, order) so that a large group spans many tasks, works inside each slice, and adds the totals
of the earlier slices, of which there are at most as many as shuffle partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicframe.functions.hashing import HASH_SPACE
from civicframe.session import materialise, shuffle_width

GROUP_ROWS = 1_000_000
BOUNDED = float("inf")  # as a limit: the caller knows a bound (a calendar, a grid), nothing is counted
SLICE = "__slice"


def largest_group(df: DataFrame, by: Sequence[str]) -> int:
    """Rows in the largest group: one aggregation with map-side partial counts."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def small_groups(df: DataFrame, by: Sequence[str], limit: float | None) -> bool:
    """Whether no group exceeds the limit; counted only when the caller knows no bound."""
    if limit == BOUNDED:
        return True
    return largest_group(df, by) <= (GROUP_ROWS if limit is None else limit)


def _ordering(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def sliced(df: DataFrame, by: Sequence[str], order: Sequence) -> DataFrame:
    """Range-partition on (by, order), number the slices, and pin them in a written table."""
    keys = [F.col(b) for b in by] + _ordering(order)
    spread = df.repartitionByRange(shuffle_width(df.sparkSession), *keys)
    return materialise(spread.withColumn(SLICE, F.spark_partition_id()))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"):
    """Equi-join that also matches null keys; the keys of the left side are kept."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    if not keys:
        raise ValueError("a join needs at least one key")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def row_number_by(df, by, order, out="rn", limit=None) -> DataFrame:
    """1-based position of each row in its group under a total order."""
    if small_groups(df, by, limit):
        frame = W.partitionBy(*by).orderBy(*_ordering(order))
        return df.withColumn(out, F.row_number().over(frame).cast("bigint"))
    rows = sliced(df, by, order)
    keys = [*by, SLICE]
    local = rows.withColumn(
        "__local", F.row_number().over(W.partitionBy(*keys).orderBy(*_ordering(order)))
    )
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    earlier = W.partitionBy(*by).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*keys, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    joined = null_safe_join(local, offsets, keys)
    position = F.col("__local") + F.col("__before")
    return joined.withColumn(out, position).drop("__local", "__before", SLICE)


_COMBINE = {
    "sum": (F.sum, lambda a, b: a + b),
    "min": (F.min, lambda a, b: F.least(a, b)),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
}


def running_totals(df, by, order, sums: dict[str, Column], inclusive=True, limit=None, how="sum"):
    """Running sums (or minima, maxima) under a total order, up to the current row or the one before."""
    end = W.currentRow if inclusive else -1
    reduce_fn, combine = _COMBINE[how]
    if small_groups(df, by, limit):
        frame = W.partitionBy(*by).orderBy(*_ordering(order)).rowsBetween(W.unboundedPreceding, end)
        return df.withColumns({k: reduce_fn(v).over(frame) for k, v in sums.items()})
    rows = sliced(df, by, order)
    keys = [*by, SLICE]
    frame = W.partitionBy(*keys).orderBy(*_ordering(order)).rowsBetween(W.unboundedPreceding, end)
    local = rows.withColumns({f"__{k}": reduce_fn(v).over(frame) for k, v in sums.items()})
    totals = rows.groupBy(*keys).agg(*[reduce_fn(v).alias(f"__t_{k}") for k, v in sums.items()])
    earlier = W.partitionBy(*by).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[reduce_fn(f"__t_{k}").over(earlier).alias(f"__o_{k}") for k in sums]
    )
    joined = null_safe_join(local, offsets, keys)
    for k in sums:
        here, before = F.col(f"__{k}"), F.col(f"__o_{k}")
        both = F.when(here.isNotNull() & before.isNotNull(), combine(here, before))
        joined = joined.withColumn(k, F.coalesce(both, here, before))
    drop = [f"__{k}" for k in sums] + [f"__o_{k}" for k in sums]
    return joined.drop(*drop, SLICE)


def running_sum_with_peers(df, by, order: Sequence[str], value: str, out: str, limit=None):
    """Running sum in which rows with equal order values share one total (the RANGE frame).

    Peers are summed first, so the ordered step sees one row per (group, order value). When the
    order is a calendar date that is a few thousand rows per group: pass ``limit=BOUNDED``.
    """
    peers = df.groupBy(*by, *order).agg(F.sum(value).alias("__peer"))
    totals = running_totals(peers, by, order, {out: F.col("__peer")}, limit=limit).drop("__peer")
    return null_safe_join(df, totals, [*by, *order], "left")


def _with_halo(df, by, order, back: int, ahead: int, chunk: int) -> DataFrame:
    """Cut each group into chunks of ``chunk`` rows. The last ``back`` rows of a chunk are also given
    to the next one and its first ``ahead`` rows to the one before, so frames are complete inside."""
    if max(back, ahead) > chunk:
        raise ValueError("the frame is longer than a chunk")
    ranked = row_number_by(df, by, order, out="__rn", limit=0)
    pos = F.col("__rn") - 1
    home = F.floor(pos / chunk)
    targets = F.array_compact(F.array(
        home,
        F.when((pos % chunk) >= chunk - back, home + 1),
        F.when((pos % chunk) < ahead, home - 1),
    ))
    return ranked.withColumn("__home", home).withColumn("__chunk", F.explode(targets))


def over_near_rows(df, by, order, back: int, make, limit=None, chunk=None, ahead: int = 0):
    """Evaluate window columns that look at most ``back`` rows back and ``ahead`` rows on.

    ``make(window)`` returns the named columns for a window that is partitioned and ordered.
    """
    if small_groups(df, by, limit):
        return df.withColumns(make(W.partitionBy(*by).orderBy(*_ordering(order))))
    size = chunk or max(100_000, back, ahead)
    halo = _with_halo(df, by, order, back, ahead, size)
    done = halo.withColumns(make(W.partitionBy(*by, "__chunk").orderBy("__rn")))
    return done.filter(F.col("__chunk") == F.col("__home")).drop("__rn", "__home", "__chunk")


def moving_average(df, by, order, value: str, rows: int, out: str, limit=None, chunk=None):
    """Mean of the current and the ``rows - 1`` preceding rows."""
    def make(w):
        return {out: F.avg(value).over(w.rowsBetween(-(rows - 1), 0))}

    return over_near_rows(df, by, order, rows - 1, make, limit, chunk)


def lagged(df, by, order, value: str, k: int, out: str, limit=None, chunk=None):
    """The value ``k`` rows earlier in the group."""
    def make(w):
        return {out: F.lag(value, k).over(w)}

    return over_near_rows(df, by, order, k, make, limit, chunk)


def exact_quantiles(df, by, value: str, probs: dict[str, float], limit=None) -> DataFrame:
    """Linearly interpolated quantiles per group; one named column per probability.

    Equal values are counted before the shuffle. When a group still has too many distinct values
    for one task, positions come from running totals of those counts.
    """
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__c"))
    )
    if small_groups(counted, by, limit):
        array = F.percentile("__v", [float(p) for p in probs.values()], F.col("__c"))
        picked = counted.groupBy(*by).agg(array.alias("__q"))
        return picked.select(*by, *[F.col("__q")[i].alias(k) for i, k in enumerate(probs)])
    totals = running_totals(counted, by, ["__v"], {"__upto": F.col("__c")}, limit=0)
    n = counted.groupBy(*by).agg(F.sum("__c").alias("__n"))
    if by:
        located = null_safe_join(totals, n, by)
    else:
        located = totals.withColumn("__n", F.lit(n.first()[0]))
    before = F.col("__upto") - F.col("__c")
    aggs = []
    for i, p in enumerate(probs.values()):
        at = F.lit(float(p)) * (F.col("__n") - 1)
        for side, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = (before <= pos) & (pos < F.col("__upto"))
            aggs.append(F.max(F.when(hit, F.col("__v"))).alias(f"__{side}{i}"))
        aggs.append(F.max(at - F.floor(at)).alias(f"__w{i}"))
    ends = located.groupBy(*by).agg(*aggs)
    mixed = [
        (F.col(f"__lo{i}") + F.col(f"__w{i}") * (F.col(f"__hi{i}") - F.col(f"__lo{i}"))).alias(k)
        for i, k in enumerate(probs)
    ]
    return ends.select(*by, *mixed)


def hash_buckets(rows_per_group: float) -> int:
    """About the square root of the rows: it balances the histogram against the rows ranked in the bucket of the cut."""
    return 1 << min(max(int(math.log2(max(rows_per_group, 1.0)) / 2), 2), 40)


def flag_lowest_by_hash(df, hashed: str, take: Column, out: str, by=(), tie=(), carry=(),
                        buckets: int | None = None) -> DataFrame:
    """Per group, flag exactly the ``take`` rows with the smallest hash.

    ``take`` may use ``group_n`` and the ``carry`` columns, which are constant inside a group.
    Hashes are uniform, so a histogram finds the bucket in which the cut falls: rows outside it are
    flagged by a comparison, only the rows of that one bucket are ranked. No group is sorted whole. The number of
    buckets follows the number of rows unless it is given.
    """
    buckets = buckets or hash_buckets(df.count())
    by, names = list(by), df.columns
    width = HASH_SPACE // buckets
    rows = df.withColumn("__b", F.floor(F.col(hashed) / F.lit(width)).cast("bigint"))
    constants = [F.max(c).alias(c) for c in carry]
    hist = rows.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__c"), *constants)
    upto = W.partitionBy(*by).orderBy("__b").rowsBetween(W.unboundedPreceding, W.currentRow)
    cut = (
        hist.withColumn("__upto", F.sum("__c").over(upto))
        .withColumn("group_n", F.sum("__c").over(W.partitionBy(*by)))
        .withColumn("__take", take.cast("bigint"))
        .filter((F.col("__upto") >= F.col("__take"))
                & (F.col("__upto") - F.col("__c") < F.col("__take")))
        .select(*by, F.col("__b").alias("__edge"),
                (F.col("__take") - F.col("__upto") + F.col("__c")).alias("__need"))
    )
    if by:
        joined = null_safe_join(rows, cut, by, "left")
    else:
        edge, need = cut.select("__edge", "__need").first() or (-1, 0)
        joined = rows.withColumns({"__edge": F.lit(edge), "__need": F.lit(need)})
    at_edge = F.coalesce(F.col("__b") == F.col("__edge"), F.lit(False))
    clear = joined.filter(~at_edge).withColumn(
        out, F.coalesce(F.col("__b") < F.col("__edge"), F.lit(False)))
    rank = F.row_number().over(W.partitionBy(*by).orderBy(hashed, *tie))
    close = joined.filter(at_edge).withColumn(out, rank <= F.col("__need"))
    return clear.unionByName(close).select(*names, out)


def lowest_by_hash(df, hashed: str, take: Column, by=(), tie=(), buckets: int | None = None) -> DataFrame:
    """Per group, exactly the ``take`` rows with the smallest hash."""
    flagged = flag_lowest_by_hash(df, hashed, take, "__low", by, tie, buckets=buckets)
    return flagged.filter("__low").drop("__low")


def _chunks(df: DataFrame, keys: Sequence[str], rows_per_chunk: int, out: str) -> DataFrame:
    """Per key with more than ``rows_per_chunk`` rows, into how many chunks its rows are dealt."""
    n = F.count(F.lit(1))
    return df.groupBy(*keys).agg(n.alias("__n")).filter(F.col("__n") > rows_per_chunk).select(
        *keys, F.ceil(F.col("__n") / rows_per_chunk).cast("int").alias(out))


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_salt=20_000):
    """Inner equi-join that splits keys with many rows on either side.

    The rows of a hot key are dealt into chunks on each side by a hash, and every chunk of one side meets
    every chunk of the other, so no task sees more than ``rows_per_salt`` rows of a key from either side. A row is copied
    once per chunk of its key on the other side. The tables of hot keys have at most ``rows / rows_per_salt`` rows.
    """
    l2, r2, on = salted(left, right, keys, rows_per_salt)
    return l2.join(r2, on).drop(*on[len(keys):])


def salted(left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_salt=20_000) -> tuple[DataFrame, DataFrame, list[str]]:
    """The sides of :func:`salted_join`, and the columns on which they meet."""
    hot_l = _chunks(left, keys, rows_per_salt, "__cl")
    hot_r = _chunks(right, keys, rows_per_salt, "__cr")
    cells = materialise(hot_l.join(hot_r, list(keys), "full"))
    if cells.isEmpty():  # no key has many rows
        return left, right, list(keys)

    def dealt(df: DataFrame, own: str, own_cell: str, other: str, other_cell: str) -> DataFrame:
        row_hash = F.abs(F.xxhash64(*[F.col(c) for c in df.columns]) % F.lit(1 << 30))
        mine, theirs = F.coalesce(F.col(own), F.lit(1)), F.coalesce(F.col(other), F.lit(1))
        return df.join(cells, list(keys), "left").withColumns({
            own_cell: (row_hash % mine).cast("int"), other_cell: F.explode(F.sequence(F.lit(0), theirs - 1))}).drop("__cl", "__cr")

    l2, r2 = dealt(left, "__cl", "__i", "__cr", "__j"), dealt(right, "__cr", "__j", "__cl", "__i")
    return l2, r2, [*keys, "__i", "__j"]


def dealt_out(left: DataFrame, right: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides shuffled by ``on`` into all shuffle partitions, however few their rows are.

    For rows that make many more pairs: a broadcast join would leave these to the tasks that read the rows, and small shuffles
    are put together into few tasks.
    """
    n = shuffle_width(left.sparkSession)
    return left.repartition(n, *on), right.repartition(n, *on).hint("merge")


def chunked_by_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], pairs_per_chunk=2_000_000) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides and the columns to join on, whatever the kind of join that keeps each left row once.

    The left rows of a key are dealt into chunks of about ``pairs_per_chunk`` joined rows, the right rows of the key
    are copied to each of them.
    """
    n_l = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__nl"))
    n_r = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__nr"))
    chunks = F.least(F.ceil(F.col("__nl") * F.col("__nr") / pairs_per_chunk), F.col("__nl")).cast("int")
    hot = materialise(n_l.join(n_r, list(keys)).select(*keys, chunks.alias("__chunks")).filter("__chunks > 1"))
    if hot.isEmpty():
        return left, right, list(keys)
    many = F.coalesce("__chunks", F.lit(1))
    l2 = left.join(hot, list(keys), "left").withColumn("__chunk", F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), many).cast("int"))
    r2 = right.join(hot, list(keys), "left").withColumn("__chunk", F.explode(F.sequence(F.lit(0), many - 1)))
    return l2.drop("__chunks"), r2.drop("__chunks"), [*keys, "__chunk"]


def chunked(left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_chunk=20_000) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``__chunk`` to join on beside the keys, whatever the kind of join.

    The left rows of a hot key are dealt into chunks by a hash; the right rows of the key are copied to each of them. A
    left row has one chunk, so a left outer join stays one.
    """
    hot = _chunks(left, keys, rows_per_chunk, "__n_chunks")
    row_hash = F.abs(F.xxhash64(*[F.col(c) for c in left.columns]) % F.lit(1 << 30))
    many = F.coalesce(F.col("__n_chunks"), F.lit(1))
    l2 = left.join(hot, list(keys), "left").withColumn("__chunk", (row_hash % many).cast("int")).drop("__n_chunks")
    r2 = right.join(hot, list(keys), "left").withColumn("__chunk", F.explode(F.sequence(F.lit(0), many - 1))).drop("__n_chunks")
    return l2, r2
