"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicframe.functions.hashing import hash_unit
from civicframe.llm.common import WORD_PATTERN, pick
from civicframe.session import materialise

#: Rows that one boundary bucket may have before it is ranked instead of refined.
RANKED_ROWS = 10_000
DIGIT_BITS, KEY_BITS = 12, 48


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = 3) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources in code-point order, null last, have the weights in turn and share the total by weight. No
    target exceeds ``limit`` times its source; the excess goes to the others by weight until none is above. Each
    round of that is one aggregate; the sources themselves stay distributed.
    """
    sources = materialise(_numbered(sizes, "source").select("source", "source_size", F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("bigint").alias("weight")))
    most = F.col("source_size") * limit
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, F.lit(False)
    while True:
        spent, rest = sources.agg(F.sum(F.when(capped, most).otherwise(0)), F.sum(F.when(capped, 0).otherwise(F.col("weight")))).first()
        new = (total - spent) / rest if rest else level
        if new <= level:
            break
        level = new
        capped = F.col("weight") * F.lit(level) > most
    return sources.select("source", "source_size", F.when(
        capped, most.cast("double")).otherwise(F.col("weight") * F.lit(level)).alias("target"))


def _numbered(rows: DataFrame, by: str) -> DataFrame:
    """0-based ``place`` of each row in the order of ``by``, null last: slices are sorted, then offset by the counts before."""
    sliced = materialise(rows.repartitionByRange(F.asc_nulls_last(by)).withColumn("slice", F.spark_partition_id()))
    inside = F.row_number().over(Window.partitionBy("slice").orderBy(F.asc_nulls_last(by))) - 1
    sizes = sliced.groupBy("slice").count()
    earlier = Window.partitionBy().orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per shuffle partition
    offsets = sizes.select("slice", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    placed = sliced.withColumn("inside", inside).join(offsets, "slice")
    return placed.select(*rows.columns, (F.col("inside") + F.col("before")).cast("bigint").alias("place"))


def pareto_key(uniform: Column, inclusion: Column) -> Column:
    """Order key in [0, 2**48] of Pareto sampling: the odds of a uniform number over the odds of inclusion.

    The ratio q is kept as q / (1 + q), which has its order and lies between 0 and 1. Rows that cannot be
    included (odds 0) have a null key.
    """
    q = (uniform / (1 - uniform)) / (inclusion / (1 - inclusion))
    return F.when(inclusion > 0, F.floor((q / (1 + q)) * F.lit(float(1 << KEY_BITS))).cast("bigint"))


def lowest_until(rows: DataFrame, group: str, key: str, size: str, budget: DataFrame, tie: tuple[str, ...]) -> DataFrame:
    """(*tie, taken) of the rows with the lowest keys of each group whose sizes add up to the group's budget.

    The row at the cut is in if that comes closer to the budget. ``budget`` has one row per group: (group, budget).
    The cut is located by histograms of the key, twelve bits at a time, over the rows that share the group's prefix
    so far; when no such bucket has more than RANKED_ROWS rows, or the bits end, its rows are ranked. Groups of any
    size are spread over all tasks.
    """
    rows = rows.select(F.col(group).alias("in_group"), F.col(key).alias("in_key"), F.col(size).alias("in_size"), F.struct(*tie).alias("tie"))
    state = materialise(budget.select(F.col(group).alias("of"), F.lit(0).cast("bigint").alias("prefix"), F.col("budget").alias("left")))
    shift = KEY_BITS + DIGIT_BITS  # keys up to 2**48 included: the first digit has one value more
    while True:
        here = F.expr(f"shiftright(in_key, {shift})")
        at = rows.join(state, F.col("in_group").eqNullSafe(F.col("of")) & (here == F.col("prefix")))
        largest = at.groupBy("of").count().agg(F.max("count")).first()[0] or 0
        if largest <= RANKED_ROWS or shift == 0:
            break
        shift -= DIGIT_BITS
        bins = at.groupBy("of", "left", F.expr(f"shiftright(in_key, {shift})").alias("bin")).agg(F.sum("in_size").alias("s"))
        group_of = Window.partitionBy("of")
        cut = bins.withColumns({"upto": F.sum("s").over(group_of.orderBy("bin")), "every": F.sum("s").over(group_of)}).where(
            "upto >= left or upto = every")
        first = cut.groupBy("of").agg(F.min(F.struct("bin", (F.col("left") - F.col("upto") + F.col("s")).alias("left"))).alias("m"))
        state = materialise(first.select("of", F.col("m.bin").alias("prefix"), F.col("m.left").alias("left")))
    joined = rows.join(state, F.col("in_group").eqNullSafe(F.col("of")))
    below = joined.where(here < F.col("prefix")).select("tie.*")
    order = Window.partitionBy("of").orderBy("in_key", "tie")
    upto = F.sum("in_size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    at_cut = joined.where(here == F.col("prefix")).withColumn("upto", upto).where("2 * upto - in_size <= 2 * left").select("tie.*")
    return below.unionByName(at_cut)


def plan_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights: tuple[int, ...] = (1, 2, 3), limit: int = 3, seed: str = "mix", odds: str | None = None) -> DataFrame:
    """How often the mix takes each row: doc_id, row, size, source_size, target, copies, taken.

    Every document of a source is taken floor(target / source_size) times. One more copy goes to a Pareto
    sample with the fraction as inclusion probability, cut where its words reach the rest of the target; the document
    at the cut is in if that comes closer. The uniform number is a hash of (seed, doc_id, md5 of the text), so reruns and other
    partitionings agree. Equal rows are told apart by their place in the input. Size is the number of words; null and empty
    texts have size 0 and taken 0. The null source is a source. An empty table gives an empty table.

    Without ``odds`` the documents of a source have one inclusion probability, and the order of the sample is that of the uniform
    numbers. ``odds`` names a column of positive numbers: a document's probability is then in proportion to its number, scaled
    so that the source's expected words stay the same, and clipped below 1. Null and other numbers count as 0: such a document gets
    whole copies only.
    """
    extra = {"odds": odds} if odds else {}
    narrow = pick(docs, doc_id=doc_id, source=source, text=text, **extra).select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint").alias("size"),
        hash_unit(seed, "doc_id", F.md5(F.col("text").cast("binary"))).alias("u"), F.monotonically_increasing_id().alias("row"),
        *[F.when(F.col(c) > 0, F.col(c).cast("double")).otherwise(0.0).alias(c) for c in extra])
    return _taken(materialise(narrow), weights, limit)


#: The largest inclusion probability of a document whose odds would give more.
MOST_LIKELY = 1 - 1e-6


def _inclusion(rows: DataFrame) -> DataFrame:
    """Add ``chance``: the fraction of the source, or in proportion to the odds with the fraction as its mean over the words."""
    if "odds" not in rows.columns:
        return rows.withColumn("chance", F.col("fraction"))
    means = rows.groupBy(F.col("source").alias("of")).agg(
        F.try_divide(F.sum(F.col("odds") * F.col("size")), F.sum("size")).alias("mean"))
    scaled = F.col("fraction") * F.try_divide(F.col("odds"), F.col("mean"))
    return rows.join(means, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "chance", F.coalesce(F.least(scaled, F.lit(MOST_LIKELY)), F.lit(0.0))).drop("of", "mean")


def _taken(rows: DataFrame, weights, limit) -> DataFrame:
    """Add target and copies to (row, source, size, u) rows."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = materialise(targets(totals, weights, limit).withColumn("ratio", ratio).select(
        F.col("source").alias("of"), "source_size", "target", F.floor("ratio").cast("bigint").alias("whole"),
        (F.col("ratio") - F.floor("ratio")).alias("fraction")))
    all_rows = rows.join(plan, rows["source"].eqNullSafe(plan["of"])).drop("of")
    candidates = materialise(_inclusion(all_rows.where((F.col("fraction") > 0) & (F.col("size") > 0))).where("chance > 0").select(
        "source", "size", "row", pareto_key(F.col("u"), F.col("chance")).alias("key")))
    budget = plan.where("fraction > 0").select(
        F.col("of").alias("source"), (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"))
    extra = lowest_until(candidates, "source", "key", "size", budget, ("row",)).withColumn("extra", F.lit(1))
    copies = F.col("whole") + F.coalesce("extra", F.lit(0))
    return all_rows.join(extra, "row", "left").select(
        "row", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                  weights: tuple[int, ...] = (1, 2, 3), limit: int = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as :func:`plan_mix` says, with the columns of ``docs``.

    Documents without words have nothing to give and appear as often as their source's whole copies.
    """
    names = list(docs.columns)
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("row", F.monotonically_increasing_id())
    staged = materialise(inner)
    at = {n: F.col(f"c{i}") for i, n in enumerate(names)}
    narrow = staged.select(
        at[doc_id].alias("doc_id"), at[source].alias("source"),
        F.coalesce(F.regexp_count(at[text], F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint").alias("size"),
        hash_unit(seed, at[doc_id], F.md5(at[text].cast("binary"))).alias("u"), "row")
    copies = _taken(materialise(narrow), weights, limit).where("copies > 0").select("row", "copies")
    many = staged.join(copies, "row").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return many.select(*inner.columns[:-1]).toDF(*names)
