"""Assignment, balance, treatment effects, placebo and permutation tests."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicframe.functions.distributions import normal_quantile, normal_two_sided
from civicframe.functions.division import float_divide
from civicframe.functions.hashing import hash48, hash48_second, hash_normal, hash_unit, replicate_hash
from civicframe.operators import regression as reg
from civicframe.operators import replicates as rep
from civicframe.operators import scalable
from civicframe.session import materialise


# ---------------------------------------------------------------- assignment

def assign(df: DataFrame, key: str, seed: str, p: float = 0.5, out="treat") -> DataFrame:
    """Independent assignment by the hash of the unit: the same unit always gets the same arm."""
    return df.withColumn(out, (hash_unit(seed, key) < p).cast("int"))


def assign_blocked(df: DataFrame, key: str, block: str, seed: str, out="treat") -> DataFrame:
    """Half of each block (rounded down) is treated: the half with the lower hashes."""
    hashed = df.withColumn("__h", hash48(seed, key))
    flagged = scalable.flag_lowest_by_hash(
        hashed, "__h", F.floor(F.col("group_n") / 2), "__low", [block], [key])
    return flagged.withColumn(out, F.col("__low").cast("int")).drop("__h", "__low")


# ---------------------------------------------------------------- effects and balance

def _arm(cond: Column, col: str) -> Column:
    return F.when(cond, F.col(col).cast("double"))


def ate(df: DataFrame, treat: str, outcomes: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Difference in means per outcome with its unpooled standard error, in one pass."""
    one, zero = F.col(treat) == 1, F.col(treat) == 0
    aggs = []
    for y in outcomes:
        a, b = _arm(one, y), _arm(zero, y)
        aggs.append(F.struct(
            F.lit(y).alias("outcome"), F.count(a).alias("n1"), F.count(b).alias("n0"),
            F.avg(a).alias("mean1"), F.avg(b).alias("mean0"),
            F.var_samp(a).alias("var1"), F.var_samp(b).alias("var0")).alias(y))
    wide = df.groupBy(*by).agg(*aggs)
    long = wide.select(*by, F.inline(F.array(*[F.col(y) for y in outcomes])))
    return long.withColumns({
        "effect": F.col("mean1") - F.col("mean0"),
        "std_error": F.sqrt(F.col("var1") / F.col("n1") + F.col("var0") / F.col("n0")),
    })


def smd(df: DataFrame, treat: str, covariates: Sequence[str]) -> DataFrame:
    """Standardised mean differences."""
    rows = ate(df, treat, covariates)
    pooled = F.sqrt((F.col("var1") + F.col("var0")) / 2)
    return rows.select(F.col("outcome").alias("covariate"), "mean1", "mean0",
                       float_divide(F.col("effect"), pooled).alias("smd"))


def subgroup_effects(df: DataFrame, treat: str, outcome: str, group: str) -> DataFrame:
    """Effect per subgroup with its share of the units."""
    rows = ate(df, treat, [outcome], [group])
    n = F.col("n1") + F.col("n0")
    return rows.withColumn("weight", F.try_divide(n, rows.agg(F.sum(n)).scalar()))


def weighted_effect(groups: DataFrame) -> DataFrame:
    """Subgroup effects averaged with their weights."""
    return groups.agg(
        F.sum(F.col("effect") * F.col("weight")).alias("effect"),
        F.sqrt(F.sum(F.pow("std_error", 2) * F.pow("weight", 2))).alias("std_error"))


def wald(df: DataFrame, instrument: str, takeup: str, outcome: str) -> DataFrame:
    """Effect of assignment, effect on take-up, and their ratio."""
    rows = ate(df, instrument, [outcome, takeup])
    itt = F.max(F.when(F.col("outcome") == outcome, F.col("effect")))
    first = F.max(F.when(F.col("outcome") == takeup, F.col("effect")))
    return rows.agg(itt.alias("itt"), first.alias("first_stage"), float_divide(itt, first).alias("tot"))


def two_stage(df: DataFrame, instrument: str, takeup: str, outcome: str, controls: reg.Terms) -> DataFrame:
    """Two-stage least squares with one instrument: fitted take-up replaces take-up.

    Estimates only: the standard errors of the second regression would be those of the fitted value.
    """
    first = {instrument: F.col(instrument), **controls}
    stage1 = reg.coefficients(df, takeup, first)
    second = reg.ols(df, outcome, {takeup: reg.linear_predictor(stage1, first), **controls})
    return second.select("term", "estimate", "n")


def minimum_detectable(df: DataFrame, treat: str, outcomes: Sequence[str], alpha=0.05, power=0.8) -> DataFrame:
    z = normal_quantile(1 - alpha / 2) + normal_quantile(power)
    return ate(df, treat, outcomes).select("outcome", "n1", "n0", (F.lit(z) * F.col("std_error")).alias("mde"))


def cluster_exposure(df: DataFrame, cluster: str, treat: str) -> DataFrame:
    """Share treated in the unit's cluster, with and without the unit itself.

    Clusters are counted first and joined back, so a large cluster is never gathered in one task.
    """
    totals = df.groupBy(cluster).agg(F.sum(treat).alias("__t"), F.count(F.lit(1)).alias("__n"))
    rows = df.join(totals, cluster)
    others = F.when(F.col("__n") > 1, (F.col("__t") - F.col(treat)) / (F.col("__n") - 1))
    return rows.withColumns({"share_treated": F.col("__t") / F.col("__n"), "share_others": others}).drop("__t", "__n")


# ---------------------------------------------------------------- p-values

def with_p_values(df: DataFrame, stat: str, out: str = "p_value") -> DataFrame:
    """Two-sided normal p-value of a statistic column of an aggregated table."""

    def tail(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(**{out: [
                None if z is None or z != z else normal_two_sided(z) for z in batch[stat]]})

    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    return df.mapInPandas(tail, f"{schema}, `{out}` double")


def bh_adjust(df: DataFrame, p: str, out: str = "p_adjusted", tie: Sequence[str] = (), limit=None) -> DataFrame:
    """Benjamini-Hochberg: p * m / rank, made monotone from the largest p down, at most 1."""
    m = df.filter(F.col(p).isNotNull()).count()
    ranked = scalable.row_number_by(df.filter(F.col(p).isNotNull()), [], [p, *tie], "__rank", limit)
    raw = ranked.withColumn("__raw", F.col(p) * F.lit(float(m)) / F.col("__rank"))
    order = [F.desc("__rank")]
    done = scalable.running_totals(raw, [], order, {out: F.col("__raw")}, limit=limit, how="min")
    return done.withColumn(out, F.least(F.col(out), F.lit(1.0))).drop("__rank", "__raw")


def many_outcomes(df: DataFrame, treat: str, outcomes: Sequence[str], q: float = 0.05) -> DataFrame:
    rows = ate(df, treat, outcomes).withColumn("z", float_divide(F.col("effect"), F.col("std_error")))
    slim = rows.select("outcome", "effect", "std_error", "z")
    adjusted = bh_adjust(with_p_values(slim, "z"), "p_value", tie=["outcome"])
    return adjusted.withColumn("significant", F.col("p_adjusted") <= q)


# ---------------------------------------------------------------- replicates

def replicates(df: DataFrame, key: str, reps: int, seed: str) -> DataFrame:
    """Every row once per replicate (1..reps) with a hash per (row, replicate).

    Rows are expanded in place and summed on the map side; one digest serves all replicates.
    """
    digest = df.withColumns({"__h1": hash48(seed, key), "__h2": hash48_second(seed, key)})
    spread = digest.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(reps))))
    hashed = replicate_hash(F.col("__h1"), F.col("__h2"), F.col("rep").cast("bigint"))
    return spread.withColumn("__h", hashed).drop("__h1", "__h2")


def _blocks(df: DataFrame, within: Sequence[str], take: Column, reps: int):
    """(rows with ``__block``, rows to take and size of each block); None if the cuts are more than the driver should hold."""
    counts = df.groupBy(*within).agg(take.cast("bigint").alias("__take"), F.count(F.lit(1)).alias("__n"))
    if not within:
        r = counts.first()
        return df.withColumn("__block", F.lit(0)), np.array([r["__take"] or 0]), np.array([r["__n"]])
    most = rep.MOST_CUTS // reps
    counts = materialise(counts)
    if counts.count() > most:
        return None
    order = W.partitionBy().orderBy(*within)  # at most MOST_CUTS rows
    numbered = materialise(counts.withColumn("__block", F.row_number().over(order) - 1))
    found = sorted((r["__block"], r["__take"] or 0, r["__n"]) for r in numbered.collect())
    rows = scalable.null_safe_join(df, numbered.drop("__take", "__n"), list(within))
    return rows, np.array([f[1] for f in found], np.int64), np.array([f[2] for f in found], np.int64)


def _difference(drawn: DataFrame, n: int, total: float, out: str) -> DataFrame:
    """Mean of the drawn rows less that of the others, from the count and the sum of each."""
    n1, s1 = F.col("s")[0], F.col("s")[1]
    return drawn.select("rep", (F.try_divide(s1, n1) - F.try_divide(F.lit(total) - s1, F.lit(float(n)) - n1)).alias(out))


def aa_test(df: DataFrame, key: str, outcome: str, reps: int, seed: str) -> DataFrame:
    """Effect of ``reps`` random half splits: exactly floor(n / 2) units in the first half of each.

    The table is read a few times in all; no row is copied for a replicate.
    """
    y = F.col(outcome).cast("double")
    n_all, n, mean = df.agg(F.count(F.lit(1)), F.count(y), F.avg(y)).first()
    kept = F.coalesce(y - F.lit(mean or 0.0), F.lit(0.0))
    total = df.agg(F.sum(kept)).first()[0] or 0.0
    rows = rep.prepared(df, key, seed, [y.isNotNull(), kept])
    drawn = rep.sums_of_lowest(rows, np.array([n_all // 2]), np.array([n_all]), reps, 2)
    return _difference(drawn, n, total, "aa_effect")


def permutations(df: DataFrame, key: str, treat: str, reps: int, seed: str, within: Sequence[str] = ()) -> DataFrame:
    """Treatment labels redrawn ``reps`` times; the number treated stays fixed (in each block)."""
    n1 = df.groupBy(*within).agg(F.sum(treat).cast("bigint").alias("__n1"), F.count(F.lit(1)).alias("__n"))
    typical = n1.agg(F.avg("__n")).first()[0] or 1.0
    if within:
        rows = scalable.null_safe_join(df, n1.drop("__n"), list(within))
    else:
        rows = df.withColumn("__n1", F.lit(n1.first()["__n1"]))
    spread = replicates(rows, key, reps, seed)
    flagged = scalable.flag_lowest_by_hash(
        spread, "__h", F.col("__n1"), "__d", ["rep", *within], [key], carry=["__n1"],
        buckets=scalable.hash_buckets(typical))
    return flagged.withColumn("d_perm", F.col("__d").cast("int")).drop("__d", "__n1", "__h")


def permutation_effects(df, key, y, treat, reps, seed, within=(), controls: Sequence[str] = ()) -> DataFrame:
    """Null distribution of the effect: difference in means, or the coefficient next to controls.

    The treated of each replicate only add to its sums; what does not depend on them is summed once. With so many
    blocks that their cuts exceed ``replicates.MOST_CUTS``, rows are expanded instead (:func:`permutations`).
    """
    slim = df.select(key, y, treat, *within, *[c for c in controls if c not in within])
    placed = _blocks(slim, within, F.sum(treat), reps)
    if placed is None:
        return _expanded_effects(slim, key, y, treat, reps, seed, within, controls)
    rows, take, sizes = placed
    names = [*controls, y]
    whole = reg.moments(slim, y, {c: F.col(c) for c in controls}).first()
    n, means = whole["n"], whole["means"]
    valid = F.lit(True)
    for c in names:
        valid = valid & F.col(c).isNotNull()
    centred = [F.when(valid, F.col(c).cast("double") - F.lit(m)).otherwise(0.0) for c, m in zip(names, means, strict=True)]
    drawn = rep.sums_of_lowest(rep.prepared(rows, key, seed, [valid, *centred], F.col("__block")), take, sizes, reps, 1 + len(names))
    if not controls:
        return _difference(drawn, n, 0.0, "tau")
    if not n:
        return drawn.select("rep", F.lit(None).cast("double").alias("tau"))
    share = F.col("s")[0] / F.lit(float(n))
    # Covariances of the drawn treatment with the centred columns; those among the columns are the same in all replicates.
    own = [share * (1 - share), *[F.col("s")[i + 1] / F.lit(float(n)) for i in range(len(names))]]
    grams = drawn.select("rep", F.lit(n).alias("n"), F.array(share, *[F.lit(m) for m in means]).alias("means"),
                         F.array(*own, *[F.lit(c) for c in whole["cross"]]).alias("cross"))
    fits = reg.solve_moments(grams, ["d_perm", *controls], ["rep"])
    return fits.filter("term = 'd_perm'").select("rep", F.col("estimate").alias("tau"))


def _expanded_effects(slim, key, y, treat, reps, seed, within, controls) -> DataFrame:
    perms = permutations(slim, key, treat, reps, seed, within)
    if not controls:
        return ate(perms, "d_perm", [y], ["rep"]).select("rep", F.col("effect").alias("tau"))
    terms = {"d_perm": F.col("d_perm"), **{c: F.col(c) for c in controls}}
    fits = reg.ols(perms, y, terms, ["rep"])
    return fits.filter("term = 'd_perm'").select("rep", F.col("estimate").alias("tau"))


def permutation_test(df, key, y, treat, reps, seed, within=(), controls: Sequence[str] = ()) -> DataFrame:
    """Observed effect and the empirical two-sided p-value (1 + #extreme) / (B + 1).

    Without rows, or without an observed effect, there is nothing to test: the effect and the p-value are null.
    """
    if controls:
        terms = {treat: F.col(treat), **{c: F.col(c) for c in controls}}
        observed = reg.coefficients(df, y, terms)[treat]
    else:
        observed = ate(df, treat, [y]).first()["effect"]
    if observed is None or observed != observed:
        return df.sparkSession.createDataFrame([(None, 0, None)], "tau_hat double, n_permutations bigint, p_value double")
    null = permutation_effects(df, key, y, treat, reps, seed, within, controls)
    extreme = F.count_if(F.abs("tau") >= F.lit(abs(observed)))
    return null.agg(
        F.lit(observed).alias("tau_hat"), F.count(F.lit(1)).alias("n_permutations"),
        ((1.0 + extreme) / (F.count(F.lit(1)) + 1.0)).alias("p_value"))


def uniformity(df: DataFrame, p: str, bins: int = 10) -> DataFrame:
    """Counts of p-values per bin and the largest distance from the uniform distribution."""
    n = df.count()
    ranked = scalable.row_number_by(df.select(p), [], [p], "__rank")
    gap = ranked.agg(F.max(F.abs(F.col("__rank") / F.lit(n) - F.col(p))).alias("max_distance"))
    bin_id = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    counts = df.groupBy(bin_id.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    distance = gap.first()[0]
    return frame.join(counts, "bin", "left").select(
        "bin", F.coalesce("n", F.lit(0)).alias("n"), F.lit(distance).alias("max_distance"))


# Cumulative probabilities of the Poisson distribution with mean 1.
POISSON_ONE = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
               0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999897508033253)


def _poisson(numbers: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.array(POISSON_ONE), numbers / float(1 << 48), side="right")


def bootstrap_moments(df: DataFrame, key: str, x: str, y: str, reps: int, seed: str) -> DataFrame:
    """Poisson bootstrap of a simple regression over the rows with both values: the same result on every run and partitioning."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    both = df.where(a.isNotNull() & b.isNotNull())
    rows = rep.prepared(both, key, seed, [F.lit(1.0), a, b, a * a, a * b])
    sums = rep.weighted_sums(rows, reps, 5, _poisson)
    sw, sx, sy, sxx, sxy = (F.col("s")[i] for i in range(5))
    return sums.select("rep", sw.alias("n"), F.try_divide(sw * sxy - sx * sy, sw * sxx - sx * sx).alias("slope"))


# ---------------------------------------------------------------- measurement error

def regression_calibration(df: DataFrame, y: str, d: str, x_true: str, x_obs: str, validation: Column) -> DataFrame:
    """Fit the true on the observed covariate in the validation rows, predict for all, refit."""
    fit = reg.coefficients(df.filter(validation), x_true, {x_obs: F.col(x_obs)})
    hat = df.withColumn("x_hat", reg.linear_predictor(fit, {x_obs: F.col(x_obs)}))
    models = {
        "true": reg.ols(df, y, {d: F.col(d), "x": F.col(x_true)}),
        "naive": reg.ols(df, y, {d: F.col(d), "x": F.col(x_obs)}),
        "calibrated": reg.ols(hat, y, {d: F.col(d), "x": F.col("x_hat")}),
    }
    return reg.tidy_models(models)


def noise_sweep(df: DataFrame, key: str, y: str, d: str, x: str, sigmas: Sequence[float], reps: int, seed: str):
    """Refit under added noise for every (sigma, replicate); mean and 2.5 / 97.5 percent quantiles.

    A row's noise for all replicates is an array beside it. Its products with the centred columns are summed once for each
    replicate, and as the noise enters scaled by sigma, the moments of every sigma follow from those sums.
    """
    whole = reg.moments(df, y, {d: F.col(d), x: F.col(x)}).first()
    n, means = whole["n"], whole["means"]
    columns = [F.col(c).cast("double") - F.lit(m) for c, m in zip((d, x, y), means, strict=True)]
    present = df.where(" and ".join(f"`{c}` is not null" for c in (y, d, x)))
    noise = F.transform(F.sequence(F.lit(1), F.lit(reps)), lambda r: hash_normal(seed, r, F.col(key)))
    rows = present.select(F.array(*columns).alias("z"), noise.alias("e"))

    def run(batches):
        sums, any_row = np.zeros((reps, 5)), False
        for batch in batches:
            if len(batch):
                any_row = True
                z = batch["z"].flatten().to_numpy().reshape(len(batch), 3)
                e = batch["e"].flatten().to_numpy().reshape(len(batch), reps)
                sums[:, :3] += e.T @ z
                sums[:, 3] += e.sum(axis=0)
                sums[:, 4] += (e * e).sum(axis=0)
        if any_row:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(1, reps + 1, dtype=np.int32)), *[pa.array(sums[:, i]) for i in range(5)]],
                names=["rep", "ed", "ex", "ey", "e", "ee"])

    sent = rows.mapInArrow(run, "rep int, ed double, ex double, ey double, e double, ee double")
    sums = sent.groupBy("rep").agg(*[F.sum(c).alias(c) for c in ("ed", "ex", "ey", "e", "ee")])
    grid = sums.withColumn("sigma", F.explode(F.array(*[F.lit(float(s)) for s in sigmas])))
    if not n:
        return grid.select("sigma").groupBy("sigma").agg(F.count(F.lit(1)).alias("n_fits"), *[
            F.max(F.lit(None).cast("double")).alias(c) for c in ("mean_estimate", "lo", "hi")])
    s, size = F.col("sigma"), F.lit(float(n))
    dd, dx, dy, xx, xy, yy = (F.lit(c) for c in whole["cross"])
    mean_e = F.col("e") / size
    cross = F.array(dd, dx + s * F.col("ed") / size, dy, xx + 2 * s * F.col("ex") / size + s * s * (F.col("ee") / size - mean_e * mean_e),
                    xy + s * F.col("ey") / size, yy)
    grams = grid.select("sigma", "rep", F.lit(n).alias("n"), F.array(F.lit(means[0]), F.lit(means[1]) + s * mean_e, F.lit(means[2])).alias("means"),
                        cross.alias("cross"))
    fits = reg.solve_moments(grams, [d, "x_obs"], ["sigma", "rep"]).filter(F.col("term") == d)
    # Fits are one row per (sigma, replicate): the quantiles see `reps` rows per group.
    return fits.groupBy("sigma").agg(
        F.count(F.lit(1)).alias("n_fits"), F.avg("estimate").alias("mean_estimate"),
        F.percentile("estimate", 0.025).alias("lo"), F.percentile("estimate", 0.975).alias("hi"))


# ---------------------------------------------------------------- monitoring and composition

def sequential_z(df: DataFrame, day: str, treat: str, outcome: str) -> DataFrame:
    """Cumulative z statistic by day. Days are summed first, so the window is as long as the calendar."""
    daily = df.groupBy(day, treat).agg(
        F.count(outcome).alias("n"), F.sum(outcome).alias("s"), F.sum(F.pow(outcome, 2)).alias("ss"))
    wide = daily.groupBy(day).agg(*[
        F.coalesce(F.sum(F.when(F.col(treat) == a, F.col(c))), F.lit(0.0)).alias(f"{c}{a}")
        for a in (0, 1) for c in ("n", "s", "ss")])
    names = [f"{c}{a}" for a in (0, 1) for c in ("n", "s", "ss")]
    cum = scalable.running_totals(wide.withColumnsRenamed({n: f"d_{n}" for n in names}), [], [day],
                                  {n: F.col(f"d_{n}") for n in names}, limit=scalable.BOUNDED)

    def var(a):
        n, s, ss = (F.col(f"{c}{a}") for c in ("n", "s", "ss"))
        return F.when(n > 1, (ss - s * s / n) / (n - 1))

    se = F.sqrt(var(1) / F.col("n1") + var(0) / F.col("n0"))
    effect = F.when((F.col("n1") > 0) & (F.col("n0") > 0), F.try_divide("s1", "n1") - F.try_divide("s0", "n0"))
    return cum.select(day, "n1", "n0", effect.alias("effect"), F.try_divide(effect, se).alias("z"))


def composition_drift(df: DataFrame, wave: str, level: str, reference) -> DataFrame:
    """Share of each level per wave, its difference from the reference wave, and the drift index."""
    counts = df.groupBy(wave, level).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(wave).agg(F.sum("n").alias("__total"))
    shares = counts.join(totals, wave).withColumn("share", F.col("n") / F.col("__total")).drop("__total")
    base = shares.filter(F.col(wave) == F.lit(reference)).select(level, F.col("share").alias("reference_share"))
    both = shares.join(base, level, "left")
    diff = F.col("share") - F.col("reference_share")
    return both.withColumns({
        "difference": diff, "drift": diff * F.log(F.col("share") / F.col("reference_share"))})


def post_stratify(df: DataFrame, level: str, targets: Mapping[str, float], outcome: str) -> DataFrame:
    """Mean weighted to target shares, next to the raw mean; only group means are combined."""
    groups = df.groupBy(level).agg(F.count(outcome).alias("n"), F.avg(outcome).alias("m"))
    pairs = [F.lit(x) for kv in targets.items() for x in kv]
    weight = F.try_element_at(F.create_map(*pairs), F.col(level))
    return groups.agg(
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("raw_mean"),
        (F.sum(weight * F.col("m")) / F.sum(F.when(F.col("m").isNotNull(), weight))).alias("weighted_mean"))


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Percent agreement and Cohen's kappa from the cross table of two coders; kappa is NaN when only one class occurs."""
    table = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(
        F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    margins = table.select(
        F.explode(F.array(F.struct(F.col("a").cast("string").alias("v"), F.col("n").alias("na"), F.lit(0).alias("nb")),
                          F.struct(F.col("b").cast("string").alias("v"), F.lit(0).alias("na"), F.col("n").alias("nb")))).alias("m"))
    chance = margins.groupBy("m.v").agg((F.sum("m.na") * F.sum("m.nb")).alias("prod")).agg(F.sum("prod").alias("chance"))
    same = table.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    joined = same.withColumn("__k", F.lit(1)).join(chance.withColumn("__k", F.lit(1)), "__k")
    po, pe = F.try_divide("same", "n"), F.try_divide(F.col("chance"), F.col("n") * F.col("n"))
    return joined.select("n", po.alias("agreement"), float_divide(po - pe, 1 - pe).alias("kappa"))
