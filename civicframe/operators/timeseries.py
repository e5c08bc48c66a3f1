"""Series of (series, t, y): correlation, AR(1), backtests, breaks, decomposition, survival."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.functions.division import float_divide
from civicframe.operators import regression as reg
from civicframe.operators import scalable
from civicframe.session import materialise_observed


def detrend(df: DataFrame, series: Sequence[str], t: str, y: str, out="residual") -> DataFrame:
    """Residual from a straight line per series; the lines are fitted by one aggregation."""
    lines = df.groupBy(*series).agg(
        F.regr_slope(y, t).alias("__b"), F.regr_intercept(y, t).alias("__a"))
    rows = scalable.null_safe_join(df, lines, list(series)) if series else df.withColumns(
        dict(zip(("__b", "__a"), map(F.lit, lines.first()))))
    return rows.withColumn(out, F.col(y) - F.col("__a") - F.col("__b") * F.col(t)).drop("__a", "__b")


def autocorrelation(df: DataFrame, series: Sequence[str], t: str, y: str, lags: int, limit=None, chunk=None):
    """ACF at lags 0..lags (mean of the whole series, divided by the full sum of squares); NaN for a constant series."""
    means = df.groupBy(*series).agg(F.avg(y).alias("__m"))
    rows = scalable.null_safe_join(df, means, list(series)).withColumn("__d", F.col(y) - F.col("__m"))
    slim = rows.select(*series, t, "__d")

    def make(w):
        return {f"__l{k}": F.lag("__d", k).over(w) for k in range(1, lags + 1)}

    wide = scalable.over_near_rows(slim, list(series), [t], lags, make, limit, chunk)
    total = F.sum(F.col("__d") * F.col("__d"))
    acf = [float_divide(total, total)] + [
        float_divide(F.coalesce(F.sum(F.col("__d") * F.col(f"__l{k}")), F.lit(0.0)), total) for k in range(1, lags + 1)]
    grouped = wide.groupBy(*series).agg(F.array(*acf).alias("acf"))
    return grouped.select(*series, F.posexplode("acf").alias("lag", "acf"))


def _partial(rho: Sequence[float]) -> list[float]:
    """Durbin-Levinson recursion on autocorrelations at lags 0, 1, ..."""
    phi: list[float] = []
    out: list[float] = []
    for k in range(1, len(rho)):
        top = rho[k] - sum(p * rho[k - 1 - i] for i, p in enumerate(phi))
        bottom = 1.0 - sum(p * rho[i + 1] for i, p in enumerate(phi))
        last = top / bottom if bottom else float("nan")
        phi = [p - last * q for p, q in zip(phi, reversed(phi))] + [last]
        out.append(last)
    return out


def partial_autocorrelation(df, series: Sequence[str], t: str, y: str, lags: int) -> DataFrame:
    """PACF at lags 1..lags (Yule-Walker): a recursion over the few autocorrelations of a series."""
    acf = autocorrelation(df, series, t, y, lags)
    packed = acf.groupBy(*series).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda v: v["acf"]).alias("rho"))
    types = dict(packed.dtypes)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                tuple(rec[s] for s in series) + (k + 1, v)
                for rec in batch.to_dict("records") for k, v in enumerate(_partial(list(rec["rho"])))]
            yield pd.DataFrame(rows, columns=[*series, "lag", "pacf"])

    head = "".join(f"`{s}` {types[s]}, " for s in series)
    return packed.mapInPandas(solve, head + "lag int, pacf double")


def with_lag(df, series, t, y, k=1, out="y_lag", limit=None, chunk=None) -> DataFrame:
    return scalable.lagged(df, list(series), [t], y, k, out, limit, chunk)


def ar1(df: DataFrame, series: Sequence[str], t: str, y: str) -> DataFrame:
    """AR(1) by conditional least squares: phi, constant, mean and the last value per series."""
    lagged = with_lag(df, series, t, y)
    phi = F.regr_slope(y, "y_lag")
    const = F.regr_intercept(y, "y_lag")
    return lagged.groupBy(*series).agg(
        phi.alias("phi"), const.alias("const"), (const / (1 - phi)).alias("mu"),
        F.max_by(y, t).alias("y_last"), F.count(F.lit(1)).alias("n"))


def ar1_forecast(model: DataFrame, horizon: int) -> DataFrame:
    """mu + phi^h (y_last - mu) for h = 1..horizon."""
    steps = model.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    path = F.col("mu") + F.pow("phi", F.col("h")) * (F.col("y_last") - F.col("mu"))
    return steps.withColumn("forecast", path)


def split_evaluation(df: DataFrame, t: str, y: str, split: str) -> DataFrame:
    """Fit AR(1) on the training rows (in time order) and score its forecasts on the test rows.

    ``split`` holds 'train' or 'test'; the h-th test row in time order gets the h-step forecast.
    """
    model = ar1(df.filter(F.col(split) == "train"), [], t, y).first()
    test = scalable.row_number_by(df.filter(F.col(split) == "test"), [], [t], "h")
    mu, phi = F.lit(model["mu"]), F.lit(model["phi"])
    scored = test.withColumn("forecast", mu + F.pow(phi, F.col("h")) * (F.lit(model["y_last"]) - mu))
    return reg.score_metrics(scored, y, "forecast")


def backtest_ar1(df: DataFrame, series: Sequence[str], t: str, y: str, min_train: int, limit=None) -> DataFrame:
    """One-step forecasts with a growing window: each row is predicted from the rows before it.

    Running sums of the moments give every refit in a single ordered pass.
    """
    rows = with_lag(df, series, t, y, limit=limit)
    x, v, ok = F.col("y_lag"), F.col(y), F.col("y_lag").isNotNull()

    def part(c):
        return F.when(ok, c)

    sums = {"__n": F.when(ok, 1).otherwise(0), "__sx": part(x), "__sy": part(v), "__sxx": part(x * x), "__sxy": part(x * v)}
    cum = scalable.running_totals(rows, list(series), [t], sums, inclusive=False, limit=limit)
    n, sx, sy, sxx, sxy = (F.col(c) for c in sums)
    slope = F.try_divide(n * sxy - sx * sy, n * sxx - sx * sx)
    predicted = sy / n + slope * (x - sx / n)
    return cum.filter(ok & (n >= min_train)).select(
        *series, t, y, predicted.alias("forecast"), (v - predicted).alias("error"))


def interrupted_terms(t: str, t0: float) -> dict[str, Column]:
    after = (F.col(t) >= t0).cast("double")
    return {"t": F.col(t).cast("double"), "level": after, "slope": (F.col(t) - F.lit(t0)) * after}


def interrupted_series(df: DataFrame, t: str, y: str, t0: float) -> DataFrame:
    """Level and slope change at t0, as a tidy coefficient table."""
    return reg.ols(df, y, interrupted_terms(t, t0))


def interrupted_paths(df: DataFrame, t: str, y: str, t0: float) -> DataFrame:
    """Fitted values, and the path that would have followed without the break."""
    terms = interrupted_terms(t, t0)
    beta = reg.coefficients(df, y, terms)
    without = F.lit(beta[reg.INTERCEPT]) + F.lit(beta["t"]) * F.col(t)
    return df.withColumns({"fitted": reg.linear_predictor(beta, terms), "counterfactual": without})


def switchback(df: DataFrame, t: str, length: int) -> DataFrame:
    """Alternating blocks of ``length`` periods: block number and arm."""
    block = F.floor(F.col(t) / length)
    return df.withColumns({"block": block, "treat": (block % 2).cast("int")})


def decompose(df: DataFrame, series: Sequence[str], t: str, y: str, period: int = 7, limit=None, chunk=None):
    """Classical decomposition for an odd period: centred mean, seasonal means, remainder."""
    half = period // 2

    def make(w):
        frame = w.rowsBetween(-half, half)
        return {"__trend": F.avg(y).over(frame), "__seen": F.count(y).over(frame)}

    rows = scalable.over_near_rows(df, list(series), [t], half, make, limit, chunk, ahead=half)
    rows = rows.withColumn("trend", F.when(F.col("__seen") == period, F.col("__trend")))
    rows = rows.withColumn("season", F.pmod(F.col(t), F.lit(period))).withColumn("__gap", F.col(y) - F.col("trend"))
    seasonal = rows.groupBy(*series, "season").agg(F.avg("__gap").alias("__s"))
    level = seasonal.groupBy(*series).agg(F.avg("__s").alias("__c"))
    centred = scalable.null_safe_join(seasonal, level, list(series))
    centred = centred.select(*series, "season", (F.col("__s") - F.col("__c")).alias("seasonal"))
    out = scalable.null_safe_join(rows, centred, [*series, "season"], "left")
    return out.withColumn("remainder", F.col(y) - F.col("trend") - F.col("seasonal")).drop(
        "__trend", "__seen", "__gap", "season")


def two_way_demean(df: DataFrame, unit: str, time: str, cols: Sequence[str], tol: float = 1e-10, sweeps: int | None = None) -> DataFrame:
    """Residuals of the columns after unit and time effects.

    Means of units, then of times, are subtracted in turn until no time mean moves any more beside the spread of
    its column, or for ``sweeps`` rounds. A balanced panel settles in the first round, one with gaps in some more.
    """
    done = 0
    while sweeps is None or done < sweeps:
        by_unit = df.groupBy(unit).agg(*[F.avg(c).alias(f"__u_{c}") for c in cols])
        half = df.join(by_unit, unit).select(unit, time, *[(F.col(c) - F.col(f"__u_{c}")).alias(c) for c in cols])
        by_time = half.groupBy(time).agg(*[F.avg(c).alias(f"__t_{c}") for c in cols])
        df, seen = materialise_observed(
            half.join(by_time, time).select(unit, time, *[(F.col(c) - F.col(f"__t_{c}")).alias(c) for c in cols], *[f"__t_{c}" for c in cols]),
            **{f"move{i}": F.max(F.abs(F.col(f"__t_{c}"))) for i, c in enumerate(cols)},
            **{f"spread{i}": F.max(F.abs(F.col(c))) for i, c in enumerate(cols)})
        df, done = df.drop(*[f"__t_{c}" for c in cols]), done + 1
        if sweeps is None and all((seen[f"move{i}"] or 0.0) <= tol * (seen[f"spread{i}"] or 0.0) for i in range(len(cols))):
            break
    return df


def two_way_effect(df: DataFrame, unit: str, time: str, y: str, d: str, sweeps: int | None = None) -> DataFrame:
    """Two-way fixed-effects slope with a standard error clustered by unit; the panel may have gaps."""
    flat = two_way_demean(df, unit, time, [y, d], sweeps=sweeps)
    dd = F.sum(F.col(d) * F.col(d))
    slope = flat.agg((F.sum(F.col(d) * F.col(y)) / dd).alias("b"), dd.alias("dd")).first()
    score = F.sum(F.col(d) * (F.col(y) - F.lit(slope["b"]) * F.col(d))).alias("s")
    clusters = flat.groupBy(unit).agg(score)
    g = F.count(F.lit(1))
    return clusters.agg(
        F.lit(slope["b"]).alias("estimate"),
        F.sqrt(F.sum(F.col("s") * F.col("s")) * (g / (g - 1))).alias("__root"),
        g.alias("n_units")).select(
        "estimate", (F.col("__root") / F.lit(slope["dd"])).alias("std_error"), "n_units")


def kaplan_meier(df: DataFrame, time: str, event: str, by: Sequence[str], limit=None) -> DataFrame:
    """Survival per group with right censoring.

    Rows are counted per (group, time) first; the running products see one row per time.
    """
    counts = df.groupBy(*by, time).agg(
        F.count_if(F.col(event) == 1).alias("events"), F.count(F.lit(1)).alias("leaving"))
    totals = counts.groupBy(*by).agg(F.sum("leaving").alias("__n"))
    rows = scalable.null_safe_join(counts, totals, list(by))
    left = scalable.running_totals(rows, list(by), [time], {"__gone": F.col("leaving")}, inclusive=False, limit=limit)
    at_risk = left.withColumn("at_risk", F.col("__n") - F.coalesce("__gone", F.lit(0)))
    # A time at which everybody still at risk fails ends the curve at zero.
    alive = F.col("at_risk") > F.col("events")
    step = F.when(alive, F.log(1 - F.col("events") / F.col("at_risk"))).otherwise(0.0)
    cum = scalable.running_totals(at_risk, list(by), [time], {
        "__log": step, "__dead": F.when(alive, 0).otherwise(1)}, limit=limit)
    survival = F.when(F.col("__dead") > 0, 0.0).otherwise(F.exp("__log"))
    return cum.select(*by, time, "events", "at_risk", survival.alias("survival"))
