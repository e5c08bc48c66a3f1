"""Least squares from one distributed aggregation.

A regression needs the means and co-moments of its columns, a row of a few dozen numbers per group.
Spark computes them (``avg`` and ``covar_pop`` merge stably); the small solve then runs on the
aggregated rows, inside tasks. Rows of data never leave the executors.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.functions.distributions import normal_two_sided, student_two_sided
from civicframe.functions.division import float_divide

Terms = Mapping[str, Column]
INTERCEPT = "Intercept"
TIDY = "term string, estimate double, std_error double, statistic double, p_value double, n bigint, r2 double"


def levels(df: DataFrame, col: str, most: int = 500) -> list:
    """Sorted values of a factor; an error when it has too many to be dummy coded."""
    found = [r[0] for r in df.select(col).distinct().orderBy(col).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{col} has more than {most} levels; demean within it instead")
    return [v for v in found if v is not None]


def factor(col: str, values: Sequence) -> dict[str, Column]:
    """Treatment coding: one dummy per level, the first level dropped."""
    return {f"{col}[{v}]": (F.col(col) == F.lit(v)).cast("double") for v in values[1:]}


def _design(df: DataFrame, y: str | Column, terms: Terms, keep: Sequence[str]) -> DataFrame:
    target = F.col(y) if isinstance(y, str) else y
    cols = [v.cast("double").alias(f"x{i}") for i, v in enumerate(terms.values())]
    wide = df.select(*keep, *cols, target.cast("double").alias("y"))
    return wide.na.drop(subset=[f"x{i}" for i in range(len(cols))] + ["y"])


def moments(df: DataFrame, y: str | Column, terms: Terms, by: Sequence[str] = ()) -> DataFrame:
    """Per group: n, means, and centred cross products (upper triangle) of the terms and y.

    The products are covariances, which merge without cancellation, so columns may have any offset.
    """
    rows = _design(df, y, terms, by)
    names = [f"x{i}" for i in range(len(terms))] + ["y"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    means = [F.avg(c).alias(f"m_{c}") for c in names]
    wide = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *means, *[F.covar_pop(a, b).alias(f"{a}_{b}") for a, b in pairs])
    packed = F.array(*[F.col(f"m_{c}") for c in names])
    return wide.select(*by, "n", packed.alias("means"), F.array(*[F.col(f"{a}_{b}") for a, b in pairs]).alias("cross"))


def unpack(n: float, means: Sequence[float], cross: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """Mean vector and full matrix of centred cross products."""
    k = len(means)
    m = np.zeros((k, k))
    m[np.triu_indices(k)] = np.asarray(cross, dtype=float) * n
    return np.asarray(means, dtype=float), m + np.triu(m, 1).T


def solve_centred(n: float, mean: np.ndarray, m: np.ndarray, extra_df: int = 0):
    """Coefficients (intercept first), the inverse of X'X, residual variance and R squared."""
    sxx, sxy, syy = m[:-1, :-1], m[:-1, -1], m[-1, -1]
    size = np.sqrt(np.where(np.diag(sxx) > 0, np.diag(sxx), 1.0))
    inv = np.linalg.pinv(sxx / np.outer(size, size), rcond=1e-12, hermitian=True) / np.outer(size, size)
    slope = inv @ sxy
    x = mean[:-1]
    beta = np.concatenate([[mean[-1] - x @ slope], slope])
    bread = np.zeros((len(beta), len(beta)))
    bread[1:, 1:] = inv
    bread[0, 1:] = bread[1:, 0] = -inv @ x
    bread[0, 0] = 1.0 / n + x @ inv @ x
    rss = max(syy - slope @ sxy, 0.0)
    dof = n - len(beta) - extra_df
    sigma2 = rss / dof if dof > 0 else float("nan")
    return beta, bread, sigma2, dof, (1.0 - rss / syy if syy > 0 else float("nan"))


def tidy_rows(names, beta, variance, dof, n, r2, normal=False) -> list[tuple]:
    out = []
    for name, b, v in zip(names, beta, np.diag(variance)):
        se = float(np.sqrt(max(v, 0.0))) if v == v else float("nan")
        stat = float(b) / se if se > 0 else float("nan")
        p = normal_two_sided(stat) if normal else student_two_sided(stat, dof)
        out.append((name, float(b), se, stat, p, int(n), float(r2)))
    return out


def ols(df: DataFrame, y: str | Column, terms: Terms, by: Sequence[str] = ()) -> DataFrame:
    """Tidy coefficient table with classical standard errors, one block of rows per group."""
    grams = moments(df, y, terms, by)
    return solve_moments(grams, list(terms), by)


def solve_moments(grams: DataFrame, terms: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    types = dict(grams.dtypes)
    names, by = [INTERCEPT, *terms], list(by)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for rec in batch.to_dict("records"):
                if not rec["n"]:  # no rows, no model
                    continue
                mean, m = unpack(rec["n"], rec["means"], rec["cross"])
                beta, bread, s2, dof, r2 = solve_centred(rec["n"], mean, m)
                key = tuple(rec[b] for b in by)
                rows += [key + r for r in tidy_rows(names, beta, bread * s2, dof, rec["n"], r2)]
            yield pd.DataFrame(rows, columns=by + [c.split()[0] for c in TIDY.split(", ")])

    head = "".join(f"`{b}` {types[b]}, " for b in by)
    return grams.mapInPandas(solve, head + TIDY)


def coefficients(df: DataFrame, y: str | Column, terms: Terms) -> dict[str, float]:
    """Coefficients of one model as numbers, to be used in expressions; not numbers when there are no rows."""
    row = moments(df, y, terms).first()
    if not row["n"]:
        return dict.fromkeys([INTERCEPT, *terms], float("nan"))
    mean, m = unpack(row["n"], row["means"], row["cross"])
    return dict(zip([INTERCEPT, *terms], map(float, solve_centred(row["n"], mean, m)[0])))


def linear_predictor(beta: Mapping[str, float], terms: Terms) -> Column:
    out = F.lit(beta[INTERCEPT])
    for name, col in terms.items():
        out = out + F.lit(beta[name]) * col.cast("double")
    return out


def _sandwich(df, y, terms, keep):
    """First pass of the robust estimators: solution, rows with residual, and the bread."""
    row = moments(df, y, terms).first()
    mean, m = unpack(row["n"], row["means"], row["cross"])
    beta, bread, _, dof, r2 = solve_centred(row["n"], mean, m)
    rows = _design(df, y, terms, keep)
    xs = [F.lit(1.0)] + [F.col(f"x{i}") for i in range(len(terms))]
    fitted = sum((F.lit(float(b)) * x for b, x in zip(beta, xs)), F.lit(0.0))
    return row["n"], beta, bread, dof, r2, rows.withColumn("e", F.col("y") - fitted), xs


def _pairs(names):
    return [(a, b) for i, a in enumerate(names) for b in names[i:]]


def _symmetric(values, k) -> np.ndarray:
    out = np.zeros((k, k))
    out[np.triu_indices(k)] = values
    return out + np.triu(out, 1).T


def ols_cluster(df: DataFrame, y: str | Column, terms: Terms, cluster: str) -> DataFrame:
    """Cluster-robust table (CR1 with G/(G-1) (N-1)/(N-K), normal statistics).

    The second pass sums the scores per cluster with map-side combine, so a cluster that holds most
    rows costs one partial row per task.
    """
    n, beta, bread, dof, r2, rows, xs = _sandwich(df, y, terms, [cluster])
    k = len(beta)
    scores = rows.groupBy(cluster).agg(*[F.sum(x * F.col("e")).alias(f"s{i}") for i, x in enumerate(xs)])
    names = [f"s{i}" for i in range(k)]
    meat_row = scores.agg(F.count(F.lit(1)).alias("g"), *[F.sum(F.col(a) * F.col(b)) for a, b in _pairs(names)]).first()
    groups = meat_row["g"]
    meat = _symmetric(list(meat_row)[1:], k) * (groups / (groups - 1)) * ((n - 1) / (n - k))
    variance = bread @ meat @ bread
    table = tidy_rows([INTERCEPT, *terms], beta, variance, dof, n, r2, normal=True)
    return df.sparkSession.createDataFrame(table, TIDY)


def ols_hc2(df: DataFrame, y: str | Column, terms: Terms) -> DataFrame:
    """Heteroskedasticity-robust table (HC2: squared residuals over one minus leverage)."""
    n, beta, bread, dof, r2, rows, xs = _sandwich(df, y, terms, [])
    k = len(beta)
    leverage = F.lit(0.0)
    for i in range(k):
        for j in range(k):
            leverage = leverage + F.lit(float(bread[i, j])) * xs[i] * xs[j]
    weighted = rows.withColumn("w", F.col("e") * F.col("e") / (1.0 - leverage))
    sums = [F.sum(xs[i] * xs[j] * F.col("w")) for i in range(k) for j in range(i, k)]
    meat = _symmetric(list(weighted.agg(*sums).first()), k)
    table = tidy_rows([INTERCEPT, *terms], beta, bread @ meat @ bread, dof, n, r2)
    return df.sparkSession.createDataFrame(table, TIDY)


def ols_absorbed(df: DataFrame, y: str | Column, terms: Terms, factor_col: str, cluster: str | None = None,
                 cov: str = "classic") -> DataFrame:
    """Least squares with one intercept per level of a factor, for any number of levels.

    Moments are taken per level and their within-level parts added up, so no dummy is ever formed;
    the table holds the terms only. ``cov``: "classic", "cluster" (CR1) or "hc2".
    """
    grams = moments(df, y, terms, [factor_col])
    size = (len(terms) + 1) * (len(terms) + 2) // 2
    total = grams.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("levels"),
        *[F.sum(F.col("cross")[i] * F.col("n")).alias(f"c{i}") for i in range(size)]).first()
    n, k = total["n"], len(terms)
    m = _symmetric([total[f"c{i}"] for i in range(size)], k + 1)
    inv = np.linalg.pinv(m[:-1, :-1], rcond=1e-12, hermitian=True)
    beta = inv @ m[:-1, -1]
    rss, dof = max(m[-1, -1] - beta @ m[:-1, -1], 0.0), n - k - total["levels"]
    r2 = 1.0 - rss / m[-1, -1] if m[-1, -1] > 0 else float("nan")
    if cov == "classic":
        return df.sparkSession.createDataFrame(tidy_rows(terms, beta, inv * rss / dof, dof, n, r2), TIDY)
    means = grams.select(
        factor_col, F.col("n").alias("__n"), *[F.col("means")[i].alias(f"__m{i}") for i in range(k + 1)])
    keep = [factor_col] + ([cluster] if cluster and cluster != factor_col else [])
    rows = _design(df, y, terms, keep).join(means, factor_col)
    z = [F.col(f"x{i}") - F.col(f"__m{i}") for i in range(k)]
    fitted = sum((F.lit(float(b)) * c for b, c in zip(beta, z)), F.lit(0.0))
    rows = rows.withColumn("e", F.col("y") - F.col(f"__m{k}") - fitted)
    if cov == "cluster":
        scores = rows.groupBy(cluster).agg(*[F.sum(c * F.col("e")).alias(f"s{i}") for i, c in enumerate(z)])
        pairs = _pairs([f"s{i}" for i in range(k)])
        found = scores.agg(F.count(F.lit(1)).alias("g"), *[F.sum(F.col(a) * F.col(b)) for a, b in pairs]).first()
        g = found["g"]
        meat = _symmetric(list(found)[1:], k) * (g / (g - 1)) * ((n - 1) / dof)
        return df.sparkSession.createDataFrame(tidy_rows(terms, beta, inv @ meat @ inv, dof, n, r2, normal=True), TIDY)
    if cov != "hc2":
        raise ValueError(f"unknown covariance {cov}")
    leverage = 1.0 / F.col("__n")
    for i in range(k):
        for j in range(k):
            leverage = leverage + F.lit(float(inv[i, j])) * z[i] * z[j]
    weighted = rows.withColumn("w", F.col("e") * F.col("e") / (1.0 - leverage))
    found = weighted.agg(*[F.sum(z[i] * z[j] * F.col("w")) for i in range(k) for j in range(i, k)]).first()
    meat = _symmetric(list(found), k)
    return df.sparkSession.createDataFrame(tidy_rows(terms, beta, inv @ meat @ inv, dof, n, r2), TIDY)


def tidy_models(models: Mapping[str, DataFrame]) -> DataFrame:
    """Stack coefficient tables with the label of their model."""
    frames = [df.withColumn("model", F.lit(name)) for name, df in models.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def specification_grid(df: DataFrame, y: str, treat: str, controls: Terms,
                       specs: Mapping[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """The effect of one treatment under many sets of controls.

    One aggregation over the union of the controls; each specification solves a part of the matrix.
    """
    terms = {treat: F.col(treat), **controls}
    grams = moments(df, y, terms, by)
    names, by, types = list(terms), list(by), dict(grams.dtypes)
    plan = {label: [0] + [names.index(c) for c in chosen] + [len(names)] for label, chosen in specs.items()}

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for rec in batch.to_dict("records"):
                mean, m = unpack(rec["n"], rec["means"], rec["cross"])
                for label, at in plan.items():
                    beta, bread, s2, dof, r2 = solve_centred(rec["n"], mean[at], m[np.ix_(at, at)])
                    line = tidy_rows([INTERCEPT, treat], beta[:2], (bread * s2)[:2, :2], dof, rec["n"], r2)[1]
                    rows.append(tuple(rec[b] for b in by) + (label,) + line[1:])
            yield pd.DataFrame(rows, columns=by + ["spec"] + [c.split()[0] for c in TIDY.split(", ")][1:])

    head = "".join(f"`{b}` {types[b]}, " for b in by)
    return grams.mapInPandas(solve, head + "spec string, " + TIDY.split(", ", 1)[1])


def within_bandwidths(df: DataFrame, running: str, cutoff: float, widths: Sequence[float]) -> DataFrame:
    """Every row once per bandwidth whose window around the cutoff holds it, with the ``bandwidth``; for grids ``by`` it."""
    gap = F.abs(F.col(running) - F.lit(float(cutoff)))
    inside = F.filter(F.array(*[F.lit(float(w)) for w in widths]), lambda w: gap <= w)
    return df.withColumn("bandwidth", F.explode(inside))


def leave_one_period_out(df: DataFrame, y: str, terms: Terms, period: str) -> DataFrame:
    """For each period: coefficients fitted on all other periods.

    One row of moments per period is aggregated; dropping a period is a subtraction of its share.
    The solve sees the periods only, never their rows.
    """
    grams = moments(df, y, terms, [period])
    names, kind = [INTERCEPT, *terms], dict(grams.dtypes)[period]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, (mean, m) = whole["n"], unpack(whole["n"], whole["means"], whole["cross"])
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                own_mean, own = unpack(r["n"], r["means"], r["cross"])
                n = total - r["n"]
                if not n:
                    continue
                rest = (total * mean - r["n"] * own_mean) / n
                gap = own_mean - rest
                beta, bread, s2, dof, r2 = solve_centred(n, rest, m - own - r["n"] * n / total * np.outer(gap, gap))
                rows += [(r[period], *t) for t in tidy_rows(names, beta, bread * s2, dof, n, r2)]
            yield pd.DataFrame(rows, columns=[period] + [c.split()[0] for c in TIDY.split(", ")])

    # The moments of all rows are a few numbers; each period is taken out of them where its own moments are.
    whole = moments(df, y, terms).first().asDict()
    return grams.mapInPandas(solve, f"`{period}` {kind}, {TIDY}")


def ridge(df: DataFrame, y: str | Column, terms: Terms, alpha: float = 1.0) -> dict[str, float]:
    """Closed-form ridge with an unpenalised intercept."""
    row = moments(df, y, terms).first()
    mean, m = unpack(row["n"], row["means"], row["cross"])
    slope = np.linalg.solve(m[:-1, :-1] + alpha * np.eye(len(terms)), m[:-1, -1])
    return {INTERCEPT: float(mean[-1] - mean[:-1] @ slope), **dict(zip(terms, map(float, slope)))}


def score_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R squared; the squared errors are divided by n. Where the actual values are all equal, R squared is
    minus infinity, or not a number if they are also all predicted."""
    e = F.col(actual) - F.col(predicted)
    sums = df.groupBy(*by).agg(
        F.count(e).alias("n"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
        F.var_pop(F.when(e.isNotNull(), F.col(actual))).alias("__v"))
    return sums.select(*by, "n", F.sqrt("mse").alias("rmse"), "mae", (1 - float_divide(F.col("mse"), F.col("__v"))).alias("r2"))
