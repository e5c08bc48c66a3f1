"""Record linkage: blocking, comparison, Fellegi-Sunter weights, thresholds and resolution.

Every record of one list is compared with every record of the other list in its block. Large blocks are cut
into chunks on both sides, and every two chunks meet in a task of their own. Pairs are counted by agreement pattern
before anything is fitted, so the model sees a table of patterns, whatever the number of pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicframe.functions import similarity as sim
from civicframe.operators import relational as rel
from civicframe.operators import scalable
from civicframe.session import materialise


def deterministic_match(a: DataFrame, b: DataFrame, keys: Sequence[str], key: str = "id") -> DataFrame:
    """Exact multi-key join, clashing columns with suffixes."""
    return rel.suffixed_join(a, b, keys)


def match_rate(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Records of ``a`` with a partner, by a semi join on distinct keys."""
    hit = a.join(b.select(*keys).distinct().withColumn("__hit", F.lit(1)), list(keys), "left")
    return hit.agg(F.count(F.lit(1)).alias("n"), F.count("__hit").alias("n_matched"), (F.count("__hit") / F.count(F.lit(1))).alias("match_rate"))


def block_report(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sizes and candidate pairs per block, without forming a pair."""
    na = a.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_a"))
    nb = b.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_b"))
    both = na.join(nb, list(keys), "full").na.fill(0, ["n_a", "n_b"])
    return both.withColumn("n_pairs", F.col("n_a") * F.col("n_b"))


#: Records of a large block that meet on either side at a time.
ROWS_PER_SALT = 2_000


def candidate_pairs(a: DataFrame, b: DataFrame, key: str, block: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """All pairs of records in the same block: the block, and key and fields of both sides. Null blocks pair with nothing."""
    fields = [f for f in fields if f not in block]

    def side(df: DataFrame, name: str) -> DataFrame:
        cols = {f: f"{f}_{name}" for f in (key, *fields)}
        return df.na.drop(subset=list(block)).select(*block, *cols).withColumnsRenamed(cols)

    left, right, on = scalable.salted(side(a, "a"), side(b, "b"), list(block), ROWS_PER_SALT)
    left, right = scalable.dealt_out(left, right, on)
    return left.join(right, on).drop(*on[len(block):])


@dataclass(frozen=True)
class Comparison:
    """How a field is compared: 'jaro_winkler', 'levenshtein', 'gauss' or 'exact', and the cuts of its levels."""

    field: str
    method: str
    cuts: tuple[float, ...] = (0.88, 0.92)
    offset: float = 0.0
    scale: float = 2.0


def compare(pairs: DataFrame, specs: Sequence[Comparison]) -> DataFrame:
    """Add one similarity per field, in one pass over the pairs."""
    for s in specs:
        a, b, out = f"{s.field}_a", f"{s.field}_b", f"{s.field}_sim"
        if s.method == "jaro_winkler":
            pairs = sim.with_jaro_winkler(pairs, a, b, out)
        elif s.method == "levenshtein":
            longest = F.greatest(F.length(a), F.length(b))
            pairs = pairs.withColumn(out, F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest))
        elif s.method == "gauss":
            pairs = pairs.withColumn(out, sim.gaussian_similarity(F.col(a), F.col(b), s.offset, s.scale))
        elif s.method == "exact":
            pairs = pairs.withColumn(out, sim.exact(F.col(a), F.col(b)).cast("double"))
        else:
            raise ValueError(f"unknown comparison {s.method}")
    return pairs


def agreement_levels(compared: DataFrame, specs: Sequence[Comparison]) -> DataFrame:
    """Level of each field: the number of cuts its similarity reaches; missing counts as 0."""
    levels = {}
    for s in specs:
        x = F.coalesce(F.col(f"{s.field}_sim"), F.lit(0.0))
        levels[f"{s.field}_level"] = sum((x >= c).cast("int") for c in s.cuts)
    return compared.withColumns(levels)


#: A level that never occurs keeps this probability.
LEAST_PROBABILITY = 1e-9


@dataclass(frozen=True)
class MatchModel:
    """Share of matches and the level probabilities among matches (m) and others (u)."""

    share: float
    m: list[list[float]]
    u: list[list[float]]
    n_iterations: int


def pattern_counts(levelled: DataFrame, names: Sequence[str]) -> DataFrame:
    return levelled.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def _em_step(theta: np.ndarray, patterns: np.ndarray, counts: np.ndarray, sizes: Sequence[int]) -> tuple[np.ndarray, float]:
    """The parameters (share, m of each field, u of each field) after one EM step, and the log-likelihood before it."""
    ends = 1 + np.cumsum([*sizes, *sizes])[:-1]
    parts = np.split(theta[1:], ends - 1)
    pm, pu = np.full(len(counts), theta[0]), np.full(len(counts), 1 - theta[0])
    for j in range(len(sizes)):
        pm, pu = pm * parts[j][patterns[:, j]], pu * parts[len(sizes) + j][patterns[:, j]]
    both = np.maximum(pm + pu, 1e-300)
    wm, wu = counts * pm / both, counts * pu / both
    out = [np.array([wm.sum() / counts.sum()])]
    for weights in (wm, wu):
        for j, s in enumerate(sizes):
            v = np.maximum(np.bincount(patterns[:, j], weights, s) / max(weights.sum(), 1e-300), LEAST_PROBABILITY)
            out.append(v / v.sum())
    return np.concatenate(out), float((counts * np.log(both)).sum())


def _feasible(theta: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """Back into the range of probabilities after a long step."""
    out = [np.clip(theta[:1], 1e-12, 1 - 1e-12)]
    for part in np.split(theta[1:], np.cumsum([*sizes, *sizes])[:-1]):
        part = np.maximum(part, LEAST_PROBABILITY)
        out.append(part / part.sum())
    return np.concatenate(out)


def fit_patterns(patterns: np.ndarray, counts: np.ndarray, sizes: Sequence[int], tol: float | None = 1e-13, most=5_000) -> MatchModel:
    """EM for two classes with independent fields, on the table of agreement patterns.

    It starts with matches that agree more often, so the classes cannot swap. Where matches are few, plain steps creep, so
    two of them are extrapolated along their differences (squared iterative steps); an extrapolation that lowers
    the likelihood is dropped. It ends when a plain step changes no parameter by more than ``tol``, or after ``most``
    rounds; with ``tol`` None it takes ``most`` plain steps exactly.
    """
    theta = np.concatenate([[0.05], *[[0.1, *(0.9 * np.arange(1, s) / np.arange(1, s).sum())] for s in sizes],
                            *[[0.9, *[0.1 / (s - 1)] * (s - 1)] for s in sizes]])
    step = lambda t: _em_step(t, patterns, counts, sizes)
    for turn in range(1, most + 1):
        one, before = step(theta)
        if tol is None:
            theta = one
            continue
        two, _ = step(one)
        r, v = one - theta, two - 2 * one + theta
        if np.abs(two - one).max() <= tol:
            theta = two
            break
        length = np.linalg.norm(v)
        alpha = -max(1.0, np.linalg.norm(r) / length) if length > 0 else -1.0
        far, reached = step(_feasible(theta - 2 * alpha * r + alpha * alpha * v, sizes))
        _, plain = step(two)
        theta = far if reached >= plain else two
    k = len(sizes)
    parts = [list(map(float, p)) for p in np.split(theta[1:], np.cumsum([*sizes, *sizes])[:-1])]
    return MatchModel(float(theta[0]), parts[:k], parts[k:], turn)


def fit_linkage(levelled: DataFrame, specs: Sequence[Comparison], tol: float | None = 1e-13, most=5_000) -> MatchModel:
    """Fit the model to the pattern counts: at most product(levels) rows reach the driver."""
    names = [f"{s.field}_level" for s in specs]
    rows = sorted(map(tuple, pattern_counts(levelled, names).collect()))
    table = np.array(rows, dtype=np.int64).reshape(-1, len(names) + 1)
    return fit_patterns(table[:, :-1], table[:, -1].astype(float), [len(s.cuts) + 1 for s in specs], tol, most)


def posterior(model: MatchModel, specs: Sequence[Comparison]) -> Column:
    """Match probability as an expression of the levels."""
    log_odds = F.lit(float(np.log(model.share / (1 - model.share))))
    for s, m, u in zip(specs, model.m, model.u):
        weights = F.array(*[F.lit(float(np.log(a / b))) for a, b in zip(m, u)])
        log_odds = log_odds + F.get(weights, F.col(f"{s.field}_level"))
    return 1.0 / (1.0 + F.exp(-log_odds))


def probabilistic_pairs(a, b, key, block, specs: Sequence[Comparison], tol: float | None = 1e-13, most=5_000) -> tuple[DataFrame, MatchModel]:
    """Compared pairs with their posterior, and the fitted model."""
    pairs = candidate_pairs(a, b, key, block, [s.field for s in specs])
    levelled = materialise(agreement_levels(compare(pairs, specs), specs))
    model = fit_linkage(levelled, specs, tol, most)
    return levelled.withColumn("posterior", posterior(model, specs)), model


def threshold_curve(pairs: DataFrame, score: str, steps: int = 100) -> DataFrame:
    """Pairs with score >= t for t = 0, 1 / steps, ..., 1."""
    x = F.col(score)
    base = F.floor(x * steps).cast("int")
    level = F.when((base + 1) / F.lit(float(steps)) <= x, base + 1).when(base / F.lit(float(steps)) > x, base - 1).otherwise(base)
    counts = pairs.groupBy(F.least(level, F.lit(steps)).alias("step")).agg(F.count(F.lit(1)).alias("c"))
    grid = pairs.sparkSession.range(steps + 1).select(F.col("id").cast("int").alias("step"))
    above = W.partitionBy().orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, W.currentRow)
    return grid.join(counts, "step", "left").select(
        (F.col("step") / float(steps)).alias("threshold"), F.sum(F.coalesce("c", F.lit(0))).over(above).alias("n"))


def quality_by_bin(pairs: DataFrame, score: str, texts: Sequence[str], numbers: Sequence[str], lowest=1e-6) -> DataFrame:
    """Mean edit distance and absolute difference per score bin (right-closed tenths, empty bins kept)."""
    edges = [i / 10 for i in range(11)]
    labels = [f"{x:.1f}-{y:.1f}" for x, y in zip(edges, edges[1:])]
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(F.levenshtein(f"{f}_a", f"{f}_b")).alias(f"mean_{f}") for f in texts]
    aggs += [F.avg(F.abs(F.col(f"{f}_a") - F.col(f"{f}_b"))).alias(f"mean_{f}") for f in numbers]
    out = rel.bin_table(pairs.filter(F.col(score) > lowest), score, edges, labels, aggs)
    return out.withColumn("n", F.coalesce("n", F.lit(0)))


def decide(score: Column, upper: float, lower: float) -> Column:
    return F.when(score >= upper, "match").when(score >= lower, "review").otherwise("non-match")


def best_partner(pairs: DataFrame, key: str, score: str, side: str = "a", least: float = 0.0) -> DataFrame:
    """The best partner of each record (ties to the lower id): a maximum, no sort."""
    other = "b" if side == "a" else "a"
    rank = F.struct(F.col(score).alias("score"), (-F.col(f"{key}_{other}")).alias("neg"))
    best = pairs.filter(F.col(score) >= least).groupBy(f"{key}_{side}").agg(F.max(rank).alias("__best"))
    return best.select(f"{key}_{side}", (-F.col("__best.neg")).alias(f"{key}_{other}"), F.col("__best.score").alias(score))


def mutual_best(pairs: DataFrame, key: str, score: str, least: float = 0.0) -> DataFrame:
    """One-to-one: pairs that are the best of both of their sides."""
    first = best_partner(pairs, key, score, "a", least)
    second = best_partner(pairs, key, score, "b", least).select(f"{key}_a", f"{key}_b")
    return first.join(second, [f"{key}_a", f"{key}_b"])


def link_scores(pairs: DataFrame, key: str, score: str, thresholds: Sequence[float], n_true: int) -> DataFrame:
    """Precision and recall of links at each threshold; the truth is an equal id.

    All thresholds come from one pass.
    """
    true = F.col(f"{key}_a") == F.col(f"{key}_b")
    aggs, rows = [], []
    for i, cut in enumerate(thresholds):
        hit = F.col(score) >= cut
        aggs += [F.count_if(hit).alias(f"n{i}"), F.count_if(hit & true).alias(f"t{i}")]
        rows.append(F.struct(F.lit(float(cut)).alias("threshold"), F.col(f"n{i}").alias("n_links"), F.col(f"t{i}").alias("n_true_links")))
    table = pairs.agg(*aggs).select(F.inline(F.array(*rows)))
    return table.withColumns({
        "precision": F.try_divide("n_true_links", "n_links"),
        "recall": F.col("n_true_links") / F.lit(n_true)})
