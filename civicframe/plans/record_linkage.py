"""Record linkage over two versions of a list of people derived from the parts (N1 to N9, C9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions.hashing import sql_hash48
from civicframe.operators import linkage as ln
from civicframe.plans import views
from civicframe.plans.registry import query
from civicframe.plans.views import hash_sql

A = """a AS (SELECT p_partkey AS id, split_part(p_name, ' ', 1) AS firstname, lower(p_type) || split_part(p_name, ' ', 2) AS lastname,
  CAST(1940 + p_size AS INT) AS birthyear, CAST(floor(p_partkey / 40) AS BIGINT) AS zipcode FROM part)"""
# The second list: a tenth missing, typing errors in names, shifted years, some moves.
B_SPARK, B_DUCK = views.both("""b AS (SELECT id,
  CASE WHEN h % 10 = 0 THEN substr(firstname, 1, length(firstname) - 1) WHEN h % 10 = 1 THEN substr(firstname, 2, 1) || substr(firstname, 1, 1) || substr(firstname, 3)
       ELSE firstname END AS firstname,
  CASE WHEN h % 12 = 2 THEN substr(lastname, 2) ELSE lastname END AS lastname,
  CAST(CASE WHEN h % 15 = 0 THEN birthyear + 1 ELSE birthyear END AS INT) AS birthyear,
  CASE WHEN h % 25 = 3 THEN zipcode + 1 ELSE zipcode END AS zipcode
  FROM (SELECT a.*, {h} AS h FROM a) AS p WHERE h % 10 <> 7)""", h=hash_sql("typo", "id"))
FIELDS = ["firstname", "lastname", "birthyear"]
KEYS = ["firstname", "lastname", "birthyear", "zipcode"]
SPECS = (
    ln.Comparison("firstname", "jaro_winkler"),
    ln.Comparison("lastname", "jaro_winkler"),
    ln.Comparison("birthyear", "gauss", cuts=(0.6, 0.99), scale=2.0),
)


def people(t):
    a = t.sql(f"WITH {A} SELECT * FROM a", "part")
    b = t.sql(f"WITH {A}, {B_SPARK} SELECT * FROM b", "part")
    return a, b


@query("n1_deterministic_match", f"WITH {A}, {B_DUCK} SELECT a.id AS id_a, b.id AS id_b, firstname, lastname, birthyear, zipcode FROM a JOIN b USING (firstname, lastname, birthyear, zipcode)")
def _(t):
    return ln.deterministic_match(*people(t), KEYS)


@query("n1_match_rate", f"WITH {A}, {B_DUCK} SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE hit) AS n_matched, ROUND(AVG(hit::INT), 9) AS match_rate FROM (SELECT (firstname, lastname, birthyear, zipcode) IN (SELECT (firstname, lastname, birthyear, zipcode) FROM b) AS hit FROM a)")
def _(t):
    return ln.match_rate(*people(t), KEYS).withColumn("match_rate", F.round("match_rate", 9))


@query("n2_block_report", f"WITH {A}, {B_DUCK} SELECT COALESCE(x.zipcode, y.zipcode) AS zipcode, COALESCE(n_a, 0) AS n_a, COALESCE(n_b, 0) AS n_b, COALESCE(n_a, 0) * COALESCE(n_b, 0) AS n_pairs FROM (SELECT zipcode, COUNT(*) AS n_a FROM a GROUP BY 1) x FULL JOIN (SELECT zipcode, COUNT(*) AS n_b FROM b GROUP BY 1) y ON x.zipcode = y.zipcode")
def _(t):
    return ln.block_report(*people(t), ["zipcode"])


PAIRS = """pairs AS (SELECT a.zipcode, a.id AS id_a, a.firstname AS firstname_a, a.lastname AS lastname_a, a.birthyear AS birthyear_a,
b.id AS id_b, b.firstname AS firstname_b, b.lastname AS lastname_b, b.birthyear AS birthyear_b FROM a JOIN b USING (zipcode))"""
SIMS = """sims AS (SELECT *, jaro_winkler_similarity(firstname_a, firstname_b) AS firstname_sim, jaro_winkler_similarity(lastname_a, lastname_b) AS lastname_sim,
pow(2, -pow(abs(birthyear_a - birthyear_b) / 2.0, 2)) AS birthyear_sim FROM pairs), scored AS (SELECT *, (firstname_sim + lastname_sim + birthyear_sim) / 3 AS score FROM sims)"""
HEAD = f"WITH {A}, {B_DUCK}, {PAIRS}"


LEVELS = "(firstname_sim >= 0.88)::INT + (firstname_sim >= 0.92)::INT AS firstname_level, (lastname_sim >= 0.88)::INT + (lastname_sim >= 0.92)::INT AS lastname_level, (birthyear_sim >= 0.6)::INT + (birthyear_sim >= 0.99)::INT AS birthyear_level"


def scored(t, specs=SPECS):
    """All pairs of a block with the mean similarity as score."""
    a, b = people(t)
    pairs = ln.compare(ln.candidate_pairs(a, b, "id", ["zipcode"], FIELDS), specs)
    return pairs.withColumn("score", (F.col("firstname_sim") + F.col("lastname_sim") + F.col("birthyear_sim")) / 3)


@query("c9_blocking_join", HEAD + " SELECT zipcode, firstname_a, lastname_a, birthyear_a, firstname_b, lastname_b, birthyear_b, id_a, id_b FROM pairs")
def _(t):
    return ln.candidate_pairs(*people(t), "id", ["zipcode"], FIELDS)


@query("n3_comparison_vectors", HEAD + f", {SIMS} SELECT id_a, id_b, ROUND(firstname_sim, 6) AS firstname_sim, ROUND(lastname_sim, 6) AS lastname_sim, ROUND(birthyear_sim, 6) AS birthyear_sim, CAST(1 AS INT) AS zipcode_exact FROM scored")
def _(t):
    rows = scored(t)
    return rows.select("id_a", "id_b", *[F.round(f"{f}_sim", 6).alias(f"{f}_sim") for f in FIELDS], F.lit(1).alias("zipcode_exact"))


# Plain steps in the SQL text, far beyond where the posterior settles; the operator gets there by extrapolation.
EM_STEPS = 20_000


def em_sql(steps: int) -> str:
    """Two-class EM on the pattern counts by recursion, one row of parameters a step.

    A row holds the share and, per field and level, the probabilities among matches and among others.
    """
    short = ("f", "l", "y")
    m0 = [0.1, 0.9 * 1 / 3, 0.9 * 2 / 3]
    u0 = [0.9, 0.05, 0.05]
    start = ", ".join(f"{v}::DOUBLE AS {c}{x}{k}" for c, vs in (("m", m0), ("u", u0)) for x in short for k, v in enumerate(vs))
    names = dict(zip(short, FIELDS))

    def product(c: str, lead: str) -> str:
        return lead + "".join(f" * CASE {names[x]}_level WHEN 0 THEN {c}{x}0 WHEN 1 THEN {c}{x}1 ELSE {c}{x}2 END" for x in short)

    parts = ["SUM(n * pm / (pm + pu)) / SUM(n)"]
    for weight in ("n * pm / (pm + pu)", "n * pu / (pm + pu)"):
        for x in short:
            raw = [f"greatest(COALESCE(SUM({weight}) FILTER (WHERE {names[x]}_level = {k}), 0) / SUM({weight}), 1e-9)" for k in range(3)]
            parts += [f"{raw[k]} / ({' + '.join(raw)})" for k in range(3)]
    return f"""em AS (SELECT 0 AS step, 0.05::DOUBLE AS share, {start} UNION ALL
SELECT step + 1, {', '.join(parts)} FROM (SELECT *, {product('m', 'share')} AS pm, {product('u', '(1 - share)')} AS pu FROM patterns, em) WHERE step < {steps} GROUP BY step),
posterior AS (SELECT id_a, id_b, ROUND(1 / (1 + {product('u', '(1 - share)')} / ({product('m', 'share')})), 6) AS posterior FROM levelled, em WHERE step = {steps})"""


@query("n4_posterior_pairs", HEAD.replace("WITH ", "WITH RECURSIVE ", 1) + f", {SIMS}, levelled AS MATERIALIZED (SELECT id_a, id_b, {LEVELS} FROM scored), patterns AS MATERIALIZED (SELECT firstname_level, lastname_level, birthyear_level, COUNT(*) AS n FROM levelled GROUP BY ALL), {em_sql(EM_STEPS)} SELECT id_a, id_b, posterior FROM posterior")
def _(t):
    pairs, _model = ln.probabilistic_pairs(*people(t), "id", ["zipcode"], SPECS)
    return pairs.select("id_a", "id_b", F.round("posterior", 6).alias("posterior"))


@query("n4_pattern_counts", HEAD + f", {SIMS} SELECT {LEVELS}, COUNT(*) AS n FROM scored GROUP BY 1, 2, 3")
def _(t):
    levelled = ln.agreement_levels(scored(t), SPECS)
    return ln.pattern_counts(levelled, [f"{f}_level" for f in FIELDS])


@query("n5_threshold_curve", HEAD + f", {SIMS} SELECT i / 100.0::DOUBLE AS threshold, (SELECT COUNT(*) FROM scored WHERE score >= i / 100.0::DOUBLE) AS n FROM range(101) AS g(i)")
def _(t):
    return ln.threshold_curve(scored(t), "score")


@query("n6_quality_by_bin", HEAD + f""", {SIMS}, q AS (SELECT CAST(CEIL(round(round(score, 9) * 10, 9)) AS INT) - 1 AS bin, COUNT(*) AS n, AVG(levenshtein(firstname_a, firstname_b)) AS f, AVG(levenshtein(lastname_a, lastname_b)) AS l, AVG(abs(birthyear_a - birthyear_b)) AS y FROM scored WHERE round(score, 9) > 1e-6 GROUP BY 1)
SELECT CAST(b AS INT) AS bin, COALESCE(n, 0)::BIGINT AS n, ROUND(f, 6) AS mean_firstname, ROUND(l, 6) AS mean_lastname, ROUND(y, 6) AS mean_birthyear FROM range(10) AS g(b) LEFT JOIN q ON b = bin""")
def _(t):
    out = ln.quality_by_bin(rounded_scores(t), "score", ["firstname", "lastname"], ["birthyear"])
    return out.select("bin", "n", *[F.round(f"mean_{f}", 6).alias(f"mean_{f}") for f in FIELDS])


@query("n7_two_cutoffs", HEAD + f", {SIMS} SELECT CASE WHEN score >= 0.9 THEN 'match' WHEN score >= 0.7 THEN 'review' ELSE 'non-match' END AS decision, COUNT(*) AS n FROM scored GROUP BY 1")
def _(t):
    decided = scored(t).withColumn("decision", ln.decide(F.col("score"), 0.9, 0.7))
    return decided.groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


BEST = "best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_a ORDER BY round(score, 9) DESC, id_b) AS ra, ROW_NUMBER() OVER (PARTITION BY id_b ORDER BY round(score, 9) DESC, id_a) AS rb FROM scored WHERE round(score, 9) >= 0.8)"


def rounded_scores(t):
    return scored(t).withColumn("score", F.round("score", 9))


@query("n8_best_partner", HEAD + f", {SIMS}, {BEST} SELECT id_a, id_b, round(score, 9) AS score FROM best WHERE ra = 1")
def _(t):
    return ln.best_partner(rounded_scores(t), "id", "score", "a", 0.8)


@query("n8_one_to_one", HEAD + f", {SIMS}, {BEST} SELECT id_a, id_b, round(score, 9) AS score FROM best WHERE ra = 1 AND rb = 1")
def _(t):
    return ln.mutual_best(rounded_scores(t), "id", "score", 0.8)


THRESHOLDS = [0.6, 0.7, 0.8, 0.9, 0.95]


PRECISION = f"""COUNT(*) FILTER (WHERE score >= threshold) AS n_links, COUNT(*) FILTER (WHERE score >= threshold AND id_a = id_b) AS n_true_links,
ROUND(COUNT(*) FILTER (WHERE score >= threshold AND id_a = id_b) / nullif(COUNT(*) FILTER (WHERE score >= threshold), 0), 9) AS "precision", ROUND(COUNT(*) FILTER (WHERE score >= threshold AND id_a = id_b) / (SELECT COUNT(*) FROM b), 9) AS recall"""


def precision_recall(t, specs):
    out = ln.link_scores(scored(t, specs).select("id_a", "id_b", F.round("score", 9).alias("score")), "id", "score", THRESHOLDS, people(t)[1].count())
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall")})


@query("n9_precision_recall", HEAD + f""", {SIMS}, r AS (SELECT round(score, 9) AS score, id_a, id_b FROM scored) SELECT threshold, {PRECISION}
FROM r, (SELECT unnest({THRESHOLDS})::DOUBLE AS threshold) GROUP BY threshold""")
def _(t):
    return precision_recall(t, SPECS)


# The same links when names are compared by another distance.
METHODS = ("jaro_winkler", "levenshtein", "exact")
METHOD_SQL = {
    "jaro_winkler": "jaro_winkler_similarity({f}_a, {f}_b)",
    "levenshtein": "1 - levenshtein({f}_a, {f}_b)::DOUBLE / greatest(length({f}_a), length({f}_b))",
    "exact": "({f}_a = {f}_b)::INT",
}


@query("n9_distance_sensitivity", HEAD + ", r AS (" + " UNION ALL ".join(
    f"""SELECT '{m}' AS method, id_a, id_b, round(({METHOD_SQL[m].format(f='firstname')} + {METHOD_SQL[m].format(f='lastname')}
    + pow(2, -pow(abs(birthyear_a - birthyear_b) / 2.0, 2))) / 3, 9) AS score FROM pairs""" for m in METHODS)
    + f") SELECT method, threshold, {PRECISION} FROM r, (SELECT unnest({THRESHOLDS})::DOUBLE AS threshold) GROUP BY method, threshold")
def _(t):
    out = None
    for method in METHODS:
        specs = [ln.Comparison("firstname", method), ln.Comparison("lastname", method), SPECS[2]]
        rows = precision_recall(t, specs).withColumn("method", F.lit(method))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("n9_key_set_sensitivity", f"WITH {A}, {B_DUCK}, " + ", ".join(
    f"k{i} AS (SELECT '{'+'.join(ks)}' AS key_set, COUNT(*) AS n_links, COUNT(*) FILTER (WHERE a.id = b.id) AS n_true FROM a JOIN b ON {' AND '.join(f'a.{k} = b.{k}' for k in ks)})"
    for i, ks in enumerate([KEYS, KEYS[:3], ["lastname", "birthyear", "zipcode"]])) + " SELECT * FROM k0 UNION ALL SELECT * FROM k1 UNION ALL SELECT * FROM k2")
def _(t):
    a, b = people(t)
    out = None
    for ks in (KEYS, KEYS[:3], ["lastname", "birthyear", "zipcode"]):
        # Counts per key on each side multiply to the number of links; no link is formed.
        total = ln.block_report(a, b, ks).agg(F.sum("n_pairs").alias("n_links"))
        same = a.join(b, ["id", *ks], "left_semi").agg(F.count(F.lit(1)).alias("n_true"))
        row = total.withColumn("__k", F.lit(1)).join(same.withColumn("__k", F.lit(1)), "__k").drop("__k")
        row = row.withColumn("key_set", F.lit("+".join(ks)))
        out = row if out is None else out.unionByName(row)
    return out
