"""Regression and experiments (inventory I0 to I19, I30 to I36, F8, F9, E4 to E6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions.distributions import normal_quantile
from civicframe.functions.hashing import hash48, hash_unit, sql_hash48, sql_hash48_second
from civicframe.operators import experiments as ex
from civicframe.operators import regression as reg
from civicframe.operators import relational as rel
from civicframe.operators import timeseries as ts
from civicframe.plans import views
from civicframe.plans.oracle_text import last_coefficient, two_regressors
from civicframe.plans.registry import query
from civicframe.plans.views import USERS_DUCK, with_views

SPACE = "281474976710656"


def over_users(body: str, *more: str) -> str:
    return with_views(body, USERS_DUCK, *more)


def rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ---------------------------------------------------------------- least squares

@query("i1_simple_ols", """SELECT term, ROUND(estimate, 4) AS estimate, ROUND(std_error, 4) AS std_error, n, ROUND(r2, 9) AS r2 FROM (
SELECT 'quantity' AS term, regr_slope(l_extendedprice, l_quantity) AS estimate, SQRT(regr_syy(l_extendedprice, l_quantity) * (1 - regr_r2(l_extendedprice, l_quantity)) / (COUNT(*) - 2) / regr_sxx(l_extendedprice, l_quantity)) AS std_error, COUNT(*) AS n, regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem
UNION ALL SELECT 'Intercept', regr_intercept(l_extendedprice, l_quantity), SQRT(regr_syy(l_extendedprice, l_quantity) * (1 - regr_r2(l_extendedprice, l_quantity)) / (COUNT(*) - 2) * (1.0 / COUNT(*) + AVG(l_quantity) * AVG(l_quantity) / regr_sxx(l_extendedprice, l_quantity))), COUNT(*), regr_r2(l_extendedprice, l_quantity) FROM lineitem)""")
def _(t):
    table = reg.ols(t.lineitem, "l_extendedprice", {"quantity": F.col("l_quantity")})
    return rounded(table, 4, "estimate", "std_error").withColumn("r2", F.round("r2", 9)).drop("statistic", "p_value")


@query("i2_polynomial_ols", f"""SELECT ROUND({two_regressors('p_retailprice', 'p_size', 'p_size * p_size')}, 6) AS linear, ROUND({two_regressors('p_retailprice', 'p_size * p_size', 'p_size')}, 6) AS quadratic FROM part""")
def _(t):
    beta = reg.ols(t.part, "p_retailprice", {"linear": F.col("p_size"), "quadratic": F.col("p_size") * F.col("p_size")})
    return beta.agg(*[F.round(F.max(F.when(F.col("term") == c, F.col("estimate"))), 6).alias(c) for c in ("linear", "quadratic")])


@query("i2_log_response", """SELECT ROUND(regr_slope(LN(o_totalprice), year(o_orderdate)), 9) AS estimate, ROUND(SQRT(regr_syy(LN(o_totalprice), year(o_orderdate)) * (1 - regr_r2(LN(o_totalprice), year(o_orderdate))) / (COUNT(*) - 2) / regr_sxx(LN(o_totalprice), year(o_orderdate))), 9) AS std_error FROM orders""")
def _(t):
    table = reg.ols(t.orders, F.log("o_totalprice"), {"year": F.year("o_orderdate")}).filter("term = 'year'")
    return rounded(table, 9, "estimate", "std_error").select("estimate", "std_error")


ORDER_MODEL_SQL = """(SELECT o_totalprice / 1000.0 AS price, year(o_orderdate) - 1998.0 AS yr, (o_orderstatus = 'F')::INT AS closed,
(o_orderpriority = '2-HIGH')::INT AS p2, (o_orderpriority = '3-MEDIUM')::INT AS p3, (o_orderpriority = '4-NOT SPECIFIED')::INT AS p4, (o_orderpriority = '5-LOW')::INT AS p5,
{m} AS month FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"""
ORDER_MODEL_SQL = ORDER_MODEL_SQL.format(m="month(o_orderdate) * 1.0")


def order_model(t):
    """Price on closed x month, priority dummies, year and its square; trained before 2000."""
    rows = t.orders.withColumns({
        "price": F.col("o_totalprice") / 1000.0, "yr": F.year("o_orderdate") - 1998.0,
        "closed": (F.col("o_orderstatus") == "F").cast("int"), "month": F.month("o_orderdate") * 1.0})
    terms = {
        **reg.factor("o_orderpriority", reg.levels(rows, "o_orderpriority")),
        "yr": F.col("yr"), "yr2": F.col("yr") * F.col("yr"), "closed": F.col("closed"), "month": F.col("month"),
        "closed:month": F.col("closed") * F.col("month")}
    early = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    return rows, terms, early


@query("i3_interaction_ols", last_coefficient(
    ORDER_MODEL_SQL, "price", ["p2", "p3", "p4", "p5", "yr", "yr * yr", "closed", "month", "closed * month"]))
def _(t):
    rows, terms, early = order_model(t)
    table = reg.ols(rows.filter(early), "price", terms).filter("term = 'closed:month'")
    return rounded(table, 6, "estimate", "std_error").select("estimate", "std_error")


def predictions_sql(key: str, y: str, xs: list[str], base: str, train: str) -> str:
    """Predictions by successive residuals: slopes and means come from the training rows, all rows are transformed."""
    k = len(xs)
    steps = [f"r0 AS (SELECT {key}, {train} AS tr, CAST({y} AS DOUBLE) AS y0, CAST({y} AS DOUBLE) AS y, " + ", ".join(
        f"CAST({x} AS DOUBLE) AS x{i}" for i, x in enumerate(xs)) + f" FROM {base})"]
    for i in range(k):
        rest = ["y"] + [f"x{j}" for j in range(i + 1, k)]
        slopes = ", ".join(f"regr_slope({c}, x{i}) FILTER (WHERE tr) AS b_{c}" for c in rest)
        moved = ", ".join(f"{c} - b_{c} * (x{i} - m) AS {c}" for c in rest)
        steps.append(f"r{i + 1} AS MATERIALIZED (SELECT {key}, tr, y0, {moved} FROM r{i}, (SELECT {slopes}, AVG(x{i}) FILTER (WHERE tr) AS m FROM r{i}) AS f{i})")
    return "WITH " + ", ".join(steps) + (
        f" SELECT {key}, y0 AS {y}, ROUND(y0 - y + m, 6) AS predicted FROM r{k}, (SELECT AVG(y) FILTER (WHERE tr) AS m FROM r{k}) AS f WHERE NOT tr")


ALL_ORDERS_SQL = ORDER_MODEL_SQL.replace("(SELECT ", "(SELECT o_orderkey, o_orderdate, ", 1).replace(" WHERE o_orderdate < TIMESTAMP '2000-01-01'", "")


@query("i3_predict_test", predictions_sql(
    "o_orderkey", "price", ["p2", "p3", "p4", "p5", "yr", "yr * yr", "closed", "month", "closed * month"], ALL_ORDERS_SQL, "o_orderdate < TIMESTAMP '2000-01-01'"))
def _(t):
    rows, terms, early = order_model(t)
    beta = reg.coefficients(rows.filter(early), "price", terms)
    return rows.filter(~early).select("o_orderkey", "price", F.round(reg.linear_predictor(beta, terms), 6).alias("predicted"))


@query("i4_tidy_models", """SELECT model, term, ROUND(estimate, 6) AS estimate FROM (
SELECT 'size' AS model, 'x' AS term, regr_slope(p_retailprice, p_size) AS estimate FROM part UNION ALL SELECT 'size', 'Intercept', regr_intercept(p_retailprice, p_size) FROM part
UNION ALL SELECT 'log', 'x', regr_slope(LN(p_retailprice), p_size) FROM part UNION ALL SELECT 'log', 'Intercept', regr_intercept(LN(p_retailprice), p_size) FROM part)""")
def _(t):
    x = {"x": F.col("p_size")}
    models = {"size": reg.ols(t.part, "p_retailprice", x), "log": reg.ols(t.part, F.log("p_retailprice"), x)}
    return reg.tidy_models(models).select("model", "term", F.round("estimate", 6).alias("estimate"))


BLOCKED = """blocked AS (SELECT u.*, CAST(1 + len(list_filter(c, lambda x: baseline > x)) AS INT) AS block FROM users u,
(SELECT quantile_cont(baseline, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS c FROM users))"""
BLOCK_DUMMIES = [f"(block = {b})::INT" for b in range(2, 11)]


def blocked_users(t):
    return rel.value_ntile(views.users(t, staged=True), "baseline", 10, "block")


@query("i5_cluster_robust_ols", last_coefficient(
    "blocked", "converted", [*BLOCK_DUMMIES, "baseline", "pre_spend", "treat"], cluster="cluster_id", digits=9,
    with_clause=over_users("", BLOCKED).rstrip() + ",\n"))
def _(t):
    users = blocked_users(t)
    terms = {"baseline": F.col("baseline"), "pre_spend": F.col("pre_spend"), "treat": F.col("treat")}
    table = reg.ols_absorbed(users, "converted", terms, "block", "cluster_id", "cluster").filter("term = 'treat'")
    return rounded(table, 9, "estimate", "std_error").select("estimate", "std_error")


@query("i6_difference_in_means", over_users(" UNION ALL ".join(
    f"""SELECT '{y}' AS outcome, COUNT(*) FILTER (WHERE treat = 1) AS n1, COUNT(*) FILTER (WHERE treat = 0) AS n0,
ROUND(AVG({y}) FILTER (WHERE treat = 1) - AVG({y}) FILTER (WHERE treat = 0), 6) AS effect,
ROUND(SQRT(VAR_SAMP({y}) FILTER (WHERE treat = 1) / COUNT(*) FILTER (WHERE treat = 1) + VAR_SAMP({y}) FILTER (WHERE treat = 0) / COUNT(*) FILTER (WHERE treat = 0)), 6) AS std_error FROM users"""
    for y in ("spend", "converted", "n_orders"))))
def _(t):
    out = ex.ate(views.users(t), "treat", ["spend", "converted", "n_orders"])
    return rounded(out, 6, "effect", "std_error").select("outcome", "n1", "n0", "effect", "std_error")


@query("i7_standardised_difference", over_users(" UNION ALL ".join(
    f"""SELECT '{y}' AS covariate, ROUND(AVG({y}) FILTER (WHERE treat = 1), 6) AS mean1, ROUND(AVG({y}) FILTER (WHERE treat = 0), 6) AS mean0,
ROUND((AVG({y}) FILTER (WHERE treat = 1) - AVG({y}) FILTER (WHERE treat = 0)) / SQRT((VAR_SAMP({y}) FILTER (WHERE treat = 1) + VAR_SAMP({y}) FILTER (WHERE treat = 0)) / 2), 6) AS smd FROM users"""
    for y in ("baseline", "pre_spend"))))
def _(t):
    return rounded(ex.smd(views.users(t), "treat", ["baseline", "pre_spend"]), 6, "mean1", "mean0", "smd")


@query("i8_hash_assignment", f"""SELECT c_custkey, CAST({sql_hash48('arm-7', 'c_custkey')} / {SPACE}.0 < 0.3 AS INT) AS treat FROM customer""")
def _(t):
    return ex.assign(t.customer.select("c_custkey"), "c_custkey", "arm-7", 0.3)


@query("i8_blocked_assignment", over_users(f"""SELECT user_id, block, CASE WHEN ROW_NUMBER() OVER (PARTITION BY block ORDER BY {sql_hash48('block-1', 'user_id')}, user_id)
<= FLOOR(COUNT(*) OVER (PARTITION BY block) / 2) THEN 1 ELSE 0 END AS treat FROM blocked""", BLOCKED))
def _(t):
    users = blocked_users(t).select("user_id", "block")
    return ex.assign_blocked(users, "user_id", "block", "block-1")


def rep_hash(seed: str, key: str, rep: str = "rep") -> str:
    return f"(({sql_hash48(seed, key)} + {rep} * {sql_hash48_second(seed, key)}) % {SPACE})"


@query("i9_aa_test", over_users(f"""SELECT CAST(rep AS INT) AS rep, ROUND(AVG(spend) FILTER (WHERE r <= FLOOR(n / 2)) - AVG(spend) FILTER (WHERE r > FLOOR(n / 2)), 6) AS aa_effect FROM (
SELECT rep, spend, ROW_NUMBER() OVER (PARTITION BY rep ORDER BY {rep_hash('aa', 'user_id')}, user_id) AS r, COUNT(*) OVER (PARTITION BY rep) AS n
FROM users, range(1, 201) AS g(rep) WHERE treat = 0) GROUP BY rep"""))
def _(t):
    control = views.users(t, staged=True).filter("treat = 0")
    return rounded(ex.aa_test(control, "user_id", "spend", 200, "aa"), 6, "aa_effect")


@query("i10_placebo_outcome_hc2", last_coefficient(
    "blocked", "pre_spend", [*BLOCK_DUMMIES, "treat"], robust=True, with_clause=over_users("", BLOCKED).rstrip() + ",\n"))
def _(t):
    users = blocked_users(t)
    table = reg.ols_absorbed(users, "pre_spend", {"treat": F.col("treat")}, "block", cov="hc2").filter("term = 'treat'")
    return rounded(table, 6, "estimate", "std_error").select("estimate", "std_error")


PERMUTED = f"""perm AS (SELECT rep, spend, baseline, block, CASE WHEN ROW_NUMBER() OVER (PARTITION BY rep{{by}} ORDER BY {rep_hash('perm', 'user_id')}, user_id)
<= SUM(treat) OVER (PARTITION BY rep{{by}}) THEN 1 ELSE 0 END AS d FROM blocked, range(1, 501) AS g(rep))"""


@query("i11_permutation_test", over_users("""SELECT ROUND(tau, 6) AS tau_hat, COUNT(*) AS n_permutations, ROUND((1.0 + COUNT(*) FILTER (WHERE abs(tau_b) >= abs(tau))) / (COUNT(*) + 1.0), 9) AS p_value
FROM (SELECT rep, AVG(spend) FILTER (WHERE d = 1) - AVG(spend) FILTER (WHERE d = 0) AS tau_b FROM perm GROUP BY rep),
(SELECT AVG(spend) FILTER (WHERE treat = 1) - AVG(spend) FILTER (WHERE treat = 0) AS tau FROM users) GROUP BY tau""",
    BLOCKED, PERMUTED.format(by=", block")))
def _(t):
    users = blocked_users(t)
    out = ex.permutation_test(users, "user_id", "spend", "treat", 500, "perm", within=["block"])
    return rounded(out, 6, "tau_hat").withColumn("p_value", F.round("p_value", 9))


@query("i11_permutation_coefficients", over_users(f"SELECT CAST(rep AS INT) AS rep, ROUND({two_regressors('spend', 'd', 'baseline')}, 6) AS tau FROM perm GROUP BY rep",
       BLOCKED, PERMUTED.format(by="")))
def _(t):
    users = blocked_users(t)
    out = ex.permutation_effects(users, "user_id", "spend", "treat", 500, "perm", controls=["baseline"])
    return rounded(out, 6, "tau")


MEASURED = f"""measured AS (SELECT *, baseline + (CAST({sql_hash48('noise', 'user_id')} AS DOUBLE) / {SPACE}.0 - 0.5) * 4 AS x_obs, {sql_hash48('valid', 'user_id')} % 5 = 0 AS valid FROM users)"""


def measured_users(t):
    return views.users(t, staged=True).withColumns({
        "x_obs": F.col("baseline") + (hash_unit("noise", "user_id") - 0.5) * 4, "valid": hash48("valid", "user_id") % 5 == 0})


@query("i12_regression_calibration", over_users("""SELECT model, ROUND(tau, 6) AS tau FROM (
SELECT 'true' AS model, {a} AS tau FROM measured UNION ALL SELECT 'naive', {b} FROM measured
UNION ALL SELECT 'calibrated', {c} FROM (SELECT *, (SELECT regr_intercept(baseline, x_obs) FROM measured WHERE valid) + (SELECT regr_slope(baseline, x_obs) FROM measured WHERE valid) * x_obs AS x_hat FROM measured))""".format(
    a=two_regressors("spend", "treat", "baseline"), b=two_regressors("spend", "treat", "x_obs"), c=two_regressors("spend", "treat", "x_hat")), MEASURED))
def _(t):
    table = ex.regression_calibration(measured_users(t), "spend", "treat", "baseline", "x_obs", F.col("valid"))
    return table.filter("term = 'treat'").select("model", F.round("estimate", 6).alias("tau"))


SIGMAS = [0.0, 0.5, 1.0, 1.5, 2.0]


def noise_sql(seed: str) -> str:
    u1 = f"(1.0 - {sql_hash48(seed, 'rep', 'user_id')} / {SPACE}.0)"
    u2 = f"({sql_hash48_second(seed, 'rep', 'user_id')} / {SPACE}.0)"
    return f"(SQRT(-2.0 * LN({u1})) * COS(2.0 * PI() * {u2}))"


@query("i13_noise_sweep", over_users(f"""SELECT sigma, COUNT(*) AS n_fits, ROUND(AVG(tau), 6) AS mean_estimate, ROUND(quantile_cont(tau, 0.025), 6) AS lo, ROUND(quantile_cont(tau, 0.975), 6) AS hi FROM (
SELECT sigma, rep, {two_regressors('spend', 'treat', 'x_obs')} AS tau FROM (SELECT sigma, rep, spend, treat, baseline + sigma * {noise_sql('sweep')} AS x_obs
FROM users, range(1, 31) AS g(rep), (SELECT unnest({SIGMAS})::DOUBLE AS sigma)) GROUP BY sigma, rep) GROUP BY sigma"""))
def _(t):
    out = ex.noise_sweep(views.users(t), "user_id", "spend", "treat", "baseline", SIGMAS, 30, "sweep")
    return rounded(out, 6, "mean_estimate", "lo", "hi")


TAKEUP = f"taken AS (SELECT *, CASE WHEN treat = 1 AND {sql_hash48('take', 'user_id')} % 10 < 7 THEN 1 ELSE 0 END AS took FROM users)"


def takeup_users(t):
    return views.users(t).withColumn("took", F.when((F.col("treat") == 1) & (hash48("take", "user_id") % 10 < 7), 1).otherwise(0))


@query("i14_itt_and_tot", over_users("""SELECT ROUND(itt, 6) AS itt, ROUND(fs, 6) AS first_stage, ROUND(itt / fs, 6) AS tot FROM (SELECT AVG(spend) FILTER (WHERE treat = 1) - AVG(spend) FILTER (WHERE treat = 0) AS itt,
AVG(took) FILTER (WHERE treat = 1) - AVG(took) FILTER (WHERE treat = 0) AS fs FROM taken)""", TAKEUP))
def _(t):
    return rounded(ex.wald(takeup_users(t), "treat", "took", "spend"), 6, "itt", "first_stage", "tot")


@query("i14_two_stage", over_users("""SELECT ROUND({a} / {b}, 6) AS tot FROM taken""".format(
    a=two_regressors("spend", "treat", "baseline"), b=two_regressors("took", "treat", "baseline")), TAKEUP))
def _(t):
    beta = ex.two_stage(takeup_users(t), "treat", "took", "spend", {"baseline": F.col("baseline")})
    return beta.filter("term = 'took'").select(F.round("estimate", 6).alias("tot"))


@query("i15_bh_adjust", f"""WITH p AS (SELECT p_partkey, pow({sql_hash48('p', 'p_partkey')} / {SPACE}.0, 3) AS p FROM part),
r AS (SELECT *, p * COUNT(*) OVER () / ROW_NUMBER() OVER (ORDER BY p, p_partkey) AS raw, ROW_NUMBER() OVER (ORDER BY p, p_partkey) AS rk FROM p)
SELECT p_partkey, ROUND(LEAST(1.0, MIN(raw) OVER (ORDER BY rk DESC)), 9) AS p_adjusted FROM r""")
def _(t):
    rows = t.part.select("p_partkey", F.pow(hash_unit("p", "p_partkey"), 3).alias("p"))
    return rounded(ex.bh_adjust(rows, "p", tie=["p_partkey"]), 9, "p_adjusted").drop("p")


# Two-sided normal tail by the series of the distribution function; the terms are powers over double factorials.
TAIL_SQL = """2 * (0.5 - exp(-z * z / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 200), lambda k:
  CASE WHEN z = 0 THEN 0 ELSE exp((2 * k + 1) * ln(abs(z)) - lgamma(2 * k + 2) + k * ln(2) + lgamma(k + 1)) END)))"""
OUTCOMES = ("spend", "converted", "n_orders", "pre_spend", "baseline")


@query("i15_many_outcomes", over_users("SELECT outcome, ROUND(effect, 6) AS effect, ROUND(std_error, 6) AS std_error, ROUND(z, 6) AS z, ROUND(p, 9) AS p_value, ROUND(least(1, MIN(raw) OVER (ORDER BY rk DESC)), 9) AS p_adjusted, least(1, MIN(raw) OVER (ORDER BY rk DESC)) <= 0.05 AS significant FROM r", "e AS (" + " UNION ALL ".join(
    f"SELECT '{y}' AS outcome, AVG({y}) FILTER (WHERE treat = 1) - AVG({y}) FILTER (WHERE treat = 0) AS effect, sqrt(var_samp({y}) FILTER (WHERE treat = 1) / COUNT({y}) FILTER (WHERE treat = 1) + var_samp({y}) FILTER (WHERE treat = 0) / COUNT({y}) FILTER (WHERE treat = 0)) AS std_error FROM users" for y in OUTCOMES)
    + ")", "zs AS (SELECT *, effect / std_error AS z FROM e)", f"ps AS (SELECT *, {TAIL_SQL} AS p FROM zs)",
    "r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY p, outcome) AS rk, p * COUNT(*) OVER () / ROW_NUMBER() OVER (ORDER BY p, outcome) AS raw FROM ps)"))
def _(t):
    out = ex.many_outcomes(views.users(t), "treat", list(OUTCOMES))
    return rounded(rounded(out, 6, "effect", "std_error", "z"), 9, "p_value", "p_adjusted")


@query("i16_cluster_exposure", over_users("""SELECT user_id, ROUND(AVG(treat) OVER w, 9) AS share_treated, ROUND((SUM(treat) OVER w - treat) / (COUNT(*) OVER w - 1), 9) AS share_others
FROM users WINDOW w AS (PARTITION BY cluster_id)"""))
def _(t):
    out = ex.cluster_exposure(views.users(t), "cluster_id", "treat")
    return rounded(out, 9, "share_treated", "share_others").select("user_id", "share_treated", "share_others")


@query("i17_subgroup_effects", over_users("""SELECT platform, ROUND(AVG(spend) FILTER (WHERE treat = 1) - AVG(spend) FILTER (WHERE treat = 0), 6) AS effect, ROUND(COUNT(*) * 1.0 / (SELECT COUNT(*) FROM users), 9) AS weight FROM users GROUP BY platform"""))
def _(t):
    out = ex.subgroup_effects(views.users(t), "treat", "spend", "platform")
    return out.select("platform", F.round("effect", 6).alias("effect"), F.round("weight", 9).alias("weight"))


@query("i17_weighted_effect", over_users("""SELECT ROUND(SUM(effect * w), 6) AS effect FROM (SELECT platform, AVG(spend) FILTER (WHERE treat = 1) - AVG(spend) FILTER (WHERE treat = 0) AS effect, COUNT(*) * 1.0 / (SELECT COUNT(*) FROM users) AS w FROM users GROUP BY platform)"""))
def _(t):
    return ex.weighted_effect(ex.subgroup_effects(views.users(t), "treat", "spend", "platform")).select(F.round("effect", 6).alias("effect"))


@query("i18_minimum_detectable", over_users(f"""SELECT 'spend' AS outcome, ROUND({normal_quantile(0.975) + normal_quantile(0.8)!r} * SQRT(VAR_SAMP(spend) FILTER (WHERE treat = 1) / COUNT(*) FILTER (WHERE treat = 1)
+ VAR_SAMP(spend) FILTER (WHERE treat = 0) / COUNT(*) FILTER (WHERE treat = 0)), 6) AS mde FROM users"""))
def _(t):
    return ex.minimum_detectable(views.users(t), "treat", ["spend"]).select("outcome", F.round("mde", 6).alias("mde"))


ARM = f"CASE WHEN {sql_hash48('arm', 'user_id')} % 2 = 0 THEN 1 ELSE 0 END"


@query("i19_sequential_monitoring", f"""WITH d AS (SELECT CAST(ts AS DATE) AS day, {ARM} AS treat, COUNT(*) AS n, SUM(value) AS s, SUM(value * value) AS ss FROM events GROUP BY 1, 2),
w AS (SELECT day, SUM(n) FILTER (WHERE treat = 1) AS n1, SUM(s) FILTER (WHERE treat = 1) AS s1, SUM(ss) FILTER (WHERE treat = 1) AS q1, SUM(n) FILTER (WHERE treat = 0) AS n0, SUM(s) FILTER (WHERE treat = 0) AS s0, SUM(ss) FILTER (WHERE treat = 0) AS q0 FROM d GROUP BY day),
c AS (SELECT day, SUM(n1) OVER o AS n1, SUM(s1) OVER o AS s1, SUM(q1) OVER o AS q1, SUM(n0) OVER o AS n0, SUM(s0) OVER o AS s0, SUM(q0) OVER o AS q0 FROM w WINDOW o AS (ORDER BY day))
SELECT CAST(day AS VARCHAR) AS day, ROUND(s1 / n1 - s0 / n0, 6) AS effect, ROUND((s1 / n1 - s0 / n0) / SQRT((q1 - s1 * s1 / n1) / (n1 - 1) / n1 + (q0 - s0 * s0 / n0) / (n0 - 1) / n0), 6) AS z FROM c""")
def _(t):
    rows = t.events.select(F.to_date("ts").alias("day"), F.when(hash48("arm", "user_id") % 2 == 0, 1).otherwise(0).alias("treat"), "value")
    out = ex.sequential_z(rows, "day", "treat", "value")
    return rounded(out, 6, "effect", "z").select(F.col("day").cast("string").alias("day"), "effect", "z")


@query("i30_two_way_fixed_effects", f"""WITH p AS (SELECT c_nationkey AS unit, CAST(year(o_orderdate) AS INT) AS yr, AVG(o_totalprice) / 1000 AS y FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
d AS (SELECT *, CASE WHEN {sql_hash48('unit', 'unit')} % 2 = 0 AND yr >= 1998 THEN 1.0 ELSE 0.0 END AS d FROM p),
f AS (SELECT unit, y - AVG(y) OVER (PARTITION BY unit) - AVG(y) OVER (PARTITION BY yr) + AVG(y) OVER () AS y, d - AVG(d) OVER (PARTITION BY unit) - AVG(d) OVER (PARTITION BY yr) + AVG(d) OVER () AS d FROM d),
b AS (SELECT SUM(d * y) / SUM(d * d) AS b, SUM(d * d) AS dd FROM f),
s AS (SELECT unit, SUM(d * (y - b * d)) AS s, MAX(b) AS b, MAX(dd) AS dd FROM f, b GROUP BY unit)
SELECT ROUND(MAX(b), 6) AS estimate, ROUND(SQRT(SUM(s * s) * COUNT(*) / (COUNT(*) - 1)) / MAX(dd), 6) AS std_error, COUNT(*) AS n_units FROM s""")
def _(t):
    panel = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_nationkey").alias("unit"), F.year("o_orderdate").alias("yr")).agg((F.avg("o_totalprice") / 1000).alias("y"))
    treated = (hash48("unit", "unit") % 2 == 0) & (F.col("yr") >= 1998)
    out = ts.two_way_effect(panel.withColumn("d", treated.cast("double")), "unit", "yr", "y", "d")
    return rounded(out, 6, "estimate", "std_error")


# The same panel by quarter without a fifth of its cells.
GAPS = f"""WITH p AS (SELECT c_nationkey AS unit, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) AS INT) AS t, AVG(o_totalprice) / 1000 AS y FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
f0 AS (SELECT *, CASE WHEN {sql_hash48('unit', 'unit')} % 2 = 0 AND t >= 7992 THEN 1.0 ELSE 0.0 END AS d FROM p WHERE {sql_hash48('gap', 'unit', 't')} % 5 <> 0)"""
SWEEPS = 12


def sweeps_sql(n: int) -> str:
    parts = []
    for i in range(n):
        parts.append(f"g{i} AS (SELECT unit, t, y - AVG(y) OVER (PARTITION BY unit) AS y, d - AVG(d) OVER (PARTITION BY unit) AS d FROM f{i}), "
                     f"f{i + 1} AS MATERIALIZED (SELECT unit, t, y - AVG(y) OVER (PARTITION BY t) AS y, d - AVG(d) OVER (PARTITION BY t) AS d FROM g{i})")
    return ", ".join(parts)


@query("i30_panel_with_gaps", GAPS + ", " + sweeps_sql(SWEEPS) + f""", b AS (SELECT SUM(d * y) / SUM(d * d) AS b, SUM(d * d) AS dd FROM f{SWEEPS}),
s AS (SELECT unit, SUM(d * (y - b * d)) AS s, MAX(b) AS b, MAX(dd) AS dd FROM f{SWEEPS}, b GROUP BY unit)
SELECT ROUND(MAX(b), 6) AS estimate, ROUND(SQRT(SUM(s * s) * COUNT(*) / (COUNT(*) - 1)) / MAX(dd), 6) AS std_error, COUNT(*) AS n_units FROM s""")
def _(t):
    panel = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_nationkey").alias("unit"), (F.year("o_orderdate") * 4 + F.quarter("o_orderdate")).alias("t")).agg((F.avg("o_totalprice") / 1000).alias("y"))
    panel = panel.filter(hash48("gap", "unit", "t") % 5 != 0)
    treated = (hash48("unit", "unit") % 2 == 0) & (F.col("t") >= 7992)
    out = ts.two_way_effect(panel.withColumn("d", treated.cast("double")), "unit", "t", "y", "d", sweeps=SWEEPS)
    return rounded(out, 6, "estimate", "std_error")


@query("i31_kaplan_meier", f"""WITH u AS (SELECT user_id, {ARM} AS treat, MIN(CASE WHEN event_type = 'purchase' AND value > 60 THEN CAST(ts AS DATE) - DATE '2024-01-01' END) AS t FROM events GROUP BY user_id),
r AS (SELECT treat, COALESCE(t, 30) AS day, (t IS NOT NULL)::INT AS e FROM u),
c AS (SELECT treat, day, SUM(e)::BIGINT AS events, COUNT(*) AS leaving FROM r GROUP BY 1, 2),
k AS (SELECT *, SUM(leaving) OVER (PARTITION BY treat) - COALESCE(SUM(leaving) OVER (PARTITION BY treat ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_risk FROM c)
SELECT treat, CAST(day AS INT) AS day, events, CAST(at_risk AS BIGINT) AS at_risk, ROUND(EXP(SUM(LN(1 - events / at_risk)) OVER (PARTITION BY treat ORDER BY day)), 9) AS survival FROM k""")
def _(t):
    hit = (F.col("event_type") == "purchase") & (F.col("value") > 60)
    first = t.events.groupBy("user_id").agg(F.min(F.when(hit, F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")))).alias("t"))
    rows = first.select(F.when(hash48("arm", "user_id") % 2 == 0, 1).otherwise(0).alias("treat"),
                        F.coalesce("t", F.lit(30)).alias("day"), F.col("t").isNotNull().cast("int").alias("e"))
    return rounded(ts.kaplan_meier(rows, "day", "e", ["treat"]), 9, "survival")


@query("i32_composition_drift", """WITH c AS (SELECT CAST(year(o_orderdate) AS INT) AS wave, o_orderpriority AS level, COUNT(*) AS n FROM orders GROUP BY 1, 2),
s AS (SELECT *, n * 1.0 / SUM(n) OVER (PARTITION BY wave) AS share FROM c)
SELECT s.wave, s.level, s.n, ROUND(s.share, 9) AS share, ROUND(s.share - b.share, 9) AS difference, ROUND((s.share - b.share) * LN(s.share / b.share), 9) AS drift FROM s JOIN s b ON s.level = b.level AND b.wave = 1995""")
def _(t):
    rows = t.orders.select(F.year("o_orderdate").alias("wave"), F.col("o_orderpriority").alias("level"))
    out = ex.composition_drift(rows, "wave", "level", 1995)
    return rounded(out, 9, "share", "difference", "drift").drop("reference_share")


@query("i32_post_stratify", """SELECT ROUND(AVG(c_acctbal), 6) AS raw_mean, ROUND((SELECT SUM(m * 0.2) FROM (SELECT AVG(c_acctbal) AS m FROM customer GROUP BY c_mktsegment)), 6) AS weighted_mean FROM customer""")
def _(t):
    targets = dict.fromkeys(["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], 0.2)
    return rounded(ex.post_stratify(t.customer, "c_mktsegment", targets, "c_acctbal"), 6, "raw_mean", "weighted_mean")


@query("i33_coder_agreement", """WITH a AS (SELECT COUNT(*) AS n, AVG((quality = toxic)::INT) AS po, AVG(quality) * AVG(toxic) + (1 - AVG(quality)) * (1 - AVG(toxic)) AS pe FROM labels)
SELECT n, ROUND(po, 9) AS agreement, ROUND((po - pe) / (1 - pe), 9) AS kappa FROM a""")
def _(t):
    return rounded(ex.agreement(t.labels, "quality", "toxic"), 9, "agreement", "kappa")


@query("i34_score_difference_table", """WITH s AS (SELECT n_name AS state, CASE WHEN l_returnflag = 'A' THEN 'first' WHEN l_returnflag = 'R' THEN 'second' ELSE 'third' END AS side, 10 + 0.001 * l_extendedprice AS score
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
w AS (SELECT state, AVG(score) FILTER (WHERE side = 'first') AS first_score, AVG(score) FILTER (WHERE side = 'second') AS second_score FROM s GROUP BY state)
SELECT state, ROUND(first_score, 6) AS first_score, ROUND(second_score, 6) AS second_score, ROUND(first_score - second_score, 6) AS difference FROM w WHERE state NOT IN ('NATION_0', 'NATION_1')""")
def _(t):
    from civicframe.operators.prep import override_in_order

    side = override_in_order(F.lit("third"), [(F.col("l_returnflag") == "A", F.lit("first")), (F.col("l_returnflag") == "R", F.lit("second"))])
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    scored = rows.filter(~F.col("n_name").isin("NATION_0", "NATION_1")).select(F.col("n_name").alias("state"), side.alias("side"), (10 + 0.001 * F.col("l_extendedprice")).alias("score"))
    means = scored.groupBy("state", "side").agg(F.avg("score").alias("score"))
    wide = rel.pivot_first(means, ["state"], "side", ["first", "second"], ["score"], "{by}_{value}").distinct()
    out = wide.withColumn("difference", F.col("first_score") - F.col("second_score"))
    return rounded(out, 6, "first_score", "second_score", "difference")


SPECS = {"none": [], "baseline": ["baseline"], "both": ["baseline", "pre_spend"]}


@query("i35_specification_grid", over_users(f"""SELECT spec, ROUND(b, 6) AS estimate FROM (SELECT 'none' AS spec, regr_slope(spend, treat) AS b FROM users UNION ALL SELECT 'baseline', {two_regressors('spend', 'treat', 'baseline')} FROM users
UNION ALL (WITH s AS (SELECT (SELECT regr_slope(spend, baseline) FROM users) AS by_, (SELECT regr_slope(treat, baseline) FROM users) AS bt, (SELECT regr_slope(pre_spend, baseline) FROM users) AS bp)
SELECT 'both', {two_regressors('y', 'd', 'x')} FROM (SELECT spend - by_ * baseline AS y, treat - bt * baseline AS d, pre_spend - bp * baseline AS x FROM users, s)))"""))
def _(t):
    controls = {"baseline": F.col("baseline"), "pre_spend": F.col("pre_spend")}
    grid = reg.specification_grid(views.users(t), "spend", "treat", controls, SPECS)
    return grid.select("spec", F.round("estimate", 6).alias("estimate"))


@query("i35_bandwidth_grid", over_users(f"""SELECT h::DOUBLE AS bandwidth, 'none' AS spec, COUNT(*) AS n, ROUND(regr_slope(spend, treat), 6) AS estimate FROM users, (SELECT unnest([1.0, 2.0, 4.0, 8.0]) AS h) WHERE abs(baseline - 4) <= h GROUP BY h
UNION ALL SELECT h::DOUBLE, 'baseline', COUNT(*), ROUND({two_regressors('spend', 'treat', 'baseline')}, 6) FROM users, (SELECT unnest([1.0, 2.0, 4.0, 8.0]) AS h) WHERE abs(baseline - 4) <= h GROUP BY h"""))
def _(t):
    windows = reg.within_bandwidths(views.users(t), "baseline", 4.0, [1, 2, 4, 8])
    grid = reg.specification_grid(windows, "spend", "treat", {"baseline": F.col("baseline")}, {"none": [], "baseline": ["baseline"]}, by=["bandwidth"])
    return grid.select("bandwidth", "spec", "n", F.round("estimate", 6).alias("estimate"))


@query("i35_grid_with_adjustment")
def _(t):
    controls = {"baseline": F.col("baseline"), "pre_spend": F.col("pre_spend")}
    grid = reg.specification_grid(views.users(t), "spend", "treat", controls, SPECS, by=["platform"])
    return ex.bh_adjust(grid, "p_value", tie=["platform", "spec"])


@query("i36_p_uniformity", f"""WITH p AS (SELECT {sql_hash48('unif', 'o_orderkey')} / {SPACE}.0 AS p FROM orders), g AS (SELECT MAX(abs(r * 1.0 / n - p)) AS d FROM (SELECT p, ROW_NUMBER() OVER (ORDER BY p) AS r, COUNT(*) OVER () AS n FROM p))
SELECT CAST(LEAST(FLOOR(p * 10), 9) AS INT) AS bin, COUNT(*) AS n, ROUND(MAX(d), 9) AS max_distance FROM p, g GROUP BY 1""")
def _(t):
    return rounded(ex.uniformity(t.orders.select(hash_unit("unif", "o_orderkey").alias("p")), "p"), 9, "max_distance")


@query("f8_leave_one_period_out", """SELECT y AS year, ROUND(regr_slope(o_totalprice, month(o_orderdate)), 4) AS estimate, COUNT(*) AS n FROM orders, (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders) WHERE year(o_orderdate) <> y GROUP BY y""")
def _(t):
    rows = t.orders.withColumn("year", F.year("o_orderdate"))
    table = reg.leave_one_period_out(rows, "o_totalprice", {"month": F.month("o_orderdate")}, "year")
    return table.filter("term = 'month'").select("year", F.round("estimate", 4).alias("estimate"), "n")


@query("f9_poisson_bootstrap", over_users("""SELECT CAST(rep AS INT) AS rep, SUM(w) AS n, ROUND((SUM(w) * SUM(w * baseline * spend) - SUM(w * baseline) * SUM(w * spend)) / (SUM(w) * SUM(w * baseline * baseline) - SUM(w * baseline) * SUM(w * baseline)), 6) AS slope
FROM (SELECT rep, baseline, spend, CAST(len(list_filter([""" + ", ".join(map(repr, ex.POISSON_ONE)) + f"""], lambda c: {rep_hash('boot', 'user_id')} / {SPACE}.0 >= c)) AS DOUBLE) AS w FROM users, range(1, 101) AS g(rep)) GROUP BY rep"""))
def _(t):
    return rounded(ex.bootstrap_moments(views.users(t), "user_id", "baseline", "spend", 100, "boot"), 6, "slope")
