"""Time series (inventory I20 to I29, E6, E7, F7, C4 with growth)."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions.hashing import hash48, sql_hash48
from civicframe.operators import experiments as ex
from civicframe.operators import regression as reg
from civicframe.operators import scalable
from civicframe.operators import timeseries as ts
from civicframe.plans.registry import query

# Daily order totals (in millions) per priority, and over all orders, by day number since 1995.
DAILY = """daily AS (SELECT o_orderpriority AS series, CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS INT) AS t, SUM(o_totalprice) / 1000000.0 AS y FROM orders GROUP BY 1, 2)"""
TOTAL = """total AS (SELECT CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS INT) AS t, SUM(o_totalprice) / 1000000.0 AS y FROM orders GROUP BY 1)"""
HOURLY = """hourly AS (SELECT CAST(epoch(date_trunc('hour', ts)) / 3600 - epoch(TIMESTAMP '2024-01-01') / 3600 AS BIGINT) AS t, COUNT(*) AS n, SUM(value) AS y FROM events GROUP BY 1)"""


def daily(t):
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date"))
    return t.orders.groupBy(F.col("o_orderpriority").alias("series"), day.alias("t")).agg((F.sum("o_totalprice") / 1e6).alias("y"))


def total(t):
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date"))
    return t.orders.groupBy(day.alias("t")).agg((F.sum("o_totalprice") / 1e6).alias("y"))


def hourly(t):
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    hour = (day * 24 + F.hour("ts")).cast("bigint")
    return t.events.groupBy(hour.alias("t")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("y"))


def r(col, digits=6):
    return F.round(col, digits).alias(col)


SWITCH = """b AS (SELECT *, FLOOR(t / 6) AS block, CAST(FLOOR(t / 6) % 2 AS INT) AS treat FROM hourly)"""


@query("i20_switchback", f"""WITH {HOURLY}, {SWITCH} SELECT 'y' AS outcome, ROUND(AVG(y) FILTER (WHERE treat = 1) - AVG(y) FILTER (WHERE treat = 0), 6) AS effect FROM b""")
def _(t):
    rows = ts.switchback(hourly(t), "t", 6)
    return ex.ate(rows, "treat", ["y"]).select("outcome", r("effect"))


@query("e6_lagged_assignment_placebo", f"""WITH {HOURLY}, {SWITCH}, k AS (SELECT block, MAX(treat) AS treat, AVG(y) AS y FROM b GROUP BY block),
l AS (SELECT *, LAG(treat) OVER (ORDER BY block) AS treat_lag FROM k) SELECT ROUND(AVG(y) FILTER (WHERE treat_lag = 1) - AVG(y) FILTER (WHERE treat_lag = 0), 6) AS effect FROM l""")
def _(t):
    blocks = ts.switchback(hourly(t), "t", 6).groupBy("block").agg(F.max("treat").alias("treat"), F.avg("y").alias("y"))
    lagged = scalable.lagged(blocks, [], ["block"], "treat", 1, "treat_lag")
    return ex.ate(lagged, "treat_lag", ["y"]).select(r("effect"))


@query("e7_expanding_statistics", f"""WITH {DAILY}, e AS (SELECT series, t, COUNT(*) OVER w AS n, AVG(y) OVER w AS mean_before, regr_slope(y, t) OVER w AS slope FROM daily WINDOW w AS (PARTITION BY series ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT series, t, n, ROUND(mean_before, 6) AS mean_before, ROUND(slope, 6) AS slope FROM e WHERE n >= 30""")
def _(t):
    x, y = F.col("t").cast("double"), F.col("y")
    sums = {"n": F.lit(1), "sx": x, "sy": y, "sxx": x * x, "sxy": x * y}
    cum = scalable.running_totals(daily(t), ["series"], ["t"], sums, inclusive=False)
    n, sx, sy, sxx, sxy = (F.col(c) for c in sums)
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    return cum.filter("n >= 30").select("series", "t", "n", F.round(sy / n, 6).alias("mean_before"), F.round(slope, 6).alias("slope"))


ITS_SQL = """WITH {total}, f AS (SELECT regr_slope(y, t) FILTER (WHERE t < {t0}) AS b0, regr_intercept(y, t) FILTER (WHERE t < {t0}) AS a0, regr_slope(y, t) FILTER (WHERE t >= {t0}) AS b1, regr_intercept(y, t) FILTER (WHERE t >= {t0}) AS a1 FROM total)"""


def its_rows(t0):
    return ITS_SQL.format(total=TOTAL, t0=t0) + f""" SELECT 'Intercept' AS term, ROUND(a0, 6) AS estimate FROM f UNION ALL SELECT 't', ROUND(b0, 6) FROM f
UNION ALL SELECT 'level', ROUND(a1 + b1 * {t0} - a0 - b0 * {t0}, 6) FROM f UNION ALL SELECT 'slope', ROUND(b1 - b0, 6) FROM f"""


@query("i21_interrupted_series", its_rows(1200))
def _(t):
    return ts.interrupted_series(total(t), "t", "y", 1200).select("term", r("estimate"))


@query("i21_placebo_date", its_rows(600))
def _(t):
    return ts.interrupted_series(total(t), "t", "y", 600).select("term", r("estimate"))


@query("i21_counterfactual", ITS_SQL.format(total=TOTAL, t0=1200) + """ SELECT t, ROUND(CASE WHEN t >= 1200 THEN a1 + b1 * t ELSE a0 + b0 * t END, 6) AS fitted, ROUND(a0 + b0 * t, 6) AS counterfactual FROM total, f""")
def _(t):
    return ts.interrupted_paths(total(t), "t", "y", 1200).select("t", r("fitted"), r("counterfactual"))


@query("i22_detrend", f"""WITH {DAILY} SELECT series, t, ROUND(y - a - b * t, 6) AS residual FROM daily JOIN (SELECT series, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM daily GROUP BY series) USING (series)""")
def _(t):
    return ts.detrend(daily(t), ["series"], "t", "y").select("series", "t", r("residual"))


ACF = f"""WITH {DAILY}, d AS (SELECT series, ROW_NUMBER() OVER (PARTITION BY series ORDER BY t) AS rn, y - AVG(y) OVER (PARTITION BY series) AS d FROM daily),
acf AS (SELECT a.series, CAST(k AS INT) AS lag, SUM(a.d * b.d) / MAX(v.ss) AS acf FROM d a, range(41) AS g(k), d b, (SELECT series, SUM(d * d) AS ss FROM d GROUP BY series) v
WHERE b.series = a.series AND b.rn = a.rn + k AND v.series = a.series GROUP BY a.series, k)"""


@query("i23_autocorrelation", ACF + " SELECT series, lag, ROUND(acf, 6) AS acf FROM acf")
def _(t):
    return ts.autocorrelation(daily(t), ["series"], "t", "y", 40).select("series", "lag", r("acf"))


@query("i24_partial_autocorrelation", ACF + """, w AS (SELECT series, MAX(CASE WHEN lag = 1 THEN acf END) AS r1, MAX(CASE WHEN lag = 2 THEN acf END) AS r2, MAX(CASE WHEN lag = 3 THEN acf END) AS r3 FROM acf GROUP BY series)
SELECT series, CAST(1 AS INT) AS lag, ROUND(r1, 6) AS pacf FROM w UNION ALL SELECT series, 2, ROUND((r2 - r1 * r1) / (1 - r1 * r1), 6) FROM w
UNION ALL SELECT series, 3, ROUND((r1 * r1 * r1 - 2 * r1 * r2 + r1 * r2 * r2 + r3 * (1 - r1 * r1)) / (1 - 2 * r1 * r1 + 2 * r1 * r1 * r2 - r2 * r2), 6) FROM w""")
def _(t):
    return ts.partial_autocorrelation(daily(t), ["series"], "t", "y", 3).select("series", "lag", r("pacf"))


def levinson_sql(most: int) -> str:
    """The recursion of the partial autocorrelations, one common table expression per lag; r[1] is lag 0."""
    parts = ["r AS (SELECT series, list(acf ORDER BY lag) AS r FROM acf GROUP BY series)", "p1 AS (SELECT series, r, [r[2]] AS phi, [r[2]] AS pacf FROM r)"]
    for k in range(2, most + 1):
        parts.append(
            f"q{k} AS (SELECT *, (r[{k + 1}] - list_sum(list_transform(range(1, {k}), lambda j: phi[j] * r[{k + 1} - j]))) / (1 - list_sum(list_transform(range(1, {k}), lambda j: phi[j] * r[j + 1]))) AS p FROM p{k - 1}), "
            f"p{k} AS MATERIALIZED (SELECT series, r, list_append(list_transform(range(1, {k}), lambda j: phi[j] - p * phi[{k} - j]), p) AS phi, list_append(pacf, p) AS pacf FROM q{k})")
    return ", ".join(parts) + f" SELECT series, CAST(unnest(range(1, {most + 1})) AS INT) AS lag, ROUND(unnest(pacf), 6) AS pacf FROM p{most}"


@query("i24_partial_autocorrelation_40", ACF + ", " + levinson_sql(40))
def _(t):
    return ts.partial_autocorrelation(daily(t), ["series"], "t", "y", 40).select("series", "lag", r("pacf"))


AR = f"""WITH {DAILY}, l AS (SELECT *, LAG(y) OVER (PARTITION BY series ORDER BY t) AS y_lag FROM daily),
m AS (SELECT series, regr_slope(y, y_lag) AS phi, regr_intercept(y, y_lag) AS c, arg_max(y, t) AS y_last FROM l GROUP BY series)"""


@query("i25_ar1_forecast", AR + """ SELECT series, CAST(h AS INT) AS h, ROUND(phi, 6) AS phi, ROUND(c / (1 - phi) + pow(phi, h) * (y_last - c / (1 - phi)), 6) AS forecast FROM m, range(1, 13) AS g(h)""")
def _(t):
    return ts.ar1_forecast(ts.ar1(daily(t), ["series"], "t", "y"), 12).select("series", "h", r("phi"), r("forecast"))


@query("i26_error_metrics", f"""WITH {DAILY}, l AS (SELECT *, LAG(y) OVER (PARTITION BY series ORDER BY t) AS f FROM daily)
SELECT series, COUNT(*) AS n, ROUND(SQRT(AVG((y - f) * (y - f))), 6) AS rmse, ROUND(AVG(abs(y - f)), 6) AS mae, ROUND(1 - AVG((y - f) * (y - f)) / VAR_POP(y), 6) AS r2 FROM l WHERE f IS NOT NULL GROUP BY series""")
def _(t):
    rows = ts.with_lag(daily(t), ["series"], "t", "y", out="f")
    return reg.score_metrics(rows, "y", "f", ["series"]).select("series", "n", r("rmse"), r("mae"), r("r2"))


LEAK = f"""WITH {TOTAL}, s AS (SELECT *, COUNT(*) OVER () AS n, ROW_NUMBER() OVER (ORDER BY t) AS rt, ROW_NUMBER() OVER (ORDER BY {sql_hash48('leak', 't')}, t) AS rh FROM total),
w AS (SELECT 'time' AS kind, t, y, rt <= FLOOR(0.8 * n) AS train FROM s UNION ALL SELECT 'random', t, y, rh <= FLOOR(0.8 * n) FROM s),
l AS (SELECT *, LAG(y) OVER (PARTITION BY kind ORDER BY t) AS y_lag FROM w WHERE train),
m AS (SELECT kind, regr_slope(y, y_lag) AS phi, regr_intercept(y, y_lag) / (1 - regr_slope(y, y_lag)) AS mu, arg_max(y, t) AS y_last FROM l GROUP BY kind),
p AS (SELECT w.kind, y, mu + pow(phi, ROW_NUMBER() OVER (PARTITION BY w.kind ORDER BY t)) * (y_last - mu) AS f FROM w JOIN m ON w.kind = m.kind WHERE NOT train)
SELECT kind, COUNT(*) AS n, ROUND(SQRT(AVG((y - f) * (y - f))), 6) AS rmse FROM p GROUP BY kind"""


@query("i27_leak_demonstration", LEAK)
def _(t):
    from civicframe.operators import relational as rel

    series = total(t)
    by_hash = rel.random_split(series, "t", {"train": 0.8, "test": 0.2}, "leak")
    n = series.count()
    ranked = scalable.row_number_by(series, [], ["t"], "rn")
    by_time = ranked.withColumn("split", F.when(F.col("rn") <= F.floor(F.lit(0.8) * n), "train").otherwise("test"))
    out = [ts.split_evaluation(df, "t", "y", "split").withColumn("kind", F.lit(kind)) for kind, df in (("random", by_hash), ("time", by_time))]
    return out[0].unionByName(out[1]).select("kind", "n", r("rmse"))


@query("i28_rolling_backtest", f"""WITH {DAILY}, l AS (SELECT *, LAG(y) OVER (PARTITION BY series ORDER BY t) AS y_lag FROM daily),
f AS (SELECT *, COUNT(y_lag) OVER w AS n, regr_slope(y, y_lag) OVER w AS b, regr_intercept(y, y_lag) OVER w AS a FROM l WINDOW w AS (PARTITION BY series ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT series, t, ROUND(y, 8) AS y, ROUND(a + b * y_lag, 6) AS forecast, ROUND(y - a - b * y_lag, 6) AS error FROM f WHERE n >= 60""")
def _(t):
    return ts.backtest_ar1(daily(t), ["series"], "t", "y", 60).select("series", "t", r("y", 8), r("forecast"), r("error"))


@query("i29_seasonal_decomposition", f"""WITH {DAILY}, w AS (SELECT *, CASE WHEN COUNT(*) OVER f = 7 THEN AVG(y) OVER f END AS trend, t % 7 AS season FROM daily WINDOW f AS (PARTITION BY series ORDER BY t ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
s AS (SELECT series, season, AVG(y - trend) AS s FROM w GROUP BY 1, 2), c AS (SELECT series, season, s - AVG(s) OVER (PARTITION BY series) AS seasonal FROM s)
SELECT w.series, t, ROUND(trend, 6) AS trend, ROUND(seasonal, 6) AS seasonal, ROUND(y - trend - seasonal, 6) AS remainder FROM w JOIN c ON w.series = c.series AND w.season = c.season""")
def _(t):
    return ts.decompose(daily(t), ["series"], "t", "y", 7).select("series", "t", r("trend"), r("seasonal"), r("remainder"))
