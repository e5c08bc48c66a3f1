"""Joins, aggregates, reshaping, windows, ordering, sampling and sets (sections C to G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions.hashing import sql_hash48
from civicframe.operators import prep, scalable
from civicframe.operators import relational as rel
from civicframe.plans import views
from civicframe.plans.preparation import FLAG_SQL, FLAGS, flagged_survey, over_survey
from civicframe.plans.registry import query, same_sql

# ---------------------------------------------------------------- joins


@query("c1_inner_join", """SELECT a.o_orderkey, b.c_name, b.c_nationkey, a.o_totalprice FROM orders a
JOIN customer b ON a.o_custkey = b.c_custkey""")
def _(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "c_nationkey", "o_totalprice")


@query("c1_multi_key_suffixes", """SELECT a.nation_key, a.segment, a.n AS n_a, b.n AS n_b FROM
(SELECT c_nationkey AS nation_key, c_mktsegment AS segment, COUNT(*) AS n FROM customer WHERE c_acctbal >= 5000 GROUP BY ALL) a
JOIN (SELECT c_nationkey AS nation_key, c_mktsegment AS segment, COUNT(*) AS n FROM customer WHERE c_acctbal < 5000 GROUP BY ALL) b
ON a.nation_key = b.nation_key AND a.segment = b.segment""")
def _(t):
    base = t.customer.select(F.col("c_nationkey").alias("nation_key"), F.col("c_mktsegment").alias("segment"), "c_acctbal")
    rich = rel.value_counts(base.filter("c_acctbal >= 5000"), ["nation_key", "segment"])
    poor = rel.value_counts(base.filter("c_acctbal < 5000"), ["nation_key", "segment"])
    return rel.suffixed_join(rich, poor, ["nation_key", "segment"])


same_sql("c2_join_chain", """SELECT r_name, n_name, COUNT(*) AS n_customers, ROUND(AVG(c_acctbal), 4) AS mean_balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, n_name""", "customer", "nation", "region")


@query("c3_left_join", """SELECT d.doc_id, d.lang, l.quality, l.quality IS NULL AS unlabelled FROM documents d
LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(t):
    return t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left").withColumn(
        "unlabelled", F.col("quality").isNull())


MONTHS = """SELECT year, quarter, {v} FROM (SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, {e} AS {v}
FROM orders WHERE {f} GROUP BY 1, 2)"""


@query("c4_full_join_chain", f"""SELECT COALESCE(a.year, b.year, c.year) AS year, COALESCE(a.quarter, b.quarter, c.quarter) AS quarter,
n_open, n_fulfilled, n_large FROM
({MONTHS.format(v='n_open', e='COUNT(*)', f="o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '2000-01-01'")}) a FULL JOIN
({MONTHS.format(v='n_fulfilled', e='COUNT(*)', f="o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-01-01'")}) b
ON a.year = b.year AND a.quarter = b.quarter FULL JOIN
({MONTHS.format(v='n_large', e='COUNT(*)', f="o_totalprice > 300000 AND o_orderdate >= TIMESTAMP '1997-01-01'")}) c
ON COALESCE(a.year, b.year) = c.year AND COALESCE(a.quarter, b.quarter) = c.quarter""")
def _(t):
    dated = t.orders.withColumns({"year": F.year("o_orderdate"), "quarter": F.quarter("o_orderdate")})

    def counted(condition, name):
        return dated.filter(condition).groupBy("year", "quarter").agg(F.count(F.lit(1)).alias(name))

    return rel.full_join_chain([
        counted("o_orderstatus = 'O' AND o_orderdate < TIMESTAMP_NTZ '2000-01-01'", "n_open"),
        counted("o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP_NTZ '1996-01-01'", "n_fulfilled"),
        counted("o_totalprice > 300000 AND o_orderdate >= TIMESTAMP_NTZ '1997-01-01'", "n_large"),
    ], ["year", "quarter"])


@query("c5_units_by_days", """SELECT c_custkey AS user_id, CAST(day AS INT) AS day, CAST(DATE '2024-01-01' + CAST(day AS INT) AS VARCHAR) AS date,
CAST(isodow(DATE '2024-01-01' + CAST(day AS INT)) AS INT) AS dow FROM customer, range(14) AS r(day)""")
def _(t):
    days = rel.units_by_days(t.customer.select(F.col("c_custkey").alias("user_id")), "2024-01-01", 14)
    return days.withColumn("dow", F.weekday("date") + 1).withColumn("date", F.col("date").cast("string"))


@query("c6_many_to_many_left", """SELECT s.s_nationkey AS nationkey, s.s_suppkey, c.c_custkey, c.c_mktsegment FROM supplier s
LEFT JOIN customer c ON s.s_nationkey = c.c_nationkey""")
def _(t):
    left = t.supplier.select(F.col("s_nationkey").alias("nationkey"), "s_suppkey")
    right = t.customer.select(F.col("c_nationkey").alias("nationkey"), "c_custkey", "c_mktsegment")
    return rel.related_join(left, right, ["nationkey"], "many-to-many")


same_sql("c7_semi_join_top", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (
SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY SUM(o_totalprice) DESC, o_custkey LIMIT 20)""", "orders")


@query("c8_anti_join", """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""")
def _(t):
    large = t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(large, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("c11_key_audit", """WITH l AS (SELECT doc_id AS k, COUNT(*) AS nl FROM documents GROUP BY 1),
r AS (SELECT doc_id AS rk, COUNT(*) AS nr FROM labels GROUP BY 1),
j AS (SELECT k, rk, COALESCE(nl, 0) AS nl, COALESCE(nr, 0) AS nr FROM l FULL JOIN r ON k = rk)
SELECT SUM(nl)::BIGINT AS rows_left, SUM(nr)::BIGINT AS rows_right, SUM(nl * nr)::BIGINT AS rows_joined,
COUNT(*) FILTER (WHERE nl > 1) AS left_duplicate_keys, COUNT(*) FILTER (WHERE nr > 1) AS right_duplicate_keys,
CAST(0 AS BIGINT) AS left_null_keys, (SUM(nl) FILTER (WHERE rk IS NULL))::BIGINT AS left_orphan_rows,
COALESCE(SUM(nr) FILTER (WHERE k IS NULL), 0)::BIGINT AS right_unused_rows, ROUND(SUM(nl * nr) / SUM(nl), 6) AS fan_out FROM j""")
def _(t):
    return rel.key_audit(t.documents, t.labels, "doc_id", "doc_id").withColumn("fan_out", F.round("fan_out", 6))


@query("c13_score_in_row", """SELECT o_orderkey, ROUND(1.5 + 0.25 * LN(o_totalprice), 6) AS predicted FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", F.round(1.5 + 0.25 * F.log("o_totalprice"), 6).alias("predicted"))


# ---------------------------------------------------------------- aggregation and reshaping

same_sql("d1_group_sum_count", """SELECT l_returnflag, l_linestatus, ROUND(SUM(l_extendedprice), 2) AS total, COUNT(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus""", "lineitem")


@query("d2_share_of_total", """SELECT event_type, ROUND(SUM(value), 2) AS total,
ROUND(SUM(value) * 100.0 / (SELECT SUM(value) FROM events), 6) AS percentage FROM events GROUP BY event_type""")
def _(t):
    return rel.share_of_total(t.events, ["event_type"], "value").withColumns(
        {"total": F.round("total", 2), "percentage": F.round("percentage", 6)})


same_sql("d3_count_distinct", """SELECT l_suppkey, COUNT(DISTINCT o_custkey) AS n_customers, COUNT(*) AS n_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_suppkey""", "lineitem", "orders")

same_sql("d4_having_distinct", """SELECT o_custkey, COUNT(DISTINCT o_orderpriority) AS n_priorities FROM orders
GROUP BY o_custkey HAVING COUNT(DISTINCT o_orderpriority) > 3""", "orders")


@query("d5_distinct_list", """SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds
FROM events GROUP BY user_id""")
def _(t):
    kinds = t.events.select("user_id", "event_type").distinct()
    return kinds.groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_list("event_type")), ",").alias("kinds"))


same_sql("d6_conditional_sums", """SELECT l_suppkey, ROUND(SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END), 2) AS returned,
ROUND(SUM(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0 END), 2) AS kept FROM lineitem GROUP BY l_suppkey""", "lineitem")

same_sql("d7_group_mean_size", """SELECT c_mktsegment, c_nationkey, COUNT(*) AS n, ROUND(AVG(c_acctbal), 4) AS mean_balance
FROM customer GROUP BY c_mktsegment, c_nationkey""", "customer")


@query("d8_group_median", """SELECT o_orderpriority, ROUND(MEDIAN(o_totalprice), 4) AS median_price FROM orders GROUP BY o_orderpriority""")
def _(t):
    return scalable.exact_quantiles(t.orders, ["o_orderpriority"], "o_totalprice", {"median_price": 0.5}).withColumn(
        "median_price", F.round("median_price", 4))


@query("d8_median_with_empty_years", """WITH y AS (SELECT o_custkey, year(o_orderdate) AS yr, COUNT(*) AS n FROM orders GROUP BY 1, 2),
g AS (SELECT c_custkey, yr FROM customer, range(1995, 2002) AS r(yr))
SELECT c_custkey, MEDIAN(COALESCE(n, 0))::DOUBLE AS median_per_year FROM g LEFT JOIN y ON c_custkey = o_custkey AND g.yr = y.yr GROUP BY c_custkey""")
def _(t):
    yearly = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").cast("bigint").alias("yr")).agg(
        F.count(F.lit(1)).alias("n"))
    years = F.explode(F.sequence(F.lit(1995).cast("bigint"), F.lit(2001).cast("bigint")))
    grid = t.customer.select("c_custkey", years.alias("yr")).join(yearly, ["c_custkey", "yr"], "left")
    filled = grid.withColumn("n", F.coalesce("n", F.lit(0)))
    # Seven rows per customer, so a plain median per group is bounded.
    return filled.groupBy("c_custkey").agg(F.median("n").alias("median_per_year"))


LOGGED = f"CASE WHEN {sql_hash48('log', 'event_id')} % 50 <> 0 THEN value END"


def logged_events(t):
    """Events whose value is missing for a hash-chosen 2 percent."""
    from civicframe.functions.hashing import hash48

    return t.events.withColumn("value", F.when(hash48("log", "event_id") % 50 != 0, F.col("value")))


@query("d9_null_aware_rollup", f"""SELECT user_id, ROUND(COALESCE(SUM(v), 0), 2) AS value, COUNT(v) AS days_observed,
ROUND(AVG(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 6) AS missing_share FROM (SELECT user_id, {LOGGED} AS v FROM events) GROUP BY user_id""")
def _(t):
    out = rel.observed_rollup(logged_events(t), ["user_id"], ["value"], "value")
    return out.withColumns({"value": F.round("value", 2), "missing_share": F.round("missing_share", 6)})


@query("d10_threshold_of_aggregate", """SELECT user_id, CASE WHEN SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS converted,
COUNT(DISTINCT CAST(ts AS DATE)) AS days_active,
CASE WHEN MAX(ts) >= TIMESTAMP '2024-01-22' THEN 1 ELSE 0 END AS retained_any FROM events GROUP BY user_id""")
def _(t):
    return t.events.groupBy("user_id").agg(
        (F.count_if(F.col("event_type") == "purchase") > 0).cast("int").alias("converted"),
        F.count_distinct(F.to_date("ts")).alias("days_active"),
        (F.max("ts") >= F.lit("2024-01-22").cast("timestamp_ntz")).cast("int").alias("retained_any"))


@query("d11_flag_summary", over_survey("SELECT " + ", ".join(
    f"COUNT(*) FILTER (WHERE {f}) AS {f}" for f in FLAGS) + f" FROM (SELECT *, {FLAG_SQL} FROM survey)"))
def _(t):
    return prep.flag_summary(flagged_survey(t), FLAGS)


@query("d12_value_counts_duplicates", """SELECT p_name, COUNT(*) AS n FROM part GROUP BY p_name HAVING COUNT(*) >= 2""")
def _(t):
    return rel.value_counts(t.part, ["p_name"], 2)


@query("d13_unique_and_range", """SELECT event_type, MIN(value) AS lowest, MAX(value) AS highest FROM events GROUP BY event_type ORDER BY event_type""")
def _(t):
    return t.events.groupBy("event_type").agg(F.min("value").alias("lowest"), F.max("value").alias("highest")).orderBy("event_type")


@query("d14_pivot_wide", "SELECT year, " + ", ".join(
    f"MIN(CASE WHEN quarter = {q} THEN {v} END) AS {v}_Q{q}" for v in ("n", "mean_price") for q in (1, 2))
    + """ FROM (SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, COUNT(*) AS n, ROUND(AVG(o_totalprice), 4) AS mean_price
FROM orders GROUP BY 1, 2) GROUP BY year""")
def _(t):
    quarterly = t.orders.groupBy(F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_price"))
    return rel.pivot_first(quarterly, ["year"], "quarter", [1, 2], ["n", "mean_price"], "{value}_Q{by}")


@query("d15_unpivot_long", """SELECT l_returnflag, measure, ROUND(amount, 2) AS amount FROM (
SELECT l_returnflag, SUM(l_quantity) AS quantity, SUM(l_extendedprice) AS price FROM lineitem GROUP BY 1)
UNPIVOT (amount FOR measure IN (quantity, price))""")
def _(t):
    wide = t.lineitem.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("price"))
    return wide.unpivot(["l_returnflag"], ["quantity", "price"], "measure", "amount").withColumn("amount", F.round("amount", 2))


@query("d16_crosstab", """SELECT o_orderpriority, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS F, COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS O,
COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def _(t):
    return rel.crosstab(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("d17_quantiles", """SELECT event_type, ROUND(quantile_cont(value, 0.025), 6) AS lo, ROUND(quantile_cont(value, 0.5), 6) AS mid,
ROUND(quantile_cont(value, 0.975), 6) AS hi FROM events GROUP BY event_type""")
def _(t):
    out = scalable.exact_quantiles(t.events, ["event_type"], "value", {"lo": 0.025, "mid": 0.5, "hi": 0.975})
    return out.withColumns({c: F.round(c, 6) for c in ("lo", "mid", "hi")})


@query("d18_histogram", """WITH e AS (SELECT MIN(value) AS lo, (MAX(value) - MIN(value)) / 60 AS w FROM events),
c AS (SELECT LEAST(CAST(FLOOR((value - lo) / w) AS INT), 59) AS bin, COUNT(*) AS n FROM events, e GROUP BY 1)
SELECT CAST(r.b AS INT) AS bin, ROUND(lo + r.b * w, 6) AS left_edge, COALESCE(n, 0) AS n FROM range(60) AS r(b) CROSS JOIN e LEFT JOIN c ON r.b = c.bin""")
def _(t):
    return rel.histogram(t.events, "value", 60).withColumn("left_edge", F.round("left_edge", 6))


@query("d19_quarterly_resample", """SELECT o_orderpriority, year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, ROUND(AVG(o_totalprice), 4) AS o_totalprice
FROM orders WHERE quarter(o_orderdate) IN (1, 2) AND year(o_orderdate) IN (1996, 2000) GROUP BY 1, 2, 3""")
def _(t):
    kept = t.orders.filter(F.quarter("o_orderdate").isin(1, 2) & F.year("o_orderdate").isin(1996, 2000))
    return rel.resample_quarters(kept, "o_orderdate", ["o_orderpriority"], "o_totalprice").withColumn(
        "o_totalprice", F.round("o_totalprice", 4))


EDGES = [i / 10 for i in range(11)]
BIN_LABELS = [f"{a:.1f}-{b:.1f}" for a, b in zip(EDGES, EDGES[1:])]
SCORE = f"({sql_hash48('score', 'o_orderkey')} % 1001) / 1000.0 * 0.95"


def scored_orders(t):
    from civicframe.functions.hashing import hash48

    return t.orders.withColumn("score", (hash48("score", "o_orderkey") % 1001) / 1000.0 * 0.95)


@query("d20_right_closed_bins", "WITH s AS (SELECT " + SCORE + """ AS score, o_totalprice FROM orders),
b AS (SELECT CASE """ + " ".join(f"WHEN score > {a} AND score <= {b} THEN {i}" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:])))
    + """ END AS bin, COUNT(*) AS n, AVG(o_totalprice) AS m FROM s GROUP BY 1)
SELECT l.bin, l.label, COALESCE(n, 0) AS n, COALESCE(ROUND(m, 4), 0) AS mean_price FROM (VALUES """
    + ", ".join(f"({i}, '{x}')" for i, x in enumerate(BIN_LABELS)) + ") AS l(bin, label) LEFT JOIN b ON l.bin = b.bin")
def _(t):
    out = rel.bin_table(scored_orders(t), "score", EDGES, BIN_LABELS, [
        F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean_price")])
    return out.withColumns({"n": F.coalesce("n", F.lit(0)), "mean_price": F.coalesce(F.round("mean_price", 4), F.lit(0.0))})


@query("d21_threshold_curve", f"""WITH s AS (SELECT {SCORE} AS score FROM orders)
SELECT i / 100.0::DOUBLE AS threshold, (SELECT COUNT(*) FROM s WHERE score >= i / 100.0::DOUBLE) AS n FROM range(101) AS r(i)""")
def _(t):
    return rel.threshold_curve(scored_orders(t), "score", 100)


@query("d22_arg_max", """SELECT vec_id, list_position(embedding, list_max(embedding))::INT - 1 AS dim, ROUND(list_max(embedding)::DOUBLE, 6) AS weight FROM embeddings""")
def _(t):
    top = F.array_max("embedding")
    return t.embeddings.select(
        "vec_id", (F.array_position("embedding", top) - 1).cast("int").alias("dim"), F.round(top.cast("double"), 6).alias("weight"))


@query("d22_arg_max_per_group", """SELECT user_id, arg_max(event_type, (value, event_id)) AS top_type, MAX(value) AS top_value FROM events GROUP BY user_id""")
def _(t):
    return t.events.groupBy("user_id").agg(
        F.max_by("event_type", F.struct("value", "event_id")).alias("top_type"), F.max("value").alias("top_value"))


ARM = f"CASE WHEN {sql_hash48('arm', 'user_id')} % 2 = 0 THEN 1 ELSE 0 END"


def armed_events(t):
    from civicframe.functions.hashing import hash48

    return logged_events(t).withColumn("treat", F.when(hash48("arm", "user_id") % 2 == 0, 1).otherwise(0))


@query("d23_day_by_arm", f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, treat, COUNT(*) AS n, ROUND(AVG(v), 4) AS mean_value,
ROUND(AVG(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 6) AS missing_share
FROM (SELECT ts, {ARM} AS treat, {LOGGED} AS v FROM events) GROUP BY 1, 2""")
def _(t):
    return armed_events(t).groupBy(F.to_date("ts").cast("string").alias("date"), "treat").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean_value"),
        F.round(F.avg(F.col("value").isNull().cast("int")), 6).alias("missing_share"))


@query("d24_platform_by_flags", over_survey("SELECT gender, platform, COUNT(*) AS n, " + ", ".join(
    f"ROUND(AVG(CAST({f} AS INT)), 6) AS {f}" for f in FLAGS) + f" FROM (SELECT *, {FLAG_SQL} FROM survey) GROUP BY gender, platform"))
def _(t):
    return flagged_survey(t).groupBy("gender", "platform").agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.avg(F.col(f).cast("int")), 6).alias(f) for f in FLAGS])


@query("d25_h_index", """WITH c AS (SELECT l_suppkey, l_partkey, COUNT(*) AS c FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY c DESC, l_partkey) AS rn FROM c)
SELECT l_suppkey, SUM(c)::BIGINT AS total_cites, COUNT(*) FILTER (WHERE c >= rn) AS h_index FROM r GROUP BY 1""")
def _(t):
    cites = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("c"))
    return rel.citation_indices(cites, "l_suppkey", "c")


# ---------------------------------------------------------------- windows

LINE_ORDER = ["gift_date", "order_id", "line_no", "part_id", "amount"]
CONTRIB = views.CONTRIBUTIONS


@query("e1_running_sum", views.with_views("""SELECT candidate_id, CAST(gift_date AS VARCHAR) AS gift_date, amount,
ROUND(SUM(amount) OVER (PARTITION BY candidate_id ORDER BY gift_date), 2) AS cumulative FROM contributions""", CONTRIB))
def _(t):
    out = scalable.running_sum_with_peers(views.contributions(t), ["candidate_id"], ["gift_date"], "amount", "cumulative", limit=scalable.BOUNDED)
    return out.select("candidate_id", F.col("gift_date").cast("string").alias("gift_date"), "amount", F.round("cumulative", 2).alias("cumulative"))


@query("e2_moving_average_rows", views.with_views("""SELECT candidate_id, order_id, line_no, part_id, amount, ROUND(AVG(CAST(ROUND(amount * 100) AS BIGINT)) OVER (PARTITION BY candidate_id
ORDER BY gift_date, order_id, line_no, part_id, amount ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 4) AS moving_avg_cents FROM contributions""", CONTRIB))
def _(t):
    # Whole cents, so that the sums inside the frame are exact.
    gifts = views.contributions(t).withColumn("cents", F.round(F.col("amount") * 100).cast("bigint"))
    out = scalable.moving_average(gifts, ["candidate_id"], LINE_ORDER, "cents", 30, "moving_avg")
    return out.select("candidate_id", "order_id", "line_no", "part_id", "amount", F.round("moving_avg", 4).alias("moving_avg_cents"))


@query("e2_moving_average_days", views.with_views("""SELECT candidate_id, CAST(gift_date AS VARCHAR) AS gift_date, ROUND(SUM(s) OVER w / SUM(n) OVER w, 4) AS moving_avg_cents
FROM (SELECT candidate_id, gift_date, SUM(CAST(ROUND(amount * 100) AS BIGINT))::BIGINT AS s, COUNT(*) AS n FROM contributions GROUP BY 1, 2)
WINDOW w AS (PARTITION BY candidate_id ORDER BY gift_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)""", CONTRIB))
def _(t):
    from pyspark.sql import Window as W

    # One row per recipient and day, so a window is no longer than the calendar.
    daily = views.contributions(t).groupBy("candidate_id", "gift_date").agg(
        F.sum(F.round(F.col("amount") * 100).cast("bigint")).alias("s"), F.count(F.lit(1)).alias("n"))
    day = F.unix_date("gift_date")
    w = W.partitionBy("candidate_id").orderBy(day).rangeBetween(-29, 0)
    return daily.select("candidate_id", F.col("gift_date").cast("string").alias("gift_date"),
                        F.round(F.sum("s").over(w) / F.sum("n").over(w), 4).alias("moving_avg_cents"))


MONTHLY = """SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, SUM(o_totalprice) AS total FROM orders GROUP BY 1, 2"""


@query("e3_lag_growth", f"""SELECT o_orderpriority, CAST(month AS VARCHAR) AS month, ROUND(total / LAG(total, 2) OVER (PARTITION BY o_orderpriority ORDER BY month) - 1, 6) AS growth
FROM ({MONTHLY})""")
def _(t):
    monthly = t.orders.groupBy("o_orderpriority", F.trunc("o_orderdate", "month").alias("month")).agg(F.sum("o_totalprice").alias("total"))
    out = rel.growth(monthly, ["o_orderpriority"], ["month"], "total", 2, "growth")
    return out.select("o_orderpriority", F.col("month").cast("string").alias("month"), F.round("growth", 6).alias("growth"))


@query("e4_rank_deciles", "SELECT c_custkey, CAST(ntile(10) OVER (ORDER BY c_acctbal, c_custkey) AS INT) AS decile FROM customer")
def _(t):
    return rel.rank_ntile(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"], 10, "decile").drop("c_acctbal")


@query("e5_value_deciles", """WITH q AS (SELECT quantile_cont(c_acctbal, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS c FROM customer)
SELECT c_custkey, CAST(1 + len(list_filter(c, lambda x: c_acctbal > x)) AS INT) AS decile FROM customer, q""")
def _(t):
    return rel.value_ntile(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 10, "decile").drop("c_acctbal")


@query("e8_first_k_per_entity", """SELECT o_custkey, o_orderkey, CAST(rank AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rank FROM orders) WHERE rank <= 5""")
def _(t):
    return rel.top_k_per_group(t.orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 5).drop("o_orderdate")


# ---------------------------------------------------------------- order, samples, splits, sets

same_sql("f1_order_limit", """SELECT o_custkey, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey
ORDER BY n DESC, total DESC, o_custkey LIMIT 25""", "orders")


@query("f2_flag_sort", over_survey(f"""SELECT response_id, CAST(ROW_NUMBER() OVER (ORDER BY flag_fast DESC, flag_attention DESC, response_id) AS BIGINT) AS position
FROM (SELECT *, {FLAG_SQL} FROM survey) WHERE flag_fast OR flag_attention"""))
def _(t):
    rows = flagged_survey(t).filter("flag_fast OR flag_attention").select("response_id", "flag_fast", "flag_attention")
    order = [F.desc("flag_fast"), F.desc("flag_attention"), F.asc("response_id")]
    return scalable.row_number_by(rows, [], order, "position").select("response_id", "position")


@query("f4_top_k_per_group", """SELECT l_returnflag, l_partkey, n, CAST(rank AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY n DESC, l_partkey) AS rank
FROM (SELECT l_returnflag, l_partkey, COUNT(*) AS n FROM lineitem GROUP BY 1, 2)) WHERE rank <= 10""")
def _(t):
    counts = rel.value_counts(t.lineitem, ["l_returnflag", "l_partkey"])
    return rel.top_k_per_group(counts, ["l_returnflag"], [F.desc("n"), F.asc("l_partkey")], 10)


@query("f5_exact_sample", f"SELECT doc_id, source FROM documents ORDER BY {sql_hash48('audit', 'doc_id')}, doc_id LIMIT 150")
def _(t):
    return rel.exact_sample(t.documents.select("doc_id", "source"), "doc_id", 150, "audit")


@query("f6_random_split", f"""WITH r AS (SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY {sql_hash48('split', 'c_custkey')}, c_custkey) AS r, COUNT(*) OVER () AS n FROM customer)
SELECT c_custkey, CASE WHEN r <= FLOOR(0.6 * n) THEN 'train' WHEN r <= FLOOR(0.8 * n) THEN 'val' ELSE 'test' END AS split FROM r""")
def _(t):
    return rel.random_split(t.customer.select("c_custkey"), "c_custkey", {"train": 0.6, "val": 0.2, "test": 0.2}, "split")


@query("f7_time_split", """SELECT split, COUNT(*) AS n, ROUND(AVG(o_totalprice), 4) AS mean_price FROM (SELECT *, CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS split FROM orders) GROUP BY split""")
def _(t):
    return rel.time_split(t.orders, "o_orderdate", "2000-01-01").groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_price"))


@query("g1_union_all", """SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS balance FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier""")
def _(t):
    c = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    s = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s)


@query("g2_union_dedupe", """SELECT doc_id, MIN(origin) AS origin FROM (SELECT doc_id, 2 AS origin FROM documents UNION ALL SELECT doc_id, 1 FROM labels WHERE toxic = 1) GROUP BY doc_id""")
def _(t):
    docs = t.documents.select("doc_id", F.lit(2).alias("origin"))
    toxic = t.labels.filter("toxic = 1").select("doc_id", F.lit(1).alias("origin"))
    return rel.union_dedupe([docs, toxic], ["doc_id"], ["origin"])


same_sql("g3_except", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels", "documents", "labels")
