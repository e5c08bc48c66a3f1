"""Streaming over the event files (inventory T1 to T3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions.hashing import hash48, sql_hash48
from civicframe.plans.registry import query
from civicframe.session import scratch_path
from civicframe.streaming import monitor as mo

SPACE = "281474976710656.0"
LOGGED = f"CASE WHEN {sql_hash48('log', 'event_id')} % 50 <> 0 THEN value END"
ARM = f"CAST({sql_hash48('live', 'user_id')} / {SPACE} < 0.5 AS INT)"


def stream(t):
    # As a pattern the path may be one file or a folder of files; a plain path must be a folder.
    raw = mo.event_stream(t.spark, f"{t.directory}/events.parque[t]", t.events.schema)
    logged = raw.withColumn("value", F.when(hash48("log", "event_id") % 50 != 0, F.col("value")))
    return mo.event_time(logged.withColumn("treat", mo.arm("user_id", "live")), "ts")


def day(col="w.start"):
    return F.date_format(col, "yyyy-MM-dd")


@query("t1_daily_monitor", f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, treat, COUNT(*) AS n, ROUND(AVG(v), 4) AS mean_value, ROUND(AVG((v IS NULL)::INT), 6) AS missing_share
FROM (SELECT ts, {ARM} AS treat, {LOGGED} AS v FROM events) GROUP BY 1, 2""")
def _(t):
    out = mo.run_available(mo.daily_by_arm(stream(t), "ts", "value", "treat"), "daily-monitor", "complete")
    return out.select(day().alias("day"), "treat", "n", F.round("mean_value", 4).alias("mean_value"), F.round("missing_share", 6).alias("missing_share"))


# Append mode gives a day out once the watermark has passed its end, so the last day stays open.
@query("t1_closed_days", f"""SELECT day, treat, n FROM (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, treat, COUNT(*) AS n, MAX(CAST(ts AS DATE)) AS d FROM (SELECT ts, {ARM} AS treat FROM events) GROUP BY 1, 2)
WHERE d + INTERVAL 1 DAY <= (SELECT MAX(ts) - INTERVAL 1 HOUR FROM events)""")
def _(t):
    out = mo.run_available(mo.daily_by_arm(stream(t), "ts", "value", "treat"), "closed-days", "append")
    return out.select(day().alias("day"), "treat", "n")


@query("t2_drift_alerts", """WITH b AS (SELECT event_type AS level, COUNT(*) * 1.0 / (SELECT COUNT(*) FROM events) AS share FROM events GROUP BY 1),
d AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1), c AS (SELECT CAST(ts AS DATE) AS day, event_type AS level, COUNT(*) AS k FROM events GROUP BY 1, 2)
SELECT CAST(d.day AS VARCHAR) AS day, b.level, ROUND(COALESCE(k, 0) * 1.0 / n - b.share, 6) AS difference FROM d CROSS JOIN b LEFT JOIN c ON c.day = d.day AND c.level = b.level WHERE abs(COALESCE(k, 0) * 1.0 / n - b.share) > 0.03""")
def _(t):
    n = t.events.count()
    baseline = t.events.groupBy(F.col("event_type").alias("level")).agg((F.count(F.lit(1)) / F.lit(n)).alias("share"))
    counts = mo.run_available(mo.level_counts(stream(t), "ts", "event_type"), "drift", "complete")
    return mo.drift_alerts(counts, baseline, 0.03).select(day().alias("day"), "level", F.round("difference", 6).alias("difference"))


@query("t3_first_seen_assignment", f"SELECT DISTINCT user_id, {ARM} AS treat FROM events")
def _(t):
    return mo.assign_first_seen(stream(t), "user_id", "live", scratch_path(t.spark, "first-seen")).select("user_id", "treat")
