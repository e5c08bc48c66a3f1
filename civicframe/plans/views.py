"""Relations in the shape of the analyses, derived from the given tables.

Each has a SQL text (used by both engines as a common table expression) and, where an operator
needs a frame, a builder on top of that text.
"""

from __future__ import annotations

from civicframe.functions.hashing import sql_hash48

CANDIDATES = """candidates AS (
  SELECT s_suppkey AS id, s_name AS name, r_name AS party, n_name AS office
  FROM supplier
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

CONTRIBUTORS = """contributors AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS occupation, n_name AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

CONTRIBUTIONS = """contributions AS (
  SELECT o_custkey AS contributor_id, l_suppkey AS candidate_id, l_extendedprice AS amount,
         CAST(l_shipdate AS DATE) AS gift_date, l_orderkey AS order_id, l_linenumber AS line_no,
         l_partkey AS part_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def with_views(body: str, *views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n" + body


# Experiment units: customers, with a hash-assigned arm and outcomes from their orders. Customers
# without orders keep zero outcomes. Spend is measured in thousands.
ASSIGN_SEED = "assign-2024"
USERS = f"""users AS (
  SELECT c_custkey AS user_id, c_mktsegment AS platform, c_nationkey AS cluster_id,
         c_acctbal / 1000.0 AS baseline,
         CASE WHEN {{h}} < 140737488355328 THEN 1 ELSE 0 END AS treat,
         COALESCE(n_orders, 0) AS n_orders,
         COALESCE(spend, 0.0) AS spend,
         COALESCE(pre_spend, 0.0) AS pre_spend,
         CAST(CASE WHEN COALESCE(post_orders, 0) > 5 THEN 1 ELSE 0 END AS DOUBLE) AS converted
  FROM customer LEFT JOIN (
    SELECT o_custkey, COUNT(*) AS n_orders,
           SUM(CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice END) / 1000.0 AS spend,
           SUM(CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_totalprice END) / 1000.0 AS pre_spend,
           SUM(CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 1 ELSE 0 END) AS post_orders
    FROM orders GROUP BY o_custkey) AS o ON c_custkey = o_custkey)"""

USERS_DUCK = USERS.format(h=sql_hash48(ASSIGN_SEED, "c_custkey"))
USERS_SPARK = USERS.format(
    h=f"CAST(conv(substr(md5(concat('{ASSIGN_SEED}', ':', CAST(c_custkey AS STRING))), 1, 12), 16, 10) AS BIGINT)"
)


def users(t, staged: bool = False):
    """The experiment's unit table; ``staged`` writes it once for analyses that read it often."""
    from civicframe.session import materialise

    frame = t.sql(with_views("SELECT * FROM users", USERS_SPARK), "customer", "orders")
    return materialise(frame) if staged else frame


def candidates(t):
    return t.sql(with_views("SELECT * FROM candidates", CANDIDATES), "supplier", "nation", "region")


def contributors(t):
    return t.sql(with_views("SELECT * FROM contributors", CONTRIBUTORS), "customer", "nation")


def contributions(t):
    return t.sql(with_views("SELECT * FROM contributions", CONTRIBUTIONS), "lineitem", "orders")


def hash_sql(seed: str, column: str) -> tuple[str, str]:
    """(Spark text, DuckDB text) of the 48-bit hash of a column."""
    spark = (f"CAST(conv(substr(md5(concat('{seed}', ':', CAST({column} AS STRING))), 1, 12), 16, 10)"
             " AS BIGINT)")
    return spark, sql_hash48(seed, column)


def both(template: str, **hashes: tuple[str, str]) -> tuple[str, str]:
    """Fill a CTE template with the hash texts of each engine."""
    return (template.format(**{k: v[0] for k, v in hashes.items()}),
            template.format(**{k: v[1] for k, v in hashes.items()}))


# A raw survey export: one response per event, answers from a hash, with the missing codes and
# failing answers that a platform export carries.
SURVEY_SPARK, SURVEY_DUCK = both("""survey AS (
  SELECT response_id, platform, user_id, duration_seconds, started_at,
         CASE WHEN h % 7 = 0 THEN 'Prefer not to say' WHEN h % 11 = 0 THEN ''
              ELSE CAST(18 + h % 60 AS VARCHAR(20)) END AS age,
         CASE WHEN h % 13 = 0 THEN NULL WHEN h % 17 = 0 THEN 'Agree' ELSE 'Strongly agree' END AS attention,
         CASE WHEN h % 19 = 0 THEN 'I do not consent' ELSE 'I consent' END AS consent,
         CASE h % 5 WHEN 0 THEN 'Democrat' WHEN 1 THEN 'Republican' WHEN 2 THEN 'Independent'
              WHEN 3 THEN 'Prefer not to say' END AS party,
         CASE h % 4 WHEN 0 THEN 'Woman' WHEN 1 THEN 'Man' WHEN 2 THEN '' ELSE 'Non-binary' END AS gender,
         CASE WHEN h % 23 = 0 THEN NULL ELSE CAST(1 + h % 5 AS INT) END AS q1,
         CASE WHEN h % 29 = 0 THEN NULL ELSE CAST(1 + h % 3 AS INT) END AS q2,
         CAST(1 + h % 2 AS INT) AS q3,
         CASE WHEN h % 31 = 0 THEN NULL ELSE CAST(1 + h % 5 AS INT) END AS q4
  FROM (SELECT event_id AS response_id, event_type AS platform, user_id, value * 10 AS duration_seconds,
               ts AS started_at, {h} AS h FROM events) AS raw)""", h=hash_sql("survey", "event_id"))


def survey(t):
    return t.sql(with_views("SELECT * FROM survey", SURVEY_SPARK), "events")
