"""Six analytic queries over recipients, donors and gifts, plus the table life cycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.operators import scalable
from civicframe.plans import views
from civicframe.plans.registry import query, same_sql
from civicframe.plans.views import CANDIDATES, CONTRIBUTIONS, CONTRIBUTORS, with_views

# The output names of the six queries are fixed values: the questions prescribe them.
ALL = ("supplier", "nation", "region", "customer", "lineitem", "orders")

@query("s1_top_occupations", with_views("""
SELECT occupation, ROUND(SUM(amount), 2) AS total_amount, COUNT(*) AS num_contributions
FROM contributors JOIN contributions ON contributors.id = contributor_id
GROUP BY occupation ORDER BY total_amount DESC, occupation LIMIT 10
""", CONTRIBUTORS, CONTRIBUTIONS))
def _(t):
    # The gifts are summed per donor before the donors are joined: no gift is shuffled with their table.
    per_donor = views.contributions(t).groupBy("contributor_id").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    rows = per_donor.join(views.contributors(t).select(F.col("id").alias("contributor_id"), "occupation"), "contributor_id")
    return rows.groupBy("occupation").agg(F.round(F.sum("amount"), 2).alias("total_amount"), F.sum("n").alias("num_contributions")).orderBy(
        F.desc("total_amount"), "occupation").limit(10)


same_sql("s2_party_share_large_gifts", with_views("""
SELECT party, ROUND(SUM(amount), 2) AS total_amount,
       ROUND(SUM(amount) * 100.0
             / (SELECT SUM(amount) FROM contributions WHERE amount > 1000), 6) AS percentage
FROM contributions JOIN candidates ON candidate_id = candidates.id
WHERE amount > 1000 GROUP BY party
""", CANDIDATES, CONTRIBUTIONS), *ALL)

@query("s3_recipients_most_states", with_views("""
SELECT candidates.id AS candidate_id, candidates.name AS name, party,
       COUNT(DISTINCT state) AS num_states, COUNT(*) AS contribution_count
FROM candidates
JOIN contributions ON candidates.id = candidate_id
JOIN contributors ON contributor_id = contributors.id
GROUP BY candidates.id, candidates.name, party
ORDER BY num_states DESC, contribution_count DESC, candidate_id LIMIT 5
""", CANDIDATES, CONTRIBUTORS, CONTRIBUTIONS))
def _(t):
    # One row per recipient and donor, then per recipient and state: the distinct count needs no expansion.
    pairs = views.contributions(t).groupBy("candidate_id", "contributor_id").agg(F.count(F.lit(1)).alias("n"))
    by_state = pairs.join(views.contributors(t).select(F.col("id").alias("contributor_id"), "state"), "contributor_id").groupBy(
        "candidate_id", "state").agg(F.sum("n").alias("n"))
    totals = by_state.groupBy("candidate_id").agg(F.count("state").alias("num_states"), F.sum("n").alias("contribution_count"))
    return totals.join(views.candidates(t).select(F.col("id").alias("candidate_id"), "name", "party"), "candidate_id").select(
        "candidate_id", "name", "party", "num_states", "contribution_count").orderBy(
        F.desc("num_states"), F.desc("contribution_count"), "candidate_id").limit(5)


@query("s4_cross_party_donors", with_views("""
SELECT contributors.id AS contributor_id, contributors.name AS name,
       string_agg(DISTINCT party, ',' ORDER BY party) AS parties,
       ROUND(SUM(CASE WHEN party = 'ASIA' THEN amount ELSE 0 END), 2) AS asia_amount,
       ROUND(SUM(CASE WHEN party = 'EUROPE' THEN amount ELSE 0 END), 2) AS europe_amount
FROM contributors
JOIN contributions ON contributors.id = contributor_id
JOIN candidates ON candidate_id = candidates.id
GROUP BY contributors.id, contributors.name
HAVING COUNT(DISTINCT party) > 1
""", CANDIDATES, CONTRIBUTORS, CONTRIBUTIONS))
def _(t):
    # One row per donor and party first: the distinct count and the list then need no expansion.
    gifts = views.contributions(t).join(
        views.candidates(t).select(F.col("id").alias("candidate_id"), "party"), "candidate_id"
    )
    by_party = gifts.groupBy("contributor_id", "party").agg(F.sum("amount").alias("amount"))
    donors = by_party.groupBy("contributor_id").agg(
        F.array_join(F.sort_array(F.collect_list("party")), ",").alias("parties"),
        F.count(F.lit(1)).alias("n_parties"),
        *[F.round(F.sum(F.when(F.col("party") == name, F.col("amount")).otherwise(0.0)), 2)
          .alias(f"{name.lower()}_amount") for name in ("ASIA", "EUROPE")],
    ).filter("n_parties > 1").drop("n_parties")
    names = views.contributors(t).select(F.col("id").alias("contributor_id"), "name")
    return donors.join(names, "contributor_id")


TIES = "order_id, line_no, part_id, amount"


@query("s5_moving_average_top_recipients", with_views(f"""
, ranked AS (
  SELECT id, name, gift_date, amount, {TIES.replace(', amount', '')},
         SUM(amount) OVER (PARTITION BY id ORDER BY gift_date) AS cumulative_amount,
         AVG(amount) OVER (PARTITION BY id ORDER BY gift_date, {TIES}
                           ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS moving_avg
  FROM candidates JOIN contributions ON candidates.id = candidate_id)
SELECT id, name, CAST(gift_date AS VARCHAR) AS gift_date, amount,
       ROUND(cumulative_amount, 2) AS cumulative_amount, ROUND(moving_avg, 4) AS moving_avg
FROM ranked
WHERE id IN (SELECT id FROM ranked GROUP BY id ORDER BY MAX(cumulative_amount) DESC, id LIMIT 3)
""", CANDIDATES, CONTRIBUTIONS).replace("\n\n, ranked", ",\nranked"))
def _(t):
    people, gifts = views.candidates(t), views.contributions(t)
    totals = gifts.groupBy(F.col("candidate_id").alias("id")).agg(
        F.sum("amount").alias("total"), F.count(F.lit(1)).alias("n"))
    # Gifts are positive, so the largest running total is the sum: three keys are found first, the
    # ordered steps run over their rows only, and their counts say whether a plain window will do.
    top = totals.orderBy(F.desc("total"), "id").limit(3).collect()
    rows = gifts.filter(F.col("candidate_id").isin([r["id"] for r in top])).withColumnRenamed("candidate_id", "id")
    plain = max((r["n"] for r in top), default=0) <= scalable.GROUP_ROWS
    order = ["gift_date", "order_id", "line_no", "part_id", "amount"]
    averaged = scalable.moving_average(
        rows, ["id"], order, "amount", 30, "moving_avg", limit=scalable.BOUNDED if plain else 0)
    averaged = scalable.running_sum_with_peers(
        averaged, ["id"], ["gift_date"], "amount", "cumulative_amount", limit=scalable.BOUNDED)
    return averaged.join(people.select("id", "name"), "id").select(
        "id", "name", F.col("gift_date").cast("string").alias("gift_date"), "amount",
        F.round("cumulative_amount", 2).alias("cumulative_amount"),
        F.round("moving_avg", 4).alias("moving_avg"),
    )


same_sql("s6_party_totals", with_views("""
SELECT party, ROUND(SUM(amount), 2) AS total_amount
FROM contributions JOIN candidates ON candidate_id = candidates.id GROUP BY party
""", CANDIDATES, CONTRIBUTIONS), *ALL)
