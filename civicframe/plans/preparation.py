"""Selecting, recoding, flagging and documenting columns (inventory section B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.operators import prep
from civicframe.operators import relational as rel
from civicframe.plans import views
from civicframe.plans.registry import query
from civicframe.plans.views import SURVEY_DUCK, with_views


def over_survey(body: str) -> str:
    return with_views(body, SURVEY_DUCK)


@query("b1_select_columns", "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders")
def _(t):
    return t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice")


@query("b2_rename_positional", "SELECT r_regionkey AS X1, r_name AS X2 FROM region")
def _(t):
    return prep.rename_positional(t.region.select("r_regionkey", "r_name"))


@query("b3_clean_names", """SELECT event_id AS responseid, event_type AS event_type_raw,
       value AS duration_in_seconds, value AS response_id FROM events""")
def _(t):
    raw = t.events.select(
        F.col("event_id").alias("ResponseId"), F.col("event_type").alias(" Event  Type (raw) "),
        F.col("value").alias("Duration (in seconds)"),
    )
    camel = t.events.select("event_id", F.col("value").alias("ResponseId"))
    snake = prep.clean_names(camel, split_camel=True)
    return prep.clean_names(raw).join(snake, F.col("responseid") == F.col("event_id")).drop("event_id")


@query("b4_membership_filters", """SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P') AND o_orderstatus IS NOT NULL""")
def _(t):
    keep = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    drop = ~F.col("o_orderstatus").isin("P") & F.col("o_orderstatus").isNotNull()
    return t.orders.filter(keep & drop).select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query("b5_drop_nulls", over_survey(
    "SELECT response_id, q1, q2 FROM survey WHERE q1 IS NOT NULL AND q2 IS NOT NULL"))
def _(t):
    return views.survey(t).na.drop(subset=["q1", "q2"]).select("response_id", "q1", "q2")


@query("b6_keep_finite", """SELECT c_custkey, ROUND(LN(c_acctbal), 6) AS log_balance FROM customer
WHERE c_acctbal > 0""")
def _(t):
    logged = t.customer.withColumn("log_balance", F.log("c_acctbal"))
    return prep.keep_finite(logged, ["log_balance"]).select(
        "c_custkey", F.round("log_balance", 6).alias("log_balance"))


@query("b7_strict_cast", """SELECT p_partkey, CAST(regexp_extract(p_brand, '[0-9]+') AS DOUBLE) AS brand_no
FROM part""")
def _(t):
    digits = t.part.withColumn("digits", F.regexp_extract("p_brand", "[0-9]+", 0))
    return digits.select("p_partkey", prep.strict_number("digits").alias("brand_no"))


@query("b8_lenient_cast", over_survey(
    "SELECT response_id, COALESCE(TRY_CAST(age AS DOUBLE), -1) AS age_or_flag, "
    "TRY_CAST(age AS DOUBLE) IS NULL AS age_missing FROM survey"))
def _(t):
    age = prep.lenient_number("age")
    return views.survey(t).select(
        "response_id", F.coalesce(age, F.lit(-1.0)).alias("age_or_flag"), age.isNull().alias("age_missing"))


@query("b9_missing_codes", over_survey("""SELECT response_id, NULLIF(NULLIF(age, ''), 'Prefer not to say') AS age,
NULLIF(party, 'Prefer not to say') AS party, NULLIF(gender, '') AS gender FROM survey"""))
def _(t):
    codes = {"age": ["", "Prefer not to say"], "party": ["Prefer not to say"], "gender": [""]}
    return prep.recode_missing(views.survey(t), codes).select("response_id", "age", "party", "gender")


PARTY_CODES = {"Democrat": 1, "Republican": 2, "Independent": 3}


@query("b10_dictionary_recode", over_survey("""SELECT response_id, party,
COALESCE(CASE party WHEN 'Democrat' THEN 1 WHEN 'Republican' THEN 2 WHEN 'Independent' THEN 3 END, 0) AS party_code
FROM survey"""))
def _(t):
    coded = prep.map_values(views.survey(t), "party", PARTY_CODES, "party_code")
    return coded.select("response_id", "party", F.coalesce("party_code", F.lit(0)).alias("party_code"))


@query("b11_sequential_override", """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'large'
WHEN o_orderstatus = 'F' THEN 'closed' WHEN o_orderpriority = '1-URGENT' THEN 'urgent' ELSE 'other' END AS kind
FROM orders""")
def _(t):
    rules = [
        (F.col("o_orderpriority") == "1-URGENT", F.lit("urgent")),
        (F.col("o_orderstatus") == "F", F.lit("closed")),
        (F.col("o_totalprice") > 400000, F.lit("large")),
    ]
    return t.orders.select("o_orderkey", prep.override_in_order(F.lit("other"), rules).alias("kind"))


@query("b12_conditional_null", """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events""")
def _(t):
    return t.events.select("event_id", prep.null_unless(F.col("event_type") != "error", F.col("value")).alias("value"))


FLAG_SQL = """duration_seconds < 120 AS flag_fast, attention IS DISTINCT FROM 'Strongly agree' AS flag_attention,
consent IS DISTINCT FROM 'I consent' AS flag_no_consent,
COALESCE(q1 = q2 AND q2 = q3 AND q3 = q4, FALSE) AS flag_straightline"""
FLAGS = ["flag_fast", "flag_attention", "flag_no_consent", "flag_straightline"]


def flagged_survey(t):
    return prep.quality_flags(views.survey(t), {
        "flag_fast": F.col("duration_seconds") < 120,
        "flag_attention": prep.differs("attention", "Strongly agree"),
        "flag_no_consent": prep.differs("consent", "I consent"),
        "flag_straightline": prep.all_equal("q1", "q2", "q3", "q4"),
    })


@query("b13_quality_flags", over_survey(f"SELECT response_id, {FLAG_SQL} FROM survey"))
def _(t):
    return flagged_survey(t).select("response_id", *FLAGS)


@query("b14_any_flag", over_survey(
    f"SELECT response_id, flag_fast OR flag_attention OR flag_no_consent AS any_flag FROM "
    f"(SELECT *, {FLAG_SQL} FROM survey)"))
def _(t):
    return flagged_survey(t).select(
        "response_id", prep.any_flag("flag_fast", "flag_attention", "flag_no_consent").alias("any_flag"))


@query("b15_missing_share", over_survey("""SELECT response_id, ROUND((CAST(q1 IS NULL AS INT) + CAST(q2 IS NULL AS INT)
+ CAST(q3 IS NULL AS INT) + CAST(q4 IS NULL AS INT) + CAST(attention IS NULL AS INT)) / 5.0, 6) AS missing_share
FROM survey"""))
def _(t):
    share = prep.missing_share("q1", "q2", "q3", "q4", "attention")
    return views.survey(t).select("response_id", F.round(share, 6).alias("missing_share"))


@query("b16_row_mean", over_survey("""SELECT response_id, ROUND((COALESCE(q1, 0) + COALESCE(q2, 0) + COALESCE(q3, 0)
+ COALESCE(q4, 0)) * 1.0 / (CAST(q1 IS NOT NULL AS INT) + CAST(q2 IS NOT NULL AS INT) + CAST(q3 IS NOT NULL AS INT)
+ CAST(q4 IS NOT NULL AS INT)), 6) AS scale FROM survey"""))
def _(t):
    return views.survey(t).select("response_id", F.round(prep.row_mean("q1", "q2", "q3", "q4"), 6).alias("scale"))


@query("b17_straight_lining", over_survey("""SELECT platform, SUM(CASE WHEN q1 = q2 AND q2 = q3 AND q3 = q4 THEN 1 ELSE 0 END)::BIGINT
AS n_straight FROM survey GROUP BY platform"""))
def _(t):
    return flagged_survey(t).groupBy("platform").agg(F.count_if("flag_straightline").alias("n_straight"))


@query("b18_blank_columns", "SELECT doc_id, '' AS reviewer_notes, '' AS failure_mode FROM documents")
def _(t):
    return prep.add_blank(t.documents.select("doc_id"), "reviewer_notes", "failure_mode")


@query("b19_distinct_rows", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def _(t):
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query("b20_first_per_key", """SELECT user_id, event_id, event_type, value FROM (SELECT *, ROW_NUMBER() OVER
(PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def _(t):
    rows = t.events.select("user_id", "ts", "event_id", "event_type", "value")
    return prep.first_per_key(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("b21_value_labels", over_survey("""SELECT response_id, q1, COALESCE(CASE q1 WHEN 1 THEN 'Strongly disagree'
WHEN 2 THEN 'Disagree' WHEN 3 THEN 'Neither' WHEN 4 THEN 'Agree' WHEN 5 THEN 'Strongly agree' END, '(missing)') AS q1_label,
'Support for policy 1' AS variable_label FROM survey"""))
def _(t):
    answers = ["Strongly disagree", "Disagree", "Neither", "Agree", "Strongly agree"]
    codes = t.spark.createDataFrame(list(enumerate(answers, start=1)), "value int, label string")
    rows = prep.set_labels(views.survey(t).select("response_id", "q1"), {"q1": "Support for policy 1"})
    text = prep.get_labels(rows)["q1"]
    return prep.value_labels(rows, "q1", codes, "q1_label").select(
        "response_id", "q1", F.coalesce("q1_label", F.lit("(missing)")).alias("q1_label"),
        F.lit(text).alias("variable_label"))


SURVEY_WORDS = {
    "response_id": ("Unique response", "one row per response"),
    "platform": ("Recruitment platform", ""),
    "user_id": ("Respondent", "repeat respondents possible"),
    "duration_seconds": ("Time to complete", "seconds"),
    "started_at": ("Start of the interview", "local time, no zone"),
    "age": ("Age in years", "text with missing codes"),
    "attention": ("Attention check", "pass is Strongly agree"),
    "consent": ("Consent", ""),
    "party": ("Party identification", ""),
    "gender": ("Gender", ""),
    "q1": ("Policy item 1", "1 to 5"),
    "q2": ("Policy item 2", "1 to 3"),
}


def _profile_sql(cols):
    parts = [
        f"SELECT '{c}' AS variable, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_missing, "
        f"COUNT(DISTINCT {c}) AS n_distinct, '{d}' AS description, '{n}' AS notes FROM survey"
        for c, (d, n) in cols.items()
    ]
    return over_survey("\nUNION ALL ".join(parts))


@query("b22_codebook", _profile_sql(SURVEY_WORDS))
def _(t):
    return prep.codebook(views.survey(t), SURVEY_WORDS).drop("type")


@query("b23_describe", "\nUNION ALL ".join(
    f"SELECT '{c}' AS variable, COUNT({c}) AS n, ROUND(AVG({c}), 4) AS mean, ROUND(STDDEV_SAMP({c}), 4) AS sd, "
    f"MIN({c})::DOUBLE AS min, MAX({c})::DOUBLE AS max FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")))
def _(t):
    out = prep.describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"])
    return out.withColumns({"mean": F.round("mean", 4), "sd": F.round("sd", 4)})


@query("b24_threshold_sensitivity", over_survey("\nUNION ALL ".join(
    f"SELECT {c}::DOUBLE AS cut, COUNT(*) AS n_kept FROM survey WHERE duration_seconds >= {c}"
    for c in (30.0, 60.0, 120.0, 240.0, 600.0))))
def _(t):
    return prep.threshold_sensitivity(views.survey(t), "duration_seconds", [30.0, 60.0, 120.0, 240.0, 600.0])


@query("b25_check_suite", """SELECT check_name AS "check", n_bad, CASE WHEN n_bad = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
SELECT 'price_positive' AS check_name, COUNT(*) FILTER (WHERE NOT o_totalprice > 0) AS n_bad FROM orders
UNION ALL SELECT 'status_known', COUNT(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F')) FROM orders
UNION ALL SELECT 'customer_present', COUNT(*) FILTER (WHERE o_custkey IS NULL) FROM orders
UNION ALL SELECT 'order_key_unique', COALESCE(SUM(n - 1), 0)::BIGINT FROM (SELECT COUNT(*) AS n FROM orders GROUP BY o_orderkey)
UNION ALL SELECT 'line_key_unique', SUM(n - 1)::BIGINT FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber))""")
def _(t):
    rows = prep.check_suite(t.orders, {
        "price_positive": ~(F.col("o_totalprice") > 0),
        "status_known": ~F.col("o_orderstatus").isin("O", "F"),
        "customer_present": F.col("o_custkey").isNull(),
    })

    def duplicates(df, keys, name):
        extra = rel.value_counts(df, keys, 2).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_bad"))
        status = F.when(F.col("n_bad") == 0, "pass").otherwise("fail")
        return extra.select(F.lit(name).alias("check"), "n_bad", status.alias("status"))

    return (rows.unionByName(duplicates(t.orders, ["o_orderkey"], "order_key_unique"))
            .unionByName(duplicates(t.lineitem, ["l_orderkey", "l_linenumber"], "line_key_unique")))


@query("b25_quarantine", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN 'status,price'
WHEN o_orderstatus = 'P' THEN 'status' ELSE 'price' END AS failed FROM orders WHERE o_orderstatus = 'P' OR o_totalprice > 400000""")
def _(t):
    bad = prep.quarantine(t.orders, {"status": F.col("o_orderstatus") == "P", "price": F.col("o_totalprice") > 400000})
    return bad.select("o_orderkey", F.array_join("failed_checks", ",").alias("failed"))


@query("b_survey_screening", over_survey(f"""SELECT platform, COUNT(*) AS n_before,
COUNT(*) FILTER (WHERE NOT (flag_fast OR flag_attention OR flag_no_consent)) AS n_after,
ROUND(AVG(CAST(flag_fast AS INT)), 6) AS share_fast, ROUND(AVG(CAST(flag_attention AS INT)), 6) AS share_attention
FROM (SELECT *, {FLAG_SQL} FROM survey) GROUP BY platform"""))
def _(t):
    bad = prep.any_flag("flag_fast", "flag_attention", "flag_no_consent")
    return flagged_survey(t).groupBy("platform").agg(
        F.count(F.lit(1)).alias("n_before"), F.count_if(~bad).alias("n_after"),
        F.round(F.avg(F.col("flag_fast").cast("int")), 6).alias("share_fast"),
        F.round(F.avg(F.col("flag_attention").cast("int")), 6).alias("share_attention"))
