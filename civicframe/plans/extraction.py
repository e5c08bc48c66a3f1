"""Extraction review (inventory K1 to K8, J15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions.hashing import hash48, sql_hash48
from civicframe.operators import review
from civicframe.plans.registry import query
from civicframe.session import materialise

# One extraction per event. The hash decides the fields, which of them are missing, and which
# records break the schema.
FIELDS = f"""x AS (SELECT event_id, h, h % 101 / 100.0 AS conf, h % 9 = 0 AS no_country, h % 7 = 0 AS no_date, h % 5 = 0 AS no_actors,
CASE h % 4 WHEN 0 THEN 'country_only' WHEN 1 THEN 'admin1_or_state' WHEN 2 THEN 'city_or_local' ELSE 'unknown' END AS geo,
CASE event_type WHEN 'view' THEN 'protest' WHEN 'signup' THEN 'election' WHEN 'error' THEN 'disaster' WHEN 'click' THEN 'violence' ELSE 'policy_change' END AS kind,
h % 37 = 0 AS bad_kind, h % 41 = 0 AS bad_conf, h % 43 = 0 AS bad_json, h % 47 = 0 AS bad_evidence
FROM (SELECT event_id, event_type, {sql_hash48('extract', 'event_id')} AS h FROM events))"""
GOOD = "NOT (bad_kind OR bad_conf OR bad_json OR bad_evidence)"
KINDS = {"view": "protest", "signup": "election", "error": "disaster", "click": "violence", "purchase": "policy_change"}


def responses(t):
    """(event_id, response_json) as a model would return them."""
    h = F.col("h")
    rows = t.events.select("event_id", "event_type", hash48("extract", "event_id").alias("h"))
    pairs = [F.lit(v) for kv in KINDS.items() for v in kv]
    kind = F.when(h % 37 == 0, "riot").otherwise(F.create_map(*pairs)[F.col("event_type")])
    conf = F.when(h % 41 == 0, F.lit(1.7)).otherwise((h % 101) / 100.0)
    geo = F.when(h % 4 == 0, "country_only").when(h % 4 == 1, "admin1_or_state").when(h % 4 == 2, "city_or_local").otherwise("unknown")
    field = F.when(h % 47 == 0, "weather").otherwise("date")
    record = F.struct(
        kind.alias("event_type"), F.when(h % 7 != 0, "2024-01-05").alias("event_date_iso"), F.lit(False).alias("date_is_approximate"),
        F.when(h % 9 != 0, "Freedonia").alias("country"), geo.alias("geo_precision"),
        F.when(h % 5 != 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("actors"),
        conf.alias("extraction_confidence"), F.array().cast("array<string>").alias("uncertainty_flags"),
        F.array(F.struct(field.alias("field"), F.lit("q").alias("quote"))).alias("evidence"))
    text = F.to_json(record)
    cut = F.when(h % 43 == 0, F.substring(text, 1, 40)).otherwise(text)
    return rows.select("event_id", cut.alias("response_json"))


def extractions(t):
    return review.valid_records(review.parse_records(responses(t), "response_json")).drop("response_json")


@query("k1_validate_records", f"WITH {FIELDS} SELECT event_id, kind AS event_type, ROUND(conf, 6) AS extraction_confidence, geo AS geo_precision FROM x WHERE {GOOD}")
def _(t):
    return extractions(t).select("event_id", "event_type", F.round("extraction_confidence", 6).alias("extraction_confidence"), "geo_precision")


@query("k1_quarantine", f"""WITH {FIELDS} SELECT event_id, CASE WHEN bad_json THEN 'json' ELSE concat_ws(',', CASE WHEN bad_kind THEN 'event_type' END, CASE WHEN bad_conf THEN 'extraction_confidence' END, CASE WHEN bad_evidence THEN 'evidence' END) END AS errors FROM x WHERE NOT ({GOOD})""")
def _(t):
    parsed = review.parse_records(responses(t), "response_json")
    bad = review.quarantined(parsed, "event_id", "response_json")
    # A broken record can lose fields as well; it is reported as broken text only.
    first = F.when(F.array_contains("errors", "json"), "json").otherwise(F.array_join("errors", ","))
    return bad.select("event_id", first.alias("errors"))


FLAGS_SQL = "conf < 0.7 AS flag_low_confidence, no_date AS flag_missing_date, no_country AS flag_missing_country, geo IN ('unknown', 'country_only') AS flag_geo_unknown, no_actors AS flag_no_actors"
NEEDS = "(conf < 0.7 OR no_date OR no_country OR geo IN ('unknown', 'country_only') OR no_actors)"


@query("k2_review_flags", f"WITH {FIELDS} SELECT event_id, {FLAGS_SQL}, {NEEDS} AS needs_human_review FROM x WHERE {GOOD}")
def _(t):
    return review.review_flags(extractions(t)).select("event_id", *review.FLAG_NAMES, "needs_human_review")


@query("k2_flag_counts", f"WITH {FIELDS}, f AS (SELECT {FLAGS_SQL}, {NEEDS} AS needs_human_review FROM x WHERE {GOOD}) SELECT " + ", ".join(
    f"COUNT(*) FILTER (WHERE {c}) AS {c}" for c in (*review.FLAG_NAMES, "needs_human_review")) + " FROM f")
def _(t):
    from civicframe.operators.prep import flag_summary

    return flag_summary(review.review_flags(extractions(t)), [*review.FLAG_NAMES, "needs_human_review"])


@query("k3_audit_sheet", f"""WITH {FIELDS}, v AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {sql_hash48('sheet', 'event_id')}, event_id) AS r FROM x WHERE {GOOD})
SELECT event_id, kind AS event_type, {NEEDS} AS needs_human_review, '' AS human_is_correct, '' AS failure_mode FROM v WHERE r <= 200 OR {NEEDS}""")
def _(t):
    records = materialise(review.review_flags(extractions(t)))  # read by the sample and by the sheet
    sheet = review.audit_sheet(records, "event_id", 200, "sheet")
    return sheet.select("event_id", "event_type", "needs_human_review", "human_is_correct", "failure_mode")


@query("k4_audit_statistics", """WITH a AS (SELECT quality AS ok, CASE WHEN quality = 1 THEN '' WHEN toxic = 1 THEN 'actors' WHEN doc_id % 3 = 0 THEN 'date' ELSE 'location' END AS f FROM labels)
SELECT COUNT(*) AS n_audited, ROUND(AVG(ok), 9) AS share_correct, (SELECT f FROM a WHERE f <> '' GROUP BY f ORDER BY COUNT(*) DESC, f LIMIT 1) AS modal_failure FROM a""")
def _(t):
    mode = F.when(F.col("quality") == 1, "").when(F.col("toxic") == 1, "actors").when(F.col("doc_id") % 3 == 0, "date").otherwise("location")
    audited = t.labels.withColumn("failure_mode", mode)
    return review.audit_statistics(audited, "quality", "failure_mode").withColumn("share_correct", F.round("share_correct", 9))


REPORT = """c AS (SELECT {by}cls AS "class", SUM(support)::BIGINT AS support, SUM(predicted)::BIGINT AS predicted, SUM(tp)::BIGINT AS tp FROM (
SELECT {by}gold AS cls, 1 AS support, 0 AS predicted, CASE WHEN gold = pred THEN 1 ELSE 0 END AS tp FROM g UNION ALL SELECT {by}pred, 0, 1, 0 FROM g) GROUP BY ALL),
m AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM c),
rep AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM m)"""
REPORT_COLS = """"class", support, ROUND(p, 9) AS "precision", ROUND(r, 9) AS recall, ROUND(f, 9) AS f1"""


def report_columns(df, *by):
    return df.select(*by, "class", "support", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query("j15_classification_report", f"WITH g AS (SELECT CAST(quality AS VARCHAR) AS gold, CAST(toxic AS VARCHAR) AS pred FROM labels), {REPORT.format(by='')} SELECT {REPORT_COLS} FROM rep")
def _(t):
    return report_columns(review.classification_report(review.confusion(t.labels, "quality", "toxic")))


@query("j15_overall_scores", f"""WITH g AS (SELECT CAST(quality AS VARCHAR) AS gold, CAST(toxic AS VARCHAR) AS pred FROM labels), {REPORT.format(by='')}
SELECT ROUND(AVG(p), 9) AS macro_precision, ROUND(AVG(r), 9) AS macro_recall, ROUND(AVG(f), 9) AS macro_f1, ROUND(SUM(tp) / SUM(support), 9) AS accuracy, SUM(support)::BIGINT AS n FROM rep""")
def _(t):
    out = review.overall_scores(review.classification_report(review.confusion(t.labels, "quality", "toxic")))
    return out.select("n", *[F.round(c, 9).alias(c) for c in ("macro_precision", "macro_recall", "macro_f1", "accuracy")])


def gold_kinds(t):
    """Human labels for a third of the events, a tenth of them different from the event's kind."""
    h = hash48("gold", "event_id")
    pairs = [F.lit(v) for kv in KINDS.items() for v in kv]
    label = F.when(h % 10 == 0, "other").otherwise(F.create_map(*pairs)[F.col("event_type")])
    return t.events.filter(h % 3 == 0).select("event_id", label.alias("event_type_gold"))


GOLD = f"""gold AS (SELECT event_id, CASE WHEN {sql_hash48('gold', 'event_id')} % 10 = 0 THEN 'other' ELSE kind END AS gold FROM x WHERE {sql_hash48('gold', 'event_id')} % 3 = 0)"""


@query("k5_gold_evaluation", f"""WITH {FIELDS}, {GOLD}, g AS (SELECT gold, COALESCE(kind, '(none)') AS pred FROM gold LEFT JOIN (SELECT event_id, kind FROM x WHERE {GOOD}) USING (event_id)), {REPORT.format(by='')} SELECT {REPORT_COLS} FROM rep""")
def _(t):
    return report_columns(review.evaluate_against_gold(gold_kinds(t), extractions(t), "event_id", "event_type_gold", "event_type"))


VARIANTS = ("short", "long", "examples")


def variant_predictions(t):
    """Three prompt variants: each keeps the extracted kind except for a hash-chosen share."""
    base = gold_kinds(t).join(extractions(t).select("event_id", "event_type", "extraction_confidence"), "event_id")
    spread = base.withColumn("variant", F.explode(F.array(*[F.lit(v) for v in VARIANTS])))
    miss = hash48("variant", "variant", "event_id") % 20 < F.length("variant")
    return spread.withColumn("pred", F.when(miss, "other").otherwise(F.col("event_type")))


VARIANT_SQL = f"""WITH {FIELDS}, {GOLD}, g AS (SELECT variant, event_id, gold, conf, CASE WHEN {sql_hash48('variant', 'variant', 'event_id')} % 20 < LENGTH(variant) THEN 'other' ELSE kind END AS pred
FROM gold JOIN (SELECT event_id, kind, conf FROM x WHERE {GOOD}) USING (event_id), (SELECT unnest({list(VARIANTS)}) AS variant)), {REPORT.format(by='variant, ')}"""


@query("k6_variant_comparison", VARIANT_SQL + """ SELECT variant, ROUND(AVG(f), 9) AS macro_f1, ROUND(SUM(tp) / SUM(support), 9) AS accuracy, MAX(n_flagged) AS n_flagged FROM rep JOIN (SELECT variant, COUNT(*) FILTER (WHERE conf < 0.7) AS n_flagged FROM g GROUP BY variant) USING (variant) GROUP BY variant""")
def _(t):
    rows = variant_predictions(t)
    report = review.classification_report(review.confusion(rows, "event_type_gold", "pred", ["variant"]), ["variant"])
    flagged = rows.groupBy("variant").agg(F.count_if(F.col("extraction_confidence") < 0.7).alias("n_flagged"))
    return review.overall_scores(report, ["variant"]).join(flagged, "variant").select(
        "variant", F.round("macro_f1", 9).alias("macro_f1"), F.round("accuracy", 9).alias("accuracy"), "n_flagged")


CHUNKS = f"""ch AS (SELECT conv_id, turn, role, {sql_hash48('chunk', 'conv_id', 'turn')} AS h FROM conversations),
cp AS (SELECT *, h % 997 AS conf, CASE h % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN 'country_only' WHEN 2 THEN 'admin1_or_state' ELSE 'city_or_local' END AS geo, h % 4 AS geo_rank FROM ch)"""


@query("k7_merge_chunks", f"""WITH {CHUNKS} SELECT conv_id, arg_max(role, (conf, -turn)) AS role, arg_max(geo, (geo_rank, conf, -turn)) AS geo, MAX(conf) AS conf, COUNT(*) AS n_chunks, string_agg(DISTINCT role, ',' ORDER BY role) AS actors FROM cp GROUP BY conv_id""")
def _(t):
    h = hash48("chunk", "conv_id", "turn")
    geo = F.element_at(F.array(*[F.lit(g) for g in review.PLACE_RANK]), (h % 4 + 1).cast("int"))
    rows = t.conversations.select("conv_id", "turn", "role", (h % 997).alias("conf"), geo.alias("geo"), F.array("role").alias("actors"))
    out = review.merge_chunks(rows, "conv_id", "turn", "conf", ["role"], "actors", "geo")
    return out.withColumn("actors", F.array_join("actors", ","))


CUTS = [0.0, 0.3, 0.5, 0.7, 0.9]


@query("k8_abstention", f"""WITH {FIELDS}, {GOLD}, j AS (SELECT gold, kind, conf FROM gold JOIN (SELECT event_id, kind, conf FROM x WHERE {GOOD}) USING (event_id))
SELECT cut, COUNT(*) FILTER (WHERE conf < cut) AS n_queue, ROUND(AVG(CASE WHEN conf >= cut THEN (gold = kind)::INT END), 9) AS accuracy_kept FROM j, (SELECT unnest({CUTS})::DOUBLE AS cut) GROUP BY cut""")
def _(t):
    joined = gold_kinds(t).join(extractions(t), "event_id")
    out = review.abstention_curve(joined, "event_type", "event_type_gold", "extraction_confidence", CUTS)
    return out.withColumn("accuracy_kept", F.round("accuracy_kept", 9))
