"""Extraction records: validation, review flags, audit sheets, and evaluation against gold labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.operators import prep
from civicframe.operators import relational as rel

# The extraction schema and its enumerations.
EVENT_TYPES = ("protest", "election", "policy_change", "violence", "disaster", "other")
GEO_PRECISION = ("country_only", "admin1_or_state", "city_or_local", "unknown")
EVIDENCE_FIELDS = ("event_type", "date", "location", "actors", "outcome")
REQUIRED = ("event_type", "date_is_approximate", "geo_precision", "actors", "extraction_confidence",
            "uncertainty_flags", "evidence")
RECORD_SCHEMA = """event_type string, event_date_iso string, date_is_approximate boolean, country string,
admin1_or_state string, city_or_local string, geo_precision string, actors array<string>,
outcome_summary string, extraction_confidence double, uncertainty_flags array<string>,
evidence array<struct<field: string, quote: string>>"""
REVIEW_COLUMNS = ("human_is_correct", "human_correct_event_type", "human_correct_date_iso",
                  "human_correct_location", "failure_mode", "reviewer_notes")


def parse_records(df: DataFrame, text: str) -> DataFrame:
    """Parse the JSON text and list what is wrong with it in ``errors``; unparsable text keeps nulls."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    record = F.from_json(text, RECORD_SCHEMA + ", _corrupt string", options)
    # Expanding the record by a generator parses each text once; plain field access would be
    # inlined by the optimizer and parse it again for every field.
    fields = df.select(*df.columns, F.inline_outer(F.array(record)))
    bad_json, conf = F.col("_corrupt").isNotNull(), F.col("extraction_confidence")
    checks = [F.when(bad_json, F.lit("json"))]
    checks += [F.when(~bad_json & F.col(c).isNull(), F.lit(f"missing {c}")) for c in REQUIRED]
    checks += [
        F.when(~F.col("event_type").isin(*EVENT_TYPES), F.lit("event_type")),
        F.when(~F.col("geo_precision").isin(*GEO_PRECISION), F.lit("geo_precision")),
        F.when((conf < 0) | (conf > 1), F.lit("extraction_confidence")),
        F.when(F.exists("evidence", lambda e: ~e["field"].isin(*EVIDENCE_FIELDS)), F.lit("evidence")),
    ]
    return fields.withColumn("errors", F.array_compact(F.array(*checks))).drop("_corrupt")


def valid_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.size("errors") == 0).drop("errors")


def quarantined(parsed: DataFrame, key: str, text: str) -> DataFrame:
    return parsed.filter(F.size("errors") > 0).select(key, text, "errors")


FLAG_NAMES = ("flag_low_confidence", "flag_missing_date", "flag_missing_country", "flag_geo_unknown", "flag_no_actors")


def review_flags(df: DataFrame, threshold: float = 0.70) -> DataFrame:
    """Mechanical checks and ``needs_human_review`` when any of them is set."""
    conf = F.col("extraction_confidence").try_cast("double")
    flagged = prep.quality_flags(df, {
        "flag_low_confidence": conf < threshold,
        "flag_missing_date": F.col("event_date_iso").isNull(),
        "flag_missing_country": F.col("country").isNull(),
        "flag_geo_unknown": F.col("geo_precision").isin("unknown", "country_only"),
        "flag_no_actors": F.size("actors") == 0,
    })
    return flagged.withColumn("needs_human_review", prep.any_flag(*FLAG_NAMES))


def audit_sheet(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """A random n together with all flagged rows, each row once, with blank reviewer columns."""
    random = rel.exact_sample(df, key, n, seed).select(F.col(key).alias("__k")).withColumn("__pick", F.lit(True))
    chosen = df.join(random, F.col(key) == F.col("__k"), "left")
    keep = F.coalesce("__pick", F.lit(False)) | F.col("needs_human_review")
    unique = prep.first_per_key(chosen.filter(keep).drop("__k", "__pick"), [key], _comparable(df, key))
    return prep.add_blank(unique, *REVIEW_COLUMNS).orderBy(key)


def _comparable(df: DataFrame, key: str) -> list[str]:
    return [c for c, t in df.dtypes if c != key and not t.startswith(("map", "variant"))][:1]


def audit_statistics(df: DataFrame, correct: str, failure: str) -> DataFrame:
    """Share correct, and the most frequent failure mode (ties by name)."""
    counts = df.groupBy(F.col(failure).alias("failure_mode")).agg(
        F.count(correct).alias("n"), F.sum(correct).alias("ok"))
    named = F.col("failure_mode").isNotNull() & (F.col("failure_mode") != "")
    rank = F.struct((-F.col("n")).alias("n"), "failure_mode")
    return counts.agg(
        F.sum("n").alias("n_audited"), (F.sum("ok") / F.sum("n")).alias("share_correct"),
        F.min_by(F.when(named, F.col("failure_mode")), F.when(named, rank)).alias("modal_failure"))


def confusion(df: DataFrame, gold: str, pred: str, by: Sequence[str] = (), nulls: str | None = None) -> DataFrame:
    """Counts per (gold, predicted): the only pass over the data. ``nulls`` names missing labels."""
    g, p = F.col(gold).cast("string"), F.col(pred).cast("string")
    if nulls is not None:
        g, p = F.coalesce(g, F.lit(nulls)), F.coalesce(p, F.lit(nulls))
    rows = df.select(*by, g.alias("gold"), p.alias("pred")).na.drop(subset=["gold", "pred"])
    return rows.groupBy(*by, "gold", "pred").agg(F.count(F.lit(1)).alias("n"))


def classification_report(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, from the counts of :func:`confusion`."""
    hit = F.when(F.col("gold") == F.col("pred"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("gold").alias("cls"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("pred").alias("cls"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")))
    sums = table.select(*by, F.explode(sides).alias("s")).groupBy(*by, F.col("s.cls").alias("class")).agg(
        F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"), F.sum("s.tp").alias("tp"))
    zero_div = F.lit(0.0)
    rows = sums.withColumns({
        "precision": F.coalesce(F.try_divide("tp", "predicted"), zero_div),
        "recall": F.coalesce(F.try_divide("tp", "support"), zero_div)})
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0)
    return rows.withColumn("f1", f1)


def overall_scores(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Macro averages and accuracy; a class without gold and predictions cannot occur."""
    return report.groupBy(*by).agg(
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"), (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.sum("support").alias("n"))


def evaluate_against_gold(gold: DataFrame, predicted: DataFrame, key: str, gold_col: str, pred_col: str):
    """Left join on the key, then the report; a gold row without prediction counts as class (none)."""
    joined = gold.select(key, gold_col).join(predicted.select(key, pred_col), key, "left")
    return classification_report(confusion(joined, gold_col, pred_col, nulls="(none)"))


PLACE_RANK = {"unknown": 0, "country_only": 1, "admin1_or_state": 2, "city_or_local": 3}


def merge_chunks(df: DataFrame, doc: str, chunk: str, confidence: str, scalars: Sequence[str],
                 actors: str, precision: str) -> DataFrame:
    """One record per document: fields of the most confident chunk, all actors, most specific place.

    Actors are made distinct before they are gathered, so a list holds the different names only.
    """
    best = F.max_by(F.struct(*scalars), F.struct(F.col(confidence), -F.col(chunk))).alias("__best")
    pairs = [F.lit(x) for kv in PLACE_RANK.items() for x in kv]
    rank = F.try_element_at(F.create_map(*pairs), F.col(precision))
    place = F.max_by(precision, F.struct(rank, F.col(confidence), -F.col(chunk))).alias(precision)
    base = df.groupBy(doc).agg(best, place, F.max(confidence).alias(confidence), F.count(F.lit(1)).alias("n_chunks"))
    names = df.select(doc, F.explode(actors).alias("__a")).distinct()
    sets = names.groupBy(doc).agg(F.sort_array(F.collect_list("__a")).alias(actors))
    return base.join(sets, doc, "left").select(
        doc, "__best.*", precision, confidence, "n_chunks", F.coalesce(actors, F.array().cast("array<string>")).alias(actors))


def abstain(df: DataFrame, label: str, confidence: str, cut: float, out: str, other: str = "other") -> DataFrame:
    return df.withColumn(out, F.when(F.col(confidence) < cut, F.lit(other)).otherwise(F.col(label)))


def abstention_curve(df: DataFrame, label: str, gold: str, confidence: str, cuts: Sequence[float]) -> DataFrame:
    """Queue size and accuracy of the rows kept at each cut, all cuts in one pass."""
    structs = []
    wide = []
    hit = (F.col(label) == F.col(gold)).cast("int")
    for i, cut in enumerate(cuts):
        kept = F.col(confidence) >= cut
        wide += [F.count_if(~kept).alias(f"q{i}"), F.avg(F.when(kept, hit)).alias(f"a{i}")]
        structs.append(F.struct(F.lit(float(cut)).alias("cut"), F.col(f"q{i}").alias("n_queue"), F.col(f"a{i}").alias("accuracy_kept")))
    return df.agg(*wide).select(F.inline(F.array(*structs)))


