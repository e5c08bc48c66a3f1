"""The registered queries of this package and the DuckDB texts of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicframe.llm import (
    exact_topk,
    importance_resampling,
    language_id,
    line_dedup,
    lm_scoring,
    mixing,
    oracles,
    packing,
    product_codes,
    quality_rules,
    simhash_dedup,
    substring_dedup,
    suffix_dedup,
    toxicity,
)
from civicframe.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def wrap(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return wrap


@register(oracles.SUBSTRING_DEDUP)
def op1_substring_dedup(t: Tables) -> DataFrame:
    rows = substring_dedup.remove_repeats(t.documents, length=35)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@register(oracles.EXACT_TOPK)
def op2_exact_topk(t: Tables) -> DataFrame:
    return exact_topk.top_k(t.embeddings, k=5, every=50)


@register(oracles.QUALITY_RULES)
def op3_quality_rules(t: Tables) -> DataFrame:
    return quality_rules.judge(t.documents).drop("host_rate")


@register()
def op4_lm_scoring(t: Tables) -> DataFrame:
    return lm_scoring.score_documents(t.documents)


@register()
def op5_best_fit_packing(t: Tables) -> DataFrame:
    return packing.pack_documents(t.documents, public_tokenizers.path("byte_bpe_50k.json"))


@register()
def op6_toxicity(t: Tables) -> DataFrame:
    return toxicity.score_documents(t.documents, t.labels)


@register(oracles.LINE_DEDUP)
def op7_line_dedup(t: Tables) -> DataFrame:
    rows = line_dedup.drop_recurring_lines(t.documents)
    return rows.select("doc_id", "n_lines", "n_dropped", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))


@register()
def op8_simhash_near_dedup(t: Tables) -> DataFrame:
    return simhash_dedup.near_duplicates(t.documents, shingle=3, distance=3)


@register()
def op9_language_id(t: Tables) -> DataFrame:
    return language_id.identify(t.documents)


@register(oracles.MIXING)
def op10_mixing(t: Tables) -> DataFrame:
    return mixing.plan_mix(t.documents).select("doc_id", "size", "source_size", "target", "taken")


@register(oracles.PRODUCT_CODES)
def op11_vector_compression(t: Tables) -> DataFrame:
    codes, books = product_codes.compress(t.embeddings, parts=8, entries=16, rounds=6)
    rows = product_codes.with_label_error(codes)
    return rows.select("vec_id", "code", "error", "label_error", F.lit(product_codes.digest(books)).alias("codebooks_sha256"))


@register(oracles.SUFFIX_DEDUP)
def op12_suffix_array_dedup(t: Tables) -> DataFrame:
    rows = suffix_dedup.remove_copies(t.documents, length=100)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register(oracles.RESAMPLING)
def op13_importance_resampling(t: Tables) -> DataFrame:
    return importance_resampling.resample(t.documents, t.benchmark, low=1, high=1, buckets=10_000, percent=10, least_words=20, seed="2024")
