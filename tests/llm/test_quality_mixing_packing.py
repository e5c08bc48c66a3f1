"""Quality rules, mixing and packing against brute force and round trips."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from civicframe.llm import mixing, packing, quality_rules
from tests.llm.fixtures import awkward, empty, rows_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_measures():
    text = "a b c\nx a b c\nx\n \nx a b c #*$"
    words = text.split()
    starts = [i for i in range(len(words) - 2) if [words[k:k + 3] for k in range(len(words) - 2)].count(words[i:i + 3]) > 1]
    covered = {p for i in starts for p in (i, i + 1, i + 2)}
    assert quality_rules.text_measures(text) == (len(words), sum(map(len, words)), 3, 0, len(covered), True)
    assert quality_rules.text_measures("q\nq\nr\nq") == (4, 4, 0, 2, 0, True)
    assert quality_rules.text_measures(None) == (0, 0, 0, 0, 0, True)


def good(i, words=60):
    return " ".join(f"w{i}x{k}" for k in range(words))


def test_hosts_with_many_failures_are_rejected(spark):
    rows = [(i, good(i) if i % 10 else "short", "good", ) for i in range(200)]
    rows += [(1000 + i, good(i) if i % 20 == 0 else "short", "bad") for i in range(200)]
    rows += [(2000, "short", "single"), (2001, good(5), None), (2002, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    for key, text, source in rows:
        failed = text is None or len(text.split()) < 50
        assert (got[key]["base_failed"], got[key]["kept"]) == (failed, not failed and source != "bad")
    kept = quality_rules.filter_documents(docs.withColumn("host", F.lit(1)).withColumn("fails", F.lit("x")))
    assert kept.columns == ["doc_id", "text", "source", "host", "fails"]
    assert {r["doc_id"] for r in kept.collect()} == {k for k, r in got.items() if r["kept"]}


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark, [good(1), good(2)], extra=True)
    got = quality_rules.judge(docs)
    assert got.count() == docs.count()
    assert quality_rules.judge(empty(spark)).count() == 0
    assert quality_rules.filter_documents(empty(spark)).count() == 0
    assert quality_rules.filter_documents(docs).columns == docs.columns


def fair_targets(sizes, weights=(1, 2, 3), limit=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        rest = sum(weight[s] for s in names if s not in capped)
        level = (sum(sizes.values()) - sum(limit * sizes[s] for s in capped)) / rest if rest else 0
        above = {s for s in names if s not in capped and weight[s] * level > limit * sizes[s]}
        if not above:
            return {s: limit * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= above


@pytest.mark.parametrize("ranked", [10_000, 3])
def test_mix(spark, monkeypatch, ranked):
    monkeypatch.setattr(mixing, "RANKED_ROWS", ranked)
    rng = np.random.default_rng(2)
    texts = [" ".join(["w"] * int(n)) for n in rng.integers(0, 40, 600)]
    rows = [(i, t, None if i % 50 == 0 else f"s{min(i % 7, 4)}" if i > 5 else "tiny") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.plan_mix(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    wanted = fair_targets(sizes)
    by_source = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["size"] == len(texts[r["doc_id"]].split()) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]])
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        by_source[r["source"]] += r["taken"]
    for s, n in by_source.items():
        assert abs(n - wanted[s]) <= 20  # half of the longest document
    again = {r["doc_id"]: r["taken"] for r in mixing.plan_mix(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {r["doc_id"]: r["copies"] for r in got if r["copies"]}


def test_higher_odds_are_taken_more_often(spark):
    """With odds, the chance of a further copy follows them, and the mix still meets its targets."""
    rows = [(i, "w " * (5 + i % 7), "ab"[i % 2], 1.0 + 3.0 * (i % 3 == 0) if i % 5 else None) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, worth double")
    got = {r["doc_id"]: r for r in mixing.plan_mix(docs, weights=(1, 2), odds="worth").collect()}
    for source in "ab":
        of = [r for r in rows if r[2] == source]
        whole = min(got[r[0]]["copies"] for r in of)
        extra = {name: np.mean([got[r[0]]["copies"] - whole for r in of if r[3] == worth]) for name, worth in (("none", None), ("low", 1.0), ("high", 4.0))}
        assert extra["none"] == 0 and extra["high"] > extra["low"] + 0.2 > 0.2
        taken, target = sum(got[r[0]]["taken"] for r in of), got[of[0][0]]["target"]
        assert abs(taken - target) <= 12
    even = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(docs).collect()}
    same = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(docs.withColumn("worth", F.lit(2.5)), odds="worth").collect()}
    assert even == same


def test_mix_of_awkward_rows(spark):
    docs = awkward(spark, extra=True)
    assert mixing.plan_mix(docs).count() == docs.count()
    assert mixing.plan_mix(empty(spark)).count() == 0
    assert mixing.mix_documents(empty(spark)).count() == 0
    assert mixing.mix_documents(docs).columns == docs.columns


def test_pareto_order_follows_the_inclusion_odds(spark):
    rows = spark.range(20_000).select("id", (F.xxhash64("id").bitwiseAND((1 << 40) - 1) / F.lit(float(1 << 40))).alias("u"),
                                      F.when(F.col("id") % 2 == 0, 0.6).otherwise(0.2).alias("p"), F.lit("g").alias("g"), F.lit(1).alias("size"))
    keyed = rows.withColumn("k", mixing.pareto_key(F.col("u"), F.col("p")))
    budget = spark.createDataFrame([("g", 8000.0)], "g string, budget double")
    chosen = mixing.lowest_until(keyed, "g", "k", "size", budget, ("id",)).collect()
    assert len(chosen) == 8000
    assert abs(sum(r["id"] % 2 == 0 for r in chosen) / 10_000 - 0.6) < 0.02


def check_packing(got, docs, capacity):
    full = Tokenizer.from_file(PATH)
    expected = []
    for r in docs.collect():
        ids = [*full.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for k, (start, length) in enumerate(packing.pieces(len(ids), capacity)):
            part = np.array(ids[start:start + length], "<u4").tobytes()
            expected.append((r["doc_id"], k, start, length, zlib.crc32(part)))
        assert packing.pieces(len(ids), capacity)[0][0] == 0
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(expected, key=str)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r["length"] for r in got)


@pytest.mark.parametrize("capacity,per_task", [(2048, 50_000), (64, 5)])
def test_packing_round_trip(spark, capacity, per_task):
    docs = awkward(spark, [good(i, 3 * i + 1) for i in range(60)], extra=True)
    got = packing.pack_documents(docs, PATH, capacity, items_per_task=per_task).collect()
    n, tokens = check_packing(got, docs, capacity)
    assert n <= 1.05 * -(-tokens // capacity) + 2


def test_packing_corpus_comes_near_the_bound(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.pack_documents(docs, PATH, items_per_task=100).collect()
    n, tokens = check_packing(got, docs, packing.CAPACITY)
    assert n <= 1.01 * -(-tokens // packing.CAPACITY) + 1
    assert packing.pack_documents(empty(spark), PATH).count() == 0


def test_packing_rejects_other_lengths(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 9)], "i bigint, n int"), "i", "n", 8)


def test_tokenizer_gives_the_ids_of_the_file():
    """All characters of the plane, alone and between letters, digits and blanks, in the fast and the full reader."""
    full, fast = Tokenizer.from_file(PATH), packing.tokenizer(PATH)
    chars = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000] + ["漢", "한", "\U0001f600", "﻿", "　"]
    for c in chars:
        text = f"a{c}b {c} 1{c}{c}2  {c}\n\n {c}'s"
        assert fast(text).tolist() == full.encode(text, add_special_tokens=False).ids, hex(ord(c))
