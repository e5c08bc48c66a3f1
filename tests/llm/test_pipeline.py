"""The pipeline against the brute-force versions of its stages."""

import re

import pytest

import corpus_pipeline
from civicframe.llm import packing, quality_rules
from tests.llm import test_line_dedup, test_simhash_dedup
from tests.llm.test_quality_mixing_packing import check_packing, fair_targets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Whole documents of sf0.001 with planted cases: rejects, copies, near copies, shared lines, nulls."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = [tuple(r) for r in docs]
    long = [r for r in rows if len(r[1].split()) > 120][:12]
    for k, r in enumerate(long):
        words = r[1].split(" ")
        words[40] = "changed"
        rows.append((10_000 + k, r[1] + f"\nfooter of page {k} at the end of all things", r[2], r[3], 0))
        rows.append((11_000 + k, " ".join(words), r[2], r[3], 0))
        rows.append((12_000 + k, r[1], r[2], r[3], 0))
    rows += [(13_000, None, "en", "src1", None), (13_001, "", None, None, 0), (13_002, "too short", "en", "src2", 9)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    return path, rows


def test_stages(spark, folder):
    path, rows = folder
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "SimHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    docs = spark.read.parquet(f"{path}/documents.parquet")

    kept = corpus_pipeline.quality(spark, docs, path)
    assert kept.columns == COLUMNS
    expected = [r for r in rows if not quality_rules.text_measures(r[1])[-1]]  # no host fails as often as the limit
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(expected, key=str)

    clean = corpus_pipeline.lines(spark, spark.createDataFrame(expected, docs.schema), path)
    assert clean.columns == COLUMNS
    brute = {key: (text, dropped) for key, _, dropped, text in test_line_dedup.brute([(r[0], r[1]) for r in expected])}
    expected = [(r[0], brute[r[0]][0], r[2], r[3], len(brute[r[0]][0]) if brute[r[0]][1] else r[4]) for r in expected]
    assert any(b[1] for b in brute.values())
    assert sorted(map(tuple, clean.collect()), key=str) == sorted(expected, key=str)

    single = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(expected, docs.schema), path)
    assert single.columns == COLUMNS
    stay = {key for key, _, low in test_simhash_dedup.slow_components([(r[0], r[1]) for r in expected]) if key == low}
    assert len(stay) < len(expected)
    expected = [r for r in expected if r[0] in stay]
    assert sorted(map(tuple, single.collect()), key=str) == sorted(expected, key=str)

    mixed = corpus_pipeline.mix(spark, spark.createDataFrame(expected, docs.schema), path)
    assert mixed.columns == COLUMNS
    taken, sizes, longest = {}, {}, {}
    for r in expected:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
        sizes[r[3]] = sizes.get(r[3], 0) + n
        longest[r[3]] = max(n, longest.get(r[3], 0))
    for r in mixed.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    for s, target in fair_targets(sizes).items():
        assert abs(taken.get(s, 0) - target) <= longest[s] / 2 + 1
    assert {tuple(r) for r in mixed.collect()} <= set(expected)


def test_run_packs_the_mix(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, path).collect(), docs.schema)
    n, tokens = check_packing(corpus_pipeline.run(spark, path).collect(), docs, packing.CAPACITY)
    assert n <= 1.03 * -(-tokens // packing.CAPACITY) + 1
