"""Communities on packed links against the same steps on tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicframe.operators import graph as gr


def test_rounded_as_spark_rounds(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-9, 9, 500), [0.0, 5e-10, -5e-10, 1.5e-9, 2.5e-9, 0.1234567885, 3.0000000005, 5e15 + 1, 1e300]])
    frame = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, x double").withColumn("r", F.round("x", 9))
    assert gr.rounded(x).tolist() == [r["r"] for r in frame.orderBy("i").collect()]


@pytest.mark.parametrize("least, loops", [(1 << 16, True), (40, False)])
def test_rounds_on_blocks_are_those_on_tables(spark, monkeypatch, least, loops):
    """In one block and in several, with ids that are not in order, weights and self-loops; modularity and contraction too."""
    monkeypatch.setattr(gr, "LEAST_OF_BLOCK", least)
    rng = np.random.default_rng(7)
    pairs = {(int(a) * 37 % 101 - 50, int(b) * 37 % 101 - 50): float(w) / 4 for a, b, w in zip(*rng.integers(0, 60, (2, 300)), rng.integers(1, 9, 300), strict=True) if a < b}
    rows = [(a, b, w) for a, b, w in [(a, b, w) for (a, b), w in pairs.items()] + [(b, a, w) for (a, b), w in pairs.items()]]
    rows += [(rows[0][0], rows[0][0], 3.0)] * loops
    edges = spark.createDataFrame(rows, "src long, dst long, w double")
    strength = edges.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("k")).cache()
    plain, m2 = strength.select("id", F.col("id").alias("community")), sum(w for _, _, w in rows)
    with gr.neighbourhoods(edges) as links:
        assert len(links.keys) == (1 if least > 40 else min(8, -(-len(rows) // 40)))
        labels = links.start()
        for turn in range(4):
            expected = {r["id"]: (r["community"], r["moved"]) for r in gr._move_round(edges, strength, plain, m2, "s", turn).collect()}
            step = gr.materialise(links.moved(labels, m2, f"s-{turn}"))
            found = {r["id"]: r["community"] for r in links.labelled(step).collect()}
            assert found == {i: c for i, (c, _) in expected.items()}
            sums = step.agg(F.sum("moved"), F.sum("n")).first()
            assert sums[0] == sum(m for _, m in expected.values()) and sums[1] == len(expected)
            labels, plain = step, spark.createDataFrame([(i, c) for i, (c, _) in expected.items()], "id long, community long")
        assert links.modularity(labels, m2) == pytest.approx(gr.modularity(edges, plain), abs=1e-12)
        to = dict(found)
        sums = {}
        for a, b, w in rows:
            sums[to[a], to[b]] = sums.get((to[a], to[b]), 0.0) + w
        assert {(r["src"], r["dst"]): r["w"] for r in links.contracted(labels).collect()} == sums


def test_a_round_moves_labels_and_no_links(spark):
    """What is shuffled in a round is a row for each unit and block, however many links there are."""
    edges = spark.createDataFrame([(a, b, 1.0) for a in range(80) for b in range(80) if a != b and (a + b) % 3], "src long, dst long, w double")
    with gr.neighbourhoods(edges) as links:
        plan = links.moved(gr.materialise(links.start()), 1.0, "s")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "of" in exchanges[0]
