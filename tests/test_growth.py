"""Steps that must not send or hold more than the input asks for."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from civicframe.functions.hashing import hash48
from civicframe.operators import graph as gr
from civicframe.operators import textual
from civicframe.operators import replicates as rp
from civicframe.operators import topics as tp


def test_blocks_of_topics_share_the_numbers_of_their_terms(spark, monkeypatch):
    """Blocks lie in batches: each term of a batch is sent once, and the model is the same to the last digit."""
    rng = np.random.default_rng(3)
    words = [f"w{c}" for c in "abcdefghij"]
    rows = [(i, " ".join(rng.choice(words, 12))) for i in range(200)]
    docs = spark.createDataFrame(rows, "d long, t string").repartition(2)
    found = []
    for size, most in ((2, 64), (2, 1)):
        monkeypatch.setattr(tp, "DOCS_PER_BLOCK", size)
        monkeypatch.setattr(tp, "BLOCKS_PER_BATCH", most)
        model = textual.topic_model(docs, "d", "t", k=3, iterations=3, stop=[])
        found.append(({r["term"]: r["w"] for r in model.weights.collect()}, model.seen.count(), sorted(model.documents().collect())))
    assert found[0][1] <= 16 < found[1][1]
    assert found[0][0] == found[1][0] and found[0][2] == found[1][2]


def test_models_share_counts(spark):
    docs = spark.createDataFrame([(i, "apple pear " * (i % 3) + "plum" * (i % 2) + " sea" * (i < 3)) for i in range(12)], "d long, t string")
    counts = textual.topic_counts(docs, "d", "t", stop=[])
    for least in (2, 5):
        own, shared = (textual.topic_model(docs, "d", "t", k=2, min_df=least, iterations=2, stop=[], counts=c) for c in (None, counts))
        assert sorted(own.weights.collect()) == sorted(shared.weights.collect())


def test_a_round_of_moves_reads_no_links_of_the_resting_half(spark):
    links = [(a, b) for a in range(12) for b in range(12) if a != b and a // 4 == b // 4]
    edges = spark.createDataFrame(links, "src long, dst long")
    moves = hash48("s-0", "src") % 2 == 0
    strength = spark.createDataFrame([(v, 3.0) for v in range(12)], "id long, k double")
    labels = strength.select("id", F.col("id").alias("community"))
    whole = gr._move_round(edges.withColumn("w", F.lit(1.0)), strength, labels, 36.0, "s", 0)
    half = gr._move_round(edges.withColumn("w", F.when(moves, 1.0).otherwise(F.raise_error(F.lit("read")).cast("double"))), strength, labels, 36.0, "s", 0)
    found = sorted(whole.collect())
    assert found == sorted(half.collect()) and len(found) == 12
    resting = {r["src"] for r in edges.where(~moves).collect()}
    assert any(r["moved"] for r in found) and all(r["id"] == r["community"] and not r["moved"] for r in found if r["id"] in resting)


def test_replicates_are_worked_out_in_small_matrices():
    """An executor runs a worker for each core, so what one holds counts several times."""
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(10_000)), pa.array(np.arange(10_000) * 7)], names=["h1", "h2"])
    parts = list(rp._numbers(batch, 500))
    assert sum(len(n) for _, n in parts) == 10_000 and max(n.nbytes for _, n in parts) <= 1 << 21
