"""Exact top-k search by distributed histogram selection.

Vectors and queries are packed into blocks; every vector block meets every query block in some task. Each round scores all
pairs and counts, for each query, how many scores fall into each of BINS bins; the bin with the kth score is the range of the
next round. When bins are single integers the kth score is known; a last pass keeps the scores from there on, and ties at
the kth score by the smallest id. Nothing but histograms and the kept rows leaves a task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicframe.llm.common import arrow_pass, pick, shuffle_partitions
from civicframe.session import materialise

BINS = 256
VECTORS_PER_BLOCK, QUERIES_PER_BLOCK = 4_096, 1_024
SCALE = 256
#: Query blocks whose histograms, and queries whose ties, a task holds before it sends them.
HELD_BLOCKS, HELD_QUERIES = 32, 50_000


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, row, v): rows with an id whose vector has no null or non-finite component; v = floor(256 * x) of each."""
    rows = pick(vectors, id=vec_id, v=embedding).withColumn("row", F.monotonically_increasing_id())
    fine = F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return rows.where(fine).select("id", "row", F.transform("v", lambda x: F.floor(x.cast("double") * SCALE).cast("double")).alias("v"))


def _blocks(rows: DataFrame, per_block: int, name: str) -> DataFrame:
    """Blocks of up to ``per_block`` rows: their number, ids, rows and matrix. Shorter vectors are filled with zeros."""

    def make():
        def step(batch):
            out = {k: [] for k in ("ids", "rows", "dims", "matrix")}
            for at in range(0, len(batch), per_block):
                part = batch.slice(at, per_block)
                lists = part["v"]
                lengths = pa.compute.list_value_length(lists).to_numpy()
                dims = int(lengths.max())
                matrix = np.zeros((len(part), dims))
                matrix[np.arange(dims)[None] < lengths[:, None]] = lists.flatten().to_numpy()
                for k, v in zip(out, (part["id"].to_numpy().astype("<i8").tobytes(), part["row"].to_numpy().tobytes(), dims, matrix.tobytes()), strict=True):
                    out[k].append(v)
            return out

        import pyarrow.compute  # noqa: F401

        return step

    packed = arrow_pass(rows, "ids binary, rows binary, dims int, matrix binary", make)
    return materialise(packed.withColumn(name, F.monotonically_increasing_id()))


def _matrix(block: dict, prefix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    read = lambda k: np.frombuffer(block[f"{prefix}_{k}"], "<i8")
    ids = read("ids")
    return ids, read("rows"), np.frombuffer(block[f"{prefix}_matrix"]).reshape(len(ids), block[f"{prefix}_dims"])


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products as integers: by floating point while sums stay exact in it, else by integer arithmetic."""
    dims = min(q.shape[1], x.shape[1])
    q, x = q[:, :dims], x[:, :dims]
    if dims == 0 or not len(x):
        return np.zeros((len(q), len(x)), np.int64)
    if dims * np.abs(q).max() * np.abs(x).max() < 2.0**53:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def _pairs(queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """Every query block beside every vector block. Query blocks are repeated for each share of the vector blocks."""
    parts = shuffle_partitions(vectors.sparkSession)
    shares = vectors.withColumn("share", F.pmod(F.xxhash64("vb"), F.lit(parts)).cast("int"))
    asked = queries.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    named = shares.select("share", *[F.col(c).alias(f"x_{c}") for c in ("ids", "rows", "dims", "matrix")])
    return asked.join(named, "share")


def _histograms(pairs: DataFrame) -> DataFrame:
    """(qb, place, bin, n): of each query's scores in its range, summed over the pairs that a task holds before they leave it."""

    def run(batches):
        from collections import defaultdict

        counts = defaultdict(lambda: 0)

        def flushed():
            for qb, n in counts.items():
                at = np.flatnonzero(n)
                at = at[at % (BINS + 1) < BINS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), qb)), pa.array((at // (BINS + 1)).astype(np.int32)), pa.array((at % (BINS + 1)).astype(np.int32)),
                     pa.array(n[at].astype(np.int64))], names=["qb", "place", "bin", "n"])
            counts.clear()

        for batch in batches:
            for block in batch.to_pylist():
                _, qrows, q = _matrix(block, "q")
                _, xrows, x = _matrix(block, "x")
                low, width = np.frombuffer(block["low"], "<i8"), np.frombuffer(block["width"], "<i8")
                bins = (_scores(q, x) - low[:, None]) // width[:, None]
                bins[(bins < 0) | (bins >= BINS) | (qrows[:, None] == xrows[None])] = BINS
                bins += np.arange(len(q))[:, None] * (BINS + 1)
                if block["qb"] not in counts and len(counts) >= HELD_BLOCKS:
                    yield from flushed()
                counts[block["qb"]] = counts[block["qb"]] + np.bincount(bins.ravel(), minlength=len(q) * (BINS + 1))
        yield from flushed()

    found = pairs.mapInArrow(run, "qb bigint, place int, bin int, n bigint")
    return found.groupBy("qb", "place", "bin").agg(F.sum("n").alias("n"))


def _ranges(state: DataFrame) -> DataFrame:
    """(qb, low, width) with the ranges of a block's queries packed in their order."""
    in_order = F.array_sort(F.collect_list(F.struct("place", "low", "width")))
    packed = state.groupBy("qb").agg(in_order.alias("s"))

    def make():
        def step(batch):
            read = lambda k: [np.array([x[k] for x in s], "<i8").tobytes() for s in batch["s"].to_pylist()]
            return {"of": batch["qb"], "low": read("low"), "width": read("width")}

        return step

    return arrow_pass(packed, "of bigint, low binary, width binary", make)


def _kept(pairs: DataFrame, k: int) -> DataFrame:
    """(row, id, vec_id, vec_row, score): scores above the kth, and of those equal to it the ``k`` with the smallest ids in a task."""

    def run(batches):
        ties: dict = {}

        def tied():
            flat = [(row, qid, vid, vrow, kth) for (row, qid, kth), found in ties.items() for vid, vrow in found]
            return _rows(*np.array(flat, np.int64).reshape(-1, 5).T)

        for batch in batches:
            for block in batch.to_pylist():
                qids, qrows, q = _matrix(block, "q")
                xids, xrows, x = _matrix(block, "x")
                kth = np.frombuffer(block["low"], "<i8")
                scores = _scores(q, x)
                other = qrows[:, None] != xrows[None]
                i, j = np.nonzero((scores > kth[:, None]) & other)
                yield _rows(qrows[i], qids[i], xids[j], xrows[j], scores[i, j])
                order = np.lexsort((xrows, xids))
                equal = (scores[:, order] == kth[:, None]) & other[:, order]
                equal &= np.cumsum(equal, axis=1) <= k
                i, j = np.nonzero(equal)
                j = order[j]
                touched = set()
                for a, b in zip(i.tolist(), j.tolist(), strict=True):
                    key = (int(qrows[a]), int(qids[a]), int(kth[a]))
                    touched.add(key)
                    ties.setdefault(key, []).append((int(xids[b]), int(xrows[b])))
                for key in touched:
                    if len(ties[key]) > k:
                        ties[key] = sorted(ties[key])[:k]
                if len(ties) >= HELD_QUERIES:
                    yield tied()
                    ties.clear()
        yield tied()

    return pairs.mapInArrow(run, "row bigint, id bigint, vec_id bigint, vec_row bigint, score bigint")


def _rows(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row", "id", "vec_id", "vec_row", "score"])


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best other rows of each row whose id is divisible by ``every``.

    The score is the inner product of the vectors after floor(256 * x); ties go to the smaller id. Fewer than ``k`` other rows are
    all returned. Rows without an id, without a vector, or with a null or non-finite component take no part. Shorter vectors
    count as filled with zeros, and empty ones score 0. Repeated rows are rows of their own, as queries and as candidates. An empty
    table gives an empty table; other columns are not read. Scores beyond 64 bits raise an error.
    """
    spark = vectors.sparkSession
    rows = materialise(quantised(vectors, vec_id, embedding))
    n, norm = rows.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if norm >= 2.0**62:
        raise ValueError("scores would not fit 64 bits")
    reach = int(math.ceil(norm)) + 1
    vector_blocks = _blocks(rows, VECTORS_PER_BLOCK, "vb")
    asked = rows.where(F.col("id") % every == 0)
    m = asked.count()
    query_blocks = _blocks(asked.repartition(max(1, math.ceil(m / QUERIES_PER_BLOCK))), QUERIES_PER_BLOCK, "qb").withColumnsRenamed(
        {c: f"q_{c}" for c in ("ids", "rows", "dims", "matrix")})
    width = 1
    while width * BINS < 2 * reach + 1:
        width *= BINS  # so that the bins of a round fill one bin of the round before
    members = query_blocks.select("qb", F.explode(F.sequence(F.lit(0), (F.length("q_ids") / 8).cast("int") - 1)).alias("place"))
    state = materialise(members.select(
        "qb", "place", F.lit(-reach).cast("bigint").alias("low"), F.lit(width).cast("bigint").alias("width"),
        F.lit(min(k, n - 1)).cast("bigint").alias("need")))
    while True:
        pairs = _pairs(query_blocks.join(_ranges(state), F.col("qb") == F.col("of")).drop("of"), vector_blocks)
        down = Window.partitionBy("qb", "place").orderBy(F.desc("bin"))
        counted = _histograms(pairs).join(state, ["qb", "place"]).withColumn("upto", F.sum("n").over(down)).where("upto >= need")
        best = counted.groupBy("qb", "place").agg(F.max(F.struct("bin", "low", "width", (F.col("need") - F.col("upto") + F.col("n")).alias("need"))).alias("b"))
        left = F.lit(max(1, width // BINS)).cast("bigint")
        state = materialise(best.select("qb", "place", (F.col("b.low") + F.col("b.bin") * F.col("b.width")).alias("low"), left.alias("width"), "b.need"))
        if width == 1:
            break
        width //= BINS
    pairs = _pairs(query_blocks.join(_ranges(state), F.col("qb") == F.col("of")).drop("of"), vector_blocks)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "vec_row")
    return _kept(pairs, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("id").alias("query_id"), "rank", "vec_id", "score")
