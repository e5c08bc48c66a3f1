"""Sums of many replicates in one pass: no row is copied for a replicate.

A replicate gives each row a number from two hashes of the row (:func:`civicframe.functions.hashing.replicate_hash`). A task works
out the numbers of a few thousand rows for all replicates as a matrix, turns them into weights, and adds the
products of weights and values to one accumulator per replicate. It sends one row a replicate.

Replicates that draw a fixed number of rows, those with the lowest numbers, need the number at the cut first. Histograms of a few
bits, one for each cut, narrow it down pass by pass; when few rows share the bits at the cuts, only those rows are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicframe.functions.hashing import HASH_SPACE, hash48, hash48_second

BITS = HASH_SPACE.bit_length() - 1
#: Numbers of rows x replicates that a task works out at a time.
CELLS = 1 << 18
#: Rows that share the bits at the cuts, over all replicates, that are ranked; more are narrowed down further.
RANKED = 1_000_000
#: Cuts (blocks x replicates) whose states the driver holds and a task counts.
MOST_CUTS = 20_000


def prepared(df: DataFrame, key: str, seed: str, values: Sequence[Column], block: Column | None = None) -> DataFrame:
    """(block, key, h1, h2, z): the hashes of the key and the values of each row."""
    z = F.array(*[v.cast("double") for v in values])
    return df.select((F.lit(0) if block is None else block).cast("int").alias("block"), F.col(key).alias("key"),
                     hash48(seed, key).alias("h1"), hash48_second(seed, key).alias("h2"), z.alias("z"))


def _numbers(batch: pa.RecordBatch, reps: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Slices of a batch with the numbers of their rows (rows x replicates)."""
    h1, h2 = batch["h1"].to_numpy()[:, None], batch["h2"].to_numpy()[:, None]
    turns = np.arange(1, reps + 1, dtype=np.int64)[None]
    rows = max(1, CELLS // reps)
    for at in range(0, len(batch), rows):
        part = slice(at, min(at + rows, len(batch)))
        yield part, (h1[part] + turns * h2[part]) & (HASH_SPACE - 1)


def _values(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch["z"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _added(rows: DataFrame, width: int) -> DataFrame:
    return rows.groupBy("rep").agg(F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s"))


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(matrix.ravel()))


def weighted_sums(rows: DataFrame, reps: int, width: int, weigh: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(rep, s): for each replicate the sums of the ``width`` values times ``weigh(numbers)``; values must not be null."""

    def run(batches):
        sums, any_row = np.zeros((reps, width)), False
        for batch in batches:
            z = _values(batch, width)
            for part, numbers in _numbers(batch, reps):
                sums += weigh(numbers).T.astype(np.float64) @ z[part]
                any_row = True
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, reps + 1, dtype=np.int32)), _lists(sums)], names=["rep", "s"])

    return _added(rows.mapInArrow(run, "rep int, s array<double>"), width)


def _digit_counts(rows: DataFrame, reps: int, prefix: np.ndarray, shift: int, bits: int) -> DataFrame:
    """(cut, digit, n): of the rows whose bits above agree with a cut's prefix, how many have each value of the next ``bits``."""
    blocks, per_cut = prefix.shape[1], 1 << bits

    def run(batches):
        counts = np.zeros(reps * blocks * per_cut, np.int64)
        first = np.arange(reps)[None] * blocks
        for batch in batches:
            block = batch["block"].to_numpy()
            for part, numbers in _numbers(batch, reps):
                at = first + block[part][:, None]
                here = (numbers >> (shift + bits)) == prefix.ravel()[at]
                digit = (numbers[here] >> shift) & (per_cut - 1)
                counts += np.bincount(at[here] * per_cut + digit, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used // per_cut), pa.array((used % per_cut).astype(np.int32)), pa.array(counts[used])],
                                         names=["cut", "digit", "n"])

    sent = rows.select("block", "h1", "h2").mapInArrow(run, "cut bigint, digit int, n bigint")
    return sent.groupBy("cut", "digit").agg(F.sum("n").alias("n"))


def sums_of_lowest(rows: DataFrame, take: np.ndarray, sizes: np.ndarray, reps: int, width: int) -> DataFrame:
    """(rep, s): the sums of the values of the rows with the lowest numbers of each block, exactly ``take[block]`` of its
    ``sizes[block]`` rows in every replicate; equal numbers go by key. At most MOST_CUTS blocks x replicates.
    """
    blocks = len(take)
    spark = rows.sparkSession
    prefix = np.zeros((reps, blocks), np.int64)
    left = np.tile(np.minimum(np.maximum(take, 0), sizes)[None], (reps, 1)).astype(np.int64)
    shift, bits = BITS, min(8, max(3, int(math.log2(max(1, sizes.max() if blocks else 1) / 32 + 1))))
    most = int(sizes.sum()) * reps
    while most > RANKED and shift:
        step = min(bits, shift)
        shift -= step
        counts = _digit_counts(rows, reps, prefix, shift, step)
        state = spark.createDataFrame([(i, int(n)) for i, n in enumerate(left.ravel())], "of bigint, need bigint")
        upto = F.sum("n").over(W.partitionBy("cut").orderBy("digit").rowsBetween(W.unboundedPreceding, 0))
        reached = counts.withColumn("upto", upto).join(state, F.col("cut") == F.col("of")).where("upto >= need and upto - n < need")
        prefix <<= step
        most = 0
        none = left.ravel() == 0
        for r in reached.select("cut", "digit", "n", "upto", "need").collect():  # a row for each cut at most
            i = r["cut"]
            prefix.ravel()[i] |= r["digit"]
            left.ravel()[i] = r["need"] - r["upto"] + r["n"]
            most += r["n"]
        prefix.ravel()[none] = -1  # nothing is taken: no number is below
    if shift == BITS:  # few rows: all of them are ranked
        prefix[:] = np.where(left == 0, -1, 0)

    key_type = dict(rows.dtypes)["key"]

    def run(batches):
        sums, any_row = np.zeros((reps, width)), False
        for batch in batches:
            z, block = _values(batch, width), batch["block"].to_numpy()
            for part, numbers in _numbers(batch, reps):
                any_row = True
                cut = prefix.T[block[part]]
                top = numbers >> shift
                sums += (top < cut).T.astype(np.float64) @ z[part]
                at, rep = np.nonzero(top == cut)
                if len(at):
                    here = pa.array(at + part.start)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((rep + 1).astype(np.int32)), _lists(z[part][at]), batch["block"].take(here),
                         pa.array(numbers[at, rep]), batch["key"].take(here)], names=["rep", "s", "block", "number", "key"])
        if any_row:
            none = pa.nulls(reps, pa.int32()), pa.nulls(reps, pa.int64()), pa.nulls(reps, batch["key"].type)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, reps + 1, dtype=np.int32)), _lists(sums), *none],
                                             names=["rep", "s", "block", "number", "key"])

    found = rows.mapInArrow(run, f"rep int, s array<double>, block int, number bigint, key {key_type}")
    need = spark.createDataFrame([(r + 1, b, int(left[r, b])) for r in range(reps) for b in range(blocks)], "r int, b int, need bigint")
    place = F.row_number().over(W.partitionBy("rep", "block").orderBy("number", "key"))
    at_cut = found.where("block is not null").withColumn("place", place).join(
        need, (F.col("rep") == F.col("r")) & (F.col("block") == F.col("b"))).where("place <= need")
    return _added(found.where("block is null").select("rep", "s").unionByName(at_cut.select("rep", "s")), width)
