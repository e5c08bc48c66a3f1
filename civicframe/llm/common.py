"""What the operators of this package share: words, column picking, Arrow passes, null-safe keys."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names: ``pick(df, text="body")``.

    Columns are found by exact name and position, so other columns may have any names.
    """
    missing = [c for c in columns.values() if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}")
    numbered = df.toDF(*[f"__c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"__c{df.columns.index(c)}").alias(name) for name, c in columns.items()])


def same(left: DataFrame, right: DataFrame, *keys: str) -> Column:
    """Equality on the keys in which null equals null."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    return condition


def arrow_pass(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """Run ``make()`` once per task and the function that it returns on every Arrow batch.

    The function returns one list or array per column of ``schema``, all of the same length.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            out = step(batch)
            yield pa.RecordBatch.from_arrays([_column(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array, rows: int = 256) -> Iterator[str | None]:
    """The values of a text column, a few hundred at a time as Python strings."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


def text_udf(schema: str, make: Callable[[], Callable[[str | None], tuple]]):
    """A column function from a text column to a struct; ``make()`` runs once per task.

    Only the text goes to Python; other columns, whatever their types, stay in the JVM.
    """
    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
    from pyspark.sql.types import StructType

    struct = StructType.fromDDL(schema)
    fields, kind = list(to_arrow_schema(struct)), to_arrow_type(struct)

    @F.arrow_udf(struct)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        step = make()
        for texts in batches:
            columns = list(zip(*map(step, texts_of(texts)), strict=True)) or [()] * len(fields)
            yield pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], fields=list(kind))

    return run


def _column(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_BLOCK = 1 << 19
_SEPARATES = np.zeros(256, bool)
_SEPARATES[[0x20, *range(0x09, 0x0E)]] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class WordHashes:
    """64-bit hashes of the words of text columns, taken from their bytes: a polynomial modulo 2**64, scrambled."""

    def __init__(self):
        self._up, self._down = powers(BASE, 2 * _BLOCK), powers(INVERSE, 2 * _BLOCK)

    def rows(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The word hashes of each row; none for null."""
        for hashes, counts in self.slices(column):
            yield from np.split(hashes, np.cumsum(counts)[:-1])

    def slices(self, column: pa.Array, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For a few hundred rows at a time, all their word hashes and the number of words of each row."""
        column = column.fill_null("") if column.null_count else column
        for at in range(0, len(column), rows):
            part = column.slice(at, rows)
            width = np.int64 if pa.types.is_large_string(part.type) else np.int32
            ends = np.frombuffer(part.buffers()[1], width)[part.offset:part.offset + len(part) + 1].astype(np.int64)
            data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
            yield self._hashed(data, ends - ends[0])

    def _hashed(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        word = np.zeros(len(data) + 2, bool)
        word[1:-1] = ~_SEPARATES[data]
        edge = word[1:] != word[:-1]  # at i: between the bytes i - 1 and i
        inner = ends[1:-1]
        first, last = edge & word[1:], edge & word[:-1]
        touching = inner[word[inner] & word[inner + 1]]  # a row ends in a word and the next begins with one
        first[touching] = last[touching] = True
        starts, stops = np.flatnonzero(first), np.flatnonzero(last)
        hashes = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(stops, starts[at] + _BLOCK, side="right")))
            low, high = int(starts[at]), int(stops[to - 1])
            if high - low > len(self._up):  # one word longer than a block
                self._up, self._down = powers(BASE, high - low), powers(INVERSE, high - low)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * self._up[:high - low], out=sums[1:])
            a, b = starts[at:to] - low, stops[at:to] - low
            hashes[at:to] = mixed((sums[b] - sums[a]) * self._down[a])
            at = to
        return hashes, np.diff(np.searchsorted(starts, ends))


def reused(df: DataFrame) -> DataFrame:
    """The frame, computed now and cached on the executors' disks for several readers.

    Blocks of lost executors are computed again. The cache lasts until the caller clears it or the application ends.
    """
    kept = df.persist(StorageLevel.DISK_ONLY)
    kept.count()
    return kept


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
