"""Compressed vectors by product codes, assigned through memoised grid cells.

A vector is cut into parts, and each part is replaced by the index of the nearest entry of that part's codebook. To find it, the part
is put into a cell of a coarse grid. For a box, an entry is dominated if its smallest distance to the box exceeds the largest
distance of another entry; it is then nearest to no point inside. The entries that are left are worked out once for each
cell that a task meets and kept by the cell's hash; only their distances are evaluated exactly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import arrow_pass, pick
from civicframe.session import materialise

SCALE = 4096
#: Grid cells for the extent of a codebook along one component, and cells that a task remembers before it starts anew.
CELLS, REMEMBERED = 2, 100_000
#: Shares into which the rows of a label are dealt when they meet the label's total.
SHARES = 16


class GridCells:
    """Nearest entries of one codebook (entries x components), ties to the lower index."""

    def __init__(self, entries: np.ndarray, remembered: int = REMEMBERED):
        self.entries, self.remembered = entries, remembered
        self.origin = entries.min(axis=0)
        self.width = np.maximum((entries.max(axis=0) - self.origin) // CELLS + 1, 1)
        self.memo: dict[bytes, int] = {}  # cell to row of ``masks``
        self.masks = np.zeros((0, len(entries)), bool)
        self.evaluated = 0  # exact distances so far

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """For each cell, which entries can be nearest to a point of its box."""
        low = (self.origin + cells * self.width)[:, None, :]
        high = low + self.width - 1
        entry = self.entries[None]
        far = np.maximum(np.abs(entry - low), np.abs(entry - high))
        best = self.entries[(far**2).sum(axis=2).argmin(axis=1)][:, None, :]
        # How much farther than ``best`` an entry is changes linearly along each component: it is least at an end of the box.
        ahead = np.minimum((low - entry) ** 2 - (low - best) ** 2, (high - entry) ** 2 - (high - best) ** 2)
        return ahead.sum(axis=2) <= 0

    def _masks_of(self, cells: np.ndarray) -> np.ndarray:
        keys = [c.tobytes() for c in cells]
        if len(self.memo) + len(keys) > self.remembered:
            self.memo, self.masks = {}, self.masks[:0]
        new = [i for i, key in enumerate(keys) if key not in self.memo]
        if new:
            self.memo.update((keys[i], len(self.masks) + k) for k, i in enumerate(new))
            self.masks = np.concatenate([self.masks, self.candidates(cells[new])])
        return self.masks[[self.memo[key] for key in keys]]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each point."""
        index, best = np.zeros(len(points), np.int64), np.full(len(points), np.iinfo(np.int64).max)
        if not len(points) or not points.shape[1]:
            return index, np.zeros(len(points), np.int64)
        cells = (points - self.origin) // self.width
        packed = np.ascontiguousarray(cells).view(np.dtype((np.void, cells.dtype.itemsize * cells.shape[1]))).ravel()
        _, first, of = np.unique(packed, return_index=True, return_inverse=True)
        masks = self._masks_of(cells[first])[of.ravel()]
        for e, entry in enumerate(self.entries):
            at = np.flatnonzero(masks[:, e])
            distance = ((points[at] - entry) ** 2).sum(axis=1)
            self.evaluated += len(at)
            closer = distance < best[at]
            best[at[closer]], index[at[closer]] = distance[closer], e
        return index, best


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, label, largest, v): rows whose vector has no null or non-finite component; v = floor(4096 * x) of each."""
    rows = pick(vectors, vec_id=vec_id, v=embedding, label=label)
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    kept = rows.where(F.col("v").isNotNull() & finite)
    largest = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double") * SCALE)))
    return kept.select("vec_id", "label", largest.alias("largest"), F.transform("v", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A batch of vectors, shorter ones filled with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims)[None] < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _parts(batch: pa.RecordBatch, books: np.ndarray) -> np.ndarray:
    parts, _, size = books.shape
    return _matrix(batch["v"], parts * size).reshape(len(batch), parts, size)


def refined(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks (parts x entries x components) with each entry replaced by the floored mean of the parts nearest to it.

    A task sends one sum for each number of the codebooks.
    """
    parts, entries, size = books.shape

    def run(batches):
        cells = [GridCells(b) for b in books]
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            cut = _parts(batch, books)
            for p in range(parts):
                index, _ = cells[p].nearest(cut[:, p])
                np.add.at(sums[p], index, cut[:, p])
                counts[p] += np.bincount(index, minlength=entries)
        at = np.arange(parts * entries)
        flat = np.concatenate([counts.reshape(-1, 1), sums.reshape(parts * entries, size)], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, size + 1)), pa.array(np.tile(np.arange(size + 1), len(at))), pa.array(flat.ravel())],
            names=["entry", "place", "total"])

    sent = rows.select("v").mapInArrow(run, "entry bigint, place bigint, total bigint")
    totals = sent.groupBy("entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {(r["entry"], r["place"]): int(r["total"]) for r in totals.collect()}  # parts x entries x (size + 1) numbers
    out = books.copy().reshape(parts * entries, size)
    for e in range(parts * entries):
        if n := found.get((e, 0), 0):
            out[e] = [found[e, i + 1] // n for i in range(size)]
    return out.reshape(books.shape)


def _coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    def make():
        cells = [GridCells(b) for b in books]

        def step(batch):
            cut = _parts(batch, books)
            code, error = np.zeros((len(batch), len(books)), np.uint8), np.zeros(len(batch), np.int64)
            for p, cell in enumerate(cells):
                code[:, p], distance = cell.nearest(cut[:, p])
                error += distance
            return {"vec_id": batch["vec_id"], "label": batch["label"], "code": [c.tobytes().hex() for c in code], "error": error}

        return step

    kinds = dict(rows.dtypes)
    return arrow_pass(rows.select("vec_id", "label", "v"), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint", make)


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, vec_id: str = "vec_id",
             embedding: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks): vec_id, label, code and error of each kept row, and the parts x entries x components integers.

    Rows whose vector is null or holds a null or non-finite component are dropped. Components become floor(4096 * x). Vectors
    are cut into ``parts`` equal parts; shorter ones count as filled with zeros up to the longest, whose length is rounded up
    to a multiple of ``parts``. A codebook starts as the parts of the rows with the smallest ids (null last, equal ids by their
    components), as many as there are if they are fewer than ``entries`` (at most 256). Each round assigns all parts and moves each
    entry to the floored mean of its parts; an entry without parts stays. ``code`` has two hex digits a part, ``error`` is the sum
    of the squared distances. Repeated rows count as often as they occur. An empty table gives an empty table and no entries.
    Distances beyond 64 bits raise an error. Other columns are not read. Besides the codebooks, nothing passes through the driver.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits hold 1 to 256 entries")
    rows = materialise(integer_vectors(vectors, vec_id, embedding, label))
    longest, largest = rows.agg(F.max(F.size("v")), F.max("largest")).first()
    size = -(-(longest or 0) // parts)
    if max(1, size * parts) * (2 * ((largest or 0) + 1)) ** 2 >= 2.0**62:
        raise ValueError("distances would not fit 64 bits")
    seeds = [r["v"] for r in rows.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()]
    books = np.zeros((parts, len(seeds), size), np.int64)
    for e, v in enumerate(seeds):
        books[:, e] = np.array([*v, *[0] * (parts * size - len(v))], np.int64).reshape(parts, size)
    if not seeds:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), books
    for _ in range(rounds):
        books = refined(rows, books)
    return materialise(_coded(rows, books)), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """Add ``label_error``: the errors summed over equal labels, nulls together.

    Sums are combined before they are shuffled; the rows of a label are dealt into shares, each of which meets a copy of the sum.
    """
    totals = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    shared = codes.withColumn("share", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SHARES)).cast("int"))
    on = F.col("label").eqNullSafe(F.col("of")) & (F.col("share") == F.col("copy"))
    return shared.join(totals, on).drop("of", "share", "copy")
