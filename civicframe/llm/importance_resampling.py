"""Resampling towards a target distribution, with hashed n-grams taken from prefix CRCs.

A document is brought to lower-case words with one space between them and scanned once; the CRC-32 of each prefix that ends
at a word's edge is stored. The CRC of any run of words follows from two of them: a CRC is linear over GF(2), so
``crc(ab) = shift(crc(a), len(b)) ^ crc(b)``, and shifting the shorter prefix over the run's bytes cancels it.
No n-gram is ever built as a string. The bucket numbers are written once; counts and weights are read from them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicframe.llm.common import arrow_pass, pick
from civicframe.session import materialise

#: Rows whose bytes are Python objects at a time.
ROWS = 256


def _one_byte() -> np.ndarray:
    """The CRC-32 of each byte without the initial and final complement."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def _applied(lanes: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map on 32 bits, given by its values on each byte: lanes[4, 256]."""
    return (lanes[0][crc & 255] ^ lanes[1][(crc >> 8) & 255] ^ lanes[2][(crc >> 16) & 255] ^ lanes[3][crc >> 24])


class Shift:
    """CRCs shifted over any number of bytes, by maps for 1, 2, 4, ... bytes."""

    def __init__(self):
        byte = np.arange(256, dtype=np.uint32)
        moved = [byte << np.uint32(8 * lane) for lane in range(4)]
        self.step = _one_byte()
        self.maps = [np.stack([self.step[m & 255] ^ (m >> 8) for m in moved])]

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        crc, bit = crc.copy(), 0
        while len(n) and int(n.max()) >> bit:
            if bit == len(self.maps):
                self.maps.append(np.stack([_applied(self.maps[-1], lane) for lane in self.maps[-1]]))
            at = np.flatnonzero((n >> bit) & 1)
            crc[at] = _applied(self.maps[bit], crc[at])
            bit += 1
        return crc

    def over_space(self, crc: np.ndarray) -> np.ndarray:
        """The CRCs of the same prefixes with a space behind them."""
        crc = ~crc
        return ~(self.step[(crc ^ np.uint32(0x20)) & 255] ^ (crc >> 8))


#: Bytes of words as they are, A-Z in lower case, all others a space.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, with A-Z lower-cased."""
    return text.translate(_NORMAL).split()


class NgramCrcs:
    """CRC-32 of all runs of ``low`` to ``high`` consecutive words, joined by one space."""

    def __init__(self, low: int, high: int):
        if not 1 <= low <= high:
            raise ValueError("runs go from 1 or more words to as many or more")
        self.low, self.high, self.shift = low, high, Shift()

    def __call__(self, words: list[bytes]) -> np.ndarray:
        crc, crc32, at_end = 0, zlib.crc32, []
        for word in words:  # the scan: the CRC of the document up to the end of each word
            crc = crc32(word, crc)
            at_end.append(crc)
            crc = crc32(b" ", crc)
        ends = np.array(at_end, np.uint32)
        starts = np.concatenate([np.zeros(1, np.uint32), self.shift.over_space(ends)])[:len(words)]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        end_at = np.cumsum(lengths) + np.arange(len(words))
        start_at = end_at - lengths
        out = [np.zeros(0, np.uint32)]
        for n in range(self.low, min(self.high, len(words)) + 1):
            span = end_at[n - 1:] - start_at[:len(words) - n + 1]
            out.append(ends[n - 1:] ^ self.shift(starts[:len(words) - n + 1], span))
        return np.concatenate(out)


def _bytes_of(column: pa.Array):
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    for at in range(0, len(column), ROWS):
        yield from column.slice(at, ROWS).to_pylist()


def _bucket_type(buckets: int):
    return np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")


def bucketed(rows: DataFrame, low: int, high: int, buckets: int) -> DataFrame:
    """(doc_id, text) to (doc_id, n_words, n_features, buckets): the feature buckets packed in order; one scan of each text."""
    kind = _bucket_type(buckets)

    def make():
        crcs = NgramCrcs(low, high)

        def step(batch):
            n_words, n_features, packed = [], [], []
            for text in _bytes_of(batch["text"]):
                words = words_of(text or b"")
                found = crcs(words) % np.uint32(buckets)
                n_words.append(len(words))
                n_features.append(len(found))
                packed.append(found.astype(kind).tobytes())
            return {"doc_id": batch["doc_id"], "n_words": n_words, "n_features": n_features, "buckets": pa.array(packed, pa.binary())}

        return step

    return arrow_pass(rows, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words bigint, n_features bigint, buckets binary", make)


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall into each bucket: summed in each task, then over the tasks; ``buckets`` numbers come back."""
    kind = _bucket_type(buckets)

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                found = np.frombuffer(b"".join(batch["buckets"].slice(at, ROWS).to_pylist()), kind)
                counts += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    summed = features.select("buckets").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in summed.collect():  # at most ``buckets`` rows
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(ratio of the smoothed shares)) of each bucket, in doubles."""
    n = len(source)
    up = (target + 1).astype(np.float64) * float(source.sum() + n)
    down = (source + 1).astype(np.float64) * float(target.sum() + n)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def _weighted(features: DataFrame, gain: np.ndarray) -> DataFrame:
    kind = _bucket_type(len(gain))

    def make():
        def step(batch):
            weight = [int(gain[np.frombuffer(x, kind)].sum()) for at in range(0, len(batch), ROWS)
                      for x in batch["buckets"].slice(at, ROWS).to_pylist()]
            return {"doc_id": batch["doc_id"], "n_words": batch["n_words"], "n_features": batch["n_features"], "weight": weight}

        return step

    return arrow_pass(features, f"doc_id {dict(features.dtypes)['doc_id']}, n_words bigint, n_features bigint, weight bigint", make)


def _ranked(rows: DataFrame) -> DataFrame:
    """1-based ``place`` by score, highest first, then by id: slices of the range are numbered, then offset by the counts before."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    sliced = materialise(rows.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()))
    inside = F.row_number().over(Window.partitionBy("slice").orderBy(*order))
    earlier = Window.partitionBy().orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shuffle partition
    offsets = sliced.groupBy("slice").count().select("slice", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    placed = sliced.withColumn("inside", inside).join(offsets, "slice")
    return placed.select(*rows.columns, (F.col("inside") + F.col("before")).cast("bigint").alias("place"))


def resample(docs: DataFrame, target: DataFrame, low: int = 1, high: int = 1, buckets: int = 10_000, percent: int = 10,
             least_words: int = 20, seed: str = "2024", doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """Every row of ``docs`` with n_features, weight, score and its rank in a draw without replacement towards ``target``.

    Features are the runs of ``low`` to ``high`` words, repeats counted, in ``buckets`` buckets of their CRC-32. A bucket's gain is the
    logarithm of its smoothed share in the target texts over that in all documents, times 1000 and floored; a document's
    weight sums the gains of its features. The score adds Gumbel noise, a hash of (seed, id), so that the highest
    ``percent`` of a hundred of the rows with ``least_words`` words or more are a weighted sample; ties go to the smaller id,
    a null id last. Other rows have a null rank, and so has every row beyond the draw.

    Null and empty texts have no features and the weight 0. Repeated rows are rows of their own with one score. With an
    empty target, gains only even out the documents' buckets. An empty table gives an empty table; other columns are not read.
    Only ``buckets`` counts and gains pass through the driver.
    """
    def features(df, **names):
        return materialise(bucketed(pick(df, **names), low, high, buckets))

    all_texts = features(docs, doc_id=doc_id, text=text)
    aimed = bucketed(pick(target, text=target_text).select(F.lit(0).alias("doc_id"), "text"), low, high, buckets)
    weighted = _weighted(all_texts, gains(bucket_counts(all_texts, buckets), bucket_counts(aimed, buckets)))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(uniform)))
    scored = weighted.withColumn("score", F.col("weight") + noise)
    long_enough = F.col("n_words") >= least_words
    n = all_texts.where(long_enough).count()
    drawn = F.when(F.col("place") <= percent * n // 100, F.col("place")).alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    scored = materialise(scored)
    short = scored.where(~long_enough).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return _ranked(scored.where(long_enough).select(*columns)).select(*columns, drawn).unionByName(short)
