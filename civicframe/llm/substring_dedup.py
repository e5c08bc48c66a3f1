"""Substring dedup by level-wise doubling: windows repeated at one length alone are extended to the next.

The first level looks at windows of half the length, and of those only at the ones that are smallest by hash among the
half windows inside some full window. Which they are depends on the words of that full window alone, so a
full window that is repeated has a repeated half window. Only full windows over repeated half windows reach the
second level. :func:`longest_repeats` goes on from there with twice the length each time, until no window is repeated.

A level compares windows by hash, 64 bits for half windows and 96 for full ones. Each batch of documents packs its
hashes into one row for each slice of the hash range, of which a task holds one at a time. It sends a hash once, with
its count in the batch, so a window shared by a third of all documents costs an entry for each batch, not for each
document. Full windows are sliced by their smallest half window, which keeps the neighbours in a document together;
those over a half window with very many rows are sliced by their own hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import (
    BASE,
    INVERSE,
    WORD,
    WordHashes,
    arrow_pass,
    mixed,
    pick,
    powers,
    reused,
    shuffle_partitions,
    texts_of,
)
from civicframe.session import materialise

#: Slices of the hash range for each shuffle partition; a task holds one slice at a time.
SLICES = 4
#: A half window with this many rows may be crowded.
CROWD = 100
SENT = "slice int, key binary, window binary, n binary, start binary, entries binary, id_hash binary, text_hash binary"


def planes(values: np.ndarray) -> np.ndarray:
    """32-bit numbers as all low halves, then all high halves: small numbers leave the second part zero, which compresses."""
    return np.ascontiguousarray(values.astype("<u4").view("<u2").reshape(-1, 2).T).ravel()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, "<u2").reshape(2, -1).T).view("<u4").ravel().astype(np.int64)


class Rolling:
    """Hashes of all windows of a sequence of word hashes: a polynomial modulo 2**64, scrambled."""

    def __init__(self, words: np.ndarray):
        self.back = powers(INVERSE, len(words))
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers(BASE, len(words)), out=self.sums[1:])

    def windows(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[length:] - self.sums[:-length]) * self.back[:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` neighbours, by doubling."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = np.minimum(values[:-step], values[step:])
        reach += step
    return values


def is_smallest(values: np.ndarray, smallest: np.ndarray, width: int) -> np.ndarray:
    """Which values are the smallest of some ``width`` neighbours."""
    padded = np.concatenate([np.zeros(width - 1, np.uint64), smallest, np.zeros(width - 1, np.uint64)])
    return ~sliding_min(~padded, width) == values  # the largest of the minima that cover a place


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows with a key of 96 bits: hashes of the id and of the text. Equal rows share it and count as repeats."""
    return pick(docs, doc_id=doc_id, text=text).select(
        "doc_id", F.hash("doc_id", F.col("doc_id").isNull()).alias("id_hash"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")


def _sent(batch: pa.RecordBatch, slices: int, keys: list, windows: list, starts: list, rows: list, by: list | None = None) -> dict:
    """One row for each slice of the hash range (of ``by``, else of the keys): the windows of the batch in it and their documents.

    A (key, window) that the batch has several times has its count at its first place; its other places need no answer from
    other batches, and go with the count 2 under a scrambled key.
    """
    join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    keys, windows = join(keys, np.uint64), join(windows, np.uint32)
    by = keys.copy() if by is None else join(by, np.uint64)
    starts, rows = join(starts, np.int32), join(rows, np.int64)
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[1:] = (keys[order][1:] == keys[order][:-1]) & (windows[order][1:] == windows[order][:-1])
    heads = np.flatnonzero(~again)
    n = np.full(len(keys), 2, np.uint16)
    n[order[heads]] = np.minimum(np.diff(np.append(heads, len(keys))), 65535)
    extra = order[again]
    keys[extra] = by[extra] = mixed(keys[extra] + np.arange(1, len(extra) + 1, dtype=np.uint64) * BASE)
    part = (mixed(by) >> np.uint64(32)) % np.uint64(slices)
    order = np.argsort(part.astype(np.uint32), kind="stable")
    used, first = np.unique(part[order], return_index=True)
    ends = np.append(first, len(order)).astype(np.int32)
    pairs, begins = np.unique(part[order].astype(np.int64) * len(batch) + rows[order], return_index=True)
    docs = np.searchsorted(pairs, np.append(used.astype(np.int64) * len(batch), np.iinfo(np.int64).max))
    member = pairs % max(1, len(batch))

    def packed(values: np.ndarray, ends: np.ndarray = ends) -> pa.Array:
        offsets = (ends.astype(np.int64) * values.itemsize).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])

    def in_planes(values: np.ndarray, ends: np.ndarray) -> list[bytes]:
        return [planes(values[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]

    entries = np.diff(np.append(begins, len(order)))
    return {"slice": used.astype(np.int32), "key": packed(keys[order]), "window": packed(windows[order]), "n": packed(n[order]),
            "start": in_planes(starts[order], ends), "entries": in_planes(entries, docs)} | {
                name: packed(batch[name].to_numpy()[member], docs) for name in ("id_hash", "text_hash")}


def _half(length: int) -> tuple[int, int]:
    half = (length + 1) // 2
    return half, length - half + 1


def _half_windows(keyed: DataFrame, length: int, slices: int) -> DataFrame:
    """The smallest half windows of every document, packed."""
    half, width = _half(length)

    def make():
        hashes = WordHashes()

        def step(batch):
            found = [], [], [], []
            for i, words in enumerate(hashes.rows(batch["text"])):
                if len(words) >= length:
                    halves = Rolling(words).windows(half)
                    at = np.flatnonzero(is_smallest(halves, sliding_min(halves, width), width))
                    for part, values in zip(found, (halves[at], np.zeros(len(at)), at, np.full(len(at), i)), strict=True):
                        part.append(values)
            return _sent(batch, slices, *found)

        return step

    return arrow_pass(keyed, SENT, make)


def _full_windows(with_seeds: DataFrame, length: int, slices: int, crowded) -> DataFrame:
    """The windows of full length whose smallest half window is repeated, packed. ``crowded``: half windows with many rows."""
    half, width = _half(length)

    def make():
        hashes, many = WordHashes(), np.array(crowded.value, np.int64).view(np.uint64)

        def step(batch):
            found = [], [], [], [], []
            for i, (words, seeds) in enumerate(zip(hashes.rows(batch["text"]), batch["seeds"], strict=True)):
                rolling = Rolling(words)
                halves, whole = rolling.windows(half), rolling.windows(length)
                at = np.concatenate([from_planes(x.as_py()) for x in seeds])
                smallest = sliding_min(halves, width)
                start = np.flatnonzero(np.isin(smallest, halves[at]))
                second = mixed(halves[start] ^ (halves[start + length - half] * BASE)) >> np.uint64(32)
                by = np.where(np.isin(smallest[start], many), whole[start], smallest[start])
                for part, values in zip(found, (whole[start], second, start, np.full(len(start), i), by), strict=True):
                    part.append(values)
            return _sent(batch, slices, *found)

        return step

    return arrow_pass(with_seeds, SENT, make)


def _answer(rows: list[pa.RecordBatch], crowd: int) -> pa.RecordBatch:
    """Of one slice, the places of windows that occur twice or more: (id_hash, text_hash, starts, n) rows.

    Keys that occur ``crowd`` times or more come as rows with their count n, the key in the place of the text hash and null starts.
    """
    table = pa.Table.from_batches(rows).combine_chunks()
    column = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
    numbers = lambda name: np.concatenate([from_planes(x) for x in table[name].to_pylist()])
    key, window = column("key", np.uint64), column("window", np.uint32)
    order = np.lexsort((window, key))
    k, w = key[order], window[order]
    first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (w[1:] != w[:-1])]))
    total = np.add.reduceat(column("n", np.uint16)[order].astype(np.int64), first)
    keep = order[np.repeat(total >= 2, np.diff(np.append(first, len(order))))]
    many = np.flatnonzero(total >= crowd) if crowd else np.zeros(0, np.int64)
    entries = numbers("entries")
    doc = np.repeat(np.arange(len(entries)), entries)[keep]
    start = numbers("start")[keep]
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    begins = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    packed = [planes(part).tobytes() for part in np.split(start, begins[1:])] if len(doc) else []
    ids = np.concatenate([column("id_hash", np.int32)[doc[begins]], np.zeros(len(many), np.int32)])
    texts = np.concatenate([column("text_hash", np.int64)[doc[begins]], k[first[many]].view(np.int64)])
    counts = np.concatenate([np.zeros(len(begins), np.int64), total[many]])
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts), pa.array(packed + [None] * len(many), pa.binary()), pa.array(counts)],
                                      names=["id_hash", "text_hash", "starts", "n"])


def _repeated(sent: DataFrame, parts: int, crowd: int = 0) -> DataFrame:
    """The rows of :func:`_answer` over all slices."""
    dealt = sent.repartitionById(parts, F.col("slice")).sortWithinPartitions("slice")

    def run(batches):
        at, held = None, []
        for batch in batches:
            slices = batch["slice"].to_numpy()
            edges = [0, *(np.flatnonzero(slices[1:] != slices[:-1]) + 1).tolist(), len(slices)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if held and slices[a] != at:
                    yield _answer(held, crowd)
                    held = []
                at = slices[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield _answer(held, crowd)

    return dealt.mapInArrow(run, "id_hash int, text_hash bigint, starts binary, n bigint")


def _by_document(found: DataFrame) -> DataFrame:
    return found.where("starts is not null").groupBy("id_hash", "text_hash").agg(F.collect_set("starts").alias("starts"))


def repeated_windows(docs: DataFrame, length: int = 35, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(keyed, found): the documents with their keys, and (id_hash, text_hash, starts) of windows of ``length``
    words that also start elsewhere, in the same document or another. ``starts`` is a list of packed lists.

    The repeated half windows are read twice and stay cached on the executors' disks until the caller clears the cache;
    blocks of lost executors are computed again.
    """
    keyed, parts = _keyed(docs, doc_id, text), shuffle_partitions(docs.sparkSession)
    slices = parts * SLICES
    seeds = reused(_repeated(_half_windows(keyed, length, slices), parts, CROWD))
    # Half windows that fill a good part of a slice: at most one for each slice, so their list is small.
    crowded = [r["text_hash"] for r in seeds.where("starts is null").orderBy(F.desc("n")).limit(slices).select("text_hash").collect()]
    with_seeds = keyed.join(_by_document(seeds).withColumnRenamed("starts", "seeds"), ["id_hash", "text_hash"])
    sent = _full_windows(with_seeds, length, slices, docs.sparkSession.sparkContext.broadcast(crowded))
    return keyed, _by_document(_repeated(sent, parts))


def _extended(keyed: DataFrame, found: DataFrame, length: int, slices: int) -> DataFrame:
    """The windows of ``length`` words, both halves of which are among the found ones, packed."""
    half = length // 2

    def make():
        hashes = WordHashes()

        def step(batch):
            out = [], [], [], []
            for i, (words, starts) in enumerate(zip(hashes.rows(batch["text"]), batch["starts"], strict=True)):
                at = np.unique(np.concatenate([from_planes(x.as_py()) for x in starts]))
                at = at[np.isin(at + half, at)]
                if len(at):
                    rolling = Rolling(words)
                    halves, whole = rolling.windows(half), rolling.windows(length)
                    second = mixed(halves[at] ^ (halves[at + half] * BASE)) >> np.uint64(32)
                    for part, values in zip(out, (whole[at], second, at, np.full(len(at), i)), strict=True):
                        part.append(values)
            return _sent(batch, slices, *out)

        return step

    return arrow_pass(keyed.join(found, ["id_hash", "text_hash"]), SENT, make)


def longest_repeats(docs: DataFrame, length: int = 35, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the longest level (length, twice, four times, ...) at which a window of the row is repeated; 0: none.

    Each level extends the windows repeated at the level before to twice their length, until none survives.
    """
    parts = shuffle_partitions(docs.sparkSession)
    keyed, found = repeated_windows(docs, length, doc_id, text)
    levels = keyed.select("id_hash", "text_hash").limit(0).withColumn("level", F.lit(0))
    while True:
        found = materialise(found)
        if found.isEmpty():
            break
        levels = levels.unionByName(found.select("id_hash", "text_hash", F.lit(length).alias("level")))
        length *= 2
        found = _by_document(_repeated(_extended(keyed, found, length, parts * SLICES), parts))
    longest = levels.groupBy("id_hash", "text_hash").agg(F.max("level").alias("level"))
    return keyed.join(longest, ["id_hash", "text_hash"], "left").select("doc_id", F.coalesce("level", F.lit(0)).alias("level"))


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of n words lie in a window that begins at one of the starts."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + length, n), -1)
    return np.cumsum(steps[:n]) > 0


def remove_repeats(docs: DataFrame, length: int = 35, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` without the words of windows that also start elsewhere: doc_id, n_words, n_removed, kept.

    ``kept`` is the remaining words joined by one space. Windows are judged on the input. Null and empty texts
    have no words; texts shorter than a window stay whole; repeated rows repeat each other's windows; an empty
    table gives an empty table; other columns are not read.
    """
    keyed, found = repeated_windows(docs, length, doc_id, text)
    marked = keyed.join(found, ["id_hash", "text_hash"], "left")
    id_type = dict(keyed.dtypes)["doc_id"]

    def make():
        def step(batch):
            n_words, n_removed, kept = [], [], []
            for text, starts in zip(texts_of(batch["text"]), batch["starts"], strict=True):
                words = WORD.findall(text or "")
                n_words.append(len(words))
                if starts.is_valid:
                    out = covered(len(words), np.concatenate([from_planes(x.as_py()) for x in starts]), length)
                    words = [w for w, gone in zip(words, out.tolist(), strict=True) if not gone]
                n_removed.append(n_words[-1] - len(words))
                kept.append(" ".join(words))
            return {"doc_id": batch["doc_id"], "n_words": n_words, "n_removed": n_removed, "kept": kept}

        return step

    return arrow_pass(marked.select("doc_id", "text", "starts"), f"doc_id {id_type}, n_words bigint, n_removed bigint, kept string", make)
