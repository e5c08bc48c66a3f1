"""Best-fit packing of documents into sequences: local rounds, then tree merges of underfull bins."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import arrow_pass, pick, texts_of
from civicframe.session import materialise, materialise_observed

CAPACITY = 2048
#: Items that one task packs; the tree has as many leaves as the items need.
ITEMS_PER_TASK = 50_000
END = 0


def tokenizer(path: str):
    """A function from a text to its token ids as uint32, without special tokens added.

    The ids are those of ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``. Where the ranks of the
    same vocabulary lie beside the file (``.tiktoken``), texts that name no special token take the faster
    reader of those ranks, which gives the same ids.
    """
    import base64
    import os
    import re

    from tokenizers import Tokenizer

    full = Tokenizer.from_file(path)
    added = [t.content for t in full.get_added_tokens_decoder().values()]
    ranks_file = os.path.splitext(path)[0] + ".tiktoken"

    def by_file(text: str) -> np.ndarray:
        return np.array(full.encode(text, add_special_tokens=False).ids, dtype="<u4")

    if not os.path.exists(ranks_file):
        return by_file
    import public_tokenizers
    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = re.compile("|".join(map(re.escape, added)) or r"(?!)")

    def by_ranks(text: str) -> np.ndarray:
        return by_file(text) if special.search(text) else np.array(fast.encode_ordinary(text), dtype="<u4")

    return by_ranks


def pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens: whole ones, only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, row, piece, start, length, ids_crc32. Null texts count as empty: one token, the end."""

    def make():
        encode = tokenizer(path)

        def step(batch):
            out = {k: [] for k in ("doc_id", "row", "piece", "start", "length", "ids_crc32")}
            for key, row, body in zip(batch["doc_id"].to_pylist(), batch["row"].to_pylist(), texts_of(batch["text"]), strict=True):
                ids = np.append(encode(body or ""), np.array([END], dtype="<u4"))
                for k, (start, length) in enumerate(pieces(len(ids), capacity)):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    for name, value in zip(out, (key, row, k, start, length, crc), strict=True):
                        out[name].append(value)
            return out

        return step

    rows = pick(docs, doc_id=doc_id, text=text).withColumn("row", F.monotonically_increasing_id())
    kind = dict(rows.dtypes)["doc_id"]
    return arrow_pass(rows, f"doc_id {kind}, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint", make)


def best_fit(fills: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: indices of the items of each bin, items of one bin in the order they went in."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    rooms = 0  # bit r is set while some open bin has room r
    for i in np.argsort(-fills, kind="stable").tolist():
        size = int(fills[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins


def _packed(items: DataFrame, capacity: int, parts: int, seed: int) -> DataFrame:
    """One best-fit round: (members, fill) items to (members, fill) bins, ``parts`` tasks each taking a random share."""
    dealt = items.repartition(parts, F.pmod(F.xxhash64(F.col("members")[0]["item"], F.lit(seed)), F.lit(1 << 30)))

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        bins = best_fit(table["fill"].to_numpy(), capacity)
        order = np.fromiter((i for b in bins for i in b), np.int64)
        lists = table["members"].combine_chunks().take(pa.array(order))
        counts = pa.compute.list_value_length(lists).to_numpy()
        per_bin = np.cumsum(np.fromiter(map(len, bins), np.int64))
        ends = np.concatenate([[0], np.cumsum(counts)[per_bin - 1]])
        fills = np.add.reduceat(table["fill"].to_numpy()[order], np.concatenate([[0], per_bin[:-1]]))
        members = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lists.flatten())
        yield pa.RecordBatch.from_arrays([members, pa.array(fills)], names=["members", "fill"])

    import pyarrow.compute  # noqa: F401

    return dealt.mapInArrow(run, items.schema)


def pack(items: DataFrame, item: str, length: str, capacity: int = CAPACITY, items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """Pack items into as few bins of ``capacity`` as the method finds: item, bin, offset.

    Every round deals the open bins to tasks by a hash and packs each share best-fit. Bins whose room is smaller
    than every open bin are full and leave; the others are the items of the next round, in as many tasks as
    they need. The rounds end with one task's share, or when a round joins fewer than one bin in a hundred. Bins hold their
    members, at most ``capacity`` of them. Lengths run from 1 to ``capacity``; others raise an error. The item must be unique.
    """
    state = items.select(
        F.array(F.struct(F.col(item).alias("item"), F.col(length).cast("bigint").alias("length"))).alias("members"),
        F.col(length).cast("bigint").alias("fill"))
    state, seen = materialise_observed(state, n=F.count(F.lit(1)), low=F.min("fill"), high=F.max("fill"))
    if seen["n"] and (seen["low"] < 1 or seen["high"] > capacity):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    n, done, turn = seen["n"], [], 0
    while n:
        parts = math.ceil(n / items_per_task)
        state, seen = materialise_observed(
            _packed(state, capacity, parts, turn), n=F.count(F.lit(1)), low=F.min("fill"))
        if parts == 1 or seen["n"] > 0.99 * n:
            break
        full = F.lit(capacity) - F.col("fill") < seen["low"]
        done.append(state.where(full))
        state = state.where(~full)
        n, turn = state.count(), turn + 1
    bins = state
    for d in done:
        bins = bins.unionByName(d)
    return _offsets(materialise(bins.withColumn("bin", F.monotonically_increasing_id())))


def _offsets(bins: DataFrame) -> DataFrame:
    """Members one by one, with the sum of the lengths before each: one running pass over a bin's list."""
    placed = F.aggregate(
        "members", F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<bigint>)").alias("offsets")),
        lambda s, m: F.struct((s["at"] + m["length"]).alias("at"), F.concat(s["offsets"], F.array(s["at"])).alias("offsets")))
    rows = bins.select("bin", F.explode(F.arrays_zip("members", placed["offsets"].alias("offset"))).alias("m"))
    return rows.select(F.col("m.members.item").alias("item"), "bin", F.col("m.offset").alias("offset"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
                   items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """Token sequences of at most ``capacity`` from the texts: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and a closing 0. Longer ones than ``capacity`` are cut into whole pieces, the first of which
    may be shorter. Whole pieces are sequences of their own; the rest is packed by :func:`pack`. Null and empty texts
    are the closing 0 alone; repeated rows are packed each; an empty table gives an empty table; other columns are not read.
    """
    cut = materialise(tokenize(docs, path, capacity, doc_id, text))
    short = cut.where(F.col("length") < capacity)  # at most one a row: its first piece
    bins = pack(short, "row", "length", capacity, items_per_task)
    placed = short.join(bins.withColumnRenamed("item", "row"), "row").withColumn("sequence_id", 2 * F.col("bin"))
    whole = cut.where(F.col("length") == capacity).withColumns(
        {"sequence_id": 2 * F.monotonically_increasing_id() + 1, "offset": F.lit(0).cast("bigint")})
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    return placed.select(*names).unionByName(whole.select(*names))
