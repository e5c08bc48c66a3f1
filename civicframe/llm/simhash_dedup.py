"""SimHash near-duplicates: an inverted index over positional bytes with count filtering, then verification.

Two 64-bit fingerprints that differ in at most d bits differ in at most d of their 8 bytes, so they share at least
8 - d bytes at the same position. A list for each single byte would hold a 256th of all fingerprints, so
the lists here are for sets of positions: a family of sets such that whichever 8 - d positions a pair shares, it
shares all of some set. For d = 3 these are the 14 quadruples of positions whose numbers xor to 0: any five positions
hold exactly one of them, so a pair with just five shared bytes meets in one list. Within a list shared bytes are
tallied, pairs below the minimum go, and the others are verified by their differing bits.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import WORD, arrow_pass, pick, shuffle_partitions, texts_of
from civicframe.llm.components import connected_components
from civicframe.session import materialise

BYTES = 8
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
#: Fingerprints of one list that are compared in one go; longer lists are cut into chunks and compared chunk by chunk.
CHUNK = 2_048


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the shingles of a text, repeats included: a bit is 1 if over half the hashes have it.

    Words are taken after A-Z are lower-cased. Fewer words than a shingle give the whole sequence as the only shingle;
    no words give 0.
    """
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(" ".join(words), 42)
    bits, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, n, 4096):
        part = words[at:at + 4096 + shingle - 1]
        grams = map(" ".join, zip(*(part[k:] for k in range(shingle)), strict=False))
        hashes = np.frombuffer(b"".join([xxhash.xxh64_digest(g, 42) for g in grams]), np.uint8)
        bits += np.unpackbits(hashes.reshape(-1, BYTES), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` (doc_id, text) to (doc_id, fp); fp is the fingerprint as a signed 64-bit integer."""

    def make():
        def step(batch):
            found = np.array([fingerprint(t, shingle) for t in texts_of(batch["text"])], np.uint64)
            return {"doc_id": batch["doc_id"], "fp": found.view(np.int64)}

        return step

    return arrow_pass(docs, f"doc_id {dict(docs.dtypes)['doc_id']}, fp bigint", make)


def position_sets(distance: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any 8 - distance positions contain one of the sets."""
    if distance == 3:
        return [s for s in itertools.combinations(range(BYTES), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
    if not 0 <= distance < BYTES:
        raise ValueError(f"the distance must lie between 0 and {BYTES - 1}")
    return list(itertools.combinations(range(BYTES), BYTES - distance))


def _postings(distinct: DataFrame, distance: int) -> DataFrame:
    """(list, bytes, fp): each fingerprint in the list of its bytes at each set of positions."""
    masks = [sum(0xFF << (8 * p) for p in s) for s in position_sets(distance)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    index = F.array(*[F.struct(F.lit(i).cast("smallint").alias("list"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("bytes"))
                      for i, m in enumerate(signed)])
    return distinct.select(F.explode(index).alias("at"), "fp").select("at.list", "at.bytes", "fp")


def _linked(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Pairs (row of a, row of b): at least 8 - distance shared positional bytes, and at most ``distance`` differing bits."""
    differ = a[:, None] ^ b[None, :]
    shared = np.zeros(differ.shape, np.uint8)
    for p in range(BYTES):
        shared += (differ >> np.uint64(8 * p)).astype(np.uint8) == 0
    i, j = np.nonzero(shared >= BYTES - distance)
    return np.stack([i, j])[:, np.bitwise_count(differ[i, j]) <= distance]


def spanning_links(a: np.ndarray, b: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join the same fingerprints as all links within a (b is a) or across a and b, one fewer than fingerprints.

    Breadth first: each fingerprint is compared once with all not yet reached, so a dense group costs little.
    """
    values = np.unique(np.concatenate([a, b]))
    side_a, side_b = np.isin(values, a), np.isin(values, b)
    waiting = np.ones(len(values), bool)
    links = []
    for root in range(len(values)):
        if not waiting[root]:
            continue
        waiting[root] = False
        front = np.array([root])
        while len(front):
            rest = np.flatnonzero(waiting)
            if not len(rest):
                return links
            new = []
            for at in range(0, len(front), 64):
                some = front[at:at + 64]
                i, j = _linked(values[some], values[rest], distance)
                across = (side_a[some[i]] & side_b[rest[j]]) | (side_b[some[i]] & side_a[rest[j]])
                j, first = np.unique(j[across], return_index=True)
                i = i[across][first]
                links += zip(values[some[i]].tolist(), values[rest[j]].tolist(), strict=True)
                waiting[rest[j]] = False
                new.append(rest[j])
                rest = rest[waiting[rest]]
                if not len(rest):
                    break
            front = np.concatenate(new)
    return links


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """Links (src, dst) between distinct fingerprints that join exactly what all links within ``distance`` bits join.

    Lists with one fingerprint are dropped by their counts. A list longer than CHUNK is cut into chunks by a hash; every two
    of its chunks meet in some task. A task holds one pair of chunks at a time and gives at most a link for each
    of its fingerprints, so neither lists nor pairs are ever spelled out.
    """
    postings = _postings(distinct, distance)
    sizes = postings.groupBy("list", "bytes").count().where("count > 1")
    chunks = F.ceil(F.col("count") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    paired = postings.join(sizes, ["list", "bytes"]).withColumn("chunks", chunks).withColumn("own", own).select(
        "list", "bytes", "fp", F.explode(F.expr(
            "transform(sequence(0, chunks - 1), x -> struct(least(x, own) as i, greatest(x, own) as j, x < own as second))")).alias("c"))
    parts = shuffle_partitions(distinct.sparkSession)
    keys = ("list", "bytes", "i", "j")
    dealt = paired.select("list", "bytes", "c.i", "c.j", "c.second", "fp").repartition(parts, *keys).sortWithinPartitions(*keys)

    def run(batches):
        def emit(rows):
            table = pa.Table.from_batches(rows)
            fp = table["fp"].to_numpy().view(np.uint64)
            second = table["second"].to_numpy()
            if table["i"][0].as_py() == table["j"][0].as_py():
                found = spanning_links(fp, fp, distance)
            else:  # chunk i meets chunk j: rows of j came with x < own
                found = spanning_links(fp[~second], fp[second], distance)
            if found:
                pairs = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["src", "dst"])

        at, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = np.stack([batch[k].to_numpy().astype(np.int64) for k in keys])
            edges = [0, *(np.flatnonzero((cells[:, 1:] != cells[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                key = tuple(cells[:, a].tolist())
                if held and key != at:
                    yield from emit(held)
                    held = []
                at = key
                held.append(batch.slice(a, b - a))
        if held:
            yield from emit(held)

    return dealt.mapInArrow(run, "src bigint, dst bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    Fingerprints link when they differ in at most ``distance`` bits; the component is the smallest doc_id that links lead to,
    itself included. Copies share a fingerprint and enter the index once. Null, empty and wordless texts have fingerprint
    0, which links like any other. Null ids stay null and count as no id; a component with null ids alone has the id null.
    Repeated rows come back each; an empty table gives an empty table; other columns are not read.
    """
    rows = materialise(fingerprints(pick(docs, doc_id=doc_id, text=text), shingle))
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    found = materialise(links(distinct.select("fp"), distance))
    member = connected_components(found)  # id, root
    of = distinct.join(member, distinct["fp"] == member["id"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = of.groupBy("root").agg(F.min("low").alias("component_id"))
    component = materialise(of.join(lowest, "root").select(F.col("fp").alias("f"), "component_id"))
    return rows.join(component, rows["fp"] == component["f"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with the columns of ``docs``.

    The row with the group's component_id stays; of several such rows the one with the smallest hash of
    its text, and of wholly equal ones any. Rows with a null id stay only in groups without another id, one a group.
    """
    names = list(docs.columns)
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("row", F.monotonically_increasing_id())
    staged = materialise(inner)
    key, body = f"c{names.index(doc_id)}", f"c{names.index(text)}"
    keyed = staged.select(F.struct(
        F.col(key).isNull().alias("no_id"), F.col(key).alias("id"), F.xxhash64(body).alias("text"), "row").alias("key"), F.col(body).alias("text"))
    judged = materialise(near_duplicates(keyed, shingle, distance, "key", "text"))
    chosen = judged.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.row").alias("row"))
    return staged.join(chosen, "row", "left_semi").drop("row").toDF(*names)
