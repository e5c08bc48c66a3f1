"""Masked pseudo-likelihood of documents under a bidirectional window network trained in numpy.

Words are hashed once. Their buckets, two bytes a word, are written in shares: documents are dealt by a hash of the
document into as many shares as the corpus has words for, whatever the splits of the input. Frequent buckets are classes
of their own, the others are dealt to classes by their count. A network reads the classes of the words on both sides of a masked word
and predicts its class. Training goes over all shares in rounds: each share starts a round from the same weights and learns
from its masked words, and the weights are averaged by numbers of words. Every word is masked in exactly one round.

Within its class a word has its share of the occurrences, and these are counted for every different word of the corpus, so what
is gathered grows with the input: batches send their words by slices of the hash range, and each slice adds up
its words and answers with sums by document. The score of a document is the sum of the log-probabilities of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import BASE, WordHashes, mixed, pick, shuffle_partitions
from civicframe.session import materialise

BUCKETS = 1 << 15
CLASSES, OWN_CLASS = 128, 96
SIDE, EMBEDDING, HIDDEN = 2, 16, 32
SLOTS = 2 * SIDE
#: In each round over the corpus one word in MASK_EVERY is masked and learned; after ROUNDS of them each word was, exactly once.
MASK_EVERY, BATCH, RATE = 4, 512, 0.01
ROUNDS = MASK_EVERY
#: Words in a share, about: one training run of a round.
SHARE_WORDS = 1 << 21
FIXED = 1 << 40
MOST = 60.0  # a logit's exponential stays finite
PAD = CLASSES
SHAPES = [(CLASSES + 1, EMBEDDING), (SLOTS * EMBEDDING, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,)]


def buckets_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class Vocabulary:
    """Class of each bucket, and the occurrences of each class."""

    classes: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Vocabulary:
        """Most frequent buckets first get classes of their own; the rest is dealt round and round, so each class has its share."""
        order = np.argsort(-counts, kind="stable")
        classes = np.empty(BUCKETS, np.int64)
        classes[order] = np.where(np.arange(BUCKETS) < OWN_CLASS, np.arange(BUCKETS), OWN_CLASS + np.arange(BUCKETS) % (CLASSES - OWN_CLASS))
        return cls(classes, np.bincount(classes, counts, CLASSES))


class WindowNet:
    """Embedding of classes, one hidden layer over the words on both sides, softmax over classes."""

    def __init__(self, weights: list[np.ndarray]):
        self.weights = weights

    @classmethod
    def fresh(cls, counts: np.ndarray, vocabulary: Vocabulary, seed: int = 3) -> WindowNet:
        rng = np.random.default_rng(seed)
        weights = [rng.normal(0, scale, shape).astype(np.float32) for shape, scale in zip(SHAPES, (0.3, 0.15, 0, 0.15, 0), strict=True)]
        shares = np.bincount(vocabulary.classes, counts + 1.0, CLASSES)
        weights[4] = np.log(shares / shares.sum()).astype(np.float32)
        return cls(weights)

    @classmethod
    def unpacked(cls, flat: np.ndarray) -> WindowNet:
        ends = np.cumsum([int(np.prod(s)) for s in SHAPES])[:-1]
        return cls([part.reshape(s).astype(np.float32) for part, s in zip(np.split(flat, ends), SHAPES, strict=True)])

    def packed(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights]).astype(np.float64)

    def gradients(self, context: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy of targets (n) given the classes around them (n, SLOTS)."""
        embedding, w1, b1, w2, b2 = self.weights
        n = len(target)
        x = embedding[context].reshape(n, -1)
        h = np.tanh(x @ w1 + b1)
        error = h @ w2
        error += b2
        np.minimum(error, MOST, out=error)
        np.exp(error, out=error)
        error *= (1 / (n * (error @ np.ones(CLASSES, error.dtype))))[:, None]
        error[np.arange(n), target] -= 1 / n
        dh = (error @ w2.T) * (1 - h * h)
        dx = (dh @ w1.T).reshape(-1, EMBEDDING)
        flat = context.ravel()
        pulled = np.stack([np.bincount(flat, dx[:, k], CLASSES + 1) for k in range(EMBEDDING)], axis=1).astype(embedding.dtype)
        return [pulled, x.T @ dh, dh.sum(axis=0), h.T @ error, error.sum(axis=0)]

    def scorer(self):
        """A function from classes with SIDE pads around each document, and places in them, to log p(class | both sides)."""
        embedding, w1, b1, w2, b2 = self.weights
        tables = [embedding @ w1[s * EMBEDDING:(s + 1) * EMBEDDING] for s in range(SLOTS)]
        steps, ones = around(), np.ones(CLASSES, w2.dtype)

        def log_prob(classes: np.ndarray, at: np.ndarray) -> np.ndarray:
            h = tables[0].take(classes[at + steps[0]], axis=0) + b1
            for table, step in zip(tables[1:], steps[1:], strict=True):
                h += table.take(classes[at + step], axis=0)
            z = np.tanh(h, out=h) @ w2 + b2
            np.minimum(z, MOST, out=z)
            own = z[np.arange(len(at)), classes[at]]
            return own - np.log(np.exp(z, out=z) @ ones)

        return log_prob


def around() -> list[int]:
    return [s for s in range(-SIDE, SIDE + 1) if s]


def _padded(classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents one after another with SIDE pads around each, and the places of their words."""
    at = np.arange(len(classes)) + SIDE * (1 + np.repeat(np.arange(len(counts)), counts))
    padded = np.full(len(classes) + SIDE * (len(counts) + 1), PAD)
    padded[at] = classes
    return padded, at


def _masked(counts: np.ndarray, keys: np.ndarray, turn: int) -> np.ndarray:
    """The words of some documents that are masked in a round, by a hash of the document and the place."""
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    drawn = mixed(place.astype(np.uint64) + np.repeat(mixed(keys), counts))
    return np.flatnonzero(drawn % np.uint64(MASK_EVERY) == turn)


# ---------------------------------------------------------------- shares

def shared(docs: DataFrame, shares: int) -> DataFrame:
    """(share, keys, counts, buckets, doc_ids): the documents of each share in the order of their keys, with their words' buckets.

    A document's share is a hash of its key. ``docs`` has doc_id, key and text.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def hashed(batches):
        hashes = WordHashes()
        for batch in batches:
            packed = []
            for words, counts in hashes.slices(batch["text"]):
                packed += [part.tobytes() for part in np.split(buckets_of(words).astype("<u2"), np.cumsum(counts)[:-1])]
            if len(batch):
                yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["key"], pa.array(packed, pa.binary())], names=["doc_id", "key", "buckets"])

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending")]).combine_chunks()
        buckets = table["buckets"].to_pylist()
        ids = table["doc_id"].combine_chunks()
        return pa.table({
            "share": table["share"].slice(0, 1), "keys": pa.array([table["key"].to_numpy().astype("<i8").tobytes()], pa.binary()),
            "counts": pa.array([np.array([len(x) // 2 for x in buckets], "<u4").tobytes()], pa.binary()),
            "buckets": pa.array([b"".join(buckets)], pa.binary()),
            "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)})

    rows = docs.mapInArrow(hashed, f"doc_id {kind}, key bigint, buckets binary")
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("key"), F.lit(shares)).cast("int"))
    return dealt.groupBy("share").applyInArrow(packed, f"share int, keys binary, counts binary, buckets binary, doc_ids array<{kind}>")


def count_buckets(shares: DataFrame) -> np.ndarray:
    """Occurrences of each bucket over all documents; tasks send one row a bucket."""

    def run(batches):
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for packed in batch["buckets"]:
                counts += np.bincount(np.frombuffer(packed.as_buffer(), "<u2"), minlength=BUCKETS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    rows = shares.select("buckets").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BUCKETS, np.int64)  # at most BUCKETS rows come back
    for r in rows:
        counts[r["bucket"]] = r["n"]
    return counts


def _documents(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, word counts and buckets of a share."""
    return np.frombuffer(row["keys"], "<u8"), np.frombuffer(row["counts"], "<u4").astype(np.int64), np.frombuffer(row["buckets"], "<u2")


def train_round(shares: DataFrame, vocabulary, net: WindowNet, words: int, turn: int) -> WindowNet:
    """One pass over all shares: each starts from the same weights and learns from its masked words; weights are averaged by words.

    The average is summed in fixed point, so it does not depend on the order of the shares, nor on the tasks they fall to.
    """
    start = net.packed()
    steps = around()

    def learned(keys: np.ndarray, counts: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        local, t = WindowNet.unpacked(start), 0
        first, second = [np.zeros_like(w) for w in local.weights], [np.zeros_like(w) for w in local.weights]
        padded, at = _padded(vocabulary.value.classes[buckets], counts)
        at = at[_masked(counts, keys, turn)]
        for low in range(0, len(at), BATCH):
            t += 1
            here = at[low:low + BATCH]
            context = np.stack([padded[here + s] for s in steps], axis=1)
            for w, g, m, s in zip(local.weights, local.gradients(context, padded[here]), first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
        return np.rint(local.packed() * (len(buckets) / words) * FIXED).astype(np.int64)

    def run(batches):
        total = np.zeros(len(start), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                total += learned(*_documents(row))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "share"])

    sent = shares.select("keys", "counts", "buckets").where("length(buckets) > 0").mapInArrow(run, "place bigint, share bigint")
    flat = np.zeros(len(start))
    for r in sent.groupBy("place").agg(F.sum("share").alias("share")).collect():  # a row for each weight
        flat[r["place"]] = r["share"] / FIXED
    return WindowNet.unpacked(flat)


def train(shares: DataFrame, rounds: int = ROUNDS):
    """(broadcast vocabulary, network) after ``rounds`` passes over all shares."""
    counts = count_buckets(shares)
    known = Vocabulary.of(counts)
    vocabulary, net = shares.sparkSession.sparkContext.broadcast(known), WindowNet.fresh(counts, known)
    for turn in range(rounds if counts.sum() else 0):
        net = train_round(shares, vocabulary, net, int(counts.sum()), turn)
    return vocabulary, net


def _context_scores(shares: DataFrame, vocabulary, net: WindowNet) -> DataFrame:
    """(doc_id, key, n_words, context): the sum of log p(class | both sides) of each document."""
    trained = shares.sparkSession.sparkContext.broadcast(net)
    kind = shares.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        log_prob, classes_of = trained.value.scorer(), vocabulary.value.classes
        for batch in batches:
            for i, row in enumerate(batch.select(["keys", "counts", "buckets"]).to_pylist()):
                keys, counts, buckets = _documents(row)
                padded, at = _padded(classes_of[buckets], counts)
                scores = np.empty(len(at))
                for a in range(0, len(at), 2048):
                    scores[a:a + 2048] = log_prob(padded, at[a:a + 2048])
                total = np.bincount(np.repeat(np.arange(len(counts)), counts), scores, len(counts))
                yield pa.RecordBatch.from_arrays([batch["doc_ids"][i].values, pa.array(keys.view(np.int64)), pa.array(counts), pa.array(total)],
                                                 names=["doc_id", "key", "n_words", "context"])

    return shares.select("keys", "counts", "buckets", "doc_ids").mapInArrow(run, f"doc_id {kind}, key bigint, n_words bigint, context double")


# ---------------------------------------------------------------- words

SENT = "batch bigint, slice int, docs int, keys binary, words binary, tokens binary, members binary"


def _low_high(values: np.ndarray) -> bytes:
    """16-bit numbers as all their low bytes, then all their high ones: small numbers leave the second half zero, which compresses."""
    return np.ascontiguousarray(values.astype("<u2").view(np.uint8).reshape(-1, 2).T).tobytes()


def _from_low_high(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(2, -1).T).view("<u2").ravel().astype(np.int64)


def _postings(docs: DataFrame, slices: int, rows_at_a_time: int = 32_768) -> DataFrame:
    """Of each batch, a row with its documents' keys (slice -1) and a row for each slice of the hash range: the different
    words in it, how often each occurs, and in which documents of the batch, as steps from one to the next.
    """

    def of_batch(batch: pa.RecordBatch, hashes: WordHashes) -> pa.RecordBatch:
        keys = batch["key"].to_numpy()
        # A number of the batch that depends on its rows alone.
        number = int((mixed(keys.view(np.uint64)) * (np.arange(len(keys), dtype=np.uint64) * np.uint64(2) + np.uint64(1))).sum().view(np.int64))
        found = list(hashes.slices(batch["text"]))
        words = np.concatenate([w for w, _ in found])
        member = np.repeat(np.arange(len(batch)), np.concatenate([c for _, c in found]))
        part = (mixed(words + BASE) >> np.uint64(32)) % np.uint64(slices)
        order = np.argsort(words, kind="stable")  # documents stay in order within a word
        order = order[np.argsort(part[order].astype(np.uint32), kind="stable")]
        words, member, part = words[order], member[order], part[order].astype(np.int64)
        head = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.int64)
        tokens = np.diff(np.append(head, len(words)))
        step = np.diff(member, prepend=0) % (1 << 16)
        used, first = np.unique(part[head], return_index=True)
        ends = np.append(first, len(head))
        out = [[number, -1, len(batch), keys.astype("<i8").tobytes(), None, None, None]]
        for s, a, b in zip(used.tolist(), ends[:-1], ends[1:], strict=True):
            low, high = head[a], head[b] if b < len(head) else len(words)
            steps = step[low:high].copy()
            steps[0] = member[low]
            out.append([number, s, len(batch), None, words[head[a:b]].tobytes(), tokens[a:b].astype("<u4").tobytes(), _low_high(steps)])
        kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                          names=[c.split()[0] for c in SENT.split(", ")])

    def run(batches):
        hashes = WordHashes()
        for whole in batches:
            for at in range(0, len(whole), rows_at_a_time):
                yield of_batch(whole.slice(at, rows_at_a_time), hashes)

    return docs.select("key", "text").mapInArrow(run, SENT)


REPLY = ["batch", "keys", "sums"]


def _answers(rows: list[pa.RecordBatch], known: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Of one slice, the sums of its words' log-probabilities for the documents of each batch; rows with keys pass through."""
    table = pa.Table.from_batches(rows)
    for r in table.filter(pc.equal(table["slice"], -1)).select(["batch", "keys"]).to_pylist():
        yield pa.RecordBatch.from_arrays([pa.array([r["batch"]]), pa.array([r["keys"]], pa.binary()), pa.nulls(1, pa.binary())], names=REPLY)
    table = table.filter(pc.greater_equal(table["slice"], 0))
    if not len(table):
        return
    words = [np.frombuffer(x, np.uint64) for x in table["words"].to_pylist()]
    tokens = [np.frombuffer(x, "<u4").astype(np.int64) for x in table["tokens"].to_pylist()]
    different, place = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(place, np.concatenate(tokens))
    weight = np.log(total / known.sizes[known.classes[buckets_of(different)]])
    at = 0
    for r, w, n in zip(table.select(["batch", "docs", "members"]).to_pylist(), words, tokens, strict=True):
        member = np.cumsum(_from_low_high(r["members"])) % (1 << 16)
        sums = np.bincount(member, np.repeat(weight[place[at:at + len(w)]], n), r["docs"])
        at += len(w)
        yield pa.RecordBatch.from_arrays([pa.array([r["batch"]]), pa.nulls(1, pa.binary()), pa.array([sums.astype("<f4").tobytes()], pa.binary())], names=REPLY)


def _word_scores(docs: DataFrame, vocabulary) -> DataFrame:
    """(key, words): the sum of log(occurrences of the word / occurrences of its class) over the words of each document.

    A slice holds the different words of all batches in a part of the hash range, and sums by document go back to their batch.
    """
    slices = max(1, shuffle_partitions(docs.sparkSession) // 4)
    # The rows with the keys are spread over the slices' tasks.
    to = F.when(F.col("slice") >= 0, F.col("slice")).otherwise(F.pmod(F.col("batch"), F.lit(slices)))
    dealt = _postings(docs, slices).withColumn("to", to.cast("int")).repartitionById(slices, F.col("to")).sortWithinPartitions("to")

    def run(batches):
        at, held = None, []
        for batch in batches:
            for i, to in enumerate(batch["to"].to_pylist()):
                if held and to != at:
                    yield from _answers(held, vocabulary.value)
                    held = []
                at = to
                held.append(batch.slice(i, 1))
        if held:
            yield from _answers(held, vocabulary.value)

    def added(table: pa.Table) -> pa.Table:
        """The slices' sums of one batch, or of several batches of the same rows, which have the same keys and as many sums each."""
        keys = [k for k in table["keys"].to_pylist() if k is not None]
        sums = np.zeros(len(keys[0]) // 8)
        for part in table["sums"].to_pylist():
            if part is not None:
                sums += np.frombuffer(part, "<f4")
        return pa.table({"key": np.frombuffer(keys[0], "<i8"), "words": sums / len(keys)})

    replies = dealt.mapInArrow(run, "batch bigint, keys binary, sums binary")
    by_row = replies.groupBy("batch").applyInArrow(added, "key bigint, words double")
    return by_row.groupBy("key").agg(F.max("words").alias("words"))  # equal rows have equal sums


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, share_words: int = SHARE_WORDS) -> DataFrame:
    """doc_id, n_words, log_prob (sum over all words) and mean_log_prob of every row of ``docs``.

    Counts and weights come from all documents; how the input is split does not matter. Null and empty texts have 0 words, log_prob 0 and
    a null mean; repeated rows are counted and scored each; texts of any length are scored whole; an empty table gives an empty
    table; other columns are not read.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    keyed = rows.select("doc_id", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("key"), "text")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shares = materialise(shared(keyed, max(1, size // (6 * share_words))))  # about six characters a word
    vocabulary, net = train(shares, rounds)
    contexts = _context_scores(shares, vocabulary, net)
    joined = contexts.join(_word_scores(keyed, vocabulary), "key", "left")
    log_prob = F.when(F.col("n_words") > 0, F.col("context") + F.col("words")).otherwise(F.lit(0.0))
    return joined.select("doc_id", "n_words", log_prob.alias("log_prob"), F.try_divide(log_prob, F.col("n_words")).alias("mean_log_prob"))
