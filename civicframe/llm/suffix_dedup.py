"""Removal of repeated byte strings by prefix-free parsing: phrases, their dictionary, and the parse in corpus order.

**Parsing.** A rolling hash over pieces of PIECE bytes triggers: the piece with the smallest hash inside a string of ``length``
bytes (the leftmost of equal ones) is its trigger. Which piece that is depends on the string alone. Neighbouring strings with the
same trigger make a phrase, so every string of ``length`` bytes lies in exactly one phrase, and phrases overlap by ``length - 1``
bytes. A document is the sequence of its phrases.

**Parse.** Occurrences of phrases, by hash, are put into corpus order: id, then place. Of equal phrases all but the first
occurrence are copies throughout. If a trigger has one phrase only, its first occurrence holds no copies either; for most
of a repetitive corpus that is all there is to do, and it costs an entry for each phrase, not for each byte.

**Dictionary.** The first occurrences of different phrases around one trigger can still share strings. Their texts, once each, make up
the dictionary. Its suffixes are sorted by prefix doubling to the depth of ``length`` bytes; suffixes with the same rank are the
same string. Each rank has the occurrences of its phrases, shifted by the place of the suffix in them, and the earliest in corpus
order is the original. As a string never reaches into a second phrase, the order of the parse is needed at depth one only.

A trigger inside a boilerplate line may have a phrase of its own in every document. Where a batch meets more than CROWD of them,
their strings are compared one by one, each dealt by its own digest, so no task receives them all; a mark under
the trigger's hash makes the other batches do the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import BASE, INVERSE, arrow_pass, mixed, pick, powers, shuffle_partitions
from civicframe.llm.substring_dedup import sliding_min
from civicframe.session import materialise

PIECE = 32
#: Bytes that are parsed at a time, and dictionary bytes that are sorted at a time; neither changes the result.
BLOCK, SORTED = 1 << 20, 1 << 22
PLACE_BITS = 24
#: Different phrases around one trigger in a batch from which on their strings are compared one by one.
CROWD = 16
#: An entry goes to its trigger's slice, says that its strings are copies, asks for single strings, or marks a crowded trigger.
PLAIN, COPY, SINGLE, MARK = range(4)
RUN = np.dtype([("start", "<u4"), ("n", "<u4"), ("verdict", "<u8")])
#: Verdicts on a run of strings: copies, to be compared one by one, or else the trigger by which to compare them.
IS_COPY, ONE_BY_ONE = 0, 1
LAST = np.iinfo(np.int64).max
#: The answer of a slice to the documents of a home: which documents, how many runs each has, and the runs.
REPLY = "home int, ids binary, salts binary, counts binary, runs binary"
FOUND = "id bigint, salt bigint, runs binary, open boolean"
#: Bytes of runs that are handed on at a time.
HANDED = 1 << 23


class Parser:
    """Phrases of the texts of a column, a block of bytes at a time."""

    def __init__(self, length: int):
        self.length, self.piece = length, min(PIECE, (length + 1) // 2)
        self.up, self.down = powers(BASE, BLOCK + length), powers(INVERSE, BLOCK + length)

    def blocks(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(bytes, ends of the pieces of documents in them, rows, offsets of the pieces in their documents)."""
        if not len(column):
            return
        width = np.int64 if pa.types.is_large_string(column.type) else np.int32
        ends = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK, side="right")) - 1)
            if ends[to] - ends[at] <= BLOCK:
                yield data[ends[at]:ends[to]], ends[at + 1:to + 1] - ends[at], np.arange(at, to), np.zeros(to - at, np.int64)
            else:  # one long document
                for low in range(int(ends[at]), int(ends[to]), BLOCK):
                    part = data[low:min(low + BLOCK + self.length - 1, int(ends[to]))]
                    yield part, np.array([len(part)]), np.array([at]), np.array([low - ends[at]])
            at = to

    def phrases(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """First string, number of strings, trigger hash, phrase hash and piece of document of each phrase of a block."""
        n, length, piece = len(data), self.length, self.piece
        if n < length:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        pieces = mixed((sums[piece:] - sums[:-piece]) * self.down[:n + 1 - piece])
        places = np.arange(len(pieces), dtype=np.uint64)
        ordered = ((pieces >> np.uint64(PLACE_BITS)) << np.uint64(PLACE_BITS)) | places
        trigger = (sliding_min(ordered, length - piece + 1) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        inside = np.ones(n + 1, bool)
        for end in ends.tolist():  # strings that would reach beyond their document
            inside[max(0, end - length + 1):end] = False
        start = np.flatnonzero(inside[:len(trigger)])
        trigger = trigger[start]
        first = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]])) if len(start) else np.zeros(0, np.int64)
        many = np.diff(np.append(first, len(start)))
        start, trigger = start[first], trigger[first]
        text = (sums[start + many - 1 + length] - sums[start]) * self.down[start]
        return (start, many, np.maximum(pieces[trigger], np.uint64(2)), mixed(text + many.astype(np.uint64) * BASE),
                np.searchsorted(ends, start, side="right"))


def _planes(values: np.ndarray) -> bytes:
    """Numbers as all their lowest 16 bits, then all the next, ...: small numbers leave most parts zero, which compresses."""
    return np.ascontiguousarray(values.view("<u2").reshape(len(values), -1).T).tobytes()


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    parts = np.dtype(kind).itemsize // 2
    return np.ascontiguousarray(np.frombuffer(data, "<u2").reshape(parts, -1).T).view(kind).ravel()


def _same(*columns: np.ndarray) -> np.ndarray:
    """Which rows of sorted columns equal the row before."""
    out = np.zeros(len(columns[0]), bool)
    out[1:] = True
    for c in columns:
        out[1:] &= c[1:] == c[:-1]
    return out


def _grouped(keys: np.ndarray, least: int = 2) -> np.ndarray:
    """Places of the values that occur ``least`` times or more."""
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(~_same(keys[order]))
    many = np.diff(np.append(first, len(order)))
    return order[np.repeat(many >= least, many)]


def _joined(parts: list, kind) -> np.ndarray:
    return np.concatenate(parts).astype(kind, copy=False) if parts else np.zeros(0, kind)


#: Packed columns of entries: their numbers, and how they are packed.
ENTRIES = {"trigger": "<u8", "phrase": "<u8", "start": "<u4", "n": "<u4", "kind": "<u2"}
SENT = "slice int, " + ", ".join(f"{c} binary" for c in (*ENTRIES, "texts", "ids", "salts", "docs"))


def _packed(batch: pa.RecordBatch, slices: np.ndarray, row: np.ndarray, columns: dict[str, np.ndarray], texts: list[bytes] | None = None) -> dict:
    """A row for each slice with the entries in it. The documents of entries are listed once for each slice."""
    order = np.argsort(slices.astype(np.uint16) if len(slices) and slices.max() < 1 << 16 else slices, kind="stable")
    used, first = np.unique(slices[order], return_index=True)
    edges = np.append(first, len(order))
    ids = batch["id"].to_numpy(zero_copy_only=False).astype("<i8")
    salts = batch["salt"].to_numpy(zero_copy_only=False).astype("<i8")
    out = {"slice": used.astype(np.int32)} | {c: [] for c in (*ENTRIES, "texts", "ids", "salts", "docs")}
    ordered = {c: v[order].astype(ENTRIES[c]) for c, v in columns.items()}
    row = row[order]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        for c, v in ordered.items():
            out[c].append(v[a:b].tobytes() if c in ("trigger", "phrase") else _planes(v[a:b]))
        head = np.flatnonzero(~_same(row[a:b]))
        member = row[a:b][head]
        out["docs"].append(_planes(np.diff(np.append(head, b - a)).astype("<u4")))
        out["ids"].append(_planes(ids[member]))
        out["salts"].append(salts[member].tobytes())
        out["texts"].append(b"".join(texts[k] for k in order[a:b].tolist()) if texts else b"")
    return out


def _by_slice(sent: DataFrame, answer) -> DataFrame:
    """``answer(rows of one slice)`` over all slices, one at a time in a task; then (id, salt, runs, open), a row for
    each document that has an answer. A slice sends a row to each home, not to each document.
    """
    homes = shuffle_partitions(sent.sparkSession)
    dealt = sent.repartitionById(homes, F.col("slice")).sortWithinPartitions("slice")

    def run(batches):
        at, held = None, []
        for batch in batches:
            slices = batch["slice"].to_numpy()
            edges = [0, *(np.flatnonzero(slices[1:] != slices[:-1]) + 1).tolist(), len(slices)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if held and slices[a] != at:
                    yield _by_home(answer(_Slice(held)), homes)
                    held = []
                at = slices[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield _by_home(answer(_Slice(held)), homes)

    return _by_document(dealt.mapInArrow(run, REPLY))


def _by_document(replies: DataFrame) -> DataFrame:
    """The runs of each document, of all slices together."""

    def run(batches):
        rows = [b for b in batches if len(b)]
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        ids, salts, counts, runs = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table[c]]) for c, kind in (
            ("ids", "<i8"), ("salts", "<i8"), ("counts", "<i8"), ("runs", RUN)))
        by_document = np.lexsort((salts, ids))
        new = ~_same(ids[by_document], salts[by_document])
        of = np.empty(len(ids), np.int64)
        of[by_document] = np.cumsum(new) - 1
        runs = runs[np.argsort(np.repeat(of, counts), kind="stable")]
        ids, salts = ids[by_document[new]], salts[by_document[new]]
        ends = np.cumsum(np.bincount(of, counts, len(ids)).astype(np.int64))
        begins = np.concatenate([[0], ends[:-1]])
        still_open = np.logical_or.reduceat(runs["verdict"] != IS_COPY, begins)
        at = 0
        while at < len(ids):
            to = max(at + 1, int(np.searchsorted(ends, begins[at] + HANDED // RUN.itemsize, side="right")))
            offsets = (np.append(begins[at:to], ends[to - 1]) - begins[at]) * RUN.itemsize
            packed = pa.BinaryArray.from_buffers(
                pa.binary(), to - at, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(runs[begins[at]:ends[to - 1]].copy())])
            yield pa.RecordBatch.from_arrays([pa.array(ids[at:to]), pa.array(salts[at:to]), packed, pa.array(still_open[at:to])],
                                             names=["id", "salt", "runs", "open"])
            at = to

    return replies.repartitionById(shuffle_partitions(replies.sparkSession), F.col("home")).mapInArrow(run, FOUND)


class _Slice:
    """The entries of one slice as arrays."""

    def __init__(self, rows: list[pa.RecordBatch]):
        table = pa.Table.from_batches(rows)
        values = lambda name: table[name].to_pylist()
        for c, kind in ENTRIES.items():
            read = (lambda x: np.frombuffer(x, kind)) if c in ("trigger", "phrase") else (lambda x: _from_planes(x, kind))  # noqa: B023
            setattr(self, c, np.concatenate([read(x) for x in values(c)]))
        per_doc = np.concatenate([_from_planes(x, "<u4") for x in values("docs")])
        self.id = np.repeat(np.concatenate([_from_planes(x, "<i8") for x in values("ids")]), per_doc)
        self.salt = np.repeat(np.concatenate([np.frombuffer(x, "<i8") for x in values("salts")]), per_doc)
        self.texts = values("texts")

    def reply(self, at: np.ndarray, start: np.ndarray, n: np.ndarray, verdict: np.ndarray) -> pa.RecordBatch:
        """Runs of strings, packed by document."""
        order = np.lexsort((self.salt[at], self.id[at]))
        at = at[order]
        ids, salts = self.id[at], self.salt[at]
        runs = np.empty(len(at), RUN)
        runs["start"], runs["n"], runs["verdict"] = start[order], n[order], verdict[order]
        first = np.flatnonzero(~_same(ids, salts))
        offsets = (np.append(first, len(at)) * RUN.itemsize).astype(np.int32)
        packed = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(runs)])
        still_open = np.logical_or.reduceat(runs["verdict"] != IS_COPY, first) if len(first) else np.zeros(0, bool)
        return pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(salts[first]), packed, pa.array(still_open)],
                                          names=["id", "salt", "runs", "open"])


def _by_home(reply: pa.RecordBatch, homes: int) -> pa.RecordBatch:
    """A reply with a row for each home of documents instead of one for each document."""
    ids, salts = (reply[c].to_numpy().astype("<i8") for c in ("id", "salt"))
    ends = np.frombuffer(reply["runs"].buffers()[1], np.int32)[1:len(reply) + 1] if len(reply) else np.zeros(0, np.int32)
    counts = (np.diff(ends, prepend=0) // RUN.itemsize).astype("<i8")
    runs = np.frombuffer(reply["runs"].buffers()[2], RUN) if len(reply) else np.zeros(0, RUN)
    home = ((mixed(ids.view(np.uint64) * BASE + salts.view(np.uint64)) >> np.uint64(32)) % np.uint64(homes)).astype(np.int32)
    order = np.argsort(home, kind="stable")
    place = np.repeat(home, counts)
    used, first = np.unique(home[order], return_index=True)
    runs, starts = runs[np.argsort(place, kind="stable")], np.searchsorted(np.sort(place), used)
    cut = lambda values, at: pa.array([x.tobytes() for x in np.split(values, at[1:])] if len(at) else [], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(used), cut(ids[order], first), cut(salts[order], first), cut(counts[order], first), cut(runs, starts)],
                                      names=["home", "ids", "salts", "counts", "runs"])


def _parsed(keyed: DataFrame, length: int, slices: int) -> DataFrame:
    """The phrases of all documents, packed. Of equal phrases in a batch, the first in corpus order stands for all."""

    def make():
        parser = Parser(length)

        def step(batch):
            found = [], [], [], [], []
            texts = batch["text"]
            for data, ends, rows, offsets in parser.blocks(texts):
                start, many, trigger, phrase, part = parser.phrases(data, ends)
                begins = np.concatenate([[0], ends[:-1]])
                for of, values in zip(found, (trigger, phrase, start - begins[part] + offsets[part], many, rows[part]), strict=True):
                    of.append(values)
            trigger, phrase, start, many, row = (_joined(f, k) for f, k in zip(found, (np.uint64, np.uint64, np.int64, np.int64, np.int64), strict=True))
            ids = batch["id"].to_numpy(zero_copy_only=False)[row]
            salts = batch["salt"].to_numpy(zero_copy_only=False)[row]
            kind, gone = np.full(len(row), PLAIN), np.zeros(len(row), bool)
            at = _grouped(trigger ^ mixed(phrase))
            at = at[np.lexsort((start[at], salts[at], ids[at], phrase[at], trigger[at]))]
            later = _same(trigger[at], phrase[at])
            head = at[np.maximum.accumulate(np.where(later, 0, np.arange(len(at))))]
            again = later & (ids[at] == ids[head]) & (salts[at] == salts[head]) & (start[at] == start[head])
            kind[at[later]] = COPY
            gone[at[again]] = True  # the same place of an equal row
            plain = np.flatnonzero(kind == PLAIN)
            crowded = plain[_grouped(trigger[plain], CROWD + 1)]
            kind[crowded] = SINGLE
            marks = crowded[np.unique(trigger[crowded], return_index=True)[1]]
            by = mixed(np.where(kind == PLAIN, trigger, phrase + start.astype(np.uint64) * BASE + row.astype(np.uint64)))
            keep = np.concatenate([np.flatnonzero(~gone), marks])
            keep = keep[np.argsort(row[keep], kind="stable")]
            is_mark = np.zeros(len(keep), bool)
            kinds = kind[keep]
            if len(marks):  # a crowded trigger's entry occurs twice in ``keep``: once for itself and once as its mark
                twice = np.flatnonzero(np.isin(keep, marks))
                is_mark[twice[~_first_of(keep[twice])]] = True
                kinds[is_mark] = MARK
            hashed = np.where(is_mark, mixed(trigger[keep]), by[keep])
            columns = {"trigger": trigger[keep], "phrase": np.where(is_mark, np.uint64(0), phrase[keep]), "start": start[keep], "n": many[keep], "kind": kinds}
            return _packed(batch, ((hashed >> np.uint64(32)) % np.uint64(slices)).astype(np.int64), row[keep], columns)

        return step

    return arrow_pass(keyed, SENT, make)


def _first_of(values: np.ndarray) -> np.ndarray:
    """Which values have not occurred before."""
    out = np.zeros(len(values), bool)
    out[np.unique(values, return_index=True)[1]] = True
    return out


def _judged(slice_: _Slice) -> pa.RecordBatch:
    """Which runs of strings are copies, and which are to be compared by text, from the phrases in corpus order."""
    known = np.flatnonzero((slice_.kind == COPY) | (slice_.kind == SINGLE))
    here = np.flatnonzero((slice_.kind == PLAIN) | (slice_.kind == MARK))
    at = here[_grouped(slice_.trigger[here])]
    s = slice_
    at = at[np.lexsort((s.start[at], s.salt[at], s.id[at], s.phrase[at], s.kind[at] != MARK, s.trigger[at]))]
    same_trigger = _same(s.trigger[at])
    mark = s.kind[at] == MARK
    same_phrase = _same(s.trigger[at], s.phrase[at], mark)
    group = np.cumsum(~same_trigger) - 1
    marked = np.zeros(len(at), bool)
    several = np.zeros(len(at), bool)
    if len(at):
        marked = np.bincount(group, mark)[group] > 0
        several = np.bincount(group, ~same_phrase)[group] > 1
    head = at[np.maximum.accumulate(np.where(same_phrase, 0, np.arange(len(at))))]
    is_first = (s.id[at] == s.id[head]) & (s.salt[at] == s.salt[head]) & (s.start[at] == s.start[head])
    verdict = np.where(is_first, np.where(marked, np.uint64(ONE_BY_ONE), s.trigger[at]), np.uint64(IS_COPY))
    asked = ~mark & (~is_first | marked | several) & ~(same_phrase & is_first)
    told = np.where(s.kind[known] == COPY, np.uint64(IS_COPY), np.uint64(ONE_BY_ONE))
    at, verdict = np.concatenate([known, at[asked]]), np.concatenate([told, verdict[asked]])
    return s.reply(at, s.start[at], s.n[at], verdict)


def _runs_of(packed) -> np.ndarray:
    return np.unique(np.concatenate([np.frombuffer(x.as_py(), RUN) for x in packed]))


def _dictionary(asked: DataFrame, length: int, slices: int) -> DataFrame:
    """The phrases that are to be compared by text, and the digests of strings that are compared one by one, packed."""

    def make():
        def step(batch):
            trigger, start, many, kind, row, texts = [], [], [], [], [], []
            earliest: dict[bytes, tuple] = {}
            ids, salts = batch["id"].to_pylist(), batch["salt"].to_pylist()

            def add(of, first, n, what, i, text):
                for column, value in zip((trigger, start, many, kind, row, texts), (of, first, n, what, i, text), strict=True):
                    column.append(value)

            for i, (text, packed) in enumerate(zip(_bytes_of(batch["text"]), batch["runs"], strict=True)):
                for first, n, verdict in _runs_of(packed).tolist():
                    if verdict == ONE_BY_ONE:
                        for p in range(first, first + n):
                            digest = hashlib.blake2b(text[p:p + length], digest_size=16).digest()
                            place = (ids[i], salts[i], p, i)
                            other = earliest.setdefault(digest, place)
                            if place[:3] < other[:3]:
                                earliest[digest], place = place, other
                            if place[:3] != earliest[digest][:3]:
                                add(2, place[2], 1, COPY, place[3], b"")
                    elif verdict != IS_COPY:
                        add(verdict, first, n, PLAIN, i, text[first:first + n - 1 + length])
            for digest, (_, _, p, i) in earliest.items():
                add(int.from_bytes(digest[:8], "little"), p, 1, SINGLE, i, digest)
            kind, trigger, row = np.array(kind, np.int64), np.array(trigger, np.uint64), np.array(row, np.int64)
            start, many = np.array(start, np.int64), np.array(many, np.int64)
            by = mixed(np.where(kind == COPY, start.astype(np.uint64) * BASE + row.astype(np.uint64), trigger))
            order = np.argsort(row, kind="stable")
            columns = {"trigger": trigger, "phrase": np.zeros(len(row), np.uint64), "start": start, "n": many, "kind": kind}
            dealt = ((by >> np.uint64(32)) % np.uint64(slices)).astype(np.int64)
            return _packed(batch, dealt[order], row[order], {c: v[order] for c, v in columns.items()}, [texts[k] for k in order.tolist()])

        return step

    return arrow_pass(asked, SENT, make)


def _bytes_of(column: pa.Array) -> Iterator[bytes]:
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    for at in range(0, len(column), 256):
        yield from column.slice(at, 256).to_pylist()


def suffix_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """The rank of each suffix with ``depth`` bytes or more among all of them by its first ``depth`` bytes: prefix doubling.

    Up to eight bytes the prefix itself is the rank; from there on, ranks of pairs of ranks are made dense by sorting.
    """
    dense = lambda r: np.unique(r, return_inverse=True)[1].astype(np.uint64)
    ranks, k = data.astype(np.uint64), 1
    while k < depth:
        step = min(k, depth - k)
        if k + step <= 8:
            ranks = (ranks[:-step] << np.uint64(8 * step)) | (ranks[step:] & np.uint64((1 << 8 * step) - 1))
        else:
            ranks = dense(ranks)
            ranks = (ranks[:-step] << np.uint64(32)) | ranks[step:]
        k += step
    return dense(ranks)


def _later(slice_: _Slice, key: np.ndarray, at: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which of the strings (equal where ``key`` is) are not the first in corpus order."""
    ids, salts = slice_.id[at], slice_.salt[at]
    order = np.lexsort((start, salts, ids, key))
    same = _same(key[order])
    head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    out = np.zeros(len(at), bool)
    out[order] = (ids[order] != ids[head]) | (salts[order] != salts[head]) | (start[order] != start[head])
    return out


def _compared(slice_: _Slice, length: int) -> pa.RecordBatch:
    """The runs of copies among the strings of a slice's dictionary."""
    s = slice_
    sizes = np.where(s.kind == PLAIN, s.n.astype(np.int64) - 1 + length, np.where(s.kind == SINGLE, 16, 0))
    text = np.frombuffer(b"".join(s.texts), np.uint8)
    begins = np.cumsum(sizes) - sizes
    known = np.flatnonzero(s.kind == COPY)
    out = [(known, s.start[known].astype(np.int64), s.n[known].astype(np.int64))]
    single = np.flatnonzero(s.kind == SINGLE)
    if len(single):
        digests = text[begins[single][:, None] + np.arange(16)].copy().view("V16").ravel()
        key = np.unique(digests, return_inverse=True)[1].ravel()
        at = single[_later(s, key, single, s.start[single])]
        out.append((at, s.start[at].astype(np.int64), s.n[at].astype(np.int64)))
    plain = np.flatnonzero(s.kind == PLAIN)
    plain = plain[np.argsort(s.trigger[plain], kind="stable")]
    room = np.cumsum(sizes[plain]) // SORTED
    while len(plain):  # whole triggers at a time: strings with different triggers differ
        to = int(np.searchsorted(room, room[0], side="right"))
        to = int(np.searchsorted(s.trigger[plain], s.trigger[plain[to - 1]], side="right"))
        now, plain, room = plain[:to], plain[to:], room[to:]
        local = np.cumsum(sizes[now]) - sizes[now]
        joined = np.concatenate([text[b:b + n] for b, n in zip(begins[now], sizes[now], strict=True)])
        ranks = suffix_ranks(joined, length)
        many = s.n[now].astype(np.int64)
        of = np.repeat(np.arange(len(now)), many)
        within = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        start = s.start[now][of].astype(np.int64) + within
        gone = np.flatnonzero(_later(s, ranks[local[of] + within], now[of], start))
        first = np.flatnonzero(~(_same(of[gone]) & (np.diff(gone, prepend=-2) == 1)))
        out.append((now[of[gone[first]]], start[gone[first]], np.diff(np.append(first, len(gone)))))
    at, start, n = (_joined([o[k] for o in out], np.int64) for k in range(3))
    return s.reply(at, start, n, np.full(len(at), IS_COPY, np.uint64))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, id, salt, text). Where ids repeat, the salt is a hash of the text: rows share the key only if they are equal."""
    rows = pick(docs, doc_id=doc_id, text=text)
    kind = dict(rows.dtypes)["doc_id"]
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError("corpus order needs whole numbers as ids")
    twice = not rows.groupBy("doc_id").count().where("count > 1").isEmpty()
    salt = F.xxhash64(F.coalesce("text", F.lit("")), F.col("doc_id").isNull()) if twice else F.lit(0).cast("bigint")
    number = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST))
    return rows.select("doc_id", number.alias("id"), salt.alias("salt"), F.coalesce("text", F.lit("")).alias("text"))


def copied_runs(keyed: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(id, salt, runs) and (id, salt, more): where strings of ``length`` bytes that occur earlier in the corpus begin, packed by
    document; from the phrases, and from the texts of the dictionary.
    """
    slices = shuffle_partitions(keyed.sparkSession)
    judged = materialise(_by_slice(_parsed(keyed.select("id", "salt", "text"), length, slices), _judged))
    asked = keyed.join(judged.where("open").select("id", "salt", F.array("runs").alias("runs")), ["id", "salt"])
    compared = _by_slice(_dictionary(asked, length, slices), lambda s: _compared(s, length))
    return judged.select("id", "salt", "runs"), compared.select("id", "salt", F.col("runs").alias("more"))


def remove_copies(docs: DataFrame, length: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` without the bytes of strings that start earlier too: doc_id, n_bytes, n_removed, n_spans, kept.

    Texts are UTF-8 bytes. Of equal strings of ``length`` bytes the one that starts first in the corpus stays: by id, a null id
    last, then by place. Bytes covered by any other go; strings are judged on the input. ``n_spans`` counts the maximal runs of removed
    bytes, ``kept`` holds the other bytes, which need not be whole characters. Null texts count as empty; texts
    shorter than ``length`` stay whole. Different texts under one id come in the order of a hash of the text; of equal rows
    one is the first and the others are copies. An empty table gives an empty table; other columns are not read.
    """
    if length < 2:
        raise ValueError("strings have two bytes or more")
    keyed = _keyed(docs, doc_id, text)
    judged, compared = copied_runs(keyed, length)
    marked = keyed.join(judged, ["id", "salt"], "left").join(compared, ["id", "salt"], "left")
    kind = dict(keyed.dtypes)["doc_id"]

    def make():
        def step(batch):
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for data, *packed in zip(_bytes_of(batch["text"]), batch["runs"], batch["more"], strict=True):
                spans, parts, at = 0, [], 0
                if packed := [p for p in packed if p.is_valid]:
                    runs = _runs_of(packed)
                    runs = runs[runs["verdict"] == IS_COPY]
                    steps = np.zeros(len(data) + 1, np.int32)
                    np.add.at(steps, runs["start"], 1)
                    np.add.at(steps, runs["start"].astype(np.int64) + runs["n"] - 1 + length, -1)
                    gone = np.concatenate([[False], np.cumsum(steps[:-1]) > 0, [False]])
                    edges = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
                    for low, high in zip(edges[::2], edges[1::2], strict=True):
                        parts.append(data[at:low])
                        at, spans = high, spans + 1
                parts.append(data[at:])
                left = b"".join(parts)
                for column, value in zip((n_bytes, n_removed, n_spans, kept), (len(data), len(data) - len(left), spans, left), strict=True):
                    column.append(value)
            return {"doc_id": batch["doc_id"], "id": batch["id"], "salt": batch["salt"], "n_bytes": n_bytes, "n_removed": n_removed,
                    "n_spans": n_spans, "kept": pa.array(kept, pa.binary())}

        return step

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    schema = f"doc_id {kind}, id bigint, salt bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    rows = arrow_pass(marked.select("doc_id", "id", "salt", "text", "runs", "more"), schema, make)
    equal = materialise(keyed.groupBy("id", "salt").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    if equal.isEmpty():
        return rows.select(names)
    return _with_equal_rows(materialise(rows), equal, length).select(names)


def _with_equal_rows(rows: DataFrame, equal: DataFrame, length: int) -> DataFrame:
    """Of equal rows, which came out alike, one stays as it is and the others become copies throughout."""
    lone = rows.join(equal, ["id", "salt"], "left_anti")
    alike = rows.join(equal, ["id", "salt"]).groupBy("id", "salt").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept", "copies")])
    long_enough = F.col("n_bytes") >= length
    chunk = 10_000  # so that a row with very many equals is not expanded in one task
    shares = alike.withColumn("share", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 2) / chunk).cast("int"))))
    dealt = shares.repartition(shuffle_partitions(rows.sparkSession), "id", "salt", "share")
    n_here = F.least(F.lit(chunk), F.col("copies") - 1 - F.col("share") * chunk).cast("int")
    others = dealt.withColumn("k", F.explode(F.sequence(F.lit(1), n_here))).withColumns({
        "n_removed": F.when(long_enough, F.col("n_bytes")).otherwise(F.lit(0).cast("bigint")),
        "n_spans": long_enough.cast("bigint"), "kept": F.when(long_enough, F.lit(b"")).otherwise(F.col("kept"))})
    return lone.unionByName(alike.drop("copies")).unionByName(others.drop("copies", "share", "k"))
