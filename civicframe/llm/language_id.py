"""Language identification by a byte convolutional network, trained in numpy.

Bytes are embedded, filters of several widths run over windows of fixed length, the largest response of each filter goes
into a softmax over the languages. A text is cut into windows that cover it whole; their probabilities are averaged by length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import arrow_pass, pick, texts_of
from civicframe.llm.sampling import bounded_sample, crc_of

WINDOW = 128
EMBEDDING, FILTERS, WIDTHS = 8, 16, (2, 3, 4)
#: Labelled documents to learn from, shared evenly by the languages, and windows of each.
SAMPLE_DOCUMENTS, SAMPLE_WINDOWS = 1_600, 10
UNKNOWN = "und"


@dataclass
class ByteNet:
    """The weights, and the languages in code-point order."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]  # (width * EMBEDDING, FILTERS) for each width
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> ByteNet:
        def draw(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        return cls(languages, draw(256, EMBEDDING, scale=0.5),
                   [draw(w * EMBEDDING, FILTERS, scale=(w * EMBEDDING) ** -0.5) for w in WIDTHS],
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                   draw(len(WIDTHS) * FILTERS, len(languages), scale=0.1), np.zeros(len(languages), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.bias, self.out, self.out_bias]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy of windows x (n, WINDOW) with language numbers y; only the pooled places pass anything back."""
        n, e = len(x), self.embedding[x]
        pooled, at, spans = [], [], []
        for w, weights, bias in zip(WIDTHS, self.filters, self.bias, strict=True):
            span = np.lib.stride_tricks.sliding_window_view(e, w, axis=1).transpose(0, 1, 3, 2).reshape(n, WINDOW - w + 1, w * EMBEDDING)
            response = span @ weights
            at.append(response.argmax(axis=1))
            pooled.append(np.take_along_axis(response, at[-1][:, None], axis=1)[:, 0] + bias)
            spans.append(span)
        features = np.maximum(np.concatenate(pooled, axis=1), 0)
        error = softmax(features @ self.out + self.out_bias)
        error[np.arange(n), y] -= 1
        error /= n
        back = (error @ self.out.T) * (features > 0)
        d_embedding, d_filters, d_bias = np.zeros_like(self.embedding), [], []
        for k, (w, weights) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            g = back[:, k * FILTERS:(k + 1) * FILTERS]
            taken = np.take_along_axis(spans[k], at[k][:, :, None], axis=1)  # (n, FILTERS, w * EMBEDDING)
            d_filters.append(np.einsum("nfd,nf->df", taken, g))
            d_bias.append(g.sum(axis=0))
            d_span = (g[:, :, None] * weights.T[None]).reshape(n, FILTERS, w, EMBEDDING)
            for i in range(w):
                np.add.at(d_embedding, np.take_along_axis(x, at[k] + i, axis=1), d_span[:, :, i])
        return [d_embedding, *d_filters, *d_bias, features.T @ error, error.sum(axis=0)]

    def tables(self) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Response of each width as sums of looked-up rows: by byte pair, and by the pair or byte after it."""
        found = []
        for w, weights, bias in zip(WIDTHS, self.filters, self.bias, strict=True):
            single = [self.embedding @ weights[i * EMBEDDING:(i + 1) * EMBEDDING] for i in range(w)]
            first = (single[0][:, None] + single[1][None] + bias).reshape(65536, FILTERS)
            rest = None if w == 2 else single[2] if w == 3 else (single[2][:, None] + single[3][None]).reshape(65536, FILTERS)
            found.append((first, rest))
        return found

    def predictor(self):
        """A function from windows (n, WINDOW) of bytes to probabilities."""
        tables = self.tables()

        def predict(x: np.ndarray) -> np.ndarray:
            pairs = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
            pooled = []
            for w, (first, rest) in zip(WIDTHS, tables, strict=True):
                response = first[pairs[:, :WINDOW - w + 1]]
                if rest is not None:
                    response += rest[x[:, 2:] if w == 3 else pairs[:, 2:]]
                pooled.append(response.max(axis=1))
            return softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ self.out + self.out_bias)

        return predict


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the lower-cased text after a blank, which marks the first word's begin, in rows of WINDOW, the last one
    filled with zeros; and the number of bytes in each."""
    data = b" " + text.lower().encode("utf-8", "replace")
    n = -(-len(data) // WINDOW)
    x = np.zeros(n * WINDOW, np.uint8)
    x[:len(data)] = np.frombuffer(data, np.uint8)
    sizes = np.full(n, WINDOW)
    sizes[-1:] = len(data) - (n - 1) * WINDOW
    return x.reshape(n, WINDOW), sizes


def _sample_windows(sample: DataFrame) -> DataFrame:
    """(lang, doc_id, x): some windows of each text, spread over all of it, one after another."""

    def make():
        def step(batch):
            found = []
            for text in texts_of(batch["text"]):
                x, _ = windows(text)
                found.append(x[np.unique(np.linspace(0, len(x) - 1, SAMPLE_WINDOWS).astype(int))].tobytes())
            return {"lang": batch["lang"], "doc_id": batch["doc_id"], "x": found}

        return step

    return arrow_pass(sample, f"lang string, doc_id {dict(sample.dtypes)['doc_id']}, x binary", make)


def train(x: np.ndarray, languages: list[str], epochs: int = 3, batch: int = 64, seed: int = 7) -> ByteNet:
    """Fit the network by Adam on windows (n, WINDOW) with their languages; half are cut short, as short texts are."""
    rng = np.random.default_rng(seed)
    names = sorted(set(languages))
    net = ByteNet.fresh(names, rng)
    if len(names) < 2:
        return net
    short = rng.random(len(x)) < 0.5
    ends = np.where(short, rng.integers(12, WINDOW, len(x)), WINDOW)
    x = np.where(np.arange(WINDOW) < ends[:, None], x, 0).astype(np.uint8)
    y = np.searchsorted(names, languages)
    weights = net.parameters()
    mean, square, t = [np.zeros_like(p) for p in weights], [np.zeros_like(p) for p in weights], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            some, t = order[at:at + batch], t + 1
            for p, g, m, s in zip(weights, net.gradients(x[some], y[some]), mean, square, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= 0.004 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
    return net


def learn(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> ByteNet | None:
    """Fit on a bounded sample of (doc_id, text, lang) rows that are labelled and not held out; None if there are none.

    The driver gets SAMPLE_WINDOWS windows of each document of the sample, never a text.
    """
    known = docs.where("lang is not null and text <> ''").where(crc_of(F.col("doc_id")) % 5 != 0)
    n = known.select("lang").distinct().count()
    if not n:
        return None
    sample = bounded_sample(known, "lang", max(8, sample_documents // n), "language", "doc_id").select("doc_id", "text", "lang")
    rows = sorted(map(tuple, _sample_windows(sample).collect()), key=str)
    x = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, WINDOW)
    return train(x, [r[0] for r in rows for _ in range(len(r[2]) // WINDOW)])


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             sample_documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``.

    The network learns from text and non-null ``lang`` of at most ``sample_documents`` documents (eight a language at least)
    whose crc32 of the id is not divisible by 5. Null texts and texts without a letter are ``und`` with score 0, as is
    everything when nothing is labelled. Null ids count as held out. Repeated rows are judged each, texts of any length
    whole; an empty table gives an empty table; other columns are not read.
    """
    rows = pick(docs, doc_id=doc_id, text=text, lang=lang)
    net = rows.sparkSession.sparkContext.broadcast(learn(rows, sample_documents))
    held_out = F.coalesce(crc_of(F.col("doc_id")) % 5 == 0, F.lit(True))

    def make():
        predict = net.value and net.value.predictor()

        def step(batch):
            found = _judged(batch["text"], predict, net.value.languages if net.value else [])
            return {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": found[0], "score": found[1]}

        return step

    kind = dict(rows.dtypes)["doc_id"]
    return arrow_pass(rows.select("doc_id", held_out.alias("held_out"), "text"),
                      f"doc_id {kind}, held_out boolean, lang_pred string, score double", make)


def _judged(texts: pa.Array, predict, languages: list[str], rows: int = 512) -> tuple[list[str], list[float]]:
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if predict is None:
        return names, scores
    total = np.zeros((len(texts), len(languages)))
    length = np.zeros(len(texts))
    held, sizes, owner = [], [], []

    def flush():
        p = predict(np.concatenate(held)) * np.concatenate(sizes)[:, None]
        np.add.at(total, np.concatenate(owner), p)
        held.clear(), sizes.clear(), owner.clear()

    for i, text in enumerate(texts_of(texts)):
        if text and any(map(str.isalpha, text)):
            x, n = windows(text)
            length[i] = n.sum()
            for at in range(0, len(x), rows):
                held.append(x[at:at + rows])
                sizes.append(n[at:at + rows])
                owner.append(np.full(len(held[-1]), i))
                if sum(map(len, held)) >= rows:
                    flush()
    if held:
        flush()
    for i in np.flatnonzero(length):
        best = int(total[i].argmax())
        names[i], scores[i] = languages[best], float(min(1.0, total[i, best] / length[i]))
    return names, scores
