"""Language, toxicity and language-model scores: held-out accuracy, brute force of the parts, and awkward rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from civicframe.llm import language_id, lm_scoring, toxicity
from civicframe.llm.common import WORD, WordHashes
from tests.llm.fixtures import awkward, empty, rows_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_languages_of_held_out_documents(docs):
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = language_id.identify(docs).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_languages_of_awkward_rows(spark):
    rows = awkward(spark, ["hello there my friend " * 5, "1234 ... !!"], extra=True)
    got = language_id.identify(rows).collect()
    assert len(got) == rows.count()
    text = {r["doc_id"]: r["text"] for r in rows.collect()}
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] not in (5, 7):
            assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, text[r["doc_id"]] or "")))
    assert all(r["held_out"] for r in got if r["doc_id"] is None)
    assert language_id.identify(empty(spark)).count() == 0
    nothing = language_id.identify(spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")).collect()
    assert [tuple(r) for r in nothing] == [(1, False, "und", 0.0)]


def test_lookup_tables_equal_the_convolutions():
    rng = np.random.default_rng(3)
    net = language_id.ByteNet.fresh(["a", "b", "c"], rng)
    x = rng.integers(0, 256, (4, language_id.WINDOW)).astype(np.uint8)
    pooled = []
    for w, weights, bias in zip(language_id.WIDTHS, net.filters, net.bias, strict=True):
        spans = np.stack([net.embedding[x[:, t:t + w]].reshape(4, -1) for t in range(language_id.WINDOW - w + 1)], axis=1)
        pooled.append((spans @ weights).max(axis=1) + bias)
    expected = language_id.softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ net.out + net.out_bias)
    assert np.allclose(net.predictor()(x), expected, atol=1e-5)


def numeric(loss, parameters, gradients, rng):
    for p, g in zip(parameters, gradients, strict=True):
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in p.shape)
            kept, step = p[at], 1e-5
            p[at] = kept + step
            up = loss()
            p[at] = kept - step
            down = loss()
            p[at] = kept
            assert abs((up - down) / (2 * step) - g[at]) < 1e-5


def test_gradients():
    rng = np.random.default_rng(6)
    net = language_id.ByteNet.fresh(["a", "b", "c"], rng)
    for name in ("embedding", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.filters, net.bias = [f.astype(np.float64) for f in net.filters], [b.astype(np.float64) for b in net.bias]
    x, y = rng.integers(97, 123, (5, language_id.WINDOW)).astype(np.uint8), rng.integers(0, 3, 5)
    numeric(lambda: -np.log(net.predictor()(x)[np.arange(5), y]).mean(), net.parameters(), net.gradients(x, y), rng)
    known = lm_scoring.Vocabulary.of(np.arange(lm_scoring.BUCKETS))
    lm = lm_scoring.WindowNet.fresh(np.arange(lm_scoring.BUCKETS), known)
    lm.weights = [w.astype(np.float64) for w in lm.weights]
    context, target = rng.integers(0, lm_scoring.CLASSES + 1, (6, lm_scoring.SLOTS)), rng.integers(0, lm_scoring.CLASSES, 6)
    side = lm_scoring.SIDE

    def loss():
        total = 0.0
        for c, t in zip(context, target, strict=True):
            total -= lm.scorer()(np.array([*c[:side], t, *c[side:]]), np.array([side]))[0]
        return total / 6

    numeric(loss, lm.weights, lm.gradients(context, target), rng)


def test_language_model_adds_up_and_prefers_the_corpus(spark, docs):
    import random
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rng = random.Random(5)
    for key, text in rows[:200]:
        words = text.split()
        rng.shuffle(words)
        rows.append((key + 10_000, " ".join(words)))
    rows += [(20_000, None), (20_001, ""), (20_002, "zzzz qqqq"), (20_002, "zzzz qqqq")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in lm_scoring.score_documents(frame, rounds=8).collect()}
    assert tuple(got[20_000]) == (20_000, 0, 0.0, None) and got[20_001]["mean_log_prob"] is None
    for key, text in rows:
        words = WORD.findall(text or "")
        assert got[key]["n_words"] == len(words)
        assert not words or got[key]["log_prob"] < 0 and math.isclose(got[key]["mean_log_prob"], got[key]["log_prob"] / len(words))
    longer = [k for k, _ in rows[:200] if got[k]["n_words"] > 50]
    assert np.mean([got[k]["mean_log_prob"] > got[k + 10_000]["mean_log_prob"] for k in longer]) > 0.6
    assert lm_scoring.score_documents(empty(spark)).count() == 0
    assert lm_scoring.score_documents(awkward(spark, extra=True)).count() == awkward(spark).count()


def test_every_word_is_learned_once_by_default(spark, docs, monkeypatch):
    counts, keys = np.array([7, 0, 400, 1]), np.arange(4, dtype=np.uint64)
    turns = []
    monkeypatch.setattr(lm_scoring, "train_round", lambda shares, vocabulary, net, words, turn: turns.append(turn) or net)
    lm_scoring.score_documents(docs.limit(5))
    masked = np.concatenate([lm_scoring._masked(counts, keys, turn) for turn in turns])
    assert sorted(masked.tolist()) == list(range(counts.sum()))


def test_scores_equal_a_plain_sum(spark, docs):
    """Every word by itself: the softmax over its neighbours' classes, and its share of the occurrences of its class."""
    rows = [(r["doc_id"], r["text"]) for r in docs.limit(40).collect()]
    rows += [tuple(r) for r in awkward(spark).select("doc_id", "text").collect()]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    keyed = frame.selectExpr("doc_id", "xxhash64(doc_id, coalesce(text, '')) AS key", "text")
    shares = lm_scoring.shared(keyed, max(1, sum(len(t or "") for _, t in rows) // 6_000))
    vocabulary, net = lm_scoring.train(shares)
    embedding, w1, b1, w2, b2 = [w.astype(np.float64) for w in net.weights]
    hashes, numbers = WordHashes(), {}
    words = [WORD.findall(t or "") for _, t in rows]
    for w in {w for ws in words for w in ws}:
        numbers[w] = int(next(hashes.rows(pa.array([w])))[0]) % lm_scoring.BUCKETS
    times, classes = Counter(w for ws in words for w in ws), vocabulary.value.classes
    of_class = Counter()
    for w, n in times.items():
        of_class[classes[numbers[w]]] += n
    expected = []
    for (key, _), ws in zip(rows, words, strict=True):
        own, total = [classes[numbers[w]] for w in ws], 0.0
        for i, w in enumerate(ws):
            near = [own[j] if 0 <= j < len(ws) else lm_scoring.PAD for j in (i - 2, i - 1, i + 1, i + 2)]
            z = np.tanh(embedding[near].ravel() @ w1 + b1) @ w2 + b2
            total += z[own[i]] - np.log(np.exp(z).sum()) + np.log(times[w] / of_class[own[i]])
        expected.append((key, len(ws), total))
    got = lm_scoring.score_documents(frame.repartition(7), share_words=1_000).collect()
    by = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    for a, b in zip(sorted(expected, key=by), sorted(([*r][:3] for r in got), key=by), strict=True):
        assert (a[0], a[1]) == (b[0], b[1]) and b[2] == pytest.approx(a[2], rel=1e-3, abs=1e-3)


def test_scores_do_not_depend_on_partitions(spark, docs):
    part = docs.limit(300)
    few, many = (
        {r["doc_id"]: r["log_prob"] for r in lm_scoring.score_documents(part.repartition(n), share_words=20_000).collect()} for n in (2, 16))
    assert few.keys() == many.keys() and all(math.isclose(few[k], many[k], rel_tol=1e-5, abs_tol=1e-3) for k in few)


def test_default_training_prefers_the_corpus(spark, docs):
    import random
    rng, rows = random.Random(5), [(r["doc_id"], r["text"]) for r in docs.collect()]
    for key, text in rows[:200]:
        words = text.split()
        rng.shuffle(words)
        rows.append((key + 10_000, " ".join(words)))
    got = {r["doc_id"]: r for r in lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    longer = [k for k, _ in rows[:200] if got[k]["n_words"] > 50]
    assert np.mean([got[k]["mean_log_prob"] > got[k + 10_000]["mean_log_prob"] for k in longer]) > 0.6


def test_conditional_probabilities_of_the_network_sum_to_one():
    counts = np.random.default_rng(1).integers(0, 50, lm_scoring.BUCKETS)
    known = lm_scoring.Vocabulary.of(counts)
    assert (np.bincount(known.classes, counts, lm_scoring.CLASSES) == known.sizes).all()
    score = lm_scoring.WindowNet.fresh(counts, known).scorer()
    total = sum(np.exp(score(np.array([3, 9, t, 120, lm_scoring.PAD]), np.array([2]))[0]) for t in range(lm_scoring.CLASSES))
    assert abs(total - 1) < 1e-4


@pytest.mark.parametrize("plain,hidden", [("idiot", "1d10t"), ("stupid", "$tup1d"), ("loser", "lоsеr"), ("moron", "mоr0n"), ("trash", "7rásh"),
                                          ("clown", "CL0WN"), ("worthless", "w​orth1ess"), ("scum", "ѕсυm")])
def test_folding(plain, hidden):
    assert toxicity.fold(hidden) == toxicity.fold(plain)


def test_folding_leaves_numbers():
    assert toxicity.fold("In 2024, 17 of 30!") == "ln 2024, 17 of 30!"


def test_matching_weights_words_and_exceptions():
    lexicon = toxicity.Lexicon({"trash": 2.0, "ldlot": 3.0}, {"trash can", "the trash"}, 1.0, -2.0)
    found = lexicon.matcher()
    assert found("you are TR4SH, an 1d1ot") == (5.0, 5)
    assert found("the trash, a trash can; trashy idiots") == (0.0, 7)
    assert found("") == (0.0, 1)
    score = lexicon.scorer()
    assert 0 < score(None) == score("") < 0.7 < score("idiot idiot")
    assert score("idiot") > score("idiot " + "fine words " * 2000)


def test_toxicity_of_held_out_documents(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    many = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = [r for r in toxicity.score_documents(many, labels).collect() if r["doc_id"] in truth and r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in got)
    hits = [r["predicted"] == 1 for r in got if truth[r["doc_id"]] == 1]
    false = [r["predicted"] == 1 for r in got if truth[r["doc_id"]] == 0]
    assert np.mean(hits) > 0.85 and np.mean(false) < 0.01


def test_toxicity_knows_rare_short_and_unspaced_terms(spark):
    """Terms in 20 to 60 of 4,000 toxic documents are learned, however many other toxic labels there are."""
    import random
    rng, filler = random.Random(2), [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x" for i in range(400)]
    glyphs = "天地人山水火木金土日月星云雨风花草鸟鱼虫"
    rows = []
    for i in range(4_000):
        a, b = rng.choice(filler), rng.choice(filler)
        word = "gnarl" if i % 200 == 0 else "zq" if i % 200 == 1 else "vile"
        cjk = "".join(glyphs[(i * k + k) % 20] for k in (3, 7, 11))
        rows.append((i, f"{cjk}坏蛋{cjk[::-1]}" if i % 66 == 5 else f"{a} {b} {word} {a}", 1))
        rows.append((10_000 + i, f"{cjk}{cjk[::-1]}" if i % 66 == 5 else f"{a} {b} {a}", 0))
    probes = ["wcax gnarl wdax", "wcax zq wdax", "火木坏蛋金土", "wcax wdax", "火木金土"]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(90_000 + i, t) for i, t in enumerate(probes)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(docs, labels).where("doc_id >= 90000").collect()}
    assert [got[90_000 + i] for i in range(5)] == [1, 1, 1, 0, 0]


def test_toxicity_of_awkward_rows(spark):
    rows = awkward(spark, ["you idiot"] * 12 + ["fine words"] * 12, extra=True)
    labels = spark.createDataFrame([(100 + i, 1, int(i < 12)) for i in range(24)] + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    got = toxicity.score_documents(rows, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == rows.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.collect())
    none = toxicity.score_documents(rows, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}
    assert rows_of(toxicity.score_documents(empty(spark), labels)) == []


def test_word_hashes_of_bytes():
    import pyarrow as pa

    texts = ["a b a", None, "", "b", "b a\tb", " é\x0bé  漢字 a", "x" * 3000, "ab", "cd", "ab cd", "\x00 \x00\x00", "end\n"] * 40
    hashes = WordHashes()
    rows = list(hashes.rows(pa.array(texts)))
    known = {}
    for text, row in zip(texts, rows, strict=True):
        words = WORD.findall(text or "")
        assert len(words) == len(row)
        for w, h in zip(words, row.tolist(), strict=True):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    long = ["w" * 700_000 + " " + "v" * 1_500_000, " ".join(f"q{i % 99}" for i in range(400_000))]
    first, second = hashes.rows(pa.array(long))
    assert len(first) == 2 and len(second) == 400_000 and len(set(second.tolist())) == 99
    assert list(hashes.rows(pa.array(["zz", "a b", "c"]).slice(1)))[0][0] == rows[0][0]
