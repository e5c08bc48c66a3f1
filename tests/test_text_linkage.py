"""Text, pages, records and reviews on small fixtures."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicframe.functions import similarity as sim
from civicframe.functions import text as tx
from civicframe.functions.hashing import hash48, hash_normal
from civicframe.operators import linkage as ln
from civicframe.operators import prep
from civicframe.operators import review
from civicframe.operators import textual
from civicframe.sources import files, html


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "s string").select(column(F.col("s")).alias("v")).first()["v"]


def test_regular_expressions(spark):
    assert one(spark, "a quick fox", lambda s: tx.detect(s, "quick")) is True
    assert one(spark, "42 apples, 7 pears", lambda s: tx.extract_all(s, r"\d+")) == ["42", "7"]
    assert one(spark, "gray or grey", lambda s: tx.extract_all(s, "gr[a|e]y?")) == ["gray", "grey"]
    assert one(spark, "on 2023-05-15", lambda s: tx.match(s, r"(\d{4})-(\d{2})-(\d{2})", 3)) == ["2023-05-15", "2023", "05", "15"]
    assert one(spark, "no date", lambda s: tx.match(s, r"(\d{4})-(\d{2})", 2)) is None
    assert one(spark, "<p>one</p><b>two</b>", lambda s: tx.replace_all(s, r"<(\w+)>(.*?)</\1>", "[$2]")) == "[one][two]"
    assert one(spark, "häns@example.com", tx.is_email) is True
    assert one(spark, "not.an.address", tx.is_email) is False
    assert one(spark, "see https://a-b.org/x and www.c.net", tx.urls) == ["https://a-b.org", "www.c.net"]
    assert one(spark, "(123) 456-7890, 123-456-7890 1234567890 123.456.7890 12345678901", tx.standard_phones) == (
        "(123) 456-7890, (123) 456-7890 (123) 456-7890 (123) 456-7890 12345678901")
    assert one(spark, "Abcdef1!", tx.strong_password) is True
    assert one(spark, "abcdef1!", tx.strong_password) is False
    assert one(spark, "nothing", lambda s: tx.first_match(s, r"\d+")) == ""


def test_pages(spark):
    page = ('<table><tr><td>x</td><td>y</td></tr></table><table class="big infobox"><tr><th colspan=2>T</th></tr>'
            "<tr><td>Born</td><td>1900 &amp; on</td></tr><tr><td>Died</td><td></td></tr></table>"
            "<h2>Areas of  Interest</h2><p>x</p><ul><li>one <b>big</b></li><li> </li></ul><ul><li>no</li></ul>"
            "<h3>Research Interests</h3><div>two <i>three</i></div><p>no</p>")
    df = spark.createDataFrame([(1, page), (2, "plain"), (3, None)], "id int, html string")
    rows = [tuple(r) for r in html.key_value_table(df, "id", "html", "infobox").collect()]
    assert rows == [(1, 1, "Born", "1900 & on")]
    got = {r["id"]: (r["v"]["areas"], r["v"]["research"]) for r in df.select("id", html.section_items(F.col("html")).alias("v")).collect()}
    assert got[1] == (["one big"], ["two", "three"]) and got[2] == ([], [])
    assert html.body_text(F.lit("<body><p>a</p><script>b</script> c&nbsp;d</body>")) is not None
    assert one(spark, "<html><body><p>a</p><script>b</script> c&nbsp;d</body>", html.body_text) == "a b c d"


def test_platform_csv(spark, tmp_path):
    for name, ids in (("a", (1, 2)), ("b", (3,))):
        lines = ["platform note,,", '"long, quoted\nlabel",b,c', "id,name,score", *[f"{i},n{i},{'bad' if i == 2 else i}" for i in ids]]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines[:1] + ["labels,x,y"] + lines[2:]) + "\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType())])
    rows = sorted(tuple(r) for r in files.read_platform_csv(spark, str(tmp_path), schema).collect())
    assert rows == [(1, "n1", 1.0), (2, "n2", None), (3, "n3", 3.0)]


def test_missing_value_rules(spark):
    df = spark.createDataFrame([(1, "Yes", 4, 4, 4, None), (2, None, 4, 4, 4, 4), (3, "No", 1, 2, 1, 1), (4, "Yes", 2, 2, 2, 2)],
                               "i int, ok string, a int, b int, c int, d int")
    out = df.select("i", prep.differs("ok", "Yes").alias("fail"), prep.all_equal("a", "b", "c", "d").alias("line"),
                    prep.missing_share("ok", "d").alias("miss"), prep.row_mean("a", "b", "c", "d").alias("m")).orderBy("i").collect()
    assert [r["fail"] for r in out] == [False, True, True, False]
    assert [r["line"] for r in out] == [False, True, False, True]
    assert [r["miss"] for r in out] == [0.5, 0.5, 0.0, 0.0]
    assert [r["m"] for r in out] == [4.0, 4.0, 1.25, 2.0]
    empty = spark.createDataFrame([(1, None)], "g int, v double").groupBy("g").agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("s"))
    assert empty.first()["s"] == 0.0
    assert prep.clean_names(spark.createDataFrame([(1, 2)], "ResponseId int, `Q1 (policy)` int")).columns == ["responseid", "q1_policy"]
    assert prep.clean_name("ResponseId", split_camel=True) == "response_id"
    labelled = prep.set_labels(df, {"a": "Item A"})
    assert prep.get_labels(labelled) == {"a": "Item A"}
    with pytest.raises(Exception, match="not a double"):
        spark.createDataFrame([("x",)], "s string").select(prep.strict_number("s")).collect()


def test_similarities(spark):
    assert sim.jaro_winkler("MARTHA", "MARHTA") == pytest.approx(0.9611, abs=1e-4)
    assert sim.jaro_winkler("DIXON", "DICKSONX") == pytest.approx(0.8133, abs=1e-4)
    assert sim.jaro_winkler("a", "") == 0.0 and sim.jaro_winkler("", "") == 1.0
    got = spark.range(1).select(sim.gaussian_similarity(F.lit(1990), F.lit(1992), 0, 2).alias("g")).first()["g"]
    assert got == pytest.approx(0.5)


def people(spark):
    base = spark.range(300).select(
        "id", F.substring(F.md5((hash48("f", "id") % 23).cast("string").cast("binary")), 1, 7).alias("firstname"),
        F.substring(F.md5((hash48("l", "id") % 41 + 100).cast("string").cast("binary")), 1, 8).alias("lastname"),
        (1940 + hash48("y", "id") % 50).cast("int").alias("birthyear"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 10).alias("zipcode"))
    typo = hash48("typo", "id")
    other = base.withColumn("firstname", F.when(typo % 6 == 0, F.concat(F.lit("x"), "firstname")).otherwise(F.col("firstname")))
    return base, other.withColumn("birthyear", F.when(typo % 7 == 0, F.col("birthyear") + 1).otherwise(F.col("birthyear")))


SPECS = (ln.Comparison("firstname", "jaro_winkler"), ln.Comparison("lastname", "jaro_winkler"), ln.Comparison("birthyear", "gauss", cuts=(0.6, 0.99)))


def test_every_pair_of_a_block_is_compared(spark):
    a, b = people(spark)
    odd = spark.createDataFrame([(9001, "Quentin", "Zabriskie", 1700, 0)], "id bigint, firstname string, lastname string, birthyear int, zipcode bigint")
    a = a.select(*odd.columns).unionByName(odd).unionByName(a.limit(1).select(*odd.columns).withColumn("zipcode", F.lit(None).cast("bigint")))
    fields = ["firstname", "lastname", "birthyear"]
    pairs = ln.candidate_pairs(a, b, "id", ["zipcode"], fields)
    want = sorted((x["id"], y["id"]) for x, y in itertools.product(a.collect(), b.collect()) if x["zipcode"] == y["zipcode"])
    got = sorted((r["id_a"], r["id_b"]) for r in pairs.collect())
    assert got == want and any(x == 9001 for x, _ in got)  # this record differs from all others in every field
    assert ln.block_report(a, b, ["zipcode"]).agg(F.sum("n_pairs")).first()[0] == len(want)
    compared = ln.compare(pairs, SPECS)
    one = compared.filter("id_a = 9001").first()
    assert one["firstname_sim"] == pytest.approx(sim.jaro_winkler("Quentin", one["firstname_b"]))


def test_posterior_separates_matches(spark):
    a, b = people(spark)
    pairs, model = ln.probabilistic_pairs(a, b, "id", ["zipcode"], SPECS)
    assert all(m[-1] > u[-1] for m, u in zip(model.m, model.u)) and 0 < model.share < 0.2
    scored = pairs.withColumn("same", F.col("id_a") == F.col("id_b"))
    means = {r["same"]: r["p"] for r in scored.groupBy("same").agg(F.avg("posterior").alias("p")).collect()}
    assert means[True] > 0.8 > 0.3 > means[False]
    higher = scored.agg(F.corr("posterior", F.col("firstname_level") + F.col("lastname_level") + F.col("birthyear_level"))).first()[0]
    assert higher > 0.5
    curve = {r["threshold"]: r["n"] for r in ln.threshold_curve(pairs, "posterior").collect()}
    assert curve[0.5] == pairs.filter("posterior >= 0.5").count() and curve[0.0] == pairs.count()
    one_to_one = ln.mutual_best(pairs, "id", "posterior", 0.5)
    assert one_to_one.count() == one_to_one.select("id_a").distinct().count() == one_to_one.select("id_b").distinct().count()


def test_em_recovers_known_rates():
    rng = np.random.default_rng(1)
    match = rng.random(20000) < 0.1
    patterns = np.stack([np.where(match, rng.random(20000) < m, rng.random(20000) < u) for m, u in ((0.9, 0.1), (0.8, 0.05), (0.95, 0.2))], axis=1).astype(int)
    cells, counts = np.unique(patterns, axis=0, return_counts=True)
    model = ln.fit_patterns(cells, counts.astype(float), [2, 2, 2])
    assert model.share == pytest.approx(0.1, abs=0.02)
    assert model.m[0][1] == pytest.approx(0.9, abs=0.04) and model.u[2][1] == pytest.approx(0.2, abs=0.02)


def test_extrapolated_steps_reach_the_limit_of_plain_ones():
    """With one match in a thousand pairs plain steps creep; the fit must agree with very many of them."""
    rng = np.random.default_rng(5)
    patterns = np.array(list(itertools.product(range(3), repeat=3)))
    m, u = [[0.1, 0.2, 0.7], [0.2, 0.2, 0.6], [0.05, 0.15, 0.8]], [[0.8, 0.15, 0.05], [0.7, 0.2, 0.1], [0.6, 0.3, 0.1]]
    pm, pu = (np.prod([np.array(v[j])[patterns[:, j]] for j in range(3)], axis=0) for v in (m, u))
    counts = rng.multinomial(400_000, 0.001 * pm + 0.999 * pu).astype(float)

    def posteriors(model):
        a, b = model.share, 1 - model.share
        for j in range(3):
            a, b = a * np.array(model.m[j])[patterns[:, j]], b * np.array(model.u[j])[patterns[:, j]]
        return a / (a + b)

    fast = ln.fit_patterns(patterns, counts, [3, 3, 3])
    plain = ln.fit_patterns(patterns, counts, [3, 3, 3], tol=None, most=40_000)
    assert np.abs(posteriors(fast) - posteriors(plain)).max() < 1e-6
    short = ln.fit_patterns(patterns, counts, [3, 3, 3], tol=None, most=20)
    assert np.abs(posteriors(short) - posteriors(plain)).max() > 1e-3


def test_set_overlap_is_exact(spark):
    docs = spark.range(120).select("id", F.explode(F.sequence(F.lit(0), F.lit(14))).alias("k"))
    # A third of the entities hold one and the same set.
    item = F.when(F.col("id") % 3 == 0, F.col("k")).otherwise(hash48("item", F.floor(F.col("id") / 4), "k") % 40 + hash48("jitter", "id", "k") % 2)
    items = docs.select("id", item.cast("string").alias("item"))
    sets = {}
    for r in items.collect():
        sets.setdefault(r["id"], set()).add(r["item"])
    merged = {}
    for i in sorted(sets):
        merged.setdefault(frozenset(sets[i]), []).append(i)
    want = {}
    for (s, x), (u, y) in itertools.combinations(merged.items(), 2):
        j = len(s & u) / len(s | u)
        if j >= 0.4:
            want[tuple(sorted((x[0], y[0])))] = j
    got = {(r["id_a"], r["id_b"]): r["jaccard"] for r in textual.set_overlap(items, "id", "item", 0.4).collect()}
    assert got == pytest.approx(want) and len(want) > 5


def test_signatures_leave_few_candidates(spark):
    """No similar pair is lost, and most pairs that share a rare item but little else go before their sets are read."""
    rng = np.random.default_rng(2)
    sets = {}
    for i in range(300):
        topic = i % 10
        sets[i] = {f"t{topic}-{j}" for j in rng.choice(40, 8, replace=False)} | {f"c{j}" for j in rng.choice(400, 30, replace=False)}
    for i in range(300, 330):
        sets[i] = set(list(sorted(sets[i - 300]))[2:]) | {f"own{i}"}
    items = spark.createDataFrame([(i, x) for i, s in sets.items() for x in s], "id int, item string")
    prepared = textual._item_sets(items, "id", "item")
    pairs = lambda on: {tuple(r) for r in textual.overlap_candidates(prepared, 0.6, on).collect()}
    before, after = pairs(False), pairs(True)
    similar = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    assert similar <= after <= before and len(similar) >= 30
    assert len(after) - len(similar) <= 0.2 * (len(before) - len(similar))


def test_cells_of_clustered_vectors(spark):
    """Clusters meet in few pairs of rows, and every close pair meets in exactly one group."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(30, 24))
    x = centres[np.arange(900) % 30] + rng.normal(scale=0.05, size=(900, 24))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id int, v array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.95, 1)))}
    merged = textual.unit_vectors(df, "id", "v").withColumn("n", F.lit(1).cast("bigint")).select("__u", "id", "n")
    groups = {}
    for r in textual.vector_cells(merged, "id", 0.95, 900, 50).collect():
        groups.setdefault((r["cell"], r["i"], r["j"]), ([], []))[r["right"]].append(r["__k"])
    met = []
    for (_, i, j), (left, right) in groups.items():
        met += [(min(a, b), max(a, b)) for a in left for b in (left if i == j else right) if (a < b if i == j else True)]
    assert len(met) == len(set(met)) and close <= set(met)
    assert len(met) < 0.25 * 900 * 899 / 2
    got = {(r["id_a"], r["id_b"]) for r in textual.cosine_pairs(df, "id", "v", 0.95, rows_per_block=50).collect()}
    assert got == close


def test_cosine_pairs_find_their_pairs(spark):
    dims = [(0.2 + 3.0 / (d + 1)) * hash_normal("v", F.floor(F.col("id") / 3), F.lit(d)) + 0.2 * hash_normal("w", "id", F.lit(d)) for d in range(6)]
    df = spark.range(150).select("id", F.array(*dims).alias("v")).cache()
    rows = [(r["id"], np.array(r["v"])) for r in df.collect()]
    want = {(a, b) for (a, x), (b, y) in itertools.combinations(rows, 2) if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.97}
    got = {(r["id_a"], r["id_b"]) for r in textual.cosine_pairs(df, "id", "v", 0.97).collect()}
    assert got == want and len(want) > 5


def test_near_vectors_meet_few_others(spark):
    """Candidates stay far below all pairs, and pairs just at the threshold are found at the stated rate."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.normal(size=(500, 64))
    other -= (other * x[:500]).sum(axis=1, keepdims=True) * x[:500]
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    x = np.vstack([x, 0.901 * x[:500] + math.sqrt(1 - 0.901**2) * other])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>")
    got = {(r["id_a"], r["id_b"]) for r in textual.cosine_pairs(df, "id", "v", 0.9, recall=0.999).collect()}
    close = np.triu(x @ x.T >= 0.9, 1)
    want = set(zip(*(a.tolist() for a in np.nonzero(close))))
    assert got <= want and len(want - got) <= 3 and len(want) >= 500
    bands = textual._bands(df, "v", 11, 40, 11).groupBy("table", "band").count()
    met = bands.agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    assert met < 0.05 * 40 * 2000 * 1999 / 2


def test_cosine_pairs_lose_no_pair(spark):
    """Thousands of pairs just above and just below the threshold, in one block and in several."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(12_000, 8))
    x[1], x[3] = x[0], x[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>")
    close = np.triu(x @ x.T, 1) >= 0.9
    want = {(a, b) for a, b in zip(*(a.tolist() for a in np.nonzero(close))) if a not in (1, 3) and b not in (1, 3)}
    assert len(want) > 30_000
    for rows in (16_384, 1_500):
        found = textual.cosine_pairs(df, "id", "v", 0.9, rows_per_block=rows).collect()
        assert len(found) == len(want) and {(r["id_a"], r["id_b"]) for r in found} == want
        assert all(r["n_a"] == (3 if r["id_a"] == 0 else 1) and r["n_b"] == 1 for r in found)
    assert textual.cosine_pairs(df.limit(0), "id", "v", 0.9).count() == 0


def test_every_document_has_a_topic_row(spark):
    docs = spark.range(40).withColumnRenamed("id", "k")
    vectors = spark.range(30).select(F.col("id").alias("k"), F.array(F.col("id") % 3 * 1.0, F.col("id") % 2 * 1.0).alias("e"))
    rows = textual.embedding_topics(docs, vectors, "k", "e", 3).collect()
    assert len(rows) == 40 and all((r["topic"] is None) == (r["k"] >= 30) for r in rows)


def test_topic_vocabulary_has_no_limit(spark):
    """Every term has its row in the matrix, also the rarest."""
    words = spark.range(270_000).select((F.col("id") % 3000).alias("d"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij").alias("w"))
    docs = words.groupBy("d").agg(F.concat_ws(" ", F.collect_list(F.concat(F.lit("zz"), "w"))).alias("t"))
    model = textual.topic_model(docs, "d", "t", k=2, min_df=1, iterations=1)
    assert model.weights.count() == 270_000


def test_terms(spark):
    df = spark.createDataFrame([(1, "The Cat, the été c4t cat"), (2, "cat_a dog"), (3, "dog")], "d int, t string")
    counts = {(r["d"], r["term"]): r["n"] for r in textual.dtm(df, "d", "t", ["the"], min_df=1).collect()}
    assert counts == {(1, "cat"): 2, (2, "dog"): 1, (3, "dog"): 1}
    weights = {(r["d"], r["term"]): r["tfidf"] for r in textual.tfidf(textual.dtm(df, "d", "t", ["the"], 1), "d", 3).collect()}
    assert weights[(1, "cat")] == pytest.approx(2 * math.log(3)) and weights[(2, "dog")] == pytest.approx(math.log(1.5))


def test_record_validation(spark):
    good = '{"event_type":"protest","date_is_approximate":false,"geo_precision":"unknown","actors":[],"extraction_confidence":0.4,"uncertainty_flags":[],"evidence":[]}'
    bad = [good.replace("protest", "riot"), good.replace("0.4", "1.4"), good[:30], good.replace('"actors":[],', ""), good.replace("0.4", '"high"')]
    df = spark.createDataFrame(list(enumerate([good, *bad])), "i int, j string")
    parsed = {r["i"]: r["errors"] for r in review.parse_records(df, "j").collect()}
    assert parsed[0] == [] and parsed[1] == ["event_type"] and parsed[2] == ["extraction_confidence"]
    assert "json" in parsed[3] and parsed[4] == ["missing actors"] and parsed[5]
    flags = review.review_flags(review.valid_records(review.parse_records(df, "j"))).first()
    assert flags["flag_low_confidence"] and flags["flag_missing_country"] and flags["needs_human_review"]


def test_report_counts_missing_predictions(spark):
    gold = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k int, g string")
    pred = spark.createDataFrame([(1, "a"), (3, "a")], "k int, p string")
    rows = {r["class"]: r for r in review.evaluate_against_gold(gold, pred, "k", "g", "p").collect()}
    assert rows["a"]["precision"] == 0.5 and rows["a"]["recall"] == 0.5 and rows["b"]["f1"] == 0.0
    assert rows["(none)"]["support"] == 0 and rows["(none)"]["predicted"] == 1
