"""Text and models over documents and embeddings (inventory J1 to J17, F3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions import text
from civicframe.functions.hashing import hash48, sql_hash48
from civicframe.operators import graph as gr
from civicframe.operators import models
from civicframe.operators import relational as rel
from civicframe.operators import textual as tx
from civicframe.plans.registry import query
from civicframe.session import materialise, spread




def stop_sql() -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in STOP)


# A short English stop list, a parameter of the term tables.
STOP = ("a an and are as at be but by for from had has have he her his i in is it its not of on or she "
        "that the their they this to was we were which will with you").split()

TERMS = f"""occ AS (SELECT doc_id, term FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS term FROM documents)
WHERE regexp_matches(term, '^[a-z]{{2,}}$') AND term NOT IN ({stop_sql()})),
counts AS (SELECT doc_id, term, COUNT(*) AS n FROM occ GROUP BY 1, 2), dfs AS (SELECT term, COUNT(*) AS df FROM counts GROUP BY 1 HAVING COUNT(*) >= 2),
dtm AS (SELECT doc_id, term, n, df FROM counts JOIN dfs USING (term))"""


def counts(t, with_df=False):
    return tx.dtm(t.documents, "doc_id", "text", STOP, 2, with_df=with_df)


@query("j1_tokenise", "SELECT doc_id, len(l) AS n_tokens, md5(array_to_string(l, ' ')) AS digest FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS l FROM documents)")
def _(t):
    tokens = text.tokens(F.col("text"))
    return t.documents.select("doc_id", F.size(tokens).cast("bigint").alias("n_tokens"), F.md5(F.array_join(tokens, " ").cast("binary")).alias("digest"))


@query("j2_document_term_counts", f"WITH {TERMS} SELECT doc_id, term, n FROM dtm")
def _(t):
    return counts(t).select("doc_id", "term", "n")


@query("j3_top_terms", f"WITH {TERMS} SELECT term, SUM(n)::BIGINT AS n FROM dtm GROUP BY term ORDER BY n DESC, term LIMIT 15")
def _(t):
    return tx.top_terms(counts(t), 15)


@query("j4_tfidf", f"WITH {TERMS} SELECT doc_id, term, ROUND(n * LN((SELECT COUNT(*) FROM documents) * 1.0 / df), 9) AS tfidf FROM dtm")
def _(t):
    out = tx.tfidf(materialise(counts(t, with_df=True)), "doc_id", t.documents.count())
    return out.select("doc_id", "term", F.round("tfidf", 9).alias("tfidf"))


def topic_model(t, k=6, min_df=2, seed=123, counts=None):
    return tx.topic_model(t.documents, "doc_id", "text", k=k, min_df=min_df, seed=seed, counts=counts)


@query("j6_topic_words")
def _(t):
    return topic_model(t).topics(10)


@query("j7_dominant_topics")
def _(t):
    return topic_model(t).documents()


@query("j7_topic_counts")
def _(t):
    return topic_model(t).documents().groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.avg("probability").alias("mean_probability"))


def document_vectors(t, size=100):
    rows = t.documents.select("doc_id", "text", F.log("n_chars").alias("y"))
    return tx.word_vectors(rows, "doc_id", text.tokens(F.col("text")), size=size)


@query("j8_word_vectors")
def _(t):
    words, _docs = document_vectors(t)
    return words.select("word", "vector")


@query("j9_mean_vectors", "SELECT label, CAST(i - 1 AS INT) AS dim, ROUND(AVG(embedding[i]::DOUBLE), 9) AS x FROM embeddings, range(1, 65) AS g(i) GROUP BY 1, 2")
def _(t):
    return tx.mean_vector(t.embeddings, ["label"], "embedding").withColumn("x", F.round("x", 9))


@query("j9_document_vectors")
def _(t):
    _words, docs = document_vectors(t)
    return docs.select("doc_id", "vector")


@query("j10_ridge_on_vectors")
def _(t):
    _words, docs = document_vectors(t)
    rows = rel.random_split(docs.select("doc_id", "vector", "y"), "doc_id", {"train": 0.75, "test": 0.25}, "ridge")
    return models.ridge_evaluation(rows, "y", "vector", "split", alpha=1.0)


def embedding_topics(t):
    docs = t.documents.select("doc_id", "text")
    vectors = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")
    return tx.embedding_topics(docs, vectors, "doc_id", "embedding", 6)


@query("j11_embedding_topics")
def _(t):
    return embedding_topics(t)


@query("j11_topic_table")
def _(t):
    return tx.topic_table(embedding_topics(t), materialise(counts(t)), "doc_id", 10)


@query("j12_class_similarity", """WITH m AS (SELECT label AS class, list(x ORDER BY i) AS mean FROM (SELECT label, i, AVG(embedding[i]::DOUBLE) AS x FROM embeddings, range(1, 65) AS g(i) GROUP BY 1, 2) GROUP BY 1)
SELECT vec_id, label, class, ROUND(list_cosine_similarity(embedding::DOUBLE[], mean), 9) AS similarity FROM embeddings, m""")
def _(t):
    return tx.class_similarity(t.embeddings, "vec_id", "embedding", "label").withColumn("similarity", F.round("similarity", 9))


# Each vector, and for a fifth of them a copy with one changed coordinate.
COPIES = f"""v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings UNION ALL SELECT 1000000 + vec_id, list_concat([embedding[1]::DOUBLE + 0.1], embedding[2:]::DOUBLE[]) FROM embeddings WHERE {sql_hash48('copy', 'vec_id')} % 5 = 0)"""


@query("j12_near_vectors", f"WITH {COPIES} SELECT a.vec_id AS vec_id_a, b.vec_id AS vec_id_b, CAST(1 AS BIGINT) AS n_a, CAST(1 AS BIGINT) AS n_b, ROUND(list_cosine_similarity(a.e, b.e), 9) AS cosine FROM v a, v b WHERE a.vec_id < b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9")
def _(t):
    e = F.col("embedding").cast("array<double>")
    base = t.embeddings.select("vec_id", e.alias("e"))
    changed = F.concat(F.array(e[0] + 0.1), F.slice(e, 2, 63))
    copies = t.embeddings.filter(hash48("copy", "vec_id") % 5 == 0).select((F.col("vec_id") + 1000000).alias("vec_id"), changed.alias("e"))
    return tx.cosine_pairs(base.unionByName(copies), "vec_id", "e", 0.9).withColumn("cosine", F.round("cosine", 9))


@query("j13_variant_stability")
def _(t):
    """Topics under another vocabulary and another seed, each compared with the first by the adjusted Rand index."""
    counts = tx.topic_counts(t.documents, "doc_id", "text")
    first = materialise(topic_model(t, counts=counts).documents().select("doc_id", F.col("topic").alias("a")))
    out = None
    for variant, model in (("min_df 5", topic_model(t, min_df=5, counts=counts)), ("seed 321", topic_model(t, seed=321, counts=counts))):
        other = model.documents().select("doc_id", F.col("topic").alias("b"))
        row = gr.adjusted_rand(first.join(other, "doc_id"), "a", "b").withColumn("variant", F.lit(variant))
        out = row if out is None else out.unionByName(row)
    return out


@query("j14_logistic_regression")
def _(t):
    rows = t.embeddings.withColumn("high", (F.col("label") >= 5).cast("int"))
    split = rel.random_split(rows, "vec_id", {"train": 0.6, "val": 0.2, "test": 0.2}, "nodes")
    return models.logistic_accuracy(split, "embedding", "high", "split")


@query("j16_model_families")
def _(t):
    rows = t.lineitem.select(
        (F.col("l_extendedprice") / 1000).alias("price"), "l_quantity", "l_discount", "l_tax", F.col("l_linenumber").cast("double").alias("line"),
        F.month("l_shipdate").cast("double").alias("month"), "l_shipdate")
    split = rows.withColumn("split", F.when(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz"), "train").otherwise("test"))
    return models.compare_families(split, "price", ["l_quantity", "l_discount", "l_tax", "line", "month"], "split")


@query("j17_item_overlap", """WITH i AS (SELECT DISTINCT doc_id AS id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS item FROM documents),
s AS (SELECT id, list(item ORDER BY item) AS l FROM i GROUP BY id), g AS (SELECT MIN(id) AS id, COUNT(*) AS n, l FROM s GROUP BY l),
r AS (SELECT id, unnest(l) AS item FROM g),
p AS (SELECT a.id AS id_a, b.id AS id_b, COUNT(*) AS shared FROM r a JOIN r b ON a.item = b.item AND a.id < b.id GROUP BY 1, 2)
SELECT id_a, id_b, ga.n AS n_a, gb.n AS n_b, shared, ROUND(shared / (len(ga.l) + len(gb.l) - shared), 9) AS jaccard FROM p JOIN g ga ON ga.id = id_a JOIN g gb ON gb.id = id_b
WHERE shared / (len(ga.l) + len(gb.l) - shared) >= 0.5""")
def _(t):
    items = spread(t.documents.select("doc_id", "text")).select("doc_id", F.explode(text.tokens(F.col("text"))).alias("item"))
    return tx.set_overlap(items, "doc_id", "item", 0.5).withColumn("jaccard", F.round("jaccard", 9))
