"""Networks (inventory L1 to L13, J14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions.hashing import hash48, sql_hash48
from civicframe.operators import graph as gr
from civicframe.operators import relational as rel
from civicframe.operators import review, scalable
from civicframe.plans.registry import query
from civicframe.session import materialise

# Customers (even numbers) and suppliers (odd numbers), linked by all order lines.
LINKS = """links AS (SELECT o_custkey * 2 AS c, l_suppkey * 2 + 1 AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
GRAPH = LINKS + """, e AS (SELECT DISTINCT least(c, s) AS a, greatest(c, s) AS b FROM links),
edges AS (SELECT a AS src, b AS dst FROM e UNION ALL SELECT b, a FROM e),
nodes AS (SELECT c_custkey * 2 AS id FROM customer UNION ALL SELECT s_suppkey * 2 + 1 FROM supplier),
deg AS (SELECT id, COUNT(src) AS d FROM nodes LEFT JOIN edges ON src = id GROUP BY id)"""


def trade_graph(t):
    links = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("o_custkey") * 2).alias("c"), (F.col("l_suppkey") * 2 + 1).alias("s"))
    nodes = t.customer.select((F.col("c_custkey") * 2).alias("id")).unionByName(t.supplier.select((F.col("s_suppkey") * 2 + 1).alias("id")))
    return gr.build_graph(links, "c", "s", vertices=nodes)


@query("l1_edge_list", f"WITH {GRAPH} SELECT a AS src, b AS dst FROM e")
def _(t):
    return gr.edge_list(trade_graph(t)).select("src", "dst")


@query("l1_directed_weighted", "SELECT o_custkey * 2 AS src, l_suppkey * 2 + 1 AS dst, ROUND(SUM(l_quantity), 2) AS w FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2")
def _(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("o_custkey") * 2).alias("c"), (F.col("l_suppkey") * 2 + 1).alias("s"), "l_quantity")
    g = gr.build_graph(rows, "c", "s", weight="l_quantity", directed=True)
    return g.edges.withColumn("w", F.round("w", 2))


@query("l2_graph_summary", f"WITH {GRAPH} SELECT n AS n_nodes, CAST(m / 2 AS BIGINT) AS n_edges, ROUND(m / (n * (n - 1.0)), 12) AS density, m AS nnz FROM (SELECT COUNT(*) AS n FROM nodes), (SELECT COUNT(*) AS m FROM edges)")
def _(t):
    return gr.summary(trade_graph(t)).withColumn("density", F.round("density", 12))


@query("l3_degrees", f"WITH {GRAPH} SELECT id, d AS degree FROM deg")
def _(t):
    return gr.degrees(trade_graph(t)).select("id", "degree")


@query("l3_degree_distribution", f"WITH {GRAPH} SELECT d AS degree, COUNT(*) AS n FROM deg GROUP BY d")
def _(t):
    return gr.degree_distribution(trade_graph(t))


def betweenness_sql(k: int, depth: int) -> str:
    """Breadth-first levels with path counts, then dependencies level by level; depth exceeds any distance in the graph."""
    out = [f"WITH {GRAPH}, links2 AS MATERIALIZED (SELECT * FROM edges), l0 AS MATERIALIZED (SELECT id AS s, id AS v, 1.0::DOUBLE AS sigma FROM nodes ORDER BY {sql_hash48('betweenness', 'id')}, id LIMIT {k})"]
    for d in range(depth):
        known = f"SELECT s, v FROM l{d}" + (f" UNION ALL SELECT s, v FROM l{d - 1}" if d else "")
        out.append(f"l{d + 1} AS MATERIALIZED (SELECT n.* FROM (SELECT s, dst AS v, SUM(sigma) AS sigma FROM l{d} JOIN links2 ON src = v GROUP BY 1, 2) AS n ANTI JOIN ({known}) AS o USING (s, v))")
    out.append(f"b{depth} AS (SELECT *, 0.0::DOUBLE AS delta FROM l{depth})")
    for d in range(depth, 0, -1):
        out.append(f"b{d - 1} AS MATERIALIZED (SELECT e.s, e.v, sigma, sigma * COALESCE(share, 0) AS delta FROM l{d - 1} AS e LEFT JOIN "
                   f"(SELECT s, src AS v, SUM((1 + delta) / sigma) AS share FROM b{d} JOIN links2 ON dst = v GROUP BY 1, 2) AS o USING (s, v))")
    every = " UNION ALL ".join(f"SELECT v, delta FROM b{d} WHERE s <> v" for d in range(1, depth + 1))
    return ", ".join(out) + f""", t AS (SELECT v AS id, SUM(delta) AS delta FROM ({every}) GROUP BY v), c AS (SELECT COUNT(*) AS n, (SELECT COUNT(*) FROM l0) AS k FROM nodes)
SELECT id, ROUND(COALESCE(delta, 0) * (n::DOUBLE / k / ((n - 1.0) * (n - 2.0))), 9) AS betweenness FROM nodes LEFT JOIN t USING (id), c"""


@query("l4_betweenness", betweenness_sql(200, 8))
def _(t):
    return gr.betweenness(trade_graph(t), k=200).withColumn("betweenness", F.round("betweenness", 9))


# Steps after which both measures have settled on graphs like this one; a test compares them with exact solutions.
STEPS = 32


def eigen_sql(steps):
    out = [f"WITH {GRAPH}, links2 AS MATERIALIZED (SELECT * FROM edges), shift AS MATERIALIZED (SELECT SUM(CAST(d AS DOUBLE) * d) / SUM(d) / 2 AS s FROM deg), x0 AS (SELECT id, 1.0::DOUBLE / SQRT(COUNT(*) OVER ()) AS x FROM nodes)"]
    for i in range(steps):
        out.append(f"y{i} AS (SELECT a.id, MAX(s) * MAX(a.x) + COALESCE(SUM(b.x), 0) AS y FROM x{i} a CROSS JOIN shift LEFT JOIN links2 ON dst = a.id LEFT JOIN x{i} b ON b.id = src GROUP BY a.id), "
                   f"x{i + 1} AS MATERIALIZED (SELECT id, y / SQRT(SUM(y * y) OVER ()) AS x FROM y{i})")
    return ", ".join(out) + f" SELECT id, ROUND(x, 9) AS centrality FROM x{steps}"


@query("l5_eigenvector", eigen_sql(STEPS))
def _(t):
    return gr.eigenvector(trade_graph(t).staged(), iterations=STEPS).withColumn("centrality", F.round("centrality", 9))


def pagerank_sql(steps):
    out = [f"WITH {GRAPH}, links2 AS MATERIALIZED (SELECT src, dst, d FROM edges JOIN deg ON id = src), r0 AS (SELECT id, COUNT(*) OVER () AS n, 1.0::DOUBLE / COUNT(*) OVER () AS r FROM nodes)"]
    for i in range(steps):
        out.append(f"r{i + 1} AS MATERIALIZED (SELECT a.id, MAX(a.n) AS n, MAX(a.r) + 0.75::DOUBLE * ((1 - 0.85::DOUBLE) / MAX(a.n) + 0.85::DOUBLE * COALESCE(SUM(b.r / d), 0) - MAX(a.r)) AS r "
                   f"FROM r{i} a LEFT JOIN links2 ON dst = a.id LEFT JOIN r{i} b ON b.id = src GROUP BY a.id)")
    return ", ".join(out) + f" SELECT id, ROUND(r / SUM(r) OVER (), 9) AS rank FROM r{steps}"


@query("l6_pagerank", pagerank_sql(STEPS))
def _(t):
    return gr.pagerank(trade_graph(t).staged(), iterations=STEPS).withColumn("rank", F.round("rank", 9))


@query("f4_top_nodes_per_measure", f"WITH {GRAPH}, m AS (SELECT 'degree' AS measure, id, CAST(d AS DOUBLE) AS v FROM deg UNION ALL SELECT 'mean_neighbour_degree', src, ROUND(AVG(d), 6) FROM edges JOIN deg ON id = dst GROUP BY src) SELECT measure, id, v AS value, CAST(r AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY measure ORDER BY v DESC, id) AS r FROM m) WHERE r <= 10")
def _(t):
    g = trade_graph(t)
    deg = gr.degrees(g).select("id", F.col("degree").cast("double").alias("value"))
    near = g.edges.join(deg.withColumnRenamed("id", "dst"), "dst").groupBy(F.col("src").alias("id")).agg(F.round(F.avg("value"), 6).alias("value"))
    rows = deg.withColumn("measure", F.lit("degree")).unionByName(near.withColumn("measure", F.lit("mean_neighbour_degree")))
    return rel.top_k_per_group(rows, ["measure"], [F.desc("value"), F.asc("id")], 10)


@query("l7_communities")
def _(t):
    return gr.communities(trade_graph(t))


@query("l8_labels_and_sizes", "SELECT CAST(c_custkey AS BIGINT) AS id, CAST(dense_rank - 1 AS INT) AS label, size FROM customer JOIN (SELECT c_nationkey, COUNT(*) AS size, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, c_nationkey) AS dense_rank FROM customer GROUP BY 1) USING (c_nationkey)")
def _(t):
    labels = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("community"))
    return gr.dense_labels(labels).join(gr.community_sizes(labels), "community").select("id", "label", "size")


ARI_SQL = """WITH c AS (SELECT a, b, COUNT(*) AS n FROM ({src}) GROUP BY 1, 2), s AS (SELECT SUM(n * (n - 1) / 2.0) AS same, SUM(n) AS total FROM c),
x AS (SELECT SUM(n * (n - 1) / 2.0) AS sa FROM (SELECT SUM(n) AS n FROM c GROUP BY a)), y AS (SELECT SUM(n * (n - 1) / 2.0) AS sb FROM (SELECT SUM(n) AS n FROM c GROUP BY b))
SELECT CAST(total AS BIGINT) AS n, ROUND((same - sa * sb / (total * (total - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (total * (total - 1) / 2)), 9) AS ari FROM s, x, y"""


@query("l9_adjusted_rand", ARI_SQL.format(src="SELECT label AS a, list_position(embedding, list_max(embedding)) % 10 AS b FROM embeddings"))
def _(t):
    rows = t.embeddings.select("label", (F.array_position("embedding", F.array_max("embedding")) % 10).alias("dim"))
    return gr.adjusted_rand(rows, "label", "dim").withColumn("ari", F.round("ari", 9))


ADJ = GRAPH + """, known AS MATERIALIZED (SELECT id, d FROM deg), full_e AS MATERIALIZED (SELECT src, dst FROM edges UNION ALL SELECT id, id FROM nodes),
adj AS MATERIALIZED (SELECT src, dst, 1.0 / SQRT((x.d + 1.0) * (y.d + 1.0)) AS w FROM full_e JOIN known x ON x.id = src JOIN known y ON y.id = dst)"""


@query("l10_normalised_adjacency", f"WITH {ADJ} SELECT src, dst, ROUND(w, 9) AS w FROM adj")
def _(t):
    return gr.normalised_adjacency(trade_graph(t)).withColumn("w", F.round("w", 9))


FEAT = f"""feat AS (SELECT id, CAST(dim AS INT) AS dim, CAST({sql_hash48('feat', 'id', 'dim')} % 1000 AS DOUBLE) / 1000.0 AS x FROM nodes, range(4) AS g(dim))"""


def node_features(g):
    spread = g.vertices.withColumn("dim", F.explode(F.sequence(F.lit(0), F.lit(3))))
    return spread.withColumn("x", (hash48("feat", "id", "dim") % 1000).cast("double") / 1000.0)


@query("l11_feature_propagation", f"""WITH {ADJ}, {FEAT}, h1 AS (SELECT dst AS id, dim, SUM(w * x) AS x FROM adj JOIN feat ON feat.id = src GROUP BY 1, 2), h2 AS (SELECT dst AS id, dim, SUM(w * x) AS x FROM adj JOIN h1 ON h1.id = src GROUP BY 1, 2)
SELECT id, dim, ROUND(x, 9) AS x FROM h2""")
def _(t):
    g = trade_graph(t).staged()
    return gr.propagate(g, node_features(g), 2).withColumn("x", F.round("x", 9))


@query("l11_propagated_classifier")
def _(t):
    """Logistic regression on features averaged over two hops; the class is the kind of vertex."""
    from civicframe.operators import models

    g = trade_graph(t).staged()
    # Written once: the split and the training read the vectors many times.
    wide = materialise(gr.feature_vectors(gr.propagate(g, node_features(g), 2), [0, 1, 2, 3]))
    rows = rel.random_split(wide.withColumn("label", (F.col("id") % 2).cast("int")), "id", {"train": 0.6, "val": 0.2, "test": 0.2}, "nodes")
    return models.logistic_accuracy(rows, "features", "label", "split")


@query("l12_model_comparison", f"""WITH p AS (SELECT doc_id, quality, CASE WHEN {sql_hash48('model', 'doc_id')} % 4 = 0 THEN 1 - quality ELSE quality END AS pred FROM labels)
SELECT quality AS "true", COUNT(*) FILTER (WHERE pred = 0) AS "0", COUNT(*) FILTER (WHERE pred = 1) AS "1" FROM p GROUP BY quality""")
def _(t):
    pred = F.when(hash48("model", "doc_id") % 4 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    return rel.crosstab(t.labels.withColumn("pred", pred), "quality", "pred", [0, 1]).withColumnRenamed("quality", "true")


@query("l12_model_scores", f"""WITH p AS (SELECT m, quality, CASE WHEN {sql_hash48('model', 'm', 'doc_id')} % m = 0 THEN 1 - quality ELSE quality END AS pred FROM labels, (SELECT unnest([3, 4, 8]) AS m))
SELECT CAST(m AS INT) AS m, ROUND(AVG((quality = pred)::INT), 9) AS accuracy, COUNT(*) AS n FROM p GROUP BY m""")
def _(t):
    spread = t.labels.withColumn("m", F.explode(F.array(F.lit(3), F.lit(4), F.lit(8))))
    miss = hash48("model", "m", "doc_id") % F.col("m") == 0
    rows = spread.withColumn("pred", F.when(miss, 1 - F.col("quality")).otherwise(F.col("quality")))
    report = review.classification_report(review.confusion(rows, "quality", "pred", ["m"]), ["m"])
    return review.overall_scores(report, ["m"]).select("m", F.round("accuracy", 9).alias("accuracy"), "n")


EXPOSED = f"""WITH {GRAPH}, ev AS (SELECT o_custkey * 2 AS node, CAST(year(o_orderdate) AS INT) AS yr, COUNT(*) AS v FROM orders GROUP BY 1, 2)"""


@query("l13_network_exposure", EXPOSED + " SELECT src AS id, yr + 1 AS t, CAST(SUM(v) AS DOUBLE) AS exposure FROM edges JOIN ev ON node = dst GROUP BY 1, 2")
def _(t):
    return gr.exposure(trade_graph(t), orders_by_year(t), "node", "t", "v")


def orders_by_year(t):
    return t.orders.groupBy((F.col("o_custkey") * 2).alias("node"), F.year("o_orderdate").alias("t")).agg(F.count(F.lit(1)).alias("v"))


# People are the customers; two are linked when they bought from the same supplier in the same month.
PEERS = """peers AS (SELECT DISTINCT o_custkey AS id, l_suppkey AS s, year(o_orderdate) * 100 + month(o_orderdate) AS m FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
edges AS (SELECT DISTINCT a.id AS src, b.id AS dst FROM peers a JOIN peers b ON a.s = b.s AND a.m = b.m AND a.id <> b.id)"""


@query("l13_hazard_by_exposure", f"""WITH {PEERS}, ev AS (SELECT o_custkey AS node, CAST(year(o_orderdate) AS INT) AS yr, COUNT(*) AS v FROM orders WHERE o_totalprice > 400000 GROUP BY 1, 2),
x AS (SELECT src AS id, yr + 1 AS t, SUM(v) AS exposure FROM edges JOIN ev ON node = dst GROUP BY 1, 2)
SELECT exposure > 3 AS high, COUNT(*) AS n, ROUND(AVG((v IS NOT NULL)::INT), 9) AS hazard FROM x LEFT JOIN ev ON node = id AND yr = t GROUP BY 1""")
def _(t):
    """The event is a year with an order above 400,000; all customers and orders take part."""
    peers = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("id"), F.col("l_suppkey").alias("s"), (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("m")).distinct()
    pairs = scalable.salted_join(peers, peers.withColumnRenamed("id", "other"), ["s", "m"]).filter(F.col("id") < F.col("other"))
    g = gr.build_graph(pairs, "id", "other")
    events = t.orders.filter("o_totalprice > 400000").groupBy(F.col("o_custkey").alias("node"), F.year("o_orderdate").alias("t")).agg(F.count(F.lit(1)).alias("v"))
    out = gr.hazard_by_exposure(gr.exposure(g, events, "node", "t", "v"), events, "node", "t", "v", 3)
    return out.withColumn("hazard", F.round("hazard", 9))
