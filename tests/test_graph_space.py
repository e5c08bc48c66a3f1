"""Graphs and places against brute force."""

from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicframe.functions.hashing import hash48
from civicframe.operators import graph as gr
from civicframe.operators import spatial as sp

EDGES = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (6, 4), (7, 8)]


@pytest.fixture(scope="module")
def graph(spark):
    pairs = spark.createDataFrame([*EDGES, (2, 1), (5, 5)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in range(1, 10)], "id long")
    return gr.build_graph(pairs, "a", "b", vertices=nodes)


def exact_betweenness(n_nodes, edges):
    near = {v: set() for v in range(1, n_nodes + 1)}
    for a, b in edges:
        near[a].add(b), near[b].add(a)
    total = dict.fromkeys(near, 0.0)
    for s in near:
        dist, sigma, order, before = {s: 0}, {v: 0.0 for v in near}, [], {v: [] for v in near}
        sigma[s], queue = 1.0, deque([s])
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in near[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    queue.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    before[w].append(v)
        delta = dict.fromkeys(near, 0.0)
        for w in reversed(order):
            for v in before[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                total[w] += delta[w]
    return {v: x / ((n_nodes - 1) * (n_nodes - 2)) for v, x in total.items()}


def test_summary_and_degrees(graph):
    s = gr.summary(graph).first()
    assert (s["n_nodes"], s["n_edges"], s["nnz"]) == (9, 8, 16)
    assert s["density"] == pytest.approx(16 / 72)
    deg = {r["id"]: r["degree"] for r in gr.degrees(graph).collect()}
    assert deg[3] == 3 and deg[9] == 0


def test_betweenness_is_exact_with_all_sources(graph):
    got = {r["id"]: r["betweenness"] for r in gr.betweenness(graph, k=50).collect()}
    assert got == pytest.approx(exact_betweenness(9, EDGES))


def test_hubs_are_split_and_links_stay_where_they_are(spark):
    """With rows of a few links only, sums equal those of plain edges; a step exchanges values, never links."""
    rng = np.random.default_rng(6)
    pairs = {(int(a), int(b)) for a, b in rng.integers(0, 60, (300, 2)) if a != b} | {(0, i) for i in range(1, 60)}
    g = gr.build_graph(spark.createDataFrame(sorted(pairs), "a long, b long"), "a", "b").staged()
    x = g.vertices.withColumn("x", F.col("id") * 0.5 + 1)
    plain = {r["id"]: r["s"] for r in g.edges.join(x, F.col("src") == F.col("id")).groupBy(
        F.col("dst").alias("id")).agg(F.sum("x").alias("s")).collect()}
    for room in (4_096, 7):
        with gr.packed_links(g.edges, room) as links:
            assert (links.far is None) == (room > 60)
            assert {r["id"]: r["pulled"] for r in links.pulled(x).collect()} == pytest.approx(plain)
            if links.far is None:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
                try:
                    plan = links.pulled(links.pulled(x).select("id", F.col("pulled").alias("x")))._jdf.queryExecution().executedPlan().toString()
                finally:
                    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
                exchanged = [line for line in plan.splitlines() if "Exchange" in line and "links" in line]
                assert "Bucketed: true" in plan and not exchanged
                # the starting values and each step's partial sums
                assert plan.count("Exchange hashpartitioning") == 3


@pytest.mark.parametrize("directed", [False, True])
def test_betweenness_in_blocks_of_sources(spark, directed):
    """The blocks of sources, and how hubs are split, change nothing."""
    pairs = [*EDGES, (6, 7), (8, 9), (9, 1), (2, 6)]
    nodes = spark.createDataFrame([(i,) for i in range(1, 10)], "id long")
    g = gr.build_graph(spark.createDataFrame(pairs, "a long, b long"), "a", "b", vertices=nodes, directed=directed)
    whole = {r["id"]: r["betweenness"] for r in gr.betweenness(g, k=50).collect()}
    blocks = {r["id"]: r["betweenness"] for r in gr.betweenness(g, k=50, sources_per_row=2).collect()}
    assert whole == pytest.approx(blocks)
    if not directed:
        assert whole == pytest.approx(exact_betweenness(9, pairs))
    else:
        assert whole == pytest.approx(directed_betweenness(9, pairs))


def directed_betweenness(n_nodes, edges):
    """By counting, for each pair, the shortest paths through each vertex."""
    far = float("inf")
    dist = {(a, b): (0 if a == b else far) for a in range(1, n_nodes + 1) for b in range(1, n_nodes + 1)}
    ways = {k: float(k[0] == k[1]) for k in dist}
    for s in range(1, n_nodes + 1):
        queue = deque([s])
        while queue:
            v = queue.popleft()
            for a, w in edges:
                if a == v:
                    if dist[s, w] == far:
                        dist[s, w] = dist[s, v] + 1
                        queue.append(w)
                    if dist[s, w] == dist[s, v] + 1:
                        ways[s, w] += ways[s, v]
    total = dict.fromkeys(range(1, n_nodes + 1), 0.0)
    for (s, t), d in dist.items():
        for v in total:
            if s != t and v not in (s, t) and d < far and dist[s, v] + dist[v, t] == d:
                total[v] += ways[s, v] * ways[v, t] / ways[s, t]
    return {v: x / ((n_nodes - 1) * (n_nodes - 2)) for v, x in total.items()}


def test_pagerank_and_eigenvector(graph):
    ranks = {r["id"]: r["rank"] for r in gr.pagerank(graph).collect()}
    assert sum(ranks.values()) == pytest.approx(1.0)
    assert ranks[3] > ranks[1] > ranks[9]
    x = {r["id"]: r["centrality"] for r in gr.eigenvector(graph).collect()}
    assert x[3] == pytest.approx(x[4], rel=1e-3) and x[3] > x[1] > x[9]


@pytest.mark.parametrize("fixed", [False, True])
def test_centralities_reach_their_limit(spark, fixed):
    """On the whole trade graph of sf0.001, two-sided and with isolates, against dense solutions."""
    from civicframe.plans import networks
    from civicframe.sources.tables import Tables

    g = networks.trade_graph(Tables(spark, "/root/testdata/sf0.001")).staged()
    ids = sorted(r["id"] for r in g.vertices.collect())
    at = {v: i for i, v in enumerate(ids)}
    a = np.zeros((len(ids), len(ids)))
    for r in g.edges.collect():
        a[at[r["src"]], at[r["dst"]]] = r["w"]
    steps = networks.STEPS if fixed else None
    out = a.sum(axis=1)
    walk = np.divide(a, out[:, None], out=np.full_like(a, 1 / len(ids)), where=out[:, None] > 0)
    exact = np.linalg.solve(np.eye(len(ids)) - 0.85 * walk.T, np.full(len(ids), 0.15 / len(ids)))
    got = {r["id"]: r["rank"] for r in gr.pagerank(g, iterations=steps).collect()}
    assert max(abs(got[v] / exact[at[v]] - 1) for v in ids) < 1e-6
    values, vectors = np.linalg.eigh(a)
    lead = np.abs(vectors[:, -1])
    got = {r["id"]: r["centrality"] for r in gr.eigenvector(g, iterations=steps).collect()}
    assert max(abs(got[v] - lead[at[v]]) for v in ids) < 1e-6


def test_communities_find_triangles(spark, graph):
    labels = {r["id"]: r["community"] for r in gr.communities(graph).collect()}
    assert labels[1] == labels[2] == labels[3]
    assert labels[4] == labels[5] == labels[6] != labels[1]
    assert labels[7] == labels[8] and labels[9] == 9
    truth = spark.createDataFrame([(i, (i - 1) // 3) for i in range(1, 10)], "id long, g int")
    got = spark.createDataFrame(list(labels.items()), "id long, c long").join(truth, "id")
    assert 0.6 < gr.adjusted_rand(got, "c", "g").first()["ari"] <= 1
    assert gr.adjusted_rand(truth, "g", "g").first()["ari"] == pytest.approx(1.0)


def test_propagation_keeps_constant_direction(graph):
    deg = gr.degrees(graph).select("id", F.lit(0).alias("dim"), F.sqrt(F.col("degree") + 1.0).alias("x"))
    out = gr.propagate(graph, deg, 2).join(deg.withColumnRenamed("x", "x0"), ["id", "dim"])
    assert out.filter("abs(x - x0) > 1e-9").count() == 0


def test_components_match_search(spark):
    px = spark.range(900).select(F.floor(F.col("id") / 450).alias("raster_id"), (F.col("id") % 450 / 30).cast("int").alias("row"),
                                 (F.col("id") % 30).cast("int").alias("col"), (hash48("mask", "id") % 100 < 58).alias("on"))
    cells = {(r["raster_id"], r["row"], r["col"]) for r in px.filter("on").collect()}
    want, seen = {}, set()
    for start in sorted(cells):
        if start in seen:
            continue
        queue = deque([start])
        seen.add(start)
        while queue:
            k, r, c = queue.popleft()
            want[(k, r, c)] = start
            for nxt in ((k, r + 1, c), (k, r - 1, c), (k, r, c + 1), (k, r, c - 1)):
                if nxt in cells and nxt not in seen:
                    seen.add(nxt)
                    queue.append(nxt)
    labelled = sp.components(px, F.col("on"))
    got = {(r["raster_id"], r["row"], r["col"]): tuple(r["component"]) for r in labelled.collect()}
    assert got == want  # rasters with touching coordinates stay apart
    numbers = {tuple(r[:3]): r["instance"] for r in sp.instances(labelled).collect()}
    for k in (0, 1):
        names = sorted({c for c in want.values() if c[0] == k})
        assert all(numbers[cell] == names.index(c) + 1 for cell, c in want.items() if c[0] == k)


def test_only_buildings_have_instances(spark):
    px = spark.range(8).select((F.col("id") % 2).alias("raster_id"), F.lit(0).alias("row"), F.floor(F.col("id") / 2).cast("int").alias("col"))
    ring = lambda a, b: sp.box(F.lit(a), F.lit(-2.0), F.lit(b), F.lit(2.0)).alias("ring")
    shapes = spark.range(1).select(F.lit(2).alias("class"), F.lit(7).alias("shape"), F.lit(1).alias("ord"), ring(0.0, 2.0)).unionByName(
        spark.range(1).select(F.lit(1).alias("class"), F.lit(9).alias("shape"), F.lit(2).alias("ord"), ring(1.0, 3.0)))
    out = sp.rasterize(px, shapes, "ring", (1.0, 0.0, 0.0, 0.0, -1.0, 0.0), 1.0, "class", "shape", "ord", 2)
    assert sorted(map(tuple, out.collect())) == sorted((k, 0, c, *v) for k in (0, 1) for c, v in enumerate([(2, 7), (2, 7), (1, 0), (0, 0)]))


def test_crowded_cells_are_split(spark, monkeypatch):
    from civicframe.operators import scalable
    plain = scalable.chunked
    monkeypatch.setattr(scalable, "chunked", lambda a, b, k: plain(a, b, k, rows_per_chunk=5))
    pts = spark.range(60).select("id", (F.col("id") % 7 * 0.1).alias("x"), (F.col("id") % 5 * 0.1 + F.when(F.col("id") > 50, 9).otherwise(0)).alias("y"))
    ring = spark.range(3).select("id", sp.box(F.lit(-1.0), F.lit(-1.0), F.lit(0.35) + F.col("id") * 0.1, F.lit(3.0)).alias("ring")).withColumnRenamed("id", "poly")
    got = sorted(map(tuple, sp.points_in_polygons(pts, ring, "ring", 5.0).select("id", "poly").collect()), key=str)
    want = []
    for r in pts.collect():
        hits = [p for p in range(3) if r["x"] < 0.35 + p * 0.1 and r["y"] < 3]
        want += [(r["id"], p) for p in hits] or [(r["id"], None)]
    assert got == sorted(want, key=str)


def test_within_excludes_the_boundary(spark):
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 0.0, 1.0), (3, 2.0, 2.0), (4, 3.0, 1.0), (5, -4.0, -4.0)], "pt int, x double, y double")
    ring = spark.range(1).select(F.lit(7).alias("poly"), sp.box(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(2.0)).alias("ring"))
    out = {r["pt"]: r["poly"] for r in sp.points_in_polygons(pts, ring, "ring", 0.5).collect()}
    assert out == {1: 7, 2: None, 3: None, 4: None, 5: None}


def test_projection_and_crs(spark):
    pts = spark.createDataFrame([(2.2945, 48.8582)], "x double, y double")
    utm = sp.reproject(pts, "x", "y", "EPSG:4326", "EPSG:32631").first()
    assert utm["x"] == pytest.approx(448252, abs=2) and utm["y"] == pytest.approx(5411943, abs=12)
    web = sp.reproject(pts, "x", "y", "EPSG:4326", "EPSG:3857")
    back = sp.reproject(web, "x", "y", "EPSG:3857", "EPSG:4326").first()
    assert (back["x"], back["y"]) == pytest.approx((2.2945, 48.8582))
    with pytest.raises(ValueError):
        sp.reproject(pts, "x", "y", "EPSG:2154", "EPSG:4326")
    with pytest.raises(ValueError):
        sp.check_crs(pts.withColumn("crs", F.lit("EPSG:4326")), pts.withColumn("crs", F.lit("EPSG:3857")))


def plain_within(px, py, ring):
    inside = False
    for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:]):
        if (bx - ax) * (py - ay) == (by - ay) * (px - ax) and min(ax, bx) <= px <= max(ax, bx) and min(ay, by) <= py <= max(ay, by):
            return False
        if (ay > py) != (by > py) and px < ax + (py - ay) * (bx - ax) / (by - ay):
            inside = not inside
    return inside


def star(rng, x, y, radius, corners):
    turns = np.sort(rng.random(corners)) * 2 * np.pi
    reach = radius * (0.3 + 0.7 * rng.random(corners))
    ring = [(float(np.round(x + r * np.cos(t), 3)), float(np.round(y + r * np.sin(t), 3))) for r, t in zip(reach, turns)]
    return ring + ring[:1]


SHAPE = "poly_id int, name string, ring array<struct<x:double,y:double>>"


@pytest.mark.parametrize("cell", [100.0, 5.0, 0.7])
def test_points_in_polygons_of_all_sizes(spark, cell, monkeypatch):
    rng = np.random.default_rng(12)
    shapes = [star(rng, *rng.uniform(0, 100, 2), size, n) for size, n in ((60, 40), (30, 7), (8, 5), (1, 9), (0.2, 4), (45, 200))]
    shapes += [[(10, 10), (30, 10), (30, 30), (10, 30), (10, 10)], [(10, 10), (20, 20), (30, 10), (10, 10)]]
    rows = [(i, f"s{i}", ring) for i, ring in enumerate(shapes)] + [(90, "none", None), (91, "short", [(0.0, 0.0), (1.0, 1.0)]), (92, "odd", [(0.0, float("nan"))] * 5)]
    polygons = spark.createDataFrame([(i, n, None if r is None else [(float(x), float(y)) for x, y in r]) for i, n, r in rows], SHAPE)
    spots = [tuple(map(float, np.round(p, 2))) for p in rng.uniform(-10, 110, (400, 2))] + [(10.0, 10.0), (20.0, 10.0), (20.0, 20.0), (15.0, 25.0), (30.0, 30.0)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)] + [(1000, None, 5.0)], "pt_id int, x double, y double")
    expected = {(i, j) for i, p in enumerate(spots) for j, ring in enumerate(shapes) if plain_within(*p, [tuple(map(float, q)) for q in ring])}
    for crowd in (20_000, 3):
        monkeypatch.setattr(sp, "CROWDED", crowd)
        got = [(r["pt_id"], r["poly_id"]) for r in sp.points_in_polygons(points, polygons, "ring", cell).collect()]
        assert len(got) == len(set(got)) and {g for g in got if g[1] is not None} == expected
        assert {g[0] for g in got if g[1] is None} == {*range(len(spots)), 1000} - {i for i, _ in expected}


def test_a_continent_takes_cells_along_its_boundary(spark):
    turns = np.linspace(0, 2 * np.pi, 2001)
    ring = np.stack([5000 * np.cos(turns), 4000 * np.sin(turns)], axis=1)
    ring[-1] = ring[0]
    inside, border, _, _ = sp.quad_cover(ring, 10.0)
    assert len(inside) + len(border) < 12 * 28_400 / 10  # the boundary is about 28,400 long; the extent has 800,000 cells
    area = len(border) * 100 + ((10.0 * sp.FACTOR ** inside[:, 0]) ** 2).sum()
    assert np.pi * 5000 * 4000 <= area <= 1.01 * np.pi * 5000 * 4000
    polygons = spark.createDataFrame([(1, "land", [tuple(map(float, p)) for p in ring])], SHAPE)
    spots = [(0.0, 0.0), (4999.0, 0.0), (5000.5, 0.0), (0.0, -3999.0), (3600.0, 2800.0), (3530.0, 2820.0)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], "pt_id int, x double, y double")
    got = {r["pt_id"] for r in sp.points_in_polygons(points, polygons, "ring", 10.0, how="inner").collect()}
    assert got == {i for i, p in enumerate(spots) if plain_within(*p, [tuple(q) for q in ring])}


@pytest.mark.parametrize("tile", [256, 7, 1])
def test_components_across_tiles(spark, tile):
    rng = np.random.default_rng(3)
    masks = [rng.random((40, 33)) < 0.6, np.ones((9, 30), bool), np.zeros((3, 3), bool)]
    spiral = np.zeros((21, 21), bool)
    for k in range(0, 10, 2):
        spiral[k, k:21 - k] = spiral[k:21 - k, 20 - k] = spiral[20 - k, k:21 - k] = True
        spiral[k + 2:21 - k, k] = True
    masks.append(spiral)
    rows = [(m, r, c, bool(v)) for m, mask in enumerate(masks) for (r, c), v in np.ndenumerate(mask)]
    pixels = spark.createDataFrame(rows, "raster_id long, row int, col int, on boolean")
    expected = {}
    for m, mask in enumerate(masks):
        seen = np.zeros(mask.shape, bool)
        for start in zip(*np.nonzero(mask)):
            if seen[start]:
                continue
            queue, seen[start] = deque([start]), True
            while queue:
                r, c = queue.popleft()
                expected[m, int(r), int(c)] = (m, *map(int, start))
                for a, b in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                    if 0 <= a < mask.shape[0] and 0 <= b < mask.shape[1] and mask[a, b] and not seen[a, b]:
                        seen[a, b] = True
                        queue.append((a, b))
    got = {(r["raster_id"], r["row"], r["col"]): tuple(r["component"]) for r in sp.components(pixels, F.col("on"), tile).collect()}
    assert got == expected


@pytest.mark.parametrize("room, held", [(4096, 1 << 27), (3, 1 << 27), (4096, 64)])
def test_a_step_sends_each_sum_once_for_each_bucket(spark, monkeypatch, room, held):
    """Not once for each task: with 16 shuffle partitions the links lie in 2 buckets of 8 columns."""
    pairs = [(a, 1000 + b) for a in range(60) for b in range(60) if (a * b) % 7 != 3]
    g = gr.build_graph(spark.createDataFrame(pairs, "a long, b long"), "a", "b")
    values = g.vertices.select(F.lit(0).alias("block"), "id", "id").toDF("block", "id", "v")
    values = gr.batchwise(values, "block int, id bigint, x binary", lambda b: [
        b["block"], b["id"], gr.packed(np.stack([b["v"].to_numpy(), np.ones(len(b))], axis=1).astype(float))])
    whole, partial = gr.summed, []
    monkeypatch.setattr(gr, "summed", lambda rows, *rest: partial.append(rows) or whole(rows, *rest))
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        with gr.link_grid(g.edges, room) as links:
            sums = {r["id"]: np.frombuffer(r["x"]).tolist() for r in gr.sent_along(links.beside(values), 2, "bigint", held=held).collect()}
            sent = partial[0].count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    expected = {}
    for a, b in pairs + [(b, a) for a, b in pairs]:
        s = expected.setdefault(a, [0.0, 0.0])
        s[0], s[1] = s[0] + b, s[1] + 1
    assert sums == expected
    assert held < 1 << 27 or sent <= 2 * len(expected)
