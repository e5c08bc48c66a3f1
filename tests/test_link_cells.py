"""Steps of one number a vertex: links lie in cells, and what a step sends follows the vertices, not the links."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicframe.operators import graph as gr


@pytest.mark.parametrize("text_ids", [False, True])
def test_cells_sum_what_plain_links_sum(spark, monkeypatch, text_ids):
    """With small cells and units, isolates, ids that only links name, and a vertex given twice."""
    monkeypatch.setattr(gr, "LINKS_PER_CELL", 20)
    monkeypatch.setattr(gr, "VERTICES_PER_UNIT", 3)
    rng = np.random.default_rng(8)
    kind, name = ("string", lambda v: f"v{v}") if text_ids else ("long", int)
    links = [(name(a), name(b), float(w)) for a, b, w in zip(rng.integers(0, 40, 300), rng.integers(0, 50, 300), rng.random(300), strict=True)]
    edges = spark.createDataFrame(links, f"src {kind}, dst {kind}, w double")
    given = [name(v) for v in range(30)] + [name(3), name(90)]
    vertices = spark.createDataFrame([(v,) for v in given], f"id {kind}" if text_ids else "id int")
    now = {}
    for v in given:
        now[v] = now.get(v, 0.0) + 0.5
    with gr.link_cells(edges, vertices, len(links), len(given)) as cells:
        assert cells.side > 3 and cells.units.count() > cells.side
        x = cells.start(0.5)
        for base, scale in ((0.0, 1.0), (0.25, 0.5)):
            x, after = cells.pulled(x, base, scale), {}
            for a, b, w in links:
                if a in now:
                    after[b] = after.get(b, 0.0) + scale * w * now[a]
            now = {v: s + base for v, s in after.items()}
            assert {r["id"]: r["x"] for r in cells.rows(x).collect()} == pytest.approx(now)


def test_a_step_sends_the_same_for_ten_times_the_links(spark):
    def sent(n_links):
        edges = spark.range(n_links).select((F.col("id") % 50).alias("src"), (F.col("id") % 997 % 50).alias("dst"), F.lit(1.0).alias("w"))
        with gr.link_cells(edges, spark.range(50), n_links, 50) as cells:
            plan = cells.pulled(cells.start(1.0))
            moved = [line for line in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line and "src" in line]
            parts = cells.cells.select(F.sum(F.size("sizes"))).first()[0]
            return parts, moved, plan.agg(F.sum("total")).first()[0]

    few, many = sent(2_000), sent(20_000)
    assert few[0] == many[0] and not few[1] and not many[1]
    assert few[2] == pytest.approx(2_000) and many[2] == pytest.approx(20_000)
