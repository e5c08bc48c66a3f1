"""Graphs as edge tables: summaries, centrality, communities, propagation.

An undirected edge is stored in both directions, so every step is an equi-join of edges with a
small per-vertex table followed by a partial aggregation. Iterative operators write their state to
the shared folder each round; the plan never grows.
"""

from __future__ import annotations

import contextlib
import hashlib
import itertools
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicframe.functions.hashing import hash48
from civicframe.operators import relational as rel
from civicframe.session import Bucketed, bucket_of, materialise, materialise_observed, shuffle_width


@dataclass(frozen=True)
class Graph:
    vertices: DataFrame  # id
    edges: DataFrame  # src, dst, w; both directions when undirected
    directed: bool = False

    def staged(self) -> Graph:
        return Graph(materialise(self.vertices), materialise(self.edges), self.directed)


def build_graph(edges: DataFrame, src: str, dst: str, weight: str | None = None, directed: bool = False,
                vertices: DataFrame | None = None, key: str = "id") -> Graph:
    """Parallel edges are merged (weights added), self-loops dropped, isolates kept with ``vertices``."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    a, b = F.col(src), F.col(dst)
    rows = edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
    if directed:
        merged = rows.groupBy(a.alias("src"), b.alias("dst")).agg(F.sum(w).alias("w"))
        both = merged
    else:
        merged = rows.groupBy(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst")).agg(F.sum(w).alias("w"))
        both = merged.select(F.explode(F.array(F.struct("src", "dst", "w"), F.struct(
            F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))).alias("e")).select("e.*")
    if not weight:
        both = both.withColumn("w", F.lit(1.0))
    if vertices is None:
        ids = both.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    else:
        ids = vertices.select(F.col(key).alias("id")).distinct()
    return Graph(ids, both, directed)


def edge_list(g: Graph) -> DataFrame:
    return g.edges if g.directed else g.edges.filter("src < dst")


def summary(g: Graph) -> DataFrame:
    """Nodes, edges, density, stored entries."""
    n = g.vertices.agg(F.count(F.lit(1)).alias("n_nodes"), F.lit(1).alias("__k"))
    e = g.edges.agg(F.count(F.lit(1)).alias("nnz"), F.lit(1).alias("__k"))
    m = F.col("nnz") if g.directed else (F.col("nnz") / 2).cast("bigint")
    pairs = F.col("n_nodes") * (F.col("n_nodes") - 1)
    density = F.when(pairs > 0, F.col("nnz") / pairs)
    return n.join(e, "__k").select("n_nodes", m.alias("n_edges"), density.alias("density"), "nnz")


def degrees(g: Graph) -> DataFrame:
    """Degree and strength of every vertex, isolates with 0."""
    out = g.edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"), F.sum("w").alias("strength"))
    return g.vertices.join(out, "id", "left").select(
        "id", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("strength", F.lit(0.0)).alias("strength"))


def degree_distribution(g: Graph) -> DataFrame:
    return rel.value_counts(degrees(g), ["degree"])


# ---------------------------------------------------------------- links, packed

#: Links that one packed row holds; the links of a vertex with more are dealt into several rows.
LINKS_PER_ROW = 4_096


@dataclass(frozen=True)
class Links:
    """The out-links of each vertex, packed into rows (src, share, links).

    ``near`` has share 0 of every vertex and is bucketed by ``src``, so a step moves the vertices' values but never the links.
    ``far`` has the further shares of vertices with very many links (null if there are none), and ``hubs`` how many each of
    them has; the value of a hub is copied to its shares, wherever they are, and the sums of all shares meet.
    """

    near: DataFrame
    far: DataFrame | None
    hubs: DataFrame | None

    def beside(self, values: DataFrame) -> DataFrame:
        """``values`` (id, ...) with the links of each vertex: columns of ``values`` and ``links``, one row for each share."""
        values = values.withColumnRenamed("id", "src")
        columns = [c for c in values.columns if c != "src"]
        rows = self.near.join(values, "src").select(*columns, "links")
        if self.far is None:
            return rows
        copies = values.join(self.hubs, "src").withColumn("share", F.explode(F.sequence(F.lit(1), F.col("shares") - 1)))
        return rows.unionByName(self.far.join(copies, ["src", "share"]).select(*columns, "links"))

    def pulled(self, values: DataFrame) -> DataFrame:
        """(id, x) of vertices to (id, pulled): the sum of weight * x over the links that lead to a vertex."""
        links = self.beside(values.select("id", "x")).select("x", F.explode("links").alias("l"))
        return links.groupBy(F.col("l.dst").alias("id")).agg(F.sum(F.col("x") * F.col("l.w")).alias("pulled"))


@contextlib.contextmanager
def packed_links(edges: DataFrame, links_per_row: int = LINKS_PER_ROW) -> Iterator[Links]:
    """Edges (src, dst, w) as :class:`Links`, to be used inside the block."""
    counts = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > links_per_row)
    hubs = materialise(counts.select("src", F.ceil(F.col("n") / links_per_row).cast("int").alias("shares")))
    if hubs.isEmpty():
        dealt, hubs = edges.withColumn("share", F.lit(0)), None
    else:
        share = F.pmod(F.xxhash64("dst"), F.coalesce("shares", F.lit(1))).cast("int")
        dealt = edges.join(hubs, "src", "left").withColumn("share", share)
    rows = dealt.groupBy("src", "share").agg(F.collect_list(F.struct("dst", "w")).alias("links"))
    if hubs is not None:
        rows = materialise(rows)
    near = rows if hubs is None else rows.where("share = 0")
    with Bucketed(near.drop("share"), "src") as bucketed:
        yield Links(bucketed, None if hubs is None else rows.where("share > 0"), hubs)


@dataclass(frozen=True)
class LinkGrid:
    """The out-links of each vertex, dealt by their ends into ``columns`` and bucketed by ``src`` into a few rows of buckets.

    A task reads the links of one bucket that lead to one column. Wide values are shuffled once into the buckets and read again
    for each column; a task's sums go to its column only, so a step sends each sum once for each bucket, not for each task.
    """

    table: DataFrame
    columns: int

    def beside(self, values: DataFrame) -> DataFrame:
        """``values`` (id, ...) with the links of each vertex: columns of ``values`` and ``links``, one row or more for each column."""
        values = values.withColumnRenamed("id", "src")
        names = [c for c in values.columns if c != "src"]
        # Sorted and merged, as the links would otherwise be broadcast to the rows where they lie, and each of their tasks send all sums.
        parts = [self.table.where(F.col("to") == c).hint("merge").join(values, "src").select(*names, "links") for c in range(self.columns)]
        return reduce(DataFrame.unionAll, parts)


def grid_shape(tasks: int) -> tuple[int, int]:
    """(buckets, columns) of about as many cells as there are tasks."""
    buckets = max(1, math.ceil(math.sqrt(tasks) / 2))
    return buckets, math.ceil(tasks / buckets)


@contextlib.contextmanager
def link_grid(edges: DataFrame, links_per_row: int = LINKS_PER_ROW) -> Iterator[LinkGrid]:
    """Edges (src, dst, w) as :class:`LinkGrid`, to be used inside the block; they are read once and shuffled once.

    The links of a cell are sorted in its task and cut into rows of ``links_per_row`` at most, so no vertex is too large for a row.
    """
    width = shuffle_width(edges.sparkSession)
    buckets, columns = grid_shape(width)
    kinds = dict(edges.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            src, to = batch["src"], batch["to"].to_numpy()
            new = np.concatenate([[True], to[1:] != to[:-1]])
            new[1:] |= pc.not_equal(src.slice(1), src.slice(0, len(src) - 1)).to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(new)
            after = np.arange(len(src)) - np.repeat(heads, np.diff(np.append(heads, len(src))))  # links of the vertex before this one
            first = np.flatnonzero(after % links_per_row == 0)
            links = pa.StructArray.from_arrays([batch["dst"], batch["w"]], names=["dst", "w"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(src)).astype(np.int32)), links)
            yield pa.RecordBatch.from_arrays([src.take(pa.array(first)), pa.array(to[first]), lists], names=["src", "to", "links"])

    column = F.pmod(F.xxhash64("dst"), F.lit(columns)).cast("int")
    dealt = edges.where(F.col("src").isNotNull()).select("src", "dst", F.col("w").cast("double").alias("w"), column.alias("to"))
    dealt = dealt.repartition(width, "to", bucket_of(buckets, "src")).sortWithinPartitions("to", "src")
    rows = dealt.select("src", "to", "dst", "w").mapInArrow(run, f"src {kinds['src']}, to int, links array<struct<dst: {kinds['dst']}, w: double>>")
    with Bucketed(rows, "src", buckets=buckets, within="to", dealt=True) as table:
        yield LinkGrid(table, columns)


#: Links of a cell, at most about, and vertices of a unit.
LINKS_PER_CELL, VERTICES_PER_UNIT = 1 << 22, 1 << 16
#: What a step leaves of each unit: its numbers, which of its vertices have one, the sum of the numbers and that of their squares.
VALUES = "unit int, x binary, there binary, total double, squares double"


def _values(unit: int, x: np.ndarray, there: np.ndarray) -> dict[str, list]:
    return {"unit": [unit], "x": [x.tobytes()], "there": [there.tobytes()], "total": [float(x.sum())], "squares": [float(x @ x)]}


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


@dataclass(frozen=True)
class LinkCells:
    """The links of a graph in a square of cells, for steps that carry one number for each vertex.

    Vertices are dealt by a hash into units, and the units in turn to the rows and to the columns of the square. A cell has the links from the
    vertices of its row to those of its column, as places among them. A step sends the numbers of a unit to the cells of its row and the sums
    of a cell to the units of its column: twice ``side`` numbers for each vertex, however many links it has. Links never move.
    """

    units: DataFrame  # unit, ids, copies
    cells: DataFrame  # cell, units and sizes of its column, src, dst, w
    side: int

    def start(self, x: float) -> DataFrame:
        """``x`` for every vertex of the graph, none for others that links lead to."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for unit, copies in zip(batch["unit"].to_pylist(), batch["copies"], strict=True):
                    n = copies.values.to_numpy()
                    yield pa.RecordBatch.from_pydict(_values(unit, n * x, (n > 0).astype(np.uint8)), schema=target)

        target = _arrow_schema(VALUES)
        return self.units.select("unit", "copies").mapInArrow(run, VALUES)

    def pulled(self, values: DataFrame, base: float = 0.0, scale: float = 1.0) -> DataFrame:
        """``base`` and ``scale`` times the sum of weight * x over the links that lead to a vertex; it has one if such a link starts at one that has."""
        side, parts_schema, target = self.side, _arrow_schema("unit int, x binary, there binary"), _arrow_schema(VALUES)
        sent = values.select("unit", "x", "there", F.explode(F.transform(
            F.sequence(F.lit(0), F.lit(side - 1)), lambda c: F.pmod("unit", F.lit(side)) * side + c)).alias("of"))

        def part(cell: pa.Table, own: pa.Table) -> pa.Table:
            if not len(cell) or not len(own):
                return parts_schema.empty_table()
            own = own.sort_by("unit")
            x, there = _joined(own["x"], np.float64), _joined(own["there"], np.uint8).astype(bool)
            src, dst, w = (_joined(cell[c], k) for c, k in (("src", np.int32), ("dst", np.int32), ("w", np.float64)))
            ends = np.cumsum(cell["sizes"][0].values.to_numpy())
            sums, reached = np.bincount(dst, x[src] * w, minlength=ends[-1]), np.zeros(ends[-1], np.uint8)
            reached[dst if there.all() else dst[there[src]]] = 1
            return pa.table({"unit": cell["units"][0].values, "x": [v.tobytes() for v in np.split(sums, ends[:-1])],
                             "there": [v.tobytes() for v in np.split(reached, ends[:-1])]}, schema=parts_schema)

        def add(parts: pa.Table) -> pa.Table:
            x, there = 0.0, np.uint8(0)
            for sums, reached in zip(parts["x"].to_pylist(), parts["there"].to_pylist(), strict=True):
                x, there = x + np.frombuffer(sums, np.float64), there | np.frombuffer(reached, np.uint8)
            return pa.table(_values(parts["unit"][0].as_py(), np.where(there > 0, base + scale * x, 0.0), there), schema=target)

        parts = self.cells.groupBy("cell").cogroup(sent.groupBy("of")).applyInArrow(part, "unit int, x binary, there binary")
        return parts.groupBy("unit").applyInArrow(add, VALUES)

    def both(self, values: DataFrame, start: DataFrame, scale: float = 1.0, start_scale: float = 1.0) -> DataFrame:
        """``values`` of the vertices that have one in ``start`` too; ``gap`` and ``most`` are the sum and the largest of their changes, each side scaled."""
        schema = VALUES + ", gap double, most double"
        target = _arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for unit, x, there, x0, there0 in zip(*(batch[c].to_pylist() for c in ("unit", "x", "there", "x0", "there0")), strict=True):
                    kept = np.frombuffer(there, np.uint8) & np.frombuffer(there0, np.uint8)
                    x = np.where(kept > 0, np.frombuffer(x, np.float64), 0.0)
                    change = np.abs(scale * x - start_scale * np.frombuffer(x0, np.float64)) * kept
                    gaps = {"gap": [float(change.sum())], "most": [float(change.max(initial=0.0))]}
                    yield pa.RecordBatch.from_pydict(_values(unit, x, kept) | gaps, schema=target)

        before = start.select("unit", F.col("x").alias("x0"), F.col("there").alias("there0"))
        return values.select("unit", "x", "there").join(before, "unit").mapInArrow(run, schema)

    def rows(self, values: DataFrame) -> DataFrame:
        """(id, x) of the vertices that have a number."""
        target = T.StructType([T.StructField("id", self.units.schema["ids"].dataType.elementType), T.StructField("x", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    there = pa.array(_joined(batch["there"], np.uint8) > 0)
                    x = pa.array(_joined(batch["x"], np.float64))
                    yield pa.RecordBatch.from_arrays([batch["ids"].flatten().filter(there), x.filter(there)], names=["id", "x"])

        return self.units.select("unit", "ids").join(values.select("unit", "x", "there"), "unit").mapInArrow(run, target)


def _arrow_schema(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


@contextlib.contextmanager
def link_cells(edges: DataFrame, vertices: DataFrame, n_links: int, n_vertices: int) -> Iterator[LinkCells]:
    """Edges (src, dst, w) as :class:`LinkCells`, to be used inside the block."""
    side = math.ceil(math.sqrt(max(shuffle_width(edges.sparkSession), n_links / LINKS_PER_CELL)))
    n_units = side * max(1, math.ceil(n_vertices / side / VERTICES_PER_UNIT))
    edges = edges.where(F.col("src").isNotNull())
    own = vertices.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
    led_to = edges.select(F.col("dst").alias("id")).distinct().withColumn("copies", F.lit(0).cast("bigint"))
    ids = own.unionByName(led_to).groupBy("id").agg(F.sum("copies").alias("copies"))
    kind = dict(ids.dtypes)["id"]

    def unit(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c).cast(kind)), F.lit(n_units)).cast("int")

    listed = ids.groupBy(unit("id").alias("unit")).agg(F.collect_list(F.struct("id", "copies")).alias("l"))
    units = materialise(listed.select("unit", F.col("l.id").alias("ids"), F.col("l.copies").alias("copies")))
    schema = "cell int, units array<int>, sizes array<int>, src binary, dst binary, w binary"

    def place(key: tuple, links: pa.Table, around: pa.Table) -> pa.Table:
        if not len(links):
            return pa.table({c: [] for c in ("cell", "units", "sizes", "src", "dst", "w")})
        around, out = around.sort_by("unit"), {"cell": pa.array([key[0].as_py()], pa.int32())}
        for end in ("src", "dst"):  # the units of the row, and those of the column, which stay
            own = around.filter(pc.equal(around["end"], end))
            lists = own["ids"].combine_chunks()
            at = pc.index_in(links[end], value_set=lists.flatten()).to_numpy()
            out[end] = pa.array([at.astype(np.int32).tobytes()], pa.binary())
        out["units"] = pa.array([own["unit"].to_pylist()], pa.list_(pa.int32()))
        out["sizes"] = pa.array([pc.list_value_length(lists).to_pylist()], pa.list_(pa.int32()))
        out["w"] = pa.array([links["w"].to_numpy().tobytes()], pa.binary())
        return pa.table({c: out[c] for c in ("cell", "units", "sizes", "src", "dst", "w")})

    dealt = edges.select((F.pmod(unit("src"), F.lit(side)) * side + F.pmod(unit("dst"), F.lit(side))).alias("cell"),
                         F.col("src").cast(kind).alias("src"), F.col("dst").cast(kind).alias("dst"), "w")
    at, others = F.pmod("unit", F.lit(side)), F.sequence(F.lit(0), F.lit(side - 1))
    ends = F.concat(F.transform(others, lambda o: F.struct((at * side + o).alias("cell"), F.lit("src").alias("end"))),
                    F.transform(others, lambda o: F.struct((o * side + at).alias("cell"), F.lit("dst").alias("end"))))
    around = units.select("unit", "ids", F.inline(ends))
    placed = dealt.groupBy("cell").cogroup(around.groupBy("cell")).applyInArrow(place, schema)
    with Bucketed(placed, "cell") as cells:
        yield LinkCells(units, cells, side)


def _with_loops(edges: DataFrame, vertices: DataFrame, weight: float) -> DataFrame:
    """Edges with a link from every vertex to itself, so that what a vertex keeps in a step comes in with its links' sums."""
    own = vertices.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(weight).alias("w"))
    return edges.select("src", "dst", "w").unionByName(own)


def pagerank(g: Graph, damping: float = 0.85, iterations: int | None = None, tol: float = 1e-10, relax: float = 0.75,
             steps_per_job: int = 8) -> DataFrame:
    """PageRank; the mass of vertices without out-links is spread evenly.

    That spreading only scales the solution of r = (1 - d) / n + d P'r, so it is left out of the steps and the result is
    scaled to sum 1. Steps go ``relax`` of the way, which damps the swing between the sides of bipartite graphs. They end
    when the ranks of a job's steps change by at most ``tol`` in all, or after ``iterations``. Several steps make one job.
    """
    out = g.edges.groupBy("src").agg(F.sum("w").alias("__out"))
    edges = g.edges.join(out, "src").select("src", "dst", (F.lit(relax * damping) * F.col("w") / F.col("__out")).alias("w"))
    n = g.vertices.count()
    base = relax * (1 - damping) / n if n else 0.0
    done, total = 0, 1.0
    with link_cells(_with_loops(edges, g.vertices, 1 - relax), g.vertices, g.edges.count() + n, n) as cells:
        ranks = cells.start(1.0 / max(n, 1))
        while n and (iterations is None or done < iterations):
            steps = steps_per_job if iterations is None else min(steps_per_job, iterations - done)
            start = ranks
            for _ in range(steps):
                ranks = cells.pulled(ranks, base)
            if iterations is None:
                ranks, seen = materialise_observed(cells.both(ranks, start), gap=F.sum("gap"), total=F.sum("total"))
            else:
                ranks, seen = materialise_observed(ranks, total=F.sum("total"))
            done, total = done + steps, seen["total"]
            if iterations is None and seen["gap"] <= tol:
                break
    return cells.rows(ranks).select("id", (F.col("x") / F.lit(total)).alias("rank"))


def eigenvector(g: Graph, iterations: int | None = None, tol: float = 1e-10, steps_per_job: int = 8) -> DataFrame:
    """Leading eigenvector of the adjacency, unit length, by power steps on A + s I.

    The shift s is half the strength of the average neighbour, an estimate of the leading eigenvalue; it keeps bipartite graphs
    from flipping. Steps end when no entry moves by more than ``tol``, or after ``iterations``. Several steps make one job.
    """
    edges = g.edges.select("src", "dst", "w")
    strength = edges.groupBy("src").agg(F.sum("w").alias("s"))
    shift = (strength.agg(F.sum(F.col("s") * F.col("s")) / F.sum("s")).first()[0] or 0.0) / 2
    n = g.vertices.count()
    norm, done = 1.0, 0
    with link_cells(_with_loops(edges, g.vertices, shift), g.vertices, g.edges.count() + n, n) as cells:
        x = cells.start(1.0 / math.sqrt(max(n, 1)))
        while n and shift and (iterations is None or done < iterations):
            steps = steps_per_job if iterations is None else min(steps_per_job, iterations - done)
            start, y, before = x, x, norm
            for step in range(steps):
                y = cells.pulled(y, scale=1 / norm if step == 0 else 1.0)
            # The squared length is taken while the vector is written; it scales the next reading.
            y = cells.both(y, start) if iterations is None else y
            x, seen = materialise_observed(y, ss=F.sum("squares"))
            norm, done = math.sqrt(seen["ss"]), done + steps
            if iterations is None and cells.both(x, start, 1 / norm, 1 / before).agg(F.max("most")).first()[0] <= tol:
                break
    return cells.rows(x).select("id", (F.col("x") / F.lit(norm)).alias("centrality"))


def sample_sources(g: Graph, k: int, seed: str) -> DataFrame:
    """k vertices with the lowest hash (all of them when the graph has fewer)."""
    return rel.exact_sample(g.vertices, "id", k, seed)


# ---------------------------------------------------------------- betweenness

#: Sources whose numbers a row holds side by side, and links that are summed at a time.
SOURCES_PER_ROW, LINKS_AT_A_TIME = 256, 16_384
#: Bytes of sums that a task holds before it sends them, and rows that it sends at a time.
HELD, SENT_AT_A_TIME = 1 << 27, 4_096


def unpacked(column, width: int) -> np.ndarray:
    """Packed rows of doubles as a matrix; null rows are zero."""
    zero = bytes(8 * width)
    return np.frombuffer(b"".join(zero if x is None else x for x in column.to_pylist()), np.float64).reshape(-1, width)


def packed(matrix: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in matrix], pa.binary())


def batchwise(df: DataFrame, schema: str, step: Callable[[pa.RecordBatch], list]) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays(step(batch), names=names)

    return df.mapInArrow(run, schema)


def sent_along(rows: DataFrame, width: int, id_type: str, weighted: bool = False, held: int = HELD) -> DataFrame:
    """(block, x, links) to (block, id, x): the sum of the packed rows over the links that lead to a vertex, times their weights
    if ``weighted``.

    A link is read once for all numbers of a row. Links of a task that lead to one vertex are summed before they leave it, up to
    ``held`` bytes of sums.
    """

    def step(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        block, x, links = batch["block"].to_numpy(), unpacked(batch["x"], width), batch["links"]
        of = np.repeat(np.arange(len(block)), np.diff(links.offsets.to_numpy()))
        ids, to = np.unique(links.flatten().field("dst").to_numpy(zero_copy_only=False), return_inverse=True)
        key = block[of].astype(np.int64) * max(1, len(ids)) + to
        order = np.argsort(key, kind="stable")
        of, to, key = of[order], to[order], key[order]
        weights = links.flatten().field("w").to_numpy()[order] if weighted else None
        heads = np.flatnonzero(np.diff(key, prepend=-1))
        out = np.zeros((len(heads), width))
        place = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(to))))
        for at in range(0, len(to), LINKS_AT_A_TIME):
            own = place[at:at + LINKS_AT_A_TIME]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            sent = x[of[at:at + LINKS_AT_A_TIME]]
            if weighted:
                sent *= weights[at:at + LINKS_AT_A_TIME, None]
            out[own[first]] += np.add.reduceat(sent, first, axis=0)
        return block[of[heads]], ids[to[heads]], out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, kind = None, None

        def parts():
            for at in range(0, len(sums[0]), SENT_AT_A_TIME):
                block, ids, x = (v[at:at + SENT_AT_A_TIME] for v in sums)
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(ids, kind), packed(x)], names=["block", "id", "x"])

        for batch in batches:
            if len(batch):
                kind = batch["links"].type.value_type.field("dst").type
                found = step(batch)
                sums = found if sums is None else added(sums, found)
                if sums[2].nbytes > held:
                    yield from parts()
                    sums = None
        if sums is not None:
            yield from parts()

    return summed(rows.mapInArrow(run, f"block int, id {id_type}, x binary"), width, id_type)


def added(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sum of two sets of rows (block, id, x), each with different (block, id)."""
    block, ids = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    ids, of = np.unique(ids, return_inverse=True)
    key, at = np.unique(block.astype(np.int64) * max(1, len(ids)) + of, return_inverse=True)
    x = np.zeros((len(key), a[2].shape[1]))
    x[at[:len(a[0])]] = a[2]
    x[at[len(a[0]):]] += b[2]
    return (key // max(1, len(ids))).astype(np.int32), ids[key % max(1, len(ids))], x


def summed(rows: DataFrame, width: int, id_type: str) -> DataFrame:
    """(block, id, x) with the packed rows of equal (block, id) added up."""
    dealt = rows.repartition(shuffle_width(rows.sparkSession), "block", "id").sortWithinPartitions("block", "id")

    def run(batches):
        held, kind = None, None  # the last key of a batch may go on in the next

        def row(held):
            return pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int32()), pa.array([held[1]], kind), packed(held[2][None])], names=["block", "id", "x"])

        for batch in batches:
            if not len(batch):
                continue
            kind = batch["id"].type
            block, key, x = batch["block"].to_numpy(), batch["id"].to_numpy(zero_copy_only=False), unpacked(batch["x"], width)
            first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (block[1:] != block[:-1])]))
            sums = np.add.reduceat(x, first, axis=0)
            block, key = block[first], key[first]
            if held is not None:
                if held[0] == block[0] and held[1] == key[0]:
                    sums[0] += held[2]
                else:
                    yield row(held)
            yield pa.RecordBatch.from_arrays([pa.array(block[:-1]), pa.array(key[:-1], kind), packed(sums[:-1])], names=["block", "id", "x"])
            held = block[-1], key[-1], sums[-1]
        if held is not None:
            yield row(held)

    return dealt.mapInArrow(run, f"block int, id {id_type}, x binary")


def betweenness(g: Graph, k: int = 200, seed: str = "betweenness", sources_per_row: int = SOURCES_PER_ROW) -> DataFrame:
    """Approximate betweenness from k sources, normalised, by breadth-first levels.

    A row of a level holds, for one vertex and a block of sources side by side, the numbers of shortest paths of this length;
    so a step reads each link once for all sources. What an earlier level has reached (of an undirected graph the
    two before suffice) is set to zero; dependencies then flow back level by level. Distances count edges, weights are ignored.
    """
    n = g.vertices.count()
    kind = dict(g.vertices.dtypes)["id"]
    chosen = [r["id"] for r in sample_sources(g, k, seed).collect()]  # k ids
    width = min(sources_per_row, max(1, len(chosen)))
    rows = []
    for i, vertex in enumerate(chosen):
        x = np.zeros(width)
        x[i % width] = 1.0
        rows.append((i // width, vertex, bytearray(x.tobytes())))
    schema = f"block int, id {kind}, x binary"
    levels = [materialise(g.vertices.sparkSession.createDataFrame(rows, schema))]
    edges = materialise(g.edges.select("src", "dst", F.lit(1.0).alias("w")))
    with contextlib.ExitStack() as open_tables:
        links = open_tables.enter_context(link_grid(edges))
        back = links if not g.directed else open_tables.enter_context(link_grid(
            edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")))

        def unseen(batch: pa.RecordBatch) -> list:
            x = unpacked(batch["x"], width).copy()
            for c in batch.schema.names:
                if c.startswith("seen"):
                    x[unpacked(batch[c], width) > 0] = 0
            keep = np.flatnonzero(x.any(axis=1))
            return [batch["block"].take(pa.array(keep)), batch["id"].take(pa.array(keep)), packed(x[keep])]

        reached = levels[0]
        while True:
            steps = sent_along(links.beside(levels[-1]), width, kind)
            for i, earlier in enumerate([reached] if g.directed else levels[-2:]):
                steps = steps.join(earlier.withColumnRenamed("x", f"seen{i}"), ["block", "id"], "left")
            fresh, size = materialise_observed(batchwise(steps, schema, unseen), n=F.count(F.lit(1)))
            if not size["n"]:
                break
            levels.append(fresh)
            if g.directed:
                reached = materialise(summed(reached.unionByName(fresh), width, kind))

        def shares(batch: pa.RecordBatch) -> list:
            sigma, delta = unpacked(batch["sigma"], width), unpacked(batch["delta"], width)
            return [batch["block"], batch["id"], packed(np.divide(1 + delta, sigma, out=np.zeros_like(sigma), where=sigma > 0))]

        def owed(batch: pa.RecordBatch) -> list:
            return [batch["block"], batch["id"], batch["sigma"], packed(unpacked(batch["sigma"], width) * unpacked(batch["x"], width))]

        def total(batch: pa.RecordBatch) -> list:
            return [batch["id"], pa.array(unpacked(batch["delta"], width).sum(axis=1))]

        later = levels[-1].select("block", "id", F.col("x").alias("sigma"), F.lit(None).cast("binary").alias("delta"))
        totals = None
        for depth in range(len(levels) - 1, 0, -1):
            found = batchwise(later.select("id", "delta"), f"id {kind}, delta double", total)
            totals = found if totals is None else totals.unionByName(found)
            flow = sent_along(back.beside(batchwise(later, schema, shares)), width, kind)
            earlier = levels[depth - 1].withColumnRenamed("x", "sigma").join(flow, ["block", "id"], "left")
            later = materialise(batchwise(earlier, f"block int, id {kind}, sigma binary, delta binary", owed))
    scale = (n / len(chosen)) / ((n - 1) * (n - 2)) if n > 2 else 1.0
    if totals is None:
        return g.vertices.withColumn("betweenness", F.lit(0.0))
    sums = totals.groupBy("id").agg(F.sum("delta").alias("delta"))
    return g.vertices.join(sums, "id", "left").select(
        "id", (F.coalesce("delta", F.lit(0.0)) * F.lit(scale)).alias("betweenness"))


# ---------------------------------------------------------------- communities

def modularity(edges: DataFrame, labels: DataFrame) -> float:
    """Modularity of a labelling (id, community) on symmetric edges (self-loops stored once, doubled)."""
    m2 = edges.agg(F.sum("w")).first()[0]
    if not m2:
        return 0.0
    src = labels.select(F.col("id").alias("src"), F.col("community").alias("__c"))
    dst = labels.select(F.col("id").alias("dst"), F.col("community").alias("__d"))
    # One row per community: weight inside, and total degree.
    sums = edges.join(src, "src").join(dst, "dst").groupBy("__c").agg(
        F.sum(F.when(F.col("__c") == F.col("__d"), F.col("w"))).alias("inside"), F.sum("w").alias("total"))
    return sums.agg(F.sum(F.coalesce("inside", F.lit(0.0)) / m2 - F.pow(F.col("total") / m2, 2))).first()[0]


def _move_round(edges, strength, labels, m2, seed, round_no) -> DataFrame:
    """One round on tables: vertices of one hash half take the neighbouring community with the highest gain. Only the links of that half are read.

    :meth:`Neighbourhoods.moved` gives the same rows without moving links; tests compare the two.
    """
    def may_move(vertex: str) -> Column:
        return hash48(f"{seed}-{round_no}", vertex) % 2 == 0

    own = labels.where(may_move("id")).select(F.col("id").alias("src"), F.col("community").alias("own"))
    near = labels.select(F.col("id").alias("dst"), F.col("community").alias("c"))
    weight_to = edges.filter((F.col("src") != F.col("dst")) & may_move("src")).join(near, "dst").groupBy("src", "c").agg(F.sum("w").alias("w_to"))
    totals = labels.join(strength, "id").groupBy(F.col("community").alias("c")).agg(F.sum("k").alias("tot"))
    k = strength.select(F.col("id").alias("src"), "k")
    stay = own.select("src", F.col("own").alias("c"), F.lit(0.0).alias("w_to"))
    options = weight_to.unionByName(stay).groupBy("src", "c").agg(F.sum("w_to").alias("w_to"))
    scored = options.join(own, "src").join(k, "src").join(totals, "c")
    others = F.col("tot") - F.when(F.col("c") == F.col("own"), F.col("k")).otherwise(0.0)
    gain = F.round(F.col("w_to") - F.col("k") * others / F.lit(m2), 9)
    best = scored.withColumn("gain", gain).groupBy("src").agg(
        F.max(F.struct("gain", (-F.col("c")).alias("neg"))).alias("best"),
        F.max(F.when(F.col("c") == F.col("own"), F.col("gain"))).alias("kept"),
        F.max("own").alias("own"))
    target = F.when(F.col("best.gain") > F.col("kept"), -F.col("best.neg")).otherwise(F.col("own"))
    movers = best.select(F.col("src").alias("id"), target.alias("community"), (target != F.col("own")).alias("moved"))
    return movers.unionByName(labels.where(~may_move("id")).select("id", "community", F.lit(False).alias("moved")))


#: Links of a block of neighbourhoods: at least and at most, about, unless blocks are as many as shuffle partitions.
LEAST_OF_BLOCK, MOST_OF_BLOCK = 1 << 16, 1 << 22


def _even_keys(spark, n: int, width: int) -> list[int]:
    """``n`` whole numbers whose buckets, of ``width``, hold equally many of them."""
    buckets: dict[int, list[int]] = {}
    for key, bucket in spark.range((16 + 4 * n // width) * width).select(F.col("id").cast("int").alias("key"), "id").select(
            "key", bucket_of(width, "key")).collect():
        buckets.setdefault(bucket, []).append(key)
    return [buckets[i % width][i // width] for i in range(n)]


def rounded(x: np.ndarray, digits: int = 9) -> np.ndarray:
    """Rounded as Spark rounds: halves of the shortest decimal text go away from zero."""
    whole = np.abs(x) >= 1 << 52  # numbers without a fraction
    shifted = np.where(whole, 0.0, np.abs(x)) * 10.0 ** digits
    out = np.where(whole, x, np.copysign(np.floor(shifted + 0.5) / 10.0 ** digits, x))
    for i in np.flatnonzero((np.abs(shifted - np.floor(shifted) - 0.5) < 1e-4) | (shifted >= 1 << 52)):
        out[i] = float(Decimal(repr(float(x[i]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
    return out


@dataclass(frozen=True)
class Neighbourhoods:
    """The links of a graph in blocks, for steps that label each vertex with a vertex of its neighbourhood.

    Vertices have places in the order of their ids; a unit is a run of places, and its block has the links that start there, as places, with the
    strengths of all vertices. A step sends the labels, one place for each vertex, to every block; links never move.
    """

    places: DataFrame  # id, place
    units: DataFrame  # unit, ids
    blocks: DataFrame  # block, unit, first, names, src, dst, w, k
    keys: list[int]

    def start(self) -> DataFrame:
        """(unit, labels): every vertex has its own place."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for unit, first, n in zip(*(batch[c].to_pylist() for c in ("unit", "first", "n")), strict=True):
                    yield pa.RecordBatch.from_pydict({"unit": [unit], "labels": [np.arange(first, first + n, dtype=np.int32).tobytes()]}, schema=target)

        target = _arrow_schema("unit int, labels binary")
        return self.units.select("unit", "first", F.size("ids").alias("n")).mapInArrow(run, "unit int, labels binary")

    def each(self, labels: DataFrame, schema: str, step: Callable) -> DataFrame:
        """``step(block, labels of all vertices)`` of every block."""
        names = [c.split()[0] for c in schema.split(", ")]
        sent = labels.select("unit", "labels", F.explode(F.array(*map(F.lit, self.keys))).alias("of"))

        def run(block: pa.Table, own: pa.Table) -> pa.Table:
            return pa.table(dict(zip(names, step(block, _joined(own.sort_by("unit")["labels"], np.int32)), strict=True)))

        return self.blocks.groupBy("block").cogroup(sent.groupBy("of")).applyInArrow(run, schema)

    def moved(self, labels: DataFrame, m2: float, seed: str) -> DataFrame:
        """(unit, labels, moved, n): vertices of one hash half take the neighbouring community with the highest gain, of equal ones the first."""

        def step(block: pa.Table, label: np.ndarray) -> list:
            first, names, k = block["first"][0].as_py(), block["names"][0].as_py(), _joined(block["k"], np.float64)
            src, dst, w = (_joined(block[c], t) for c, t in (("src", np.int32), ("dst", np.int32), ("w", np.float64)))
            mine = label[first:first + len(names)].copy()
            may = np.array([hashlib.md5(f"{seed}:{name}".encode()).digest()[5] % 2 == 0 for name in names])
            used = may[src - first] & (src != dst)
            movers = np.flatnonzero(may)
            of = np.concatenate([src[used] - first, movers])  # each may also stay
            c = np.concatenate([label[dst[used]], mine[movers]])
            key = of.astype(np.int64) * len(label) + c
            order = np.argsort(key, kind="stable")
            heads = np.flatnonzero(np.diff(key[order], prepend=-1))
            to = np.add.reduceat(np.concatenate([w[used], np.zeros(len(movers))])[order], heads) if len(heads) else np.zeros(0)
            of, c = of[order][heads], c[order][heads]
            own = c == mine[of]
            strength = k[first + of]
            others = np.bincount(label, k, len(label))[c] - np.where(own, strength, 0.0)
            gain = rounded(to - strength * others / m2)
            kept = np.zeros(len(mine))
            kept[of[own]] = gain[own]
            best = np.lexsort((c, -gain, of))
            best = best[np.flatnonzero(np.diff(of[best], prepend=-1))]
            best = best[gain[best] > kept[of[best]]]
            mine[of[best]] = c[best]
            return [block["unit"], [mine.tobytes()], [len(best)], [len(mine)]]

        return self.each(labels, "unit int, labels binary, moved bigint, n bigint", step)

    def modularity(self, labels: DataFrame, m2: float) -> float:
        """Modularity of a labelling on symmetric edges (self-loops stored once, doubled)."""

        def step(block: pa.Table, label: np.ndarray) -> list:
            first, n, k = block["first"][0].as_py(), len(block["names"][0]), _joined(block["k"], np.float64)
            src, dst, w = (_joined(block[c], t) for c, t in (("src", np.int32), ("dst", np.int32), ("w", np.float64)))
            totals = np.bincount(label, k, len(label))[first:first + n]  # communities that are called after a vertex of this unit
            return [[float(w[label[src] == label[dst]].sum() / m2)], [float(((totals / m2) ** 2).sum())]]

        return self.each(labels, "inside double, expected double", step).agg(F.sum("inside") - F.sum("expected")).first()[0]

    def contracted(self, labels: DataFrame) -> DataFrame:
        """Edges (src, dst, w) between communities: the weights of links between their vertices, added up."""

        def step(block: pa.Table, label: np.ndarray) -> list:
            src, dst, w = (_joined(block[c], t) for c, t in (("src", np.int32), ("dst", np.int32), ("w", np.float64)))
            key, at = np.unique(label[src].astype(np.int64) * len(label) + label[dst], return_inverse=True)
            return [key // len(label), key % len(label), np.bincount(at, w, len(key))]

        sums = self.each(labels, "a bigint, b bigint, w double", step).groupBy("a", "b").agg(F.sum("w").alias("w"))
        src, dst = (self.places.select(F.col("place").alias(side), F.col("id").alias(end)) for side, end in (("a", "src"), ("b", "dst")))
        return sums.join(src, "a").join(dst, "b").select("src", "dst", "w")

    def labelled(self, labels: DataFrame) -> DataFrame:
        """(id, community) of every vertex."""
        kind = dict(self.places.dtypes)["id"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    yield pa.RecordBatch.from_arrays([batch["ids"].flatten(), pa.array(_joined(batch["labels"], np.int32).astype(np.int64))], names=["id", "place"])

        rows = self.units.select("unit", "ids").join(labels.select("unit", "labels"), "unit").select("ids", "labels").mapInArrow(run, f"id {kind}, place bigint")
        return rows.join(self.places.withColumnRenamed("id", "community"), "place").select("id", "community")


@contextlib.contextmanager
def neighbourhoods(edges: DataFrame) -> Iterator[Neighbourhoods]:
    """Symmetric edges (src, dst, w) as :class:`Neighbourhoods`, to be used inside the block; they are read three times."""
    spark, kind = edges.sparkSession, dict(edges.dtypes)["src"]
    width, n_links = shuffle_width(spark), edges.count()
    n = max(min(width, math.ceil(n_links / LEAST_OF_BLOCK)), math.ceil(n_links / MOST_OF_BLOCK), 1)
    keys = _even_keys(spark, n, width)
    strength = edges.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("k"))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(done, done + len(batch)))], names=[*batch.schema.names, "at"])
            done += len(batch)

    ordered = strength.repartitionByRange(n, "id").sortWithinPartitions("id").withColumn("unit", F.spark_partition_id())
    own = materialise(ordered.mapInArrow(numbered, f"id {kind}, k double, unit int, at bigint"))
    sizes = {r["unit"]: r["n"] for r in own.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each unit
    firsts = np.concatenate([[0], np.cumsum([sizes.get(u, 0) for u in range(n)])]).tolist()
    if firsts[-1] >= 1 << 31:
        raise ValueError("places are numbers of 32 bits")
    first = F.element_at(F.array(*[F.lit(int(v)) for v in firsts]), F.col("unit") + 1)
    places = materialise(own.select("id", (F.col("at") + first).alias("place"), "unit", "k"))
    listed = places.groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("place", "id", "k"))).alias("l"))
    units = materialise(listed.select("unit", first.cast("int").alias("first"), F.col("l.id").alias("ids"),
                                      F.col("l.id").cast("array<string>").alias("names"), F.col("l.k").alias("k")))
    at = F.element_at(F.array(*map(F.lit, keys)), F.col("unit") + 1)
    src = places.select(F.col("id").alias("src"), F.col("place").cast("int").alias("a"), at.alias("block"))
    dst = places.select(F.col("id").alias("dst"), F.col("place").cast("int").alias("b"))
    placed = edges.join(src, "src").join(dst, "dst").select("block", "a", "b", "w")
    around = units.select("unit", "k", F.explode(F.array(*map(F.lit, keys))).alias("block")).join(
        units.select(F.col("unit").alias("own"), at.alias("block"), "first", "names"), "block")
    around = around.select("block", "unit", "k", "own", "first", F.when(F.col("unit") == F.col("own"), F.col("names")).alias("names"))
    schema = "block int, unit int, first int, names array<string>, src binary, dst binary, w binary, k binary"

    def gathered(key: tuple, links: pa.Table, around: pa.Table) -> pa.Table:
        own = around.filter(pc.equal(around["unit"], around["own"]))
        one = lambda values: pa.array([values.tobytes()], pa.binary())
        return pa.table({
            "block": pa.array([key[0].as_py()], pa.int32()), "unit": own["unit"], "first": own["first"], "names": own["names"],
            "src": one(links["a"].to_numpy()), "dst": one(links["b"].to_numpy()), "w": one(links["w"].to_numpy()),
            "k": one(around.sort_by("unit")["k"].combine_chunks().flatten().to_numpy())})

    rows = placed.groupBy("block").cogroup(around.groupBy("block")).applyInArrow(gathered, schema)
    with Bucketed(rows, "block") as blocks:
        yield Neighbourhoods(places.select("id", "place"), units, blocks, keys)


def communities(g: Graph, seed: str = "communities") -> DataFrame:
    """Communities by modularity: parallel local moves, then the same on the graph of communities.

    Only half of the vertices, chosen by a hash, may move in a round. Two rounds in which hardly any
    vertex moves end a level, as do eight rounds that move no fewer; a level that does not raise modularity is
    undone and ends the search.
    """
    edges = materialise(g.edges.select("src", "dst", "w"))
    mapping = materialise(g.vertices.select("id", F.col("id").alias("community")))
    m2 = edges.agg(F.sum("w")).first()[0]
    if not m2:
        return mapping
    quality = None
    for level in itertools.count():
        with neighbourhoods(edges) as links:
            start = labels = materialise(links.start())
            idle, fewest, since = 0, math.inf, 0
            for round_no in itertools.count():
                labels, seen = materialise_observed(
                    links.moved(labels, m2, f"{seed}-{level}-{round_no}"), moved=F.sum("moved"), n=F.sum("n"))
                idle = idle + 1 if seen["moved"] <= 0.001 * seen["n"] else 0
                since = 0 if seen["moved"] < fewest else since + 1
                fewest = min(fewest, seen["moved"])
                if idle == 2 or since == 8:
                    break
            after = links.modularity(labels, m2)
            if quality is None:
                quality = links.modularity(start, m2)
            if after <= quality + 1e-9:
                break
            quality = after
            step = links.labelled(labels).select(F.col("id").alias("community"), F.col("community").alias("__c"))
            mapping = materialise(mapping.join(step, "community", "left").select(
                "id", F.coalesce("__c", "community").alias("community")))
            edges = materialise(links.contracted(labels))
    return mapping


def community_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("community").agg(F.count(F.lit(1)).alias("size"))


def dense_labels(labels: DataFrame, out: str = "label") -> DataFrame:
    """Number communities 0, 1, ... by size, then id; the table of communities is ranked, not the vertices."""
    from civicframe.operators.scalable import row_number_by

    ranked = row_number_by(community_sizes(labels), [], [F.desc("size"), F.asc("community")], "__r")
    return labels.join(ranked.select("community", (F.col("__r") - 1).cast("int").alias(out)), "community")


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index from the counts of the cross table."""
    cells = df.groupBy(F.col(a).alias("__a"), F.col(b).alias("__b")).agg(F.count(F.lit(1)).alias("n"))

    def choose2(x: Column) -> Column:
        return x * (x - 1) / 2.0

    def side(name):
        sums = cells.groupBy(name).agg(F.sum("n").alias("n"))
        return sums.agg(F.sum(choose2(F.col("n"))).alias(f"s{name}"), F.lit(1).alias("__k"))

    inner = cells.agg(F.sum(choose2(F.col("n"))).alias("same"), F.sum("n").alias("total"), F.lit(1).alias("__k"))
    joined = inner.join(side("__a"), "__k").join(side("__b"), "__k")
    expected = F.col("s__a") * F.col("s__b") / choose2(F.col("total"))
    most = (F.col("s__a") + F.col("s__b")) / 2
    ari = F.when(most == expected, 1.0).otherwise((F.col("same") - expected) / (most - expected))
    return joined.select(F.col("total").alias("n"), ari.alias("ari"))


# ---------------------------------------------------------------- propagation

def normalised_adjacency(g: Graph) -> DataFrame:
    """Entries of D^-1/2 (A + I) D^-1/2, with D the degrees of A + I."""
    loops = g.vertices.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(1.0).alias("w"))
    full = g.edges.select("src", "dst", "w").unionByName(loops)
    deg = full.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("d"))
    ds = deg.select(F.col("id").alias("src"), F.col("d").alias("__s"))
    dd = deg.select(F.col("id").alias("dst"), F.col("d").alias("__d"))
    return full.join(ds, "src").join(dd, "dst").select(
        "src", "dst", (F.col("w") / F.sqrt(F.col("__s") * F.col("__d"))).alias("w"))


def propagate(g: Graph, features: DataFrame, hops: int) -> DataFrame:
    """Features (id, dim, x) averaged over neighbours ``hops`` times with the normalised adjacency."""
    adjacency = materialise(normalised_adjacency(g))
    x = features.select("id", "dim", "x")
    for hop in range(hops):
        pulled = adjacency.join(x.select(F.col("id").alias("src"), "dim", "x"), "src")
        x = pulled.groupBy(F.col("dst").alias("id"), "dim").agg(F.sum(F.col("w") * F.col("x")).alias("x"))
        if hop + 1 < hops:
            x = materialise(x)
    return x


def feature_vectors(features: DataFrame, dims: Sequence) -> DataFrame:
    """Wide array per vertex in a fixed order of dimensions, absent ones 0."""
    cells = [F.coalesce(F.max(F.when(F.col("dim") == d, F.col("x"))), F.lit(0.0)) for d in dims]
    return features.groupBy("id").agg(F.array(*cells).alias("features"))


def exposure(g: Graph, events: DataFrame, node: str, t: str, value: str) -> DataFrame:
    """Weighted events of the neighbours one period earlier: sum over j of w_ij * event_j(t - 1)."""
    totals = events.groupBy(F.col(node).alias("dst"), (F.col(t) + 1).alias("t")).agg(F.sum(value).alias("e"))
    return g.edges.join(totals, "dst").groupBy(F.col("src").alias("id"), "t").agg(
        F.sum(F.col("w") * F.col("e")).alias("exposure"))


def hazard_by_exposure(exposed: DataFrame, events: DataFrame, node: str, t: str, value: str, cut: float) -> DataFrame:
    """Share of (vertex, period) rows with an event, by low and high exposure."""
    now = events.groupBy(F.col(node).alias("id"), F.col(t).alias("t")).agg((F.sum(value) > 0).cast("int").alias("event"))
    rows = exposed.join(now, ["id", "t"], "left").withColumn("high", F.col("exposure") > cut)
    return rows.groupBy("high").agg(F.count(F.lit(1)).alias("n"), F.avg(F.coalesce("event", F.lit(0))).alias("hazard"))
