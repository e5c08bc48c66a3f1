"""Points, polygons, lines and rasters as tables.

A polygon is a closed ring, an array of (x, y). A spatial join covers polygons with grid cells,
joins on the cell, and checks the exact predicate: an equi-join in place of a nested loop.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicframe.operators import scalable
from civicframe.session import materialise

# ---------------------------------------------------------------- geometry


def xy(x, y) -> Column:
    return F.struct(F.lit(x).cast("double").alias("x"), F.lit(y).cast("double").alias("y"))


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Closed ring of a rectangle."""
    return F.array(xy(x0, y0), xy(x1, y0), xy(x1, y1), xy(x0, y1), xy(x0, y0))


def line(*points: tuple) -> Column:
    return F.array(*[xy(x, y) for x, y in points])


def _segments(path: Column, fn) -> Column:
    """fn(start, end) for every segment of a path."""
    starts = F.slice(path, F.lit(1), F.size(path) - 1)
    ends = F.slice(path, F.lit(2), F.size(path) - 1)
    return F.zip_with(starts, ends, fn)


def _crosses(x: Column, y: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Whether an edge crosses the ray to the right of a point, as 0 or 1."""
    at = ax + (y - ay) * (bx - ax) / F.when(by != ay, by - ay)
    return F.when(((ay > y) != (by > y)) & (x < at), 1).otherwise(0)


def _touches(x: Column, y: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Whether a point lies on an edge."""
    inside = x.between(F.least(ax, bx), F.greatest(ax, bx)) & y.between(F.least(ay, by), F.greatest(ay, by))
    return ((bx - ax) * (y - ay) - (by - ay) * (x - ax) == 0) & inside


def within(x: Column, y: Column, ring: Column) -> Column:
    """Strictly inside a ring: odd number of edges to the right, and not on an edge."""
    crossed = _segments(ring, lambda a, b: _crosses(x, y, a["x"], a["y"], b["x"], b["y"]))
    touched = _segments(ring, lambda a, b: _touches(x, y, a["x"], a["y"], b["x"], b["y"]))
    return (F.aggregate(crossed, F.lit(0), lambda s, v: s + v) % 2 == 1) & ~F.exists(touched, lambda v: v)


def _within_edges(x: Column, y: Column, edges: Column) -> Column:
    """The same for the edges (ax, ay, bx, by) that can matter to the points of a cell."""
    crossed = F.transform(edges, lambda e: _crosses(x, y, e["ax"], e["ay"], e["bx"], e["by"]))
    return (F.aggregate(crossed, F.lit(0), lambda s, v: s + v) % 2 == 1) & ~F.exists(
        edges, lambda e: _touches(x, y, e["ax"], e["ay"], e["bx"], e["by"]))


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.sqrt((x0 - x1) * (x0 - x1) + (y0 - y1) * (y0 - y1))


def distance_to_line(x: Column, y: Column, path: Column) -> Column:
    """Distance to the nearest point of a line; <= d is the exact test for its buffer."""

    def to_segment(a, b):
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        length = dx * dx + dy * dy
        t = F.when(length > 0, ((x - a["x"]) * dx + (y - a["y"]) * dy) / length).otherwise(0.0)
        t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
        return distance(x, y, a["x"] + t * dx, a["y"] + t * dy)

    return F.array_min(_segments(path, to_segment))


def extent(path: Column) -> dict[str, Column]:
    xs, ys = F.transform(path, lambda p: p["x"]), F.transform(path, lambda p: p["y"])
    return {"x0": F.array_min(xs), "y0": F.array_min(ys), "x1": F.array_max(xs), "y1": F.array_max(ys)}


def cover(df: DataFrame, path: str, cell: float, margin: float = 0.0) -> DataFrame:
    """One row per grid cell that the extent of a geometry (grown by ``margin``) touches."""
    e = extent(F.col(path))

    def span(lo, hi):
        return F.sequence(F.floor((lo - margin) / cell), F.floor((hi + margin) / cell))

    rows = df.withColumn("__cx", F.explode(span(e["x0"], e["x1"])))
    return rows.withColumn("__cy", F.explode(span(e["y0"], e["y1"])))


# A quadtree cover: a cell is split into FACTOR x FACTOR cells of the next lower level.
FACTOR = 4
COVER = T.StructType([
    T.StructField("__level", T.IntegerType()), T.StructField("__px", T.LongType()), T.StructField("__py", T.LongType()),
    T.StructField("__edges", T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in ("ax", "ay", "bx", "by")])))])


def _cells_with_edges(cells: np.ndarray, of: np.ndarray, edge: np.ndarray, ends: np.ndarray, size: float) -> np.ndarray:
    """Which (cell, edge) pairs intersect; cells are a little larger here, so that none is lost to rounding."""
    room = 1e-9 * size
    x0, y0 = cells[of, 0] * size - room, cells[of, 1] * size - room
    x1, y1 = x0 + size + 2 * room, y0 + size + 2 * room
    ax, ay, bx, by = ends[edge].T
    near = (np.maximum(ax, bx) >= x0) & (np.minimum(ax, bx) <= x1) & (np.maximum(ay, by) >= y0) & (np.minimum(ay, by) <= y1)
    sides = np.stack([(by - ay) * (x - ax) - (bx - ax) * (y - ay) for x in (x0, x1) for y in (y0, y1)])
    return near & (sides.min(axis=0) <= 0) & (sides.max(axis=0) >= 0)


def _inside(cells: np.ndarray, ends: np.ndarray, size: float) -> np.ndarray:
    """Which cells, none of which an edge touches, lie inside: edges to the right of the centre, counted along rows of centres."""
    ax, ay, bx, by = ends.T
    low, high = np.minimum(ay, by), np.maximum(ay, by)
    first = np.ceil(low / size - 0.5).astype(np.int64)
    rows = np.maximum(np.ceil(high / size - 0.5).astype(np.int64) - first, 0)
    of = np.repeat(np.arange(len(ends)), rows)
    row = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows)
    wanted = np.unique(cells[:, 1])
    keep = np.isin(row, wanted)
    of, row = of[keep], row[keep]
    at = ax[of] + ((row + 0.5) * size - ay[of]) * (bx[of] - ax[of]) / (by[of] - ay[of])
    left, right = min(ax.min(), bx.min()) - size, max(ax.max(), bx.max()) + size
    key = lambda r, x: np.searchsorted(wanted, r) + np.clip((x - left) / (right - left), 0, 1) * 0.999
    crossings = np.sort(key(row, at))
    here = np.searchsorted(crossings, key(cells[:, 1], (cells[:, 0] + 0.5) * size), side="right")
    row_end = np.searchsorted(crossings, np.searchsorted(wanted, cells[:, 1]) + 0.9995)
    return (row_end - here) % 2 == 1


def quad_cover(ring: np.ndarray, cell: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cover of a ring (n x 2): (level, x, y) of cells inside, (x, y) of boundary cells of level 0, and (boundary cell, edge) pairs.

    Cells of level k are cell * FACTOR**k wide. A cell that an edge touches is split down to level 0; one that none touches
    is inside or dropped. So the number of cells grows with the boundary. The edges of a boundary cell are those that can
    decide about a point in it: they reach its rows and do not end to the left of it.
    """
    ends = np.concatenate([ring[:-1], ring[1:]], axis=1)
    level = 0
    while np.ptp(ring, axis=0).max() > cell * FACTOR**level:
        level += 1
    size = cell * FACTOR**level
    low, high = np.floor(ring.min(axis=0) / size).astype(np.int64), np.floor(ring.max(axis=0) / size).astype(np.int64)
    cells = np.stack(np.meshgrid(*[np.arange(a, b + 1) for a, b in zip(low, high, strict=True)], indexing="ij"), axis=-1).reshape(-1, 2)
    of, edge = np.repeat(np.arange(len(cells)), len(ends)), np.tile(np.arange(len(ends)), len(cells))
    inner = []
    while True:
        size = cell * FACTOR**level
        hit = _cells_with_edges(cells, of, edge, ends, size)
        of, edge = of[hit], edge[hit]
        split = np.zeros(len(cells), bool)
        split[of] = True
        rest = cells[~split]
        if len(rest):
            rest = rest[_inside(rest, ends, size)]
            inner.append(np.concatenate([np.full((len(rest), 1), level), rest], axis=1))
        place = np.cumsum(split) - 1
        cells, of = cells[split], place[of]
        if not level or not len(cells):
            break
        level -= 1
        steps = np.stack(np.meshgrid(np.arange(FACTOR), np.arange(FACTOR), indexing="ij"), axis=-1).reshape(-1, 2)
        cells = (cells[:, None] * FACTOR + steps[None]).reshape(-1, 2)
        of = (of[:, None] * len(steps) + np.arange(len(steps))[None]).ravel()
        edge = np.repeat(edge, len(steps))
    first = np.floor(np.minimum(ends[:, 1], ends[:, 3]) / cell - 1e-9).astype(np.int64)
    rows = np.floor(np.maximum(ends[:, 1], ends[:, 3]) / cell + 1e-9).astype(np.int64) - first + 1
    edge = np.repeat(np.arange(len(ends)), rows)
    row = first[edge] + np.arange(len(edge)) - np.repeat(np.cumsum(rows) - rows, rows)
    order = np.argsort(row, kind="stable")
    edge, row = edge[order], row[order]
    a, b = np.searchsorted(row, cells[:, 1]), np.searchsorted(row, cells[:, 1], side="right")
    of = np.repeat(np.arange(len(cells)), b - a)
    edge = edge[a[of] + np.arange(len(of)) - np.repeat(np.cumsum(b - a) - (b - a), b - a)]
    matters = np.maximum(ends[edge, 0], ends[edge, 2]) >= cells[of, 0] * cell - 1e-9 * cell
    inside = np.concatenate(inner) if inner else np.zeros((0, 3), np.int64)
    return inside, cells, of[matters], edge[matters]


def cover_polygons(polygons: DataFrame, ring: str, cell: float) -> DataFrame:
    """The columns of ``polygons`` but the ring, for each cell of its cover: __level, __px, __py, and __edges of boundary cells.

    Rings that are null or have fewer than four points, or coordinates that are not finite, cover nothing.
    """
    others = [c for c in polygons.columns if c != ring]
    target = T.StructType([polygons.schema[c] for c in others] + COVER.fields)

    def run(batches):
        for batch in batches:
            for i, points in enumerate(batch[ring]):
                if not points.is_valid or len(points) < 4:
                    continue
                xy_ = np.stack([points.values.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y")], axis=1)
                if not np.isfinite(xy_).all():
                    continue
                inside, border, of, edge = quad_cover(xy_, cell)
                n, m = len(inside), len(border)
                if not n + m:
                    continue
                ends = np.concatenate([xy_[:-1], xy_[1:]], axis=1)[edge]
                edges = pa.StructArray.from_arrays([pa.array(ends[:, k]) for k in range(4)], names=["ax", "ay", "bx", "by"])
                offsets = np.concatenate([np.zeros(n, np.int64), np.searchsorted(of, np.arange(m + 1))])
                missing = pa.array(np.concatenate([np.ones(n, bool), np.zeros(m, bool)]))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), edges, mask=missing)
                kept = batch.select(others).take(pa.array(np.full(n + m, i)))
                yield pa.RecordBatch.from_arrays([
                    *kept.columns, pa.array(np.concatenate([inside[:, 0], np.zeros(m, np.int64)]).astype(np.int32)),
                    pa.array(np.concatenate([inside[:, 1], border[:, 0]])), pa.array(np.concatenate([inside[:, 2], border[:, 1]])), lists],
                    names=target.names)

    return polygons.select(*others, ring).mapInArrow(run, target)


def check_crs(a: DataFrame, b: DataFrame, col: str = "crs") -> None:
    """Fail before a join when two layers do not share one reference system."""
    found = {r[0] for df in (a, b) for r in df.select(col).distinct().limit(3).collect()}
    if len(found) > 1:
        raise ValueError(f"layers use different reference systems: {sorted(map(str, found))}")


#: Points of a cell from which on they are dealt into several chunks.
CROWDED = 20_000


def _cell_join(points: DataFrame, cells: DataFrame, keys: Sequence[str], test: Column, how: str) -> DataFrame:
    """Join points, which have ``keys``, to the shapes of their cell that pass the test. ``cells`` has the keys too.

    The points of a crowded cell are dealt into chunks, and its shapes copied to each; without a crowded cell it is a plain
    join. A shape occurs once per cell and chunk, a point has one of each, so a pair is found once.
    """
    own = {k: f"{k}_shape" for k in keys}
    crowded = materialise(points.groupBy(*keys).count().where(F.col("count") > CROWDED).select(
        *keys, F.ceil(F.col("count") / CROWDED).cast("int").alias("__n")))
    if not crowded.isEmpty():
        keys = [*keys, "__chunk"]
        own["__chunk"] = "__chunk_shape"
        many = F.coalesce("__n", F.lit(1))
        dealt = F.pmod(F.xxhash64(*[F.col(c) for c in points.columns]), many).cast("int")
        points = points.join(crowded, keys[:-1], "left").withColumn("__chunk", dealt).drop("__n")
        cells = cells.join(crowded, keys[:-1], "left").withColumn("__chunk", F.explode(F.sequence(F.lit(0), many - 1))).drop("__n")
    right = cells.withColumnsRenamed(own)
    on = test
    for k in keys:
        on = on & (F.col(k) == F.col(own[k]))
    return points.join(right, on, how).drop(*keys, *own.values())


def points_in_polygons(points: DataFrame, polygons: DataFrame, ring: str, cell: float, x="x", y="y", how="left") -> DataFrame:
    """Join points to the polygons they lie within, but for the ring's column; with ``left`` unmatched points stay.

    Polygons are covered by a quadtree (:func:`quad_cover`): a point in an inner cell needs no test, one in a boundary cell is
    tested against the edges that matter there. A point is looked up once for each level that the cover has.
    """
    cover_ = materialise(cover_polygons(polygons, ring, cell))
    levels = sorted(r[0] for r in cover_.select("__level").distinct().collect()) or [0]  # a few numbers
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    test = F.col("__edges").isNull() | _within_edges(px, py, F.col("__edges"))

    def located(rows: DataFrame) -> DataFrame:
        at = [F.struct(F.lit(k).alias("__l"), F.floor(px / (cell * FACTOR**k)).alias("__cx"), F.floor(py / (cell * FACTOR**k)).alias("__cy")) for k in levels]
        if len(levels) == 1:
            return rows.withColumns({c: at[0][c] for c in ("__l", "__cx", "__cy")})
        return rows.withColumn("__at", F.explode(F.array(*at))).select("*", "__at.*").drop("__at")

    shapes = cover_.withColumnsRenamed({"__level": "__l", "__px": "__cx", "__py": "__cy"})
    keys = ["__l", "__cx", "__cy"]
    if how != "left" or len(levels) == 1:
        return _cell_join(located(points), shapes, keys, test, how).drop("__edges")
    # A point looked up on several levels must stay once if none has a match.
    numbered = materialise(points.withColumn("__row", F.monotonically_increasing_id()))
    found = materialise(_cell_join(located(numbered), shapes, keys, test, "inner").drop("__edges"))
    rest = numbered.join(found.select("__row").distinct(), "__row", "left_anti")
    return found.drop("__row").unionByName(rest.drop("__row"), allowMissingColumns=True)


def points_near_lines(points: DataFrame, lines: DataFrame, path: str, d: float, cell: float, x="x", y="y", how="left") -> DataFrame:
    """Join points to the lines whose buffer of ``d`` contains them."""
    test = distance_to_line(F.col(x).cast("double"), F.col(y).cast("double"), F.col(path)) <= d
    keys = ["__cx", "__cy"]
    located = points.withColumns({"__cx": F.floor(F.col(x).cast("double") / cell), "__cy": F.floor(F.col(y).cast("double") / cell)})
    return _cell_join(located, cover(lines, path, cell, margin=d), keys, test, how)


#: Rows of a crowded cell that meet on either side at a time.
ROWS_PER_SALT = 2_000


def _near_cells(a: DataFrame, b: DataFrame, d: float, a_xy, b_xy) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides in cells of width d, the second copied to its nine neighbours, crowded cells split; and the columns on which they meet."""
    ax, ay, bx, by = (F.col(c) for c in (*a_xy, *b_xy))
    shifts = F.sequence(F.lit(-1), F.lit(1))
    left = a.withColumns({"__cx": F.floor(ax / d), "__cy": F.floor(ay / d)})
    right = b.withColumn("__sx", F.explode(shifts)).withColumn("__sy", F.explode(shifts))
    right = right.withColumns({"__cx": F.floor(bx / d) + F.col("__sx"), "__cy": F.floor(by / d) + F.col("__sy")}).drop("__sx", "__sy")
    return scalable.salted(left, right, ["__cx", "__cy"], ROWS_PER_SALT)


def distance_join(a: DataFrame, b: DataFrame, d: float, a_xy=("ax", "ay"), b_xy=("bx", "by")) -> DataFrame:
    """All pairs at most ``d`` apart: cells of width d, the second side copied to its nine neighbours, crowded cells split on both sides."""
    ax, ay, bx, by = (F.col(c) for c in (*a_xy, *b_xy))
    left, right, on = _near_cells(a, b, d, a_xy, b_xy)
    left, right = scalable.dealt_out(left, right, on)
    pairs = left.join(right, on).drop(*on)
    return pairs.withColumn("distance", distance(ax, ay, bx, by)).filter(F.col("distance") <= d)


def neighbourhood(a: DataFrame, key: str, b: DataFrame, d: float, weight: str | None = None) -> DataFrame:
    """Per point of ``a``: number of ``b`` within ``d`` and their exposure sum of weight / (1 + distance).

    The points of a cell meet as matrices, and each leaves with its sums; no pair becomes a row.
    """
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    weighed = a.withColumn("__w", w) if weight in a.columns else b.withColumn("__w", w)
    one, other = (weighed, b) if weight in a.columns else (a, weighed)
    number = lambda df, *names: [F.col(c).cast("double").alias(c) for c in names] + [c for c in df.columns if c == "__w"]
    left, right, on = _near_cells(one.select(F.col(key).alias("__k"), *number(one, "ax", "ay")), other.select(*number(other, "bx", "by")),
                                  d, ("ax", "ay"), ("bx", "by"))
    located = " AND ".join(f"{c} IS NOT NULL" for c in on)
    kind = a.schema[key].dataType
    schema = T.StructType([T.StructField("__k", kind), T.StructField("n", T.LongType()), T.StructField("e", T.DoubleType()),
                           T.StructField("m", T.DoubleType())])

    def sums(here: pa.Table, there: pa.Table) -> pa.Table:
        ax, ay = here["ax"].to_numpy(), here["ay"].to_numpy()
        bx, by = there["bx"].to_numpy(), there["by"].to_numpy()
        own, their = (t["__w"].to_numpy() if "__w" in t.column_names else None for t in (here, there))
        n, e, m = np.zeros(len(ax), np.int64), np.zeros(len(ax)), np.full(len(ax), np.inf)
        for i in range(0, len(ax), 256):
            at = slice(i, i + 256)
            for j in range(0, len(bx), ROWS_PER_SALT):
                to = slice(j, j + ROWS_PER_SALT)
                gap = np.sqrt((ax[at, None] - bx[None, to]) ** 2 + (ay[at, None] - by[None, to]) ** 2)
                near = gap <= d
                n[at] += near.sum(axis=1)
                share = (own[at, None] if own is not None else their[None, to]) / (1.0 + gap)
                e[at] += np.where(near, share, 0.0).sum(axis=1)
                m[at] = np.minimum(m[at], np.where(near, gap, np.inf).min(axis=1))
        hit = np.flatnonzero(n)
        return pa.table([here["__k"].take(pa.array(hit)), pa.array(n[hit]), pa.array(e[hit]), pa.array(m[hit])], names=schema.names)

    left, right = scalable.dealt_out(left.filter(located), right.filter(located), on)
    met = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(sums, schema)
    near = met.groupBy(F.col("__k").alias(key)).agg(F.sum("n").alias("n_near"), F.sum("e").alias("exposure"), F.min("m").alias("nearest"))
    return a.join(near, key, "left").withColumns({
        "n_near": F.coalesce("n_near", F.lit(0)), "exposure": F.coalesce("exposure", F.lit(0.0))})


# ---------------------------------------------------------------- reference systems

# WGS 84 and its spherical web projection.
EARTH_RADIUS = 6378137.0
FLATTENING = 1 / 298.257223563
UTM_SCALE, UTM_EASTING, UTM_NORTHING = 0.9996, 500000.0, 10000000.0

_N = FLATTENING / (2 - FLATTENING)
_RECTIFYING = EARTH_RADIUS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def to_web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return (EARTH_RADIUS * F.radians(lon), EARTH_RADIUS * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)))


def from_web_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / EARTH_RADIUS), F.degrees(2 * F.atan(F.exp(y / EARTH_RADIUS)) - math.pi / 2)


def _atanh(x: Column) -> Column:
    return 0.5 * F.log((1 + x) / (1 - x))


def to_utm(lon: Column, lat: Column, zone: int, south: bool = False) -> tuple[Column, Column]:
    """Transverse Mercator by the Krueger series, third order."""
    root = 2 * math.sqrt(_N) / (1 + _N)
    phi, lam = F.radians(lat), F.radians(lon - F.lit(zone * 6 - 183.0))
    t = F.sinh(_atanh(F.sin(phi)) - root * _atanh(root * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), _atanh(F.sin(lam) / F.sqrt(1 + t * t))
    e, n = eta, xi
    for j, a in enumerate(_ALPHA, start=1):
        e = e + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        n = n + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return (UTM_EASTING + UTM_SCALE * _RECTIFYING * e, (UTM_NORTHING if south else 0.0) + UTM_SCALE * _RECTIFYING * n)


def from_utm(x: Column, y: Column, zone: int, south: bool = False) -> tuple[Column, Column]:
    xi = (y - (UTM_NORTHING if south else 0.0)) / (UTM_SCALE * _RECTIFYING)
    eta = (x - UTM_EASTING) / (UTM_SCALE * _RECTIFYING)
    a, b = xi, eta
    for j, c in enumerate(_BETA, start=1):
        a = a - c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        b = b - c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(a) / F.cosh(b))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + d * F.sin(2 * j * chi)
    return F.lit(zone * 6 - 183.0) + F.degrees(F.atan2(F.sinh(b), F.cos(a))), F.degrees(phi)


def _utm_zone(code: str) -> tuple[int, bool] | None:
    digits = code.removeprefix("EPSG:")
    if len(digits) == 5 and digits[:3] in ("326", "327") and 1 <= int(digits[3:]) <= 60:
        return int(digits[3:]), digits[:3] == "327"
    return None


def reproject(df: DataFrame, x: str, y: str, source: str, target: str) -> DataFrame:
    """Replace coordinates; EPSG:4326, EPSG:3857 and the UTM zones are known, others are refused."""
    a, b = F.col(x), F.col(y)
    if source == target:
        return df
    if source == "EPSG:3857":
        a, b = from_web_mercator(a, b)
    elif _utm_zone(source):
        a, b = from_utm(a, b, *_utm_zone(source))
    elif source != "EPSG:4326":
        raise ValueError(f"unknown reference system {source}")
    if target == "EPSG:3857":
        a, b = to_web_mercator(a, b)
    elif _utm_zone(target):
        a, b = to_utm(a, b, *_utm_zone(target))
    elif target != "EPSG:4326":
        raise ValueError(f"unknown reference system {target}")
    return df.withColumns({x: a, y: b})


# ---------------------------------------------------------------- rasters

def pixel_xy(transform: Sequence[float], row: Column, col: Column, centre: bool = True) -> tuple[Column, Column]:
    """World coordinates of a pixel under the affine (a, b, c, d, e, f)."""
    a, b, c, d, e, f = (float(v) for v in transform)
    half = 0.5 if centre else 0.0
    cx, cy = col + half, row + half
    return c + a * cx + b * cy, f + d * cx + e * cy


def raster_window(pixels: DataFrame, transform: Sequence[float], row0: int, col0: int, height: int, width: int) -> DataFrame:
    """Pixels of a window, renumbered from its corner, with world coordinates of their upper left corner."""
    part = pixels.filter(F.col("row").between(row0, row0 + height - 1) & F.col("col").between(col0, col0 + width - 1))
    x, y = pixel_xy(transform, F.col("row"), F.col("col"), centre=False)
    return part.withColumns({"x": x, "y": y}).withColumns({"row": F.col("row") - row0, "col": F.col("col") - col0})


def raster_bounds(pixels: DataFrame, transform: Sequence[float], by: Sequence[str] = ("raster_id",)) -> DataFrame:
    """Size and bounds per raster, from one aggregation."""
    a, b, c, d, e, f = (float(v) for v in transform)
    sizes = pixels.groupBy(*by).agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))
    corners = [(F.lit(0), F.lit(0)), (F.col("width"), F.lit(0)), (F.lit(0), F.col("height")), (F.col("width"), F.col("height"))]
    xs = [c + a * u + b * v for u, v in corners]
    ys = [f + d * u + e * v for u, v in corners]
    return sizes.withColumns({"left": F.least(*xs), "bottom": F.least(*ys), "right": F.greatest(*xs), "top": F.greatest(*ys)})


def scale_by_max(pixels: DataFrame, value: str, by: Sequence[str] = ("raster_id",)) -> DataFrame:
    """value / max(largest value of the raster, 1)."""
    tops = pixels.groupBy(*by).agg(F.greatest(F.max(value), F.lit(1.0)).alias("__top"))
    return pixels.join(tops, list(by)).withColumn("scaled", F.col(value) / F.col("__top")).drop("__top")


def rasterize(pixels: DataFrame, polygons: DataFrame, ring: str, transform: Sequence[float], cell: float,
              burn: str, identity: str, order: str, instance_class: int) -> DataFrame:
    """Burn polygons into the pixels of every raster whose centre they contain.

    The class is the largest one that covers the pixel. The instance is the last shape in ``order`` among those of
    ``instance_class``: shapes of other classes have no instances. Uncovered pixels get 0.
    """
    x, y = pixel_xy(transform, F.col("row"), F.col("col"))
    keys = ["raster_id", "row", "col"]
    located = pixels.select(*keys).withColumns({"x": x, "y": y})
    hit = points_in_polygons(located, polygons.select(burn, identity, order, ring), ring, cell)
    return hit.groupBy(*keys).agg(
        F.coalesce(F.max(burn), F.lit(0)).alias("class"),
        F.coalesce(F.max_by(identity, F.when(F.col(burn) == instance_class, F.col(order))), F.lit(0)).alias("instance"))


def connected_labels(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest vertex id of each component, by contraction.

    Every vertex points at the smallest vertex among itself and its neighbours, then at the target
    of its target; vertices with the same target merge, and the edges that remain between different
    vertices form the next, smaller graph. It ends when no edge is left.
    """
    ends = F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))))
    rest = materialise(edges.filter("src <> dst").select(ends.alias("e")).select("e.*").distinct())
    labels = vertices.select("id", F.col("id").alias("label"))
    while not rest.isEmpty():
        low = rest.groupBy("src").agg(F.min("dst").alias("__m"))
        first = materialise(low.select(F.col("src").alias("id"), F.least("src", "__m").alias("to")))
        second = first.select(F.col("id").alias("to"), F.col("to").alias("__to2"))
        target = materialise(first.join(second, "to").select("id", F.least("to", "__to2").alias("to")))
        labels = materialise(labels.join(target.select(F.col("id").alias("label"), "to"), "label", "left").select(
            "id", F.coalesce("to", "label").alias("label")))
        src = target.select(F.col("id").alias("src"), F.col("to").alias("a"))
        dst = target.select(F.col("id").alias("dst"), F.col("to").alias("b"))
        rest = materialise(rest.join(src, "src").join(dst, "dst").filter("a <> b").select(
            F.col("a").alias("src"), F.col("b").alias("dst")).distinct())
    return labels


#: Rows and columns of a tile, inside which components are found in one task.
TILE = 256


def _first_pixels(row: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the first pixel of each pixel's 4-connected component: runs along rows, merged where runs touch.

    Every run hooks to the smallest run that it touches, and pointers are followed to their ends, until touching runs agree.
    """
    order = np.lexsort((col, row))
    r, c = row[order], col[order]
    start = np.ones(len(r), bool)
    start[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1] + 1)
    run = np.cumsum(start) - 1
    width = int(c.max()) + 2
    place = r * width + c
    below = np.searchsorted(place, place + width)
    at = np.flatnonzero((below < len(place)) & (place[np.minimum(below, len(place) - 1)] == place + width))
    pairs = np.unique(np.stack([run[at], run[below[at]]], axis=1), axis=0)
    parent = np.arange(run[-1] + 1)
    while True:
        a, b = parent[pairs[:, 0]], parent[pairs[:, 1]]
        if (a == b).all():
            break
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent != parent[parent]).any():
            parent = parent[parent]
    heads = np.flatnonzero(start)[parent[run]]
    first = np.empty(len(order), np.int64)
    first[order] = heads
    return r[first], c[first]


def components(pixels: DataFrame, mask: Column, tile: int = TILE) -> DataFrame:
    """4-connected components of the mask pixels of each raster: (raster_id, row, col, component), named by their first pixel.

    Components are found inside tiles. Those that touch the border of a tile are linked to what they touch on the other side, and
    only they go through the rounds of :func:`connected_labels`, so what is shuffled there grows with the borders.
    """
    kinds = {c: pixels.schema[c].dataType for c in ("raster_id", "row", "col")}
    out = T.StructType([T.StructField(c, k) for c, k in kinds.items()] + [T.StructField("__r", kinds["row"]), T.StructField("__c", kinds["col"])])

    def labelled(table: pa.Table) -> pa.Table:
        row, col = (table[c].to_numpy().astype(np.int64) for c in ("row", "col"))
        r, c = _first_pixels(row - row.min(), col - col.min())
        kept = table.select(["raster_id", "row", "col"])
        return kept.append_column("__r", pa.array(r + row.min(), table["row"].type)).append_column("__c", pa.array(c + col.min(), table["col"].type))

    on = pixels.filter(mask).select("raster_id", "row", "col").distinct()
    tiles = on.withColumns({"__tr": F.floor(F.col("row") / tile), "__tc": F.floor(F.col("col") / tile)})
    local = materialise(tiles.groupBy("raster_id", "__tr", "__tc").applyInArrow(labelled, out))
    label = F.struct("raster_id", F.col("__r").alias("row"), F.col("__c").alias("col"))
    border = local.where((F.pmod("row", F.lit(tile)).isin(0, tile - 1)) | (F.pmod("col", F.lit(tile)).isin(0, tile - 1))).select(
        "raster_id", "row", "col", label.alias("own"))
    right = border.where(F.pmod("col", F.lit(tile)) == 0).select("raster_id", "row", (F.col("col") - 1).alias("col"), F.col("own").alias("dst"))
    under = border.where(F.pmod("row", F.lit(tile)) == 0).select("raster_id", (F.col("row") - 1).alias("row"), "col", F.col("own").alias("dst"))
    links = materialise(border.withColumnRenamed("own", "src").join(right.unionByName(under), ["raster_id", "row", "col"]).select("src", "dst").distinct())
    touching = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    merged = connected_labels(touching, links).where("label <> id")
    joined = local.withColumn("id", label).join(merged, "id", "left")
    return joined.select("raster_id", "row", "col", F.coalesce("label", "id").alias("component"))


def instances(labelled: DataFrame, limit=None) -> DataFrame:
    """Number the components of each raster 1, 2, ... in order of their first pixel; only components are ranked."""
    from civicframe.operators.scalable import row_number_by

    numbers = row_number_by(labelled.select("raster_id", "component").distinct(), ["raster_id"], ["component"], "instance", limit)
    return labelled.join(numbers, ["raster_id", "component"]).select("raster_id", "row", "col", "instance")


def panoptic(cls: Column, instance: Column) -> Column:
    """0 background, 1000 road, 2000 + instance for buildings."""
    return F.when(cls == 2, 2000 + instance).when(cls == 1, F.lit(1000)).otherwise(F.lit(0))


def segmentation_scores(df: DataFrame, truth: str, predicted: str, classes: Sequence[int]) -> DataFrame:
    """Pixel accuracy and intersection over union of each class, from one aggregation."""
    t, p = F.col(truth), F.col(predicted)
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(t == p).alias("hit")]
    rows = []
    for c in classes:
        aggs += [F.count_if((t == c) & (p == c)).alias(f"i{c}"), F.count_if((t == c) | (p == c)).alias(f"u{c}")]
        rows.append(F.struct(F.lit(c).alias("class"), F.try_divide(F.col(f"i{c}"), F.col(f"u{c}")).alias("iou"), (F.col("hit") / F.col("n")).alias("accuracy")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
