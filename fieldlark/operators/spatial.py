"""Points in regions: ear-clipped triangles under bounding-volume hierarchies.

Region rows are dealt over the cluster and triangulated in parallel (no geometry library).
Up to ``BLOCK`` triangles (a checked size, at most 10 MB) are broadcast, and the points pass
by in Arrow batches without a shuffle; each Python worker builds the hierarchy once. More
triangles never leave the executors: every triangle lies in at most four cells of the level
of a nested grid that fits its size, every point in one cell of each level in use, and the
two meet by cell. Cells with many points are salted, cells with many triangles divided into
blocks of at most ``BLOCK``, so that no task grows with the data, and each task builds the
hierarchy of its triangles. Either way boxes come first, then an exact orientation test of
the candidate triangles, in floating point with an error bound and in rational numbers where
that bound does not settle the sign. A region's several rows, its shared inner edges and
overlapping parts are then deduplicated per point.

Defined results
- A point on an edge of a triangle counts as inside it; a point on a shared border of two
  regions lies in both. Holes are outside (their open interior).
- A point in several regions gives one row for each region code.
- NULL or unusable coordinates: no row. Regions whose code or geometry is NULL, blank or
  not readable: no row; ``unusable_regions`` lists them. A polygon that cannot be clipped
  holds the points on its edges and those with an odd number of edges to one side.
- Repeated points are separate rows as long as their ids differ. Empty tables: empty result.
- Longitudes are not wrapped: regions over the date line come as parts on both sides.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlark.session import cut

BLOCK = 200_000
# Points of one cell that meet in one task, where points are dealt by cells.
TOGETHER = 200_000
# Levels of the grid: cells of 360 / 2**level degrees.
LEVELS = (0, 2, 4, 6, 8, 10, 12, 14, 16)
LEAF = 4
EPS = 2.0**-53
ORIENT_BOUND = (3 + 16 * EPS) * EPS
_TOKEN = re.compile(r"\s*([(),]|[^\s(),]+)")

Point = tuple[float, float]
Ring = list[Point]


# ---------------------------------------------------------------- reading WKT


def parse_wkt(text: str | None) -> list[list[Ring]]:
    """Polygons, each a list of rings, of POLYGON or MULTIPOLYGON text. ValueError if unreadable."""
    if text is None or not text.strip():
        raise ValueError("no geometry")
    body = re.sub(r"^\s*SRID=\d+;", "", text, flags=re.I)
    head = re.match(r"\s*(MULTIPOLYGON|POLYGON)\s*(Z|M|ZM)?\s*(?=\(|EMPTY)", body, re.I)
    if not head:
        raise ValueError("not a polygon")
    rest = body[head.end() :]
    if rest.strip().upper() == "EMPTY":
        return []
    tokens = _TOKEN.findall(rest)
    at = 0

    def nested() -> list:
        nonlocal at
        if tokens[at] != "(":
            raise ValueError("expected (")
        at += 1
        items: list = []
        if tokens[at] == "(":
            while True:
                items.append(nested())
                if tokens[at] == ",":
                    at += 1
                    continue
                break
        else:
            pair: list[float] = []
            while True:
                if tokens[at] in (",", ")"):
                    if len(pair) < 2 or not all(map(math.isfinite, pair)):
                        raise ValueError("bad coordinate")
                    items.append((pair[0], pair[1]))
                    pair = []
                    if tokens[at] == ")":
                        break
                else:
                    pair.append(float(tokens[at]))
                at += 1
        if tokens[at] != ")":
            raise ValueError("expected )")
        at += 1
        return items

    try:
        shape = nested()
    except IndexError as e:
        raise ValueError("cut off") from e
    if at != len(tokens):
        raise ValueError("text after the geometry")
    return shape if head[1].upper() == "MULTIPOLYGON" else [shape]


# ---------------------------------------------------------------- exact signs


def side(a: Point, b: Point, c: Point) -> int:
    """The exact sign of the turn a, b, c: 1 left, -1 right, 0 straight."""
    left, right = (a[0] - c[0]) * (b[1] - c[1]), (a[1] - c[1]) * (b[0] - c[0])
    det = left - right
    if abs(det) > ORIENT_BOUND * (abs(left) + abs(right)):
        return 1 if det > 0 else -1
    ax, ay, bx, by, cx, cy = map(Fraction, (*a, *b, *c))
    exact = (ax - cx) * (by - cy) - (ay - cy) * (bx - cx)
    return (exact > 0) - (exact < 0)


def sides(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> np.ndarray:
    """``side`` of many triples; only those within the error bound go to rational numbers."""
    left, right = (ax - cx) * (by - cy), (ay - cy) * (bx - cx)
    det = left - right
    out = np.sign(det).astype(np.int8)
    for i in np.flatnonzero(np.abs(det) <= ORIENT_BOUND * (np.abs(left) + np.abs(right))):
        out[i] = side((ax[i], ay[i]), (bx[i], by[i]), (cx[i], cy[i]))
    return out


# ---------------------------------------------------------------- ear clipping


def _area2(ring: Ring) -> float:
    return math.fsum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True))


def _clean(ring: Ring) -> Ring:
    """The ring without its closing point and without repeated neighbours."""
    out: Ring = []
    for p in ring:
        if not out or p != out[-1]:
            out.append(p)
    while len(out) > 1 and out[0] == out[-1]:
        out.pop()
    return out


def _blocked(p: Point, q: Point, ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray) -> bool:
    """Whether some edge a-b keeps p from seeing q (touching counts, except at p and q themselves)."""
    low_x, high_x, low_y, high_y = min(p[0], q[0]), max(p[0], q[0]), min(p[1], q[1]), max(p[1], q[1])
    near = np.flatnonzero((np.minimum(ax, bx) <= high_x) & (np.maximum(ax, bx) >= low_x) & (np.minimum(ay, by) <= high_y) & (np.maximum(ay, by) >= low_y))
    ax, ay, bx, by = ax[near], ay[near], bx[near], by[near]
    one = lambda v: np.full(len(near), v, float)
    px, py, qx, qy = map(one, (*p, *q))
    s1, s2, s3, s4 = sides(px, py, qx, qy, ax, ay), sides(px, py, qx, qy, bx, by), sides(ax, ay, bx, by, px, py), sides(ax, ay, bx, by, qx, qy)

    def within(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        ends = ((x == p[0]) & (y == p[1])) | ((x == q[0]) & (y == q[1]))
        return ~ends & (x >= low_x) & (x <= high_x) & (y >= low_y) & (y <= high_y)

    return bool((((s1 * s2 < 0) & (s3 * s4 < 0)) | ((s1 == 0) & within(ax, ay)) | ((s2 == 0) & within(bx, by))).any())


def _opens_to(prev: Point, at: Point, nxt: Point, to: Point) -> bool:
    """Whether the inner angle of a counter-clockwise corner faces ``to``."""
    if side(prev, at, nxt) > 0:
        return side(prev, at, to) > 0 and side(at, nxt, to) > 0
    return not (side(prev, at, to) <= 0 and side(at, nxt, to) <= 0)


def _bridge(outer: Ring, holes: list[Ring]) -> Ring:
    """One ring that runs into each hole and back over a two-way cut."""
    waiting = sorted(holes, key=lambda h: -max(h)[0])
    ring = outer
    while waiting:
        hole = waiting.pop(0)
        k = max(range(len(hole)), key=lambda i: hole[i])
        start = hole[k]
        rings = [np.array(r, float) for r in (ring, hole, *waiting)]
        a, b = np.concatenate(rings), np.concatenate([np.roll(r, -1, axis=0) for r in rings])
        edges = a[:, 0], a[:, 1], b[:, 0], b[:, 1]
        order = np.argsort(((rings[0] - np.array(start)) ** 2).sum(1), kind="stable")
        for i in map(int, order):
            v = ring[i]
            if v != start and not _opens_to(ring[i - 1], v, ring[(i + 1) % len(ring)], start):
                continue
            if v == start or not _blocked(start, v, *edges):
                ring = ring[: i + 1] + hole[k:] + hole[: k + 1] + ring[i:]
                break
        else:
            raise ValueError("a hole sees no outer corner")
    return ring


class _Corners:
    """The corners of a ring by the cells of a square grid, so that those in a small box are found
    without looking at all; boxes over many rows of cells are looked for in all that are alive."""

    FEW, ROWS = 1_000, 48

    def __init__(self, xs: np.ndarray, ys: np.ndarray) -> None:
        self.xs, self.ys, self.alive = xs, ys, np.ones(len(xs), bool)
        self.n = 1 if len(xs) < self.FEW else min(1_024, math.isqrt(len(xs)))
        self.low = float(xs.min()), float(ys.min())
        self.step = [max(float(np.ptp(v)), 1e-300) / self.n for v in (xs, ys)]
        cell = self._at(ys, 1) * self.n + self._at(xs, 0)
        self.order = np.argsort(cell, kind="stable")
        self.starts = np.searchsorted(cell[self.order], np.arange(self.n * self.n + 1))

    def _at(self, v: np.ndarray | float, axis: int) -> np.ndarray:
        return np.clip(np.floor((np.asarray(v) - self.low[axis]) / self.step[axis]), 0, self.n - 1).astype(np.int64)

    def within(self, low_x: float, high_x: float, low_y: float, high_y: float) -> np.ndarray:
        """The corners that are still there, inside a box or on its edge."""
        if self.n > 1:
            c0, c1, r0, r1 = int(self._at(low_x, 0)), int(self._at(high_x, 0)), int(self._at(low_y, 1)), int(self._at(high_y, 1))
            if r1 - r0 < self.ROWS:
                near = np.concatenate([self.order[self.starts[r * self.n + c0] : self.starts[r * self.n + c1 + 1]] for r in range(r0, r1 + 1)])
                near = np.sort(near)
                x, y = self.xs[near], self.ys[near]
                return near[self.alive[near] & (x >= low_x) & (x <= high_x) & (y >= low_y) & (y <= high_y)]
        return np.flatnonzero(self.alive & (self.xs >= low_x) & (self.xs <= high_x) & (self.ys >= low_y) & (self.ys <= high_y))


def ear_clip(rings: list[Ring]) -> np.ndarray:
    """Triangles (n, 6) that tile an outer ring less its holes. ValueError if the rings can't be clipped."""
    shells = [r for r in map(_clean, rings) if len(r) >= 3]
    if not shells or _area2(shells[0]) == 0:
        return np.empty((0, 6))
    outer = shells[0] if _area2(shells[0]) > 0 else shells[0][::-1]
    holes = [h if _area2(h) < 0 else h[::-1] for h in shells[1:] if _area2(h) != 0]
    ring = _bridge(outer, holes)
    want = _area2(outer) + sum(map(_area2, holes))
    n = len(ring)
    xs, ys = np.array([p[0] for p in ring]), np.array([p[1] for p in ring])
    before, after = list(range(-1, n - 1)), [*range(1, n), 0]
    before[0] = n - 1
    corners_of = _Corners(xs, ys)
    out = []
    left, i, idle = n, 0, 0
    while left > 3:
        a, c = before[i], after[i]
        turn = side(ring[a], ring[i], ring[c])
        ear = turn == 0
        if turn > 0:
            lo_x, hi_x = sorted((xs[a], xs[i], xs[c]))[::2]
            lo_y, hi_y = sorted((ys[a], ys[i], ys[c]))[::2]
            near = corners_of.within(lo_x, hi_x, lo_y, hi_y)
            corners = (ring[a], ring[i], ring[c])
            ear = not any(
                side(corners[0], corners[1], ring[j]) >= 0 and side(corners[1], corners[2], ring[j]) >= 0 and side(corners[2], corners[0], ring[j]) >= 0
                for j in near
                if ring[j] not in corners
            )
        if ear:
            if turn > 0:
                out.append((*ring[a], *ring[i], *ring[c]))
            after[a], before[c], corners_of.alive[i] = c, a, False
            left, idle, i = left - 1, 0, after[c]
        else:
            i, idle = c, idle + 1
            if idle > left:
                raise ValueError("no ear left: the ring crosses itself")
    a, c = before[i], after[i]
    if side(ring[a], ring[i], ring[c]) > 0:
        out.append((*ring[a], *ring[i], *ring[c]))
    found = np.array(out, float).reshape(-1, 6)
    got = float(np.sum((found[:, 2] - found[:, 0]) * (found[:, 5] - found[:, 1]) - (found[:, 4] - found[:, 0]) * (found[:, 3] - found[:, 1])))
    if abs(got - want) > 1e-9 * max(1.0, abs(want)):
        raise ValueError("the triangles don't add up to the polygon")
    return found


# ---------------------------------------------------------------- hierarchy


class Hierarchy:
    """Boxes over triangles as flat arrays: node k has the children 2k+1 and 2k+2."""

    def __init__(self, triangles: np.ndarray, codes: np.ndarray) -> None:
        n = len(triangles)
        self.depth = max(0, math.ceil(math.log2(max(1, n / LEAF))))
        leaves = 1 << self.depth
        order = np.arange(n)
        groups = [order]
        for level in range(self.depth):
            halves = []
            for g in groups:
                if len(g) > 1:
                    t = triangles[g]
                    mid_x, mid_y = t[:, ::2].mean(1), t[:, 1::2].mean(1)
                    by = mid_x if np.ptp(mid_x) >= np.ptp(mid_y) else mid_y
                    g = g[np.argsort(by, kind="stable")]
                halves += [g[: (len(g) + 1) // 2], g[(len(g) + 1) // 2 :]]
            groups = halves
        order = np.concatenate(groups) if groups else order
        self.starts = np.concatenate([[0], np.cumsum([len(g) for g in groups])])
        self.triangles, self.codes = triangles[order], codes[order]
        boxes = np.tile(np.array([np.inf, np.inf, -np.inf, -np.inf]), (2 * leaves - 1, 1))
        for k in range(leaves):
            t = self.triangles[self.starts[k] : self.starts[k + 1]]
            if len(t):
                boxes[leaves - 1 + k] = t[:, ::2].min(), t[:, 1::2].min(), t[:, ::2].max(), t[:, 1::2].max()
        for k in range(leaves - 2, -1, -1):
            a, b = boxes[2 * k + 1], boxes[2 * k + 2]
            boxes[k] = *np.minimum(a[:2], b[:2]), *np.maximum(a[2:], b[2:])
        self.boxes, self.leaves = boxes, leaves

    def find(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (position of the point, code of a region row that holds it)."""
        point, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for level in range(self.depth + 1):
            b = self.boxes[node]
            px, py = x[point], y[point]
            hit = (px >= b[:, 0]) & (px <= b[:, 2]) & (py >= b[:, 1]) & (py <= b[:, 3])
            point, node = point[hit], node[hit]
            if level < self.depth:
                point, node = np.repeat(point, 2), np.repeat(2 * node + 1, 2)
                node[1::2] += 1
        leaf = node - (self.leaves - 1)
        count = self.starts[leaf + 1] - self.starts[leaf]
        point = np.repeat(point, count)
        first = np.repeat(self.starts[leaf] - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else count, count)
        tri = first + np.arange(len(point))
        t, px, py = self.triangles[tri], x[point], y[point]
        a, b, c = (t[:, 0], t[:, 1]), (t[:, 2], t[:, 3]), (t[:, 4], t[:, 5])
        keep = np.ones(len(point), bool)
        for p, q in ((a, b), (b, c), (c, a)):
            k = np.flatnonzero(keep)
            keep[k] = sides(p[0][k], p[1][k], q[0][k], q[1][k], px[k], py[k]) >= 0
        return point[keep], self.codes[tri[keep]]


# ---------------------------------------------------------------- operators


_COLUMNS = ["code", "x1", "y1", "x2", "y2", "x3", "y3", "problem", "rings"]


def _clip_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for code, geom in zip(pdf["code"], pdf["geom"], strict=True):
            try:
                polygons = parse_wkt(geom)
            except ValueError as e:
                rows.append((code, *[None] * 6, str(e), None))
                continue
            for rings in polygons:
                try:
                    tri = ear_clip(rings)
                except ValueError as e:
                    rows.append((code, *[None] * 6, str(e), json.dumps(rings)))
                    continue
                rows += [(code, *t, None, None) for t in tri.tolist()]
        yield pd.DataFrame(rows, columns=_COLUMNS)


def crossed(rings: list[Ring], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which points lie on an edge, or have an odd number of edges to their right; exact."""
    odd, on = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (ax, ay) == (bx, by):
                continue
            near = np.flatnonzero((y >= min(ay, by)) & (y <= max(ay, by)) & (x <= max(ax, bx)))
            if not len(near):
                continue
            px, py = x[near], y[near]
            s = sides(*(np.full(len(near), v) for v in (ax, ay, bx, by)), px, py)
            on[near] |= (s == 0) & (px >= min(ax, bx))
            odd[near] ^= ((ay <= py) != (by <= py)) & (s == (1 if by > ay else -1))
    return odd | on


def region_triangles(regions: DataFrame, code: str, geom: str) -> DataFrame:
    """``code, x1..y3, problem, rings``: the triangles of each polygon, or its problem with the
    rings as JSON; rings are NULL where the whole row is not readable."""
    rows = regions.select(F.col(code).cast("string").alias("code"), F.col(geom).cast("string").alias("geom"))
    # One file of many regions would be one task; a number that is given is not coalesced.
    rows = rows.where(F.trim("code") != "").repartition(regions.sparkSession.sparkContext.defaultParallelism, "code", "geom")
    return rows.mapInPandas(_clip_rows, "code string, x1 double, y1 double, x2 double, y2 double, x3 double, y3 double, problem string, rings string")


def unusable_regions(regions: DataFrame, code: str, geom: str) -> DataFrame:
    """``code, problem`` of the region rows that hold no point because they can't be read."""
    return region_triangles(regions, code, geom).where(F.col("problem").isNotNull() & F.col("rings").isNull()).select("code", "problem")


def region_report(regions: DataFrame, code: str, geom: str) -> DataFrame:
    """Per code: triangles, polygons that are tested by their edges, rows that are not readable."""
    t = region_triangles(regions, code, geom)
    bad = F.col("problem").isNotNull()
    return t.groupBy("code").agg(F.count_if(~bad).alias("n_triangles"), F.count_if(F.col("rings").isNotNull()).alias("n_unclipped"), F.count_if(bad & F.col("rings").isNull()).alias("n_unreadable"))


def coordinate(c: Column, most: float) -> Column:
    """A coordinate from text: a plain decimal number within +-``most``, else NULL."""
    t = F.trim(c.cast("string"))
    v = F.when(t.rlike(r"\A[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"), t.try_cast("double"))
    return F.when(v.between(-most, most), v)


CORNERS = ["x1", "y1", "x2", "y2", "x3", "y3"]


def _hits(tree: Hierarchy, names: np.ndarray, points: pa.RecordBatch | pa.Table) -> list[pa.Array]:
    """The points in some triangle, each with every code once."""
    at, which = tree.find(points.column("x").to_numpy(), points.column("y").to_numpy())
    pairs = np.unique(np.stack([at, which], 1), axis=0)
    ident = points.column("ident")
    ident = ident.combine_chunks() if isinstance(ident, pa.ChunkedArray) else ident
    return [ident.take(pa.array(pairs[:, 0])), pa.array(names[pairs[:, 1]], pa.string())]


def _by_broadcast(asked: DataFrame, triangles: DataFrame, schema: str) -> DataFrame:
    """Points past a broadcast hierarchy; the caller has checked how many triangles there are."""
    rows = triangles.collect()
    corners = np.array([r[1:] for r in rows], float)
    names, index = np.unique(np.array([r[0] for r in rows], object), return_inverse=True)
    shared = asked.sparkSession.sparkContext.broadcast((corners, index.astype(np.int32), names))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corners, index, names = shared.value
        tree = Hierarchy(corners, index)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(_hits(tree, names, batch), ["ident", "code"])

    low_x, high_x, low_y, high_y = corners[:, ::2].min(), corners[:, ::2].max(), corners[:, 1::2].min(), corners[:, 1::2].max()
    near = asked.where(F.col("x").between(float(low_x), float(high_x)) & F.col("y").between(float(low_y), float(high_y)))
    return near.mapInArrow(look, schema)


def _place(v: Column, low: float, level: Column) -> Column:
    """Column or row of the grid; what lies outside the world falls into its outermost cells."""
    cells = F.pow(F.lit(2.0), level)
    return F.greatest(F.lit(0.0), F.least(cells - 1, F.floor((v - low) * cells / 360.0).cast("double"))).cast("bigint")


def _cell(level: Column, x: Column, y: Column) -> Column:
    """One number for a cell: 5 bits of level, 17 of row and 17 of column."""
    return F.shiftleft(F.shiftleft(level.cast("bigint"), 17).bitwiseOR(y), 17).bitwiseOR(x)


def _by_cells(asked: DataFrame, triangles: DataFrame, schema: str, block: int, together: int) -> DataFrame:
    """Points and triangles meet by cells of a nested grid."""
    low_x, high_x, low_y, high_y = F.least("x1", "x2", "x3"), F.greatest("x1", "x2", "x3"), F.least("y1", "y2", "y3"), F.greatest("y1", "y2", "y3")
    wide = F.greatest(high_x - low_x, high_y - low_y)
    # The finest level whose cells are as wide as the triangle.
    level = F.coalesce(*[F.when(wide <= 360.0 / 2**n, F.lit(n)) for n in reversed(LEVELS)], F.lit(0))
    sized = triangles.withColumn("level", level)
    spans = [F.sequence(_place(a, low, F.col("level")), _place(b, low, F.col("level"))) for a, b, low in ((low_x, high_x, -180.0), (low_y, high_y, -90.0))]
    placed = sized.withColumn("cx", F.explode(spans[0])).withColumn("cy", F.explode(spans[1])).withColumn("cell", _cell(F.col("level"), F.col("cx"), F.col("cy")))
    placed = cut(placed.select("code", *CORNERS, "cell", "level"))
    levels = [r[0] for r in placed.select("level").distinct().collect()]
    here = lambda n: _cell(F.lit(n), _place(F.col("x"), -180.0, F.lit(n)), _place(F.col("y"), -90.0, F.lit(n)))
    cells = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    points = asked.withColumn("cell", F.explode(F.array(*map(here, levels)))).join(cells, "cell")
    salts = points.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / together).cast("int").alias("salts"))
    sides = cells.join(salts, "cell")
    any_ = F.xxhash64("ident", "x", "y")
    left = points.drop("blocks").join(sides, "cell").withColumn("salt", F.pmod(any_, F.col("salts")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = placed.join(sides, "cell").withColumn("part", F.pmod(F.xxhash64("code", *CORNERS), F.col("blocks")).cast("int")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    keys = ["cell", "salt", "part"]

    def look(points: pa.Table, tri: pa.Table) -> pa.Table:
        corners = np.stack([tri.column(c).to_numpy() for c in CORNERS], 1)
        names, index = np.unique(np.array(tri.column("code").to_pylist(), object), return_inverse=True)
        hits = _hits(Hierarchy(corners, index.astype(np.int32)), names, points) if len(corners) and points.num_rows else [points.column("ident").slice(0, 0), pa.array([], pa.string())]
        return pa.Table.from_arrays(hits, ["ident", "code"])

    met = left.select("ident", "x", "y", *keys).groupBy(*keys).cogroup(right.select("code", *CORNERS, *keys).groupBy(*keys))
    return met.applyInArrow(look, schema)


def points_in_regions(points: DataFrame, ident: str, lon: Column, lat: Column, regions: DataFrame, code: str, geom: str, *, block: int = BLOCK, together: int = TOGETHER) -> DataFrame:
    """``ident, code``: one row for each point and each region code that holds it."""
    spark = points.sparkSession
    read = cut(region_triangles(regions, code, geom))
    triangles = read.where(F.col("problem").isNull()).select("code", *CORNERS)
    schema = f"ident {points.schema[ident].dataType.simpleString()}, code string"
    asked = points.select(F.col(ident).alias("ident"), lon.alias("x"), lat.alias("y")).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    n, n_unclipped = read.agg(F.count_if(F.col("problem").isNull()), F.count_if(F.col("rings").isNotNull())).first()
    found = []
    if n:
        found.append(_by_broadcast(asked, triangles, schema) if n <= block else _by_cells(asked, triangles, schema, block, together))

    def count(name: str, rings: list[Ring]) -> DataFrame:
        shared = spark.sparkContext.broadcast(rings)
        low_x, low_y = map(min, zip(*(p for r in rings for p in r), strict=True))
        high_x, high_y = map(max, zip(*(p for r in rings for p in r), strict=True))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = np.flatnonzero(crossed(shared.value, batch.column("x").to_numpy(), batch.column("y").to_numpy()))
                yield pa.RecordBatch.from_arrays([batch.column("ident").take(pa.array(hit)), pa.array([name] * len(hit), pa.string())], ["ident", "code"])

        near = asked.where(F.col("x").between(float(low_x), float(high_x)) & F.col("y").between(float(low_y), float(high_y)))
        return near.mapInArrow(look, schema)

    # A polygon that can't be clipped is tested by its edges; one at a time reaches the driver.
    if n_unclipped:
        for row in read.where(F.col("rings").isNotNull()).select("code", "rings").toLocalIterator():
            found.append(count(row["code"], [[tuple(p) for p in r] for r in json.loads(row["rings"])]))
    return reduce(DataFrame.unionByName, found).distinct() if found else spark.createDataFrame([], schema)
