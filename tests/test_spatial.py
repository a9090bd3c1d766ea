import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlark.operators import spatial
from fieldlark.operators.spatial import Hierarchy, ear_clip, parse_wkt, points_in_regions, region_triangles, side, unusable_regions


def inside(x, y, ring):
    hit = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            hit = not hit
    return hit


def star(rng, cx, cy, r, n):
    a = np.sort(rng.uniform(0, 2 * np.pi, n))
    rr = rng.uniform(0.4, 1, n) * r
    return [(round(cx + m * np.cos(t), 4), round(cy + m * np.sin(t), 4)) for t, m in zip(a, rr, strict=True)]


@pytest.mark.parametrize("seed", range(12))
def test_triangles_tile_polygons_with_holes(seed):
    rng = np.random.default_rng(seed)
    outer = star(rng, 0, 0, 30, 60)
    square = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    holes = [square(-1.5, -1.5, 1.2), square(0.5, 0.5, 1.0), square(-1.5, 1.0, 0.8)]
    try:
        tri = ear_clip([outer + outer[:1], *holes])
    except ValueError:
        pytest.skip("the random star crosses a hole")
    tree = Hierarchy(tri, np.zeros(len(tri), int))
    x, y = rng.uniform(-32, 32, 800), rng.uniform(-32, 32, 800)
    got = set(tree.find(x, y)[0].tolist())
    want = {i for i in range(800) if inside(x[i], y[i], outer) and not any(inside(x[i], y[i], h) for h in holes)}
    assert got == want


def test_large_rings_are_clipped_by_cells(monkeypatch):
    """Corners found through the grid are those found by looking at all."""
    rng = np.random.default_rng(3)
    ring = star(rng, 0, 0, 50, 3000)
    fast = ear_clip([ring])
    monkeypatch.setattr(spatial._Corners, "FEW", 10**9)
    assert np.array_equal(fast, ear_clip([ring]))


def test_reading_and_refusing():
    assert parse_wkt("SRID=4326;multipolygon (((0 0,1 0,1 1,0 0)),((2 2, 3 2, 3 3, 2 2)))")[1][0][0] == (2.0, 2.0)
    assert parse_wkt("POLYGON Z ((0 0 5, 1 0 5, 1 1 5, 0 0 5))")[0][0][1] == (1.0, 0.0)
    assert parse_wkt("POLYGON EMPTY") == []
    for bad in (None, " ", "POINT(1 2)", "POLYGON((0 0, 1 1", "POLYGON((a b, 1 1))", "POLYGON((0 0,1 0,1 1,0 0)) x"):
        with pytest.raises(ValueError):
            parse_wkt(bad)
    with pytest.raises(ValueError):
        ear_clip([[(0, 0), (4, 4), (4, 0), (0, 2)]])
    assert side((0.0, 0.0), (1e-30, 1e-30), (2e-30, 2e-30)) == 0


REGIONS = [
    ("A", "POLYGON((0 0,10 0,10 10,0 10,0 0),(4 4,6 4,6 6,4 6,4 4))"),
    ("A", "POLYGON((20 0,30 0,30 10,20 10,20 0))"),
    ("B", "POLYGON((10 0,20 0,20 10,10 10,10 0))"),
    ("B", "POLYGON((9 0,11 0,11 1,9 1,9 0))"),
    (None, "POLYGON((0 0,50 0,50 50,0 0))"),
    ("C", "broken"),
    ("C", None),
]
POINTS = [(1, 5.0, 5.0), (2, 1.0, 1.0), (3, 10.0, 5.0), (4, 15.0, 5.0), (5, 9.5, 0.5), (6, None, 1.0), (7, 40.0, 40.0), (8, 25.0, 5.0), (8, 25.0, 5.0)]


@pytest.mark.parametrize("block", [2, spatial.BLOCK])
def test_points(spark, block):
    pts = spark.createDataFrame(POINTS, "id long, x double, y double").withColumn("code", F.lit("clash")).withColumn("geom", F.lit("clash"))
    regions = spark.createDataFrame(REGIONS, "code string, geom string")
    got = {tuple(r) for r in points_in_regions(pts, "id", F.col("x"), F.col("y"), regions, "code", "geom", block=block).collect()}
    assert got == {(2, "A"), (3, "A"), (3, "B"), (4, "B"), (5, "A"), (5, "B"), (8, "A")}
    assert {r["code"] for r in unusable_regions(regions, "code", "geom").collect()} == {"C"}
    assert points_in_regions(pts.limit(0), "id", F.col("x"), F.col("y"), regions, "code", "geom").count() == 0
    assert points_in_regions(pts, "id", F.col("x"), F.col("y"), regions.limit(0), "code", "geom").count() == 0
    assert region_triangles(regions, "code", "geom").where("problem is null").count() > 6


def test_cells_give_what_a_broadcast_gives(spark):
    """Regions of all sizes, some over each other, hot cells in several salts and blocks."""
    rng = np.random.default_rng(8)
    wkt = lambda r: "POLYGON((" + ",".join(f"{x} {y}" for x, y in [*r, r[0]]) + "))"
    shapes = [star(rng, float(rng.uniform(-170, 170)), float(rng.uniform(-80, 80)), r, 12) for r in (0.01, 0.3, 2, 9, 30, 60) for _ in range(4)] + [star(rng, 5.0, 5.0, 1, 9) for _ in range(6)]
    regions = spark.createDataFrame([(f"r{i}", wkt(s)) for i, s in enumerate(shapes)], "code string, geom string")
    xy = [(float(a), float(b)) for a, b in zip(rng.uniform(-180, 180, 1500), rng.uniform(-90, 90, 1500), strict=True)] + [(5.0, 5.0)] * 300 + [(180.0, 90.0), (-180.0, -90.0)] + [s[0] for s in shapes]
    pts = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "id long, x double, y double")
    ask = lambda **kw: sorted(map(tuple, points_in_regions(pts, "id", F.col("x"), F.col("y"), regions, "code", "geom", **kw).collect()))
    whole = ask()
    assert len({c for _, c in whole}) > 20
    assert ask(block=20, together=50) == whole == ask(block=200)


def test_a_polygon_that_cannot_be_clipped_keeps_its_row(spark):
    regions = spark.createDataFrame([("A", "MULTIPOLYGON(((0 0,4 4,4 0,0 2,0 0)),((10 0,12 0,12 2,10 2,10 0)))"), ("C", "broken")], "code string, geom string")
    pts = spark.createDataFrame([(1, 11.0, 1.0), (2, 3.5, 2.0), (3, 0.2, 1.0), (4, 1.0, 0.5), (5, 2.0, 2.0), (6, 4.0, 4.0), (7, 20.0, 1.0), (8, 0.0, 1.0)], "id long, x double, y double")
    got = {tuple(r) for r in points_in_regions(pts, "id", F.col("x"), F.col("y"), regions, "code", "geom").collect()}
    assert got == {(i, "A") for i in (1, 2, 3, 5, 6, 8)}
    assert [r["code"] for r in unusable_regions(regions, "code", "geom").collect()] == ["C"]
    report = {r["code"]: (r["n_triangles"], r["n_unclipped"], r["n_unreadable"]) for r in spatial.region_report(regions, "code", "geom").collect()}
    assert report == {"A": (2, 1, 0), "C": (0, 0, 1)}


def test_coordinates(spark):
    texts = [" 1.5 ", "+2", "1,5", "NaN", "91", "1e1", None, "", "1d", "55°25'"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(spatial.coordinate(F.col("t"), 90).alias("v"))
    assert [r["v"] for r in df.collect()] == [1.5, 2.0, None, None, None, 10.0, None, None, None, None]
