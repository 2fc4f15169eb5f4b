"""Cases that were found at larger sizes: each failed, differed from its SQL or was slow before."""

import io
import random
import time
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions import geo
from terraloom.operators import coast, destripe, focal, granules, overlay, radiometry, spatial
from terraloom.plans import scalar_queries, source_queries
from terraloom.sources import archives, staging


def test_the_transverse_mercator_goes_to_infinity_and_back(spark):
    df = spark.createDataFrame([(90.0, 0.0), (-90.0, 0.0), (89.9, 0.1)], "lon double, lat double")
    there = df.select("lon", "lat", F.struct(*geo.transverse_mercator(F.col("lon"), F.col("lat"), 0.0)).alias("p"))
    x, y = (F.col(f"p.{n}") for n in there.schema["p"].dataType.names)
    for r in there.select("lon", "lat", *[c.alias(n) for c, n in zip(geo.transverse_mercator_inverse(x, y, 0.0), "ab")]).collect():
        assert (r["a"], r["b"]) == pytest.approx((r["lon"], r["lat"]), abs=1e-6)


def test_a_stored_half_is_rounded_up(spark):
    """Pixels whose reflectance is a half of the stored step but for its last bits."""
    px = spark.createDataFrame([(671.0, 39.0, 15.0, 197.0, 1900.0, 265), (560.0, 55.0, 12.0, 244.0, 800.0, 253)], "dn double, solz double, senz double, phi double, height double, want int")
    assert all(r["stored"] == r["want"] for r in radiometry.corrected(px, 1, 100.0, 0.00005).select("stored", "want").collect())


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString().lower()


def test_windows_run_from_either_end(spark):
    """A frame up to the end of the partition takes the square of a line's or column's length."""
    px = spark.range(12).selectExpr("id div 4 AS l", "id % 4 AS s", "CAST(id AS DOUBLE) AS v", "1D AS a", "2D AS b")
    edfs = spark.createDataFrame([(0, 1, 0.5)], "det int, v long, edf double")
    for df in (focal.collar(px, F.col("v") > 3), focal.blend(px, "a", "b", F.col("v") < 7, 2), coast.squared_distance(px, F.col("v") > 3, 5, "d"), destripe.match_tables(edfs, 0)):
        assert "unboundedfollowing" not in _plan(df)
    rows = {(r["l"], r["s"]): r["share"] for r in focal.blend(px, "a", "b", F.col("v") != 6, 4).collect()}
    assert rows[1, 2] == 0 and rows[1, 0] == 0.5 and rows[0, 2] == 0.25 and rows[2, 2] == 0.25 and rows[0, 0] == 1


def test_archives_of_a_compact_table_are_spread(spark, monkeypatch):
    """One small file of names is not one task of archives."""
    monkeypatch.setattr(source_queries, "_TASK", 20)
    made = source_queries._archives(spark, "/root/testdata/sf0.001")
    assert made.rdd.getNumPartitions() >= made.count() // 20 > 1
    assert staging.spread(spark.range(0, 1, 1, 1), 20).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_members_of_many_archives_are_handed_on_together(spark, monkeypatch):
    def packed(k):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n in range(k % 3):
                z.writestr(f"m{n}.tif", b"x" * k)
        return out.getvalue() if k % 5 else b"broken"

    held = spark.createDataFrame([(f"a{k}.zip", bytearray(packed(k))) for k in range(40)], "path string, content binary").coalesce(1)
    for rows, size in ((7, 1 << 24), (4096, 50), (4096, 1 << 24)):
        monkeypatch.setattr(archives, "_ROWS", rows)
        monkeypatch.setattr(archives, "_BYTES", size)
        found = archives.members(held).collect()
        assert sorted((r["archive"], r["pos"], len(r["bytes"])) for r in found if r["error"] is None) == sorted((f"a{k}.zip", n, k) for k in range(40) if k % 5 for n in range(k % 3))
        assert sorted(r["archive"] for r in found if r["error"]) == sorted(f"a{k}.zip" for k in range(0, 40, 5))


RING = "ring array<struct<x:double,y:double>>"


@pytest.mark.parametrize("op", ["union", "difference"])
def test_points_on_slanted_borders(spark, op):
    """Points on the long side of triangles, whose last bits decide."""
    rng = random.Random(5)
    lands = [(float(rng.randrange(-170, 165)), float(rng.randrange(-80, 75)), *rng.choice(((6, 4), (5, 5), (7, 3)))) for _ in range(150)]
    land = lambda p: any(p[0] >= x and p[1] >= y and (p[0] - x) / w + (p[1] - y) / h < 1 for x, y, w, h in lands)
    points = set()
    for x, y, w, h in lands:
        for i in range(1800, 3600) if x > 0 else range(0, 1900):
            px = i / 10.0 - 179.97
            py = round((y + h * (1 - (px - x) / w) + 84.97) * 10) / 10.0 - 84.97
            if x < px < x + w and abs((px - x) / w + (py - y) / h - 1) < 1e-9:
                points.add((px, py))
    points = sorted(points)
    assert len(points) > 300 and 0 < sum(map(land, points)) < len(points)
    triangles = spark.createDataFrame([([(x, y), (x + w, y), (x, y + h), (x, y)],) for x, y, w, h in lands], RING)
    world = spark.createDataFrame([([(-180.0, -90.0), (180.0, -90.0), (180.0, 90.0), (-180.0, 90.0), (-180.0, -90.0)],)], RING)
    held = spark.createDataFrame(points, "x double, y double")
    if op == "union":
        got = overlay.covered(held, "x", "y", overlay.union(triangles, "ring"), triangles)
    else:
        got = overlay.covered(held, "x", "y", overlay.difference(world, "ring", triangles, "ring"), world, triangles, op)
    assert sorted(map(tuple, got.collect())) == [p for p in points if land(p) == (op == "union")]


@pytest.mark.parametrize("pairs", [50, 4_000_000])
def test_joins_are_dealt_by_their_pairs(spark, monkeypatch, pairs):
    monkeypatch.setattr(spatial, "PAIRS", pairs)
    rng = random.Random(2)
    rows = lambda n: [(k, x, y, x + rng.random(), y + rng.random()) for k in range(n) for x, y in ((rng.random() * 6, rng.random() * 6),)]
    ls, rs = rows(120), rows(60)
    left = spark.createDataFrame(ls, "id int, a double, b double, c double, d double").coalesce(1)
    right = spark.createDataFrame(rs, "rid int, e double, f double, g double, h double").coalesce(1)
    out = spatial.box_join(left, right, tuple("abcd"), tuple("efgh"))
    want = sorted((p[0], q[0]) for p in ls for q in rs if p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2])
    assert sorted((r["id"], r["rid"]) for r in out.collect()) == want
    lc, rc, _ = spatial.dealt(left.withColumn("_c", F.lit(1)), right.withColumn("_c", F.lit(1)))
    parts = lc.rdd.getNumPartitions()
    assert parts == rc.rdd.getNumPartitions() >= (120 * 60 // pairs or spark.sparkContext.defaultParallelism)
    semi = spatial.box_semi(left, right, tuple("abcd"), tuple("efgh"), "id")
    assert sorted(r["id"] for r in semi.collect()) == sorted({p for p, _ in want})


def test_ring_pairs_in_columns(spark):
    rng = random.Random(4)
    ring = lambda: [(rng.uniform(0, 6) + x, rng.uniform(0, 6) + y) for x, y in ((0, 0), (3, 0), (3, 3), (0, 3))[: rng.choice((3, 4))]]
    closed = lambda r: [*r, r[0]] if rng.random() < 0.5 else r
    pairs = [(closed(ring()), closed(ring())) for _ in range(300)] + [(None, ring()), (ring(), []), ([(1.0, 1.0)], ring())]
    df = spark.createDataFrame(pairs, f"a {RING[5:]}, b {RING[5:]}")
    got = df.select(spatial.rings_intersect("a", "b").alias("x"), spatial.polygons_intersect("a", "b").alias("y")).collect()
    assert all(r["x"] == r["y"] for r in got) and 0 < sum(r["x"] for r in got) < 300


def test_upright_edges_are_not_compared():
    """Two upright edges never cross: a crowded band of boxes takes no square of time."""
    x = np.repeat(np.arange(20_000.0), 2) + np.tile([0.0, 0.5], 20_000)
    e = np.column_stack([x, np.zeros(len(x)), x, np.ones(len(x)), np.tile([1.0, -1.0], 20_000), np.zeros(len(x))])
    began = time.perf_counter()
    assert len(overlay._sweep(e, -np.inf, np.inf, "union")) == 20_000
    assert time.perf_counter() - began < 3


def test_overlay_texts_are_spread(spark):
    assert scalar_queries.ground_overlays(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_granules_are_gathered_in_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(granules, "TASK_ROWS", 10)
    px = spark.range(400).selectExpr("concat('G', id div 4) AS granule", "CAST(0 AS BIGINT) AS scan", "id % 2 AS l", "id div 2 % 2 AS s", "1 AS band", "CAST(id AS DOUBLE) AS dn")
    places = px.selectExpr("granule", "l", "s", "0D AS lat", "0D AS lon", "0D AS solz")
    mirrors, flags = px.selectExpr("granule", "scan", "1 AS mirror").distinct(), px.selectExpr("granule", "1 AS day").distinct()
    out = granules.gathered(px, places, mirrors, flags, [1])
    assert out.rdd.getNumPartitions() == 40 and out.count() == 400
