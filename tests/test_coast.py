"""Masks, distances and blending against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terraloom.operators import coast


@given(st.dictionaries(st.integers(-40, 40), st.integers(0, 30), min_size=1, max_size=25))
@settings(max_examples=400, deadline=None)
def test_envelope_is_the_least_parabola(sites):
    at = np.array(sorted(sites))
    height = np.array([sites[a] ** 2 for a in at.tolist()])
    where = np.arange(-60, 61)
    assert coast.envelope(at, height, where).tolist() == [min((w - a) ** 2 + h for a, h in zip(at.tolist(), height.tolist())) for w in where.tolist()]


def image(spark, seed, lines=23, samples=31, share=0.03):
    rng = random.Random(seed)
    rows = [(g, line, s, rng.random() < share) for g in ("a", "b") for line in range(lines) for s in range(samples)]
    return rows, spark.createDataFrame(rows, "g string, l long, s long, m boolean")


def nearest(rows, g, line, s):
    return min(((line - r[1]) ** 2 + (s - r[2]) ** 2 for r in rows if r[0] == g and r[3]), default=None)


@pytest.mark.parametrize("seed,most", [(1, 100), (3, 4)])
def test_distances_equal_brute_force(spark, seed, most):
    rows, px = image(spark, seed)
    got = {(r["g"], r["l"], r["s"]): r["d2"] for r in coast.squared_distance(px.repartition(5), F.col("m"), most, "d2", "g").collect()}
    assert len(got) == len(rows)
    for g, line, s, _ in rows:
        want = nearest(rows, g, line, s)
        assert got[g, line, s] == (want if want is not None and want <= most * most else None)


def test_no_target_and_no_pixels(spark):
    _, px = image(spark, 4, 3, 3, share=-1)
    assert {r["d2"] for r in coast.squared_distance(px, F.col("m"), 9, "d2", "g").collect()} == {None}
    assert coast.squared_distance(px.limit(0), F.col("m"), 9, "d2", "g").count() == 0


def test_columns_do_not_depend_on_batches(spark):
    """Columns that are cut by Arrow batches, and a null key."""
    rows, px = image(spark, 5, 40, 7)
    px = px.withColumn("g", F.when(F.col("g") == "a", F.col("g")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        got = {(r["g"] or "b", r["l"], r["s"]): r["d2"] for r in coast.squared_distance(px, F.col("m"), 100, "d2", "g").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(got[g, line, s] == nearest(rows, g, line, s) for g, line, s, _ in rows)


def test_buffers_and_bays(spark):
    rows, px = image(spark, 6)
    held = {r[:3] for r in rows if r[3]}
    disc = [(a, b) for a in range(-2, 3) for b in range(-2, 3) if a * a + b * b <= 4]
    every = {r[:3] for r in rows}
    grown = {(g, line + a, s + b) for g, line, s in held for a, b in disc} & every
    assert {(r["g"], r["l"], r["s"]) for r in coast.buffered(px, "m", 2, "g").where("m").collect()} == grown
    closed = {p for p in grown if not any((p[0], p[1] + a, p[2] + b) in every - grown for a, b in disc)} | held
    assert {(r["g"], r["l"], r["s"]) for r in coast.filled_bays(px, "m", [2], "g").where("m").collect()} == closed


def inside(x, y, ring):
    odd = False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
        if (y0 <= y) != (y1 <= y) and x0 + (y - y0) * (x1 - x0) / (y1 - y0) <= x:
            odd = not odd
    return odd


def test_masks_of_overlapping_rings(spark):
    """Stars of both orientations, some beyond the image, against the parity of each one."""
    rng = random.Random(7)
    rings = []
    for _ in range(12):
        cx, cy = rng.uniform(-1, 11), rng.uniform(-9, 1)
        turn = [(k + rng.random()) * 2 * np.pi / 9 for k in range(9)]
        sides = [(t, rng.uniform(0.5, 3)) for t in (turn if rng.random() < 0.5 else turn[::-1])]
        ring = [(cx + r * np.cos(t), cy + r * np.sin(t)) for t, r in sides]
        rings.append([(float(x), float(y)) for x, y in [*ring, ring[0]]])
    df = spark.createDataFrame([(r,) for r in rings], "ring array<struct<x:double,y:double>>")
    px = spark.range(40 * 50).selectExpr("id div 50 AS l", "id % 50 AS s")
    got = {(r["l"], r["s"]): r["land"] for r in coast.within(px, df, "ring", 0.0, 0.0, 0.2, 40, "land").collect()}
    assert len(got) == 2000
    # A star winds once around its inner points, so parity and winding agree.
    for (line, s), land in got.items():
        assert land == any(inside((s + 0.5) * 0.2, -(line + 0.5) * 0.2, r) for r in rings)


def test_an_image_without_land_is_the_overlay_and_one_without_water_the_base(spark):
    px = spark.range(100).selectExpr("id div 10 AS l", "id % 10 AS s", "id % 2 AS k").withColumns({"base": F.lit(1.0), "over": F.lit(9.0)})
    for land, want in ((False, {9.0}), (True, {1.0})):
        assert {r["out"] for r in coast.feathered(px.withColumn("land", F.lit(land)), "land", "base", "over", 1, 3, "k").collect()} == want
    some = coast.feathered(px.withColumn("land", F.col("s") == 0).withColumn("over", F.lit(None).cast("double")), "land", "base", "over", 1, 3)
    assert {r["out"] for r in some.collect()} == {1.0}
