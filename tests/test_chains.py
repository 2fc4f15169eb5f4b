"""Pointer doubling and contour lines against plain walks."""

import random

import pytest
from pyspark.sql import functions as F

from terraloom.operators import chains, focal


def test_chains_and_rings(spark):
    rng = random.Random(1)
    ids = list(range(400))
    rng.shuffle(ids)
    want, rows, at = {}, [], 0
    for n in (1, 2, 3, 64, 65, 100):
        chain, at = ids[at : at + n], at + n
        rows += [("x", b, a) for a, b in zip([None, *chain], chain)]
        want.update({("x", v): (chain[0], k, False) for k, v in enumerate(chain)})
    for n in (1, 2, 3, 33):
        ring, at = ids[at : at + n], at + n
        first = ring.index(min(ring))
        rows += [("x", b, a) for a, b in zip([ring[-1], *ring], ring)]
        want.update({("x", v): (min(ring), (k - first) % n, True) for k, v in enumerate(ring)})
    rows += [("y", b, a) for a, b in ((None, 1), (1, 2), (99, 5))]  # the same ids under another key; one before is not there
    want.update({("y", 1): (1, 0, False), ("y", 2): (1, 1, False), ("y", 5): (5, 0, False)})
    df = spark.createDataFrame(rows, "k string, id long, before long").repartition(3)
    got = {(r["k"], r["id"]): (r["start"], r["pos"], r["closed"]) for r in chains.ranked(df, "k").collect()}
    assert got == want
    assert chains.ranked(df.limit(0), "k").count() == 0


def test_passes_are_logarithmic(spark, monkeypatch):
    made = []
    plain = chains.cut
    monkeypatch.setattr(chains, "cut", lambda df: made.append(1) or plain(df))
    df = spark.range(2000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("before"))
    assert chains.ranked(df).agg(F.max("pos")).first()[0] == 1999
    assert len(made) <= 14
    made.clear()
    got = {r["id"]: r["height"] for r in chains.heights(df, "id", "before").collect()}
    assert got == {k: 1999 - k for k in range(2000)} and len(made) <= 26


def test_heights_equal_brute_force(spark):
    rng = random.Random(2)
    parent = {k: rng.choice([None, rng.randrange(k)]) if k else None for k in range(300)}
    height = dict.fromkeys(parent, 0)
    for k in sorted(parent, reverse=True):
        if parent[k] is not None:
            height[parent[k]] = max(height[parent[k]], height[k] + 1)
    df = spark.createDataFrame(list(parent.items()), "id long, parent long")
    assert {r["id"]: r["height"] for r in chains.heights(df, "id", "parent").collect()} == height


def test_a_circle_beside_many_nodes_ends_at_once(spark, monkeypatch):
    made = []
    plain = chains.cut
    monkeypatch.setattr(chains, "cut", lambda df: made.append(1) or plain(df))
    df = spark.range(200_000).select("id", F.when(F.col("id") < 2, 1 - F.col("id")).otherwise(F.lit(2)).alias("parent")).where("id <> 2")
    with pytest.raises(ValueError, match="circle"):
        chains.heights(df, "id", "parent")
    assert len(made) <= 8


def test_a_hill_has_a_closed_line_with_its_top_on_the_left(spark):
    px = spark.range(20 * 20).selectExpr("id div 20 AS l", "id % 20 AS s").withColumn("v", 10 - F.sqrt(F.pow(F.col("l") - 9.3, 2) + F.pow(F.col("s") - 8.6, 2)))
    rows = focal.contour_lines(focal.contour_cells(px, 5.0)).orderBy("pos").collect()
    assert {r["closed"] for r in rows} == {True} and len({r["line"] for r in rows}) == 1
    p = [(r["s"], r["l"]) for r in rows]
    area = sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(p, [*p[1:], p[0]])) / 2
    assert -area == pytest.approx(3.14159 * 25, rel=0.03)  # lines go down the image, so a left turn has a negative area
    assert all(abs(x1 - x0) <= 1 and abs(y1 - y0) <= 1 for (x0, y0), (x1, y1) in zip(p, p[1:]))


def test_a_slope_has_an_open_line(spark):
    px = spark.range(10 * 30).selectExpr("id div 30 AS l", "id % 30 AS s").withColumn("v", F.col("l") + 0.01 * F.col("s"))
    rows = focal.contour_lines(focal.contour_cells(px, 4.5)).orderBy("pos").collect()
    assert {r["closed"] for r in rows} == {False} and [r["pos"] for r in rows] == list(range(len(rows))) and len(rows) >= 30
