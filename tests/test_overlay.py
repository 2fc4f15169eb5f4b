"""Union, difference, buffers and closing of polygons against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terraloom.operators import overlay

RING = "ring array<struct<x:double,y:double>>"


def stars(seed, n, size=2.0, span=20.0):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        cx, cy, k = rng.uniform(0, span), rng.uniform(0, span), rng.choice((3, 5, 9))
        ring = [(cx + r * math.cos(t), cy + r * math.sin(t)) for t, r in (((j + rng.random()) * 2 * math.pi / k, rng.uniform(0.3, size)) for j in range(k))]
        ring = ring if rng.random() < 0.5 else ring[::-1]
        out.append([*ring, ring[0]])
    return out


def inside(x, y, ring):
    odd = False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
        if (y0 <= y) != (y1 <= y) and x0 + (y - y0) * (x1 - x0) / (y1 - y0) <= x:
            odd = not odd
    return odd


def frame(spark, rings):
    return spark.createDataFrame([([{"x": float(x), "y": float(y)} for x, y in r],) for r in rings], RING)


def points(spark, seed=9, n=3000, low=-3.0, high=23.0):
    rng = random.Random(seed)
    p = [(k, rng.uniform(low, high), rng.uniform(low, high)) for k in range(n)]
    return p, spark.createDataFrame(p, "k long, px double, py double")


def got_in(df, traps):
    return {r["k"] for r in overlay.covered(df, "px", "py", traps).collect()}


@pytest.fixture
def small(monkeypatch):
    """Many bands, and crowded ones among them."""
    monkeypatch.setattr(overlay, "BAND_EDGES", 20)
    monkeypatch.setattr(overlay, "CROWDED", 60)


def box_area(boxes):
    xs, ys = sorted({v for b in boxes for v in (b[0], b[2])}), sorted({v for b in boxes for v in (b[1], b[3])})
    return sum((x1 - x0) * (y1 - y0) for x0, x1 in zip(xs, xs[1:]) for y0, y1 in zip(ys, ys[1:]) if any(b[0] <= x0 and b[2] >= x1 and b[1] <= y0 and b[3] >= y1 for b in boxes))


def test_membership_of_a_union(spark, small):
    rings = stars(1, 120)
    p, df = points(spark)
    traps = overlay.union(frame(spark, rings + rings[:30]), "ring")
    assert got_in(df, traps) == {k for k, x, y in p if any(inside(x, y, r) for r in rings)}
    # Trapezoids do not overlap: none of the points is in two.
    inside_one = (F.col("py") >= F.col("y0")) & (F.col("py") < F.col("y1"))
    share = (F.col("py") - F.col("y0")) / (F.col("y1") - F.col("y0"))
    inside_one &= (F.col("px") > F.col("xl0") + share * (F.col("xl1") - F.col("xl0"))) & (F.col("px") < F.col("xr0") + share * (F.col("xr1") - F.col("xr0")))
    assert df.join(F.broadcast(traps), inside_one).groupBy("k").count().where("count > 1").count() == 0


def test_area_of_a_union_of_boxes(spark, small):
    rng = random.Random(2)
    boxes = [(x, y, x + rng.randint(1, 6), y + rng.randint(1, 6)) for x, y in ((rng.randint(0, 30), rng.randint(0, 30)) for _ in range(90))]
    rings = [[(a, b), (c, b), (c, d), (a, d), (a, b)] for a, b, c, d in boxes]
    assert overlay.union(frame(spark, rings), "ring").agg(F.sum(overlay.area())).first()[0] == pytest.approx(box_area(boxes), rel=1e-12)


def test_difference_and_intersection(spark, small):
    a, b = stars(3, 70), stars(4, 70)
    p, df = points(spark)
    in_a, in_b = ({k for k, x, y in p if any(inside(x, y, r) for r in rings)} for rings in (a, b))
    assert got_in(df, overlay.difference(frame(spark, a), "ring", frame(spark, b), "ring")) == in_a - in_b
    assert got_in(df, overlay.intersection(frame(spark, a), "ring", frame(spark, b), "ring")) == in_a & in_b
    total = lambda t: t.agg(F.coalesce(F.sum(overlay.area()), F.lit(0.0))).first()[0]
    parts = [total(overlay.difference(frame(spark, a), "ring", frame(spark, b), "ring")), total(overlay.intersection(frame(spark, a), "ring", frame(spark, b), "ring"))]
    assert sum(parts) == pytest.approx(total(overlay.union(frame(spark, a), "ring")), rel=1e-9)


def distance(x, y, ring):
    best = math.inf
    for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
        n = (x1 - x0) ** 2 + (y1 - y0) ** 2
        t = max(0.0, min(1.0, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / n)) if n else 0.0
        best = min(best, math.hypot(x - x0 - t * (x1 - x0), y - y0 - t * (y1 - y0)))
    return 0.0 if inside(x, y, ring) else best


def test_buffers_are_distances(spark):
    rings = stars(5, 12)
    p, df = points(spark, n=1500)
    got = got_in(df, overlay.buffered(frame(spark, rings), "ring", 0.8))
    for k, x, y in p:
        d = min(distance(x, y, r) for r in rings)
        if not 0.8 * math.cos(math.pi / overlay.DISC) <= d <= 0.8:  # between the polygon and the disc
            assert (k in got) == (d < 0.8)


def test_outline_of_two_boxes(spark):
    rings = [[(0, 0), (4, 0), (4, 2), (0, 2), (0, 0)], [(2, 1), (6, 1), (6, 3), (2, 3), (2, 1)]]
    border = overlay.outline(overlay.union(frame(spark, rings), "ring")).collect()
    assert sum(math.hypot(r["x1"] - r["x0"], r["y1"] - r["y0"]) for r in border) == pytest.approx(18)


def test_closing_fills_a_bay(spark):
    """A block with a narrow bay; the bay is filled, the rest stays."""
    ring = [(0, 0), (10, 0), (10, 10), (5.4, 10), (5.4, 3), (5.0, 3), (5.0, 10), (0, 10), (0, 0)]
    p, df = points(spark, n=2500, low=-2.0, high=12.0)
    got = got_in(df, overlay.closed(frame(spark, [ring]), "ring", [0.5]))
    block = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    for k, x, y in p:
        if min(abs(v - e) for v in (x, y) for e in (0, 10)) > 0.05 and not (4.9 < x < 5.5 and y > 9.3):
            assert (k in got) == inside(x, y, block)


def test_empty_and_odd_rings(spark):
    none = frame(spark, [[(0, 0), (1, 1), (0, 0)]]).union(spark.createDataFrame([(None,)], RING))
    assert overlay.union(none, "ring").count() == 0
    assert overlay.union(none.limit(0), "ring").count() == 0
    box = frame(spark, [[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]])
    assert overlay.difference(box, "ring", box, "ring").count() == 0
    assert overlay.difference(box, "ring", none, "ring").agg(F.sum(overlay.area())).first()[0] == 4.0
