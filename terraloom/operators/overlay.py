"""Union, difference, intersection, buffers and closing of polygons.

The plane is cut into bands whose borders follow the data, so that each has about as many edges. Every edge goes to
the bands it crosses; a task sweeps one band: between two events (corners and crossings) its edges have an order from
left to right, and the sum of their turns tells what is inside. The result is a table of trapezoids that do not
overlap; a union of any size is never one row or one task. Copies of a ring are dropped first, and a band that is
still crowded is first dissolved in parts, each of some of its rings.

A buffer is a union too: of the ring, a rectangle for each edge and a polygon around each corner.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.sources.staging import cut

from .coast import oriented
from .spatial import CELL, cells, ring_box

#: Edges that a band should have, the most bands, edges from which on a band is dissolved in parts, sides of a disc.
BAND_EDGES, BANDS, CROWDED, DISC = 400, 4096, 2000, 32
#: How near to a slanted side, in parts of its coordinates, a point is held against the rings.
NEAR = 1e-9
#: y0 < y1; the left and the right border at both; layer and turn of edges.
TRAPEZOIDS = "y0 double, y1 double, xl0 double, xl1 double, xr0 double, xr1 double"
RING = "array<struct<x:double,y:double>>"
_EDGE = ["x0", "y0", "x1", "y1", "turn", "layer", "salt"]
_BANDED = "x0 double, y0 double, x1 double, y1 double, turn int, layer int, salt long, band int"


def edges(rings: DataFrame, ring: str, layer: int = 0) -> DataFrame:
    """The edges of closed rings, upwards, with their turn: what crossing them from the left adds. Level ones do not
    matter. Equal rings count once."""
    some = rings.select(F.col(ring).alias("_r")).where(F.size("_r") >= 4).distinct()
    some = some.select(oriented("_r").alias("_r"), F.xxhash64("_r").alias("salt"))
    e = some.select("salt", F.explode(F.transform(F.sequence(F.lit(1), F.size("_r") - 1), lambda i: F.struct(F.col("_r")[i - 1].alias("a"), F.col("_r")[i].alias("b")))).alias("e"))
    up = F.col("e.b.y") > F.col("e.a.y")
    low = F.when(up, F.col("e.a")).otherwise(F.col("e.b"))
    high = F.when(up, F.col("e.b")).otherwise(F.col("e.a"))
    turn = F.when(up, -1).otherwise(1)
    return e.where("e.a.y <> e.b.y").select(low["x"].alias("x0"), low["y"].alias("y0"), high["x"].alias("x1"), high["y"].alias("y1"), turn.alias("turn"), F.lit(layer).alias("layer"), "salt")


def sides(traps: DataFrame, layer: int = 0) -> DataFrame:
    """The left and right borders of trapezoids as edges."""
    both = F.array(F.struct(F.col("xl0").alias("x0"), F.col("xl1").alias("x1"), F.lit(1).alias("turn")), F.struct(F.col("xr0").alias("x0"), F.col("xr1").alias("x1"), F.lit(-1).alias("turn")))
    e = traps.select("y0", "y1", F.explode(both).alias("e"), F.xxhash64("y0", "xl0", "xr0").alias("salt"))
    return e.select("e.x0", "y0", "e.x1", "y1", "e.turn", F.lit(layer).alias("layer"), "salt")


def _sweep(e: np.ndarray, low: float, high: float, op: str) -> list[tuple]:
    """Trapezoids of a band [low, high) from edges [edge, (x0, y0, x1, y1, turn, layer)]."""
    x0, y0, x1, y1 = e[:, :4].T
    slope = (x1 - x0) / (y1 - y0)
    at = lambda k, y: np.where(y == y1[k], x1[k], x0[k] + (y - y0[k]) * slope[k])
    a, b = np.maximum(y0, low), np.minimum(y1, high)
    ys = [a, b]
    # Where two edges cross within the band, a block of pairs at a time; of two that cross one is slanted.
    slanted = np.flatnonzero(x0 != x1)
    for k in range(0, len(slanted), 256):
        i = slanted[k : k + 256]
        with np.errstate(divide="ignore", invalid="ignore"):
            y = ((x0[None, :] - y0[None, :] * slope[None, :]) - (x0[i, None] - y0[i, None] * slope[i, None])) / (slope[i, None] - slope[None, :])
        good = (y > np.maximum(a[i, None], a[None, :])) & (y < np.minimum(b[i, None], b[None, :]))
        ys.append(y[good])
    events = np.unique(np.concatenate(ys))
    out: list[tuple] = []
    going: dict = {}  # trapezoids that may go on: (left edge, right edge) -> y0, left and right there, and at the top
    for ya, yb in zip(events[:-1].tolist(), events[1:].tolist()):
        k = np.flatnonzero((y0 <= ya) & (y1 >= yb))
        now = {}
        if len(k):
            xa, xb = at(k, ya), at(k, yb)
            order = np.lexsort((xb, xa + xb))
            k, xa, xb = k[order], xa[order], xb[order]
            turn, layer = e[k, 4], e[k, 5]
            first, second = np.cumsum(turn * (layer == 0)) > 0, np.cumsum(turn * (layer == 1)) > 0
            inside = {"union": first | second, "difference": first & ~second, "intersection": first & second}[op]
            # Edges at one place count together: only the state after the last of them matters.
            last = np.append((xa[1:] != xa[:-1]) | (xb[1:] != xb[:-1]), True)
            k, xa, xb, inside = k[last], xa[last], xb[last], inside[last]
            change = np.flatnonzero(inside != np.concatenate([[False], inside[:-1]]))
            for p, q in zip(change[::2].tolist(), change[1::2].tolist()):
                key = (int(k[p]), int(k[q]))
                start = going.pop(key)[:3] if key in going else (ya, float(xa[p]), float(xa[q]))
                now[key] = (*start, float(xb[p]), float(xb[q]))
        out += [(v[0], ya, v[1], v[3], v[2], v[4]) for v in going.values()]
        going = now
    return out + [(v[0], float(events[-1]), v[1], v[3], v[2], v[4]) for v in going.values()]


def _swept(op: str, shipped):
    """Sweeps rows (band, part, edge) that come ordered by band and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = shipped.value
        names = [c.split()[0] for c in TRAPEZOIDS.split(", ")]
        now, parts = None, []

        def out():
            band = now[0]
            low = borders[band - 1] if band > 0 else -np.inf
            high = borders[band] if band < len(borders) else np.inf
            made = _sweep(np.concatenate(parts), low, high, op)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in zip(*made)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(k).to_numpy() for k in range(2)])
            rows = np.column_stack([batch.column(k).to_numpy().astype(float) for k in range(2, 8)])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                key = tuple(keys[a].tolist())
                if key != now and parts:
                    yield from out()
                    parts = []
                now = key
                parts.append(rows[a:b])
        if parts:
            yield from out()

    return run


def bands(e: DataFrame) -> list[float]:
    """Borders of bands with about as many edges each: at most BANDS, whatever the data."""
    n = e.count()
    k = min(BANDS, n // BAND_EDGES)
    if k < 1:
        return []
    ends = e.select(F.explode(F.array("y0", "y1")).alias("y"))
    found = ends.agg(F.percentile_approx("y", [i / (k + 1) for i in range(1, k + 1)], 100 * BANDS)).first()[0]
    return sorted(set(found))


def overlay(e: DataFrame, op: str = "union") -> DataFrame:
    """Trapezoids of the union of both layers, of the first without the second, or of what both cover, from edges."""
    spark = e.sparkSession
    e = cut(e)
    borders = bands(e)
    shipped = spark.sparkContext.broadcast(np.array(borders))
    rows = e.mapInArrow(_banded(shipped), _BANDED)
    count = rows.groupBy("band").count().where(F.col("count") > CROWDED).select("band", F.ceil(F.col("count") / CROWDED).alias("parts"))
    crowded = cut(count)
    if crowded.isEmpty():
        return _one(rows.withColumn("part", F.lit(0).cast("long")), op, shipped)
    # Crowded bands: each layer is dissolved in parts of whole rings, and the parts are put together.
    tight = rows.join(F.broadcast(crowded), "band").withColumn("part", F.pmod("salt", F.col("parts")))
    free = rows.join(F.broadcast(crowded), "band", "left_anti")
    out = _one(free.withColumn("part", F.lit(0).cast("long")), op, shipped)
    merged = None
    for layer in (0, 1):
        s = sides(_one(tight.where(F.col("layer") == layer), "union", shipped), 0).withColumn("layer", F.lit(layer))
        merged = s if merged is None else merged.unionByName(s)
    banded = cut(merged).mapInArrow(_banded(shipped), _BANDED)
    return out.unionByName(_one(banded.withColumn("part", F.lit(0).cast("long")), op, shipped))


def _one(rows: DataFrame, op: str, shipped) -> DataFrame:
    held = rows.select("band", "part", "x0", "y0", "x1", "y1", "turn", "layer").repartition("band", "part").sortWithinPartitions("band", "part")
    if op == "union":
        held = held.withColumn("layer", F.lit(0))
    return held.mapInArrow(_swept(op, shipped), TRAPEZOIDS)


def _banded(shipped):
    """Each edge once for every band it crosses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = shipped.value
        for batch in batches:
            y0, y1 = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("y0", "y1"))
            first, last = np.searchsorted(borders, y0, side="right"), np.searchsorted(borders, y1, side="left")
            n = last - first + 1
            rows = np.repeat(np.arange(len(n)), n)
            band = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n) + first[rows]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)).take(pa.array(rows)) for c in _EDGE), pa.array(band.astype(np.int32))], names=[*_EDGE, "band"])

    return run


def union(rings: DataFrame, ring: str) -> DataFrame:
    """The union of closed rings as trapezoids. Null rings and those without an area are left out."""
    return overlay(edges(rings, ring))


def difference(rings: DataFrame, ring: str, others: DataFrame, other: str) -> DataFrame:
    """What the rings cover and the others do not."""
    return overlay(edges(rings, ring).unionByName(edges(others, other, 1)), "difference")


def intersection(rings: DataFrame, ring: str, others: DataFrame, other: str) -> DataFrame:
    """What both cover."""
    return overlay(edges(rings, ring).unionByName(edges(others, other, 1)), "intersection")


def area() -> Column:
    """The area of a trapezoid, to be summed."""
    return (F.col("y1") - F.col("y0")) * (F.col("xr0") - F.col("xl0") + F.col("xr1") - F.col("xl1")) / 2


def outline(traps: DataFrame) -> DataFrame:
    """The border of a set of trapezoids as edges (x0, y0, x1, y1): the sides, and at every height where what lies
    above and below differ. Sides that two trapezoids share do not occur, since these would be one."""
    ends = F.array(
        F.struct(F.col("y0").alias("y"), F.col("xl0").alias("x"), F.lit(1).alias("above"), F.lit(0).alias("below")), F.struct(F.col("y0").alias("y"), F.col("xr0").alias("x"), F.lit(-1).alias("above"), F.lit(0).alias("below")),
        F.struct(F.col("y1").alias("y"), F.col("xl1").alias("x"), F.lit(0).alias("above"), F.lit(1).alias("below")), F.struct(F.col("y1").alias("y"), F.col("xr1").alias("x"), F.lit(0).alias("above"), F.lit(-1).alias("below")),
    )
    steps = traps.select(F.explode(ends).alias("e")).select("e.*").groupBy("y", "x").agg(F.sum("above").alias("above"), F.sum("below").alias("below"))
    along = Window.partitionBy("y").orderBy("x")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    level = steps.select("y", "x", F.lead("x").over(along).alias("next"), (F.sum("above").over(so_far) > 0).alias("a"), (F.sum("below").over(so_far) > 0).alias("b"))
    level = level.where((F.col("a") != F.col("b")) & F.col("next").isNotNull()).select(F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("next").alias("x1"), F.col("y").alias("y1"))
    return sides(traps).select("x0", "y0", "x1", "y1").unionByName(level)


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def around(pieces: DataFrame, distance: float) -> DataFrame:
    """ring: a rectangle around each edge (x0, y0, x1, y1) and a polygon of DISC corners around both of its ends."""
    c = F.col
    length = F.sqrt((c("x1") - c("x0")) ** 2 + (c("y1") - c("y0")) ** 2)
    dx, dy = (c("x1") - c("x0")) / length * distance, (c("y1") - c("y0")) / length * distance
    corners = [(c("x0") + dy, c("y0") - dx), (c("x1") + dy, c("y1") - dx), (c("x1") - dy, c("y1") + dx), (c("x0") - dy, c("y0") + dx)]
    box = F.array(*[_point(*p) for p in [*corners, corners[0]]])
    turns = [2 * np.pi * k / DISC for k in range(DISC)]
    disc = lambda x, y: F.array(*[_point(x + distance * float(np.cos(t)), y + distance * float(np.sin(t))) for t in [*turns, turns[0]]])
    ends = pieces.select(F.explode(F.array(_point(c("x0"), c("y0")), _point(c("x1"), c("y1")))).alias("p")).distinct()
    return pieces.where(length > 0).select(box.alias("ring")).unionByName(ends.select(disc(c("p.x"), c("p.y")).alias("ring")))


def buffered(rings: DataFrame, ring: str, distance: float) -> DataFrame:
    """The union of all rings, widened by the distance; round corners have DISC / 4 sides a quarter."""
    r = F.col("_r")
    some = rings.select(F.col(ring).alias("_r")).where(F.size("_r") >= 4)
    pieces = some.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("_r") - 1), lambda i: F.struct(r[i - 1].alias("a"), r[i].alias("b")))).alias("e"))
    pieces = pieces.select(F.col("e.a.x").alias("x0"), F.col("e.a.y").alias("y0"), F.col("e.b.x").alias("x1"), F.col("e.b.y").alias("y1"))
    return union(some.select(F.col("_r").alias("ring")).unionByName(around(pieces, distance)), "ring")


def closed(rings: DataFrame, ring: str, distances: list[float]) -> DataFrame:
    """Bays filled: the union is widened and then narrowed again by each distance in turn."""
    traps = union(rings, ring)
    for d in distances:
        grown = cut(overlay(sides(cut(traps)).unionByName(edges(around(outline(traps), d), "ring"))))
        rim = edges(around(outline(grown), d), "ring", 1)
        traps = cut(overlay(sides(grown).unionByName(rim), "difference"))
    return traps


def _in_any(x: Column, y: Column) -> Column:
    """Whether a point lies in the ring _r, its left and lower border with it, from the ring's own corners: no border is
    computed, so that points on it fall to one side by the last bit of their coordinates."""
    r = F.col("_r")

    def turn(s, k):
        a, b = r[k - 1], r[k]
        up = b["y"] > a["y"]
        low, high = F.when(up, a).otherwise(b), F.when(up, b).otherwise(a)
        left = (x - low["x"]) * (high["y"] - low["y"]) >= (y - low["y"]) * (high["x"] - low["x"])
        return s + F.when((low["y"] <= y) & (y < high["y"]) & left, F.when(up, -1).otherwise(1)).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.size(r) - 1), F.lit(0), turn) > 0


def _held(points: DataFrame, x: str, y: str, rings: DataFrame, how: str) -> DataFrame:
    """The points in any of the rings (left_semi) or in none (left_anti); they meet in cells of a grid."""
    some = rings.select(oriented(rings.columns[0]).alias("_r")).where(F.size("_r") >= 4).distinct().withColumns({f"_{k}": c for k, c in ring_box("_r").items()})
    r = some.withColumn("_c", F.explode(cells(("_xmin", "_ymin", "_xmax", "_ymax"), CELL, 0.0))).alias("r")
    at = F.struct(F.floor(F.col(x).cast("double") / CELL).alias("i"), F.floor(F.col(y).cast("double") / CELL).alias("j"))
    return points.withColumn("_c", at).alias("p").join(r, (F.col("p._c") == F.col("r._c")) & _in_any(F.col(f"p.{x}"), F.col(f"p.{y}")), how).drop("_c")


def covered(points: DataFrame, x: str, y: str, traps: DataFrame, rings: DataFrame | None = None, others: DataFrame | None = None, op: str = "union") -> DataFrame:
    """The points that lie in any trapezoid, once each: both meet in bands of the trapezoids. Slanted sides of these are
    rounded where they were cut; with the rings (and others) that they were made from by the operation, points as near
    to such a side as that rounding are held against the rings themselves."""
    traps = cut(traps)
    borders = bands(traps)
    band = lambda c: F.lit(0)
    if borders:
        found = np.array(borders)

        @F.pandas_udf("int")
        def number(v):
            import pandas as pd

            return pd.Series(np.searchsorted(found, v.to_numpy(), side="right").astype(np.int32))

        band = number
    t = traps.withColumn("_band", F.explode(F.sequence(band(F.col("y0")), band(F.col("y1")))))
    p = points.withColumn("_band", band(F.col(y).cast("double")))
    share = (F.col(y) - F.col("y0")) / (F.col("y1") - F.col("y0"))
    inside = (F.col(y) >= F.col("y0")) & (F.col(y) < F.col("y1")) & (F.col(x) >= F.col("xl0") + share * (F.col("xl1") - F.col("xl0"))) & (F.col(x) < F.col("xr0") + share * (F.col("xr1") - F.col("xr0")))
    p, t = p.alias("p"), t.alias("t")
    met = F.col("p._band") == F.col("t._band")
    if rings is None:
        return p.join(t, met & inside, "left_semi").drop("_band")
    sure, near = F.lit(True), F.lit(False)
    for side in ("xl", "xr"):
        wide = F.col(f"{side}1") - F.col(f"{side}0")
        off = F.abs(F.col(x) - F.col(f"{side}0") - share * wide)
        close = (wide != 0) & (off <= NEAR * (1 + F.abs(F.col(x)) + F.abs(wide)))
        sure, near = sure & ~close, near | close
    level = (F.col(y) >= F.col("y0")) & (F.col(y) < F.col("y1"))
    slanted = t.where("xl0 <> xl1 or xr0 <> xr1").alias("t")
    doubtful = p.join(slanted, met & level & near, "left_semi").drop("_band")
    if op == "union":
        settled = _held(doubtful, x, y, rings if others is None else rings.union(others), "left_semi")
    else:
        settled = _held(_held(doubtful, x, y, rings, "left_semi"), x, y, others, "left_anti" if op == "difference" else "left_semi")
    return p.join(t, met & inside & sure, "left_semi").drop("_band").unionByName(settled)
