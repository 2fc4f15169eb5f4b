"""Masks from polygons, exact distances, buffers by distance, and the blending of coasts.

Polygons become masks line by line: each edge leaves a crossing on every line that it cuts, and a pixel is inside if
the crossings to its left sum up to more than nothing. There is no join of pixels and polygons, and the work is spread
over the lines. Distances are Euclidean and exact: one pass along the lines, then one down the columns, over the whole
image, so that the borders of tiles do not matter. A task holds one column at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def oriented(ring: str) -> Column:
    """The ring's points counter-clockwise."""
    c = F.col(ring)
    at = F.sequence(F.lit(1), F.size(c) - 1)
    twice = F.aggregate(at, F.lit(0.0), lambda s, i: s + c[i - 1]["x"] * c[i]["y"] - c[i]["x"] * c[i - 1]["y"])
    return F.when(twice < 0, F.reverse(c)).otherwise(c)


def crossings(rings: DataFrame, ring: str, uly: float, pixel: float, lines: int, *keys: str) -> DataFrame:
    """keys, l, x, turn: where the edges of closed rings cut the middle of each line, and whether they go down (1) or
    up (-1) there, so that the sum of turns from the left is positive inside."""
    e = rings.where(F.size(ring) >= 4).withColumn("_r", oriented(ring)).select(*keys, F.explode(F.transform(F.sequence(F.lit(1), F.size("_r") - 1), lambda i: F.struct(F.col("_r")[i - 1].alias("a"), F.col("_r")[i].alias("b")))).alias("e"))
    e = e.select(*keys, *[F.col(f"e.{p}.{c}").alias(f"{c}{k}") for k, p in enumerate("ab") for c in "xy"]).where("y0 <> y1")
    first, last = (uly - F.greatest("y0", "y1")) / pixel - 0.5, (uly - F.least("y0", "y1")) / pixel - 0.5
    low, high = F.greatest(F.floor(first), F.lit(0)), F.least(F.ceil(last), F.lit(lines - 1))
    cut = e.where(low <= high).withColumn("l", F.explode(F.sequence(low, high))).withColumn("y", F.lit(uly) - (F.col("l") + 0.5) * pixel)
    cut = cut.where((F.col("y0") <= F.col("y")) != (F.col("y1") <= F.col("y")))
    return cut.select(*keys, "l", (F.col("x0") + (F.col("y") - F.col("y0")) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))).alias("x"), F.when(F.col("y1") < F.col("y0"), 1).otherwise(-1).alias("turn"))


def within(px: DataFrame, rings: DataFrame, ring: str, ulx: float, uly: float, pixel: float, lines: int, mask: str, *keys: str) -> DataFrame:
    """The pixels with a mask of those whose middle lies in any of the rings. Rings may overlap."""
    cut = crossings(rings, ring, uly, pixel, lines, *keys)
    rows = px.select(*keys, "l", (F.lit(ulx) + (F.col("s") + 0.5) * pixel).alias("x"), F.lit(0).alias("turn"), F.struct(*[c for c in px.columns]).alias("_px"))
    rows = rows.unionByName(cut, allowMissingColumns=True)
    left = Window.partitionBy(*keys, "l").orderBy("x", F.col("_px").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(mask, F.sum("turn").over(left) > 0).where("_px is not null").select("_px.*", mask)


def envelope(at: np.ndarray, height: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The least of (x - at)^2 + height at each x of ``where``: the lower envelope of parabolas whose feet ``at``
    ascend. Integers, exact."""
    feet: list[int] = []
    values: list[int] = []
    starts: list[int] = []  # the first integer from which on a parabola is below the one before
    for p, h in zip(at.tolist(), height.tolist()):
        start = None
        while feet:
            q, g = feet[-1], values[-1]
            start = -((q * q + g - p * p - h) // (2 * (p - q)))  # the crossing, rounded up
            if len(feet) > 1 and start <= starts[-1]:
                feet.pop(), values.pop(), starts.pop()
                continue
            break
        starts.append(start if feet else -(1 << 62))
        feet.append(p)
        values.append(h)
    k = np.searchsorted(np.array(starts[1:], np.int64), where, side="right")
    return (where - np.array(feet, np.int64)[k]) ** 2 + np.array(values, np.int64)[k]


def squared_distance(px: DataFrame, target: Column, most: int, name: str, *keys: str) -> DataFrame:
    """The squared distance (in pixels) of each pixel to the nearest pixel for which the target holds, null beyond
    ``most``. An image has to have all pixels of its rectangle; where the target is null it does not hold."""
    across = Window.partitionBy(*keys, "l").orderBy("s")
    at = F.when(F.coalesce(target, F.lit(False)), F.col("s"))
    before = F.col("s") - F.max(at).over(across.rowsBetween(Window.unboundedPreceding, 0))
    back = Window.partitionBy(*keys, "l").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)  # a running value from the other end
    after = F.min(at).over(back) - F.col("s")
    near = F.least(before, after).cast("long")
    rows = px.withColumn("_g", F.when(near <= most, near))
    schema = px.withColumn(name, F.lit(None).cast("long")).schema
    order = [*keys, "s", "l"]
    held = rows.repartition(*keys, "s").sortWithinPartitions(*order)
    ids = [rows.columns.index(k) for k in (*keys, "s")]
    line, g = rows.columns.index("l"), len(rows.columns) - 1

    def column(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts).combine_chunks()
        lines = t.column(line).to_numpy().astype(np.int64)
        seen = t.column(g)
        there = seen.is_valid().to_numpy()
        out = np.zeros(len(lines), np.int64)
        far = np.ones(len(lines), bool)
        if there.any():
            out = envelope(lines[there], seen.drop_null().to_numpy().astype(np.int64) ** 2, lines)
            far = out > most * most
        yield from t.drop_columns(["_g"]).append_column(name, pa.array(out, mask=far)).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = [batch.column(k) for k in ids]
            new = np.zeros(batch.num_rows, bool)
            for c in codes:
                e = c.dictionary_encode().indices.fill_null(-1).to_numpy()
                new[1:] |= e[1:] != e[:-1]
            cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                key = tuple(c[a].as_py() for c in codes)
                if key != now and parts:
                    yield from column(parts)
                    parts = []
                now = key
                parts.append(batch.slice(a, b - a))
        if parts:
            yield from column(parts)

    return held.mapInArrow(run, schema)


def buffered(px: DataFrame, mask: str, radius: int, *keys: str) -> DataFrame:
    """The mask grown by a disc."""
    return squared_distance(px, F.col(mask), radius, "_d2", *keys).withColumn(mask, F.col("_d2").isNotNull()).drop("_d2")


def shrunk(px: DataFrame, mask: str, radius: int, *keys: str) -> DataFrame:
    """The mask without what lies within a disc of any pixel that is not in it."""
    return squared_distance(px, ~F.col(mask), radius, "_d2", *keys).withColumn(mask, F.col(mask) & F.col("_d2").isNull()).drop("_d2")


def filled_bays(px: DataFrame, mask: str, radii: list[int], *keys: str) -> DataFrame:
    """Bays closed: grown and shrunk by each radius in turn. What was in the mask stays in it."""
    for r in radii:
        px = shrunk(buffered(px.withColumn("_was", F.col(mask)), mask, r, *keys), mask, r, *keys).withColumn(mask, F.col(mask) | F.col("_was")).drop("_was")
    return px


def mosaic(px: DataFrame, layers: list[str], name: str) -> DataFrame:
    """The first layer that has a value."""
    return px.withColumn(name, F.coalesce(*layers))


def feathered(px: DataFrame, land: str, base: str, overlay: str, buffer: int, width: int, *keys: str) -> DataFrame:
    """The overlay over the water of an image: land is grown by the buffer; from its edge (the cutline) the overlay's
    share rises with the distance, to 1 at ``width`` pixels. Images without water stay as they are.

    Adds share, out. Where there is no overlay, the base stays, and the other way round."""
    grown = buffered(px.withColumn("_land", F.col(land)), "_land", buffer, *keys)
    far = squared_distance(grown, F.col("_land"), width, "_d2", *keys)
    share = F.least(F.coalesce(F.sqrt(F.col("_d2").cast("double")) / width, F.lit(1.0)), F.lit(1.0))
    out = F.col("share") * F.col(overlay) + (1 - F.col("share")) * F.col(base)
    return far.withColumn("share", share).withColumn("out", F.coalesce(out, base, overlay)).drop("_land", "_d2")
