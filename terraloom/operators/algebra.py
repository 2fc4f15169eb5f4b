"""Map algebra: per-pixel expressions over bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.sources.staging import if_small


def lookup(v: Column, points: list[tuple[float, float]]) -> Column:
    """Piecewise linear table (in, out), clamped at its ends. Points ascend; a vertical step takes its last value."""
    out = F.when(v <= points[0][0], F.lit(float(points[0][1])))
    for (x0, y0), (x1, y1) in zip(points, points[1:]):
        if x1 > x0:
            out = out.when(v <= x1, F.lit(float(y0)) + (v - x0) * ((y1 - y0) / (x1 - x0)))
    return F.when(v.isNotNull(), out.otherwise(F.lit(float(points[-1][1]))))


def gradient(v: Column, rows: list[tuple[int, int, int, float]]) -> dict[str, Column]:
    """Red, green and blue tables from rows (r, g, b, value)."""
    return {name: lookup(v, [(row[3], row[k]) for row in rows]) for k, name in enumerate(("r", "g", "b"))}


def band_math(px: DataFrame, expression: str, into: str = "out") -> DataFrame:
    """A user's SQL expression over the bands b1 .. bn, as double."""
    return px.withColumn(into, F.expr(expression).cast("double"))


def rescale(v: Column, low: float, high: float) -> Column:
    """Linear to 0 .. 255, clamped, rounded down."""
    return F.floor(F.least(F.greatest((v - low) * 255.0 / (high - low), F.lit(0.0)), F.lit(255.0))).cast("int")


def masked(px: DataFrame, band: str, valid: Column) -> DataFrame:
    return px.withColumn(band, F.when(valid, F.col(band)))


def all_valid(*masks: Column) -> Column:
    """Valid where every mask is."""
    return reduce(lambda a, b: a & b, masks)


def palette(px: DataFrame, colours: DataFrame, index: str) -> DataFrame:
    """Expand palette indexes to colours (index, r, g, b, a); the table has at most a few hundred rows."""
    return px.join(if_small(colours), index, "left")


def spectral_angle(bands: Column, reference: Column) -> Column:
    """Angle between a pixel's spectrum and a reference, in radians."""
    dot = F.aggregate(F.zip_with(bands, reference, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    norm = lambda a: F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))
    return F.acos(F.least(F.greatest(dot / (norm(bands) * norm(reference)), F.lit(-1.0)), F.lit(1.0)))


def cloud(angle: Column, variance: float, low: float, high: float) -> Column:
    """1 where the Gaussian of the angle lies within the limits, else 0."""
    return F.exp(-angle * angle / (2 * variance)).between(low, high).cast("int")


def washed_out(bands: list[Column], top: float = 255.0) -> Column:
    """Every band is 0 or the top, and not all are the top: the colours of a washed-out collar."""
    return all_valid(*[b.isin(0.0, top) for b in bands]) & ~all_valid(*[b == top for b in bands])


def pansharpen(ms: DataFrame, pan: DataFrame, k: int, bands: list[str], radius: int = 1) -> DataFrame:
    """Each fine pixel: its coarse pixel's bands times pan over the mean pan of the square around it."""
    across, down = (Window.partitionBy(a).orderBy(b).rangeBetween(-radius, radius) for a, b in (("l", "s"), ("s", "l")))
    sums = pan.withColumns({"_t": F.sum("pan").over(across), "_n": F.count("pan").over(across)})
    fine = sums.withColumn("smooth", F.sum("_t").over(down) / F.sum("_n").over(down)).drop("_t", "_n")
    fine = fine.withColumn("ml", F.floor(F.col("l") / k).cast("long")).withColumn("ms_", F.floor(F.col("s") / k).cast("long"))
    coarse = ms.select(F.col("l").alias("ml"), F.col("s").alias("ms_"), *bands)
    joined = fine.join(coarse, ["ml", "ms_"])
    return joined.select("l", "s", *[F.when(F.col("smooth") != 0, F.col(b) * F.col("pan") / F.col("smooth")).alias(b) for b in bands])
