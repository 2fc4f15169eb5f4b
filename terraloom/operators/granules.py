"""From granules to a composite as one plan: bands, mirror sides, places and day flags meet, are filtered, corrected,
resampled and accumulated within each granule, then the granules are laid over one another.

Everything up to the composite is keyed by granule and dealt out once. Tables of different grain come together as
tagged rows and by windows, not by joins, so that this one partitioning serves every step; a second exchange brings
the granules' output pixels together. A granule has a bounded number of pixels, whatever the archive holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.functions.geo import Grid

from .radiometry import corners, top_of_atmosphere
from .resample import LEAST_WEIGHT, expand, kernel_weights, quantised

#: Samples around the world at a pixel of one degree (fixed value).
AROUND = 360.0
#: Counts of pixels, of all bands, that a task gathers.
TASK_ROWS = 500_000
#: A granule whose longitudes are further apart than this crosses the dateline (fixed value).
CROSSING = 180.0


def gathered(px: DataFrame, places: DataFrame, mirrors: DataFrame, flags: DataFrame, bands: list[int]) -> DataFrame:
    """granule, scan, l, s, lat, lon, solz, b<k> for each band, mirror, day: one row for each pixel, from px (granule,
    band, scan, l, s, dn), places (granule, l, s, lat, lon, solz), mirrors (granule, scan, mirror) and flags (granule,
    day). The only exchange is by granule. A pixel without a place or of a scan without a mirror side has nulls."""
    names = ["granule", "scan", "l", "s", "band", "dn", "lat", "lon", "solz", "mirror", "day"]
    kinds = {"granule": "string", "scan": "long", "l": "long", "s": "long", "band": "int", "dn": "double", "lat": "double", "lon": "double", "solz": "double", "mirror": "int", "day": "int"}
    rows = None
    for df in (px, places, mirrors, flags):
        one = df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in names])
        rows = one if rows is None else rows.unionByName(one)
    # So many tasks that each holds a bounded number of rows, and never fewer than the shuffle's own.
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-px.count() // TASK_ROWS))
    rows = rows.repartition(tasks, "granule")
    by_granule, by_scan = Window.partitionBy("granule"), Window.partitionBy("granule", "scan")
    rows = rows.withColumn("day", F.max("day").over(by_granule)).withColumn("mirror", F.max("mirror").over(by_scan)).where("l is not null")
    values = [F.max(F.when(F.col("band") == b, F.col("dn"))).alias(f"b{b}") for b in bands]
    return rows.groupBy("granule", "l", "s").agg(F.max("scan").alias("scan"), *[F.max(c).alias(c) for c in ("lat", "lon", "solz", "mirror", "day")], *values)


def balanced(px: DataFrame, bands: list[int], gains: dict[int, dict[int, float]]) -> DataFrame:
    """Counts times the gain of their band on their mirror side; 1 where there is none."""
    out = {}
    for b in bands:
        g = F.lit(1.0)
        for side, gain in gains.get(b, {}).items():
            g = F.when(F.col("mirror") == side, F.lit(gain)).otherwise(g)
        out[f"b{b}"] = F.col(f"b{b}") * g
    return px.withColumns(out)


def reflectances(px: DataFrame, bands: list[int], offset: float, scale: float) -> DataFrame:
    """Counts to reflectance at the top of the atmosphere; null for counts below 0 and where the sun is down."""
    mus = F.cos(F.radians("solz"))
    return px.withColumns({f"b{b}": F.when((F.col(f"b{b}") >= 0) & (mus > 0), top_of_atmosphere(F.col(f"b{b}"), offset, scale, mus)) for b in bands})


def placed(px: DataFrame, grid: Grid) -> DataFrame:
    """ol, os: output coordinates on a geographic grid. A granule over the dateline is carried on eastwards, so that
    its cells stay whole."""
    by = Window.partitionBy("granule")
    over = F.max("lon").over(by) - F.min("lon").over(by) > CROSSING
    lon = F.when(over & (F.col("lon") < 0), F.col("lon") + AROUND).otherwise(F.col("lon"))
    return px.withColumns({"ol": grid.line(F.col("lat")), "os": grid.sample(lon)})


def resampled(px: DataFrame, bands: list[int], grid: Grid, samples: int) -> DataFrame:
    """granule, outl, outs, b<k>, w: bilinear means within each granule. The kernel's pixels are the corners of the
    cell, which come along with it, so no pixel is looked up. Pixels without a place make no cells. Samples beyond the
    dateline are those at the other end of the grid, which goes around the world."""
    names = [f"b{b}" for b in bands]
    c = corners(px, ["ol", "os", *names], "granule")
    named = {f"p{k}{x[1]}": F.col(f"{corner}.{x}") for k, corner in enumerate(("c00", "c01", "c11", "c10")) for x in ("ol", "os")}
    whole = F.lit(True)
    for v in named.values():
        whole &= v.isNotNull()
    q = c.where(whole).select("granule", "l", "s", *[v.alias(k) for k, v in named.items()], "c00", "c01", "c10", "c11")
    cells = expand(q, grid.lines, samples)
    wl, ws = kernel_weights(quantised(F.col("dl")), "bi"), kernel_weights(quantised(F.col("ds")), "bi")
    foot = [("c00", wl[0] * ws[0]), ("c01", wl[0] * ws[1]), ("c10", wl[1] * ws[0]), ("c11", wl[1] * ws[1])]
    spread = F.explode(F.array(*[F.struct(w.alias("w"), *[F.col(f"{k}.{n}").alias(n) for n in names]) for k, w in foot]))
    around = F.pmod("outs", F.lit(round(AROUND / grid.pixel)).cast("long")).alias("outs")
    parts = cells.select("granule", "outl", around, spread.alias("k")).select("granule", "outl", "outs", "k.*")
    means, seen = [], F.lit(0.0)
    for n in names:
        w = F.when(F.col(n).isNotNull(), F.col("w"))
        means.append(F.when(F.sum(w) > LEAST_WEIGHT, F.sum(F.col(n) * w) / F.sum(w)).alias(n))
    return parts.groupBy("granule", "outl", "outs").agg(*means, F.sum("w").alias("w"))


def composite(pixels: DataFrame, bands: list[int], low: float, high: float) -> DataFrame:
    """outl, outs, granule, r, g, b, a: of each output pixel the granule that has all bands and the greatest weight
    (to six decimals; of equals the first name), as bytes between low and high."""
    names = [f"b{b}" for b in bands]
    valid = F.lit(True)
    for n in names:
        valid &= F.col(n).isNotNull()
    best = F.min(F.struct((-F.round("w", 6)).alias("o"), "granule", *names)).alias("k")
    top = pixels.where(valid).groupBy("outl", "outs").agg(best)
    byte = lambda n: F.greatest(F.least(F.floor((F.col(f"k.{n}") - low) / (high - low) * 255 + 0.5), F.lit(255)), F.lit(0)).cast("int")
    shown = [names[min(k, len(names) - 1)] for k in range(3)]
    return top.select("outl", "outs", F.col("k.granule").alias("granule"), *[byte(n).alias(c) for n, c in zip(shown, "rgb")], F.lit(255).alias("a"))


def product(px: DataFrame, places: DataFrame, mirrors: DataFrame, flags: DataFrame, bands: list[int], gains: dict[int, dict[int, float]], grid: Grid, samples: int, offset: float, scale: float, low: float, high: float) -> DataFrame:
    """The composite of all granules of the day side, in one plan of two exchanges. ``samples`` is how far the grid
    goes, beyond the dateline too."""
    whole = gathered(px, places, mirrors, flags, bands).where("day = 1")
    corrected = reflectances(balanced(whole, bands, gains), bands, offset, scale)
    return composite(resampled(placed(corrected, grid), bands, grid, samples), bands, low, high)


def is_day(flag: Column) -> Column:
    """1 for granules of the day side and for those with both."""
    return F.when(flag.isin("Day", "Both"), 1).otherwise(0)
