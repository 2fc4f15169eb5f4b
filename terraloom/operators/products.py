"""Drivers: choices by metadata, and chains of operators that make a product."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.functions.geo import Grid

from . import algebra, destripe, focal
from .radiometry import bilinear, corners

#: Prefixes of level-1 files and the pixel size they hold, in metres (fixed values).
FILE_KINDS = {"021KM": 1000, "02HKM": 500, "02QKM": 250, "02CRS": 1000, "09CRS": 1000}
#: Dataset and index in it of each band (fixed values).
BAND_SDS = {1: ("EV_250_Aggr1km_RefSB", 0), 2: ("EV_250_Aggr1km_RefSB", 1)} | {b: ("EV_500_Aggr1km_RefSB", b - 3) for b in range(3, 8)} | {b: ("EV_1KM_RefSB", b - 8) for b in range(8, 13)}


def pixel_size_of(name: Column) -> Column:
    """Metres, from the kind that stands behind a level-1 file's two-letter platform prefix; null for others."""
    out = F
    for k, size in FILE_KINDS.items():
        out = out.when(name.rlike(f"^M[OY]D{k}"), size)
    return out.otherwise(None)


def band_list(text: Column, n_bands: int = 16) -> Column:
    """Bands of a text as "1,4,3": ascending, distinct, within 1 .. n_bands."""
    numbers = F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("int"))
    return F.array_sort(F.array_distinct(F.filter(numbers, lambda x: x.between(1, n_bands))))


def sds_masks(text: Column) -> Column:
    """"A,0,1;B" as a map from dataset to its 0/1 band flags; no flags stand for all bands."""
    parts = F.transform(F.split(text, ";"), lambda x: F.split(F.trim(x), ","))
    return F.map_from_entries(F.transform(F.filter(parts, lambda p: p[0] != ""), lambda p: F.struct(p[0].alias("sds"), F.transform(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda v: v.try_cast("int")).alias("flags"))))


def collar_choice(df: DataFrame) -> DataFrame:
    """How a raster's valid area is found: its alpha, its mask, the source's nodata value, or the collar's colour,
    with some tolerance if the file is lossy."""
    c = F.when(F.col("has_alpha"), "alpha").when(F.col("has_mask"), "mask").when(F.col("srcnodata").isNotNull(), "nodata")
    return df.withColumn("collar", c.when(F.col("is_lossy"), "near").otherwise("exact"))


def is_conformant(df: DataFrame) -> DataFrame:
    """Already in the form of delivery: three byte bands, a mask and no alpha, in WGS 84, tiled."""
    ok = (F.col("nbands") == 3) & (F.col("type") == "Byte") & F.col("has_mask") & ~F.col("has_alpha") & F.col("is_wgs84") & F.col("is_tiled")
    return df.withColumn("conformant", F.coalesce(ok, F.lit(False)))


def substitute(text: Column, tokens: dict[str, str]) -> Column:
    """A template with its @TOKEN@ places filled."""
    for name, value in tokens.items():
        text = F.replace(text, F.lit(f"@{name}@"), F.lit(value))
    return text


def hash_value(hash_: Column, name: str) -> Column:
    """A parameter of a #a=1&b=2 fragment."""
    return F.element_at(F.str_to_map(F.ltrim(hash_, F.lit("#")), F.lit("&"), F.lit("=")), name)


def hash_replaced(hash_: Column, name: str, value: Column) -> Column:
    """The fragment with a parameter set, at its place if it is there, else at the end."""
    has = hash_.rlike(rf"(^#?|&){name}=")
    put = F.regexp_replace(hash_, F.lit(rf"((?:^#?|&){name}=)[^&]*"), F.concat(F.lit("$1"), value))
    return F.when(has, put).otherwise(F.concat(hash_, F.when(hash_.isin("", "#"), "").otherwise("&"), F.lit(f"{name}="), value))


def view_altitude(zoom: Column) -> Column:
    """Metres above ground for a map zoom."""
    return F.lit(128e6) / F.pow(F.lit(2.0), zoom)


def warp(px: DataFrame, target: DataFrame, source: Grid, inverse: Callable[[Column, Column], tuple[Column, Column]]) -> DataFrame:
    """Values of the target pixels (tl, ts, x, y): x, y carried into the source's projection, then bilinear between
    the source pixels around. Target pixels off the source get none."""
    sx, sy = inverse(F.col("x"), F.col("y"))
    t = target.withColumns({"_l": source.line(sy) - 0.5, "_s": source.sample(sx) - 0.5})
    t = t.withColumns({"l": F.floor("_l").cast("long"), "s": F.floor("_s").cast("long")})
    out = t.join(corners(px, ["v"]), ["l", "s"])
    return out.select("tl", "ts", bilinear("v", F.col("_l") - F.col("l"), F.col("_s") - F.col("s")).alias("v"))


def pixel_sizes(geolocation: DataFrame, *keys: str) -> DataFrame:
    """Degrees of a pixel of each granule: the step of longitude in the middle of its middle line."""
    mid = geolocation.groupBy(*keys).agg(F.expr("(max(l) + 1) div 2").alias("l"), F.expr("(max(s) + 1) div 2").alias("_s"))
    near = geolocation.join(mid, [*keys, "l"]).where("s between _s and _s + 1")
    return near.groupBy(*keys).agg(F.abs(F.max_by("lon", "s") - F.min_by("lon", "s")).alias("pixel"))


def reproject_rings(df: DataFrame, ring: str, project: Callable[[Column, Column], tuple[Column, Column]], wrap: bool = True) -> DataFrame:
    """Every point of a ring projected; longitudes beyond the dateline are wrapped first."""

    def point(p: Column) -> Column:
        lon = F.when(p["x"] > 180, p["x"] - 360).when(p["x"] < -180, p["x"] + 360).otherwise(p["x"]) if wrap else p["x"]
        x, y = project(lon, p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return df.withColumn(ring, F.transform(ring, point))


@dataclass(frozen=True)
class Composite:
    """How a multiband product is made: nodata, gap filling, a formula or three bands, table, and mask."""

    bands: list[str]
    nodata: float | None = None
    fill_gaps: int = 0
    formula: str | None = None
    table: list[tuple[float, float]] = field(default_factory=list)
    low: float = 0.0
    high: float = 255.0

    def __post_init__(self):
        if not self.bands:
            raise ValueError("no bands")
        if self.high <= self.low:
            raise ValueError("empty range")


def multiband(px: DataFrame, how: Composite) -> DataFrame:
    """Stack with nodata, fill gaps, formula or bands, table or rescaling to bytes, and the mask of all bands: l, s, r,
    g, b and a."""
    if how.nodata is not None:
        px = px.withColumns({b: F.when(F.col(b) != how.nodata, F.col(b)) for b in how.bands})
    if how.fill_gaps:
        for b in how.bands:
            px = focal.fill_nodata(px.withColumnRenamed(b, "v"), how.fill_gaps).withColumn("v", F.col("out")).drop("out").withColumnRenamed("v", b)
    valid = algebra.all_valid(*[F.col(b).isNotNull() for b in how.bands])
    if how.formula:
        px = algebra.band_math(px, how.formula, "_out")
        shown = ["_out"] * 3
    else:
        shown = [how.bands[min(k, len(how.bands) - 1)] for k in range(3)]
    byte = lambda c: F.floor(algebra.lookup(F.col(c), how.table)).cast("int") if how.table else algebra.rescale(F.col(c), how.low, how.high)
    return px.select("l", "s", *[F.coalesce(F.when(valid, byte(c)), F.lit(0)).alias(n) for n, c in zip("rgb", shown)], F.when(valid, 255).otherwise(0).alias("a"))


def destripe_granules(px: DataFrame, granules: DataFrame, config: DataFrame, mirror: DataFrame, strip: int) -> DataFrame:
    """Destripe the bands of the granules that are not destriped yet; everything else is passed on as it is.

    px: granule, band, scan (from 0 in each granule), row (of ``strip`` in a scan), s, v. granules: granule,
    destriped. config: band, ref (row of the reference detector), bad (rows); bands without an entry are passed on.
    mirror: granule, scan, side. A detector is a row on a mirror side; the reference's side is that of the scan
    numbered as its row. A band of fewer valid pixels than one strip has pixels is passed on. Each band of each
    granule is matched by its own distributions alone, and rows in are rows out.
    """
    columns = px.columns
    keys = ["granule", "band", "ref"]
    side = mirror.select("granule", F.col("scan").alias("ref"), F.col("side").alias("_ref_side"))
    set_up = px.join(granules.where("NOT destriped").select("granule", F.lit(True).alias("_todo")), "granule", "left").join(config, "band", "left")
    counts = set_up.where("_todo and ref is not null").groupBy("granule", "band").agg(F.count_if(destripe.valid()).alias("_valid"), (F.max("s") + 1).alias("_samples"))
    set_up = set_up.join(counts.where(F.col("_valid") >= strip * F.col("_samples")).select("granule", "band", F.lit(True).alias("_enough")), ["granule", "band"], "left")
    done = set_up.where("_enough is null").select(*columns)
    todo = set_up.where("_enough").drop("_todo", "_enough")
    todo = todo.join(mirror, ["granule", "scan"], "left").join(side, ["granule", "ref"], "left")
    todo = todo.withColumn("det", F.col("row") + strip * F.coalesce("side", F.lit(0))).withColumn("ref", F.col("ref") + strip * F.coalesce("_ref_side", F.lit(0)))
    matched = destripe.destripe(todo, F.col("ref"), *keys).withColumn("v", F.col("out"))
    fixed = destripe.replace_bad(matched, F.col("bad"), strip, "granule", "band", det="row")
    return done.unionByName(fixed.select(*columns))


def stamp_destriped(granules: DataFrame, config: DataFrame) -> DataFrame:
    """The granules after destriping: marked as such, with the configuration as text (band, reference, bad rows)."""
    line = F.concat_ws(",", "band", "ref", F.array_join("bad", " "))
    text = config.agg(F.array_join(F.sort_array(F.collect_list(line)), ";").alias("destripe_config"))  # a row of some bands
    return granules.crossJoin(F.broadcast(text)).withColumn("destripe_config", F.when(~F.col("destriped"), F.col("destripe_config"))).withColumn("destriped", F.lit(True))


def relief(dem: DataFrame, rows: list[tuple[int, int, int, float]], pixel: float, land: bool = True, nodata: float = -9999.0) -> DataFrame:
    """Coloured relief under hillshade: l, s, r, g, b and alpha. With ``land`` the sea (heights of 0 and less) is
    transparent; missing heights always are."""
    known = dem.withColumn("v", F.when(F.col("v") != nodata, F.col("v")))
    shaded = focal.hillshade(known, pixel=pixel)
    rgb = algebra.gradient(F.col("v"), rows)
    seen = F.col("v").isNotNull() & ((F.col("v") > 0) if land else F.lit(True))
    light = F.coalesce("shade", F.lit(255.0)) / 255
    return shaded.select("l", "s", *[F.floor(F.coalesce(c * light, F.lit(0.0))).cast("int").alias(n) for n, c in rgb.items()], F.when(seen, 255).otherwise(0).alias("a"))


def register_overrides(spark, functions: dict[str, tuple[Callable, str]]) -> None:
    """A user's own functions (name to function and SQL type) for use in queries and band expressions."""
    for name, (f, kind) in functions.items():
        spark.udf.register(name, F.pandas_udf(f, kind))
