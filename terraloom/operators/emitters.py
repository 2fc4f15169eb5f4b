"""Configuration that is written for every layer: map-server blocks, tile-cache sections, and headers of rasters.

A layer's texts are columns, so a catalog of any size is written by as many tasks as it has partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Layers beyond this latitude cannot be shown in the web mercator projection (fixed value).
MERCATOR_LATITUDE = 86.0
#: Projection parameters in a header, and how many stand in a line (fixed values).
PARAMETERS, IN_LINE = 15, 3
#: Projections whose rasters may carry a datum, and the one ellipsoid that has one (fixed values).
WITH_DATUM = ("ALBERS_EQUAL_AREA", "EQUIRECTANGULAR", "GEOGRAPHIC", "MERCATOR", "TRANSVERSE_MERCATOR", "UTM", "LAMBERT_CONFORMAL_CONIC", "POLAR_STEREOGRAPHIC")
DATUM_SPHERE = "WGS 84"


def _text(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def block(name: str, *lines, depth: int = 1) -> Column:
    """A block of a map file: its lines (null ones are left out) between its name and END."""
    pad = "  " * depth
    return F.concat_ws("\n", F.lit(pad + name), *map(_text, lines), F.lit(pad + "END"))


def _line(depth: int, *parts) -> Column:
    return F.concat(F.lit("  " * depth), *[_text(p) for p in parts])


def style_class(label: str, expression: str, red: str, green: str, blue: str, width: int = 2) -> Column:
    """A class of features with its colour."""
    colour = F.concat_ws(" ", F.lit("        COLOR"), *[F.col(c).cast("string") for c in (red, green, blue)])
    style = block("STYLE", colour, f"        WIDTH {width}", depth=3)
    return block("CLASS", _line(3, "NAME '", F.col(label), "'"), _line(3, "EXPRESSION ", F.col(expression)), style, depth=2)


def vector_classes(classes: DataFrame, field: str, by_threshold: bool, *keys: str) -> DataFrame:
    """keys, classes: the text of all classes (pos, value, r, g, b, label) of each key, in order. By threshold the
    first class holds whose value is not exceeded; else values are compared as texts."""
    expression = F.format_string(f"([{field}] <= %s )", F.col("value").cast("string")) if by_threshold else F.format_string('"%s"', F.col("value").cast("string"))
    made = classes.withColumn("expression", expression).withColumn("text", style_class("label", "expression", "r", "g", "b"))
    listed = made.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pos", "text"))).alias("t"))
    return listed.select(*keys, F.concat_ws("\n", F.lit(f"    CLASSITEM '{field}'"), F.array_join(F.transform("t", lambda x: x["text"]), "\n")).alias("classes"))


def with_aliases(layers: DataFrame) -> DataFrame:
    """layers with alias: every layer under its day, and the last two of each dataset as latest and previous too."""
    last = Window.partitionBy("dsname").orderBy(F.desc("ts"), F.desc("lid"))
    alias = F.array_compact(F.array(F.col("ts").cast("string"), F.when(F.col("_k") == 1, "latest").when(F.col("_k") == 2, "previous")))
    return layers.withColumn("_k", F.row_number().over(last)).withColumn("alias", F.explode(alias)).drop("_k")


def extent() -> Column:
    return F.format_string("%.6f %.6f %.6f %.6f", "w", "s", "e", "n")


def map_layer(kind: str, suffix: str, index: Column, scale: Column | None, classes: Column | None, oversample: int, resample: str) -> Column:
    """One layer of a map file, named after its alias."""
    name = F.concat(F.lit("'"), "dsname", F.lit("_"), "alias", F.lit(suffix), F.lit("'"))
    title = F.concat(F.lit("      'wms_title' "), name)
    meta = block("METADATA", title, "      'wms_srs' 'EPSG:4326 EPSG:3857'", F.concat(F.lit("      'wms_extent' '"), extent(), F.lit("'")), "      'ows_enable_request' '*'", depth=2)
    raster = kind == "RASTER"
    processing = [f'    PROCESSING "OVERSAMPLE_RATIO={oversample}"', f'    PROCESSING "RESAMPLE={resample}"'] if raster else []
    lines = [
        _line(2, "NAME ", name), f"    TYPE {kind}", "    STATUS ON", "    DUMP TRUE" if raster else None, meta, _line(2, "TILEINDEX '", index, "'"),
        _line(2, "GROUP '", F.col("dsname"), "_", F.col("alias"), "'"), None if scale is None else _line(2, scale), *processing, classes,
    ]
    return block("LAYER", *[x for x in lines if x is not None])


def map_texts(layers: DataFrame, folder: str, scale: str, vector: str, classes: str, oversample: int = 3, resample: str = "AVERAGE") -> DataFrame:
    """layers (lid, dsname, ts, alias, w, s, e, n) with text, their map files. Where ``scale`` is not null there are two
    layers, of which one is shown up to that scale and the overview beyond it; else one for all scales. Where
    ``vector`` holds the first shows polygons with the classes, the overview is a raster anyhow."""
    own = F.concat(F.lit(f"{folder}/"), "dsname", F.col("ts").cast("string"), F.lit(".shp"))
    over = F.concat(F.lit(f"{folder}/overview_"), "dsname", F.col("ts").cast("string"), F.lit(".shp"))
    at = lambda word: F.when(F.col(scale).isNotNull(), F.format_string(f"{word} %.0f", scale))
    limit = at("MAXSCALEDENOM")

    def one(suffix, limit):
        raster = map_layer("RASTER", suffix, own, limit, None, oversample, resample)
        return F.when(F.col(vector), map_layer("POLYGON", suffix, own, limit, F.col(classes), oversample, resample)).otherwise(raster)

    pair = F.concat_ws("\n\n", one("_hires", limit), map_layer("RASTER", "_ovr", over, at("MINSCALEDENOM"), None, oversample, resample))
    return layers.withColumn("text", F.when(F.col(scale).isNotNull(), pair).otherwise(one("", None)))


def included(text: str, path: str) -> Column:
    """A map file with an include before its last END, unless it has it already. Without an END it stays as it is."""
    c, line = F.col(text), F.concat(F.lit("  INCLUDE '"), F.col(path), F.lit("'"))
    last = r"(?s)^(.*\n|)([ ]*END[ ]*(?:\n.*|))$"  # the first group takes all it can
    head, tail = F.regexp_extract(c, last, 1), F.regexp_extract(c, last, 2)
    return F.when(F.contains(c, F.col(path)) | (tail == ""), c).otherwise(F.concat(head, line, F.lit("\n"), tail))


def tile_cache(layers: DataFrame, project: str, url: str, levels: int = 24) -> DataFrame:
    """layers with section: their two sections of a tile cache, in web mercator and in degrees. Layers beyond the
    mercator's latitudes have no box."""
    name = F.concat(F.lit(f"{project}_"), "dsname", F.lit("_"), F.col("ts").cast("string"))
    common = [F.lit("type=WMS"), F.lit(f"url={url}?"), F.concat(F.lit("layers="), "dsname", F.lit("_"), F.col("ts").cast("string")), F.lit("extension=png")]
    shown = (F.col("n") < MERCATOR_LATITUDE) & (F.col("s") > -MERCATOR_LATITUDE)
    box = F.when(shown, F.format_string("#bbox=%.6f,%.6f,%.6f,%.6f", *[c for c in _mercator_box()]))
    first = F.concat_ws("\n", F.concat(F.lit("["), name, F.lit("]")), *common, F.lit("tms_type=google"), F.lit(f"levels={levels}"), F.lit("spherical_mercator=true"), box)
    second = F.concat_ws("\n", F.concat(F.lit("["), name, F.lit("_4326]")), *common, F.lit(f"levels={levels}"))
    return layers.withColumn("section", F.concat_ws("\n\n", first, second))


def _mercator_box() -> list[Column]:
    from terraloom.functions.geo import mercator_x, mercator_y

    return [mercator_x(F.col("w")), mercator_y(F.col("s")), mercator_x(F.col("e")), mercator_y(F.col("n"))]


def raster_header(rasters: DataFrame) -> DataFrame:
    """rasters with header, the text that goes with a raw binary raster.

    Columns: projection, zone (of UTM), parameters (15 doubles), ul_lat, ul_lon, lr_lat, lr_lon, ulx, uly, lrx, lry,
    band, type, lines, samples, pixel, fill, ellipsoid (null: none), big_endian. Corners and pixels of geographic
    rasters are in degrees."""
    c = F.col
    number = lambda x: F.lpad(F.format_string("%.9f", x), 24, " ")
    rows = [F.concat(*[number(F.element_at("parameters", k + j)) for j in range(1, IN_LINE + 1)]) for k in range(0, PARAMETERS, IN_LINE)]
    corner = lambda mark, name, x, y: F.format_string(f"{mark}{name} = ( %.9f %.9f )", x, y)
    kinds = (("UL", "ul", "ul"), ("UR", "ul", "lr"), ("LL", "lr", "ul"), ("LR", "lr", "lr"))
    datum = c("projection").isin(*WITH_DATUM) & F.coalesce(c("ellipsoid") == DATUM_SPHERE, F.lit(False))
    lines = [
        F.lit(""), F.concat(F.lit("PROJECTION_TYPE = "), "projection"), F.when(c("projection") == "UTM", F.format_string("\nUTM_ZONE = %d", "zone")), F.lit("\nPROJECTION_PARAMETERS = ("),
        F.concat(F.concat_ws("\n", *rows), F.lit(" )")), F.lit(""), *[corner("", f"{n}_CORNER_LATLON", c(f"{a}_lat"), c(f"{b}_lon")) for n, a, b in kinds], F.lit(""),
        *[corner("# ", f"{n}_CORNER_XY", c(f"{b}x"), c(f"{a}y")) for n, a, b in kinds], F.lit(""), F.lit("NBANDS = 1"), F.format_string("BANDNAMES = ( %s )", "band"), F.format_string("DATA_TYPE = ( %s )", "type"),
        F.format_string("NLINES = ( %d )", "lines"), F.format_string("NSAMPLES = ( %d )", "samples"), F.format_string("PIXEL_SIZE = ( %.12f )", "pixel"), F.format_string("BACKGROUND_FILL = ( %.6f )", "fill"),
        F.lit(""), F.concat(F.lit("ELLIPSOID_CODE = "), F.coalesce("ellipsoid", F.lit("No Ellipsoid"))), F.lit(""), F.concat(F.lit("DATUM = "), F.when(datum, "WGS84").otherwise("No Datum")),
        F.concat(F.lit("BYTE_ORDER = "), F.when(c("big_endian"), "big_endian").otherwise("little_endian")),
    ]
    return rasters.withColumn("header", F.concat_ws("\n", *lines))
