"""Text artefacts: map, tile-cache and layer configuration, headers, legends and trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Coarsest resolution of the tile ladders, in metres and degrees; widest legend in pixels (fixed values).
MERCATOR_BASE, DEGREE_BASE, LEGEND = 156543.0339, 1.40625, 720


def resolutions(spark, base: float, levels: int = 25) -> DataFrame:
    return spark.range(levels).select(F.col("id").alias("z"), (F.lit(base) / F.pow(F.lit(2.0), "id")).alias("res"))


def layer_lines(layers: DataFrame) -> DataFrame:
    """A map-server block for each layer: extent, day, and the scale split of its overview."""
    text = F.format_string('LAYER NAME "%s_%d" EXTENT %.1f %.1f %.1f %.1f STATUS ON END', "dsname", "ts", "w", "s", "e", "n")
    return layers.withColumn("line", text)


def without_bbox_beyond(layers: DataFrame, latitude: float = 86.0) -> DataFrame:
    """Tile-cache entries: layers beyond the latitude carry no box."""
    box = F.when((F.col("n") <= latitude) & (F.col("s") >= -latitude), F.format_string("bbox=%.1f,%.1f,%.1f,%.1f", "w", "s", "e", "n")).otherwise("")
    return layers.withColumn("entry", F.concat_ws("|", F.concat(F.lit("["), "dsname", F.lit("]")), box))


def idempotent_includes(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Includes that a file does not have yet."""
    return wanted.join(present, key, "left_anti")


def legend(swatches: DataFrame, pos: str, label: str, *keys: str, width: int = LEGEND, letter: int = 7) -> DataFrame:
    """x of each swatch of a legend (few for each key) and whether its label is drawn: only if it does not run into
    the one drawn before it, which a fold over the ordered swatches decides."""
    item = F.struct(F.col(pos).alias("pos"), F.col(label).alias("label"))
    g = swatches.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("items"))
    g = g.withColumn("step", F.least(F.floor(F.lit(width) / F.size("items")), F.lit(40)).cast("int"))
    start = F.struct(F.lit(0).cast("int").alias("free"), F.array().cast("array<boolean>").alias("drawn"))

    def step(acc: Column, k: Column) -> Column:
        x = k * F.col("step")
        fits = x >= acc["free"]
        end = (x + F.length(F.element_at(F.col("items"), k + 1)["label"]) * letter).cast("int")
        return F.struct(F.when(fits, end).otherwise(acc["free"]).alias("free"), F.concat(acc["drawn"], F.array(fits)).alias("drawn"))

    folded = g.withColumn("drawn", F.aggregate(F.sequence(F.lit(0), F.size("items") - 1), start, step, lambda a: a["drawn"]))
    out = folded.select(*keys, "step", "drawn", F.posexplode("items").alias("k", "item"))
    return out.select(*keys, F.col("item.pos").alias(pos), F.col("item.label").alias(label), (F.col("k") * F.col("step")).alias("x"), F.element_at("drawn", F.col("k") + 1).alias("drawn"))


def header(raster: DataFrame) -> DataFrame:
    """Text header of a raw binary raster."""
    return raster.withColumn("header", F.concat_ws("\n", F.concat(F.lit("PROJECTION = "), "proj"), F.format_string("NLINES = %d", "lines"), F.format_string("NSAMPLES = %d", "samples"), F.format_string("PIXEL_SIZE = %.3f", "pixel"), F.format_string("DATA_TYPE = %s", "type")))


def merged_attributes(df: DataFrame, own: str, added: str) -> DataFrame:
    """Attributes copied to an output; the added ones win."""
    kept = F.map_filter(own, lambda k, v: ~F.map_contains_key(F.col(added), k))
    return df.withColumn("attributes", F.map_concat(kept, F.col(added)))


def stamped(df: DataFrame, ts: str, stamp: str) -> DataFrame:
    """The image date stamp at noon of the layer's day, where there is none."""
    return df.withColumn(stamp, F.coalesce(F.col(stamp), F.date_format(F.to_date(F.col(ts).cast("string"), "yyyyMMdd"), "yyyy:MM:dd 12:00:00")))


def tree_heights(spark, nodes: DataFrame, key: str = "id", parent: str = "parent") -> DataFrame:
    """Height of each node of a link tree: 0 for a leaf, else one more than its highest child. There are as many passes
    as the logarithm of the number of levels. Links in a circle are an error."""
    from .chains import heights

    return heights(nodes, key, parent)


def top_text(df: DataFrame, order: list[str], line: str, *keys: str) -> DataFrame:
    """Lines of a file in order, as one text for each key."""
    item = F.struct(*order, F.col(line).alias("_line"))
    return df.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["_line"]), "\n").alias("text"))


def progress(done: Column, total: Column, started: Column, now: Column) -> Column:
    """Expected end: start plus elapsed over the share done."""
    return F.when(done > 0, started + (now - started) * total / done)


def running(df: DataFrame, order: str, *keys: str) -> DataFrame:
    return df.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
