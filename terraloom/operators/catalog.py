"""The layer catalog and ingestion bookkeeping as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.sources.staging import if_small

from terraloom.functions import geo

#: Latitudes beyond this have no place in the mercator copy of an extent (fixed value).
LATITUDE = 86.0


def layers_of(layers: DataFrame, dataset: str) -> DataFrame:
    """The layers of a dataset, by day."""
    return layers.where(F.col("dsname") == dataset).orderBy("ts", "lid")


def latest(layers: DataFrame, n: int = 2) -> DataFrame:
    """The n newest layers of every dataset, rank 1 the newest."""
    order = Window.partitionBy("dsname").orderBy(F.desc("ts"), F.desc("lid"))
    return layers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def drop_dataset(layers: DataFrame, dataset: str) -> DataFrame:
    return layers.where(~F.col("dsname").eqNullSafe(dataset))


def extents(layers: DataFrame, *keys: str) -> DataFrame:
    """West, south, east and north of all layers of each key."""
    return layers.groupBy(*keys).agg(F.min("w").alias("w"), F.min("s").alias("s"), F.max("e").alias("e"), F.max("n").alias("n"))


def with_extent_texts(layers: DataFrame) -> DataFrame:
    """Extents as "w s e n", and in mercator metres with latitudes clamped to 86 degrees."""
    low, high = F.greatest("s", F.lit(-LATITUDE)), F.least("n", F.lit(LATITUDE))
    return layers.withColumns(
        {"gw": geo.mercator_x(F.col("w")), "gs": geo.mercator_y(low), "ge": geo.mercator_x(F.col("e")), "gn": geo.mercator_y(high)}
    )


def upsert(layers: DataFrame, changes: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Changed rows take the place of those with the same key; the highest version wins, a change before a stored row."""
    both = layers.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    order = Window.partitionBy(*keys).orderBy(F.desc("_new"), F.desc(version))
    return both.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r", "_new")


def covering(tiles: DataFrame, x: float, y: float) -> DataFrame:
    """Tiles whose box holds the point, borders included."""
    return tiles.where((F.col("xmin") <= x) & (F.col("xmax") >= x) & (F.col("ymin") <= y) & (F.col("ymax") >= y))


def daily(px: DataFrame, when: str = "day") -> DataFrame:
    """Tumbling buckets of a day."""
    return px.groupBy("ds", when).agg(F.count("*").alias("n"), F.round(F.min("v"), 6).alias("vmin"), F.round(F.max("v"), 6).alias("vmax"))


def not_held(listing: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Rows of a remote listing that are not held yet."""
    return listing.join(held, key, "left_anti")


def changed(new: DataFrame, old: DataFrame, key: str, content: str) -> DataFrame:
    """Rows that are new or whose content differs, except those that report an error."""
    known = old.select(key, F.col(content).alias("_old"))
    return new.join(known, key, "left").where(~F.col(content).eqNullSafe(F.col("_old")) & ~F.col(content).contains("Error")).drop("_old")


def touched(layers: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Layers that a batch has rows for: the only ones to refresh."""
    return layers.join(batch.select(*keys).distinct(), keys, "left_semi")


def first_format(files: DataFrame, key: str, ext: str, priority: list[str]) -> DataFrame:
    """Files in the first format of the list that their group has."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(ext))
    ranked = files.withColumn("rank", rank).where("rank > 0")
    best = ranked.groupBy(key).agg(F.min("rank").alias("best"))
    return ranked.join(best, key).where("rank = best").drop("best")


def first_match(files: DataFrame, patterns: DataFrame, group: str, name: str, pos: str) -> DataFrame:
    """For each group and pattern the first file, by position, that has the pattern in its name in any case."""
    met = files.join(if_small(patterns, 1000), F.lower(name).contains(F.lower("pattern")))
    return met.groupBy(group, "pattern").agg(F.min_by(name, pos).alias(name), F.min(pos).alias(pos))


def complete(matches: DataFrame, group: str, n_patterns: int) -> DataFrame:
    """Groups that have a file for every pattern."""
    return matches.groupBy(group).agg(F.count_distinct("pattern").alias("n")).where(F.col("n") == n_patterns).select(group)


def with_sidecars(files: DataFrame, base: str, name: str, ext: str, sidecars: list[str]) -> DataFrame:
    """One row per main file: its sidecars sorted by name and joined by semicolons."""
    side = F.when(F.col(ext).isin(sidecars), F.col(name))
    return files.groupBy(base).agg(F.min(F.when(~F.col(ext).isin(sidecars), F.col(name))).alias("main"), F.array_join(F.sort_array(F.collect_set(side)), ";").alias("sidecars")).where("main IS NOT NULL")


def day_walk(spans: DataFrame, present: DataFrame) -> DataFrame:
    """Every day from start to stop of each subset that is not present yet: subset, day, yyyyddd."""
    days = spans.select("subset", F.explode(F.sequence("start", "stop")).alias("day"))
    return days.join(present, ["subset", "day"], "left_anti").withColumn("julian", F.date_format("day", "yyyyDDD").cast("int"))


def for_each_dataset(px: DataFrame, configs: DataFrame, on: Column) -> DataFrame:
    """Fan out: each configured sub-dataset sees the rows that its condition selects."""
    return px.join(if_small(configs, 1000), on)
