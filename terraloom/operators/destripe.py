"""Destriping by matching the detectors' empirical distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Valid counts (fixed values).
LOW, HIGH = 0, 32767


def valid(v: str = "v") -> Column:
    return F.col(v).between(LOW, HIGH)


def detector(line: Column, strip: int, mirrors: int = 2) -> Column:
    """Detector and mirror side of a line."""
    return F.pmod(line, F.lit(mirrors * strip))


def histogram(px: DataFrame, *keys: str) -> DataFrame:
    return px.where(valid()).groupBy(*keys, "v").agg(F.count("*").alias("n"))


def histogram_median(px: DataFrame, *keys: str) -> DataFrame:
    """Smallest valid value at which the cumulative count reaches half of all pixels, invalid ones included."""
    hist = histogram(px, *keys)
    cum = hist.withColumn("cum", F.sum("n").over(Window.partitionBy(*keys).orderBy("v")))
    total = px.groupBy(*keys).agg(F.expr("count(*) div 2").alias("half"))
    reached = cum.join(total, list(keys)) if keys else cum.crossJoin(F.broadcast(total))
    return reached.where("cum >= half").groupBy(*keys).agg(F.min("v").alias("median"))


def edf(px: DataFrame, *keys: str) -> DataFrame:
    """Share of a detector's valid pixels at or below each of its values."""
    w = Window.partitionBy(*keys)
    hist = histogram(px, *keys)
    return hist.select(*keys, "v", "n", (F.sum("n").over(w.orderBy("v")) / F.sum("n").over(w)).alias("edf"))


def match_tables(edfs: DataFrame, reference: int | Column, *keys: str) -> DataFrame:
    """det, v, lut for each key (granule and band, say): each detector's values as the reference detector would have
    given them. Of the reference's points, ordered by share, the first at or above the share and the last below it
    bracket the value; below its first point the line through its first two is carried on. All come from ordered
    passes over the points of one key, not from a join."""
    ref = F.col("det") == reference
    own = Window.partitionBy(*keys, "det").orderBy("edf")
    points = edfs.withColumns({"_v1": F.lead("v").over(own), "_e1": F.lead("edf").over(own)})
    marked = points.select(*keys, "det", "v", "edf", ref.alias("is_ref"), F.when(ref, F.struct("v", "edf", F.col("_v1").alias("v1"), F.col("_e1").alias("e1"))).alias("r"))
    # At equal shares the reference's own points come after the others, so they are "at or above".
    up = Window.partitionBy(*keys).orderBy(F.desc("edf"), F.desc("is_ref")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # from the far end
    down = Window.partitionBy(*keys).orderBy("edf", "is_ref").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = marked.withColumns({"hi": F.last("r", ignorenulls=True).over(up), "lo": F.last("r", ignorenulls=True).over(down)}).where(~F.col("is_ref"))
    carried = F.col("hi.v") + (F.col("hi.v1") - F.col("hi.v")) / (F.col("hi.e1") - F.col("hi.edf")) * (F.col("edf") - F.col("hi.edf"))
    x = F.when(F.col("lo").isNull(), F.coalesce(carried, F.col("hi.v"))).when(F.col("hi").isNull(), F.col("lo.v"))
    x = x.otherwise(F.col("lo.v") + (F.col("edf") - F.col("lo.edf")) / (F.col("hi.edf") - F.col("lo.edf")) * (F.col("hi.v") - F.col("lo.v")))
    return out.select(*keys, "det", "v", F.floor(x + 0.5).cast("long").alias("lut"))


def destripe(px: DataFrame, reference: int | Column, *keys: str) -> DataFrame:
    """Adds out: matched values, then shifted so that each key's pixels (a band of a granule) keep their median.
    Invalid pixels are left alone. A reference that differs between keys is a column that is one of the keys."""
    tables = match_tables(edf(px, *keys, "det"), reference, *keys)
    new = px.join(tables, [*keys, "det", "v"], "left").withColumn("m", F.when(F.col("lut").between(LOW, HIGH), F.col("lut")).otherwise(F.col("v")))
    after = histogram_median(new.select(*keys, F.col("m").alias("v")), *keys).withColumnRenamed("median", "after")
    before = histogram_median(px, *keys).withColumnRenamed("median", "before")
    # One row for each key; without keys one row.
    medians = after.join(before, list(keys)) if keys else after.crossJoin(before)
    shifted = new.join(medians, list(keys), "left") if keys else new.crossJoin(F.broadcast(medians))
    return shifted.withColumn("out", F.when(valid(), F.col("m") - (F.col("after") - F.col("before"))).otherwise(F.col("v"))).drop("lut", "m", "after", "before")


def nearest_good(bad: Column, detectors: int) -> Column:
    """Map of each bad detector to the nearest good one, the lower of two as near; empty without a good one."""
    good = F.filter(F.sequence(F.lit(0), F.lit(detectors - 1)), lambda g: ~F.array_contains(bad, g))
    best = lambda b: F.array_min(F.transform(good, lambda g: F.struct(F.abs(g - b).alias("far"), g.alias("g"))))["g"]
    return F.when(F.size(good) > 0, F.map_from_entries(F.transform(bad, lambda b: F.struct(b.alias("bad"), best(b).alias("rep"))))).otherwise(F.map_from_entries(F.array().cast("array<struct<bad:int,rep:int>>")))


def replace_bad(px: DataFrame, bad: list[int] | Column, detectors: int, *keys: str, det: str = "det") -> DataFrame:
    """Lines of bad detectors take the values of the nearest good one in the same scan of the same key (a band of a
    granule). ``bad`` may be a column with an array, the same for all rows of a key."""
    if isinstance(bad, list):
        if not bad:
            return px
        bad = F.array(*[F.lit(int(b)) for b in bad])
    rep = F.try_element_at(nearest_good(bad, detectors), F.col(det).cast("int"))
    # The detectors of one scan at one sample, few rows, side by side: one shuffle.
    column = Window.partitionBy(*keys, "scan", "s").orderBy(det).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = px.withColumn("_rep", rep).withColumn("_all", F.collect_list(F.struct(F.col(det).cast("int").alias("d"), F.col("v").alias("v"))).over(column))
    found = F.try_element_at(F.filter("_all", lambda x: x["d"] == F.col("_rep")), F.lit(1))["v"]
    return rows.withColumn("v", F.when(F.col("_rep").isNotNull(), F.coalesce(found, "v")).otherwise(F.col("v"))).select(*px.columns)
