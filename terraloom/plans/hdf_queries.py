"""Queries over HDF4 containers: the events become granules, each a container, which is scanned again."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.sources import hdf

from .registry import query
from .views import table

#: Granules of 100 lines of 40 samples.
_LAYOUT = hdf.Layout(least=8, frames=40, lines=10)
_SIZE, _SAMPLES = 4000, 40
_PLACE = f"'G' || CAST(event_id // {_SIZE} AS VARCHAR) AS granule, event_id % {_SIZE} // {_SAMPLES} AS line, event_id % {_SAMPLES} AS sample"
_PX = f"""px AS (SELECT {_PLACE}, 'EV_1KM' AS sds, band, CAST(floor(value) AS DOUBLE) * (band + 1) AS dn FROM events, (SELECT unnest([0, 1]) AS band)
UNION ALL SELECT {_PLACE}, 'EV_250' AS sds, 0 AS band, CAST(floor(value) AS DOUBLE) + 7 AS dn FROM events)"""


def _granules(spark, sf_dir):
    """granule, content: containers with a dataset of two bands and one of rank 2."""
    e = table(spark, sf_dir, "events").selectExpr(f"concat('G', event_id div {_SIZE}) AS granule", f"event_id % {_SIZE} div {_SAMPLES} AS line", f"event_id % {_SAMPLES} AS sample", "floor(value) AS dn")
    two = e.withColumn("band", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("sds", F.lit("EV_1KM")).withColumn("dn", F.col("dn") * (F.col("band") + 1))
    one = e.withColumn("band", F.lit(0)).withColumn("sds", F.lit("EV_250")).withColumn("dn", F.col("dn") + 7)
    return hdf.written(two.unionByName(one), "int32", {"_FillValue": -1.0, "scale_factor": 0.5, "add_offset": 1.0}, mirrors=True, layout=_LAYOUT)


@query(f"WITH {_PX} SELECT granule, sds, band, 1 AS ires, CAST(line // 10 AS INTEGER) AS scan, CAST(line AS INTEGER) AS line, CAST(sample AS INTEGER) AS sample, dn, (dn - 1) * 0.5::DOUBLE AS v FROM px")
def hdf_scan(spark, sf_dir):
    """Every pixel of every dataset, as stored and calibrated; pixels that fill up the last scan are null."""
    return hdf.scans(_granules(spark, sf_dir), layout=_LAYOUT).where("v is not null")


@query(f"WITH {_PX} SELECT granule, sds, 2 AS scan, CAST(line AS INTEGER) AS line, CAST(sample AS INTEGER) AS sample, dn FROM px WHERE sds = 'EV_1KM' AND band = 1 AND line // 10 = 2")
def hdf_scan_pruned(spark, sf_dir):
    """One band of one dataset, the third scan of each granule: nothing else is decoded."""
    return hdf.scans(_granules(spark, sf_dir), ["EV_1KM"], [1], 2, 2, _LAYOUT).where("v is not null").select("granule", "sds", "scan", "line", "sample", "dn")


@query(f"""WITH {_PX} SELECT granule, sds, CAST(CASE WHEN max(band) > 0 THEN 3 ELSE 2 END AS INTEGER) AS rank, CAST(max(band) + 1 AS INTEGER) AS bands, 'int32' AS type,
CAST((max(line) + 10) // 10 * 10 AS INTEGER) AS lines, CAST(max(sample) + 1 AS INTEGER) AS samples, 1 AS ires, -1.0::DOUBLE AS fill, 0.5::DOUBLE AS scale, 1.0::DOUBLE AS "offset" FROM px GROUP BY granule, sds""")
def hdf_datasets(spark, sf_dir):
    return hdf.datasets(_granules(spark, sf_dir), _LAYOUT).drop("dims", "dim_names")


@query(f"WITH {_PX} SELECT DISTINCT granule, sds, name, value FROM px, (VALUES ('_FillValue', -1.0::DOUBLE), ('scale_factor', 0.5::DOUBLE), ('add_offset', 1.0::DOUBLE)) t(name, value)")
def hdf_attributes(spark, sf_dir):
    return hdf.attributes(_granules(spark, sf_dir)).where("sds is not null").select("granule", "sds", "name", F.element_at("numbers", 1).alias("value"))


@query(f"WITH {_PX} SELECT granule, CAST(line // 10 % 2 AS INTEGER) AS mirror, count(*) AS n, sum(dn) AS total FROM px WHERE sds = 'EV_1KM' GROUP BY ALL")
def hdf_mirror_sides(spark, sf_dir):
    """Sums for each side of the mirror, which the table of the scans names: two reads of a granule meet by key."""
    g = _granules(spark, sf_dir)
    px = hdf.scans(g, ["EV_1KM"], layout=_LAYOUT).where("v is not null")
    return px.join(hdf.mirror_sides(g), ["granule", "scan"]).groupBy("granule", "mirror").agg(F.count("*").alias("n"), F.sum("dn").alias("total"))
