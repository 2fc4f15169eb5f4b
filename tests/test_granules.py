"""The chain from granules to a composite: its exchanges, and its steps against the plain operators."""

import re

import pytest
from pyspark.sql import functions as F

from terraloom.functions.geo import Grid
from terraloom.operators import granules, resample
from terraloom.plans import granule_queries as q

SF = "/root/testdata/sf0.001"


def test_two_exchanges(spark):
    """One by granule, one by output pixel; the inputs' own (distinct scans and granules) are cut off before."""
    px, places, mirrors, flags = (spark.createDataFrame(df.collect(), df.schema) for df in q._inputs(spark, SF))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = granules.product(px, places, mirrors, flags, q._BANDS, q._GAINS, q._GRID, q._SAMPLES, q._OFFSET, q._SCALE, q._LOW, q._HIGH)
        plan = made._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = re.findall(r"Exchange (\w+)\((\w+)#", plan)
    assert sorted(exchanges) == [("hashpartitioning", "granule"), ("hashpartitioning", "outl")], plan
    assert "Join" not in plan


def test_one_granule_equals_the_plain_resampler(spark):
    px, places, mirrors, flags = q._inputs(spark, SF)
    whole = granules.gathered(px, places, mirrors, flags, [1]).where("granule = 'G0'")
    at = granules.placed(granules.reflectances(granules.balanced(whole, [1], q._GAINS), [1], q._OFFSET, q._SCALE), q._GRID)
    got = {(r["outl"], r["outs"]): r["b1"] for r in granules.resampled(at, [1], q._GRID, q._SAMPLES).collect()}
    plain = resample.swath_to_grid(at.select("l", "s", F.col("b1").alias("v"), "ol", "os"), "bi", q._GRID.lines, q._SAMPLES, -1.0)
    want = {(r["outl"], r["outs"]): r["v"] for r in plain.where("v > -1").collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)


def rows(spark, n=6, lon0=179.9):
    px = spark.range(n * n).selectExpr("'A' AS granule", "CAST(0 AS BIGINT) AS scan", f"id div {n} AS l", f"id % {n} AS s", "1 AS band", "CAST(id AS DOUBLE) AS dn")
    lon = F.lit(lon0) + F.col("s") * 0.05
    places = px.select("granule", "l", "s", (10.0 - F.col("l") * 0.05).alias("lat"), F.when(lon >= 180, lon - 360).otherwise(lon).alias("lon"), F.lit(0.0).alias("solz"))
    return px, places, spark.createDataFrame([("A", 0, 1)], "granule string, scan long, mirror int"), spark.createDataFrame([("A", 1)], "granule string, day int")


def test_a_granule_over_the_dateline_goes_to_both_ends(spark):
    px, places, mirrors, flags = rows(spark)
    grid = Grid(-180.0, 10.1, 0.05, 20)
    out = granules.product(px, places, mirrors, flags, [1], {}, grid, 7300, 0.0, 0.001, 0.0, 1.0).collect()
    samples = {r["outs"] for r in out}
    assert samples and max(samples) > 7190 and min(samples) <= 3 and not any(10 < s < 7190 for s in samples)


def test_nights_and_missing_pieces(spark):
    px, places, mirrors, flags = rows(spark, lon0=20.0)
    grid = Grid(19.0, 11.0, 0.05, 40)
    make = lambda *t: granules.product(*t, [1], {1: {1: 2.0}}, grid, 60, 0.0, 0.001, 0.0, 1.0)
    assert make(px, places, mirrors, flags).count() > 10
    assert make(px, places, mirrors, flags.withColumn("day", F.lit(0))).count() == 0
    assert make(px, places.limit(0), mirrors, flags).count() == 0
    assert make(px.limit(0), places, mirrors, flags).count() == 0
    plain, doubled = (max(r["r"] for r in make(px, places, m, flags).collect()) for m in (mirrors.limit(0), mirrors))
    assert doubled == pytest.approx(2 * plain, abs=1)
