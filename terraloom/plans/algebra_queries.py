"""Queries of map algebra."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.operators import algebra

from .registry import query
from .views import DN, PX1, PXW, dn, px1, pxw, table


@query(f"WITH {PX1} SELECT l, s, round(CASE WHEN v <= 10 THEN 0.0 WHEN v <= 100 THEN 0.0 + (v - 10) * (120.0 / 90) WHEN v <= 400 THEN 120.0 + (v - 100) * (135.0 / 300) ELSE 255.0 END, 6) AS out FROM px1")
def lut_piecewise(spark, sf_dir):
    return px1(spark, sf_dir).select("l", "s", F.round(algebra.lookup(F.col("v"), [(10, 0), (100, 120), (400, 255)]), 6).alias("out"))


_ROWS = [(0, 0, 128, 0.0), (0, 200, 0, 120.0), (255, 255, 0, 300.0), (255, 255, 255, 480.0)]


def _ramp(k):
    out = f"CASE WHEN v <= 0 THEN {_ROWS[0][k]}.0"
    for a, b in zip(_ROWS, _ROWS[1:]):
        out += f" WHEN v <= {b[3]} THEN {a[k]}.0 + (v - {a[3]}) * ({b[k] - a[k]}.0 / {b[3] - a[3]})"
    return out + f" ELSE {_ROWS[-1][k]}.0 END"


@query(f"WITH {PX1} SELECT l, s, round({_ramp(0)}, 6) AS r, round({_ramp(1)}, 6) AS g, round({_ramp(2)}, 6) AS b FROM px1")
def gradient_rgb(spark, sf_dir):
    rgb = algebra.gradient(F.col("v"), _ROWS)
    return px1(spark, sf_dir).select("l", "s", *[F.round(c, 6).alias(k) for k, c in rgb.items()])


_COLOURS = [(k, (k * 37) % 256, (k * 91) % 256, (k * 53) % 256, 255 if k % 5 else 0) for k in range(64)]


@query(f"WITH {DN} SELECT l, s, CAST(v AS BIGINT) AS idx, CASE WHEN v BETWEEN 0 AND 63 THEN v * 37 % 256 END AS r, CASE WHEN v BETWEEN 0 AND 63 THEN v * 91 % 256 END AS g, CASE WHEN v BETWEEN 0 AND 63 THEN v * 53 % 256 END AS b, CAST(CASE WHEN v BETWEEN 0 AND 63 THEN CASE WHEN v % 5 <> 0 THEN 255 ELSE 0 END END AS BIGINT) AS a FROM dn")
def palette_expand(spark, sf_dir):
    colours = spark.createDataFrame(_COLOURS, "idx long, r long, g long, b long, a long")
    return algebra.palette(dn(spark, sf_dir).select("l", "s", F.col("v").alias("idx")), colours, "idx").select("l", "s", "idx", "r", "g", "b", "a")


@query(f"WITH {PXW} SELECT l, s, round((b1 - b2) / nullif(b1 + b2, 0), 6) AS ndvi FROM pxw")
def band_math(spark, sf_dir):
    return algebra.band_math(pxw(spark, sf_dir), "round((b1 - b2) / nullif(b1 + b2, 0), 6)", "ndvi").select("l", "s", "ndvi")


@query(f"WITH {PX1} SELECT l, s, CAST(floor(least(greatest((v - 20.0) * 255.0 / 380.0, 0.0), 255.0)) AS INTEGER) AS out FROM px1")
def rescale_byte(spark, sf_dir):
    return px1(spark, sf_dir).select("l", "s", algebra.rescale(F.col("v"), 20.0, 400.0).alias("out"))


@query(f"WITH {PXW} SELECT l, s, CASE WHEN b1 <> 0 AND b2 > -100 AND b3 < 120 THEN b4 END AS b4 FROM pxw")
def mask_and(spark, sf_dir):
    valid = algebra.all_valid(F.col("b1") != 0, F.col("b2") > -100, F.col("b3") < 120)
    return algebra.masked(pxw(spark, sf_dir), "b4", valid).select("l", "s", "b4")


@query(f"WITH {PXW}, {PX1} SELECT x.l, x.s, b1 AS r, b2 AS g, b3 AS b, CASE WHEN p.v > 100 THEN 255 ELSE 0 END AS a FROM pxw x JOIN px1 p ON x.l = p.l AND x.s = p.s")
def rgba_stack(spark, sf_dir):
    alpha = px1(spark, sf_dir).select("l", "s", F.when(F.col("v") > 100, 255).otherwise(0).alias("a"))
    return pxw(spark, sf_dir).join(alpha, ["l", "s"]).select("l", "s", F.col("b1").alias("r"), F.col("b2").alias("g"), F.col("b3").alias("b"), "a")


@query(f"""WITH {PXW}, a AS (SELECT l, s, acos(least(greatest((b1 * 80.0 + b2 * 40.0 + b3 * 60.0 + b4 * 20.0) / (sqrt(b1 * b1 + b2 * b2 + b3 * b3 + b4 * b4) * sqrt(80.0 * 80 + 40.0 * 40 + 60.0 * 60 + 20.0 * 20)), -1.0), 1.0)) AS angle FROM pxw)
SELECT l, s, round(angle, 6) AS angle, CAST(exp(-angle * angle / (2 * 0.5)) BETWEEN 0.2 AND 1.0 AS INTEGER) AS cloud FROM a""")
def spectral_angle_mask(spark, sf_dir):
    ref = F.array(*[F.lit(x) for x in (80.0, 40.0, 60.0, 20.0)])
    px = pxw(spark, sf_dir).withColumn("angle", algebra.spectral_angle(F.array("b1", "b2", "b3", "b4"), ref))
    return px.select("l", "s", F.round("angle", 6).alias("angle"), algebra.cloud(F.col("angle"), 0.5, 0.2, 1.0).alias("cloud"))


@query(f"""WITH {DN}, w AS (SELECT l, s, CASE v % 3 WHEN 0 THEN 0 WHEN 1 THEN 255 ELSE 128 END AS a, CASE v % 2 WHEN 0 THEN 0 ELSE 255 END AS b FROM dn)
SELECT l, s, a IN (0, 255) AND b IN (0, 255) AND NOT (a = 255 AND b = 255) AS collar FROM w""")
def washout_mask(spark, sf_dir):
    px = dn(spark, sf_dir).selectExpr("l", "s", "CAST(CASE v % 3 WHEN 0 THEN 0 WHEN 1 THEN 255 ELSE 128 END AS DOUBLE) AS a", "CAST(CASE v % 2 WHEN 0 THEN 0 ELSE 255 END AS DOUBLE) AS b")
    return px.select("l", "s", algebra.washed_out([F.col("a"), F.col("b")]).alias("collar"))


@query(f"WITH {DN} SELECT scan, NOT (min(m) = 0 AND max(m) = 255) AS blank, max(m) = 0 AS blank_strict FROM (SELECT scan, CASE WHEN v > 480 OR scan % 3 = 0 THEN 0 ELSE 255 END AS m FROM dn) GROUP BY scan")
def blank_test(spark, sf_dir):
    mask = dn(spark, sf_dir).selectExpr("scan", "CASE WHEN v > 480 OR scan % 3 = 0 THEN 0 ELSE 255 END AS m")
    return mask.groupBy("scan").agg((~((F.min("m") == 0) & (F.max("m") == 255))).alias("blank"), (F.max("m") == 0).alias("blank_strict"))


@query(f"""WITH {PX1}, pan AS (SELECT l, s, sqrt(v) AS pan FROM px1), ms AS (SELECT l, s, avg(v) AS b1, max(v) AS b2 FROM (SELECT l // 4 AS l, s // 4 AS s, v FROM px1) GROUP BY l, s),
sm AS (SELECT a.l, a.s, a.pan, avg(b.pan) AS smooth FROM pan a JOIN pan b ON b.l BETWEEN a.l - 1 AND a.l + 1 AND b.s BETWEEN a.s - 1 AND a.s + 1 GROUP BY a.l, a.s, a.pan)
SELECT f.l, f.s, round(CASE WHEN smooth <> 0 THEN b1 * pan / smooth END, 8) AS b1, round(CASE WHEN smooth <> 0 THEN b2 * pan / smooth END, 8) AS b2 FROM sm f JOIN ms ON ms.l = f.l // 4 AND ms.s = f.s // 4""")
def pansharpen(spark, sf_dir):
    px = px1(spark, sf_dir)
    ms = px.groupBy(F.expr("l div 4").alias("l"), F.expr("s div 4").alias("s")).agg(F.avg("v").alias("b1"), F.max("v").alias("b2"))
    out = algebra.pansharpen(ms, px.select("l", "s", F.sqrt("v").alias("pan")), 4, ["b1", "b2"])
    return out.select("l", "s", F.round("b1", 8).alias("b1"), F.round("b2", 8).alias("b2"))


@query("SELECT event_type AS granule, count(*) AS n FROM events WHERE CASE event_id % 3 WHEN 0 THEN 'Day' WHEN 1 THEN 'Night' ELSE 'Both' END IN ('Day', 'Both') GROUP BY 1")
def day_filter(spark, sf_dir):
    flagged = table(spark, sf_dir, "events").selectExpr("event_type AS granule", "CASE event_id % 3 WHEN 0 THEN 'Day' WHEN 1 THEN 'Night' ELSE 'Both' END AS daynight")
    return flagged.where(F.col("daynight").isin("Day", "Both")).groupBy("granule").agg(F.count("*").alias("n"))
