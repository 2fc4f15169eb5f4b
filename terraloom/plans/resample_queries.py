"""Queries of resampling, projections, overviews and tiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.functions import ellipsoid, geo, isin
from terraloom.functions.geo import Grid
from terraloom.operators import resample as rs

from .registry import query
from .views import ACC, FOOT, LAY, PX1, acc, foot, lay, px1

_W = "l * 0.9::DOUBLE + s * 0.05::DOUBLE + 0.3::DOUBLE", "s * 0.95::DOUBLE - l * 0.02::DOUBLE + 6.0::DOUBLE"


def _warp(l, s):
    return tuple(x.replace("l *", f"({l}) *").replace("s *", f"({s}) *") for x in _W)


_WARPED = f"{PX1}, warped AS (SELECT l, s, sqrt(v) AS v, {_W[0]} AS ol, {_W[1]} AS os FROM px1)"
_QUADS = f"{_WARPED}, quads AS (SELECT a.l, a.s, a.ol AS p0l, a.os AS p0s, b.ol AS p1l, b.os AS p1s, c.ol AS p2l, c.os AS p2s, d.ol AS p3l, d.os AS p3s FROM warped a JOIN warped b ON b.l = a.l AND b.s = a.s + 1 JOIN warped c ON c.l = a.l + 1 AND c.s = a.s + 1 JOIN warped d ON d.l = a.l + 1 AND d.s = a.s)"
_CELLS = f"""{_QUADS}, cand AS (SELECT * FROM (SELECT *, unnest(generate_series(greatest(CAST(trunc(least(p0l, p1l, p2l, p3l)) AS BIGINT), 0), least(CAST(trunc(greatest(p0l, p1l, p2l, p3l)) AS BIGINT) + 1, (SELECT max(l) + 1 FROM px1)) - 1)) AS outl FROM quads)),
cand2 AS (SELECT *, unnest(generate_series(greatest(CAST(trunc(least(p0s, p1s, p2s, p3s)) AS BIGINT), 0), least(CAST(trunc(greatest(p0s, p1s, p2s, p3s)) AS BIGINT) + 1, 40) - 1)) AS outs FROM cand),
det AS (SELECT *, (p3l - p0l) * (p1s - p0s) - (p3s - p0s) * (p1l - p0l) AS d1, (p1l - p2l) * (p3s - p2s) - (p1s - p2s) * (p3l - p2l) AS d2 FROM cand2),
uv AS (SELECT *, ((outl - p0l) * (p1s - p0s) - (outs - p0s) * (p1l - p0l)) / d1 AS v1, ((p3l - p0l) * (outs - p0s) - (p3s - p0s) * (outl - p0l)) / d1 AS u1,
((outl - p2l) * (p3s - p2s) - (outs - p2s) * (p3l - p2l)) / d2 AS v2, ((p1l - p2l) * (outs - p2s) - (p1s - p2s) * (outl - p2l)) / d2 AS u2 FROM det),
ins AS (SELECT *, v1 >= 0 AND v1 <= 1 AND u1 >= 0 AND u1 <= 1 AND u1 + v1 <= 1 AS in1, v2 >= 0 AND v2 <= 1 AND u2 >= 0 AND u2 <= 1 AND u2 + v2 <= 1 AS in2 FROM uv),
cells AS (SELECT l, s, outl, outs, CASE WHEN in1 THEN v1 ELSE 1 - v2 END AS dl, CASE WHEN in1 THEN u1 ELSE 1 - u2 END AS ds FROM ins WHERE in1 OR in2)"""


def _warped(spark, sf_dir):
    ol, os = (x.replace("::DOUBLE", "D") for x in _W)
    return px1(spark, sf_dir).selectExpr("l", "s", "sqrt(v) AS v", f"{ol} AS ol", f"{os} AS os")


def _lines(px):
    """As many output lines as the band has."""
    return (px.agg(F.max("l")).first()[0] or 0) + 1


@query(f"WITH {_CELLS} SELECT l, s, outl, outs, round(dl, 6) AS dl, round(ds, 6) AS ds FROM cells")
def quad_expand(spark, sf_dir):
    px = _warped(spark, sf_dir)
    out = rs.expand(rs.quads(px), _lines(px), 40)
    return out.select("l", "s", "outl", "outs", F.round("dl", 6).alias("dl"), F.round("ds", 6).alias("ds"))


_BI = f"""{_CELLS}, q AS (SELECT l, s, outl, outs, floor(dl * 64 + 0.5) / 64 AS x, floor(ds * 64 + 0.5) / 64 AS y FROM cells),
spread AS (SELECT outl, outs, l, s, (1 - x) * (1 - y) AS w FROM q UNION ALL SELECT outl, outs, l, s + 1, (1 - x) * y FROM q UNION ALL SELECT outl, outs, l + 1, s, x * (1 - y) FROM q UNION ALL SELECT outl, outs, l + 1, s + 1, x * y FROM q),
contrib AS (SELECT outl, outs, s.l, s.s, w, v FROM spread s JOIN warped p ON p.l = s.l AND p.s = s.s)"""


@query(f"WITH {_BI} SELECT outl, outs, l, s, round(w, 9) AS w FROM contrib")
def triangle_weights(spark, sf_dir):
    px = _warped(spark, sf_dir)
    return rs.contributions(rs.expand(rs.quads(px), _lines(px), 40), px, "bi").select("outl", "outs", "l", "s", F.round("w", 9).alias("w"))


@query(f"""WITH {_BI}, agg AS (SELECT outl, outs, sum(w) AS w, sum(v * w) AS vw FROM contrib GROUP BY outl, outs)
SELECT outl, outs, round(coalesce(CASE WHEN w > 0.1 THEN vw / w END, -1.0), 9) AS v FROM (SELECT unnest(generate_series(0::BIGINT, (SELECT max(l) FROM px1))) AS outl) CROSS JOIN (SELECT unnest(generate_series(0::BIGINT, 39::BIGINT)) AS outs) LEFT JOIN agg USING (outl, outs)""")
def swath_to_grid(spark, sf_dir):
    px = _warped(spark, sf_dir)
    return rs.swath_to_grid(px, "bi", _lines(px), 40, -1.0).select("outl", "outs", F.round("v", 9).alias("v"))


@query(f"WITH {ACC} SELECT ol, os, round(CASE WHEN sum(w) > 0.1 THEN sum(v * w) / sum(w) END, 8) AS v FROM acc GROUP BY ol, os")
def weighted_resample(spark, sf_dir):
    return rs.weighted(acc(spark, sf_dir), "ol", "os").select("ol", "os", F.round("v", 8).alias("v"))


@query(f"WITH {ACC}, r AS (SELECT *, row_number() OVER (PARTITION BY ol, os ORDER BY w DESC, src, src2, v DESC) AS k FROM acc) SELECT ol, os, v, w FROM r WHERE k = 1")
def nearest_by_weight(spark, sf_dir):
    return rs.nearest(acc(spark, sf_dir), "ol", "os", order=("src", "src2"))


@query(f"""WITH {ACC}, agg AS (SELECT ol, os, CASE WHEN sum(w) > 0.1 THEN sum(v * w) / sum(w) END AS v FROM acc GROUP BY ol, os), grid AS (SELECT DISTINCT o_orderkey // 8 AS ol, unnest([1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]) AS os FROM orders)
SELECT ol, os, round(coalesce(v, -9999.0), 8) AS v FROM grid LEFT JOIN agg USING (ol, os)""")
def min_weight_fill(spark, sf_dir):
    values = rs.weighted(acc(spark, sf_dir), "ol", "os").select("ol", "os", "v")
    grid = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey div 8 AS ol").distinct().withColumn("os", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(8).cast("long"))))
    return rs.on_grid(values, grid, "ol", "os", fill=-9999.0).select("ol", "os", F.round("v", 8).alias("v"))


@query("""SELECT k, round(1 - x, 9) AS b0, round(x, 9) AS b1, round(-0.5 * (x + 1) * (x + 1) * (x + 1) + 2.5 * (x + 1) * (x + 1) - 4 * (x + 1) + 2, 9) AS c_1, round(1.5 * x * x * x - 2.5 * x * x + 1, 9) AS c0,
round(1.5 * (1 - x) * (1 - x) * (1 - x) - 2.5 * (1 - x) * (1 - x) + 1, 9) AS c1, round(-0.5 * (2 - x) * (2 - x) * (2 - x) + 2.5 * (2 - x) * (2 - x) - 4 * (2 - x) + 2, 9) AS c2 FROM (SELECT k, CAST(k AS DOUBLE) / 64 AS x FROM (SELECT DISTINCT CAST(floor((value * 0.37::DOUBLE - floor(value * 0.37::DOUBLE)) * 64 + 0.5) AS BIGINT) AS k FROM events))""")
def kernel_table(spark, sf_dir):
    """The weights at all offsets that pixels of the table have."""
    at = px1(spark, sf_dir).select((F.col("v") * 0.37).alias("x"))
    k = at.select((rs.quantised(F.col("x") - F.floor("x")) * rs.STEPS).cast("long").alias("k")).distinct().select("k", (F.col("k") / rs.STEPS).alias("x"))
    bi, cc = rs.kernel_weights(F.col("x"), "bi"), rs.kernel_weights(F.col("x"), "cc")
    named = {"b0": bi[0], "b1": bi[1], "c_1": cc[-1], "c0": cc[0], "c1": cc[1], "c2": cc[2]}
    return k.select("k", *[F.round(c, 9).alias(n) for n, c in named.items()])


@query(f"WITH {FOOT} SELECT id, round((90.0 - ymax) / 0.25, 6) AS line, round((xmin - -180.0) / 0.25, 6) AS sample FROM foot")
def geo_to_pixel(spark, sf_dir):
    return rs.pixel_of(foot(spark, sf_dir), Grid(-180.0, 90.0, 0.25), "xmin", "ymax").select("id", F.round("line", 6).alias("line"), F.round("sample", 6).alias("sample"))


@query(f"WITH {FOOT} SELECT id, round(6378137.0 * radians(xmin), 3) AS mx, round(6378137.0 * ln(tan(pi() / 4 + radians(ymin) / 2)), 3) AS my, round(6371007.181 * radians(xmin) * cos(radians(ymin)), 3) AS sx, round(6371007.181 * radians(ymin), 3) AS sy FROM foot")
def projections(spark, sf_dir):
    lon, lat = F.col("xmin"), F.col("ymin")
    named = {"mx": geo.mercator_x(lon), "my": geo.mercator_y(lat), "sx": geo.sinusoidal_x(lon, lat), "sy": geo.sinusoidal_y(lat)}
    return foot(spark, sf_dir).select("id", *[F.round(c, 3).alias(n) for n, c in named.items()])


_BACK = ("me", "si", "ps", "la", "al", "lc", "tm")


@query(f"WITH {FOOT} SELECT id, " + ", ".join(f"round(xmin, 6) AS {n}_lon, round(ymin, 6) AS {n}_lat" for n in _BACK) + " FROM foot")
def inverse_projections(spark, sf_dir):
    """Forward and back again by every projection gives the corner back."""
    f = foot(spark, sf_dir)
    lon, lat = F.col("xmin"), F.col("ymin")
    there = {
        "me": (geo.PROJECTIONS["mercator"](lon, lat), geo.mercator_inverse), "si": (geo.PROJECTIONS["sinusoidal"](lon, lat), geo.sinusoidal_inverse),
        "ps": (geo.polar_stereographic(lon, lat, 10.0), lambda x, y: geo.polar_stereographic_inverse(x, y, 10.0)),
        "la": (geo.lambert_azimuthal(lon, lat, 0.0, 20.0), lambda x, y: geo.lambert_azimuthal_inverse(x, y, 0.0, 20.0)),
        "al": (geo.albers(lon, lat, 20.0, 50.0, 0.0, 30.0), lambda x, y: geo.albers_inverse(x, y, 20.0, 50.0, 0.0, 30.0)),
        "lc": (geo.lambert_conformal(lon, lat, 20.0, 50.0, 0.0, 30.0), lambda x, y: geo.lambert_conformal_inverse(x, y, 20.0, 50.0, 0.0, 30.0)),
        "tm": (geo.transverse_mercator(lon, lat, 0.0), lambda x, y: geo.transverse_mercator_inverse(x, y, 0.0)),
    }
    wrap = lambda c: F.pmod(c + 180.0, F.lit(360.0)) - 180.0
    out = f.select("id", *[F.struct(*xy).alias(n) for n, (xy, _) in there.items()])
    cols = []
    for n, (_, back) in there.items():
        p = out[n]
        names = out.schema[n].dataType.names
        x, y = back(p[names[0]], p[names[1]])
        cols += [F.round(wrap(x), 6).alias(f"{n}_lon"), F.round(y, 6).alias(f"{n}_lat")]
    return out.select("id", *cols)


_PTS = """pts AS (SELECT id, unnest([xmin + i / 5.0::DOUBLE * (xmax - xmin), xmax, xmax - i / 5.0::DOUBLE * (xmax - xmin), xmin]) AS x, unnest([ymax, ymax - i / 5.0::DOUBLE * (ymax - ymin), ymin, ymin + i / 5.0::DOUBLE * (ymax - ymin)]) AS y FROM foot, (SELECT unnest([0, 1, 2, 3, 4]) AS i)),
pr AS (SELECT id, 6371007.181 * radians(x) * cos(radians(y)) AS x, 6371007.181 * radians(y) AS y FROM pts), box AS (SELECT id, min(x) AS ulx, max(y) AS uly, max(x) AS mx, min(y) AS my FROM pr GROUP BY id)"""


@query(f"WITH {FOOT}, {_PTS} SELECT id, round(ulx, 3) AS ulx, round(uly, 3) AS uly, CAST(trunc((mx - ulx) / 10000.0 + 0.5) AS BIGINT) AS samples, CAST(trunc((uly - my) / 10000.0 + 0.5) AS BIGINT) AS lines, round(ulx + trunc((mx - ulx) / 10000.0 + 0.5) * 10000.0, 3) AS lrx, round(uly - trunc((uly - my) / 10000.0 + 0.5) * 10000.0, 3) AS lry FROM box")
def grid_bounds(spark, sf_dir):
    out = rs.grid_bounds(foot(spark, sf_dir), geo.PROJECTIONS["sinusoidal"], 10000.0, "id")
    return out.select("id", "lines", "samples", *[F.round(c, 3).alias(c) for c in ("ulx", "uly", "lrx", "lry")])


_GEO = f"{PX1}, coarse AS (SELECT scan, l % 10 AS l, s, 40.0::DOUBLE + l * 0.1::DOUBLE + v / 10000 AS lat, CASE WHEN (l + s) % 37 = 0 THEN NULL ELSE s * 0.2::DOUBLE - v / 10000 END AS lon FROM px1 WHERE scan < (SELECT max(event_id) + 1 FROM events) // 400)"


@query(f"""WITH {_GEO}, fine AS (SELECT scan, l * 2 + a AS fl, s * 2 + b AS fs FROM coarse, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b)), g AS (SELECT *, fl / 2.0::DOUBLE - 0.25 AS gl, fs / 2.0::DOUBLE AS gs FROM fine),
h AS (SELECT *, least(greatest(CAST(trunc(gl) AS BIGINT), 0), 8) AS l0, least(greatest(CAST(trunc(gs) AS BIGINT), 0), 38) AS s0 FROM g)
SELECT h.scan, fl, fs, round((1 - (gl - l0)) * ((1 - (gs - s0)) * a.lat + (gs - s0) * b.lat) + (gl - l0) * ((1 - (gs - s0)) * c.lat + (gs - s0) * d.lat), 10) AS lat, round((1 - (gl - l0)) * ((1 - (gs - s0)) * a.lon + (gs - s0) * b.lon) + (gl - l0) * ((1 - (gs - s0)) * c.lon + (gs - s0) * d.lon), 10) AS lon
FROM h JOIN coarse a ON a.scan = h.scan AND a.l = l0 AND a.s = s0 JOIN coarse b ON b.scan = h.scan AND b.l = l0 AND b.s = s0 + 1 JOIN coarse c ON c.scan = h.scan AND c.l = l0 + 1 AND c.s = s0 JOIN coarse d ON d.scan = h.scan AND d.l = l0 + 1 AND d.s = s0 + 1""")
def swath_geolocation(spark, sf_dir):
    px = px1(spark, sf_dir)
    whole = px.groupBy("scan").agg(F.count("*").alias("n")).where("n = 400").select("scan")
    coarse = px.join(whole, "scan", "left_semi").selectExpr("scan", "l % 10 AS l", "s", "40D + l * 0.1D + v / 10000 AS lat", "CASE WHEN (l + s) % 37 = 0 THEN NULL ELSE s * 0.2D - v / 10000 END AS lon")
    out = rs.fine_geolocation(coarse, 2)
    return out.select("scan", "fl", "fs", F.round("lat", 10).alias("lat"), F.round("lon", 10).alias("lon"))


@query(f"""WITH {PX1}, e AS (SELECT scan, s, min(l) AS l0, max(l) AS l1 FROM px1 GROUP BY scan, s HAVING count(*) > 1)
SELECT scan, l, s, round(v, 6) AS v FROM (SELECT scan, l, s, v FROM px1 UNION ALL SELECT e.scan, l0 - 1, e.s, 2 * a.v - b.v FROM e JOIN px1 a ON a.l = l0 AND a.s = e.s JOIN px1 b ON b.l = l0 + 1 AND b.s = e.s UNION ALL SELECT e.scan, l1 + 1, e.s, 2 * a.v - b.v FROM e JOIN px1 a ON a.l = l1 AND a.s = e.s JOIN px1 b ON b.l = l1 - 1 AND b.s = e.s)""")
def scan_extend(spark, sf_dir):
    return rs.extend_scan(px1(spark, sf_dir)).withColumn("v", F.round("v", 6))


@query(f"WITH {PX1} SELECT ds, l // 8 AS bl, s // 8 AS bs, round(avg(v), 8) AS v, count(*) AS n FROM px1 GROUP BY ALL")
def overview_average(spark, sf_dir):
    return rs.overview(px1(spark, sf_dir), 8, "ds").withColumn("v", F.round("v", 8))


@query(f"WITH {PX1} SELECT level, l // level AS bl, s // level AS bs, round(avg(v), 8) AS v, count(*) AS n FROM px1, (SELECT unnest([2, 4, 8]) AS level) GROUP BY level, l // level, s // level")
def pyramid_levels(spark, sf_dir):
    return rs.pyramid(px1(spark, sf_dir), rs.levels(250, 40, 4)).withColumn("v", F.round("v", 8))


@query(f"WITH {PX1}, a AS (SELECT l, s, v, unnest(CASE WHEN l % 16 = 0 AND l >= 16 THEN [l // 16 - 1, l // 16] ELSE [l // 16] END) AS tl FROM px1) SELECT l, s, v, tl, unnest(CASE WHEN s % 16 = 0 AND s >= 16 THEN [s // 16 - 1, s // 16] ELSE [s // 16] END) AS ts FROM a")
def tile_with_halo(spark, sf_dir):
    return rs.tiles(px1(spark, sf_dir).select("l", "s", "v"), 16)


@query(f"WITH {FOOT}, c AS (SELECT id, unnest([0, 1, 2, 3, 4]) AS k, unnest([0, 100, 100, 0, 0]) AS i, unnest([0, 0, 50, 50, 0]) AS j, xmin, ymax FROM foot) SELECT id, k, round(xmin + i * 0.01::DOUBLE + j * 0.002::DOUBLE, 6) AS x, round(ymax + i * 0.001::DOUBLE + j * -0.01::DOUBLE, 6) AS y FROM c")
def footprints(spark, sf_dir):
    t = foot(spark, sf_dir).select("id", F.col("xmin").alias("xo"), F.lit(0.01).alias("xd"), F.lit(0.002).alias("xr"), F.col("ymax").alias("yo"), F.lit(0.001).alias("yr"), F.lit(-0.01).alias("yd"), F.lit(100).alias("nx"), F.lit(50).alias("ny"))
    return rs.footprint(t).select("id", F.posexplode("ring").alias("k", "p")).select("id", "k", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


_GRAN = """gran AS (SELECT lid, w AS ulx, n AS uly, CASE WHEN lid % 3 = 0 THEN -w ELSE e END AS urx, n AS ury, CASE WHEN lid % 4 = 0 THEN -w ELSE w END AS llx, s AS lly, CASE WHEN lid % 4 = 0 THEN -e ELSE e END AS lrx, s AS lry FROM lay)"""


@query(f"""WITH {LAY}, {_GRAN}, o AS (SELECT *, abs(ulx - llx) > 75 AND abs(urx - lrx) > 75 AS over_, lly < 0 AS south FROM gran),
p AS (SELECT lid, CASE WHEN over_ AND NOT south THEN CASE WHEN urx - 180 < -180 THEN urx + 180 ELSE urx - 180 END ELSE ulx END AS ulx, CASE WHEN over_ AND NOT south THEN CASE WHEN ulx - 180 < -180 THEN ulx + 180 ELSE ulx - 180 END ELSE urx END AS urx,
CASE WHEN over_ AND south THEN CASE WHEN lrx - 180 < -180 THEN lrx + 180 ELSE lrx - 180 END ELSE llx END AS llx, CASE WHEN over_ AND south THEN CASE WHEN llx - 180 < -180 THEN llx + 180 ELSE llx - 180 END ELSE lrx END AS lrx,
CASE WHEN over_ AND NOT south THEN 180 - ury ELSE uly END AS uly, CASE WHEN over_ AND NOT south THEN 180 - uly ELSE ury END AS ury, CASE WHEN over_ AND south THEN -180 - lry ELSE lly END AS lly, CASE WHEN over_ AND south THEN -180 - lly ELSE lry END AS lry FROM o),
q AS (SELECT *, (ulx > 90 OR llx > 90) AND (urx < -90 OR lrx < -90) AS line FROM p),
r AS (SELECT lid, CASE WHEN line AND ulx > 0 THEN ulx - 360 ELSE ulx END AS ulx, CASE WHEN line AND urx > 0 THEN urx - 360 ELSE urx END AS urx, CASE WHEN line AND llx > 0 THEN llx - 360 ELSE llx END AS llx, CASE WHEN line AND lrx > 0 THEN lrx - 360 ELSE lrx END AS lrx, uly, ury, lly, lry FROM q),
c AS (SELECT *, (ulx + urx + llx + lrx) / 4 AS x, (uly + ury + lly + lry) / 4 AS y FROM r)
SELECT lid, ulx, urx, llx, lrx, uly, ury, lly, lry, CASE WHEN x < -180 THEN x + 360 WHEN x > 180 THEN x - 360 ELSE x END AS cx, CASE WHEN y > 90 THEN 180 - y WHEN y < -90 THEN -180 - y ELSE y END AS cy FROM c""")
def granule_corners(spark, sf_dir):
    g = lay(spark, sf_dir).selectExpr(
        "lid", "w AS ulx", "n AS uly", "CASE WHEN lid % 3 = 0 THEN -w ELSE e END AS urx", "n AS ury", "CASE WHEN lid % 4 = 0 THEN -w ELSE w END AS llx", "s AS lly", "CASE WHEN lid % 4 = 0 THEN -e ELSE e END AS lrx", "s AS lry"
    )
    return rs.unwrap_corners(g)


_ISIN = isin.Grid(360, 1)


def _isin_columns(row):
    return f"greatest(CAST(floor(2 * cos(pi() / 2 * (1.0 - (least({row}, 359 - {row}) + 0.5) / 180.0::DOUBLE)) * 360 + 0.5) AS BIGINT), 2)"


@query(f"""WITH {LAY}, p AS (SELECT *, least(CAST(floor((90.0 - s) / 180.0 * 360) AS BIGINT), 359) AS "row", ((w + 360.0::DOUBLE) % 360.0::DOUBLE + 180.0) % 360.0::DOUBLE / 360.0 AS share FROM lay),
c AS (SELECT *, {_isin_columns('"row"')} AS nc FROM p) SELECT "row", least(CAST(floor(share * nc) AS BIGINT), nc - 1) AS col, count(*) AS layers, round(avg(CAST(ts AS DOUBLE)), 4) AS ts FROM c GROUP BY ALL""")
def isin_cells(spark, sf_dir):
    """Means over the cells of a grid whose rows have different numbers of columns."""
    row, col = _ISIN.cell(F.col("w"), F.col("s"))
    return lay(spark, sf_dir).select(row.alias("row"), col.alias("col"), "ts").groupBy("row", "col").agg(F.count("*").alias("layers"), F.round(F.avg(F.col("ts").cast("double")), 4).alias("ts"))


def _isin_place(k):
    y = f"({_ISIN.radius * 1.2} - (l + {isin.NESTED[4][0]} + {k} * {isin.NESTED[4][1]}) * 27000.0::DOUBLE)"
    return f"(SELECT lid, l, x, degrees({y} / {_ISIN.radius}::DOUBLE) AS lat FROM p)"


@query(f"""WITH {LAY}, p AS (SELECT lid, lid % 500 AS l, -20000000.0::DOUBLE + (lid * 7 % 1500) * 27000.0::DOUBLE AS x FROM lay),
a AS ({" UNION ALL ".join(f"SELECT * FROM {_isin_place(k)}" for k in range(4))}),
r AS (SELECT *, least(CAST(floor((90.0 - lat) / 180.0 * 360) AS BIGINT), 359) AS "row" FROM a WHERE abs(lat) <= 90),
s AS (SELECT *, {_isin_columns('"row"')} AS n FROM r), t AS (SELECT *, (floor((n + 1) / 2::DOUBLE) + x / {_ISIN.pitch}::DOUBLE) / n AS share FROM s),
g AS (SELECT lid, avg(share * 360.0 - 180.0) AS lon, avg(lat) AS lat FROM t WHERE share >= 0 AND share <= 1 GROUP BY lid)
SELECT lid, round(lon, 6) AS lon, round(g.lat, 6) AS lat FROM p LEFT JOIN g USING (lid)""")
def isin_nested(spark, sf_dir):
    """The places of coarse pixels as means over the four rows that are nested in them."""
    p = lay(spark, sf_dir).selectExpr("lid", "lid % 500 AS l", "lid * 7 % 1500 AS s")
    lon, lat = _ISIN.nested(F.col("l"), F.col("s"), -20000000.0, _ISIN.radius * 1.2, 27000.0, 4)
    return p.select("lid", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


_TM = f"""k AS (SELECT *, radians(lat) AS p, radians(lon - (floor((lon + 180) / 6) * 6 - 177)) AS d FROM pts),
c AS (SELECT *, {ellipsoid.WGS84.a} / sqrt(1 - {ellipsoid.WGS84.e2}::DOUBLE * sin(p) * sin(p)) AS n, tan(p) * tan(p) AS t, {ellipsoid.WGS84.e2 / (1 - ellipsoid.WGS84.e2)}::DOUBLE AS ep, d * cos(p) AS a FROM k),
m AS (SELECT *, ep * cos(p) * cos(p) AS k, {ellipsoid.WGS84.a} * ({" ".join(f"{s} {abs(v)!r}::DOUBLE * {f}" for v, s, f in zip(ellipsoid.WGS84._arc(), ("", "-", "+", "-"), ("p", "sin(2 * p)", "sin(4 * p)", "sin(6 * p)")))}) AS arc FROM c)"""


@query(f"""WITH {FOOT}, pts AS (SELECT id, xmin AS lon, ymin AS lat FROM foot), {_TM}
SELECT id, CAST(CASE WHEN lat < 0 THEN -1 ELSE 1 END * (floor((lon + 180) / 6) + 1) AS INTEGER) AS zone, round(500000 + 0.9996::DOUBLE * n * (a + (1 - t + k) * a ** 3 / 6 + (5 - 18 * t + t * t + 72 * k - 58 * ep) * a ** 5 / 120), 3) AS x,
round(CASE WHEN lat < 0 THEN 10000000 ELSE 0 END + 0.9996::DOUBLE * (arc + n * tan(p) * (a ** 2 / 2 + (5 - t + 9 * k + 4 * k * k) * a ** 4 / 24 + (61 - 58 * t + t * t + 600 * k - 330 * ep) * a ** 6 / 720)), 3) AS y FROM m""")
def utm_places(spark, sf_dir):
    """Every corner in its own zone, all zones in one pass: the central meridian is a column."""
    f = foot(spark, sf_dir).select("id", F.col("xmin").alias("lon"), F.col("ymin").alias("lat"))
    zone = ellipsoid.utm_zone(F.col("lon"), F.col("lat"))
    x, y = ellipsoid.transverse_mercator(ellipsoid.WGS84, F.abs(zone) * 6 - 183.0, 0.0, ellipsoid.UTM_SCALE, ellipsoid.UTM_EASTING).forward(F.col("lon"), F.col("lat"))
    return f.select("id", zone.alias("zone"), F.round(x, 3).alias("x"), F.round(y + F.when(zone < 0, ellipsoid.UTM_SOUTH).otherwise(0.0), 3).alias("y"))


_ROUND = {
    "mercator": ellipsoid.mercator(ellipsoid.WGS84, 30.0, 20.0), "albers": ellipsoid.albers(ellipsoid.WGS84, 20.0, 50.0, 30.0, 10.0), "lambert_conformal": ellipsoid.lambert_conformal(ellipsoid.WGS84, 20.0, 50.0, 30.0, 10.0),
    "polar_stereographic": ellipsoid.polar_stereographic(ellipsoid.WGS84, 40.0, 71.0), "lambert_azimuthal": ellipsoid.lambert_azimuthal(ellipsoid.WGS84, 45.0, 10.0),
}


@query(f"WITH {FOOT} SELECT id, name, round(xmin, 6) AS lon, round(40 + ymin / 4, 6) AS lat FROM foot, (SELECT unnest([{', '.join(f'{n!r}' for n in _ROUND)}]) AS name)")
def ellipsoidal_inverses(spark, sf_dir):
    """Forward and back on the ellipsoid gives every corner back to a tenth of a metre; the tests hold known points."""
    f = foot(spark, sf_dir).select("id", F.col("xmin").alias("lon"), (40 + F.col("ymin") / 4).alias("lat"))
    out = None
    for name, p in _ROUND.items():
        lon, lat = p.inverse(*p.forward(F.col("lon"), F.col("lat")))
        one = f.select("id", F.lit(name).alias("name"), F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"WITH {LAY} SELECT lid, CASE WHEN s >= 60 THEN 'north' WHEN s <= -60 THEN 'south' ELSE 'middle' END AS plane, round(w + 0.5, 6) AS lon, round(s + 0.25, 6) AS lat FROM lay")
def granule_planes(spark, sf_dir):
    """A point of each granule in the plane of its own centre, and back again."""
    g = lay(spark, sf_dir).select("lid", F.col("w").alias("cx"), F.col("s").alias("cy"))
    forward, inverse = ellipsoid.granule_plane(F.col("cx"), F.col("cy"))
    x, y = forward(F.col("cx") + 0.5, F.col("cy") + 0.25)
    lon, lat = inverse(F.col("x"), F.col("y"))
    there = g.withColumn("x", x).withColumn("y", y)
    plane = F.when(F.col("cy") >= 60, "north").when(F.col("cy") <= -60, "south").otherwise("middle")
    return there.select("lid", plane.alias("plane"), F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query(f"WITH {PX1} SELECT l, (s + 20) % 40 AS s, v FROM px1")
def recentred_grid(spark, sf_dir):
    """A grid from 0 to 360 degrees as one from -180 to 180."""
    return px1(spark, sf_dir).select("l", ellipsoid.recentred(F.col("s"), 40).alias("s"), "v")
