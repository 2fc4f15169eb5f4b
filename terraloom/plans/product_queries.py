"""Queries of product drivers."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.functions import geo
from terraloom.functions.geo import Grid
from terraloom.operators import products

from .registry import query
from .views import DN, FOOT, PX1, PXW, dn, foot, px1, pxw, table


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 1000 WHEN 1 THEN 500 WHEN 2 THEN 250 WHEN 3 THEN 1000 WHEN 4 THEN 1000 END AS metres FROM part")
def file_kinds(spark, sf_dir):
    name = F.concat(F.element_at(F.array(*map(F.lit, ["MOD021KM", "MYD02HKM", "MOD02QKM", "MYD02CRS", "MOD09CRS", "other"])), (F.col("p_partkey") % 6 + 1).cast("int")), F.lit(".A2010001.hdf"))
    return table(spark, sf_dir, "part").select("p_partkey", products.pixel_size_of(name).alias("metres"))


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter([p_size % 18, 4, 3], lambda x: x BETWEEN 1 AND 16))), '|') AS bands, CASE WHEN p_size % 2 = 0 THEN '0|1' ELSE '1|1' END AS flags FROM part")
def band_mask(spark, sf_dir):
    size = F.col("p_size").cast("string")
    text = F.concat((F.col("p_size") % 18).cast("string"), F.lit(", 4,3"))
    masks = products.sds_masks(F.concat(F.lit("A,"), F.when(F.col("p_size") % 2 == 0, "0").otherwise("1"), F.lit(",1;B"), size))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(products.band_list(text), "|").alias("bands"), F.array_join(F.element_at(masks, "A"), "|").alias("flags"))


_META = "meta AS (SELECT p_partkey, p_partkey % 2 = 0 AS has_alpha, p_partkey % 3 = 0 AS has_mask, CASE WHEN p_partkey % 5 = 0 THEN '0' END AS srcnodata, p_size % 2 = 0 AS is_lossy, p_partkey % 4 AS nb FROM part)"


@query(f"WITH {_META} SELECT p_partkey, CASE WHEN has_alpha THEN 'alpha' WHEN has_mask THEN 'mask' WHEN srcnodata IS NOT NULL THEN 'nodata' WHEN is_lossy THEN 'near' ELSE 'exact' END AS collar, nb = 3 AND has_mask AND NOT has_alpha AND NOT is_lossy AS conformant FROM meta")
def collar_choice(spark, sf_dir):
    meta = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_partkey % 2 = 0 AS has_alpha", "p_partkey % 3 = 0 AS has_mask", "CASE WHEN p_partkey % 5 = 0 THEN '0' END AS srcnodata", "p_size % 2 = 0 AS is_lossy", "p_partkey % 4 AS nbands", "'Byte' AS type", "true AS is_wgs84", "p_size % 2 <> 0 AS is_tiled")
    return products.is_conformant(products.collar_choice(meta)).select("p_partkey", "collar", "conformant")


@query("""SELECT page_id, 'layers=' || CAST(page_id AS VARCHAR) || '&zoom=9' AS hash, CAST(page_id AS VARCHAR) AS layers, 'layers=' || CAST(page_id AS VARCHAR) || '&zoom=4' AS zoomed, 'layers=' || CAST(page_id AS VARCHAR) || '&zoom=9&lat=1' AS grown,
128e6::DOUBLE / pow(2.0, page_id % 20) AS altitude, 'host ' || url || ' at ' || url AS page FROM pages""")
def client_state(spark, sf_dir):
    h = F.concat(F.lit("layers="), F.col("page_id").cast("string"), F.lit("&zoom=9"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", h.alias("hash"))
    filled = products.substitute(F.replace(F.lit("@KIND@ ~ at ~"), F.lit("~"), F.col("url")), {"KIND": "host"})
    return pages.select(
        "page_id", "hash", products.hash_value(F.col("hash"), "layers").alias("layers"), products.hash_replaced(F.col("hash"), "zoom", F.lit("4")).alias("zoomed"),
        products.hash_replaced(F.col("hash"), "lat", F.lit("1")).alias("grown"), products.view_altitude(F.col("page_id") % 20).alias("altitude"), filled.alias("page"),
    )


@query(f"""WITH {PX1}, d AS (SELECT l, s, sqrt(v) AS v FROM px1), t AS (SELECT l AS tl, s AS ts, (10.0 - l * 0.07::DOUBLE - (-30.0)) AS y_, s * 0.3::DOUBLE + 1 AS x FROM d),
q AS (SELECT tl, ts, (20.0 - (10.0 - tl * 0.07::DOUBLE)) / 0.5 - 0.5 AS pl, ((ts * 0.3::DOUBLE + 1) - 0.0) / 0.5 - 0.5 AS ps FROM t), r AS (SELECT *, CAST(floor(pl) AS BIGINT) AS l0, CAST(floor(ps) AS BIGINT) AS s0 FROM q)
SELECT tl, ts, round((1 - (pl - l0)) * ((1 - (ps - s0)) * a.v + (ps - s0) * b.v) + (pl - l0) * ((1 - (ps - s0)) * c.v + (ps - s0) * d.v), 7) AS v
FROM r JOIN d a ON a.l = l0 AND a.s = s0 JOIN d b ON b.l = l0 AND b.s = s0 + 1 JOIN d c ON c.l = l0 + 1 AND c.s = s0 JOIN d d ON d.l = l0 + 1 AND d.s = s0 + 1""")
def warp_grid(spark, sf_dir):
    px = px1(spark, sf_dir).selectExpr("l", "s", "sqrt(v) AS v")
    target = px.selectExpr("l AS tl", "s AS ts", "s * 0.3D + 1 AS x", "10D - l * 0.07D AS y")
    out = products.warp(px, target, Grid(0.0, 20.0, 0.5), lambda x, y: (x, y))
    return out.withColumn("v", F.round("v", 7))


@query(f"WITH {PX1}, g AS (SELECT scan, l % 10 AS l, s, s * 0.2::DOUBLE - v / 10000 AS lon FROM px1), m AS (SELECT scan, (max(l) + 1) // 2 AS ml, (max(s) + 1) // 2 AS ms FROM g GROUP BY scan) SELECT m.scan, round(abs(b.lon - a.lon), 9) AS pixel FROM m JOIN g a ON a.scan = m.scan AND a.l = ml AND a.s = ms JOIN g b ON b.scan = m.scan AND b.l = ml AND b.s = ms + 1")
def pixel_sizes(spark, sf_dir):
    g = px1(spark, sf_dir).selectExpr("scan", "l % 10 AS l", "s", "s * 0.2D - v / 10000 AS lon")
    return products.pixel_sizes(g, "scan").withColumn("pixel", F.round("pixel", 9))


@query(f"WITH {FOOT}, p AS (SELECT id, unnest([0, 1]) AS k, unnest([xmin + 200, xmax - 200]) AS lon, unnest([ymin, ymax]) AS lat FROM foot), w AS (SELECT id, k, CASE WHEN lon > 180 THEN lon - 360 WHEN lon < -180 THEN lon + 360 ELSE lon END AS lon, lat FROM p) SELECT id, k, round(6378137.0 * radians(lon), 3) AS x, round(6378137.0 * ln(tan(pi() / 4 + radians(lat) / 2)), 3) AS y FROM w")
def vector_reproject(spark, sf_dir):
    point = lambda x, y: F.struct(x.alias("x"), F.col(y).alias("y"))
    rings = foot(spark, sf_dir).select("id", F.array(point(F.col("xmin") + 200, "ymin"), point(F.col("xmax") - 200, "ymax")).alias("ring"))
    out = products.reproject_rings(rings, "ring", geo.PROJECTIONS["mercator"])
    return out.select("id", F.posexplode("ring").alias("k", "p")).select("id", "k", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


@query(f"""WITH {PXW}, n AS (SELECT l, s, nullif(b1, 0) AS b1, nullif(b2, 0) AS b2, nullif(b3, 0) AS b3 FROM pxw), v AS (SELECT *, b1 IS NOT NULL AND b2 IS NOT NULL AND b3 IS NOT NULL AS ok FROM n)
SELECT l, s, CASE WHEN ok THEN CAST(floor(least(greatest((b1 + 300.0) * 255.0 / 600.0, 0), 255)) AS INTEGER) ELSE 0 END AS r, CASE WHEN ok THEN CAST(floor(least(greatest((b2 + 300.0) * 255.0 / 600.0, 0), 255)) AS INTEGER) ELSE 0 END AS g,
CASE WHEN ok THEN CAST(floor(least(greatest((b3 + 300.0) * 255.0 / 600.0, 0), 255)) AS INTEGER) ELSE 0 END AS b, CASE WHEN ok THEN 255 ELSE 0 END AS a FROM v""")
def multiband_composite(spark, sf_dir):
    return products.multiband(pxw(spark, sf_dir), products.Composite(["b1", "b2", "b3"], nodata=0.0, low=-300.0, high=300.0))


_PXG = f"""{DN}, pxg AS (SELECT 'g' || CAST(scan % 3 AS VARCHAR) AS granule, 1 AS band, scan // 3 AS scan, det AS row, s, v FROM dn
UNION ALL SELECT 'g' || CAST(scan % 3 AS VARCHAR), 2, scan // 3, det, s, CASE WHEN v = -1 THEN -1 ELSE v * 2 + det END FROM dn UNION ALL SELECT 'g' || CAST(scan % 3 AS VARCHAR), 3, scan // 3, det, s, v FROM dn),
mirror AS (SELECT DISTINCT granule, scan, scan % 2 AS side FROM pxg), counts AS (SELECT granule, band, count(*) FILTER (WHERE v BETWEEN 0 AND 32767) >= 10 * (max(s) + 1) AS enough FROM pxg GROUP BY granule, band)"""


def _pxg(spark, sf_dir):
    """Three granules with two mirror sides and three bands."""
    base = dn(spark, sf_dir).selectExpr("concat('g', scan % 3) AS granule", "scan div 3 AS scan", "det AS row", "s", "v")
    bands = [(1, "v"), (2, "CASE WHEN v = -1 THEN -1 ELSE v * 2 + row END"), (3, "v")]
    return base.withColumn("b", F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.expr(v).alias("v")) for b, v in bands]))).select("granule", "b.band", "scan", "row", "s", "b.v")


def _granules(spark):
    return spark.createDataFrame([("g0", False), ("g1", False), ("g2", True)], "granule string, destriped boolean")


def _detectors(spark):
    """Band 3 is not configured."""
    return spark.createDataFrame([(1, 3, [2, 7, 8]), (2, 5, [])], "band int, ref int, bad array<int>")


@query(f"""WITH {_PXG}, cfg AS (SELECT * FROM (VALUES (1, 3), (2, 5)) t(band, ref)),
m AS (SELECT p.granule, p.band, p.scan, p.row, p.s, p.v, p.row + 10 * z.side AS det, cfg.ref + 10 * coalesce(y.side, 0) AS refdet FROM pxg p JOIN cfg ON cfg.band = p.band JOIN counts c ON c.granule = p.granule AND c.band = p.band AND c.enough
JOIN mirror z ON z.granule = p.granule AND z.scan = p.scan LEFT JOIN mirror y ON y.granule = p.granule AND y.scan = cfg.ref WHERE p.granule <> 'g2'),
hist AS (SELECT granule, band, refdet, det, v, count(*) AS n FROM m WHERE v BETWEEN 0 AND 32767 GROUP BY ALL),
edfs AS (SELECT *, CAST(sum(n) OVER (PARTITION BY granule, band, det ORDER BY v) AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY granule, band, det) AS DOUBLE) AS edf FROM hist),
ref AS (SELECT granule, band, v, edf, row_number() OVER (PARTITION BY granule, band ORDER BY edf) AS rn FROM edfs WHERE det = refdet),
brk AS (SELECT e.granule, e.band, e.det, e.v, e.edf, min(r.v) FILTER (WHERE r.edf >= e.edf) AS hv, min(r.edf) FILTER (WHERE r.edf >= e.edf) AS he, max(r.v) FILTER (WHERE r.edf < e.edf) AS lv, max(r.edf) FILTER (WHERE r.edf < e.edf) AS le,
min(r.v) FILTER (WHERE r.rn = 2) AS v1, min(r.edf) FILTER (WHERE r.rn = 2) AS e1 FROM edfs e JOIN ref r ON r.granule = e.granule AND r.band = e.band WHERE e.det <> e.refdet GROUP BY e.granule, e.band, e.det, e.v, e.edf),
lut AS (SELECT granule, band, det, v, CAST(floor(CASE WHEN lv IS NULL THEN coalesce(hv + (v1 - hv) / (e1 - he) * (edf - he), hv) WHEN hv IS NULL THEN lv ELSE lv + (edf - le) / (he - le) * (hv - lv) END + 0.5) AS BIGINT) AS lut FROM brk),
new AS (SELECT m.*, CASE WHEN lut BETWEEN 0 AND 32767 THEN lut ELSE m.v END AS mv FROM m LEFT JOIN lut ON lut.granule = m.granule AND lut.band = m.band AND lut.det = m.det AND lut.v = m.v),
half AS (SELECT granule, band, count(*) // 2 AS half FROM m GROUP BY granule, band),
h0 AS (SELECT granule, band, v, sum(count(*)) OVER (PARTITION BY granule, band ORDER BY v) AS cum FROM new WHERE v BETWEEN 0 AND 32767 GROUP BY granule, band, v),
h1 AS (SELECT granule, band, mv AS v, sum(count(*)) OVER (PARTITION BY granule, band ORDER BY mv) AS cum FROM new WHERE mv BETWEEN 0 AND 32767 GROUP BY granule, band, mv),
meds AS (SELECT h.granule, h.band, (SELECT min(v) FROM h0 WHERE h0.granule = h.granule AND h0.band = h.band AND cum >= half) AS before, (SELECT min(v) FROM h1 WHERE h1.granule = h.granule AND h1.band = h.band AND cum >= half) AS after FROM half h),
shifted AS (SELECT n.granule, n.band, scan, row, s, CASE WHEN v BETWEEN 0 AND 32767 THEN mv - (after - before) ELSE v END AS v FROM new n LEFT JOIN meds d ON d.granule = n.granule AND d.band = n.band),
reps AS (SELECT * FROM (VALUES (1, 2, 1), (1, 7, 6), (1, 8, 9)) t(band, bad, rep))
SELECT x.granule, x.band, x.scan, x.row, x.s, coalesce(g.v, x.v) AS v FROM shifted x LEFT JOIN reps r ON r.band = x.band AND r.bad = x.row LEFT JOIN shifted g ON g.granule = x.granule AND g.band = x.band AND g.scan = x.scan AND g.s = x.s AND g.row = r.rep
UNION ALL SELECT p.granule, p.band, scan, row, s, v FROM pxg p JOIN counts c ON c.granule = p.granule AND c.band = p.band WHERE p.granule = 'g2' OR p.band = 3 OR NOT c.enough""")
def destripe_granules(spark, sf_dir):
    px = _pxg(spark, sf_dir)
    mirror = px.select("granule", "scan", (F.col("scan") % 2).alias("side")).distinct()
    return products.destripe_granules(px, _granules(spark), _detectors(spark), mirror, 10)


@query("SELECT o_orderkey AS granule, true AS destriped, CASE WHEN o_orderkey % 3 > 0 THEN '1,3,2 7 8;2,5,' END AS destripe_config FROM orders")
def destripe_stamp(spark, sf_dir):
    """Granules after destriping; those that were destriped before keep no configuration."""
    held = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS granule", "o_orderkey % 3 = 0 AS destriped")
    return products.stamp_destriped(held, _detectors(spark)).select("granule", "destriped", "destripe_config")
