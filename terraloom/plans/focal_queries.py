"""Queries of neighbourhood operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.operators import coast, focal

from .registry import query
from .views import PX1, px1, table

_A, _D = "PARTITION BY l ORDER BY s", "PARTITION BY s ORDER BY l"


@query(f"""WITH {PX1}, d AS (SELECT l, s, v, v > 60 AS d FROM px1)
SELECT l, s, bool_or(d) OVER ({_A} ROWS UNBOUNDED PRECEDING) AND bool_or(d) OVER ({_A} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AND bool_or(d) OVER ({_D} ROWS UNBOUNDED PRECEDING) AND bool_or(d) OVER ({_D} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS valid FROM d""")
def collar_mask(spark, sf_dir):
    return focal.collar(px1(spark, sf_dir), F.col("v") > 60).select("l", "s", "valid")


_HOLES = f"{PX1}, h AS (SELECT l, s, CASE WHEN (l * 11 + s * 7) % 17 = 0 THEN -1.0 ELSE v END AS v FROM px1)"


def _holes(spark, sf_dir):
    return px1(spark, sf_dir).selectExpr("l", "s", "CASE WHEN (l * 11 + s * 7) % 17 = 0 THEN -1D ELSE v END AS v")


_AROUND = "LEFT JOIN h nw ON nw.l = h.l - 1 AND nw.s = h.s - 1 LEFT JOIN h n ON n.l = h.l - 1 AND n.s = h.s LEFT JOIN h ne ON ne.l = h.l - 1 AND ne.s = h.s + 1 LEFT JOIN h w ON w.l = h.l AND w.s = h.s - 1 LEFT JOIN h e ON e.l = h.l AND e.s = h.s + 1 LEFT JOIN h sw ON sw.l = h.l + 1 AND sw.s = h.s - 1 LEFT JOIN h so ON so.l = h.l + 1 AND so.s = h.s LEFT JOIN h se ON se.l = h.l + 1 AND se.s = h.s + 1"


@query(f"""WITH {_HOLES}, g AS (SELECT h.l, h.s, h.v, list_filter([nw.v, n.v, ne.v, sw.v, so.v, se.v], lambda x: x IS NOT NULL) AS rows_, list_filter([w.v, e.v], lambda x: x IS NOT NULL AND x <> -1) AS sides FROM h {_AROUND})
SELECT l, s, v, CASE WHEN v = -1 AND len(rows_) > 0 AND NOT list_contains(rows_, -1.0) THEN list_sort(list_concat(rows_, sides))[CAST(floor(len(list_concat(rows_, sides)) / 2.0 + 0.5) AS INTEGER)] ELSE v END AS out FROM g""")
def hole_fill(spark, sf_dir):
    return focal.fill_holes(_holes(spark, sf_dir), -1.0)


@query(f"""WITH {PX1}, h AS (SELECT l, s, CASE WHEN (l * 3 + s) % 7 < 3 OR (l > 20 AND l < 60 AND s > 5 AND s < 35) THEN NULL ELSE sqrt(v) END AS v FROM px1),
n AS (SELECT l, s, v, arg_max(s, s) FILTER (v IS NOT NULL) OVER ({_A} ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS s0, arg_min(s, s) FILTER (v IS NOT NULL) OVER ({_A} ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING) AS s1,
arg_max(l, l) FILTER (v IS NOT NULL) OVER ({_D} ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS l0, arg_min(l, l) FILTER (v IS NOT NULL) OVER ({_D} ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING) AS l1 FROM h),
j AS (SELECT n.*, a.v AS va, b.v AS vb, c.v AS vc, d.v AS vd, CASE WHEN s0 IS NOT NULL THEN 1.0 / (n.s - s0) ELSE 0 END AS wa, CASE WHEN s1 IS NOT NULL THEN 1.0 / (s1 - n.s) ELSE 0 END AS wb, CASE WHEN l0 IS NOT NULL THEN 1.0 / (n.l - l0) ELSE 0 END AS wc, CASE WHEN l1 IS NOT NULL THEN 1.0 / (l1 - n.l) ELSE 0 END AS wd
FROM n LEFT JOIN h a ON a.l = n.l AND a.s = s0 LEFT JOIN h b ON b.l = n.l AND b.s = s1 LEFT JOIN h c ON c.l = l0 AND c.s = n.s LEFT JOIN h d ON d.l = l1 AND d.s = n.s)
SELECT l, s, round(coalesce(v, CASE WHEN wa + wb + wc + wd > 0 THEN (wa * coalesce(va, 0) + wb * coalesce(vb, 0) + wc * coalesce(vc, 0) + wd * coalesce(vd, 0)) / (wa + wb + wc + wd) END), 6) AS out FROM j""")
def nodata_fill(spark, sf_dir):
    px = px1(spark, sf_dir).selectExpr("l", "s", "CASE WHEN (l * 3 + s) % 7 < 3 OR (l > 20 AND l < 60 AND s > 5 AND s < 35) THEN NULL ELSE sqrt(v) END AS v")
    return focal.fill_nodata(px, 12).select("l", "s", F.round("out", 6).alias("out"))


@query(f"""WITH {PX1}, h AS (SELECT l, s, v FROM px1),
g AS (SELECT h.l, h.s, ((nw.v + 2 * w.v + sw.v) - (ne.v + 2 * e.v + se.v)) * (5.0 / (8 * 0.01 * 111120.0)) AS dx, ((sw.v + 2 * so.v + se.v) - (nw.v + 2 * n.v + ne.v)) * (5.0 / (8 * 0.01 * 111120.0)) AS dy FROM h {_AROUND}),
k AS (SELECT *, (sin(radians(45)) - (dy * cos(radians(315)) * cos(radians(45)) - dx * sin(radians(315)) * cos(radians(45)))) / sqrt(1 + dx * dx + dy * dy) AS light FROM g)
SELECT l, s, round(CASE WHEN dx IS NOT NULL AND dy IS NOT NULL THEN CASE WHEN light <= 0 THEN 1.0 ELSE 1 + 254 * light END END, 5) AS shade FROM k""")
def hillshade(spark, sf_dir):
    return focal.hillshade(px1(spark, sf_dir).select("l", "s", "v"), pixel=0.01).select("l", "s", F.round("shade", 5).alias("shade"))


@query(f"""WITH {PX1}, g AS (SELECT a.l, a.s, a.v, b.v AS v01, c.v AS v10, d.v AS v11 FROM px1 a JOIN px1 b ON b.l = a.l AND b.s = a.s + 1 JOIN px1 c ON c.l = a.l + 1 AND c.s = a.s JOIN px1 d ON d.l = a.l + 1 AND d.s = a.s + 1),
k AS (SELECT *, CASE WHEN v > 100 THEN 8 ELSE 0 END + CASE WHEN v01 > 100 THEN 4 ELSE 0 END + CASE WHEN v11 > 100 THEN 2 ELSE 0 END + CASE WHEN v10 > 100 THEN 1 ELSE 0 END AS kind FROM g)
SELECT l, s, kind, round(CASE WHEN (v > 100) <> (v01 > 100) THEN (100 - v) / (v01 - v) END, 6) AS top, round(CASE WHEN (v01 > 100) <> (v11 > 100) THEN (100 - v01) / (v11 - v01) END, 6) AS right, round(CASE WHEN (v10 > 100) <> (v11 > 100) THEN (100 - v10) / (v11 - v10) END, 6) AS bottom, round(CASE WHEN (v > 100) <> (v10 > 100) THEN (100 - v) / (v10 - v) END, 6) AS left FROM k WHERE kind BETWEEN 1 AND 14""")
def contours(spark, sf_dir):
    out = focal.contour_cells(px1(spark, sf_dir).select("l", "s", "v"), 100.0)
    return out.select("l", "s", "kind", *[F.round(c, 6).alias(c) for c in ("top", "right", "bottom", "left")])


_CELLS = f"""{PX1}, g AS (SELECT a.l, a.s, a.v, b.v AS v01, c.v AS v10, d.v AS v11 FROM px1 a JOIN px1 b ON b.l = a.l AND b.s = a.s + 1 JOIN px1 c ON c.l = a.l + 1 AND c.s = a.s JOIN px1 d ON d.l = a.l + 1 AND d.s = a.s + 1),
k AS (SELECT *, CASE WHEN v > 100 THEN 8 ELSE 0 END + CASE WHEN v01 > 100 THEN 4 ELSE 0 END + CASE WHEN v11 > 100 THEN 2 ELSE 0 END + CASE WHEN v10 > 100 THEN 1 ELSE 0 END AS kind,
  (100 - v) / (v01 - v) AS ft, (100 - v01) / (v11 - v01) AS fr, (100 - v10) / (v11 - v10) AS fb, (100 - v) / (v10 - v) AS fl FROM g)"""
_STEPS = ((8, "lt"), (4, "tr"), (2, "rb"), (1, "bl"), (12, "lr"), (6, "tb"), (3, "rl"), (9, "bt"), (7, "tl"), (11, "rt"), (13, "br"), (14, "lb"), (5, "tr"), (5, "bl"), (10, "lt"), (10, "rb"))
_BORDER = {"t": "l * 4294967296 + s * 2", "b": "(l + 1) * 4294967296 + s * 2", "l": "l * 4294967296 + s * 2 + 1", "r": "l * 4294967296 + (s + 1) * 2 + 1"}
_POINT = {"t": "l::DOUBLE AS pl, s + ft AS ps", "b": "l + 1::DOUBLE AS pl, s + fb AS ps", "l": "l + fl AS pl, s::DOUBLE AS ps", "r": "l + fr AS pl, s + 1::DOUBLE AS ps"}
_LINKS = " UNION ALL ".join(f"SELECT {_BORDER[w[0]]} AS id, {_BORDER[w[1]]} AS nxt, {_POINT[w[0]]} FROM k WHERE kind = {kind}" for kind, w in _STEPS)
_ENDS = " UNION ALL ".join(f"SELECT {_BORDER[w[1]]} AS id, {_POINT[w[1]]} FROM k WHERE kind = {kind}" for kind, w in _STEPS)


@query(f"""WITH RECURSIVE {_CELLS}, links AS ({_LINKS}), ends AS ({_ENDS}),
points AS (SELECT id, min(pl) AS pl, min(ps) AS ps FROM (SELECT id, pl, ps FROM links UNION ALL SELECT id, pl, ps FROM ends) GROUP BY id),
walk(start, id, pos) AS (SELECT id, id, 0 FROM points WHERE id NOT IN (SELECT nxt FROM links) UNION ALL SELECT start, nxt, pos + 1 FROM walk JOIN links USING (id)),
ring AS (SELECT id, nxt FROM links WHERE id NOT IN (SELECT id FROM walk)),
around(start, id, pos) AS (SELECT id, id, 0 FROM ring UNION ALL SELECT start, nxt, pos + 1 FROM around JOIN ring USING (id) WHERE nxt > start),
whole AS (SELECT start FROM around JOIN ring USING (id) WHERE nxt = start),
lines AS (SELECT start, id, pos, false AS closed FROM walk UNION ALL SELECT start, id, pos, true FROM around WHERE start IN (SELECT start FROM whole))
SELECT CAST(start AS BIGINT) AS line, CAST(pos AS BIGINT) AS pos, closed, round(pl, 6) AS l, round(ps, 6) AS s FROM lines JOIN points USING (id)""")
def contour_lines(spark, sf_dir):
    """Whole contour lines over the whole image, each point with its place in its line."""
    cells = focal.contour_cells(px1(spark, sf_dir).select("l", "s", "v"), 100.0)
    return focal.contour_lines(cells).select("line", "pos", "closed", F.round("l", 6).alias("l"), F.round("s", 6).alias("s"))


def _square(src, f, r):
    return f"(SELECT l, s, {f}(v) OVER ({_D} ROWS BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS v FROM (SELECT l, s, {f}(v) OVER ({_A} ROWS BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS v FROM {src}))"


_CLOSED = _square(_square(_square(_square("b", "max", 1), "min", 1), "max", 2), "min", 2)


@query(f"WITH {PX1}, b AS (SELECT l, s, CASE WHEN v > 150 THEN 1 ELSE 0 END AS v FROM px1) SELECT l, s, v AS land FROM {_CLOSED}")
def bay_closing(spark, sf_dir):
    px = px1(spark, sf_dir).selectExpr("l", "s", "CASE WHEN v > 150 THEN 1 ELSE 0 END AS land")
    return focal.closing(px, "land", [1, 2])


@query(f"""WITH {PX1}, i AS (SELECT l, s, v, v < 300 AS ins FROM px1),
d AS (SELECT l, s, v, s - max(s) FILTER (NOT ins) OVER ({_A} ROWS UNBOUNDED PRECEDING) AS a, min(s) FILTER (NOT ins) OVER ({_A} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - s AS b, l - max(l) FILTER (NOT ins) OVER ({_D} ROWS UNBOUNDED PRECEDING) AS c, min(l) FILTER (NOT ins) OVER ({_D} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - l AS e FROM i),
sh AS (SELECT l, s, v, least(coalesce(least(a, b, c, e), 6) / 6.0::DOUBLE, 1.0) AS share FROM d)
SELECT l, s, round(share, 6) AS share, round(share * sqrt(v) + (1 - share) * 255.0, 6) AS out FROM sh""")
def coast_blend(spark, sf_dir):
    px = px1(spark, sf_dir).select("l", "s", "v", F.sqrt("v").alias("over"), F.lit(255.0).alias("base"))
    out = focal.blend(px, "base", "over", F.col("v") < 300, 6)
    return out.select("l", "s", F.round("share", 6).alias("share"), F.round("out", 6).alias("out"))


_ULX, _ULY, _PIXEL = 0.0, 90.0, 0.25


@query(f"""WITH {PX1}, t AS (SELECT l, s FROM px1 WHERE v > 280)
SELECT p.l, p.s, min((p.l - t.l) * (p.l - t.l) + (p.s - t.s) * (p.s - t.s)) FILTER ((p.l - t.l) * (p.l - t.l) + (p.s - t.s) * (p.s - t.s) <= 400) AS d2
FROM px1 p LEFT JOIN t ON abs(p.l - t.l) <= 20 GROUP BY p.l, p.s""")
def distance_transform(spark, sf_dir):
    """Exact squared distances to the nearest bright pixel, within 20 pixels."""
    px = px1(spark, sf_dir).select("l", "s", "v")
    return coast.squared_distance(px, F.col("v") > 280, 20, "d2").select("l", "s", "d2")


def _triangle(x, y, w, h):
    point = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
    return F.array(point(x, y), point(x, y + h), point(x + w, y), point(x, y))  # clockwise


_LAND = "rings AS (SELECT s_suppkey % 9 + 0.1 AS x, 90 - s_suppkey * 7 % 400 * 1.5 - 3 AS y, 1.5 + s_nationkey % 4 AS w, 2.0 + s_nationkey % 3 AS h FROM supplier)"


@query(f"""WITH {PX1}, {_LAND}, p AS (SELECT l, s, v, {_ULX} + (s + 0.5::DOUBLE) * {_PIXEL}::DOUBLE AS x, {_ULY} - (l + 0.5::DOUBLE) * {_PIXEL}::DOUBLE AS y FROM px1),
m AS (SELECT l, s, v, EXISTS (SELECT 1 FROM rings r WHERE p.y > r.y AND p.y < r.y + r.h AND p.x > r.x AND (p.x - r.x) / r.w + (p.y - r.y) / r.h < 1) AS land FROM p),
b AS (SELECT m.l, m.s, m.v, m.land OR EXISTS (SELECT 1 FROM m n WHERE n.land AND abs(n.l - m.l) <= 2 AND (n.l - m.l) * (n.l - m.l) + (n.s - m.s) * (n.s - m.s) <= 4) AS grown, m.land FROM m),
d AS (SELECT b.l, b.s, any_value(b.v) AS v, any_value(b.land) AS land, min((n.l - b.l) * (n.l - b.l) + (n.s - b.s) * (n.s - b.s)) AS d2 FROM b LEFT JOIN b n ON n.grown AND abs(n.l - b.l) <= 12 GROUP BY b.l, b.s),
f AS (SELECT *, CASE WHEN d2 <= 144 THEN sqrt(d2) / 12 ELSE 1.0 END AS share, CASE WHEN l % 3 = 0 THEN NULL ELSE 10.0::DOUBLE END AS a FROM d)
SELECT l, s, land, round(share, 9) AS share, round(share * coalesce(a, 20.0) + (1 - share) * v, 6) AS out FROM f""")
def coast_feather(spark, sf_dir):
    """Land from polygons, its buffer, and the overlay (a mosaic of two layers) blended by the true distance."""
    px = px1(spark, sf_dir).select("l", "s", "v")
    lines = px.agg(F.max("l")).first()[0] + 1
    rings = table(spark, sf_dir, "supplier").select(_triangle(F.expr("s_suppkey % 9 + 0.1"), F.expr("90 - s_suppkey * 7 % 400 * 1.5 - 3"), F.expr("1.5 + s_nationkey % 4"), F.expr("2.0 + s_nationkey % 3")).alias("ring"))
    masked = coast.within(px, rings, "ring", _ULX, _ULY, _PIXEL, lines, "land")
    layers = masked.withColumn("a", F.when(F.col("l") % 3 != 0, 10.0)).withColumn("b", F.lit(20.0))
    out = coast.feathered(coast.mosaic(layers, ["a", "b"], "over"), "land", "v", "over", 2, 12)
    return out.select("l", "s", "land", F.round("share", 9).alias("share"), F.round("out", 6).alias("out"))
