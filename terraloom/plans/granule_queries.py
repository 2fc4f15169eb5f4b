"""The product driver: a table of granules to one composite."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.functions.geo import Grid
from terraloom.operators import granules

from .registry import query
from .views import table

_SIZE, _BANDS, _GAINS = 1600, [1, 4, 3], {1: {1: 1.02}, 3: {0: 0.99, 1: 1.01}}
_GRID, _SAMPLES = Grid(178.0, 50.5, 0.05, 110), 140
_OFFSET, _SCALE, _LOW, _HIGH = 100.0, 0.0005, 0.0, 0.2


def _inputs(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr(f"concat('G', event_id div {_SIZE}) AS granule", f"event_id div {_SIZE} AS g", f"event_id % {_SIZE} div 40 AS l", "event_id % 40 AS s", "floor(value) AS v").withColumn("scan", F.expr("l div 10"))
    px = e.select("granule", "scan", "l", "s", F.explode(F.array(*[F.struct(F.lit(b).alias("band"), (F.col("v") * b + 100).alias("dn")) for b in _BANDS])).alias("k")).select("granule", "scan", "l", "s", "k.*")
    lon = 178.5 + F.col("g") % 3 * 0.7 + F.col("s") * 0.05 + F.col("l") * 0.003
    lat = 50.0 - F.col("g") % 5 * 0.3 - F.col("l") * 0.05 + F.col("s") * 0.002
    places = e.select("granule", "l", "s", lat.alias("lat"), F.when(lon >= 180, lon - 360).otherwise(lon).alias("lon"), (30.0 + F.col("s") * 0.5).alias("solz"))
    mirrors = e.select("granule", "scan").distinct().withColumn("mirror", F.expr("scan % 2"))
    flags = e.select("granule", "g").distinct().select("granule", granules.is_day(F.when(F.col("g") % 4 == 3, "Night").when(F.col("g") % 4 == 2, "Both").otherwise("Day")).alias("day"))
    return px, places, mirrors, flags


def _toa(band):
    gain = " ".join(f"WHEN scan % 2 = {side} THEN {g}::DOUBLE" for side, g in _GAINS.get(band, {}).items())
    dn = f"(v * {band} + 100) * " + (f"CASE {gain} ELSE 1.0::DOUBLE END" if gain else "1.0::DOUBLE")
    return f"(({dn}) - {_OFFSET}) * {_SCALE}::DOUBLE / cos(radians(30.0 + s * 0.5)) AS b{band}"


def _sum(band):
    return f"sum(b{band} * w) / sum(w) AS b{band}"


def _byte(band):
    return f"CAST(greatest(least(floor((b{band} - {_LOW}) / ({_HIGH} - {_LOW}) * 255 + 0.5), 255), 0) AS INTEGER)"


_CORNERS = ", ".join(f"{t}.ol AS p{k}l, {t}.os AS p{k}s, {t}.b1 AS p{k}b1, {t}.b4 AS p{k}b4, {t}.b3 AS p{k}b3" for k, t in enumerate("abcd"))


@query(f"""WITH e AS (SELECT event_id // {_SIZE} AS g, event_id % {_SIZE} // 40 AS l, event_id % 40 AS s, event_id % {_SIZE} // 400 AS scan, floor(value) AS v FROM events WHERE event_id // {_SIZE} % 4 <> 3),
px AS (SELECT g, l, s, (50.5 - (50.0 - g % 5 * 0.3::DOUBLE - l * 0.05::DOUBLE + s * 0.002::DOUBLE)) / 0.05::DOUBLE AS ol, (178.5 + g % 3 * 0.7::DOUBLE + s * 0.05::DOUBLE + l * 0.003::DOUBLE - 178.0) / 0.05::DOUBLE AS os, {", ".join(map(_toa, _BANDS))} FROM e),
quads AS (SELECT a.g, a.l, a.s, {_CORNERS} FROM px a JOIN px b ON b.g = a.g AND b.l = a.l AND b.s = a.s + 1 JOIN px c ON c.g = a.g AND c.l = a.l + 1 AND c.s = a.s + 1 JOIN px d ON d.g = a.g AND d.l = a.l + 1 AND d.s = a.s),
cand AS (SELECT *, unnest(generate_series(greatest(CAST(trunc(least(p0l, p1l, p2l, p3l)) AS BIGINT), 0), least(CAST(trunc(greatest(p0l, p1l, p2l, p3l)) AS BIGINT) + 1, {_GRID.lines}) - 1)) AS outl FROM quads),
cand2 AS (SELECT *, unnest(generate_series(greatest(CAST(trunc(least(p0s, p1s, p2s, p3s)) AS BIGINT), 0), least(CAST(trunc(greatest(p0s, p1s, p2s, p3s)) AS BIGINT) + 1, {_SAMPLES}) - 1)) AS outs FROM cand),
det AS (SELECT *, (p3l - p0l) * (p1s - p0s) - (p3s - p0s) * (p1l - p0l) AS d1, (p1l - p2l) * (p3s - p2s) - (p1s - p2s) * (p3l - p2l) AS d2 FROM cand2),
uv AS (SELECT *, ((outl - p0l) * (p1s - p0s) - (outs - p0s) * (p1l - p0l)) / d1 AS v1, ((p3l - p0l) * (outs - p0s) - (p3s - p0s) * (outl - p0l)) / d1 AS u1,
((outl - p2l) * (p3s - p2s) - (outs - p2s) * (p3l - p2l)) / d2 AS v2, ((p1l - p2l) * (outs - p2s) - (p1s - p2s) * (outl - p2l)) / d2 AS u2 FROM det),
ins AS (SELECT *, v1 >= 0 AND v1 <= 1 AND u1 >= 0 AND u1 <= 1 AND u1 + v1 <= 1 AS in1, v2 >= 0 AND v2 <= 1 AND u2 >= 0 AND u2 <= 1 AND u2 + v2 <= 1 AS in2 FROM uv),
q AS (SELECT *, floor(CASE WHEN in1 THEN v1 ELSE 1 - v2 END * 64 + 0.5) / 64 AS x, floor(CASE WHEN in1 THEN u1 ELSE 1 - u2 END * 64 + 0.5) / 64 AS y FROM ins WHERE in1 OR in2),
parts AS (SELECT g, outl, outs % 7200 AS outs, (1 - x) * (1 - y) AS w, p0b1 AS b1, p0b4 AS b4, p0b3 AS b3 FROM q UNION ALL SELECT g, outl, outs % 7200, (1 - x) * y, p1b1, p1b4, p1b3 FROM q UNION ALL SELECT g, outl, outs % 7200, x * y, p2b1, p2b4, p2b3 FROM q UNION ALL SELECT g, outl, outs % 7200, x * (1 - y), p3b1, p3b4, p3b3 FROM q),
means AS (SELECT 'G' || g AS granule, outl, outs, sum(w) AS w, {", ".join(map(_sum, _BANDS))} FROM parts GROUP BY ALL HAVING sum(w) > 0.1),
best AS (SELECT * FROM means QUALIFY row_number() OVER (PARTITION BY outl, outs ORDER BY round(w, 6) DESC, granule) = 1)
SELECT outl, outs, granule, {_byte(1)} AS r, {_byte(4)} AS g, {_byte(3)} AS b, 255 AS a FROM best""")
def granule_product(spark, sf_dir):
    """Bands, mirror sides, places and day flags of all granules to one composite, over the dateline."""
    px, places, mirrors, flags = _inputs(spark, sf_dir)
    return granules.product(px, places, mirrors, flags, _BANDS, _GAINS, _GRID, _SAMPLES, _OFFSET, _SCALE, _LOW, _HIGH)
