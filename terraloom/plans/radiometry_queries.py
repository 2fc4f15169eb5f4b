"""Queries of radiometric correction and destriping."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.operators import destripe as ds
from terraloom.operators import radiometry as rad

from .registry import query
from .views import DN, PX1, dn, px1

_SCENE = f"{PX1}, scene AS (SELECT l, s, CASE WHEN (l + s) % 29 = 0 THEN NULL WHEN (l + s) % 31 = 0 THEN -2 WHEN (l + s) % 37 = 0 THEN -3 WHEN (l + s) % 41 = 0 THEN -1 ELSE floor(v * 20) END AS dn, 20.0 + l % 69 AS solz, s * 1.5 AS senz, CAST((l * 3 + s * 5) % 360 AS DOUBLE) AS phi, CAST(l % 30 * 100 AS DOUBLE) AS height FROM px1)"


def _scene(spark, sf_dir):
    return px1(spark, sf_dir).selectExpr(
        "l", "s", "CASE WHEN (l + s) % 29 = 0 THEN NULL WHEN (l + s) % 31 = 0 THEN -2D WHEN (l + s) % 37 = 0 THEN -3D WHEN (l + s) % 41 = 0 THEN -1D ELSE CAST(floor(v * 20) AS DOUBLE) END AS dn", "CAST(20 + l % 69 AS DOUBLE) AS solz", "s * 1.5D AS senz", "CAST((l * 3 + s * 5) % 360 AS DOUBLE) AS phi", "CAST(l % 30 * 100 AS DOUBLE) AS height"
    )


def _terms(band):
    b = rad.Band(band)
    q = ["1.0", "(mus + muv)", "mus * muv", "(mus * mus + muv * muv)", "mus * mus * muv * muv"]
    f0 = " + ".join(f"{a!r} * {t}" for a, t in zip(rad.AS0[:5], q))
    f0b = " + ".join(f"{a!r} * {t}" for a, t in zip(rad.AS0[5:], q))
    e1 = " + ".join(f"{a!r} * pow(t, {k})" for k, a in enumerate(rad.EXP_INTEGRAL))
    wa, wb = b.water
    water = f"exp(-exp({float(wa)!r} + {wb!r} * ln({rad.WATER} * (1 / mus + 1 / muv))))" if wb else "1.0"
    x = rad.DEPOLARISATION
    return f"""{_SCENE}, g AS (SELECT *, cos(radians(solz)) AS mus, cos(radians(senz)) AS muv, {b.tau!r} * exp(-height / 8000.0) AS tau FROM scene),
h AS (SELECT *, exp(-tau / mus) AS td, exp(-tau / muv) AS tu, ln(tau) AS lt, radians(phi + 180) AS az, floor(tau / 1e-4 + 0.5) * 1e-4 AS t FROM g),
i AS (SELECT *, (1 - td * tu) / 4 / (mus + muv) AS a_, (1 - td) * (1 - tu) AS b_, {f0} + lt * ({f0b}) AS f0, {rad.AS1[0]!r} + ({rad.AS1[1]!r}) * lt AS f1, {rad.AS2[0]!r} + ({rad.AS2[1]!r}) * lt AS f2,
{e1} - ln(t) AS e1 FROM h),
j AS (SELECT *, (exp(-t) * (1 - t) + t * t * e1) / 2 AS e3,
(1 + (3 * mus * mus - 1) * (3 * muv * muv - 1) * {x!r} / 8) * (a_ + b_ * f0) + 2 * cos(az) * (-{x!r} * 0.75 * mus * muv * sqrt(1 - mus * mus) * sqrt(1 - muv * muv)) * (a_ + b_ * f1) + 2 * cos(2 * az) * ({x!r} * 0.1875 * (1 - mus * mus) * (1 - muv * muv)) * (a_ + b_ * f2) AS rho,
((2.0 / 3 + mus) + (2.0 / 3 - mus) * td) / (4.0 / 3 + tau) * (((2.0 / 3 + muv) + (2.0 / 3 - muv) * tu) / (4.0 / 3 + tau)) * {water} AS tt, exp(-(1 / mus + 1 / muv) * 0.319 * {float(b.ozone)!r}) AS to3 FROM i),
k AS (SELECT *, (3 * t - e3 * (4 + 2 * t) + 2 * exp(-t)) / (4 + 3 * t) AS sph, CASE WHEN solz < 86.5 AND 1 / mus + 1 / muv <= 18 AND dn >= 0 THEN (dn - 100.0) * 0.00005 / mus END AS toa FROM j),
c AS (SELECT *, (toa / to3 - rho) / tt AS c FROM k), r AS (SELECT *, CASE WHEN toa IS NOT NULL THEN least(greatest(c / (1 + c * sph), -0.01), 1.6) END AS refl FROM c)"""


@query(f"WITH {_terms(1)} SELECT l, s, round(toa, 8) AS toa FROM r")
def toa_reflectance(spark, sf_dir):
    return rad.corrected(_scene(spark, sf_dir), 1, 100.0, 0.00005).select("l", "s", F.round("toa", 8).alias("toa"))


@query(f"WITH {_terms(3)} SELECT l, s, round(rho, 8) AS rho, round(sph, 8) AS sph, round(tt, 8) AS tt, round(to3, 8) AS to3 FROM r")
def rayleigh_terms(spark, sf_dir):
    return rad.corrected(_scene(spark, sf_dir), 3, 100.0, 0.00005).select("l", "s", *[F.round(c, 8).alias(c) for c in ("rho", "sph", "tt", "to3")])


@query(f"WITH {_terms(1)} SELECT l, s, round(refl, 7) AS refl, CAST(coalesce(trunc(round(refl / 1e-4 + 0.5, 6)), CASE WHEN dn IN (-2, -3) THEN dn + 32768 END, -32768) AS INTEGER) AS stored FROM r")
def corrected_reflectance(spark, sf_dir):
    px = rad.corrected(_scene(spark, sf_dir), 1, 100.0, 0.00005)
    return px.select("l", "s", F.round("refl", 7).alias("refl"), F.col("stored").cast("int").alias("stored"))


@query(f"""WITH {PX1}, d AS (SELECT l, s, CAST(floor(v * 10) AS DOUBLE) - 300 AS v FROM px1), m AS (SELECT max(l) - 1 AS ml, max(s) - 1 AS ms FROM d),
p AS (SELECT l * 1.02::DOUBLE + 0.3::DOUBLE AS pl, s * 1.03::DOUBLE + 0.2::DOUBLE AS ps FROM d), q AS (SELECT pl, ps, least(CAST(floor(pl) AS BIGINT), ml) AS l0, least(CAST(floor(ps) AS BIGINT), ms) AS s0 FROM p, m),
j AS (SELECT pl, ps, pl - l0 AS fl, ps - s0 AS fs, a.v AS a, b.v AS b, c.v AS c, d.v AS d FROM q JOIN d a ON a.l = l0 AND a.s = s0 JOIN d b ON b.l = l0 AND b.s = s0 + 1 JOIN d c ON c.l = l0 + 1 AND c.s = s0 JOIN d d ON d.l = l0 + 1 AND d.s = s0 + 1)
SELECT round(pl, 6) AS pl, round(ps, 6) AS ps, CAST(greatest(trunc((1 - fl) * ((1 - fs) * a + fs * b) + fl * ((1 - fs) * c + fs * d)), 0) AS INTEGER) AS height FROM j""")
def dem_bilinear(spark, sf_dir):
    dem = px1(spark, sf_dir).selectExpr("l", "s", "CAST(floor(v * 10) AS DOUBLE) - 300 AS v")
    points = dem.selectExpr("l * 1.02D + 0.3D AS pl", "s * 1.03D + 0.2D AS ps")
    return rad.heights(points, dem).select(F.round("pl", 6).alias("pl"), F.round("ps", 6).alias("ps"), "height")


_HIST = f"{DN}, hist AS (SELECT det, v, count(*) AS n FROM dn WHERE v BETWEEN 0 AND 32767 GROUP BY det, v)"
_EDF = f"{_HIST}, edfs AS (SELECT det, v, n, CAST(sum(n) OVER (PARTITION BY det ORDER BY v) AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY det) AS DOUBLE) AS edf FROM hist)"


@query(f"""WITH {_HIST}, cum AS (SELECT det, v, sum(n) OVER (PARTITION BY det ORDER BY v) AS cum FROM hist), half AS (SELECT det, count(*) // 2 AS half FROM dn GROUP BY det)
SELECT det, min(v) AS median FROM cum JOIN half USING (det) WHERE cum >= half GROUP BY det""")
def histogram_median(spark, sf_dir):
    return ds.histogram_median(dn(spark, sf_dir), "det")


@query(f"WITH {_EDF} SELECT det, v, n, round(edf, 9) AS edf FROM edfs")
def edf_cumulative(spark, sf_dir):
    return ds.edf(dn(spark, sf_dir), "det").withColumn("edf", F.round("edf", 9))


_LUT = f"""{_EDF}, ref AS (SELECT v, edf, row_number() OVER (ORDER BY edf) AS rn FROM edfs WHERE det = 3),
brk AS (SELECT e.det, e.v, e.edf, min(r.v) FILTER (WHERE r.edf >= e.edf) AS hv, min(r.edf) FILTER (WHERE r.edf >= e.edf) AS he, max(r.v) FILTER (WHERE r.edf < e.edf) AS lv, max(r.edf) FILTER (WHERE r.edf < e.edf) AS le, min(r.v) FILTER (WHERE r.rn = 2) AS v1, min(r.edf) FILTER (WHERE r.rn = 2) AS e1
FROM edfs e, ref r WHERE e.det <> 3 GROUP BY e.det, e.v, e.edf),
lut AS (SELECT det, v, CAST(floor(CASE WHEN lv IS NULL THEN coalesce(hv + (v1 - hv) / (e1 - he) * (edf - he), hv) WHEN hv IS NULL THEN lv ELSE lv + (edf - le) / (he - le) * (hv - lv) END + 0.5) AS BIGINT) AS lut FROM brk)"""


@query(f"WITH {_LUT} SELECT det, v, lut FROM lut")
def edf_match_lut(spark, sf_dir):
    return ds.match_tables(ds.edf(dn(spark, sf_dir), "det"), 3)


@query(f"""WITH {_LUT}, new AS (SELECT dn.*, CASE WHEN lut BETWEEN 0 AND 32767 THEN lut ELSE dn.v END AS m FROM dn LEFT JOIN lut ON lut.det = dn.det AND lut.v = dn.v),
h0 AS (SELECT v, sum(count(*)) OVER (ORDER BY v) AS cum FROM dn WHERE v BETWEEN 0 AND 32767 GROUP BY v), h1 AS (SELECT m AS v, sum(count(*)) OVER (ORDER BY m) AS cum FROM new WHERE m BETWEEN 0 AND 32767 GROUP BY m),
meds AS (SELECT (SELECT min(v) FROM h0 WHERE cum >= (SELECT count(*) // 2 FROM dn)) AS before, (SELECT min(v) FROM h1 WHERE cum >= (SELECT count(*) // 2 FROM dn)) AS after)
SELECT l, s, det, scan, v, CASE WHEN v BETWEEN 0 AND 32767 THEN m - (after - before) ELSE v END AS out FROM new, meds""")
def destripe(spark, sf_dir):
    return ds.destripe(dn(spark, sf_dir), 3)


@query(f"""WITH {DN}, r AS (SELECT *, CASE det WHEN 2 THEN 1 WHEN 7 THEN 6 WHEN 8 THEN 9 END AS rep FROM dn)
SELECT r.l, r.s, r.det, r.scan, CASE WHEN r.rep IS NULL THEN r.v ELSE coalesce(g.v, r.v) END AS v FROM r LEFT JOIN dn g ON g.scan = r.scan AND g.det = r.rep AND g.s = r.s""")
def bad_detector_replace(spark, sf_dir):
    return ds.replace_bad(dn(spark, sf_dir), [2, 7, 8], 10)


@query(f"WITH {PX1} SELECT l % 20 AS row_group, count(*) AS n, count(DISTINCT l) AS lines FROM px1 GROUP BY 1")
def detector_rows(spark, sf_dir):
    rows = px1(spark, sf_dir).select(ds.detector(F.col("l"), 10).alias("row_group"), "l")
    return rows.groupBy("row_group").agg(F.count("*").alias("n"), F.count_distinct("l").alias("lines"))
