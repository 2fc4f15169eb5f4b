"""Atmospheric correction as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Clamp of reflectance, largest solar zenith and air mass, scale height in metres, ozone and water columns (fixed values).
REFLECTANCE, MAX_ZENITH, MAX_AIR_MASS, SCALE_HEIGHT, OZONE, WATER = (-0.01, 1.6), 86.5, 18.0, 8000.0, 0.319, 2.93
#: By band 1 .. 16: water vapour and ozone absorption, Rayleigh optical depth (fixed values).
A_H2O = (-5.60723, -5.25251, 0, 0, -6.29824, -7.70944, -3.91877, 0, 0, 0, 0, 0, 0, 0, 0, 0)
B_H2O = (0.820175, 0.725159, 0, 0, 0.865732, 0.966947, 0.745342, 0, 0, 0, 0, 0, 0, 0, 0, 0)
A_O3 = (0.0715289, 0, 0.00743232, 0.089691, 0, 0, 0, 0.001, 0.00383, 0.0225, 0.0663, 0.0836, 0.0485, 0.0395, 0.0119, 0.00263)
TAU0 = (0.05100, 0.01631, 0.19325, 0.09536, 0.00366, 0.00123, 0.00043, 0.3139, 0.2375, 0.1596, 0.1131, 0.0994, 0.0446, 0.0416, 0.0286, 0.0155)
#: Rayleigh reflectance polynomials and depolarisation factor (fixed values).
AS0 = (0.33243832, 0.16285370, -0.30924818, -0.10324388, 0.11493334, -6.777104e-02, 1.577425e-03, -1.240906e-02, 3.241678e-02, -3.503695e-02)
AS1, AS2 = (0.19666292, -5.439061e-02), (0.14545937, -2.910845e-02)
DEPOLARISATION = 0.958725775
#: Polynomial of the exponential integral (fixed values).
EXP_INTEGRAL = (-0.57721566, 0.99999193, -0.24991055, 0.05519968, -0.00976004, 0.00107857)


@dataclass(frozen=True)
class Band:
    """Constants of one band, numbered from 1."""

    number: int

    @property
    def tau(self) -> float:
        return TAU0[self.number - 1]

    @property
    def ozone(self) -> float:
        return A_O3[self.number - 1]

    @property
    def water(self) -> tuple[float, float]:
        return A_H2O[self.number - 1], B_H2O[self.number - 1]


def air_mass(mus: Column, muv: Column) -> Column:
    return 1 / mus + 1 / muv


def rayleigh(mus: Column, muv: Column, phi: Column, tau: Column) -> Column:
    """Path reflectance of the molecules; phi is solar minus sensor azimuth in degrees."""
    turned = F.radians(phi + 180.0)
    x = DEPOLARISATION
    p1 = 1 + (3 * mus * mus - 1) * (3 * muv * muv - 1) * (x / 8)
    p2 = -x * 0.75 * mus * muv * F.sqrt(1 - mus * mus) * F.sqrt(1 - muv * muv)
    p3 = x * 0.1875 * (1 - mus * mus) * (1 - muv * muv)
    q = [F.lit(1.0), mus + muv, mus * muv, mus * mus + muv * muv, mus * mus * muv * muv]
    log_tau = F.log(tau)
    f0 = sum((c * a for c, a in zip(q, AS0[:5])), F.lit(0.0)) + log_tau * sum((c * a for c, a in zip(q, AS0[5:])), F.lit(0.0))
    f1, f2 = AS1[0] + AS1[1] * log_tau, AS2[0] + AS2[1] * log_tau
    td, tu = F.exp(-tau / mus), F.exp(-tau / muv)
    a, b = (1 - td * tu) / 4 / (mus + muv), (1 - td) * (1 - tu)
    return p1 * (a + b * f0) + 2 * F.cos(turned) * p2 * (a + b * f1) + 2 * F.cos(2 * turned) * p3 * (a + b * f2)


def spherical_albedo(tau: Column) -> Column:
    """At the optical depth rounded to 1e-4."""
    t = F.floor(tau / 1e-4 + 0.5) * 1e-4
    e1 = sum((F.pow(t, F.lit(k)) * a for k, a in enumerate(EXP_INTEGRAL)), F.lit(0.0)) - F.log(t)
    e3 = (F.exp(-t) * (1 - t) + t * t * e1) / 2
    return F.when(t > 0, (3 * t - e3 * (4 + 2 * t) + 2 * F.exp(-t)) / (4 + 3 * t)).otherwise(0.0)


def transmittance(mus: Column, muv: Column, tau: Column, band: Band) -> Column:
    """Down and up through the molecules, times water vapour."""
    one = lambda mu: ((2 / 3 + mu) + (2 / 3 - mu) * F.exp(-tau / mu)) / (4 / 3 + tau)
    a, b = band.water
    water = F.exp(-F.exp(F.lit(float(a)) + b * F.log(WATER * air_mass(mus, muv)))) if b else F.lit(1.0)
    return one(mus) * one(muv) * water


def ozone_transmittance(mus: Column, muv: Column, band: Band) -> Column:
    return F.exp(-air_mass(mus, muv) * OZONE * band.ozone) if band.ozone else F.lit(1.0)


#: Counts that say missing and saturated (fixed values); stored as these plus 32768.
PASSED = (-2, -3)


def top_of_atmosphere(dn: Column, offset: float, scale: float, mus: Column) -> Column:
    return (dn - offset) * scale / mus


def corrected(px: DataFrame, band: int, offset: float, scale: float) -> DataFrame:
    """Adds toa and refl (both null where the sun is too low, the air mass too large or the count missing or
    negative) and the stored 16-bit value; the codes of missing and saturated counts are passed through to it. It is
    rounded half up after six decimals, so that the last bits of a half do not matter. Needs dn, solz, senz, phi in degrees and height in metres."""
    b = Band(band)
    mus, muv = F.cos(F.radians("solz")), F.cos(F.radians("senz"))
    px = px.withColumns({"mus": mus, "muv": muv, "tau": b.tau * F.exp(-F.col("height") / SCALE_HEIGHT)})
    mus, muv, tau = F.col("mus"), F.col("muv"), F.col("tau")
    usable = (F.col("solz") < MAX_ZENITH) & (air_mass(mus, muv) <= MAX_AIR_MASS) & (F.col("dn") >= 0)
    px = px.withColumn("toa", F.when(usable, top_of_atmosphere(F.col("dn"), offset, scale, mus)))
    px = px.withColumns({"rho": rayleigh(mus, muv, F.col("phi"), tau), "sph": spherical_albedo(tau), "tt": transmittance(mus, muv, tau, b), "to3": ozone_transmittance(mus, muv, b)})
    c = (F.col("toa") / F.col("to3") - F.col("rho")) / F.col("tt")
    refl = F.least(F.greatest(c / (1 + c * F.col("sph")), F.lit(REFLECTANCE[0])), F.lit(REFLECTANCE[1]))
    px = px.withColumn("refl", F.when(F.col("toa").isNotNull(), refl))
    passed = F.when(F.col("dn").isin(*PASSED), F.col("dn").cast("int") + 32768)
    return px.withColumn("stored", F.coalesce(F.round(F.col("refl") / 1e-4 + 0.5, 6).cast("int"), passed, F.lit(-32768)).cast("smallint"))


def corners(grid: DataFrame, values: list[str], *keys: str) -> DataFrame:
    """Each cell of a grid (l, s) with the values at its four corners: c00, c01, c10, c11 structs. Cells of the last
    line or sample, which have no further neighbour, are left out."""
    across, down = Window.partitionBy(*keys, "l").orderBy("s"), Window.partitionBy(*keys, "s").orderBy("l")
    cell = F.struct(*values)
    g = grid.select(*keys, "l", "s", cell.alias("c00")).withColumn("c01", F.lead("c00").over(across))
    g = g.withColumns({"c10": F.lead("c00").over(down), "c11": F.lead("c01").over(down), "_l": F.lead("l").over(down)})
    return g.where(F.col("c01").isNotNull() & F.col("c11").isNotNull() & (F.col("_l") == F.col("l") + 1)).drop("_l")


def bilinear(value: str, fl: Column, fs: Column) -> Column:
    """Between the corners of ``corners``; null if any is."""
    v = lambda c: F.col(f"{c}.{value}")
    return (1 - fl) * ((1 - fs) * v("c00") + fs * v("c01")) + fl * ((1 - fs) * v("c10") + fs * v("c11"))


def heights(points: DataFrame, dem: DataFrame) -> DataFrame:
    """Height in whole metres of each point (pl, ps) on a DEM grid (l, s, v): bilinear, cut to an integer, never
    below 0; beyond the border the slope of the nearest cell is carried on."""
    last = F.broadcast(dem.agg((F.max("l") - 1).alias("_ml"), (F.max("s") - 1).alias("_ms")))
    p = points.crossJoin(last).withColumns({"l": F.least(F.greatest(F.floor("pl"), F.lit(0)), "_ml").cast("long"), "s": F.least(F.greatest(F.floor("ps"), F.lit(0)), "_ms").cast("long")})
    joined = p.join(corners(dem, ["v"]), ["l", "s"])
    h = bilinear("v", F.col("pl") - F.col("l"), F.col("ps") - F.col("s"))
    return joined.withColumn("height", F.greatest(h.cast("int"), F.lit(0))).select(*points.columns, "height")
