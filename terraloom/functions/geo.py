"""Map projections and grid arithmetic as column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sphere of the web mercator projection, in metres (fixed value).
EARTH = 6378137.0


def mercator_x(lon: Column, radius: float = EARTH) -> Column:
    return F.lit(radius) * F.radians(lon)


def mercator_y(lat: Column, radius: float = EARTH) -> Column:
    return F.lit(radius) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def mercator_lat(y: Column, radius: float = EARTH) -> Column:
    return F.degrees(F.lit(2.0) * F.atan(F.exp(y / radius)) - F.lit(math.pi / 2))


def sinusoidal_x(lon: Column, lat: Column, centre: float = 0.0, radius: float = 6371007.181) -> Column:
    return F.lit(radius) * F.radians(lon - centre) * F.cos(F.radians(lat))


def sinusoidal_y(lat: Column, radius: float = 6371007.181) -> Column:
    return F.lit(radius) * F.radians(lat)


def equirectangular_x(lon: Column, centre: float = 0.0, parallel: float = 0.0, radius: float = EARTH) -> Column:
    return F.lit(radius * math.cos(math.radians(parallel))) * F.radians(lon - centre)


def polar_stereographic(lon: Column, lat: Column, centre: float = 0.0, radius: float = EARTH) -> tuple[Column, Column]:
    """North polar aspect on the sphere, true at the pole."""
    r = F.lit(2 * radius) * F.tan(F.lit(math.pi / 4) - F.radians(lat) / 2)
    return r * F.sin(F.radians(lon - centre)), -r * F.cos(F.radians(lon - centre))


def lambert_azimuthal(lon: Column, lat: Column, lon0: float, lat0: float, radius: float = EARTH) -> tuple[Column, Column]:
    """Equal-area azimuthal on the sphere."""
    d, p, p0 = F.radians(lon - lon0), F.radians(lat), math.radians(lat0)
    k = F.sqrt(2 / (1 + math.sin(p0) * F.sin(p) + math.cos(p0) * F.cos(p) * F.cos(d)))
    return radius * k * F.cos(p) * F.sin(d), radius * k * (math.cos(p0) * F.sin(p) - math.sin(p0) * F.cos(p) * F.cos(d))


def albers(lon: Column, lat: Column, par1: float, par2: float, lon0: float, lat0: float, radius: float = EARTH) -> tuple[Column, Column]:
    """Equal-area conic on the sphere."""
    s1, s2 = math.sin(math.radians(par1)), math.sin(math.radians(par2))
    n = (s1 + s2) / 2
    c = math.cos(math.radians(par1)) ** 2 + 2 * n * s1
    rho = F.lit(radius / n) * F.sqrt(F.lit(c) - 2 * n * F.sin(F.radians(lat)))
    rho0 = radius / n * math.sqrt(c - 2 * n * math.sin(math.radians(lat0)))
    t = n * F.radians(lon - lon0)
    return rho * F.sin(t), F.lit(rho0) - rho * F.cos(t)


def lambert_conformal(lon: Column, lat: Column, par1: float, par2: float, lon0: float, lat0: float, radius: float = EARTH) -> tuple[Column, Column]:
    """Conformal conic on the sphere."""
    t = lambda d: math.tan(math.pi / 4 + math.radians(d) / 2)
    n = math.sin(math.radians(par1)) if par1 == par2 else math.log(math.cos(math.radians(par1)) / math.cos(math.radians(par2))) / math.log(t(par2) / t(par1))
    f = math.cos(math.radians(par1)) * t(par1) ** n / n
    rho = F.lit(radius * f) / F.pow(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2), F.lit(n))
    rho0 = radius * f / t(lat0) ** n
    a = n * F.radians(lon - lon0)
    return rho * F.sin(a), F.lit(rho0) - rho * F.cos(a)


def transverse_mercator(lon: Column, lat: Column, lon0: float, lat0: float = 0.0, factor: float = 1.0, radius: float = EARTH) -> tuple[Column, Column]:
    """On the sphere. The two points of the equator a quarter away from the central meridian lie at infinity."""
    d, p = F.radians(lon - lon0), F.radians(lat)
    b = F.cos(p) * F.sin(d)
    east = F.when(b >= 1, math.inf).when(b <= -1, -math.inf).otherwise(F.log((1 + b) / F.when(b < 1, 1 - b)))
    return F.lit(0.5 * radius * factor) * east, F.lit(radius * factor) * (F.atan2(F.tan(p), F.cos(d)) - math.radians(lat0))


def hammer(lon: Column, lat: Column, lon0: float = 0.0, radius: float = EARTH) -> tuple[Column, Column]:
    d, p = F.radians(lon - lon0) / 2, F.radians(lat)
    k = F.lit(radius * math.sqrt(2)) / F.sqrt(1 + F.cos(p) * F.cos(d))
    return 2 * k * F.cos(p) * F.sin(d), k * F.sin(p)


def mollweide(lon: Column, lat: Column, lon0: float = 0.0, radius: float = EARTH, rounds: int = 12) -> tuple[Column, Column]:
    """The auxiliary angle by a fixed number of Newton steps, unrolled over an array."""
    target = F.lit(math.pi) * F.sin(F.radians(lat))
    step = lambda t, _: t - (t + F.sin(t) - target) / F.greatest(1 + F.cos(t), F.lit(1e-12))
    theta = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.radians(lat) * 1.0, step) / 2
    return F.lit(radius * 2 * math.sqrt(2) / math.pi) * F.radians(lon - lon0) * F.cos(theta), F.lit(radius * math.sqrt(2)) * F.sin(theta)


# -- back to longitude and latitude, on the sphere


def mercator_inverse(x: Column, y: Column, radius: float = EARTH) -> tuple[Column, Column]:
    return F.degrees(x / radius), mercator_lat(y, radius)


def sinusoidal_inverse(x: Column, y: Column, centre: float = 0.0, radius: float = 6371007.181) -> tuple[Column, Column]:
    return centre + F.degrees(x / (radius * F.cos(y / radius))), F.degrees(y / radius)


def polar_stereographic_inverse(x: Column, y: Column, centre: float = 0.0, radius: float = EARTH) -> tuple[Column, Column]:
    return centre + F.degrees(F.atan2(x, -y)), 90 - 2 * F.degrees(F.atan(F.hypot(x, y) / (2 * radius)))


def lambert_azimuthal_inverse(x: Column, y: Column, lon0: float, lat0: float, radius: float = EARTH) -> tuple[Column, Column]:
    p0, rho = math.radians(lat0), F.hypot(x, y)
    c = 2 * F.asin(F.least(rho / (2 * radius), F.lit(1.0)))
    lat = F.asin(F.cos(c) * math.sin(p0) + F.when(rho > 0, y * F.sin(c) * math.cos(p0) / rho).otherwise(0.0))
    return lon0 + F.degrees(F.atan2(x * F.sin(c), rho * math.cos(p0) * F.cos(c) - y * math.sin(p0) * F.sin(c))), F.degrees(lat)


def albers_inverse(x: Column, y: Column, par1: float, par2: float, lon0: float, lat0: float, radius: float = EARTH) -> tuple[Column, Column]:
    s1 = math.sin(math.radians(par1))
    n = (s1 + math.sin(math.radians(par2))) / 2
    c = math.cos(math.radians(par1)) ** 2 + 2 * n * s1
    down = F.lit(radius / n * math.sqrt(c - 2 * n * math.sin(math.radians(lat0)))) - y
    sign = math.copysign(1.0, n)
    return lon0 + F.degrees(F.atan2(sign * x, sign * down)) / n, F.degrees(F.asin((c - F.pow(F.hypot(x, down) * n / radius, F.lit(2.0))) / (2 * n)))


def lambert_conformal_inverse(x: Column, y: Column, par1: float, par2: float, lon0: float, lat0: float, radius: float = EARTH) -> tuple[Column, Column]:
    t = lambda d: math.tan(math.pi / 4 + math.radians(d) / 2)
    n = math.sin(math.radians(par1)) if par1 == par2 else math.log(math.cos(math.radians(par1)) / math.cos(math.radians(par2))) / math.log(t(par2) / t(par1))
    f = math.cos(math.radians(par1)) * t(par1) ** n / n
    down = F.lit(radius * f / t(lat0) ** n) - y
    sign = math.copysign(1.0, n)
    rho = sign * F.hypot(x, down)
    return lon0 + F.degrees(F.atan2(sign * x, sign * down)) / n, 2 * F.degrees(F.atan(F.pow(radius * f / rho, F.lit(1 / n)))) - 90


def transverse_mercator_inverse(x: Column, y: Column, lon0: float, lat0: float = 0.0, factor: float = 1.0, radius: float = EARTH) -> tuple[Column, Column]:
    a, d = x / (radius * factor), y / (radius * factor) + math.radians(lat0)
    return lon0 + F.degrees(F.atan2(F.sinh(a), F.cos(d))), F.degrees(F.asin(F.sin(d) / F.cosh(a)))


PROJECTIONS = {"geo": lambda lon, lat: (F.radians(lon), F.radians(lat)), "mercator": lambda lon, lat: (mercator_x(lon), mercator_y(lat)), "sinusoidal": lambda lon, lat: (sinusoidal_x(lon, lat), sinusoidal_y(lat))}
INVERSES = {"geo": lambda x, y: (F.degrees(x), F.degrees(y)), "mercator": mercator_inverse, "sinusoidal": sinusoidal_inverse}


@dataclass(frozen=True)
class Grid:
    """An output grid: upper-left corner, pixel size, lines and samples."""

    ulx: float
    uly: float
    pixel: float
    lines: int = 0
    samples: int = 0

    def line(self, y: Column) -> Column:
        return (F.lit(self.uly) - y) / self.pixel

    def sample(self, x: Column) -> Column:
        return (x - self.ulx) / self.pixel

    def x(self, sample: Column) -> Column:
        return F.lit(self.ulx) + sample * self.pixel

    def y(self, line: Column) -> Column:
        return F.lit(self.uly) - line * self.pixel
