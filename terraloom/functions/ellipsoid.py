"""Map projections on the ellipsoid, forward and inverse, as column expressions.

The closed forms and series are those of the standard manual of map projections (Snyder, 1987). Inverse latitudes come from series in the eccentricity, so no expression iterates over rows or columns.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: UTM's scale at the central meridian, false easting, and false northing of the southern hemisphere (fixed values).
UTM_SCALE, UTM_EASTING, UTM_SOUTH = 0.9996, 500_000.0, 10_000_000.0


def _pi4() -> Column:
    return F.lit(math.pi / 4)


@dataclass(frozen=True)
class Ellipsoid:
    """Semi-major axis and squared eccentricity."""

    a: float
    e2: float

    @staticmethod
    def of_axes(a: float, b: float) -> Ellipsoid:
        return Ellipsoid(a, 1 - (b / a) ** 2)

    @property
    def e(self) -> float:
        return math.sqrt(self.e2)

    # Of one latitude in radians, as plain numbers, for the constants of a projection.

    def m(self, phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - self.e2 * math.sin(phi) ** 2)

    def t(self, phi: float) -> float:
        s = self.e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (self.e / 2)

    def q(self, phi: float) -> float:
        s = math.sin(phi)
        x = self.e * s
        return (1 - self.e2) * (s / (1 - x * x) - math.log((1 - x) / (1 + x)) / (2 * self.e)) if self.e else 2 * s

    def arc(self, phi: float) -> float:
        a0, a2, a4, a6 = self._arc()
        return self.a * (a0 * phi - a2 * math.sin(2 * phi) + a4 * math.sin(4 * phi) - a6 * math.sin(6 * phi))

    def _arc(self) -> tuple[float, ...]:
        e2, e4, e6 = self.e2, self.e2**2, self.e2**3
        return 1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256, 3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024, 15 * e4 / 256 + 45 * e6 / 1024, 35 * e6 / 3072

    # The same of columns.

    def t_of(self, phi: Column) -> Column:
        s = F.sin(phi) * self.e
        return F.tan(_pi4() - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(self.e / 2))

    def q_of(self, phi: Column) -> Column:
        s = F.sin(phi)
        x = s * self.e
        return (s / (1 - x * x) - F.log((1 - x) / (1 + x)) / (2 * self.e)) * (1 - self.e2) if self.e else 2 * s

    def from_conformal(self, chi: Column) -> Column:
        """The latitude of a conformal latitude."""
        e2, e4, e6, e8 = (self.e2**k for k in range(1, 5))
        return (
            chi + (e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360) * F.sin(2 * chi) + (7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520) * F.sin(4 * chi)
            + (7 * e6 / 120 + 81 * e8 / 1120) * F.sin(6 * chi) + (4279 * e8 / 161280) * F.sin(8 * chi)
        )

    def from_t(self, t: Column) -> Column:
        return self.from_conformal(F.lit(math.pi / 2) - 2 * F.atan(t))

    def from_authalic(self, beta: Column) -> Column:
        """The latitude of an authalic latitude."""
        e2, e4, e6 = (self.e2**k for k in range(1, 4))
        return beta + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + (761 * e6 / 45360) * F.sin(6 * beta)


WGS84 = Ellipsoid.of_axes(6378137.0, 6356752.314245)
CLARKE_1866 = Ellipsoid.of_axes(6378206.4, 6356583.8)


@dataclass(frozen=True)
class Projection:
    """``forward`` takes longitude and latitude in degrees to metres, ``inverse`` takes them back."""

    forward: Callable[[Column, Column], tuple[Column, Column]]
    inverse: Callable[[Column, Column], tuple[Column, Column]]


def _turn(d: Column) -> Column:
    """A difference of longitudes in degrees between -180 and 180, in radians."""
    return F.radians(F.pmod(d + 180.0, F.lit(360.0)) - 180.0)


def _longitude(lon: Column) -> Column:
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def mercator(on: Ellipsoid, lon0: float = 0.0, true: float = 0.0) -> Projection:
    """True to scale at the latitude ``true``."""
    k = on.a * on.m(math.radians(true))
    return Projection(lambda lon, lat: (_turn(lon - lon0) * k, -F.log(on.t_of(F.radians(lat))) * k), lambda x, y: (_longitude(lon0 + F.degrees(x / k)), F.degrees(on.from_t(F.exp(-y / k)))))


def transverse_mercator(on: Ellipsoid, lon0: float, lat0: float = 0.0, scale: float = 1.0, east: float = 0.0, north: float = 0.0) -> Projection:
    ep = on.e2 / (1 - on.e2)
    m0 = on.arc(math.radians(lat0))
    a0, a2, a4, a6 = on._arc()

    def forward(lon: Column, lat: Column):
        p, d = F.radians(lat), _turn(lon - lon0)
        s, c = F.sin(p), F.cos(p)
        n, t, k = on.a / F.sqrt(1 - on.e2 * s * s), F.tan(p) * F.tan(p), ep * c * c
        a = d * c
        b = a * a
        arc = on.a * (a0 * p - a2 * F.sin(2 * p) + a4 * F.sin(4 * p) - a6 * F.sin(6 * p))
        x = n * a * (1 + b / 6 * (1 - t + k + b / 20 * (5 - 18 * t + t * t + 72 * k - 58 * ep)))
        y = arc - m0 + n * F.tan(p) * b * (F.lit(0.5) + b / 24 * (5 - t + 9 * k + 4 * k * k + b / 30 * (61 - 58 * t + t * t + 600 * k - 330 * ep)))
        return x * scale + east, y * scale + north

    def inverse(x: Column, y: Column):
        r = math.sqrt(1 - on.e2)
        e1 = (1 - r) / (1 + r)
        mu = (m0 + (y - north) / scale) / (on.a * a0)
        p = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu)
        s, c = F.sin(p), F.cos(p)
        k, t, w = ep * c * c, F.tan(p) * F.tan(p), 1 - on.e2 * s * s
        n, rho = on.a / F.sqrt(w), on.a * (1 - on.e2) / (w * F.sqrt(w))
        d = (x - east) / (n * scale)
        b = d * d
        lat = p - n * F.tan(p) / rho * b * (F.lit(0.5) - b / 24 * (5 + 3 * t + 10 * k - 4 * k * k - 9 * ep - b / 30 * (61 + 90 * t + 298 * k + 45 * t * t - 252 * ep - 3 * k * k)))
        lon = d * (1 - b / 6 * (1 + 2 * t + k - b / 20 * (5 - 2 * k + 28 * t - 3 * k * k + 8 * ep + 24 * t * t))) / c
        return _longitude(lon0 + F.degrees(lon)), F.degrees(lat)

    return Projection(forward, inverse)


def utm(zone: int, on: Ellipsoid = WGS84) -> Projection:
    """A zone of 1 to 60; below 0 on the southern hemisphere."""
    return transverse_mercator(on, abs(zone) * 6 - 183.0, 0.0, UTM_SCALE, UTM_EASTING, UTM_SOUTH if zone < 0 else 0.0)


def utm_zone(lon: Column, lat: Column) -> Column:
    """The zone of a point, below 0 in the south."""
    zone = F.least(F.floor((_longitude(lon) + 180.0) / 6).cast("int") + 1, F.lit(60))
    return F.when(lat < 0, -zone).otherwise(zone)


def lambert_conformal(on: Ellipsoid, par1: float, par2: float, lat0: float, lon0: float, east: float = 0.0, north: float = 0.0) -> Projection:
    p1, p2 = math.radians(par1), math.radians(par2)
    n = math.sin(p1) if par1 == par2 else math.log(on.m(p1) / on.m(p2)) / math.log(on.t(p1) / on.t(p2))
    f = on.m(p1) / (n * on.t(p1) ** n)
    rho0 = on.a * f * on.t(math.radians(lat0)) ** n
    sign = math.copysign(1.0, n)

    def forward(lon, lat):
        rho, theta = on.a * f * F.pow(on.t_of(F.radians(lat)), F.lit(n)), _turn(lon - lon0) * n
        return rho * F.sin(theta) + east, F.lit(rho0 + north) - rho * F.cos(theta)

    def inverse(x, y):
        dx, dy = x - east, F.lit(rho0 + north) - y
        rho = F.hypot(dx, dy) * sign
        return _longitude(lon0 + F.degrees(F.atan2(dx * sign, dy * sign)) / n), F.degrees(on.from_t(F.pow(rho / (on.a * f), F.lit(1 / n))))

    return Projection(forward, inverse)


def albers(on: Ellipsoid, par1: float, par2: float, lat0: float, lon0: float, east: float = 0.0, north: float = 0.0) -> Projection:
    p1, p2 = math.radians(par1), math.radians(par2)
    n = math.sin(p1) if par1 == par2 else (on.m(p1) ** 2 - on.m(p2) ** 2) / (on.q(p2) - on.q(p1))
    c = on.m(p1) ** 2 + n * on.q(p1)
    rho0 = on.a * math.sqrt(c - n * on.q(math.radians(lat0))) / n
    pole, sign = on.q(math.pi / 2), math.copysign(1.0, n)

    def forward(lon, lat):
        rho, theta = F.sqrt(F.lit(c) - on.q_of(F.radians(lat)) * n) * (on.a / n), _turn(lon - lon0) * n
        return rho * F.sin(theta) + east, F.lit(rho0 + north) - rho * F.cos(theta)

    def inverse(x, y):
        dx, dy = x - east, F.lit(rho0 + north) - y
        q = (F.lit(c) - (dx * dx + dy * dy) * (n / on.a) ** 2) / n
        return _longitude(lon0 + F.degrees(F.atan2(dx * sign, dy * sign)) / n), F.degrees(on.from_authalic(F.asin(F.greatest(F.least(q / pole, F.lit(1.0)), F.lit(-1.0)))))

    return Projection(forward, inverse)


def polar_stereographic(on: Ellipsoid, lon0: float | Column, true: float) -> Projection:
    """Around the pole of the hemisphere of ``true``, the latitude that is true to scale. The meridian that points
    down (up, in the south) may be a column: that of each granule."""
    south = true < 0
    sign, p = (-1.0, -math.radians(true)) if south else (1.0, math.radians(true))
    e = on.e
    k = 2 * on.a / math.sqrt((1 + e) ** (1 + e) * (1 - e) ** (1 - e)) if abs(true) == 90 else on.a * on.m(p) / on.t(p)

    def forward(lon, lat):
        rho, d = on.t_of(F.radians(lat) * sign) * k, _turn(lon - lon0) * sign
        return rho * F.sin(d) * sign, -rho * F.cos(d) * sign

    def inverse(x, y):
        return _longitude(lon0 + F.degrees(F.atan2(x * sign, -y * sign)) * sign), F.degrees(on.from_t(F.hypot(x, y) / k)) * sign

    return Projection(forward, inverse)


def lambert_azimuthal(on: Ellipsoid, lat0: float, lon0: float) -> Projection:
    """Around a point that is no pole."""
    pole, p0 = on.q(math.pi / 2), math.radians(lat0)
    b0 = math.asin(on.q(p0) / pole)
    rq = on.a * math.sqrt(pole / 2)
    d = on.m(p0) * on.a / (rq * math.cos(b0))
    sin0, cos0 = math.sin(b0), math.cos(b0)

    def forward(lon, lat):
        beta, turn = F.asin(on.q_of(F.radians(lat)) / pole), _turn(lon - lon0)
        b = F.sqrt(2 / (1 + sin0 * F.sin(beta) + cos0 * F.cos(beta) * F.cos(turn))) * rq
        return b * d * F.cos(beta) * F.sin(turn), b / d * (cos0 * F.sin(beta) - sin0 * F.cos(beta) * F.cos(turn))

    def inverse(x, y):
        rho = F.hypot(x / d, y * d)
        c = 2 * F.asin(F.least(rho / (2 * rq), F.lit(1.0)))
        beta = F.asin(F.cos(c) * sin0 + F.when(rho > 0, y * d * F.sin(c) * cos0 / rho).otherwise(0.0))
        lon = F.atan2(x * F.sin(c), rho * (d * cos0) * F.cos(c) - y * (d * d * sin0) * F.sin(c))
        return _longitude(lon0 + F.degrees(lon)), F.degrees(on.from_authalic(beta))

    return Projection(forward, inverse)


def granule_plane(cx: Column, cy: Column, on: Ellipsoid = WGS84, polar: float = 60.0) -> tuple[Callable, Callable]:
    """A plane for each granule by its centre: polar stereographic around the meridian and true at the latitude
    of ``polar`` beyond it, else sinusoidal around the meridian on the ellipsoid's authalic sphere. Gives functions from
    longitude and latitude to x, y, and back, for rows of many granules at once."""
    north, south = polar_stereographic(on, cx, polar), polar_stereographic(on, cx, -polar)
    radius = on.a * math.sqrt(on.q(math.pi / 2) / 2)

    def choose(n, s, m):
        return tuple(F.when(cy >= polar, a).when(cy <= -polar, b).otherwise(c) for a, b, c in zip(n, s, m))

    def forward(lon, lat):
        middle = (_turn(lon - cx) * F.cos(F.radians(lat)) * radius, F.radians(lat) * radius)
        return choose(north.forward(lon, lat), south.forward(lon, lat), middle)

    def inverse(x, y):
        lat = y / radius
        middle = (_longitude(cx + F.degrees(x / (radius * F.cos(lat)))), F.degrees(lat))
        return choose(north.inverse(x, y), south.inverse(x, y), middle)

    return forward, inverse


def recentred(sample: Column, samples: int) -> Column:
    """The sample of a grid that runs from -180 to 180 for one of a grid from 0 to 360 as wide as the world."""
    half = samples // 2
    return F.pmod(sample + half, F.lit(samples))
