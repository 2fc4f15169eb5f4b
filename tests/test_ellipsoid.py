"""Projections on the ellipsoid at the manual's own numerical examples, and there and back."""

import pytest
from pyspark.sql import functions as F

from terraloom.functions import ellipsoid as el

CLARKE = el.Ellipsoid(6378206.4, 0.00676866)
INTERNATIONAL = el.Ellipsoid(6378388.0, 0.00672267)
POINTS = [
    ("mercator", el.mercator(CLARKE, 180.0), -75.0, 35.0, 11688673.7, 4139145.6),
    ("transverse", el.transverse_mercator(CLARKE, -75.0, 0.0, 0.9996), -73.5, 40.5, 127106.5, 4484124.4),
    ("albers", el.albers(CLARKE, 29.5, 45.5, 23.0, -96.0), -75.0, 35.0, 1885472.7, 1535925.0),
    ("conformal", el.lambert_conformal(CLARKE, 33.0, 45.0, 23.0, -96.0), -75.0, 35.0, 1894410.9, 1564649.5),
    ("stereographic", el.polar_stereographic(INTERNATIONAL, -100.0, -71.0), 150.0, -75.0, -1540033.6, -560526.4),
    ("azimuthal", el.lambert_azimuthal(CLARKE, 40.0, -100.0), -110.0, 30.0, -965932.1, -1056814.9),
]


@pytest.mark.parametrize("name,p,lon,lat,x,y", POINTS, ids=[p[0] for p in POINTS])
def test_known_points(spark, name, p, lon, lat, x, y):
    got = spark.range(1).select(*p.forward(F.lit(lon), F.lit(lat)), *p.inverse(F.lit(x), F.lit(y))).first()
    assert got[0] == pytest.approx(x, abs=0.5) and got[1] == pytest.approx(y, abs=0.5)
    assert got[2] == pytest.approx(lon, abs=1e-5) and got[3] == pytest.approx(lat, abs=1e-5)


def test_axes_and_zones(spark):
    assert el.WGS84.e2 == pytest.approx(0.00669437999, abs=1e-10)
    z = lambda lon, lat: el.utm_zone(F.lit(lon), F.lit(lat))
    assert tuple(spark.range(1).select(z(-180.0, 1.0), z(179.99, 1.0), z(180.0, 1.0), z(3.0, -1.0)).first()) == (1, 60, 1, -31)
    p = el.utm(-33)
    x, y = spark.range(1).select(*p.forward(F.lit(15.0), F.lit(0.0))).first()
    assert (x, y) == (pytest.approx(500000.0), pytest.approx(10000000.0))


def test_the_sphere_is_a_special_case(spark):
    """With an eccentricity near 0 the forms agree with those on the sphere."""
    from terraloom.functions import geo

    ball = el.Ellipsoid(geo.EARTH, 1e-12)
    lon, lat = F.lit(12.0), F.lit(47.0)
    a = spark.range(1).select(*el.albers(ball, 20.0, 50.0, 30.0, 0.0).forward(lon, lat), *el.lambert_conformal(ball, 20.0, 50.0, 30.0, 0.0).forward(lon, lat), *el.mercator(ball).forward(lon, lat)).first()
    b = spark.range(1).select(*geo.albers(lon, lat, 20.0, 50.0, 0.0, 30.0), *geo.lambert_conformal(lon, lat, 20.0, 50.0, 0.0, 30.0), geo.mercator_x(lon), geo.mercator_y(lat)).first()
    assert all(x == pytest.approx(y, abs=1.0) for x, y in zip(a, b))


def test_the_dateline_does_not_matter(spark):
    p = el.polar_stereographic(el.WGS84, 179.0, 70.0)
    q = el.lambert_conformal(el.WGS84, 40.0, 60.0, 50.0, 179.0)
    for one in (p, q):
        a, b = spark.range(1).select(F.struct(*[c.alias(n) for c, n in zip(one.forward(F.lit(-179.0), F.lit(75.0)), "xy")]), F.struct(*[c.alias(n) for c, n in zip(one.forward(F.lit(181.0), F.lit(75.0)), "xy")])).first()
        assert tuple(a) == pytest.approx(tuple(b)) and a["x"] > 0


def test_the_middle_plane_keeps_areas(spark):
    """A degree by a degree in the plane of its granule has about the area it has on the ellipsoid."""
    f, _ = el.granule_plane(F.lit(10.0), F.lit(45.0))
    x0, y0, x1, y1 = spark.range(1).select(*f(F.lit(9.5), F.lit(44.5)), *f(F.lit(10.5), F.lit(45.5))).first()
    assert (x1 - x0) * (y1 - y0) == pytest.approx(78847e0 * 111132, rel=0.01)
