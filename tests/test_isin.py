"""The integerized sinusoidal grid."""

import math

import pytest
from pyspark.sql import functions as F

from terraloom.functions import isin


@pytest.mark.parametrize("justify", [0, 1, 2])
def test_there_and_back(spark, justify):
    g = isin.Grid(180, justify, 12.0)
    p = spark.range(3000).selectExpr("id", "id * 7.13 % 359 - 179.5 AS lon", "id * 3.77 % 179 - 89.5 AS lat")
    x, y = g.forward(F.col("lon"), F.col("lat"))
    q = p.withColumn("x", x).withColumn("y", y)
    lon, lat = g.inverse(F.col("x"), F.col("y"))
    assert q.where((F.abs(lon - F.col("lon")) > 1e-9) & (F.abs(F.abs(lon - F.col("lon")) - 360) > 1e-9) | (F.abs(lat - F.col("lat")) > 1e-9) | lon.isNull()).count() == 0


def test_rows_have_their_own_columns(spark):
    g = isin.Grid(180, 2)
    n = [r["n"] for r in spark.range(180).select(g.columns(F.col("id")).alias("n"), "id").orderBy("id").collect()]
    assert n == n[::-1] and all(k % 2 == 0 for k in n) and n[89] == 360 and n[0] == 2 * round(180 * math.cos(math.radians(89.5)))
    assert n[:90] == sorted(n[:90])
    odd = [r["n"] for r in spark.range(180).select(isin.Grid(180, 0).columns(F.col("id")).alias("n"), "id").orderBy("id").collect()]
    assert odd == [int(2 * 180 * math.cos(math.radians(89.5 - min(k, 179 - k))) + 0.5) for k in range(180)]


def test_beyond_the_rows(spark):
    g = isin.Grid(180)
    row = spark.range(1).select(*g.inverse(F.lit(1.9e7), F.lit(g.radius * math.radians(80.0))), *g.inverse(F.lit(0.0), F.lit(2e7)), *g.cell(F.lit(0.0), F.lit(91.0)), *g.cell(F.lit(10.0), F.lit(-90.0))).first()
    assert row[:6] == (None,) * 6 and row[6] == 179


def test_nested_rows_are_averaged(spark):
    """A pixel over two rows of which only one reaches so far takes that one; elsewhere it takes the mean."""
    g = isin.Grid(180)
    height = g.radius * math.radians(2.0)
    df = spark.range(1)
    inner = df.select(*g.nested(F.lit(0.5), F.lit(0), 0.0, g.radius * math.radians(60.0), height, 2)).first()
    assert inner[1] == pytest.approx(59.0)
    one, two = (df.select(*g.inverse(F.lit(1e6), F.lit(g.radius * math.radians(v)))).first() for v in (59.5, 58.5))
    far = df.select(*g.nested(F.lit(0.5), F.lit(1), 1e6 - height, g.radius * math.radians(60.0), height, 2)).first()
    assert far[0] == pytest.approx((one[0] + two[0]) / 2) and one[0] != two[0]
    # At the edge of the upper row only the lower one is left.
    edge = df.select(g.columns(F.lit(30)), g.columns(F.lit(31))).first()
    assert edge[0] < edge[1]
    x = (edge[1] / 2 - 0.1) * g.pitch
    out = df.select(*g.nested(F.lit(0.5), F.lit(0), x, g.radius * math.radians(60.0), height, 2)).first()
    assert out[1] == pytest.approx(58.5)
