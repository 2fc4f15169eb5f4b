"""How the tables at hand stand in for imagery, catalogs and footprints: the same views in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def px1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One band: line, sample, value, day, detector, scan and dataset of each event."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id div 40 AS l", "event_id % 40 AS s", "value AS v", "CAST(ts AS DATE) AS day", "(event_id div 40) % 10 AS det", "event_id div 400 AS scan", "event_type AS ds"
    )


PX1 = "px1 AS (SELECT event_id // 40 AS l, event_id % 40 AS s, value AS v, CAST(ts AS DATE) AS day, (event_id // 40) % 10 AS det, event_id // 400 AS scan, event_type AS ds FROM events)"


def dn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer counts of the band, some of them missing (0) or beyond the valid range (-1)."""
    return px1(spark, sf_dir).selectExpr("l", "s", "det", "scan", "CASE WHEN (l * 7 + s) % 53 = 0 THEN -1 ELSE CAST(floor(v) AS BIGINT) END AS v")


DN = f"{PX1}, dn AS (SELECT l, s, det, scan, CASE WHEN (l * 7 + s) % 53 = 0 THEN -1 ELSE CAST(floor(v) AS BIGINT) END AS v FROM px1)"


def pxw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four bands in thousandths: line, sample, b1 .. b4."""
    bands = [F.floor(F.element_at("embedding", k).cast("double") * 1000).cast("double").alias(f"b{k}") for k in range(1, 5)]
    return table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 25").alias("l"), F.expr("vec_id % 25").alias("s"), *bands)


PXW = "pxw AS (SELECT vec_id // 25 AS l, vec_id % 25 AS s, " + ", ".join(f"floor(CAST(embedding[{k}] AS DOUBLE) * 1000) AS b{k}" for k in range(1, 5)) + " FROM embeddings)"


def acc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contributions of source pixels to output pixels, several to each."""
    return table(spark, sf_dir, "lineitem").selectExpr("l_orderkey div 8 AS ol", "CAST(l_linenumber AS BIGINT) AS os", "l_extendedprice AS v", "l_discount + 0.01 AS w", "l_partkey AS src", "l_suppkey AS src2")


ACC = "acc AS (SELECT l_orderkey // 8 AS ol, CAST(l_linenumber AS BIGINT) AS os, l_extendedprice AS v, l_discount + 0.01::DOUBLE AS w, l_partkey AS src, l_suppkey AS src2 FROM lineitem)"


def lay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layer catalog entries: id, dataset, day, extent."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS lid", "o_orderpriority AS dsname", "CAST(date_format(o_orderdate, 'yyyyMMdd') AS INT) AS ts",
        "CAST(o_custkey % 360 - 180 AS DOUBLE) AS w", "CAST(o_orderkey % 170 - 85 AS DOUBLE) AS s",
        "CAST(o_custkey % 360 - 180 + 1 + o_orderkey % 7 AS DOUBLE) AS e", "CAST(o_orderkey % 170 - 85 + 1 + o_custkey % 5 AS DOUBLE) AS n",
    )


LAY = (
    "lay AS (SELECT o_orderkey AS lid, o_orderpriority AS dsname, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS ts, "
    "CAST(o_custkey % 360 - 180 AS DOUBLE) AS w, CAST(o_orderkey % 170 - 85 AS DOUBLE) AS s, "
    "CAST(o_custkey % 360 - 180 + 1 + o_orderkey % 7 AS DOUBLE) AS e, CAST(o_orderkey % 170 - 85 + 1 + o_custkey % 5 AS DOUBLE) AS n FROM orders)"
)


def foot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of tiles, in degrees."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "CAST(p_partkey * 37 % 3400 AS DOUBLE) / 10 - 170 AS xmin", "CAST(p_partkey * 53 % 1600 AS DOUBLE) / 10 - 80 AS ymin",
        "CAST(p_partkey * 37 % 3400 + p_size AS DOUBLE) / 10 - 170 AS xmax", "CAST(p_partkey * 53 % 1600 + p_size AS DOUBLE) / 10 - 80 AS ymax", "p_brand AS brand",
    )


FOOT = (
    "foot AS (SELECT p_partkey AS id, CAST(p_partkey * 37 % 3400 AS DOUBLE) / 10 - 170 AS xmin, CAST(p_partkey * 53 % 1600 AS DOUBLE) / 10 - 80 AS ymin, "
    "CAST(p_partkey * 37 % 3400 + p_size AS DOUBLE) / 10 - 170 AS xmax, CAST(p_partkey * 53 % 1600 + p_size AS DOUBLE) / 10 - 80 AS ymax, p_brand AS brand FROM part)"
)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger boxes: the areas that tiles are held against."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS zid", "CAST(s_suppkey * 61 % 340 - 170 AS DOUBLE) AS zxmin", "CAST(s_suppkey * 29 % 160 - 80 AS DOUBLE) AS zymin",
        "CAST(s_suppkey * 61 % 340 - 170 + 3 + s_nationkey % 5 AS DOUBLE) AS zxmax", "CAST(s_suppkey * 29 % 160 - 80 + 2 + s_nationkey % 4 AS DOUBLE) AS zymax",
    )


ZONES = (
    "zones AS (SELECT s_suppkey AS zid, CAST(s_suppkey * 61 % 340 - 170 AS DOUBLE) AS zxmin, CAST(s_suppkey * 29 % 160 - 80 AS DOUBLE) AS zymin, "
    "CAST(s_suppkey * 61 % 340 - 170 + 3 + s_nationkey % 5 AS DOUBLE) AS zxmax, CAST(s_suppkey * 29 % 160 - 80 + 2 + s_nationkey % 4 AS DOUBLE) AS zymax FROM supplier)"
)
