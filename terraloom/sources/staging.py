"""Materialising intermediate results where every executor can read them, and checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side of a join is broadcast.
SMALL_ROWS = 100_000


def shared_base(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; one of our own only where that is unset and driver
    and executors are one process."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return base or f"file://{tempfile.mkdtemp(prefix='checkpoint-')}"


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_base(spark))
    return df.checkpoint(eager=True)


def spread(df: DataFrame, rows: int) -> DataFrame:
    """The rows dealt evenly to tasks of about so many, for dear work on each row of a compact table, and to no fewer
    than run at once."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows)))


def is_small(df: DataFrame, rows: int = SMALL_ROWS) -> bool:
    """Whether a table has at most so many rows; no more than these are counted."""
    return df.limit(rows + 1).count() <= rows


def if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """The table, to be broadcast if it has at most so many rows; beyond them the planner chooses."""
    return F.broadcast(df) if is_small(df, rows) else df
