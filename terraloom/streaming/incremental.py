"""Incremental ingestion: the batch operators within Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.sources.staging import shared_base


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    return f"{shared_base(spark)}/stream-{uuid.uuid4().hex}"


def arrivals(spark: SparkSession, path: str, schema, files_per_trigger: int = 64) -> DataFrame:
    """Files as they arrive; a bounded number for each micro-batch is the back-pressure. The path is a folder, or a
    single file, which is then looked for by its name in its folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    folder, _, name = path.rstrip("/").rpartition("/")
    if spark.read.parquet(path).inputFiles()[:1] and spark.read.parquet(path).inputFiles()[0].endswith(f"/{name}"):
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def daily(events: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Day buckets of each dataset. Rows later than the watermark are dropped, where a batch system would have to
    report an error for state already written."""
    w = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness).groupBy(F.window("ts", "1 day").alias("w"), F.col("event_type").alias("ds"))
    return w.agg(F.count("*").alias("n"), F.min("value").alias("vmin"), F.max("value").alias("vmax")).select("ds", F.to_date("w.start").alias("day"), "n", "vmin", "vmax")


def commit(batch: DataFrame, epoch: int, target: str) -> None:
    """Write a micro-batch under its own number: a repeated one replaces itself, so the result is exact."""
    batch.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")


def ingest(stream: DataFrame, target: str, state: str, mode: str = "update"):
    """Run what has arrived through to the target and stop; a later call goes on from the stored state."""
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(lambda b, e: commit(b, e, target)).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def latest_of(written: DataFrame, keys: list[str]) -> DataFrame:
    """Of the updates of each key the one of the highest epoch."""
    cols = [c for c in written.columns if c not in (*keys, "epoch")]
    best = written.groupBy(*keys).agg(F.max_by(F.struct(*cols), "epoch").alias("v"))
    return best.select(*keys, *[F.col(f"v.{c}").alias(c) for c in cols])


def replay_daily(spark: SparkSession, path: str) -> DataFrame:
    """All of a source through the streaming path: equals the batch form."""
    schema = spark.read.parquet(path).schema
    base = shared_folder(spark)
    ingest(daily(arrivals(spark, path, schema), "400 days"), f"{base}/out", f"{base}/state")
    done = latest_of(spark.read.parquet(f"{base}/out"), ["ds", "day"])
    return done.withColumns({"vmin": F.round("vmin", 6), "vmax": F.round("vmax", 6)})
