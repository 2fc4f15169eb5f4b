"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch: with whole web texts a batch stays at a few MB.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the memory that a Python worker needs for one Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the session names; on a single machine one of our own if it names none (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_mod(column: str, n: int):
    """crc32 of the id as text, modulo n: the fold of a row."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def release() -> None:
    """Give freed memory back to the system. A worker that is used again would otherwise keep its largest size."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class TwoGenerations(dict):
    """A dict that makes missing values, of bounded size: what was not asked for lately goes first.

    Keys over ``longest`` characters are made each time, so that odd texts cannot fill the memory.
    """

    def __init__(self, make: Callable, limit: int = 300_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def map_columns(df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable]) -> DataFrame:
    """``mapInArrow`` over the chosen columns. ``make()`` runs once per task and returns a function from the
    columns' Python lists to the list of output columns. Other columns, whatever their names, are not read."""
    spark = df.sparkSession
    small_batches(spark)
    arrow = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        f, out = make(), to_arrow_schema(arrow)
        for batch in batches:
            if batch.num_rows:
                made = f(*(c.to_pylist() for c in batch.columns))
                yield pa.RecordBatch.from_arrays([pa.array(v, type=t.type) for v, t in zip(made, out, strict=True)], schema=out)
        f = made = None
        release()

    from pyspark.sql.types import StructType

    arrow = StructType.fromDDL(schema) if hasattr(StructType, "fromDDL") else None
    return df.select(*columns).mapInArrow(run, schema)


def shared_table(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Written as Parquet in the shared checkpoint folder and read again: as ``cut``, with column pruning."""
    import uuid

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.parquet(path)


def summed_counters(rows: DataFrame, tally: Callable, size: int, blocks: int = 64):
    """A vector of ``size`` counters, summed over all tasks: ``tally(batches)`` gives a task's own. Blocks of the
    vector are added up in two steps, one at a time, so that no task holds more than a few, and the driver gets one
    row for each block."""
    import numpy as np

    kind, names = "block long, part long, counts binary", ["block", "part", "counts"]

    def batch_of(found: list, part: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), pa.array([part] * len(found), pa.int64()), pa.array([x.astype(np.int64).tobytes() for _, x in found], pa.binary())], names=names)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts = tally(batches).reshape(blocks, -1)
        found = [(k, counts[k]) for k in np.flatnonzero(counts.any(axis=1)).tolist()]
        if found:
            yield batch_of(found, TaskContext.get().partitionId() % 64)
        release()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(2)):
                x = np.frombuffer(x.as_buffer(), np.int64)
                total[k] = total[k] + x if k in total else x
        if total:
            yield batch_of(list(total.items()), 0)

    sums = rows.mapInArrow(own, kind).repartition("block", "part").mapInArrow(add, kind).repartition("block").mapInArrow(add, kind)
    out = np.zeros((blocks, size // blocks), np.int64)
    for r in sums.collect():
        out[r["block"]] += np.frombuffer(bytes(r["counts"]), np.int64)
    return out.ravel()
