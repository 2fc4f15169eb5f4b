"""Tables with versions: a rebuild replays its sources beside what readers see, and is switched to at once.

A store is a folder with data folders, which are never changed, and a log. A version is one row of the log, written as
one file, so it is there as a whole or not at all; the store's state is the data folder of its last version. A rebuild
that fails or is killed leaves a data folder without a row, which no reader ever sees. Only Spark's own readers and
writers are used, so any store that Spark knows will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOG = "version long, data string, kind string, inputs array<string>"


class Conflict(RuntimeError):
    """Another writer has made the version first."""


class Store:
    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def log(self) -> DataFrame:
        """All versions. Of two writers of one version the one with the smaller folder name holds."""
        try:
            rows = self.spark.read.schema(LOG).parquet(f"{self.path}/log")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = self.spark.createDataFrame([], LOG)
        first = F.min(F.struct("data", "kind", "inputs")).alias("r")
        return rows.groupBy("version").agg(first).select("version", "r.*")

    def last(self) -> tuple[int, str | None]:
        """The last version and its data folder; version 0 has none."""
        r = self.log().orderBy(F.desc("version")).limit(1).collect()
        return (r[0]["version"], r[0]["data"]) if r else (0, None)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, else of the last one. A reader keeps what it has begun to read."""
        if version is None:
            version, data = self.last()
        else:
            found = self.log().where(F.col("version") == version).collect()
            if not found and version:
                raise ValueError(f"no version {version}")
            data = found[0]["data"] if found else None
        if data is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{data}")

    def _switch(self, version: int, data: str, kind: str, inputs: list[str]) -> int:
        row = self.spark.createDataFrame([(version, data, kind, inputs)], LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        held = self.log().where(F.col("version") == version).first()
        if held["data"] != data:
            raise Conflict(f"version {version} is {held['data']}")
        return version

    def write(self, rows: DataFrame, kind: str = "write", inputs: list[str] | None = None) -> int:
        """The rows as the next version; its number."""
        base, _ = self.last()
        data = uuid.uuid4().hex
        rows.select(*self.schema.fieldNames()).write.parquet(f"{self.path}/data/{data}")
        return self._switch(base + 1, data, kind, inputs or [])

    def add(self, rows: DataFrame, inputs: list[str]) -> int:
        """The last version with more rows; inputs that a version was made of already are refused."""
        known = set(self.current_inputs())
        again = sorted(known & set(inputs))
        if again:
            raise ValueError(f"already in the store: {', '.join(again)}")
        return self.write(self.read().unionByName(rows.select(*self.schema.fieldNames())), "add", sorted(known | set(inputs)))

    def current_inputs(self) -> list[str]:
        """What the last version was made of."""
        r = self.log().orderBy(F.desc("version")).limit(1).collect()
        return list(r[0]["inputs"]) if r else []

    def rebuild(self, sources: dict[str, Callable[[], DataFrame]], process: Callable[[DataFrame], DataFrame]) -> int:
        """Everything again from the sources, by name. Readers see the version before until the last row is written."""
        rows = None
        for name in sorted(sources):
            one = sources[name]()
            rows = one if rows is None else rows.unionByName(one)
        made = process(rows) if rows is not None else self.spark.createDataFrame([], self.schema)
        return self.write(made, "rebuild", sorted(sources))

    def roll_back(self, version: int) -> int:
        """An earlier version again, as a new one: its data folder is used as it is."""
        r = self.log().where(F.col("version") == version).collect()
        if not r:
            raise ValueError(f"no version {version}")
        base, _ = self.last()
        row = self.spark.createDataFrame([(base + 1, r[0]["data"], "roll back", list(r[0]["inputs"]))], LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        return base + 1
