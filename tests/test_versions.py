"""Versions, rebuilds, conflicts and killed writers."""

import pytest
from pyspark.sql import functions as F

from terraloom.streaming.versions import Conflict, Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "s"), spark.range(1).withColumn("v", F.lit(0)).schema)


def rows(spark, *ids, v=0):
    return spark.createDataFrame([(i, v) for i in ids], "id long, v int")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_an_empty_store(store):
    assert store.last() == (0, None) and store.read().count() == 0 and store.read().columns == ["id", "v"]
    with pytest.raises(ValueError):
        store.read(3)


def test_versions_and_roll_back(spark, store):
    assert store.add(rows(spark, 1, 2), ["a"]) == 1
    reader = store.read()
    assert store.add(rows(spark, 3), ["b"]) == 2
    assert ids(store.read()) == [1, 2, 3] and ids(store.read(1)) == [1, 2] and ids(reader) == [1, 2]
    assert store.current_inputs() == ["a", "b"]
    with pytest.raises(ValueError, match="already"):
        store.add(rows(spark, 9), ["b", "c"])
    assert store.rebuild({"x": lambda: rows(spark, 7), "y": lambda: rows(spark, 8)}, lambda r: r.where("id > 7")) == 3
    assert ids(store.read()) == [8] and store.current_inputs() == ["x", "y"]
    assert store.roll_back(2) == 4 and ids(store.read()) == [1, 2, 3] and store.current_inputs() == ["a", "b"]
    assert store.rebuild({}, lambda r: r) == 5 and ids(store.read()) == []


def test_a_killed_rebuild_leaves_the_old_version(spark, store):
    store.add(rows(spark, 1), ["a"])
    bad = lambda r: r.withColumn("v", F.when(F.col("id") == 5, F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        store.rebuild({"x": lambda: rows(spark, *range(10)).repartition(5)}, bad)
    assert store.last()[0] == 1 and ids(store.read()) == [1]
    assert store.rebuild({"x": lambda: rows(spark, 2)}, lambda r: r) == 2 and ids(store.read()) == [2]


def test_two_writers_of_one_version(spark, store):
    store.write(rows(spark, 1))
    a, b = (Store(spark, store.path, store.schema) for _ in range(2))
    made = []
    for s, name in ((a, "b" * 32), (b, "a" * 32), (b, "c" * 32)):
        rows(spark, len(made)).write.parquet(f"{s.path}/data/{name}")
        try:
            made.append(s._switch(2, name, "write", []))
        except Conflict:
            made.append(None)
    assert made[1:] == [2, None] and store.last() == (2, "a" * 32)
