"""Chains and trees of links by pointer doubling: as many passes as the logarithm of the longest one.

In each pass a pointer is replaced by the pointer of the row it leads to, so it leads twice as far. Rows whose pointer
has run off the end are finished. As long as a pass finishes rows, there are ends to reach; where none is finished,
the rest are circles. This needs no bound on lengths, and a table with a circle never runs for longer than its longest
chain asks for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.sources.staging import cut


def _runs(links: DataFrame, keys: list[str], best: bool) -> tuple[DataFrame, DataFrame]:
    """Rows (keys, id, to) split into those that end, as (keys, id, end, far), and those in circles, as (keys, id,
    best), where best is the smallest id of the circle. ``far`` is the number of steps to the end."""
    own = F.col("id")
    names = [*keys, "id", "to", "far", "end", "best"]
    at = cut(links.select(*keys, "id", "to", F.col("to").isNotNull().cast("long").alias("far"), F.coalesce("to", own).alias("end"), (F.least(own, F.coalesce("to", own)) if best else own).alias("best")))
    done = at.where("to is null")
    while True:
        going = at.where("to is not null")
        there = done.unionByName(going).select(*keys, F.col("id").alias("to"), *[F.col(c).alias(f"_{c}") for c in ("to", "far", "end", "best")])
        twice = going.join(there, [*keys, "to"]).select(*keys, "id", F.col("_to").alias("to"), (F.col("far") + F.col("_far")).alias("far"), F.col("_end").alias("end"), (F.least("best", "_best") if best else F.col("best")).alias("best"), F.col("best").alias("was"))
        at = cut(twice)
        rows, ended, changed = at.agg(F.count("*"), F.count_if(F.col("to").isNull()), F.count_if(F.col("to").isNotNull() & (F.col("best") != F.col("was")))).first()
        done = done.unionByName(at.where("to is null").select(*names))
        if not ended and not changed:
            return done.select(*keys, "id", "end", "far"), at.where("to is not null").select(*keys, "id", "best")
        at = at.select(*names)


def ranked(links: DataFrame, *keys: str) -> DataFrame:
    """The place of each row in its chain: keys, id, start, pos, closed, from rows (keys, id, before), where ``before``
    is the row before this one, null at a start. Every row comes before one other at most. A closed chain starts with
    its smallest id. A row whose ``before`` is not there is a start."""
    keys_ = list(keys)
    there = links.select(*keys_, F.col("id").alias("before"), F.col("id").alias("to"))
    rows = links.join(there, [*keys_, "before"], "left").select(*keys_, "id", "to")
    open_, rings = _runs(rows, keys_, True)
    out = open_.select(*keys_, "id", F.col("end").alias("start"), F.col("far").alias("pos"), F.lit(False).alias("closed"))
    if rings.isEmpty():
        return out
    again = cut(rows.join(rings, [*keys_, "id"]).select(*keys_, "id", F.when(F.col("id") != F.col("best"), F.col("to")).alias("to")))
    closed, _ = _runs(again, keys_, False)
    return out.unionByName(closed.select(*keys_, "id", F.col("end").alias("start"), F.col("far").alias("pos"), F.lit(True).alias("closed")))


def heights(nodes: DataFrame, key: str, parent: str) -> DataFrame:
    """id, height of each node of a forest: 0 for a leaf, else one more than its highest child. A parent that is no
    node has a height too. Links in a circle are an error."""
    links = nodes.where(F.col(parent).isNotNull()).select(F.col(key).alias("id"), F.col(parent).alias("to"))
    ids = nodes.select(F.col(key).alias("id")).union(links.select("to")).distinct()
    height = cut(ids.withColumn("height", F.lit(0)))
    up, step = cut(links), 1
    left = up.count()
    while left:
        # Heights over twice as many levels: those of the nodes so many levels below, and their own.
        below = up.join(height, "id").groupBy("to").agg((F.max("height") + step).alias("_h")).withColumnRenamed("to", "id")
        height = cut(height.join(below, "id", "left").select("id", F.greatest("height", F.coalesce("_h", F.lit(0))).alias("height")))
        up = cut(up.join(up.select(F.col("id").alias("to"), F.col("to").alias("_to")), "to").select("id", F.col("_to").alias("to")))
        n, step = up.count(), 2 * step
        if n == left:
            raise ValueError("the links form a circle")
        left = n
    return height
