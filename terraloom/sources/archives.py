"""Members of archives as rows, read where the archive's bytes are."""

from __future__ import annotations

import bz2
import gzip
import io
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Formats looked for inside an archive, in this order (fixed values).
RASTER_FORMATS = ["tif", "sid", "jp2", "bil", "png", "jpg", "gif", "grd"]
VECTOR_FORMATS = ["shp"]
#: Members, and bytes of theirs, that are handed on together; all of one archive are.
_ROWS, _BYTES = 4096, 1 << 24
_MEMBER = pa.schema([("archive", pa.string()), ("pos", pa.int32()), ("member", pa.string()), ("ext", pa.string()), ("bytes", pa.binary()), ("error", pa.string())])


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path and content of the files below a folder, each with its reader's kind."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return df.select("path", "modificationTime", "length", "content").withColumn("kind", kind(F.col("path")))


def kind(path: Column) -> Column:
    """Which reader a file's (compound) extension calls for."""
    p = F.lower(path)
    rules = [("tar", r"\.(tar|tar\.gz|tgz|tar\.bz2)$"), ("zip", r"\.(zip)$"), ("kmz", r"\.kmz$"), ("gz", r"\.gz$"), ("bz2", r"\.bz2$"), ("swath", r"\.swath$")]
    out = F
    for name, pattern in rules:
        out = out.when(p.rlike(pattern), name)
    return out.otherwise("file")


def _members(name: str, content: bytes) -> Iterator[tuple[int, str, bytes]]:
    low = name.lower()
    if low.endswith((".zip", ".kmz")):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for k, info in enumerate(i for i in z.infolist() if not i.is_dir()):
                yield k, info.filename, z.read(info)
    elif re.search(r"\.(tar|tar\.gz|tgz|tar\.bz2)$", low):
        with tarfile.open(fileobj=io.BytesIO(content)) as t:
            for k, m in enumerate(m for m in t.getmembers() if m.isfile()):
                yield k, m.name, t.extractfile(m).read()
    elif low.endswith(".gz"):
        yield 0, name.rsplit("/", 1)[-1][:-3], gzip.decompress(content)
    elif low.endswith(".bz2"):
        yield 0, name.rsplit("/", 1)[-1][:-4], bz2.decompress(content)
    else:
        yield 0, name.rsplit("/", 1)[-1], content


def members(archives: DataFrame, with_content: bool = True) -> DataFrame:
    """archive, pos, member, ext and (if wanted) bytes of every member. A broken archive gives one row with an error
    and no member, and does not stop the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                path, content = path.as_py(), content.as_py()
                rows = []
                try:
                    for pos, member, data in _members(path, content):
                        rows.append((path, pos, member, member.rsplit(".", 1)[-1].lower() if "." in member else "", data if with_content else None, None))
                except Exception as e:
                    rows = [(path, None, None, None, None, f"{type(e).__name__}: {e}")]
                held += rows
                size += sum(len(r[4] or b"") for r in rows)
                if len(held) >= _ROWS or size >= _BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _MEMBER.types)], schema=_MEMBER)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _MEMBER.types)], schema=_MEMBER)

    return archives.select("path", "content").mapInArrow(run, "archive string, pos int, member string, ext string, bytes binary, error string")


def pick(found: DataFrame, glob: str | None = None, formats: list[str] | None = None) -> DataFrame:
    """Members that match the pattern; without one, those in the first format of the list that the archive has."""
    found = found.where("member is not null")
    if glob:
        return found.where(F.lower("member").rlike(glob.lower()))
    rank = F.array_position(F.array(*map(F.lit, formats or RASTER_FORMATS)), F.col("ext"))
    ranked = found.withColumn("rank", rank).where("rank > 0")
    return ranked.withColumn("_best", F.min("rank").over(Window.partitionBy("archive"))).where("rank = _best").drop("rank", "_best")


def bands(found: DataFrame, patterns: list[str]) -> DataFrame:
    """archive and the members that fit each pattern first, in the order of the patterns; archives that lack one are
    left out."""
    hits = [F.min_by(F.when(F.lower("member").rlike(p.lower()), F.col("member")), F.when(F.lower("member").rlike(p.lower()), F.col("pos"))).alias(f"b{k}") for k, p in enumerate(patterns, 1)]
    out = found.where("member is not null").groupBy("archive").agg(*hits)
    for k in range(1, len(patterns) + 1):
        out = out.where(F.col(f"b{k}").isNotNull())
    return out
