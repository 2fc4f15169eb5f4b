"""Queries of archives, readers, configuration files and jobs."""

from __future__ import annotations

import bz2
import gzip
import io
import tarfile
import uuid
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from terraloom.sources import archives, config, swath
from terraloom.sources.staging import shared_base, spread

from .registry import query
from .views import FOOT, foot, table

#: Archives of a task.
_TASK = 2000
_SUFFIX = (".zip", ".tar.gz", ".gz", ".bz2", ".kmz")


def _archives(spark, sf_dir):
    """path, content: an archive for every part, of five kinds, with three members where it can have several; every
    eleventh is broken."""

    def pack(name: str, i: int) -> bytes:
        parts = [(f"s{i}_b1.{'tif' if i % 2 else 'png'}", b"one%d" % i), (f"s{i}_b2.{'tif' if i % 4 == 1 else 'jpg'}", b"two"), (f"doc/s{i}.txt", b"text")]
        out = io.BytesIO()
        if i % 11 == 0:
            return b"broken"
        if name.endswith((".zip", ".kmz")):
            with zipfile.ZipFile(out, "w") as z:
                for n, data in parts:
                    z.writestr(n, data)
        elif name.endswith(".tar.gz"):
            with tarfile.open(fileobj=out, mode="w:gz") as t:
                for n, data in parts:
                    info = tarfile.TarInfo(n)
                    info.size = len(data)
                    t.addfile(info, io.BytesIO(data))
        else:
            return (gzip if name.endswith(".gz") else bz2).compress(b"one%d" % i)
        return out.getvalue()

    @F.pandas_udf("binary")
    def content(path: pd.Series, i: pd.Series) -> pd.Series:
        return pd.Series([pack(p, int(k)) for p, k in zip(path, i)])

    suffix = F.element_at(F.array(*map(F.lit, _SUFFIX)), (F.col("id") % 5 + 1).cast("int"))
    named = spread(foot(spark, sf_dir), _TASK).select("id", F.concat(F.lit("/in/s"), F.col("id").cast("string"), F.when(F.col("id") % 5 == 2, ".tif").when(F.col("id") % 5 == 3, ".grd").otherwise(""), suffix).alias("path"))
    return named.select("path", content("path", "id").alias("content"))


_PATHS = f"""{FOOT}, p AS (SELECT id, '/in/s' || id || CASE id % 5 WHEN 2 THEN '.tif' WHEN 3 THEN '.grd' ELSE '' END || ['{"', '".join(_SUFFIX)}'][id % 5 + 1] AS path FROM foot),
m AS (SELECT id, path, 0 AS pos, 's' || id || '_b1.' || CASE WHEN id % 2 = 1 THEN 'tif' ELSE 'png' END AS member, 3 + length(CAST(id AS VARCHAR)) AS size FROM p WHERE id % 5 IN (0, 1, 4) AND id % 11 > 0
UNION ALL SELECT id, path, 1, 's' || id || '_b2.' || CASE WHEN id % 4 = 1 THEN 'tif' ELSE 'jpg' END, 3 FROM p WHERE id % 5 IN (0, 1, 4) AND id % 11 > 0 UNION ALL SELECT id, path, 2, 'doc/s' || id || '.txt', 4 FROM p WHERE id % 5 IN (0, 1, 4) AND id % 11 > 0
UNION ALL SELECT id, path, 0, 's' || id || CASE id % 5 WHEN 2 THEN '.tif' ELSE '.grd' END, 3 + length(CAST(id AS VARCHAR)) FROM p WHERE id % 5 IN (2, 3) AND id % 11 > 0)"""


@query(f"WITH {_PATHS} SELECT path AS archive, CAST(pos AS INTEGER) AS pos, member, CAST(size AS INTEGER) AS size, false AS broken FROM m UNION ALL SELECT path, NULL, NULL, NULL, true FROM p WHERE id % 11 = 0")
def archive_members(spark, sf_dir):
    """Every member of every archive with its size; a broken one is a row of its own."""
    found = archives.members(_archives(spark, sf_dir))
    return found.select("archive", "pos", "member", F.length("bytes").alias("size"), F.col("error").isNotNull().alias("broken"))


@query(f"""WITH {_PATHS}, r AS (SELECT *, list_position(['tif', 'sid', 'jp2', 'bil', 'png', 'jpg', 'gif', 'grd'], regexp_extract(member, '[.]([a-z0-9]+)$', 1)) AS rank FROM m)
SELECT path AS archive, member FROM r WHERE rank > 0 QUALIFY rank = min(rank) OVER (PARTITION BY path)""")
def archive_picks(spark, sf_dir):
    """The members of the first format that an archive has."""
    return archives.pick(archives.members(_archives(spark, sf_dir), False)).select("archive", "member")


@query(f"""WITH {FOOT} SELECT id, CASE id % 9 WHEN 0 THEN 'tar' WHEN 1 THEN 'tar' WHEN 2 THEN 'tar' WHEN 3 THEN 'zip' WHEN 4 THEN 'kmz' WHEN 5 THEN 'gz' WHEN 6 THEN 'bz2' WHEN 7 THEN 'swath' ELSE 'file' END AS kind FROM foot""")
def reader_kinds(spark, sf_dir):
    """Which reader each file's compound extension calls for."""
    names = [".tar", ".TAR.GZ", ".tgz", ".Zip", ".kmz", ".txt.gz", ".tif.bz2", ".swath", ".tif"]
    path = F.concat(F.lit("/x/a"), F.col("id").cast("string"), F.element_at(F.array(*map(F.lit, names)), (F.col("id") % 9 + 1).cast("int")))
    return foot(spark, sf_dir).select("id", archives.kind(path).alias("kind"))


@query("SELECT CAST(s_suppkey AS INTEGER) AS band, CAST(s_suppkey % 10 AS INTEGER) AS reference, CAST(count(*) FILTER (s_suppkey % (k + 2) = 1) AS INTEGER) AS n_bad, CAST(sum(k) FILTER (s_suppkey % (k + 2) = 1) AS INTEGER) AS sum_bad FROM supplier, (SELECT unnest(range(10)) AS k) GROUP BY s_suppkey")
def detector_configs(spark, sf_dir):
    """Detector configurations written as files of lines and read again, the last line too."""
    n = F.col("s_suppkey")
    flags = F.array_join(F.transform(F.sequence(F.lit(2), F.lit(11)), lambda k: (n % k == 1).cast("int").cast("string")), ", ")
    path = f"{shared_base(spark)}/config-{uuid.uuid4().hex}"
    lines = table(spark, sf_dir, "supplier").select(F.concat_ws(", ", n.cast("string"), (n % 10).cast("string"), flags).alias("value"))
    lines.union(spark.createDataFrame([("# band, reference, a flag for each detector",)], "value string")).write.text(path)
    c = swath.detector_config(spark, path)
    total = F.aggregate("bad", F.lit(0), lambda a, x: a + x)
    return c.select("band", "reference", F.size("bad").alias("n_bad"), F.when(F.size("bad") > 0, total).alias("sum_bad"))


@query(f"""WITH {FOOT} SELECT id, CASE WHEN id % 7 > 0 AND id % 5 > 0 THEN '/in/g' || id || '.hdf' END AS input, CASE WHEN id % 7 > 0 AND id % 5 > 0 THEN CAST(CASE WHEN id % 2 = 0 THEN 16 ELSE 0 END AS INTEGER) END AS projection, CASE WHEN id % 7 > 0 AND id % 5 > 0 THEN ['NN', 'BI', 'CC'][id % 3 + 1] END AS kernel,
CASE WHEN id % 7 > 0 AND id % 5 > 0 THEN 'EV_1KM,0,1|EV_' || id END AS sds, CASE WHEN id % 7 > 0 AND id % 5 > 0 THEN CASE WHEN id % 2 = 0 THEN 500.0::DOUBLE ELSE 0.25::DOUBLE END END AS pixel, CASE WHEN id % 7 = 0 THEN 'output is missing' WHEN id % 5 = 0 THEN 'unknown kernel QQ' END AS error FROM foot""")
def job_configs(spark, sf_dir):
    """Parameter texts as jobs; those that are none say why."""
    i = F.col("id")
    text = F.concat_ws(
        "\n", F.lit("# a job"), F.concat(F.lit('INPUT_FILENAME = "/in/g'), i.cast("string"), F.lit('.hdf" # in')), F.when(i % 7 > 0, F.lit("output_filename = /out/x")), F.lit("GEOLOCATION_FILENAME = /in/geo"),
        F.concat(F.lit("OUTPUT_PROJECTION_NUMBER = "), F.when(i % 2 == 0, "SNSOID").otherwise("geo")), F.concat(F.lit("KERNEL_TYPE = "), F.when(i % 5 == 0, "QQ").otherwise(F.element_at(F.array(F.lit("nn"), F.lit("bi"), F.lit("cc")), (i % 3 + 1).cast("int")))),
        F.concat(F.lit("INPUT_SDS_NAME = EV_1KM,0,1; EV_"), i.cast("string")), F.concat(F.lit("OUTPUT_PIXEL_SIZE = "), F.when(i % 2 == 0, "500").otherwise("0.25")),
    )
    jobs = config.parsed_jobs(foot(spark, sf_dir).select("id", text.alias("text")), "text", "id")
    return jobs.select("id", "input", "projection", "kernel", F.when(F.col("sds").isNotNull(), F.array_join("sds", "|")).alias("sds"), "pixel", "error")


@query(f"""WITH {FOOT} SELECT id, concat_ws(',', CASE WHEN id % 4 = 0 THEN 'outdir' END, CASE WHEN id % 6 < 2 THEN 'indir' END, 'mapserverpath') AS missing, CASE WHEN id % 3 = 0 THEN 'near' ELSE 'average' END AS resample, '8' AS "limit" FROM foot""")
def dataset_settings(spark, sf_dir):
    """What each dataset has left out, and its settings with the defaults."""
    i = F.col("id")
    settings = F.map_from_arrays(
        F.array(*map(F.lit, ("dsname", "outdir", "indir", "resample"))),
        F.array(F.concat(F.lit("d"), i.cast("string")), F.when(i % 4 == 0, " ").otherwise("/out"), F.when(i % 6 < 2, F.lit(None)).otherwise("/in"), F.when(i % 3 == 0, "near").otherwise("")),
    )
    full = config.with_defaults(settings, cpus=8)
    return foot(spark, sf_dir).select("id", F.array_join(config.missing(settings), ",").alias("missing"), F.element_at(full, "resample").alias("resample"), F.element_at(full, "limit").alias("limit"))
