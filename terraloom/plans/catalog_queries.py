"""Queries over the layer catalog and over listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.operators import algebra, catalog

from .registry import query
from .views import FOOT, LAY, PX1, foot, lay, px1, table


@query(f"WITH {LAY} SELECT lid, dsname, ts, w, s, e, n FROM lay WHERE dsname = '1-URGENT' ORDER BY ts, lid")
def layers_by_dataset(spark, sf_dir):
    return catalog.layers_of(lay(spark, sf_dir), "1-URGENT")


@query(f"""WITH {LAY} SELECT lid, dsname, ts, w, s, e, n, CAST(rank AS INTEGER) AS rank FROM
(SELECT *, row_number() OVER (PARTITION BY dsname ORDER BY ts DESC, lid DESC) AS rank FROM lay) WHERE rank <= 2""")
def latest_two(spark, sf_dir):
    return catalog.latest(lay(spark, sf_dir), 2)


@query(f"WITH {LAY} SELECT lid, dsname, ts, w, s, e, n FROM lay WHERE dsname IS DISTINCT FROM '5-LOW'")
def drop_dataset(spark, sf_dir):
    return catalog.drop_dataset(lay(spark, sf_dir), "5-LOW")


@query(f"""WITH {LAY}, moved AS (SELECT lid, dsname, ts, w, s - 1 AS s, e, n + 1 AS n FROM lay WHERE lid % 3 = 0),
both_ AS (SELECT *, 0 AS isnew FROM lay UNION ALL SELECT *, 1 FROM moved),
kept AS (SELECT *, row_number() OVER (PARTITION BY dsname, ts ORDER BY isnew DESC, lid DESC) AS r FROM both_)
SELECT lid, dsname, ts, w, s, e, n, round(6378137.0 * radians(w), 3) AS gw, round(6378137.0 * ln(tan(pi() / 4 + radians(greatest(s, -86.0)) / 2)), 3) AS gs,
round(6378137.0 * radians(e), 3) AS ge, round(6378137.0 * ln(tan(pi() / 4 + radians(least(n, 86.0)) / 2)), 3) AS gn FROM kept WHERE r = 1""")
def layer_upsert(spark, sf_dir):
    stored = lay(spark, sf_dir)
    changes = stored.where("lid % 3 = 0").withColumns({"s": F.col("s") - 1, "n": F.col("n") + 1})
    out = catalog.with_extent_texts(catalog.upsert(stored, changes, ["dsname", "ts"], "lid"))
    return out.withColumns({c: F.round(c, 3) for c in ("gw", "gs", "ge", "gn")})


@query(f"WITH {LAY} SELECT dsname, ts, min(w) AS w, min(s) AS s, max(e) AS e, max(n) AS n FROM lay GROUP BY dsname, ts")
def layer_extent_agg(spark, sf_dir):
    return catalog.extents(lay(spark, sf_dir), "dsname", "ts")


@query(f"WITH {FOOT} SELECT id, xmin, ymin, xmax, ymax, brand FROM foot WHERE xmin <= 12.5 AND xmax >= 12.5 AND ymin <= 20.0 AND ymax >= 20.0 OR xmin <= -60 AND xmax >= -60 AND ymin <= 0 AND ymax >= 0")
def find_tile(spark, sf_dir):
    tiles = foot(spark, sf_dir)
    return catalog.covering(tiles, 12.5, 20.0).union(catalog.covering(tiles, -60.0, 0.0))


@query(f"WITH {PX1} SELECT ds, CAST(day AS VARCHAR) AS day, count(*) AS n, round(min(v), 6) AS vmin, round(max(v), 6) AS vmax FROM px1 GROUP BY ds, day")
def daily_buckets(spark, sf_dir):
    return catalog.daily(px1(spark, sf_dir)).withColumn("day", F.col("day").cast("string"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def ingest_anti_join(spark, sf_dir):
    return catalog.not_held(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels").select("doc_id"), "doc_id")


@query("""WITH new_ AS (SELECT doc_id, CASE WHEN n_chars % 7 = 0 THEN 'Error' ELSE md5(text) END AS content FROM documents),
old_ AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'stale' ELSE md5(text) END AS content FROM documents WHERE doc_id % 10 <> 1)
SELECT doc_id, n.content FROM new_ n LEFT JOIN old_ o USING (doc_id) WHERE n.content IS DISTINCT FROM o.content AND n.content NOT LIKE '%Error%'""")
def changed_only(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    new = docs.select("doc_id", F.when(F.col("n_chars") % 7 == 0, "Error").otherwise(F.md5("text")).alias("content"))
    old = docs.where("doc_id % 10 <> 1").select("doc_id", F.when(F.col("doc_id") % 4 == 0, "stale").otherwise(F.md5("text")).alias("content"))
    return catalog.changed(new, old, "doc_id", "content")


@query(f"""WITH {LAY}, batch AS (SELECT DISTINCT dsname, ts FROM lay WHERE lid % 97 = 0)
SELECT lid, dsname, ts, w, s, e, n FROM lay WHERE EXISTS (SELECT 1 FROM batch b WHERE b.dsname = lay.dsname AND b.ts = lay.ts)""")
def touched_only(spark, sf_dir):
    layers = lay(spark, sf_dir)
    return catalog.touched(layers, layers.where("lid % 97 = 0"), ["dsname", "ts"]).select("lid", "dsname", "ts", "w", "s", "e", "n")


#: Formats of a mirror in the order in which they are looked for (fixed values).
FORMATS = ["tif", "zip", "tar.gz", "tgz", "tar.bz2", "tar", "jp2", "png", "jpg", "gif"]
_EXT = ["tif", "zip", "tgz", "png", "jpg", "xml"]
_LISTED = "listed AS (SELECT page_id, page_id // 3 AS grp, ['tif', 'zip', 'tgz', 'png', 'jpg', 'xml'][1 + CAST((page_id * 5 + page_id // 6) % 6 AS INTEGER)] AS ext FROM pages)"


def _listed(spark, sf_dir):
    ext = F.element_at(F.array(*map(F.lit, _EXT)), (1 + (F.col("page_id") * 5 + F.expr("page_id div 6")) % 6).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", F.expr("page_id div 3").alias("grp"), ext.alias("ext"))


@query(f"""WITH {_LISTED}, ranked AS (SELECT *, list_position(['tif', 'zip', 'tar.gz', 'tgz', 'tar.bz2', 'tar', 'jp2', 'png', 'jpg', 'gif'], ext) AS rank FROM listed),
known AS (SELECT * FROM ranked WHERE rank > 0)
SELECT grp, page_id, ext, CAST(rank AS BIGINT) AS rank FROM known k WHERE rank = (SELECT min(rank) FROM known x WHERE x.grp = k.grp)""")
def format_priority(spark, sf_dir):
    return catalog.first_format(_listed(spark, sf_dir), "grp", "ext", FORMATS)


_FILES = "files AS (SELECT doc_id // 8 AS grp, doc_id AS pos, source || '_B' || CAST(doc_id * 7 % 5 AS VARCHAR) || '.TIF' AS name FROM documents)"


def _files(spark, sf_dir):
    name = F.concat("source", F.lit("_B"), (F.col("doc_id") * 7 % 5).cast("string"), F.lit(".TIF"))
    return table(spark, sf_dir, "documents").select(F.expr("doc_id div 8").alias("grp"), F.col("doc_id").alias("pos"), name.alias("name"))


def _patterns(spark):
    return spark.createDataFrame([("_b1",), ("_b3",), ("_b4",)], "pattern string")


_MATCHED = f"{_FILES}, pats AS (SELECT unnest(['_b1', '_b3', '_b4']) AS pattern), matched AS (SELECT grp, pattern, arg_min(name, pos) AS name, min(pos) AS pos FROM files JOIN pats ON contains(lower(name), lower(pattern)) GROUP BY grp, pattern)"


@query(f"WITH {_MATCHED} SELECT grp, pattern, name, pos FROM matched")
def first_match_band(spark, sf_dir):
    return catalog.first_match(_files(spark, sf_dir), _patterns(spark), "grp", "name", "pos")


@query(f"WITH {_MATCHED} SELECT grp FROM matched GROUP BY grp HAVING count(DISTINCT pattern) = 3")
def complete_products(spark, sf_dir):
    return catalog.complete(catalog.first_match(_files(spark, sf_dir), _patterns(spark), "grp", "name", "pos"), "grp", 3)


@query("""WITH f AS (SELECT doc_id // 5 AS base, ['tif', 'tfw', 'aux', 'aux.xml', 'tif'][1 + CAST(doc_id * 3 % 5 AS INTEGER)] AS ext, doc_id FROM documents),
g AS (SELECT base, ext, 'f' || CAST(doc_id AS VARCHAR) || '.' || ext AS name FROM f)
SELECT base, min(name) FILTER (WHERE ext NOT IN ('tfw', 'aux', 'aux.xml')) AS main, coalesce(string_agg(DISTINCT name, ';' ORDER BY name) FILTER (WHERE ext IN ('tfw', 'aux', 'aux.xml')), '') AS sidecars
FROM g GROUP BY base HAVING main IS NOT NULL""")
def sidecar_groups(spark, sf_dir):
    ext = F.element_at(F.array(*map(F.lit, ["tif", "tfw", "aux", "aux.xml", "tif"])), (1 + F.col("doc_id") * 3 % 5).cast("int"))
    files = table(spark, sf_dir, "documents").select(F.expr("doc_id div 5").alias("base"), ext.alias("ext"), "doc_id")
    files = files.withColumn("name", F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.lit("."), F.col("ext")))
    return catalog.with_sidecars(files, "base", "name", "ext", ["tfw", "aux", "aux.xml"])


@query("""WITH spans AS (SELECT dsname, CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS b FROM (SELECT event_type AS dsname, ts FROM events) GROUP BY dsname),
days AS (SELECT dsname AS subset, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM spans),
present AS (SELECT DISTINCT event_type AS subset, CAST(ts AS DATE) AS day FROM events WHERE event_id % 41 = 0)
SELECT subset, CAST(day AS VARCHAR) AS day, CAST(strftime(day, '%Y%j') AS INTEGER) AS julian FROM days d WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.subset = d.subset AND p.day = d.day)""")
def day_walk(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("subset"), F.to_date("ts").alias("day"), "event_id")
    spans = events.groupBy("subset").agg(F.min("day").alias("start"), F.max("day").alias("stop"))
    out = catalog.day_walk(spans, events.where("event_id % 41 = 0").select("subset", "day").distinct())
    return out.withColumn("day", F.col("day").cast("string"))


@query(r"""WITH lines AS (SELECT (CASE WHEN doc_id % 3 = 0 THEN 'mkdir ' ELSE 'get ' END) || 'a|' || source || '|' || lang AS line FROM documents)
SELECT DISTINCT split_part(line, '|', 2) AS source FROM lines WHERE starts_with(line, 'get') ORDER BY source""")
def sorted_distinct_lines(spark, sf_dir):
    line = F.concat(F.when(F.col("doc_id") % 3 == 0, "mkdir ").otherwise("get "), F.lit("a|"), "source", F.lit("|"), "lang")
    lines = table(spark, sf_dir, "documents").select(line.alias("line"))
    return lines.where(F.col("line").startswith("get")).select(F.split_part("line", F.lit("|"), F.lit(2)).alias("source")).distinct().orderBy("source")


@query(r"""WITH p AS (SELECT '/data/' || CAST(20100101 + o_custkey % 28 AS VARCHAR) || '/' || CASE WHEN o_orderkey % 9 = 0 THEN 'overview' ELSE 'img' END || CAST(o_orderkey AS VARCHAR) || '.tif' AS path, o_custkey FROM orders)
SELECT regexp_extract(path, '/(\d{8})/', 1) AS ts, count(*) AS n, min(o_custkey) AS first_key FROM p WHERE NOT contains(path, '/overview') GROUP BY ts""")
def tile_index_rebuild(spark, sf_dir):
    path = F.concat(F.lit("/data/"), (20100101 + F.col("o_custkey") % 28).cast("string"), F.lit("/"), F.when(F.col("o_orderkey") % 9 == 0, "overview").otherwise("img"), F.col("o_orderkey").cast("string"), F.lit(".tif"))
    files = table(spark, sf_dir, "orders").select(path.alias("path"), "o_custkey").where(~F.col("path").contains("/overview"))
    return files.groupBy(F.regexp_extract("path", r"/(\d{8})/", 1).alias("ts")).agg(F.count("*").alias("n"), F.min("o_custkey").alias("first_key"))


@query(f"""WITH {PX1}, cfg AS (SELECT * FROM (VALUES ('view', 1, 0.0), ('view', 2, 100.0), ('click', 3, 50.0)) t(ds, sub, lo))
SELECT p.ds, sub, count(*) AS n, round(min(v), 6) AS vmin FROM px1 p JOIN cfg c ON p.ds = c.ds AND v >= lo GROUP BY p.ds, sub""")
def dataset_iterator(spark, sf_dir):
    configs = spark.createDataFrame([("view", 1, 0.0), ("view", 2, 100.0), ("click", 3, 50.0)], "cds string, sub int, lo double")
    out = catalog.for_each_dataset(px1(spark, sf_dir), configs, (F.col("ds") == F.col("cds")) & (F.col("v") >= F.col("lo")))
    return out.groupBy("ds", "sub").agg(F.count("*").alias("n"), F.round(F.min("v"), 6).alias("vmin"))


@query(f"""WITH {PX1}, m AS (SELECT l, s, ds, day, CASE WHEN v < 400 THEN least(greatest(v * 2 - 50, 0), 255) END AS b FROM px1),
k AS (SELECT ds, day, l // 8 AS bl, s // 8 AS bs, round(avg(b), 8) AS mean, count(b) AS n FROM m GROUP BY ALL),
r AS (SELECT *, dense_rank() OVER (PARTITION BY ds ORDER BY day DESC) AS rank FROM k)
SELECT ds, CAST(day AS VARCHAR) AS day, bl, bs, mean, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 2""")
def corrected_composite(spark, sf_dir):
    """Band math, mask and lookup, block averages by day, and the two newest days of every dataset."""
    px = algebra.masked(px1(spark, sf_dir), "v", F.col("v") < 400)
    px = px.withColumn("b", F.least(F.greatest(F.col("v") * 2 - 50, F.lit(0.0)), F.lit(255.0)))
    blocks = px.groupBy("ds", "day", F.expr("l div 8").alias("bl"), F.expr("s div 8").alias("bs")).agg(F.round(F.avg(F.when(F.col("v").isNotNull(), F.col("b"))), 8).alias("mean"), F.count("v").alias("n"))
    days = blocks.select("ds", "day").distinct()
    from pyspark.sql import Window

    newest = days.withColumn("rank", F.row_number().over(Window.partitionBy("ds").orderBy(F.desc("day")))).where("rank <= 2")
    return blocks.join(F.broadcast(newest), ["ds", "day"]).select("ds", F.col("day").cast("string").alias("day"), "bl", "bs", "mean", "n", "rank")
