"""Queries over scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.functions import scalar
from terraloom.sources.staging import spread

from .registry import query
from .views import DN, FOOT, PX1, dn, foot, px1, table

_NAMES = [
    "'get /a/AB12' || '345678' || strftime(o_orderdate, '%Y%m%d') || '.tif'",
    "'get /a/QX07N12_123456W123_654321' || strftime(o_orderdate, '%Y%m%d') || '.tif'",
    "'get /a/AST_L1B_003' || strftime(o_orderdate, '%m%d%Y') || '123456_' || '01022003' || '.hdf'",
    "'get /a/MOD09.A' || strftime(o_orderdate, '%Y%j') || '.h08.hdf'",
    "'get /a/flood_' || lower(strftime(o_orderdate, '%B%d')) || '.shp'",
    "'get /a/EO1H123456' || strftime(o_orderdate, '%Y%j') || '_B1.tif'",
    "'get x=LE7123456' || strftime(o_orderdate, '%Y%j') || 'EDC.tif'",
    "'get /a/nothing_here_' || CAST(o_orderkey % 10 AS VARCHAR)",
]
_SPARK_NAMES = [
    "concat('get /a/AB12345678', date_format(o_orderdate, 'yyyyMMdd'), '.tif')",
    "concat('get /a/QX07N12_123456W123_654321', date_format(o_orderdate, 'yyyyMMdd'), '.tif')",
    "concat('get /a/AST_L1B_003', date_format(o_orderdate, 'MMddyyyy'), '123456_01022003.hdf')",
    "concat('get /a/MOD09.A', date_format(o_orderdate, 'yyyyDDD'), '.h08.hdf')",
    "concat('get /a/flood_', lower(date_format(o_orderdate, 'MMMMdd')), '.shp')",
    "concat('get /a/EO1H123456', date_format(o_orderdate, 'yyyyDDD'), '_B1.tif')",
    "concat('get x=LE7123456', date_format(o_orderdate, 'yyyyDDD'), 'EDC.tif')",
    "concat('get /a/nothing_here_', CAST(o_orderkey % 10 AS STRING))",
]


def _case(parts):
    return "CASE o_orderkey % 8 " + " ".join(f"WHEN {k} THEN {p}" for k, p in enumerate(parts)) + " END"


@query(f"""WITH named AS (SELECT o_orderkey, {_case(_NAMES)} AS line, o_orderdate FROM orders)
SELECT o_orderkey, line, CAST(CASE WHEN o_orderkey % 8 = 7 THEN NULL WHEN o_orderkey % 8 = 4 THEN '2010' || strftime(make_date(2010, month(o_orderdate), 1) + INTERVAL (day(o_orderdate) - 1) DAY, '%m%d')
ELSE strftime(o_orderdate, '%Y%m%d') END AS INTEGER) AS ymd FROM named""")
def date_extract(spark, sf_dir):
    named = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_case(_SPARK_NAMES)).alias("line"))
    return named.withColumn("ymd", scalar.date_of_name(F.col("line"), 2010))


@query("SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS ymd FROM orders")
def julian_to_date(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", scalar.julian_day(F.date_format("o_orderdate", "yyyyDDD")).alias("ymd"))


@query(r"""SELECT page_id, regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) AS query, regexp_extract(url, '^[^#]*(#.*)$', 1) AS hash,
'/' || split_part(split_part(split_part(regexp_replace(url, '^[a-z]+://', ''), '?', 1), '#', 1), '/', 2) || CASE WHEN regexp_extract(url, '^[a-z]+://[^/]*/[^/?#]*(/[^?#]*)', 1) <> '' THEN regexp_extract(url, '^[a-z]+://[^/]*/[^/?#]*(/[^?#]*)', 1) ELSE '' END AS path,
split_part(split_part(url, '://', 2), '/', 1) AS host, split_part(url, '://', 1) AS proto FROM pages""")
def url_parts(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", scalar.url_query(u).alias("query"), scalar.url_hash(u).alias("hash"), scalar.url_path(u).alias("path"), scalar.url_host(u).alias("host"), scalar.url_proto(u).alias("proto"))


@query(r"""WITH t AS (SELECT page_id, url || ' (é~_*)' AS raw FROM pages)
SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(raw, '%', '%25'), ':', '%3a'), '/', '%2f'), '?', '%3f'), '=', '%3d'), '&', '%26'), '#', '%23'), '_', '%5f'), '~', '%7e'), 'é', '%c3%a9').replace(' ', '+') AS encoded FROM t""")
def url_form_encode(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", scalar.form_encode(F.concat("url", F.lit(" (é~_*)"))).alias("encoded"))


@query(r"""WITH p AS (SELECT doc_id, '/in//' || source || '//' || lang || CAST(doc_id AS VARCHAR) || CASE doc_id % 4 WHEN 0 THEN '.tar.GZ' WHEN 1 THEN '.TIF' WHEN 2 THEN '' ELSE '.aux.xml' END AS path FROM documents)
SELECT doc_id, lang_base AS base, ext, '/in//' || source || '/' AS dir, '/in/' || source || '/' || name AS fixed FROM
(SELECT p.doc_id, d.source, d.lang || CAST(d.doc_id AS VARCHAR) || CASE d.doc_id % 4 WHEN 3 THEN '.aux' ELSE '' END AS lang_base, CASE d.doc_id % 4 WHEN 0 THEN 'tar.gz' WHEN 1 THEN 'tif' WHEN 2 THEN '' ELSE 'xml' END AS ext,
regexp_replace(path, '^.*/', '') AS name FROM p JOIN documents d USING (doc_id))""")
def path_parts(spark, sf_dir):
    tail = F.expr("CASE doc_id % 4 WHEN 0 THEN '.tar.GZ' WHEN 1 THEN '.TIF' WHEN 2 THEN '' ELSE '.aux.xml' END")
    p = F.concat(F.lit("/in//"), "source", F.lit("//"), "lang", F.col("doc_id").cast("string"), tail)
    return table(spark, sf_dir, "documents").select("doc_id", p.alias("path")).select(
        "doc_id", scalar.base_name(F.col("path")).alias("base"), scalar.extension(F.col("path")).alias("ext"), scalar.directory(F.col("path")).alias("dir"), scalar.fix_path(F.col("path")).alias("fixed")
    )


@query("""WITH b AS (SELECT event_id, ['Yes', 'no', 'TRUE', 'false', '1', '0', 'maybe'][1 + CAST(event_id % 7 AS INTEGER)] AS t FROM events)
SELECT event_id, CASE WHEN lower(t) IN ('yes', 'true', '1') THEN true WHEN lower(t) IN ('no', 'false', '0') THEN false ELSE true END AS flag FROM b""")
def bool_parse(spark, sf_dir):
    t = F.element_at(F.array(*map(F.lit, ["Yes", "no", "TRUE", "false", "1", "0", "maybe"])), (1 + F.col("event_id") % 7).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", scalar.is_true(t, True).alias("flag"))


@query(f"""WITH {FOOT} SELECT id, round(CASE WHEN abs(ymin) <= 60 THEN sign(ymin) * (floor(abs(ymin)) * 1000000 + floor((abs(ymin) - floor(abs(ymin))) * 60) * 1000 + ((abs(ymin) - floor(abs(ymin))) * 60 - floor((abs(ymin) - floor(abs(ymin))) * 60)) * 60) END, 4) AS packed FROM foot""")
def pack_dms(spark, sf_dir):
    return foot(spark, sf_dir).select("id", F.round(scalar.pack_dms(F.col("ymin"), 60.0), 4).alias("packed"))


@query(f"WITH {DN} SELECT det, count(*) FILTER (WHERE v BETWEEN 0 AND 32767) AS n_valid, count(*) AS n FROM dn GROUP BY det")
def range_check(spark, sf_dir):
    return dn(spark, sf_dir).groupBy("det").agg(F.count_if(F.col("v").between(0, 32767)).alias("n_valid"), F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, least(l_tax, l_discount) AS fmin, greatest(l_tax, l_discount) AS fmax, abs(l_tax - l_discount) AS fabs, CAST(CAST(l_partkey AS VARCHAR) || 'e-2' AS DOUBLE) AS sci, CAST(sign(l_tax - l_discount) AS INTEGER) AS cmp FROM lineitem")
def float_helpers(spark, sf_dir):
    a, b = F.col("l_tax"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.least(a, b).alias("fmin"), F.greatest(a, b).alias("fmax"), F.abs(a - b).alias("fabs"),
        scalar.sci_to_decimal(F.concat(F.col("l_partkey").cast("string"), F.lit("e-2"))).alias("sci"), F.signum(a - b).cast("int").alias("cmp"),
    )


@query("SELECT p_partkey, strpos(p_name, 'r') AS pos, substr(p_name, 2, 4) AS mid, upper(p_name) AS up, replace(p_name, ' ', '') AS packed, trim('\"' FROM '\"' || p_name || '\"') AS unquoted FROM part")
def string_primitives(spark, sf_dir):
    n = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.locate("r", n).cast("long").alias("pos"), F.substring(n, 2, 4).alias("mid"), F.upper(n).alias("up"), F.replace(n, F.lit(" "), F.lit("")).alias("packed"),
        F.btrim(F.concat(F.lit('"'), n, F.lit('"')), F.lit('"')).alias("unquoted"),
    )


@query("SELECT p_partkey, 'NAME = /data/' || p_name AS line FROM part")
def config_cleanup(spark, sf_dir):
    line = F.concat(F.lit("NAME = $(ROOT)/"), "p_name", F.lit("   # a remark with $(ROOT)"))
    return table(spark, sf_dir, "part").select("p_partkey", scalar.strip_comment(line, {"ROOT": "/data"}).alias("line"))


@query("SELECT p_partkey, 'size' AS key, p_brand || '|' || CAST(p_size AS VARCHAR) || '|' || p_type AS vals, CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 ELSE 99 END AS proj FROM part")
def key_value_args(spark, sf_dir):
    parts = F.str_to_map(F.concat(F.lit("size="), F.concat_ws(",", "p_brand", F.col("p_size").cast("string"), "p_type")), F.lit(";"), F.lit("="))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", parts.alias("m"))
    proj = F.coalesce(F.element_at(F.create_map(F.lit("economy"), F.lit(1), F.lit("standard"), F.lit(2)), F.lower("p_type")), F.lit(99))
    return part.select("p_partkey", F.element_at(F.map_keys("m"), 1).alias("key"), F.array_join(F.split(F.element_at("m", "size"), ","), "|").alias("vals"), proj.alias("proj"))


_STEPS = [(50.0, "low"), (150.0, "mid"), (300.0, "high")]


@query(f"WITH {PX1} SELECT l, s, CASE WHEN v <= 50 THEN 'low' WHEN v <= 150 THEN 'mid' WHEN v <= 300 THEN 'high' ELSE 'none' END AS class FROM px1")
def threshold_class(spark, sf_dir):
    return px1(spark, sf_dir).select("l", "s", scalar.first_class(F.col("v"), _STEPS).alias("class"))


@query("""SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN p_brand || ',x' ELSE p_brand || ',' || p_type || ',x' END AS removed, p_brand || ',' || p_type || ',x' AS added, p_brand || ',' || p_type || ',x,new' AS grown FROM part""")
def comma_set(spark, sf_dir):
    c = F.concat_ws(",", "p_brand", "p_type", F.lit("x"))
    return table(spark, sf_dir, "part").select("p_partkey", scalar.comma_remove(c, F.lit("ECONOMY")).alias("removed"), scalar.comma_add(c, F.col("p_brand")).alias("added"), scalar.comma_add(c, F.lit("new")).alias("grown"))


@query("SELECT l_orderkey, l_linenumber, l_returnflag || '_b' || CAST(l_linenumber AS VARCHAR) AS band, list_contains([1, 4, 3], l_linenumber) AS wanted FROM lineitem")
def band_names(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat_ws("_b", "l_returnflag", F.col("l_linenumber").cast("string")).alias("band"), F.col("l_linenumber").isin(1, 4, 3).alias("wanted"))


@query(f"WITH {FOOT} SELECT id, ymax AS north, ymin AS south, xmax AS east, xmin AS west, 'tile' || CAST(id AS VARCHAR) || '.png' AS href FROM foot")
def ground_overlays(spark, sf_dir):
    xml = F.format_string("<GroundOverlay><Icon><href>tile%d.png</href></Icon><LatLonBox><north>%s</north><south>%s</south><east>%s</east><west>%s</west></LatLonBox></GroundOverlay>", "id", *[F.col(c).cast("string") for c in ("ymax", "ymin", "xmax", "xmin")])
    from terraloom.sources.markup import read_overlays

    # Each text is parsed several times: dear work on a compact table.
    return read_overlays(spread(foot(spark, sf_dir), 2000).select("id", xml.alias("xml")), "xml").drop("xml")


@query(f"""WITH {DN}, t AS (SELECT l, s, CAST(v AS DOUBLE) AS v FROM dn)
SELECT l, s, least(greatest(v, 0.0), 255.0) AS same_u8, least(greatest(CASE WHEN v * (65535.0 / 255.0) < 0 THEN ceil(v * (65535.0 / 255.0) - 0.5) ELSE floor(v * (65535.0 / 255.0) + 0.5) END, 0.0), 65535.0) AS wide,
least(greatest(CASE WHEN -32768 + v * (65535.0 / 255.0) < 0 THEN ceil(-32768 + v * (65535.0 / 255.0) - 0.5) ELSE floor(-32768 + v * (65535.0 / 255.0) + 0.5) END, -32768.0), 32767.0) AS signed16 FROM t""")
def type_convert(spark, sf_dir):
    v = F.col("v").cast("double")
    return dn(spark, sf_dir).select("l", "s", scalar.convert_type(v, "uint8", "uint8").alias("same_u8"), scalar.convert_type(v, "uint8", "uint16").alias("wide"), scalar.convert_type(v, "uint8", "int16").alias("signed16"))
