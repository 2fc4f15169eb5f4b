"""Queries of published text artefacts and of the streaming path."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from terraloom.operators import publish
from terraloom.sources import markup
from terraloom.sources.staging import shared_base
from terraloom.streaming import incremental, versions

from .registry import query
from .views import FOOT, LAY, foot, lay, table


@query("SELECT z, round(156543.0339 / pow(2.0, z), 6) AS merc, round(1.40625 / pow(2.0, z), 12) AS deg FROM (SELECT DISTINCT o_custkey % 25 AS z FROM orders)")
def resolution_ladder(spark, sf_dir):
    """The steps of both ladders that layers are shown at."""
    used = table(spark, sf_dir, "orders").selectExpr("o_custkey % 25 AS z").distinct()
    a, b = publish.resolutions(spark, publish.MERCATOR_BASE), publish.resolutions(spark, publish.DEGREE_BASE)
    return a.select("z", F.round("res", 6).alias("merc")).join(b.select("z", F.round("res", 12).alias("deg")), "z").join(used, "z")


@query(f"WITH {LAY} SELECT lid, format('LAYER NAME \"{{}}_{{}}\" EXTENT {{:.1f}} {{:.1f}} {{:.1f}} {{:.1f}} STATUS ON END', dsname, ts, w, s, e, n) AS line, '[' || dsname || ']|' || CASE WHEN n <= 84 AND s >= -84 THEN format('bbox={{:.1f}},{{:.1f}},{{:.1f}},{{:.1f}}', w, s, e, n) ELSE '' END AS entry FROM lay")
def config_lines(spark, sf_dir):
    return publish.without_bbox_beyond(publish.layer_lines(lay(spark, sf_dir)), 84.0).select("lid", "line", "entry")


@query(f"WITH {LAY} SELECT dsname, ts FROM (SELECT DISTINCT dsname, ts FROM lay) EXCEPT SELECT dsname, ts FROM lay WHERE lid % 5 = 0")
def include_lines(spark, sf_dir):
    layers = lay(spark, sf_dir)
    wanted, present = layers.select("dsname", "ts").distinct(), layers.where("lid % 5 = 0").select("dsname", "ts").distinct()
    return publish.idempotent_includes(wanted, present, ["dsname", "ts"])


@query("""WITH RECURSIVE sw AS (SELECT n_regionkey AS grp, n_nationkey AS pos, n_name || repeat('x', CAST(n_nationkey % 4 * 3 AS INTEGER)) AS label, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INTEGER) - 1 AS k, CAST(least(floor(720.0 / count(*) OVER (PARTITION BY n_regionkey)), 40) AS INTEGER) AS step FROM nation),
f AS (SELECT grp, pos, label, k, k * step AS x, true AS drawn, length(label) * 7 AS free FROM sw WHERE k = 0
UNION ALL SELECT s.grp, s.pos, s.label, s.k, s.k * s.step, s.k * s.step >= f.free, CASE WHEN s.k * s.step >= f.free THEN s.k * s.step + length(s.label) * 7 ELSE f.free END FROM f JOIN sw s ON s.grp = f.grp AND s.k = f.k + 1)
SELECT grp, pos, label, CAST(x AS INTEGER) AS x, drawn FROM f""")
def legend_offsets(spark, sf_dir):
    label = F.concat("n_name", F.repeat(F.lit("x"), (F.col("n_nationkey") % 4 * 3).cast("int")))
    sw = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("grp"), F.col("n_nationkey").alias("pos"), label.alias("label"))
    return publish.legend(sw, "pos", "label", "grp")


@query(f"""WITH {FOOT} SELECT id, 'PROJECTION = GEO' || chr(10) || 'NLINES = ' || CAST(id % 1000 AS VARCHAR) || chr(10) || 'NSAMPLES = 1354' || chr(10) || format('PIXEL_SIZE = {{:.3f}}', 0.25) || chr(10) || 'DATA_TYPE = ' || brand AS header FROM foot""")
def header_text(spark, sf_dir):
    r = foot(spark, sf_dir).select("id", F.lit("GEO").alias("proj"), (F.col("id") % 1000).alias("lines"), F.lit(1354).alias("samples"), F.lit(0.25).alias("pixel"), F.col("brand").alias("type"))
    return publish.header(r).select("id", "header")


@query(f"WITH {FOOT} SELECT id, brand AS sensor, 'corrected' AS level, CAST(id % 7 AS VARCHAR) AS band FROM foot")
def merged_attributes(spark, sf_dir):
    own = F.create_map(F.lit("sensor"), F.col("brand"), F.lit("level"), F.lit("raw"))
    added = F.create_map(F.lit("level"), F.lit("corrected"), F.lit("band"), (F.col("id") % 7).cast("string"))
    out = publish.merged_attributes(foot(spark, sf_dir).select("id", own.alias("own"), added.alias("added")), "own", "added")
    return out.select("id", *[F.element_at("attributes", k).alias(k) for k in ("sensor", "level", "band")])


@query(f"WITH {LAY} SELECT lid, CASE WHEN lid % 4 = 0 THEN '2001:02:03 04:05:06' ELSE strftime(strptime(CAST(ts AS VARCHAR), '%Y%m%d'), '%Y:%m:%d 12:00:00') END AS stamp FROM lay")
def commit_stamp(spark, sf_dir):
    layers = lay(spark, sf_dir).select("lid", "ts", F.when(F.col("lid") % 4 == 0, "2001:02:03 04:05:06").alias("stamp"))
    return publish.stamped(layers, "ts", "stamp").select("lid", "stamp")


@query("""WITH RECURSIVE t AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey > 0 THEN (s_suppkey - 1) // 3 END AS parent FROM supplier),
up(id, h) AS (SELECT id, 0 FROM t UNION ALL SELECT t.parent, up.h + 1 FROM up JOIN t ON t.id = up.id WHERE t.parent IS NOT NULL) SELECT id, max(h) AS height FROM up GROUP BY id""")
def kml_tree_height(spark, sf_dir):
    nodes = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "CASE WHEN s_suppkey > 0 THEN (s_suppkey - 1) div 3 END AS parent")
    return publish.tree_heights(spark, nodes)


@query(f"WITH {FOOT} SELECT id, xmin AS ul_lon, ymax AS ul_lat, xmax AS lr_lon, ymin AS lr_lat FROM foot")
def metadata_bounds(spark, sf_dir):
    one = lambda name, c: F.concat(F.lit(f"OBJECT = {name}BOUNDINGCOORDINATE\n  NUM_VAL = 1\n  VALUE = "), F.col(c).cast("string"), F.lit("\nEND_OBJECT\n"))
    core = F.concat(one("WEST", "xmin"), one("NORTH", "ymax"), one("EAST", "xmax"), one("SOUTH", "ymin"))
    texts = foot(spark, sf_dir).select("id", F.when(F.col("id") % 2 == 0, core).alias("archive"), core.alias("core"))
    return markup.bounds(texts, ["archive", "core"]).select("id", "ul_lon", "ul_lat", "lr_lon", "lr_lat")


@query(f"WITH {FOOT} SELECT id, CAST(512 + id % 100 AS INTEGER) AS x, CAST(256 AS INTEGER) AS y, xmin AS xo, ymax AS yo, 0.01::DOUBLE AS xd, -0.01::DOUBLE AS yd, CAST(CASE WHEN id % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS nbands, 'Byte' AS type, id % 2 = 0 AS has_alpha, id % 3 = 0 AND id % 2 <> 0 AS has_mask, id % 5 <> 0 AS is_wgs84 FROM foot")
def raster_metadata(spark, sf_dir):
    srs = F.when(F.col("id") % 5 != 0, 'GEOGCS["WGS 84"]\n').otherwise('PROJCS["UTM"]\n')
    alpha = F.when(F.col("id") % 2 == 0, "Band 2 Block=64x64 Type=Byte, ColorInterp=Alpha\n  Mask Flags: PER_DATASET ALPHA\n").otherwise("")
    mask = F.when((F.col("id") % 3 == 0) & (F.col("id") % 2 != 0), "  Mask Flags: PER_DATASET\n").otherwise("")
    info = F.concat(F.lit("Size is "), (512 + F.col("id") % 100).cast("string"), F.lit(", 256\n"), srs, F.lit("Origin = ("), F.col("xmin").cast("string"), F.lit(", "), F.col("ymax").cast("string"), F.lit(")\nPixel Size = (0.01, -0.01)\nBand 1 Block=64x64 Type=Byte, ColorInterp=Gray\n"), mask, alpha)
    out = markup.raster_info(foot(spark, sf_dir).select("id", info.alias("info")), "info")
    return out.select("id", "x", "y", "xo", "yo", "xd", "yd", "nbands", "type", "has_alpha", "has_mask", "is_wgs84")


@query("SELECT event_type AS ds, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, round(min(value), 6) AS vmin, round(max(value), 6) AS vmax FROM events GROUP BY 1, 2")
def streaming_daily(spark, sf_dir):
    return incremental.replay_daily(spark, f"{sf_dir}/events.parquet").withColumn("day", F.col("day").cast("string"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 100 > 0 THEN epoch(o_orderdate) + 3600.0 * 100 / (o_orderkey % 100) END AS ends FROM orders")
def progress_end(spark, sf_dir):
    """An hour after the start, with so many of a hundred parts done."""
    orders = table(spark, sf_dir, "orders")
    started = F.unix_timestamp("o_orderdate").cast("double")
    return orders.select(F.col("o_orderkey").alias("id"), publish.progress(F.col("o_orderkey") % 100, F.lit(100), started, started + 3600).alias("ends"))


_DAILY = "SELECT event_type AS ds, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, round(sum(value), 4) AS total FROM events"


@query(f"""WITH old AS ({_DAILY} WHERE event_id % 3 > 0 GROUP BY 1, 2), new AS ({_DAILY} GROUP BY 1, 2)
SELECT 'before' AS state, * FROM old UNION ALL SELECT 'during', * FROM old UNION ALL SELECT 'after', * FROM new UNION ALL SELECT 'rolled back', * FROM old""")
def reprocess_states(spark, sf_dir):
    """The daily sums that readers see before a full reprocess, while one is killed half-way, after one, and rolled back."""
    events = table(spark, sf_dir, "events")

    def daily(rows):
        return rows.groupBy(F.col("event_type").alias("ds"), F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))

    def killed(rows):
        done = daily(rows)
        return done.withColumn("total", F.when(F.col("day") > "2000", F.raise_error(F.lit("killed")).cast("double")).otherwise(F.col("total")))

    store = versions.Store(spark, f"{shared_base(spark)}/store-{uuid.uuid4().hex}", daily(events).schema)
    store.rebuild({"first": lambda: events.where("event_id % 3 = 1"), "second": lambda: events.where("event_id % 3 = 2")}, daily)
    states = [store.read().withColumn("state", F.lit("before"))]
    every = {f"part{k}": (lambda k=k: events.where(f"event_id % 3 = {k}")) for k in range(3)}
    try:
        store.rebuild(every, killed)
    except Exception as e:  # what a lost driver would leave behind
        if "killed" not in str(e):
            raise
    states.append(store.read().withColumn("state", F.lit("during")))
    store.rebuild(every, daily)
    states.append(store.read().withColumn("state", F.lit("after")))
    store.roll_back(1)
    states.append(store.read().withColumn("state", F.lit("rolled back")))
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out
