"""Queries of configuration texts, headers and georeferenced files."""

from __future__ import annotations


from pyspark.sql import functions as F

from terraloom.operators import emitters
from terraloom.sources import swath

from .registry import query
from .views import LAY, PX1, lay, px1, table

_FOLDER, _NL = "/data/maps", "chr(10)"
_CLASSES = """cls AS (SELECT n_regionkey AS grp, string_agg('    CLASS' || chr(10) || '      NAME ''' || n_name || '''' || chr(10) || '      EXPRESSION ([height] <= ' || n_nationkey || ' )' || chr(10) || '      STYLE' || chr(10)
|| '        COLOR ' || n_nationkey * 7 % 256 || ' ' || n_nationkey * 11 % 256 || ' ' || n_nationkey * 13 % 256 || chr(10) || '        WIDTH 2' || chr(10) || '      END' || chr(10) || '    END', chr(10) ORDER BY n_nationkey) AS body FROM nation GROUP BY 1)"""


def _layer_sql(kind, suffix, index, scale, classes):
    raster = kind == "RASTER"
    name = f"dsname || '_' || alias || '{suffix}'"
    lines = [
        "'  LAYER'", f"'    NAME ''' || {name} || ''''", f"'    TYPE {kind}'", "'    STATUS ON'", *(["'    DUMP TRUE'"] if raster else []), "'    METADATA'", f"'      ''wms_title'' ''' || {name} || ''''",
        "'      ''wms_srs'' ''EPSG:4326 EPSG:3857'''", "'      ''wms_extent'' ''' || format('{:.6f} {:.6f} {:.6f} {:.6f}', w, s, e, n) || ''''", "'      ''ows_enable_request'' ''*'''", "'    END'",
        f"'    TILEINDEX ''{_FOLDER}/{index}' || dsname || ts || '.shp'''", "'    GROUP ''' || dsname || '_' || alias || ''''", *([f"'    {scale} ' || format('{{:.0f}}', scale)"] if scale else []),
        *(["'    PROCESSING \"OVERSAMPLE_RATIO=3\"'", "'    PROCESSING \"RESAMPLE=AVERAGE\"'"] if raster else []), *(["'    CLASSITEM ''height''' || chr(10) || body"] if classes else []), "'  END'",
    ]
    return " || chr(10) || ".join(lines)


_RANKED = f"""{LAY}, r AS (SELECT *, row_number() OVER (PARTITION BY dsname ORDER BY ts DESC, lid DESC) AS k FROM lay),
al AS (SELECT *, CAST(ts AS VARCHAR) AS alias FROM r UNION ALL SELECT *, CASE k WHEN 1 THEN 'latest' ELSE 'previous' END FROM r WHERE k <= 2)"""


@query(f"""WITH {_RANKED}, {_CLASSES}, a AS (SELECT al.*, lid % 3 = 1 AS vec, CASE WHEN lid % 4 > 0 THEN 150000.0::DOUBLE + lid * 10 END AS scale, body FROM al JOIN cls ON grp = lid % 5)
SELECT lid, alias, CASE WHEN scale IS NOT NULL THEN CASE WHEN vec THEN {_layer_sql("POLYGON", "_hires", "", "MAXSCALEDENOM", True)} ELSE {_layer_sql("RASTER", "_hires", "", "MAXSCALEDENOM", False)} END
|| chr(10) || chr(10) || {_layer_sql("RASTER", "_ovr", "overview_", "MINSCALEDENOM", False)} WHEN vec THEN {_layer_sql("POLYGON", "", "", None, True)} ELSE {_layer_sql("RASTER", "", "", None, False)} END AS text FROM a""")
def map_files(spark, sf_dir):
    """The map file of every layer and alias: pairs split at a scale, classes of vector layers by threshold."""
    nation = table(spark, sf_dir, "nation").selectExpr("n_regionkey AS grp", "n_nationkey AS pos", "n_nationkey AS value", "n_nationkey * 7 % 256 AS r", "n_nationkey * 11 % 256 AS g", "n_nationkey * 13 % 256 AS b", "n_name AS label")
    classes = emitters.vector_classes(nation, "height", True, "grp")
    layers = lay(spark, sf_dir).withColumns({"vec": F.col("lid") % 3 == 1, "scale": F.when(F.col("lid") % 4 > 0, 150000.0 + F.col("lid") * 10), "grp": F.col("lid") % 5})
    rows = emitters.with_aliases(layers).join(F.broadcast(classes), "grp")  # a class list for each of a few fields
    return emitters.map_texts(rows, _FOLDER, "scale", "vec", "classes").select("lid", "alias", "text")


@query("""WITH m AS (SELECT o_orderkey AS lid, 'MAP' || chr(10) || CASE WHEN o_orderkey % 3 = 0 THEN '  INCLUDE ''/m/' || o_orderkey || '.map''' || chr(10) ELSE '' END || '  LAYER' || chr(10) || '  END' || chr(10) || CASE WHEN o_orderkey % 7 = 0 THEN '# END of it' ELSE 'END' || CASE WHEN o_orderkey % 2 = 0 THEN chr(10) ELSE '' END END AS text, '/m/' || o_orderkey || '.map' AS path FROM orders)
SELECT lid, CASE WHEN contains(text, path) THEN text WHEN lid % 7 = 0 THEN replace(text, '  END' || chr(10) || '#', '  INCLUDE ''' || path || '''' || chr(10) || '  END' || chr(10) || '#') ELSE regexp_replace(text, '\\nEND(\\n?)$', chr(10) || '  INCLUDE ''' || path || '''' || chr(10) || 'END\\1') END AS text FROM m""")
def map_includes(spark, sf_dir):
    """An include before the last END of each map file that does not have it."""
    o, n = F.col("o_orderkey"), F.lit("\n")
    path = F.concat(F.lit("/m/"), o.cast("string"), F.lit(".map"))
    there = F.when(o % 3 == 0, F.concat(F.lit("  INCLUDE '"), path, F.lit("'\n"))).otherwise("")
    end = F.when(o % 7 == 0, "# END of it").otherwise(F.concat(F.lit("END"), F.when(o % 2 == 0, n).otherwise("")))
    m = table(spark, sf_dir, "orders").select(o.alias("lid"), F.concat(F.lit("MAP\n"), there, F.lit("  LAYER\n  END\n"), end).alias("text"), path.alias("path"))
    return m.select("lid", emitters.included("text", "path").alias("text"))


@query(f"""WITH {LAY}, x AS (SELECT *, 6378137.0::DOUBLE * radians(w) AS mw, 6378137.0::DOUBLE * radians(e) AS me, dsname || '_' || ts AS l FROM lay)
SELECT lid, replace('[p_' || l || ']|type=WMS|url=http://x/cgi?|layers=' || l || '|extension=png|tms_type=google|levels=24|spherical_mercator=true', '|', chr(10)) AS head, CASE WHEN n < 86 AND s > -86 THEN round(mw, 3) END AS west, CASE WHEN n < 86 AND s > -86 THEN round(me, 3) END AS east,
replace('[p_' || l || '_4326]|type=WMS|url=http://x/cgi?|layers=' || l || '|extension=png|levels=24', '|', chr(10)) AS tail FROM x""")
def tile_cache_sections(spark, sf_dir):
    """The sections of each layer; boxes are taken apart, since their last digits hang on the logarithm used."""
    s = emitters.tile_cache(lay(spark, sf_dir), "p", "http://x/cgi")
    parts = F.split("section", "\n\n")
    head, box = F.regexp_replace(parts[0], r"\n#bbox=.*", ""), F.regexp_extract(parts[0], r"#bbox=([-0-9.]+),[-0-9.]+,([-0-9.]+),", 0)
    edge = lambda k: F.when(box != "", F.round(F.regexp_extract(parts[0], r"#bbox=([-0-9.]+),[-0-9.]+,([-0-9.]+),", k).cast("double"), 3))
    return s.select("lid", head.alias("head"), edge(1).alias("west"), edge(2).alias("east"), parts[1].alias("tail"))


_KINDS = ["ALBERS_EQUAL_AREA", "UTM", "GEOGRAPHIC", "SINUSOIDAL"]


def _number(x):
    return f"lpad(format('{{:.9f}}', {x}::DOUBLE), 24, ' ')"


@query(f"""WITH {LAY}, h AS (SELECT *, [{", ".join(f"'{k}'" for k in _KINDS)}][lid % 4 + 1] AS proj, CASE WHEN lid % 3 = 0 THEN NULL WHEN lid % 3 = 1 THEN 'WGS 84' ELSE 'Clarke 1866' END AS ell FROM lay)
SELECT lid, chr(10) || 'PROJECTION_TYPE = ' || proj || CASE WHEN proj = 'UTM' THEN chr(10) || chr(10) || 'UTM_ZONE = ' || (lid % 60 + 1) ELSE '' END || chr(10) || chr(10) || 'PROJECTION_PARAMETERS = (' || chr(10)
|| {" || chr(10) || ".join(" || ".join(_number(f"(lid % 100 + {k + j})") for j in range(1, 4)) for k in range(0, 15, 3))} || ' )' || chr(10) || chr(10)
|| format('UL_CORNER_LATLON = ( {{:.9f}} {{:.9f}} )', n, w) || chr(10) || format('UR_CORNER_LATLON = ( {{:.9f}} {{:.9f}} )', n, e) || chr(10) || format('LL_CORNER_LATLON = ( {{:.9f}} {{:.9f}} )', s, w) || chr(10) || format('LR_CORNER_LATLON = ( {{:.9f}} {{:.9f}} )', s, e) || chr(10) || chr(10)
|| format('# UL_CORNER_XY = ( {{:.9f}} {{:.9f}} )', w * 1000, n * 1000) || chr(10) || format('# UR_CORNER_XY = ( {{:.9f}} {{:.9f}} )', e * 1000, n * 1000) || chr(10) || format('# LL_CORNER_XY = ( {{:.9f}} {{:.9f}} )', w * 1000, s * 1000) || chr(10) || format('# LR_CORNER_XY = ( {{:.9f}} {{:.9f}} )', e * 1000, s * 1000) || chr(10) || chr(10)
|| 'NBANDS = 1' || chr(10) || 'BANDNAMES = ( ' || dsname || ' )' || chr(10) || 'DATA_TYPE = ( INT16 )' || chr(10) || 'NLINES = ( ' || lid % 500 || ' )' || chr(10) || 'NSAMPLES = ( 1354 )' || chr(10) || 'PIXEL_SIZE = ( 500.250000000000 )' || chr(10) || 'BACKGROUND_FILL = ( -1.000000 )' || chr(10) || chr(10)
|| 'ELLIPSOID_CODE = ' || coalesce(ell, 'No Ellipsoid') || chr(10) || chr(10) || 'DATUM = ' || CASE WHEN ell = 'WGS 84' AND proj <> 'SINUSOIDAL' THEN 'WGS84' ELSE 'No Datum' END || chr(10) || 'BYTE_ORDER = ' || CASE WHEN lid % 2 = 0 THEN 'big_endian' ELSE 'little_endian' END AS header FROM h""")
def raster_headers(spark, sf_dir):
    """The whole text header of a raster for each layer."""
    lid = F.col("lid")
    h = lay(spark, sf_dir).withColumns({
        "projection": F.element_at(F.array(*map(F.lit, _KINDS)), (lid % 4 + 1).cast("int")), "zone": lid % 60 + 1, "parameters": F.array(*[(lid % 100 + k).cast("double") for k in range(1, 16)]),
        "ul_lat": F.col("n"), "ul_lon": F.col("w"), "lr_lat": F.col("s"), "lr_lon": F.col("e"), "ulx": F.col("w") * 1000, "uly": F.col("n") * 1000, "lrx": F.col("e") * 1000, "lry": F.col("s") * 1000,
        "band": F.col("dsname"), "type": F.lit("INT16"), "lines": lid % 500, "samples": F.lit(1354), "pixel": F.lit(500.25), "fill": F.lit(-1.0),
        "ellipsoid": F.when(lid % 3 == 1, "WGS 84").when(lid % 3 == 2, "Clarke 1866"), "big_endian": lid % 2 == 0,
    })
    return emitters.raster_header(h).select("lid", "header")


_PARAMETERS = [6378137.0, 0.0, 29.5, 45.5, -96.0, 23.0, 1000.0, -500.0]
_GEO = [("ALBERS_EQUAL_AREA", _PARAMETERS, 0, True), ("UTM", [], -33, True), ("GEOGRAPHIC", [], 0, True), ("SINUSOIDAL", _PARAMETERS, 0, False), ("POLAR_STEREOGRAPHIC", _PARAMETERS, 0, True)]
_EXPECTED = {
    "ALBERS_EQUAL_AREA": {1024: 1, 2048: 4326, 3072: 32767, 3075: 11, 3078: 29.5, 3079: 45.5, 3080: -96.0, 3081: 23.0, 3082: 1000.0, 3083: -500.0}, "UTM": {1024: 1, 2048: 4326, 3072: 32733}, "GEOGRAPHIC": {1024: 2, 2048: 4326},
    "SINUSOIDAL": {1024: 1, 2048: 32767, 2057: 6378137.0, 3072: 32767, 3075: 24, 3082: 1000.0, 3083: -500.0, 3088: -96.0}, "POLAR_STEREOGRAPHIC": {1024: 1, 2048: 4326, 3072: 32767, 3075: 15, 3081: 23.0, 3082: 1000.0, 3083: -500.0, 3095: -96.0},
}


@query(f"""WITH {PX1}, tiles AS (SELECT DISTINCT l // 16 AS tile_l, s // 16 AS tile_s FROM px1),
k AS (SELECT * FROM (VALUES {", ".join(f"('{p}', {key}, {float(v)}::DOUBLE)" for p, keys in _EXPECTED.items() for key, v in keys.items())}) t(projection, key, value)) SELECT tile_l, tile_s, projection, key, value FROM tiles, k""")
def geotiff_keys(spark, sf_dir):
    """The georeferencing of every tile, in five projections, read back from the files' bytes."""
    tiles = swath.to_tiles(px1(spark, sf_dir).select("l", "s", "v"), 16)
    held = sorted({k for keys in _EXPECTED.values() for k in keys})

    @F.pandas_udf("map<int,double>")
    def keys(blobs):
        return blobs.map(lambda b: {k: float(v) for k, v in swath.read_keys(bytes(b)).items() if k in held})

    out = None
    for name, parameters, zone, wgs84 in _GEO:
        files = swath.tile_files(tiles, 10.0, 50.0, 0.5, "int16", geo=swath.geo_keys(name, parameters, zone, wgs84))
        one = files.select("tile_l", "tile_s", F.lit(name).alias("projection"), F.explode(keys("bytes")).alias("key", "value"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"WITH {PX1} SELECT l, string_agg(format('{{:02x}}{{:02x}}', v & 255, (v >> 8) & 255), '' ORDER BY s) AS little, string_agg(format('{{:02x}}{{:02x}}', (v >> 8) & 255, v & 255), '' ORDER BY s) AS big FROM (SELECT l, s, CAST(floor(v) AS INTEGER) AS v FROM px1) GROUP BY l")
def raw_line_bytes(spark, sf_dir):
    """Each line as raw numbers of 16 bits, in both byte orders."""
    px = px1(spark, sf_dir).select("l", "s", F.floor("v").alias("v"))
    a, b = swath.raw_lines(px, "uint16"), swath.raw_lines(px, "uint16", True)
    return a.join(b.withColumnRenamed("bytes", "other"), "l").select("l", F.lower(F.hex("bytes")).alias("little"), F.lower(F.hex("other")).alias("big"))
