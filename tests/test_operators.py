"""Operators on small grids, with results worked out by hand or by brute force."""

import bz2
import gzip
import io
import tarfile
import zipfile

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terraloom.functions import geo, scalar
from terraloom.operators import algebra, catalog, destripe, focal, radiometry, resample, spatial
from terraloom.sources import archives, markup, swath
from terraloom.streaming import incremental


def grid(spark, a):
    return spark.createDataFrame([(i, j, float(v) if v is not None else None) for i, row in enumerate(a) for j, v in enumerate(row)], "l long, s long, v double")


def back(df, value, shape):
    out = np.full(shape, np.nan, object)
    for r in df.collect():
        out[r["l"], r["s"]] = r[value]
    return out


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "line, want",
    [
        ("get /a/AB1234567820101231x", 20101231),
        ("get /a/AST_L1A_003_0101201012345 6_02032011", None),
        ("get /a/AST_L1B_00302282010", 20100228),
        ("get /a/M.A2008060.x", 20080229),
        ("get /a/flood_Mar07.shp", 20100307),
        ("get /a/x.2009001.terra.1km", 20090101),
        ("get /a/EO1A1234562010365", 20101231),
        ("get =LT51234562012366xx", 20121231),
        ("get /a/nothing", None),
    ],
)
def test_dates(spark, line, want):
    assert one(spark, scalar.date_of_name(F.lit(line), 2010)) == want


def test_dates_roll_over(spark):
    assert one(spark, scalar.date_of_name(F.lit("/a/AB1234567820100231"), 2010)) == 20100303


def test_urls(spark):
    u = F.lit("http://me@h.org:8080/p/q.html?a=1#f")
    assert [one(spark, f(u)) for f in (scalar.url_host, scalar.url_path, scalar.url_query, scalar.url_hash, scalar.url_proto)] == ["h.org", "/p/q.html", "?a=1", "#f", "http"]
    assert one(spark, scalar.url_path(F.lit("http://host"))) == "/host"
    assert one(spark, scalar.form_encode(F.lit("a b(c)_~*\n"))) == "a+b(c)%5f%7e*"


def test_convert_type(spark):
    assert one(spark, scalar.convert_type(F.lit(-2.5), "int16", "int16")) == -3.0
    assert one(spark, scalar.convert_type(F.lit(300.0), "uint8", "uint8")) == 255.0


def test_collar_keeps_inner_dark_pixels(spark):
    a = [[0, 0, 0, 0], [0, 9, 0, 9], [0, 9, 9, 9], [0, 9, 9, 9]]
    out = back(focal.collar(grid(spark, a), F.col("v") > 0), "valid", (4, 4))
    assert not out[0].any() and not out[:, 0].any() and not out[1, 2] and out[2, 2]


def test_hole_takes_the_lower_median(spark):
    a = [[1, 2, 3], [4, -1, 5], [6, 7, 8]]
    assert back(focal.fill_holes(grid(spark, a), -1.0), "out", (3, 3))[1, 1] == 4.0
    a[0][1] = -1
    assert back(focal.fill_holes(grid(spark, a), -1.0), "out", (3, 3))[1, 1] == -1.0


def test_nodata_by_inverse_distance(spark):
    out = back(focal.fill_nodata(grid(spark, [[1, None, None, 4]])), "out", (1, 4))
    assert out[0, 1] == pytest.approx((1 / 1 + 4 / 2) / (1 + 1 / 2))


def test_flat_ground_has_even_shade(spark):
    out = back(focal.hillshade(grid(spark, np.ones((3, 3)))), "shade", (3, 3))
    assert out[1, 1] == pytest.approx(1 + 254 * np.sin(np.pi / 4)) and out[0, 0] is None


def test_contour_cell(spark):
    rows = focal.contour_cells(grid(spark, [[0, 10], [0, 10]]), 5.0).collect()
    assert len(rows) == 1 and rows[0]["kind"] == 6 and rows[0]["top"] == rows[0]["bottom"] == 0.5 and rows[0]["left"] is None


def test_contour_segments(spark):
    cells = focal.contour_cells(grid(spark, [[0, 10, 0], [10, 0, 0]]), 5.0)
    lines = {frozenset([(r["l0"], r["s0"]), (r["l1"], r["s1"])]) for r in focal.contour_segments(cells).collect()}
    assert lines == {frozenset(x) for x in ([(0, 0.5), (0.5, 1)], [(1, 0.5), (0.5, 0)], [(0, 1.5), (0.5, 1)])}


def test_closing_fills_a_bay_and_keeps_the_rest(spark):
    a = np.zeros((7, 7))
    a[2:5, 2:5] = 1
    a[3, 4] = 0
    out = back(focal.closing(grid(spark, a), "v", [1]), "v", (7, 7))
    assert out[3, 4] == 1 and out.sum() == 9


@given(st.floats(0, 1))
@settings(max_examples=20, deadline=None)
def test_kernel_rows_sum_to_one(spark, x):
    for kind in ("bi", "cc"):
        assert sum(one(spark, w) for w in resample.kernel_weights(F.lit(x), kind).values()) == pytest.approx(1)


def test_identity_warp_gives_the_input_back(spark):
    a = np.arange(25.0).reshape(5, 5)
    px = grid(spark, a).withColumns({"ol": F.col("l").cast("double"), "os": F.col("s").cast("double")})
    for kind in ("nn", "bi"):
        out = resample.swath_to_grid(px, kind, 5, 5, -1.0).withColumnsRenamed({"outl": "l", "outs": "s"})
        got = back(out, "v", (5, 5))
        assert np.allclose(got[:4, :4].astype(float), a[:4, :4])


def test_pixel_and_back(spark):
    g = geo.Grid(-180.0, 90.0, 0.25)
    assert one(spark, g.y(g.line(F.lit(12.3)))) == pytest.approx(12.3)
    assert one(spark, geo.mercator_lat(geo.mercator_y(F.lit(45.6)))) == pytest.approx(45.6)
    x, y = geo.mollweide(F.lit(0.0), F.lit(90.0))
    assert one(spark, y) == pytest.approx(geo.EARTH * np.sqrt(2), rel=1e-3)


def test_pyramid_levels():
    assert resample.levels(64, 64) == [] and resample.levels(129, 400) == [2] and resample.levels(1000, 600) == [2, 4, 8]


def test_tiles_overlap(spark):
    rows = resample.tiles(grid(spark, np.zeros((5, 1))), 4).collect()
    assert sorted((r["l"], r["tl"]) for r in rows) == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 0), (4, 1)]


def test_median_counts_invalid_pixels(spark):
    px = spark.createDataFrame([(v,) for v in (-1, -1, 5, 6, 7, 8)], "v long")
    assert destripe.histogram_median(px).first()["median"] == 7


def test_destripe_matches_the_reference(spark):
    rng = np.random.default_rng(0)
    rows = [(scan, d, s, int(v)) for scan in range(40) for d in range(2) for s, v in enumerate(rng.integers(100, 200, 50) + 30 * d)]
    px = spark.createDataFrame(rows, "scan long, det long, s long, v long")
    out = destripe.destripe(px, 0).groupBy("det").agg(F.avg("out").alias("m")).collect()
    assert abs(out[0]["m"] - out[1]["m"]) < 1.5


def test_all_detectors_bad_changes_nothing(spark):
    px = spark.createDataFrame([(0, 0, 0, 5), (0, 1, 0, 6)], "scan long, det long, s long, v long")
    assert destripe.replace_bad(px, [0, 1], 2).count() == destripe.replace_bad(px, [], 2).count() == 2
    assert {r["v"] for r in destripe.replace_bad(px, [1], 2).collect()} == {5}


def test_low_sun_is_fill(spark):
    px = spark.createDataFrame([(500.0, 87.0, 10.0, 0.0, 0.0), (500.0, 30.0, 10.0, 0.0, 0.0)], "dn double, solz double, senz double, phi double, height double")
    a, b = radiometry.corrected(px, 1, 0.0, 0.0005).orderBy(F.desc("solz")).collect()
    assert a["stored"] == -32768 and a["refl"] is None and 0 < b["refl"] < 1.6 and b["toa"] > 0 and b["stored"] == int(b["refl"] / 1e-4 + 0.5)


def test_lookup_ends_and_nulls(spark):
    points = [(0, 10), (10, 20), (10, 50)]
    assert [one(spark, algebra.lookup(F.lit(v), points)) for v in (-1.0, 5.0, 11.0)] == [10.0, 15.0, 50.0]
    assert one(spark, algebra.lookup(F.lit(None).cast("double"), points)) is None


def test_upsert_is_idempotent(spark):
    a = spark.createDataFrame([("x", 1, 1), ("y", 1, 2)], "dsname string, ts int, lid int")
    b = spark.createDataFrame([("x", 1, 9)], "dsname string, ts int, lid int")
    once = catalog.upsert(a, b, ["dsname", "ts"], "lid")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, catalog.upsert(once, b, ["dsname", "ts"], "lid").collect())) == [("x", 1, 9), ("y", 1, 2)]


def test_box_join_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    mk = lambda n: [(i, *(lo := rng.uniform(-30, 30, 2)).tolist(), *(lo + rng.uniform(0, 12, 2)).tolist()) for i in range(n)]
    a, b = mk(60), mk(50)
    left = spark.createDataFrame(a, "id int, x0 double, y0 double, x1 double, y1 double")
    right = spark.createDataFrame(b, "rid int, u0 double, v0 double, u1 double, v1 double")
    got = sorted(map(tuple, spatial.box_join(left, right, ("x0", "y0", "x1", "y1"), ("u0", "v0", "u1", "v1"), 4.0, 0.5).select("id", "rid").collect()))
    want = sorted((p[0], q[0]) for p in a for q in b if p[1] <= q[3] + 0.5 and p[3] >= q[1] - 0.5 and p[2] <= q[4] + 0.5 and p[4] >= q[2] - 0.5)
    assert got == want


def test_difference_with_an_empty_table_keeps_all(spark):
    a = spark.createDataFrame([(1, 2)], "i long, j long")
    assert spatial.difference(a, a.limit(0)).count() == 1


def test_rings():
    square = [{"x": x, "y": y} for x, y in ((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))]
    move = lambda r, d: [{"x": p["x"] + d, "y": p["y"]} for p in r]
    assert spatial.rings_meet(square, move(square, 2)) and not spatial.rings_meet(square, move(square, 2.1))
    inner = [{"x": 1 + p["x"] / 10, "y": 1 + p["y"] / 10} for p in square]
    assert spatial.rings_meet(square, inner) and spatial.rings_meet(inner, square)


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x_B1.TIF", b"1")
        z.writestr("x_b2.tif", b"2")
        z.writestr("x.jpg", b"3")
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("y_b1.png")
        info.size = 1
        t.addfile(info, io.BytesIO(b"4"))
    (tmp_path / "c.txt.gz").write_bytes(gzip.compress(b"5"))
    (tmp_path / "d.txt.bz2").write_bytes(bz2.compress(b"6"))
    (tmp_path / "e.zip").write_bytes(b"broken")
    found = archives.members(archives.files(spark, str(tmp_path))).cache()
    assert found.where("error is not null").count() == 1
    assert {bytes(r["bytes"]) for r in found.where("error is null").collect()} == {b"1", b"2", b"3", b"4", b"5", b"6"}
    assert {r["member"] for r in archives.pick(found).collect()} == {"x_B1.TIF", "x_b2.tif", "y_b1.png"}
    rows = archives.bands(found, ["_b1", "_b2"]).collect()
    assert len(rows) == 1 and (rows[0]["b1"], rows[0]["b2"]) == ("x_B1.TIF", "x_b2.tif")


def test_swath_source_and_tiles(spark, tmp_path):
    path = str(tmp_path / "g.swath")
    a = np.arange(20 * 6, dtype="<i2").reshape(20, 6)
    swath.write_swath(path, {"refl": (a, {"ires": 1, "fill": 0, "scale": 0.5, "offset": 1.0}), "other": (a.astype("u1"), {"ires": 1})})
    spark.dataSource.register(swath.SwathSource)
    px = spark.read.format("swath").option("sds", "refl").load(path)
    assert px.count() == 120 and px.rdd.getNumPartitions() == 2
    first = {(r["line"], r["sample"]): r["v"] for r in px.collect()}
    assert first[0, 0] is None and first[3, 2] == (20 - 1) * 0.5
    assert swath.catalog(spark, [path]).count() == 2
    g = grid(spark, a.astype(float))
    tiles = swath.to_tiles(g, 8)
    assert sorted(map(tuple, swath.from_tiles(tiles).collect())) == sorted(map(tuple, g.collect()))
    blob = bytes(swath.tile_files(tiles, 10.0, 50.0, 0.5, "int16").where("tile_l = 0").first()["bytes"])
    assert blob[:4] == b"II*\0" and np.frombuffer(blob[-8 * 6 * 2 :], "<i2").tolist() == a[:8].ravel().tolist()
    raw = {r["l"]: bytes(r["bytes"]) for r in swath.raw_lines(g, "int16", True).collect()}
    assert raw[1] == a[1].astype(">i2").tobytes()


def test_detector_config(spark, tmp_path):
    (tmp_path / "c.csv").write_text("# band, ref, flags\n5, 3, 0,1,0\n7, 1, 1,0,1\n")
    rows = swath.detector_config(spark, str(tmp_path / "c.csv")).orderBy("band").collect()
    assert [(r["band"], r["reference"], r["bad"]) for r in rows] == [(5, 3, [1]), (7, 1, [0, 2])]


def test_metadata_dump_and_bounds(spark):
    df = spark.createDataFrame([({"CoreMetadata.1": "b", "coremetadata.0": "a", "x": "c"},)], "attrs map<string,string>")
    assert set(markup.metadata_dump(df, "attrs").first()["dump"].split("\n")) == {"a", "b"}


def test_stream_equals_batch_and_replays(spark, tmp_path):
    import datetime as dt

    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i), "ab"[i % 2], float(i)) for i in range(20)]
    src = str(tmp_path / "in")
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string, value double")
    df.where("event_id < 10").coalesce(1).write.parquet(src)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: incremental.ingest(incremental.daily(incremental.arrivals(spark, src, df.schema), "30 days"), out, state)
    run()
    df.where("event_id >= 10").coalesce(1).write.mode("append").parquet(src)
    run()
    run()
    got = incremental.latest_of(spark.read.parquet(out), ["ds", "day"]).agg(F.sum("n")).first()[0]
    assert got == 20


def test_job_configuration(monkeypatch):
    from terraloom.sources.config import ResampleJob

    monkeypatch.setenv("DATA", "/d")
    text = 'input_filename = "$(DATA)/a.swath" # remark\nOUTPUT_FILENAME=o\nGEOLOCATION_FILENAME=g\nOUTPUT_PROJECTION_NUMBER = sNsoid\nKERNEL_TYPE = bi\nINPUT_SDS_NAME = A,0,1; B\nOUTPUT_PIXEL_SIZE = 500'
    job = ResampleJob.parse(text)
    assert (job.input, job.projection, job.kernel, job.sds, job.pixel) == ("/d/a.swath", 16, "BI", ("A,0,1", "B"), 500.0)
    for bad in ("OUTPUT_PROJECTION_NUMBER = GEO", "KERNEL_TYPE = XX", "OUTPUT_DATA_TYPE = INT64", "INPUT_FILENAME = "):
        with pytest.raises(ValueError):
            ResampleJob.parse(text + "\n" + bad)


def test_relief_hides_the_sea(spark):
    from terraloom.operators import products

    out = {(r["l"], r["s"]): r for r in products.relief(grid(spark, [[-5, 10, 20], [-9999, 10, 20], [0, 10, 20]]), [(0, 0, 0, 0.0), (200, 100, 50, 20.0)], 0.01).collect()}
    assert out[0, 0]["a"] == out[1, 0]["a"] == out[2, 0]["a"] == 0 and out[1, 2]["a"] == 255 and out[0, 1]["r"] == 100


def test_overrides(spark):
    from terraloom.operators import products

    products.register_overrides(spark, {"twice": (_twice, "double")})
    assert spark.sql("SELECT twice(CAST(4 AS DOUBLE)) AS x").first()["x"] == 8.0


def _twice(v: pd.Series) -> pd.Series:
    return v * 2


def test_projections_at_known_points(spark):
    lon, lat = F.lit(-96.0), F.lit(40.0)
    pair = lambda p: tuple(one(spark, c) for c in p)
    assert pair(geo.albers(lon, lat, 29.5, 45.5, -96.0, 40.0)) == pytest.approx((0, 0), abs=1e-6)
    assert pair(geo.lambert_conformal(lon, lat, 33.0, 45.0, -96.0, 40.0)) == pytest.approx((0, 0), abs=1e-6)
    assert pair(geo.lambert_azimuthal(lon, lat, -96.0, 40.0)) == pytest.approx((0, 0), abs=1e-6)
    assert pair(geo.transverse_mercator(lon, lat, -96.0)) == pytest.approx((0, geo.EARTH * np.radians(40)))
    assert pair(geo.polar_stereographic(lon, F.lit(90.0))) == pytest.approx((0, 0), abs=1e-6)
    x, y = pair(geo.hammer(F.lit(180.0), F.lit(0.0)))
    assert x == pytest.approx(2 * np.sqrt(2) * geo.EARTH) and y == pytest.approx(0, abs=1e-6)
    assert one(spark, geo.equirectangular_x(F.lit(10.0), 10.0)) == 0


def test_small_helpers(spark):
    from terraloom.operators import publish

    assert one(spark, publish.progress(F.lit(5.0), F.lit(10.0), F.lit(100.0), F.lit(150.0))) == 200.0
    assert one(spark, publish.progress(F.lit(0.0), F.lit(10.0), F.lit(100.0), F.lit(150.0))) is None
    kml = spark.createDataFrame([("<kml><NetworkLink><Link><href>a.kml</href></Link></NetworkLink><NetworkLink><href>b.kml</href></NetworkLink></kml>",)], "xml string")
    assert [r["href"] for r in markup.links(kml, "xml").collect()] == ["a.kml", "b.kml"]
    assert one(spark, resample.overview_scale(F.lit(2.0), F.lit(1.0))) == 72 * 4374754 + 150000
    px = grid(spark, np.zeros((2, 2)))
    assert publish.top_text(px.withColumn("line", F.concat_ws(",", "l", "s")), ["l", "s"], "line").first()["text"] == "0,0\n0,1\n1,0\n1,1"
    assert sorted(r["n"] for r in publish.running(px, "s", "l").collect()) == [1, 1, 2, 2]


def test_granule_over_the_dateline(spark):
    g = spark.createDataFrame([(170.0, 10.0, -170.0, 10.0, 171.0, 0.0, -171.0, 0.0)], "ulx double, uly double, urx double, ury double, llx double, lly double, lrx double, lry double")
    r = resample.unwrap_corners(g).first()
    assert (r["ulx"], r["urx"], r["cx"], r["cy"]) == (-190.0, -170.0, 180.0 - 360.0, 5.0)
