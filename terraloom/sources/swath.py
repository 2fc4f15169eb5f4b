"""Swath files as a Spark data source, and raster sinks.

A ``.swath`` file holds a JSON line with its datasets, then their samples one after the other. The source reads it
scan by scan: each scan of each dataset is a partition, only the datasets asked for are read, and the scan is where
the resampler's partitioning begins.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Lines of a scan at the coarsest resolution, frames of a line there (fixed values).
SCAN_LINES, FRAMES = 10, 1354
TYPES = {"int8": "i1", "uint8": "u1", "int16": "<i2", "uint16": "<u2", "int32": "<i4", "uint32": "<u4", "float32": "<f4"}
PIXELS = "granule string, sds string, ires int, scan int, line int, sample int, dn double, v double"


def write_swath(path: str, datasets: dict[str, tuple[np.ndarray, dict]]) -> None:
    """Write arrays [line, sample] with attributes (fill, scale, offset, ires); for tests and small exports."""
    head, blobs, at = [], [], 0
    for name, (a, attrs) in datasets.items():
        kind = next(k for k, v in TYPES.items() if np.dtype(v) == a.dtype)
        blob = a.astype(TYPES[kind]).tobytes()
        head.append({"sds": name, "type": kind, "lines": a.shape[0], "samples": a.shape[1], "at": at, **attrs})
        blobs.append(blob)
        at += len(blob)
    with open(path, "wb") as f:
        f.write(json.dumps(head).encode() + b"\n" + b"".join(blobs))


def read_header(path: str) -> tuple[list[dict], int]:
    with open(path, "rb") as f:
        line = f.readline()
    return json.loads(line), len(line)


class _Scan(InputPartition):
    def __init__(self, path: str, start: int, item: dict, scan: int):
        self.path, self.start, self.item, self.scan = path, start, item, scan


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options["path"].split(",") if p]
        self.wanted = {s for s in options.get("sds", "").split(",") if s}

    def partitions(self):
        out = []
        for path in self.paths:
            head, start = read_header(path)
            for item in head:
                ires = int(item.get("ires", max(1, round(item["samples"] / FRAMES))))
                if ires not in (1, 2, 4):
                    raise ValueError(f"{item['sds']}: resolution {ires}")
                per = SCAN_LINES * ires
                if item["lines"] % per:
                    raise ValueError(f"{item['sds']}: {item['lines']} lines are no whole number of scans")
                if not self.wanted or item["sds"] in self.wanted:
                    out += [_Scan(path, start, item | {"ires": ires}, k) for k in range(item["lines"] // per)]
        return out

    def read(self, partition: _Scan):
        item, per = partition.item, SCAN_LINES * partition.item["ires"]
        kind = np.dtype(TYPES[item["type"]])
        n = item["samples"]
        with open(partition.path, "rb") as f:
            f.seek(partition.start + item["at"] + partition.scan * per * n * kind.itemsize)
            data = np.frombuffer(f.read(per * n * kind.itemsize), kind).reshape(per, n)
        granule = partition.path.rsplit("/", 1)[-1]
        fill, scale, offset = item.get("fill", 0), item.get("scale", 1.0), item.get("offset", 0.0)
        for line in range(per):
            for sample in range(n):
                dn = float(data[line, sample])
                yield granule, item["sds"], item["ires"], partition.scan, partition.scan * per + line, sample, dn, None if dn == fill else (dn - offset) * scale


class SwathSource(DataSource):
    """``spark.dataSource.register(SwathSource)``, then ``spark.read.format("swath").option("sds", ...).load(path)``."""

    @classmethod
    def name(cls):
        return "swath"

    def schema(self):
        return PIXELS

    def reader(self, schema):
        return _Reader(self.options)


def catalog(spark, paths: list[str]) -> DataFrame:
    """One row for each dataset of each file: name, type, dimensions, resolution and attributes."""
    rows = [(p.rsplit("/", 1)[-1], i["sds"], i["type"], i["lines"], i["samples"], int(i.get("ires", 1)), float(i.get("fill", 0)), float(i.get("scale", 1)), float(i.get("offset", 0))) for p in paths for i in read_header(p)[0]]
    return spark.createDataFrame(rows, "granule string, sds string, type string, lines int, samples int, ires int, fill double, scale double, offset double")


# -- tiles and sinks


def to_tiles(px: DataFrame, size: int, *keys: str) -> DataFrame:
    """Pixels (l, s, v) as tiles at rest: one row for each tile, its values in row order."""
    t = px.select(*keys, F.expr(f"l div {size}").alias("tile_l"), F.expr(f"s div {size}").alias("tile_s"), "l", "s", "v")
    g = t.groupBy(*keys, "tile_l", "tile_s").agg(F.sort_array(F.collect_list(F.struct("l", "s", "v"))).alias("p"), F.min("l").alias("l0"), F.min("s").alias("s0"), (F.max("l") - F.min("l") + 1).alias("nl"), (F.max("s") - F.min("s") + 1).alias("ns"))
    return g.select(*keys, "tile_l", "tile_s", "l0", "s0", "nl", "ns", F.transform("p", lambda x: x["v"]).alias("data"))


def from_tiles(tiles: DataFrame, *keys: str) -> DataFrame:
    """Tiles without gaps as pixels again."""
    x = tiles.select(*keys, "l0", "s0", "ns", F.posexplode("data").alias("k", "v"))
    return x.select(*keys, (F.col("l0") + F.expr("k div ns")).alias("l"), (F.col("s0") + F.col("k") % F.col("ns")).alias("s"), "v")


def raw_lines(px: DataFrame, kind: str, big_endian: bool = False, *keys: str) -> DataFrame:
    """One row for each line: its samples as raw binary of the type, in sample order."""
    code = TYPES[kind].replace("<", ">") if big_endian else TYPES[kind]

    def pack(values: pd.Series) -> pd.Series:
        return values.map(lambda v: np.asarray(v, float).astype(code).tobytes())

    lines = px.groupBy(*keys, "l").agg(F.transform(F.sort_array(F.collect_list(F.struct("s", "v"))), lambda x: x["v"]).alias("values"))
    return lines.withColumn("bytes", F.pandas_udf(pack, "binary")("values")).drop("values")


#: TIFF tag types (fixed values).
_ASCII, _SHORT, _LONG, _DOUBLE = 2, 3, 4, 12


#: Keys of projected rasters by projection: the code of the transformation, and for each key the projection parameter
#: that it holds (fixed values of the format).
PROJECTED = {
    "ALBERS_EQUAL_AREA": (11, {3078: 2, 3079: 3, 3080: 4, 3081: 5, 3082: 6, 3083: 7}),
    "LAMBERT_CONFORMAL_CONIC": (8, {3078: 2, 3079: 3, 3080: 4, 3081: 5, 3082: 6, 3083: 7}),
    "LAMBERT_AZIMUTHAL": (10, {3088: 4, 3089: 5, 3082: 6, 3083: 7}),
    "EQUIRECTANGULAR": (17, {3080: 4, 3081: 5, 3082: 6, 3083: 7}),
    "MERCATOR": (7, {3080: 4, 3081: 5, 3082: 6, 3083: 7}),
    "POLAR_STEREOGRAPHIC": (15, {3095: 4, 3081: 5, 3082: 6, 3083: 7}),
    "SINUSOIDAL": (24, {3088: 4, 3082: 6, 3083: 7}),
    "TRANSVERSE_MERCATOR": (1, {3092: 2, 3080: 4, 3081: 5, 3082: 6, 3083: 7}),
}
#: Further keys and codes of the format (fixed values).
_MODEL, _RASTER, _CITATION, _GEOGRAPHIC, _LINEAR, _ANGULAR, _MAJOR, _MINOR, _PCS, _PROJECTION, _TRANSFORM, _UNITS = 1024, 1025, 1026, 2048, 2052, 2054, 2057, 2058, 3072, 3074, 3075, 3076
_IS_PROJECTED, _IS_GEOGRAPHIC, _POINT, _WGS84, _USER, _METRE, _DEGREE = 1, 2, 2, 4326, 32767, 9001, 9102


def geo_keys(projection: str, parameters: list[float] | None = None, zone: int = 0, wgs84: bool = True) -> tuple[list[int], list[float], str]:
    """The key directory, its doubles and its text for a projection. ``parameters`` are in degrees and metres; the
    first two are the axes, which are written where the ellipsoid is another than WGS 84's."""
    p = list(parameters or [])
    short: dict[int, int] = {_RASTER: _POINT}
    real: dict[int, float] = {}
    short[_ANGULAR], short[_GEOGRAPHIC] = _DEGREE, _WGS84 if wgs84 else _USER
    if not wgs84 and len(p) > 1:
        real |= {_MAJOR: p[0], _MINOR: p[1] or p[0]}
    if projection == "GEOGRAPHIC":
        short[_MODEL] = _IS_GEOGRAPHIC
    elif projection == "UTM":
        short |= {_MODEL: _IS_PROJECTED, _LINEAR: _METRE, _UNITS: _METRE, _PCS: (32600 if zone > 0 else 32700) + abs(zone)}
    elif projection in PROJECTED:
        code, held = PROJECTED[projection]
        short |= {_MODEL: _IS_PROJECTED, _LINEAR: _METRE, _UNITS: _METRE, _PCS: _USER, _PROJECTION: _USER, _TRANSFORM: code}
        real |= {key: p[k] for key, k in held.items()}
    else:
        raise ValueError(f"no keys for {projection}")
    text = f"{projection}|"
    doubles: list[float] = []
    rows = []
    for key in sorted({*short, *real, _CITATION}):
        if key in real:
            rows.append([key, 34736, 1, len(doubles)])
            doubles.append(float(real[key]))
        else:
            rows.append([key, 34737, len(text), 0] if key == _CITATION else [key, 0, 1, short[key]])
    return [1, 1, 0, len(rows), *(v for r in rows for v in r)], doubles, text


def geotiff(data: np.ndarray, ulx: float, uly: float, pixel: float, keys: tuple[list[int], list[float], str] | None = None) -> bytes:
    """A single-band, uncompressed little-endian GeoTIFF with one row per strip, in geographic WGS 84, or with the keys
    of another projection."""
    kinds = {"u": 1, "i": 2, "f": 3}
    data = np.ascontiguousarray(data)
    lines, samples = data.shape
    row = samples * data.itemsize
    directory_, doubles, text = keys or ([1, 1, 0, 3, 1024, 0, 1, 2, 1025, 0, 1, 1, 2048, 0, 1, 4326], [], "")
    tags: list[tuple[int, int, list]] = [
        (256, _LONG, [samples]), (257, _LONG, [lines]), (258, _SHORT, [8 * data.itemsize]), (259, _SHORT, [1]), (262, _SHORT, [1]),
        (273, _LONG, [0] * lines), (277, _SHORT, [1]), (278, _LONG, [1]), (279, _LONG, [row] * lines), (339, _SHORT, [kinds[data.dtype.kind]]),
        (33550, _DOUBLE, [pixel, pixel, 0.0]), (33922, _DOUBLE, [0.0, 0.0, 0.0, ulx, uly, 0.0]), (34735, _SHORT, directory_),
    ]
    if doubles:
        tags.append((34736, _DOUBLE, doubles))
    if text:
        tags.append((34737, _ASCII, list(text.encode("ascii")) + [0]))
    size, code = {_SHORT: 2, _LONG: 4, _DOUBLE: 8, _ASCII: 1}, {_SHORT: "H", _LONG: "I", _DOUBLE: "d", _ASCII: "B"}
    after = 8 + 2 + 12 * len(tags) + 4
    extra = sum(size[t] * len(v) for _, t, v in tags if size[t] * len(v) > 4)
    start = after + extra
    tags[5] = (273, _LONG, [start + k * row for k in range(lines)])
    directory, tail = struct.pack("<H", len(tags)), b""
    for tag, t, values in tags:
        blob = struct.pack(f"<{len(values)}{code[t]}", *values)
        if len(blob) > 4:
            directory += struct.pack("<HHII", tag, t, len(values), after + len(tail))
            tail += blob
        else:
            directory += struct.pack("<HHI", tag, t, len(values)) + blob.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", 8) + directory + struct.pack("<I", 0) + tail + data.astype(data.dtype.newbyteorder("<")).tobytes()


def read_keys(blob: bytes) -> dict[int, float | str]:
    """The geographic keys of a little-endian GeoTIFF."""
    (at,) = struct.unpack_from("<I", blob, 4)
    (n,) = struct.unpack_from("<H", blob, at)
    code, found = {_SHORT: "H", _LONG: "I", _DOUBLE: "d", _ASCII: "B"}, {}
    for k in range(n):
        tag, t, count = struct.unpack_from("<HHI", blob, at + 2 + 12 * k)
        if tag in (34735, 34736, 34737):
            form = f"<{count}{code[t]}"
            place = at + 2 + 12 * k + 8
            found[tag] = struct.unpack_from(form, blob, place if struct.calcsize(form) <= 4 else struct.unpack_from("<I", blob, place)[0])
    d, out = found[34735], {}
    for k in range(d[3]):
        key, where, count, value = d[4 + 4 * k : 8 + 4 * k]
        out[key] = value if where == 0 else found[34736][value] if where == 34736 else bytes(found[34737][value : value + count]).decode().rstrip("|\0")
    return out


def tile_files(tiles: DataFrame, ulx: float, uly: float, pixel: float, kind: str, *keys: str, geo=None) -> DataFrame:
    """Each tile as the bytes of a GeoTIFF of its own, georeferenced by its place; ``geo`` are the keys of a projection
    (``geo_keys``), else it is geographic."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [geotiff(np.asarray(d, float).reshape(nl, ns).astype(TYPES[kind]), ulx + s0 * pixel, uly - l0 * pixel, pixel, geo) for d, l0, s0, nl, ns in zip(pdf.data, pdf.l0, pdf.s0, pdf.nl, pdf.ns)]
            yield pdf[[*keys, "tile_l", "tile_s"]].assign(bytes=made)

    named = ", ".join(f"{k} {tiles.schema[k].dataType.simpleString()}" for k in (*keys, "tile_l", "tile_s"))
    return tiles.mapInPandas(run, f"{named}, bytes binary")


def detector_config(spark, path: str) -> DataFrame:
    """band, reference detector and bad detectors from a CSV of flags; every row counts, the last one too."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & F.col("value").rlike(r"^\s*\d"))
    parts = F.transform(F.split("value", ","), lambda x: F.trim(x).cast("int"))
    p = lines.select(parts.alias("p"))
    flags = F.slice("p", 3, F.size("p") - 2)
    bad = F.filter(F.transform(flags, lambda x, i: F.when(x == 1, i)), lambda x: x.isNotNull())
    return p.select(F.element_at("p", 1).alias("band"), F.element_at("p", 2).alias("reference"), bad.alias("bad"))
