"""Scientific datasets in HDF4 containers as DataFrames.

Spark lists and reads the files, from any store it knows; the tasks that hold their bytes walk the descriptor blocks
and give Arrow batches of one scan each. A file is the unit of work, so that a mission's archive is spread over as
many tasks as it has granules. Only the datasets, bands and scans asked for are decoded.

Stored as one block, in linked blocks, in chunks, and deflated or run-length coded data are read.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format: tags of elements, codes of special elements, number types.
MAGIC = b"\x0e\x03\x13\x01"
LINKED, COMPRESSED, CHUNK, NUMBER_TYPE, DIMENSIONS, DATA, GROUP, TABLE, RECORDS, VGROUP = 20, 40, 61, 106, 701, 702, 720, 1962, 1963, 1965
SPECIAL = 0x4000
IN_LINKED_BLOCKS, IN_COMPRESSION, IN_CHUNKS = 1, 3, 5
RUN_LENGTHS, DEFLATED = 1, 4
TYPES = {3: "u1", 4: "i1", 5: ">f4", 6: ">f8", 20: "i1", 21: "u1", 22: ">i2", 23: ">u2", 24: ">i4", 25: ">u4"}
NAMES = {3: "uchar8", 4: "char8", 5: "float32", 6: "float64", 20: "int8", 21: "uint8", 22: "int16", 23: "uint16", 24: "int32", 25: "uint32"}
CODES = {"float32": 5, "float64": 6, "int8": 20, "uint8": 21, "int16": 22, "uint16": 23, "int32": 24, "uint32": 25}
TEXT = (3, 4)
LITTLE = 0x4000


@dataclass(frozen=True)
class Layout:
    """What makes a dataset a swath: both of its dimensions are over ``least``, its samples are 1, 2 or 4 times
    ``frames``, and its lines a whole number of scans of ``lines`` at the coarsest resolution."""

    least: int = 250
    frames: int = 1354
    lines: int = 10


MODIS = Layout()


@dataclass
class Dataset:
    name: str
    code: int
    dims: list[int]
    dim_names: list[str]
    attrs: dict[str, tuple[int, object]]
    ref: int

    def number(self, *names: str, default: float) -> float:
        """The first value of the first attribute there is."""
        for n in names:
            if n in self.attrs and self.attrs[n][0] not in TEXT and len(self.attrs[n][1]):
                return float(self.attrs[n][1][0])
        return default


def dtype(code: int) -> np.dtype:
    kind = np.dtype(TYPES[code & 0xFF])
    return kind.newbyteorder("<") if code & LITTLE else kind


class Container:
    """The elements of a file by tag and reference."""

    def __init__(self, data: bytes):
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not an HDF4 container")
        self.data, self.at = memoryview(data), {}
        block = 4
        while block:
            n, following = struct.unpack_from(">hi", data, block)
            for tag, ref, offset, length in struct.iter_unpack(">HHii", self.data[block + 6 : block + 6 + 12 * n]):
                if tag > 1:  # 1 marks an unused descriptor
                    self.at[tag, ref] = (offset, length)
            block = following

    def refs(self, tag: int) -> list[int]:
        return [r for t, r in self.at if t == tag]

    def raw(self, tag: int, ref: int) -> memoryview:
        offset, length = self.at[tag, ref]
        return self.data[offset : offset + length] if length > 0 else self.data[:0]

    def element(self, tag: int, ref: int, shape=None, kind=None) -> bytes | np.ndarray:
        """The bytes of an element, whatever way they are stored; chunked ones need the shape and type."""
        if (tag, ref) in self.at:
            return self.raw(tag, ref)
        head = self.raw(tag | SPECIAL, ref)
        (way,) = struct.unpack_from(">h", head)
        if way == IN_LINKED_BLOCKS:
            length, _, _, link = struct.unpack_from(">iiiH", head, 2)
            parts, size = [], 0
            while link and size < length:
                table = np.frombuffer(self.raw(LINKED, link), ">u2")
                link = int(table[0])
                for r in table[1:].tolist():
                    if r and size < length:
                        parts.append(bytes(self.raw(LINKED, r)))
                        size += len(parts[-1])
            return b"".join(parts)[:length]
        if way == IN_COMPRESSION:
            _, length, at, _, coder = struct.unpack_from(">HiHHH", head, 2)
            return _decoded(self.element(COMPRESSED, at), coder, length)
        if way == IN_CHUNKS:
            return self._chunks(head, shape, kind)
        raise ValueError(f"element {tag}/{ref} is stored in way {way}")

    def _chunks(self, head: memoryview, shape, kind: np.dtype) -> np.ndarray:
        # Way, header length, version, flag, length, chunk size and size of a number come before.
        _, table, _, _, n = struct.unpack_from(">HHHHi", head, 23)
        sides = [struct.unpack_from(">ii", head, 39 + 12 * k) for k in range(n)]
        shape, chunk = [a for a, _ in sides], [b for _, b in sides]
        (size,) = struct.unpack_from(">i", head, 35 + 12 * n)
        fill = np.frombuffer(head[39 + 12 * n : 39 + 12 * n + size], kind)[:1]
        out = np.full(shape, fill[0] if len(fill) else 0, kind)
        rows = self.table(table)
        for origin, tag, ref in zip(rows["origin"], rows["chk_tag"], rows["chk_ref"]):
            part = np.frombuffer(self.element(int(tag[0]) & ~SPECIAL, int(ref[0])), kind).reshape(chunk)
            place = [int(o) * c for o, c in zip(origin, chunk)]
            there = tuple(slice(p, min(p + c, s)) for p, c, s in zip(place, chunk, shape))
            out[there] = part[tuple(slice(0, t.stop - t.start) for t in there)]
        return out

    def group(self, ref: int) -> tuple[str, str, list[tuple[int, int]]]:
        """Name, class and members of a group of elements."""
        b = self.raw(VGROUP, ref)
        (n,) = struct.unpack_from(">H", b)
        ids = np.frombuffer(b[2 : 2 + 4 * n], ">u2").tolist()
        name, at = _text(b, 2 + 4 * n)
        kind, _ = _text(b, at)
        return name, kind, list(zip(ids[:n], ids[n:]))

    def table_head(self, ref: int) -> tuple[str, str, int, list[tuple[str, int, int, int]], int]:
        """Name, class, number of records, fields (name, type, order, offset) and record size of a table."""
        b = self.raw(TABLE, ref)
        _, n, size, k = struct.unpack_from(">hiHh", b)
        kinds, _, offsets, orders = (np.frombuffer(b[10 + 2 * k * j : 10 + 2 * k * (j + 1)], ">u2").tolist() for j in range(4))
        at, fields = 10 + 8 * k, []
        for j in range(k):
            name, at = _text(b, at)
            fields.append((name, kinds[j], orders[j], offsets[j]))
        name, at = _text(b, at)
        kind, _ = _text(b, at)
        return name, kind, n, fields, size

    def table(self, ref: int) -> dict[str, np.ndarray]:
        """The fields of a table as arrays [record, value]."""
        _, _, n, fields, size = self.table_head(ref)
        raw = np.frombuffer(self.element(RECORDS, ref), np.uint8)[: n * size].reshape(n, size)
        out = {}
        for name, code, order, offset in fields:
            kind = dtype(code)
            out[name] = np.ascontiguousarray(raw[:, offset : offset + order * kind.itemsize]).view(kind).reshape(n, order)
        return out

    def attribute(self, ref: int) -> tuple[str, int, object]:
        """Name, type and value (text or numbers) of an attribute, which is a table of one field."""
        name, _, _, fields, _ = self.table_head(ref)
        code = fields[0][1] & 0xFF
        values = self.table(ref)[fields[0][0]].ravel()
        return name, code, values.tobytes().split(b"\0")[0].decode("latin-1") if code in TEXT else values.astype(float).tolist()

    def _attributes(self, members) -> dict[str, tuple[int, object]]:
        found = (self.attribute(r) for t, r in members if t == TABLE and self.table_head(r)[1] == "Attr0.0")
        return {name: (code, value) for name, code, value in found}

    def attributes(self) -> dict[str, tuple[int, object]]:
        """The attributes of the file."""
        groups = (self.group(r) for r in self.refs(VGROUP))
        return next((self._attributes(members) for _, kind, members in groups if kind == "CDF0.0"), {})

    def datasets(self) -> list[Dataset]:
        out = []
        for r in self.refs(VGROUP):
            name, kind, members = self.group(r)
            held = dict(members)
            if kind != "Var0.0" or DIMENSIONS not in held:
                continue
            b = self.raw(DIMENSIONS, held[DIMENSIONS])
            (rank,) = struct.unpack_from(">h", b)
            dims = list(struct.unpack_from(f">{rank}i", b, 2))
            number = self.raw(NUMBER_TYPE, held.get(NUMBER_TYPE, struct.unpack_from(">H", b, 2 + 4 * rank + 2)[0]))
            code = number[1] | (LITTLE if number[3] == 4 else 0)
            names = [self.group(x)[0] for t, x in members if t == VGROUP]
            out.append(Dataset(name, code, dims, names, self._attributes(members), held.get(DATA, 0)))
        return out

    def values(self, d: Dataset) -> np.ndarray:
        kind = dtype(d.code)
        if not d.ref or (DATA, d.ref) not in self.at and (DATA | SPECIAL, d.ref) not in self.at:
            return np.full(d.dims, d.number("_FillValue", default=0), kind)  # never written
        found = self.element(DATA, d.ref, d.dims, kind)
        return found if isinstance(found, np.ndarray) else np.frombuffer(found, kind)[: math.prod(d.dims)].reshape(d.dims)


def _text(b: memoryview, at: int) -> tuple[str, int]:
    (n,) = struct.unpack_from(">H", b, at)
    return bytes(b[at + 2 : at + 2 + n]).decode("latin-1"), at + 2 + n


def _decoded(data, coder: int, length: int) -> bytes:
    if coder == 0:
        return bytes(data)[:length]
    if coder == DEFLATED:
        return zlib.decompress(data)[:length]
    if coder == RUN_LENGTHS:
        out, at = bytearray(), 0
        while at < len(data) and len(out) < length:
            c = data[at]
            if c & 0x80:
                out += bytes(data[at + 1 : at + 2]) * ((c & 0x7F) + 3)
                at += 2
            else:
                out += data[at + 1 : at + 2 + c]
                at += 2 + c
        return bytes(out[:length])
    raise ValueError(f"coder {coder} is not known")


def swath_dims(dims: list[int], layout: Layout = MODIS) -> tuple[int, int, int] | None:
    """Which dimensions are line and sample, and the resolution; None if it is no swath."""
    large = [k for k, n in enumerate(dims) if n > layout.least]
    if len(large) != 2 or not 2 <= len(dims) <= 4:
        return None
    ires = int(dims[large[1]] / layout.frames + 0.5)
    if ires not in (1, 2, 4) or dims[large[0]] % (layout.lines * ires):
        return None
    return large[0], large[1], ires


# -- files as DataFrames


def files(spark: SparkSession, path: str, pattern: str = "*.hdf") -> DataFrame:
    """granule, content of the files below a path of any store. Spark packs small files into one partition and gives
    each large one its own, so that a batch holds little more than one file."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("granule"), "content")


def _per_file(held: DataFrame, schema: str, read: Callable[[str, Container], Iterator[dict]]) -> DataFrame:
    """Batches (dicts of columns) from each file; one file's bytes are in a task's Python memory at a time."""
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(schema)
    names = kind.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(kind)
        for batch in batches:
            for k in range(batch.num_rows):
                # Without a copy: the container is a view of the batch.
                for made in read(batch.column(0)[k].as_py(), Container(batch.column(1)[k].as_buffer())):
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, type=out.field(n).type) for n, x in ((n, made[n]) for n in names)], schema=out)

    return held.select("granule", "content").mapInArrow(run, schema)


def datasets(held: DataFrame, layout: Layout = MODIS) -> DataFrame:
    """One row for each dataset of each file; bands is the smallest dimension from rank 3 on, 1 at rank 2, 0 below."""

    def read(granule, c):
        found = c.datasets()
        swath = [swath_dims(d.dims, layout) for d in found]
        pick = lambda k: [None if s is None else (d.dims[s[k]] if k < 2 else s[2]) for d, s in zip(found, swath)]
        yield {
            "granule": [granule] * len(found), "sds": [d.name for d in found], "rank": [len(d.dims) for d in found], "dims": [d.dims for d in found], "dim_names": [d.dim_names for d in found],
            "type": [NAMES[d.code & 0xFF] for d in found], "bands": [min(d.dims) if len(d.dims) > 2 else int(len(d.dims) == 2) for d in found], "lines": pick(0), "samples": pick(1), "ires": pick(2),
            "fill": [d.number("_FillValue", default=0.0) for d in found], "scale": [d.number("reflectance_scales", "scale_factor", default=1.0) for d in found],
            "offset": [d.number("reflectance_offsets", "add_offset", default=0.0) for d in found],
        }

    return _per_file(held, "granule string, sds string, rank int, dims array<int>, dim_names array<string>, type string, bands int, lines int, samples int, ires int, fill double, scale double, offset double", read)


def attributes(held: DataFrame) -> DataFrame:
    """One row for each attribute; sds is null for those of the file. Numbers of all types are doubles."""

    def read(granule, c):
        rows = [(None, n, *a) for n, a in c.attributes().items()] + [(d.name, n, *a) for d in c.datasets() for n, a in d.attrs.items()]
        yield {
            "granule": [granule] * len(rows), "sds": [r[0] for r in rows], "name": [r[1] for r in rows], "type": [NAMES[r[2]] for r in rows],
            "text": [r[3] if r[2] in TEXT else None for r in rows], "numbers": [None if r[2] in TEXT else r[3] for r in rows],
        }

    return _per_file(held, "granule string, sds string, name string, type string, text string, numbers array<double>", read)


def records(held: DataFrame, table: str, column: str) -> DataFrame:
    """granule, record, values of a field of the table of that name; files without it give no rows."""

    def read(granule, c):
        for r in c.refs(TABLE):
            if c.table_head(r)[0] == table:
                values = c.table(r)[column].astype(float)
                yield {"granule": [granule] * len(values), "record": list(range(len(values))), "values": values.tolist()}
                return

    return _per_file(held, "granule string, record int, values array<double>", read)


def mirror_sides(held: DataFrame) -> DataFrame:
    """granule, scan, mirror."""
    return records(held, "Level 1B Swath Metadata", "Mirror Side").select("granule", F.col("record").alias("scan"), F.element_at("values", 1).cast("int").alias("mirror"))


PIXELS = "granule string, sds string, band int, ires int, scan int, line int, sample int, dn double, v double"


def scans(held: DataFrame, sds: list[str] | None = None, bands: list[int] | None = None, first: int = 0, last: int | None = None, layout: Layout = MODIS) -> DataFrame:
    """The pixels of the swath datasets, a batch for each scan and band: dn as stored, v = (dn - offset) * scale, null
    at the fill value. Datasets, bands and scans that are not asked for are not decoded. One that is asked for by name
    and is no swath is an error; without names all swaths are read.

    ``band`` counts the slices over all other dimensions, in their order."""

    def read(granule, c):
        for d in c.datasets():
            if sds is not None and d.name not in sds:
                continue
            found = swath_dims(d.dims, layout)
            if found is None:
                if sds is not None:
                    raise ValueError(f"{granule}: {d.name} with dimensions {d.dims} is no swath")
                continue
            line, sample, ires = found
            per, n = layout.lines * ires, d.dims[sample]
            data = np.moveaxis(c.values(d), (line, sample), (-2, -1)).reshape(-1, d.dims[line], n)
            fill, scale = d.number("_FillValue", default=0.0), d.number("reflectance_scales", "scale_factor", default=1.0)
            offset = d.number("reflectance_offsets", "add_offset", default=0.0)
            at, across = np.repeat(np.arange(per), n), np.tile(np.arange(n, dtype=np.int32), per)
            for band in range(len(data)) if bands is None else [b for b in bands if b < len(data)]:
                for scan in range(first, min(d.dims[line] // per, math.inf if last is None else last + 1)):
                    dn = data[band, scan * per : (scan + 1) * per].astype(float).ravel()
                    yield {
                        "granule": pa.repeat(pa.scalar(granule), len(dn)), "sds": pa.repeat(pa.scalar(d.name), len(dn)), "band": pa.repeat(pa.scalar(band, pa.int32()), len(dn)),
                        "ires": pa.repeat(pa.scalar(ires, pa.int32()), len(dn)), "scan": pa.repeat(pa.scalar(scan, pa.int32()), len(dn)), "line": pa.array((scan * per + at).astype(np.int32)),
                        "sample": pa.array(across), "dn": pa.array(dn), "v": pa.array((dn - offset) * scale, mask=dn == fill),
                    }

    return _per_file(held, PIXELS, read)


# -- the sink


@dataclass
class Writer:
    """Builds a container with datasets in one block each, attributes and tables."""

    parts: list[tuple[int, int, bytes]] = field(default_factory=list)
    members: list[tuple[int, int]] = field(default_factory=list)

    def put(self, tag: int, data: bytes, ref: int | None = None) -> int:
        ref = len(self.parts) + 1 if ref is None else ref
        self.parts.append((tag, ref, data))
        return ref

    def group(self, name: str, kind: str, members: list[tuple[int, int]]) -> int:
        ids = [t for t, _ in members] + [r for _, r in members]
        body = struct.pack(f">{len(ids) + 1}H", len(members), *ids) + _packed(name) + _packed(kind) + struct.pack(">HHHHB", 0, 0, 3, 0, 0)
        return self.put(VGROUP, body)

    def table(self, name: str, kind: str, columns: dict[str, tuple[int, np.ndarray]]) -> int:
        """A table from columns: name to (type, array [record, value])."""
        arrays = [(n, code, np.ascontiguousarray(a.reshape(len(a), -1).astype(dtype(code)))) for n, (code, a) in columns.items()]
        sizes = [a.shape[1] * a.itemsize for _, _, a in arrays]
        offsets = [sum(sizes[:k]) for k in range(len(sizes))]
        k, records = len(arrays), len(arrays[0][2])
        head = struct.pack(">hiHh", 0, records, sum(sizes), k)
        for row in ([c for _, c, _ in arrays], sizes, offsets, [a.shape[1] for _, _, a in arrays]):
            head += struct.pack(f">{k}H", *row)
        head += b"".join(_packed(n) for n, _, _ in arrays) + _packed(name) + _packed(kind) + struct.pack(">HHhhB", 0, 0, 3, 0, 0)
        ref = self.put(TABLE, head)
        self.put(RECORDS, b"".join(b"".join(a[r].tobytes() for _, _, a in arrays) for r in range(records)), ref)
        return ref

    def attribute(self, name: str, value) -> tuple[int, int]:
        if isinstance(value, str):
            return TABLE, self.table(name, "Attr0.0", {"VALUES": (4, np.frombuffer(value.encode("latin-1", "replace"), np.int8)[None, :])})
        return TABLE, self.table(name, "Attr0.0", {"VALUES": (CODES["float64"], np.array(value, float).reshape(1, -1))})

    def dataset(self, name: str, kind: str, data: np.ndarray, attrs: dict, dim_names: list[str] | None = None) -> None:
        code = CODES[kind]
        names = dim_names or [f"fakeDim{k}" for k in range(data.ndim)]
        members = [(VGROUP, self.group(n, "Dim0.0", [])) for n in names]
        members += [self.attribute(n, v) for n, v in attrs.items()]
        number = self.put(NUMBER_TYPE, bytes([1, code, 8 * dtype(code).itemsize, 1]))
        shape = struct.pack(f">h{data.ndim}i", data.ndim, *data.shape) + struct.pack(">HH", NUMBER_TYPE, number) * (data.ndim + 1)
        ref = self.put(DATA, np.ascontiguousarray(data).astype(dtype(code)).tobytes())
        members += [(DATA, ref), (NUMBER_TYPE, number), (DIMENSIONS, self.put(DIMENSIONS, shape))]
        self.members.append((VGROUP, self.group(name, "Var0.0", members)))

    def finish(self, attrs: dict | None = None) -> bytes:
        self.group("", "CDF0.0", self.members + [self.attribute(n, v) for n, v in (attrs or {}).items()])
        at = 4 + 6 + 12 * len(self.parts)
        head = MAGIC + struct.pack(">hi", len(self.parts), 0)
        for tag, ref, data in self.parts:
            head += struct.pack(">HHii", tag, ref, at, len(data))
            at += len(data)
        return head + b"".join(d for _, _, d in self.parts)


def _packed(text: str) -> bytes:
    return struct.pack(">H", len(text)) + text.encode("latin-1", "replace")


def written(px: DataFrame, kind: str, attrs: dict[str, float], mirrors: bool = False, layout: Layout = MODIS) -> DataFrame:
    """granule, content: each granule's pixels (granule, sds, band, line, sample, dn) as a container, one dataset for
    each name, of rank 3 if it has more than one band. Lines go up to a whole number of scans; pixels that are not
    there hold the fill value. With ``mirrors`` the sides alternate from scan to scan. A granule is one task's work."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        w = Writer()
        longest = 0
        for name, part in sorted(pdf.groupby("sds")):
            samples = int(part["sample"].max()) + 1
            per = layout.lines * max(1, int(samples / layout.frames + 0.5))
            shape = (int(part["band"].max()) + 1, -(-(int(part["line"].max()) + 1) // per) * per, samples)
            data = np.full(shape, attrs.get("_FillValue", 0.0))
            there = part["dn"].notna()
            data[part["band"][there], part["line"][there], part["sample"][there]] = part["dn"][there]
            longest = max(longest, shape[1] // per)
            w.dataset(name, kind, data if shape[0] > 1 else data[0], {k: [v] for k, v in attrs.items()})
        if mirrors:
            w.table("Level 1B Swath Metadata", "", {"Scan Number": (CODES["int32"], np.arange(1, longest + 1)), "Mirror Side": (CODES["int32"], np.arange(longest) % 2)})
        return pd.DataFrame({"granule": [pdf["granule"].iloc[0]], "content": [w.finish()]})

    return px.select("granule", "sds", "band", "line", "sample", "dn").groupBy("granule").applyInPandas(build, "granule string, content binary")
