"""HDF4 containers put together byte by byte, and written ones."""

import struct
import zlib

import numpy as np
import pytest

from terraloom.sources import hdf


def container(elements: list[tuple[int, int, bytes]], blocks: int = 1) -> bytes:
    """Descriptor blocks, one after another, each with its share of the elements; an unused descriptor in each."""
    share = -(-len(elements) // blocks)
    parts = [elements[k * share : (k + 1) * share] for k in range(blocks)]
    heads = [6 + 12 * (len(p) + 1) for p in parts]
    data_at = 4 + sum(heads)
    out, data, at = b"\x0e\x03\x13\x01", b"", 4
    for k, p in enumerate(parts):
        at += heads[k]
        out += struct.pack(">hi", len(p) + 1, at if k + 1 < len(parts) else 0) + struct.pack(">HHii", 1, 0, -1, -1)
        for tag, ref, body in p:
            out += struct.pack(">HHii", tag, ref, data_at + len(data), len(body))
            data += body
    return out + data


def text(s: str) -> bytes:
    return struct.pack(">H", len(s)) + s.encode()


def group(name, kind, members):
    return struct.pack(">H", len(members)) + b"".join(struct.pack(">H", t) for t, _ in members) + b"".join(struct.pack(">H", r) for _, r in members) + text(name) + text(kind) + struct.pack(">HHHHB", 0, 0, 3, 0, 0)


def table_head(name, kind, n, fields):
    """fields: (name, type, bytes, order)"""
    size = sum(f[2] for f in fields)
    offsets = [sum(f[2] for f in fields[:k]) for k in range(len(fields))]
    head = struct.pack(">hiHh", 0, n, size, len(fields)) + b"".join(struct.pack(">H", f[1]) for f in fields) + b"".join(struct.pack(">H", f[2]) for f in fields)
    head += b"".join(struct.pack(">H", o) for o in offsets) + b"".join(struct.pack(">H", f[3]) for f in fields)
    return head + b"".join(text(f[0]) for f in fields) + text(name) + text(kind) + struct.pack(">HHhhB", 0, 0, 3, 0, 0)


def one_dataset(data: np.ndarray, stored: list[tuple[int, int, bytes]], code=22, attrs=(), extra=(), order=1):
    """A container with the dataset "EV"; its data are the given elements, whose reference is 50."""
    elements = [*stored, (106, 2, bytes([1, code, 8 * data.itemsize, order])), (701, 3, struct.pack(f">h{data.ndim}i", data.ndim, *data.shape) + struct.pack(">HH", 106, 2) * (data.ndim + 1))]
    members = [(702, 50), (106, 2), (701, 3)]
    for k, (name, kind, size, values) in enumerate(attrs):
        ref = 60 + k
        elements += [(1962, ref, table_head(name, "Attr0.0", 1, [("VALUES", kind, size * len(values), len(values))])), (1963, ref, values if isinstance(values, bytes) else np.array(values, hdf.TYPES[kind]).tobytes())]
        members.append((1962, ref))
    elements += [(1965, 4, group("EV", "Var0.0", members)), (1965, 5, group("", "CDF0.0", [(1965, 4)])), *extra]
    return elements


A = np.arange(20 * 12, dtype=">i2").reshape(20, 12)


def plain(a):
    return [(702, 50, a.tobytes())]


def linked(a):
    raw = a.tobytes()
    pieces = [raw[:100], raw[100:164], raw[164:]]
    head = struct.pack(">hiiiH", 1, len(raw), 64, 2, 70)
    tables = [(20, 70, struct.pack(">HHH", 71, 80, 81)), (20, 71, struct.pack(">HHH", 0, 82, 0))]
    return [(702 | 0x4000, 50, head), *tables, *((20, 80 + k, p) for k, p in enumerate(pieces))]


def deflated(a):
    head = struct.pack(">hHiHHHH", 3, 0, a.nbytes, 90, 0, 4, 6)
    return [(702 | 0x4000, 50, head), (40, 90, zlib.compress(a.tobytes()))]


def run_lengths(a):
    raw = a.tobytes()
    coded = b"".join(bytes([len(raw[k : k + 128]) - 1]) + raw[k : k + 128] for k in range(0, len(raw), 128))
    return [(702 | 0x4000, 50, struct.pack(">hHiHHH", 3, 0, len(raw), 90, 0, 1)), (40, 90, coded)]


def chunked(a, packed=False, left_out=()):
    chunk = (8, 5)  # neither side divides the dataset's
    head = struct.pack(">B", 0) + struct.pack(">iiiiHHHHi", 3 if packed else 0, a.size, 40, 2, 1962, 95, 0, 0, 2)
    head += b"".join(struct.pack(">iii", 0, n, c) for n, c in zip(a.shape, chunk)) + struct.pack(">i", 2) + struct.pack(">h", -7)
    out, rows = [], b""
    for i in range(-(-a.shape[0] // 8)):
        for j in range(-(-a.shape[1] // 5)):
            if (i, j) in left_out:
                continue
            part = np.full(chunk, 99, ">i2")
            piece = a[8 * i : 8 * i + 8, 5 * j : 5 * j + 5]
            part[: piece.shape[0], : piece.shape[1]] = piece
            ref = 100 + 10 * i + j
            if packed:
                out += [(61 | 0x4000, ref, struct.pack(">hHiHHHH", 3, 0, part.nbytes, 200 + ref, 0, 4, 6)), (40, 200 + ref, zlib.compress(part.tobytes()))]
            else:
                out.append((61, ref, part.tobytes()))
            rows += struct.pack(">iiHH", i, j, 61, ref)
    fields = [("origin", 24, 8, 2), ("chk_tag", 23, 2, 1), ("chk_ref", 23, 2, 1)]
    return [(702 | 0x4000, 50, struct.pack(">hi", 5, len(head)) + head), *out, (1962, 95, table_head("_HDF_CHK_TBL_0", "_HDF_CHK_TBL", len(rows) // 12, fields)), (1963, 95, rows)]


@pytest.mark.parametrize("blocks", [1, 3])
@pytest.mark.parametrize("stored", [plain, linked, deflated, run_lengths, chunked, lambda a: chunked(a, True)])
def test_ways_of_storage(stored, blocks):
    c = hdf.Container(container(one_dataset(A, stored(A)), blocks))
    (d,) = c.datasets()
    assert (d.name, d.dims, d.code) == ("EV", [20, 12], 22)
    assert np.array_equal(c.values(d), A)


def test_chunks_that_were_never_written_hold_the_fill_value():
    c = hdf.Container(container(one_dataset(A, chunked(A, left_out={(0, 1)}))))
    got = c.values(c.datasets()[0])
    assert (got[:8, 5:10] == -7).all() and np.array_equal(got[8:], A[8:])


@pytest.mark.parametrize("code", sorted(hdf.TYPES))
def test_types(code):
    a = np.arange(6).astype(hdf.TYPES[code]).reshape(2, 3)
    c = hdf.Container(container(one_dataset(a, plain(a), code)))
    assert np.array_equal(c.values(c.datasets()[0]), a)


def test_little_endian_numbers():
    a = np.arange(6, dtype="<i4").reshape(2, 3)
    c = hdf.Container(container(one_dataset(a, plain(a), 24, order=4)))
    assert np.array_equal(c.values(c.datasets()[0]), a)


def test_attributes_and_tables():
    attrs = [("_FillValue", 22, 2, [-7]), ("reflectance_scales", 5, 4, [0.5, 0.25]), ("units", 4, 1, b"none\0")]
    rows = b"".join(struct.pack(">i4sd", k, b"abcd", k / 2) for k in range(5))
    extra = [(1962, 40, table_head("Level 1B Swath Metadata", "", 5, [("Mirror Side", 24, 4, 1), ("Kind", 4, 4, 4), ("Time", 6, 8, 1)])), (1963, 40, rows)]
    c = hdf.Container(container(one_dataset(A, plain(A), attrs=attrs, extra=extra)))
    (d,) = c.datasets()
    assert d.attrs["reflectance_scales"] == (5, [0.5, 0.25]) and d.attrs["units"][1] == "none" and d.number("_FillValue", default=0) == -7
    t = c.table(40)
    assert t["Mirror Side"].ravel().tolist() == [0, 1, 2, 3, 4] and t["Time"].ravel().tolist() == [0, 0.5, 1, 1.5, 2] and t["Kind"].shape == (5, 4)


def test_swath_rules():
    for dims, want in [([2030, 1354], (0, 1, 1)), ([15, 2030, 1354], (1, 2, 1)), ([4060, 2708, 2], (0, 1, 2)), ([8120, 5416], (0, 1, 4)), ([2, 2, 2030, 1354], (2, 3, 1))]:
        assert hdf.swath_dims(dims) == want
    for dims in ([2030], [203, 271], [2035, 1354], [2030, 4062], [300, 300, 1354], [1, 2, 3, 2030, 1354]):
        assert hdf.swath_dims(dims) is None


def test_files_from_a_folder(spark, tmp_path):
    """Real files, one of them not asked for; the rows come from tasks, in whole scans."""
    small = hdf.Layout(least=8, frames=12, lines=10)
    attrs = [("_FillValue", 22, 2, [5]), ("scale_factor", 6, 8, [0.5]), ("add_offset", 6, 8, [1.0])]
    (tmp_path / "day").mkdir()
    for name, stored in (("a", plain), ("b", deflated)):
        (tmp_path / "day" / f"{name}.hdf").write_bytes(container(one_dataset(A, stored(A), attrs=attrs)))
    (tmp_path / "day" / "c.txt").write_text("no container")
    held = hdf.files(spark, str(tmp_path))
    px = {(r["granule"], r["line"], r["sample"]): r for r in hdf.scans(held, layout=small).collect()}
    assert len(px) == 2 * A.size
    assert all((r["dn"], r["v"], r["scan"]) == (A[line, s], None if A[line, s] == 5 else (A[line, s] - 1) * 0.5, line // 10) for (_, line, s), r in px.items())
    assert {r["scan"] for r in hdf.scans(held, ["EV"], first=1, layout=small).collect()} == {1}
    assert hdf.scans(held, ["EV"], bands=[3], layout=small).count() == 0
    with pytest.raises(Exception, match="no swath"):
        hdf.scans(held, ["EV"]).collect()  # too small for the real rules
    assert hdf.scans(held).count() == 0
    assert {(r["granule"], r["name"]) for r in hdf.attributes(held).collect()} == {(f"{g}.hdf", a[0]) for g in "ab" for a in attrs}
    assert hdf.mirror_sides(held).count() == 0


def test_written_containers_have_every_type(spark):
    for kind in hdf.CODES:
        w = hdf.Writer()
        a = np.arange(30).reshape(5, 6)
        w.dataset("EV", kind, a, {"_FillValue": [3.0], "units": "none"}, ["lines", "samples"])
        c = hdf.Container(w.finish({"CoreMetadata.0": "GROUP = X"}))
        (d,) = c.datasets()
        assert np.array_equal(c.values(d), a) and hdf.NAMES[d.code] == kind and d.dim_names == ["lines", "samples"]
        assert c.attributes()["CoreMetadata.0"][1] == "GROUP = X" and d.attrs["units"][1] == "none"


def test_not_a_container():
    with pytest.raises(ValueError):
        hdf.Container(b"GIF89a")
