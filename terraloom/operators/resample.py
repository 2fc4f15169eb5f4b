"""Swath-to-grid resampling, overviews and tiling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.functions.geo import Grid

from .radiometry import bilinear, corners

#: Steps of a kernel's offset, the cubic's parameter, the least weight of an output pixel, and the smallest triangle (fixed values).
STEPS, CUBIC, LEAST_WEIGHT, TRIANGLE = 64, -0.5, 0.10, 1e-20
#: Fill pixels that force the output to fill: nearest, bilinear, cubic (fixed values).
FILL_LIMIT = {"nn": 1, "bi": 2, "cc": 8}
#: Tiles: largest size and overlap in pixels; the smallest side of an overview (fixed values).
TILE, OVERLAP, PYRAMID_FLOOR = 16384, 1, 64


def quantised(d: Column) -> Column:
    return F.floor(d * STEPS + 0.5) / STEPS


def kernel_weights(x: Column, kind: str) -> dict[int, Column]:
    """Weights by footprint offset at the quantised distance x in 0 .. 1."""
    if kind in ("nn", "bi"):
        return {0: 1 - x, 1: x}
    a = CUBIC
    near = lambda d: (a + 2) * d * d * d - (a + 3) * d * d + 1
    far = lambda d: a * d * d * d - 5 * a * d * d + 8 * a * d - 4 * a
    return {-1: far(x + 1), 0: near(x), 1: near(1 - x), 2: far(2 - x)}


def quads(px: DataFrame, *keys: str) -> DataFrame:
    """Input cells with the output coordinates (ol, os) of their four corners p0 .. p3: this pixel, the next sample,
    the next line's next sample, the next line."""
    c = corners(px, ["ol", "os"], *keys)
    named = {f"p{k}{x[1]}": F.col(f"{corner}.{x}") for k, corner in enumerate(("c00", "c01", "c11", "c10")) for x in ("ol", "os")}
    return c.select(*keys, "l", "s", *[v.alias(k) for k, v in named.items()])


def in_triangle(e1: tuple[Column, Column], e2: tuple[Column, Column], e0: tuple[Column, Column]) -> tuple[Column, Column, Column]:
    """(inside, v, u) with e0 = v * e1 + u * e2; edges are inside, degenerate triangles hold nothing."""
    det = e1[0] * e2[1] - e1[1] * e2[0]
    safe = F.when(F.abs(det) >= TRIANGLE, det)
    v = (e0[0] * e2[1] - e0[1] * e2[0]) / safe
    u = (e1[0] * e0[1] - e1[1] * e0[0]) / safe
    return F.coalesce((v >= 0) & (v <= 1) & (u >= 0) & (u <= 1) & (u + v <= 1), F.lit(False)), v, u


def expand(q: DataFrame, lines: int, samples: int) -> DataFrame:
    """Output pixels within each quad, with the offset (dl, ds) in it: candidates from the quad's box, then the
    upper-left triangle, then the lower-right one."""
    p = {k: (F.col(f"p{k}l"), F.col(f"p{k}s")) for k in range(4)}

    def span(axis: int, n: int) -> Column:
        values = [p[k][axis] for k in range(4)]
        low = F.greatest(F.least(*values).cast("long"), F.lit(0))
        high = F.least(F.greatest(*values).cast("long") + 1, F.lit(n)) - 1
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))

    cells = q.withColumn("outl", F.explode(span(0, lines))).withColumn("outs", F.explode(span(1, samples)))
    minus = lambda a, b: (a[0] - b[0], a[1] - b[1])
    at = (F.col("outl").cast("double"), F.col("outs").cast("double"))
    first, v1, u1 = in_triangle(minus(p[3], p[0]), minus(p[1], p[0]), minus(at, p[0]))
    second, v2, u2 = in_triangle(minus(p[1], p[2]), minus(p[3], p[2]), minus(at, p[2]))
    cells = cells.withColumns({"_in1": first, "_in2": second, "_v1": v1, "_u1": u1, "_v2": v2, "_u2": u2}).where("_in1 or _in2")
    return cells.withColumns({"dl": F.when(F.col("_in1"), F.col("_v1")).otherwise(1 - F.col("_v2")), "ds": F.when(F.col("_in1"), F.col("_u1")).otherwise(1 - F.col("_u2"))}).drop("_in1", "_in2", "_v1", "_u1", "_v2", "_u2")


def contributions(cells: DataFrame, px: DataFrame, kind: str, *keys: str) -> DataFrame:
    """Each output pixel's source pixels (those of the kernel's footprint) with their weight."""
    wl, ws = kernel_weights(quantised(F.col("dl")), kind), kernel_weights(quantised(F.col("ds")), kind)
    foot = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), (wl[a] * ws[b]).alias("w")) for a in wl for b in ws])
    spread = cells.select(*keys, "outl", "outs", "l", "s", F.explode(foot).alias("k")).select(*keys, "outl", "outs", (F.col("l") + F.col("k.a")).alias("l"), (F.col("s") + F.col("k.b")).alias("s"), F.col("k.w").alias("w"))
    return spread.join(px.select(*keys, "l", "s", "v"), [*keys, "l", "s"])


def weighted(contrib: DataFrame, *keys: str, least: float = LEAST_WEIGHT) -> DataFrame:
    """Weighted mean of the values that are not null; null where their weight is too small."""
    w = F.when(F.col("v").isNotNull(), F.col("w"))
    total = F.sum(w)
    return contrib.groupBy(*keys).agg(F.when(total > least, F.sum(F.col("v") * w) / total).alias("v"), total.alias("w"))


def nearest(contrib: DataFrame, *keys: str, order: tuple[str, ...]) -> DataFrame:
    """The value of greatest weight; of equals the first in source order."""
    key = F.struct(F.col("w"), *[(-F.col(c)).alias(f"o{k}") for k, c in enumerate(order)], F.col("v"))
    return contrib.where(F.col("v").isNotNull()).groupBy(*keys).agg(F.max(key).alias("k")).select(*keys, F.col("k.v").alias("v"), F.col("k.w").alias("w"))


def on_grid(values: DataFrame, grid: DataFrame, *keys: str, fill: float) -> DataFrame:
    """Every pixel of the grid: its value, or the fill."""
    return grid.join(values, list(keys), "left").withColumn("v", F.coalesce("v", F.lit(fill)))


def swath_to_grid(px: DataFrame, kind: str, lines: int, samples: int, fill: float) -> DataFrame:
    """px (l, s, v, ol, os) resampled onto an output grid: quads, candidates, kernel, accumulation, fill."""
    cells = expand(quads(px), lines, samples)
    contrib = contributions(cells, px, kind)
    out = nearest(contrib, "outl", "outs", order=("l", "s")) if kind == "nn" else weighted(contrib, "outl", "outs")
    rows = px.sparkSession.range(lines).select(F.col("id").alias("outl"))
    grid = rows.withColumn("outs", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(samples - 1).cast("long"))))
    return on_grid(out.select("outl", "outs", "v"), grid, "outl", "outs", fill=fill)


def fine_geolocation(coarse: DataFrame, ires: int, scan_lines: int = 10) -> DataFrame:
    """lat and lon of each fine pixel from the four coarse ones around it, within its scan; beyond the last ones the
    plane is carried on. Coarse: scan, l (within the scan), s, lat, lon. Null where a corner is null."""
    size = coarse.agg((F.max("s") + 1).alias("ns"))
    cells = corners(coarse, ["lat", "lon"], "scan")
    k = F.sequence(F.lit(0), F.lit(ires - 1))
    fine = coarse.select("scan", F.col("l").alias("cl"), F.col("s").alias("cs"), F.explode(k).alias("a")).withColumn("b", F.explode(k))
    fine = fine.select("scan", (F.col("cl") * ires + F.col("a")).alias("fl"), (F.col("cs") * ires + F.col("b")).alias("fs")).crossJoin(F.broadcast(size))
    fine = fine.withColumns({"gl": F.col("fl") / ires - 0.5 * (1 - 1 / ires), "gs": F.col("fs") / ires})
    base = lambda x, n: F.least(F.greatest(F.col(x).cast("long"), F.lit(0)), n - 2)
    fine = fine.withColumns({"l": base("gl", F.lit(scan_lines)), "s": base("gs", F.col("ns"))})
    out = fine.join(cells, ["scan", "l", "s"])
    return out.select("scan", "fl", "fs", *[bilinear(v, F.col("gl") - F.col("l"), F.col("gs") - F.col("s")).alias(v) for v in ("lat", "lon")])


def extend_scan(px: DataFrame) -> DataFrame:
    """A line more before and after each scan, extrapolated linearly."""
    by = Window.partitionBy("scan", "s")
    inner = px.withColumns({"_a": F.lead("v").over(by.orderBy("l")), "_b": F.lag("v").over(by.orderBy("l")), "_first": F.row_number().over(by.orderBy("l")), "_last": F.row_number().over(by.orderBy(F.desc("l")))})
    before = inner.where("_first = 1 and _a is not null").select("scan", (F.col("l") - 1).alias("l"), "s", (2 * F.col("v") - F.col("_a")).alias("v"))
    after = inner.where("_last = 1 and _b is not null").select("scan", (F.col("l") + 1).alias("l"), "s", (2 * F.col("v") - F.col("_b")).alias("v"))
    return px.select("scan", "l", "s", "v").unionByName(before).unionByName(after)


def overview(px: DataFrame, level: int, *keys: str) -> DataFrame:
    """Block averages."""
    return px.groupBy(*keys, F.expr(f"l div {level}").alias("bl"), F.expr(f"s div {level}").alias("bs")).agg(F.avg("v").alias("v"), F.count("v").alias("n"))


def levels(lines: int, samples: int, floor: int = PYRAMID_FLOOR) -> list[int]:
    """2, 4, 8 .. while both sides stay above the floor."""
    out, k = [], 2
    while lines / k > floor and samples / k > floor:
        out.append(k)
        k *= 2
    return out


def pyramid(px: DataFrame, ks: list[int]) -> DataFrame:
    """All levels at once: each level is summed from the one before, so the pixels are read once."""
    if not ks:
        return px.sparkSession.createDataFrame([], "level int, bl long, bs long, v double, n long")
    out, sums, last = None, px.groupBy(F.expr(f"l div {ks[0]}").alias("bl"), F.expr(f"s div {ks[0]}").alias("bs")).agg(F.sum("v").alias("t"), F.count("v").alias("n")), ks[0]
    for k in ks:
        if k != last:
            sums = sums.groupBy(F.expr(f"bl div {k // last}").alias("bl"), F.expr(f"bs div {k // last}").alias("bs")).agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
            last = k
        one = sums.select(F.lit(k).alias("level"), "bl", "bs", F.when(F.col("n") > 0, F.col("t") / F.col("n")).alias("v"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def overview_scale(pixel_x: Column, pixel_y: Column) -> Column:
    return F.least(pixel_x, pixel_y) * (72 * 4374754) + 150000


def tiles(px: DataFrame, size: int = TILE, overlap: int = OVERLAP) -> DataFrame:
    """Pixels with their tile (tl, ts); those on a tile's first lines or samples also belong to the tile before."""
    both = lambda c: F.when((F.col(c) % size < overlap) & (F.col(c) >= size), F.array(F.expr(f"{c} div {size} - 1"), F.expr(f"{c} div {size}"))).otherwise(F.array(F.expr(f"{c} div {size}")))
    return px.withColumn("tl", F.explode(both("l"))).withColumn("ts", F.explode(both("s")))


def grid_bounds(boxes: DataFrame, project, pixel: float, *keys: str) -> DataFrame:
    """Projected corners and side points of each box: upper-left corner, lines, samples, snapped lower-right."""
    step = F.explode(F.sequence(F.lit(0), F.lit(4)))
    b = boxes.withColumn("i", step)
    f = F.col("i") / 5.0
    w, s, e, n = (F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    sides = F.array(
        F.struct((w + f * (e - w)).alias("x"), n.alias("y")), F.struct(e.alias("x"), (n - f * (n - s)).alias("y")),
        F.struct((e - f * (e - w)).alias("x"), s.alias("y")), F.struct(w.alias("x"), (s + f * (n - s)).alias("y")),
    )
    pts = b.select(*keys, F.explode(sides).alias("p"))
    x, y = project(F.col("p.x"), F.col("p.y"))
    agg = pts.select(*keys, x.alias("x"), y.alias("y")).groupBy(*keys).agg(F.min("x").alias("ulx"), F.max("y").alias("uly"), F.max("x").alias("_mx"), F.min("y").alias("_my"))
    agg = agg.withColumns({"samples": ((F.col("_mx") - F.col("ulx")) / pixel + 0.5).cast("long"), "lines": ((F.col("uly") - F.col("_my")) / pixel + 0.5).cast("long")})
    return agg.withColumns({"lrx": F.col("ulx") + F.col("samples") * pixel, "lry": F.col("uly") - F.col("lines") * pixel}).drop("_mx", "_my")


def pixel_of(points: DataFrame, grid: Grid, x: str, y: str) -> DataFrame:
    return points.withColumns({"line": grid.line(F.col(y)), "sample": grid.sample(F.col(x))})


def footprint(transform: DataFrame) -> DataFrame:
    """Closed ring of a raster from xo, xd, xr, yo, yr, yd and its size nx, ny, rotation included."""
    point = lambda i, j: F.struct((F.col("xo") + i * F.col("xd") + j * F.col("xr")).alias("x"), (F.col("yo") + i * F.col("yr") + j * F.col("yd")).alias("y"))
    zero, nx, ny = F.lit(0), F.col("nx"), F.col("ny")
    return transform.withColumn("ring", F.array(point(zero, zero), point(nx, zero), point(nx, ny), point(zero, ny), point(zero, zero)))


def unwrap_corners(g: DataFrame) -> DataFrame:
    """Granule corners ulx, uly, urx, ury, llx, lly, lrx, lry made continuous over a pole or the dateline, and their
    centre (cx, cy)."""
    over = (F.abs(F.col("ulx") - F.col("llx")) > 75) & (F.abs(F.col("urx") - F.col("lrx")) > 75)
    south = F.col("lly") < 0
    turn = lambda c: F.when(c - 180 < -180, c - 180 + 360).otherwise(c - 180)
    down, up = over & south, over & ~south
    out = {
        "llx": F.when(down, turn(F.col("lrx"))).otherwise(F.col("llx")), "lrx": F.when(down, turn(F.col("llx"))).otherwise(F.col("lrx")),
        "lly": F.when(down, -180 - F.col("lry")).otherwise(F.col("lly")), "lry": F.when(down, -180 - F.col("lly")).otherwise(F.col("lry")),
        "ulx": F.when(up, turn(F.col("urx"))).otherwise(F.col("ulx")), "urx": F.when(up, turn(F.col("ulx"))).otherwise(F.col("urx")),
        "uly": F.when(up, 180 - F.col("ury")).otherwise(F.col("uly")), "ury": F.when(up, 180 - F.col("uly")).otherwise(F.col("ury")),
    }
    g = g.withColumns(out)
    xs = ["ulx", "urx", "llx", "lrx"]
    line = ((F.col("ulx") > 90) | (F.col("llx") > 90)) & ((F.col("urx") < -90) | (F.col("lrx") < -90))
    g = g.withColumn("_line", line).withColumns({c: F.when(F.col("_line") & (F.col(c) > 0), F.col(c) - 360).otherwise(F.col(c)) for c in xs}).drop("_line")
    cx, cy = sum(F.col(c) for c in xs) / 4, (F.col("uly") + F.col("ury") + F.col("lly") + F.col("lry")) / 4
    cx = F.when(cx < -180, cx + 360).when(cx > 180, cx - 360).otherwise(cx)
    return g.withColumns({"cx": cx, "cy": F.when(cy > 90, 180 - cy).when(cy < -90, -180 - cy).otherwise(cy)})
