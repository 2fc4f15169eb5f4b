"""Neighbourhood operators over lines and samples. Every one of them works within windows along a line or along a
column of one granule, so that an image is spread over as many tasks as it has lines or columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _across(*keys: str):
    return Window.partitionBy(*keys, "l").orderBy("s")


def _down(*keys: str):
    return Window.partitionBy(*keys, "s").orderBy("l")


def _both_ways(*keys: str) -> list:
    """Windows over what lies before a pixel along its line and its column, and over what lies behind it, each with the
    pixel: a running value in either order. A frame that ends with the partition would be gone through for each row."""
    ends = (Window.unboundedPreceding, Window.currentRow)
    return [(Window.partitionBy(*keys, line).orderBy(o).rowsBetween(*ends), axis) for line, axis in (("l", "s"), ("s", "l")) for o in (F.asc(axis), F.desc(axis))]


def collar(px: DataFrame, is_data: Column, *keys: str) -> DataFrame:
    """valid: false for the border pixels from which, along the line or the column, no data pixel lies between them
    and the edge."""
    px = px.withColumn("_d", is_data)
    seen = [F.max("_d").over(w) for w, _ in _both_ways(*keys)]
    return px.withColumn("valid", seen[0] & seen[1] & seen[2] & seen[3]).drop("_d")


def neighbours(px: DataFrame, value: str, *keys: str) -> DataFrame:
    """The 3 x 3 surroundings of each pixel as columns nw, n_, ne, w_, e_, sw, s_, se; null beyond the edge. Two
    passes: along the lines, then along the columns with what the first has gathered."""
    a, d = _across(*keys), _down(*keys)
    px = px.withColumn("w_", F.lag(value).over(a)).withColumn("e_", F.lead(value).over(a))
    row = F.struct(F.col("w_").alias("a"), F.col(value).alias("b"), F.col("e_").alias("c"), F.col("l").alias("l"))
    px = px.withColumn("_r", row).withColumn("_u", F.lag("_r").over(d)).withColumn("_d", F.lead("_r").over(d))
    up = lambda f: F.when(F.col("_u.l") == F.col("l") - 1, F.col(f"_u.{f}"))
    down = lambda f: F.when(F.col("_d.l") == F.col("l") + 1, F.col(f"_d.{f}"))
    px = px.withColumns({"nw": up("a"), "n_": up("b"), "ne": up("c"), "sw": down("a"), "s_": down("b"), "se": down("c")})
    return px.drop("_r", "_u", "_d")


def lower_median(values: Column) -> Column:
    """Of an array without nulls: the element at int(n / 2 + 0.5), counted from 1."""
    return F.element_at(F.array_sort(values), F.floor(F.size(values) / 2 + 0.5).cast("int"))


def fill_holes(px: DataFrame, fill: float, *keys: str) -> DataFrame:
    """A fill pixel whose neighbours above and below are all there takes the lower median of its neighbours; those
    to the left and right count where they are no fill. All holes are judged on the original values."""
    g = neighbours(px, "v", *keys)
    rows = F.array("nw", "n_", "ne", "sw", "s_", "se")
    around = F.filter(rows, lambda x: x.isNotNull())
    sides = F.filter(F.array("w_", "e_"), lambda x: x.isNotNull() & (x != fill))
    hole = (F.col("v") == fill) & ~F.exists(around, lambda x: x == fill) & (F.size(around) > 0)
    return g.withColumn("out", F.when(hole, lower_median(F.concat(around, sides))).otherwise(F.col("v"))).select(*px.columns, "out")


def fill_nodata(px: DataFrame, distance: int = 12, *keys: str) -> DataFrame:
    """Missing values by inverse distance from the nearest values in the four directions, at most so far away."""
    seen = []
    for w, axis in ((_across(*keys), "s"), (_down(*keys), "l")):
        here = F.when(F.col("v").isNotNull(), F.struct(F.col(axis).alias("at"), F.col("v").alias("v")))
        seen.append((F.last(here, ignorenulls=True).over(w.rowsBetween(-distance, -1)), axis))
        seen.append((F.first(here, ignorenulls=True).over(w.rowsBetween(1, distance)), axis))
    g = px.withColumns({f"_n{k}": c for k, (c, _) in enumerate(seen)})
    weight = [F.when(F.col(f"_n{k}").isNotNull() & (F.abs(F.col(f"_n{k}.at") - F.col(axis)) <= distance), 1 / F.abs(F.col(f"_n{k}.at") - F.col(axis))) for k, (_, axis) in enumerate(seen)]
    total = sum((F.coalesce(w, F.lit(0.0)) for w in weight), F.lit(0.0))
    value = sum((F.coalesce(w * F.col(f"_n{k}.v"), F.lit(0.0)) for k, w in enumerate(weight)), F.lit(0.0))
    return g.withColumn("out", F.coalesce("v", F.when(total > 0, value / total))).select(*px.columns, "out")


def hillshade(dem: DataFrame, z: float = 5.0, scale: float = 111120.0, pixel: float = 1.0, azimuth: float = 315.0, altitude: float = 45.0, *keys: str) -> DataFrame:
    """Horn's gradient and the light from a sun at the azimuth and altitude, 1 to 255; null at the edge."""
    import math

    g = neighbours(dem, "v", *keys)
    c = F.col
    dx = ((c("nw") + 2 * c("w_") + c("sw")) - (c("ne") + 2 * c("e_") + c("se"))) * (z / (8 * pixel * scale))
    dy = ((c("sw") + 2 * c("s_") + c("se")) - (c("nw") + 2 * c("n_") + c("ne"))) * (z / (8 * pixel * scale))
    g = g.withColumns({"_dx": dx, "_dy": dy})
    az, alt = math.radians(azimuth), math.radians(altitude)
    light = (math.sin(alt) - (c("_dy") * (math.cos(az) * math.cos(alt)) - c("_dx") * (math.sin(az) * math.cos(alt)))) / F.sqrt(1 + c("_dx") * c("_dx") + c("_dy") * c("_dy"))
    return g.withColumn("shade", F.when(c("_dx").isNotNull() & c("_dy").isNotNull(), F.when(light <= 0, 1.0).otherwise(1 + 254 * light))).select(*dem.columns, "shade")


def contour_cells(dem: DataFrame, level: float, *keys: str) -> DataFrame:
    """Marching squares: each 2 x 2 cell that a contour crosses, its case (bits of the corners above the level: upper
    left 8, upper right 4, lower right 2, lower left 1) and where the contour cuts its four sides."""
    a, d = _across(*keys), _down(*keys)
    g = dem.withColumn("v01", F.lead("v").over(a))
    g = g.withColumn("_n", F.lead(F.struct("l", "v", "v01")).over(d)).where(F.col("_n.l") == F.col("l") + 1)
    g = g.withColumns({"v10": F.col("_n.v"), "v11": F.col("_n.v01")}).where("v01 is not null and v11 is not null")
    bit = lambda c, b: F.when(F.col(c) > level, b).otherwise(0)
    g = g.withColumn("kind", bit("v", 8) + bit("v01", 4) + bit("v11", 2) + bit("v10", 1)).where("kind > 0 and kind < 15")
    cut = lambda p, q: F.when((F.col(p) > level) != (F.col(q) > level), (level - F.col(p)) / (F.col(q) - F.col(p)))
    return g.select(*keys, "l", "s", "kind", cut("v", "v01").alias("top"), cut("v01", "v11").alias("right"), cut("v10", "v11").alias("bottom"), cut("v", "v10").alias("left"))


def contour_segments(cells: DataFrame, *keys: str) -> DataFrame:
    """The line pieces (l0, s0, l1, s1) of the cells of ``contour_cells``; a saddle has
    two, one around each of its high corners."""
    c = F.col
    point = {
        "top": F.struct(c("l").cast("double").alias("l"), (c("s") + c("top")).alias("s")), "right": F.struct((c("l") + c("right")).alias("l"), (c("s") + 1.0).alias("s")),
        "bottom": F.struct((c("l") + 1.0).alias("l"), (c("s") + c("bottom")).alias("s")), "left": F.struct((c("l") + c("left")).alias("l"), c("s").cast("double").alias("s")),
    }
    ends = F.filter(F.array(*[F.when(c(k).isNotNull(), point[k]) for k in ("top", "right", "bottom", "left")]), lambda p: p.isNotNull())
    pair = lambda a, b: F.struct(point[a].alias("a"), point[b].alias("b"))
    both = F.when(c("kind") == 5, F.array(pair("top", "right"), pair("bottom", "left"))).when(c("kind") == 10, F.array(pair("top", "left"), pair("bottom", "right")))
    lines = both.otherwise(F.array(F.struct(F.element_at(ends, 1).alias("a"), F.element_at(ends, -1).alias("b"))))
    out = cells.select(*keys, F.explode(lines).alias("p"))
    return out.select(*keys, c("p.a.l").alias("l0"), c("p.a.s").alias("s0"), c("p.b.l").alias("l1"), c("p.b.s").alias("s1"))


def contour_links(cells: DataFrame, *keys: str) -> DataFrame:
    """The steps of the contour lines from cell border to cell border: keys, id, after, and the point (l_at, s_at) of
    id, with higher ground on the left. Borders are numbered, so that lines join without comparing coordinates."""
    c = F.col
    across = lambda down: ((c("l") + down).cast("long") * F.lit(1 << 32) + c("s").cast("long") * 2)
    along = lambda right: (c("l").cast("long") * F.lit(1 << 32) + (c("s") + right).cast("long") * 2 + 1)
    border = {"top": across(0), "bottom": across(1), "left": along(0), "right": along(1)}
    point = {"top": (c("l") + 0.0, c("s") + c("top")), "bottom": (c("l") + 1.0, c("s") + c("bottom")), "left": (c("l") + c("left"), c("s") + 0.0), "right": (c("l") + c("right"), c("s") + 1.0)}
    step = lambda a, b: F.struct(border[a].alias("id"), border[b].alias("after"), point[a][0].alias("l_at"), point[a][1].alias("s_at"), point[b][0].alias("l_to"), point[b][1].alias("s_to"))
    ways = {
        8: ["left top"], 4: ["top right"], 2: ["right bottom"], 1: ["bottom left"], 12: ["left right"], 6: ["top bottom"], 3: ["right left"], 9: ["bottom top"],
        7: ["top left"], 11: ["right top"], 13: ["bottom right"], 14: ["left bottom"], 5: ["top right", "bottom left"], 10: ["left top", "right bottom"],
    }
    steps = None
    for kind, pairs in ways.items():
        made = F.array(*[step(*p.split()) for p in pairs])
        steps = F.when(c("kind") == kind, made) if steps is None else steps.when(c("kind") == kind, made)
    return cells.select(*keys, F.explode(steps).alias("p")).select(*keys, "p.*")


def contour_lines(cells: DataFrame, *keys: str) -> DataFrame:
    """The contour lines of ``contour_cells`` as points in order: keys, line, pos, closed, l, s. A line is known by its
    first border, a closed one by its smallest. Segments are joined by pointer doubling, so that a line may run
    through any number of cells, tasks and tiles; the higher ground lies on its left."""
    from .chains import ranked

    links = contour_links(cells, *keys)
    points = links.select(*keys, "id", F.col("l_at").alias("l"), F.col("s_at").alias("s"), F.lit(None).cast("long").alias("before"))
    points = points.unionByName(links.select(*keys, F.col("after").alias("id"), F.col("l_to").alias("l"), F.col("s_to").alias("s"), F.col("id").alias("before")))
    # A border inside has two cells, which agree on its point.
    points = points.groupBy(*keys, "id").agg(F.max("before").alias("before"), F.min("l").alias("l"), F.min("s").alias("s"))
    from terraloom.sources.staging import cut

    points = cut(points)
    placed = ranked(points.select(*keys, "id", "before"), *keys)
    return placed.join(points.drop("before"), [*keys, "id"]).select(*keys, F.col("start").alias("line"), "pos", "closed", "l", "s")


def morphology(px: DataFrame, value: str, radius: int, grow: bool, *keys: str) -> DataFrame:
    """Largest (grow) or smallest value in the square around each pixel: a window along the lines, then the columns."""
    f = F.max if grow else F.min
    px = px.withColumn(value, f(value).over(_across(*keys).rangeBetween(-radius, radius)))
    return px.withColumn(value, f(value).over(_down(*keys).rangeBetween(-radius, radius)))


def closing(px: DataFrame, value: str, radii: list[int], *keys: str) -> DataFrame:
    """Bays filled: grown and shrunk again for each radius in turn."""
    for r in radii:
        px = morphology(morphology(px, value, r, True, *keys), value, r, False, *keys)
    return px


def blend(px: DataFrame, base: str, overlay: str, inside: Column, width: int, *keys: str) -> DataFrame:
    """The overlay feathered into the base: its share is the distance to the nearest pixel that is not inside, along
    the line or the column, over the width, at most 1."""
    px = px.withColumn("_in", inside)
    near = []
    for w, axis in _both_ways(*keys):
        near.append(F.abs(F.col(axis) - F.last(F.when(~F.col("_in"), F.col(axis)), ignorenulls=True).over(w)))
    share = F.least(F.coalesce(F.least(*near), F.lit(width)) / width, F.lit(1.0))
    return px.withColumn("share", share).withColumn("out", F.col("share") * F.col(overlay) + (1 - F.col("share")) * F.col(base)).drop("_in")
