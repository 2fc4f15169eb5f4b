"""Reading KML and metadata text into columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_overlays(df: DataFrame, xml: str) -> DataFrame:
    """north, south, east, west and href of a ground overlay, by path expressions."""
    number = lambda name: F.expr(f"xpath_double({xml}, '//LatLonBox/{name}/text()')")
    return df.withColumns({name: number(name) for name in ("north", "south", "east", "west")} | {"href": F.expr(f"xpath_string({xml}, '//Icon/href/text()')")})


def links(df: DataFrame, xml: str) -> DataFrame:
    """One row for each network link of a document."""
    return df.withColumn("href", F.explode(F.expr(f"xpath({xml}, '//NetworkLink//href/text()')")))


#: Where bounds are looked for, in this order (fixed values): metadata names, each plain and with .0 to .9.
METADATA = ("ArchiveMetadata", "CoreMetadata", "StructMetadata")


def bound(texts: list[Column], name: str) -> Column:
    """The value of a bounding coordinate in the first of the metadata texts that has it."""
    pattern = rf"(?s){name}BOUNDINGCOORDINATE.*?VALUE\s*=\s*([-+0-9.eE]+)"
    return F.coalesce(*[F.regexp_extract(t, pattern, 1).try_cast("double") for t in texts])


def bounds(df: DataFrame, texts: list[str], swapped: bool = False) -> DataFrame:
    """Corner longitudes and latitudes: upper left from west and north, lower right from east and south.
    ``swapped`` takes the left longitude from the east bound and the right one from the west."""
    columns = [F.col(t) for t in texts]
    west, east = bound(columns, "WEST"), bound(columns, "EAST")
    if swapped:
        west, east = east, west
    return df.withColumns({"ul_lon": west, "ul_lat": bound(columns, "NORTH"), "lr_lon": east, "lr_lat": bound(columns, "SOUTH")})


def metadata_dump(df: DataFrame, attributes: str, names: tuple[str, ...] = METADATA) -> DataFrame:
    """All metadata attributes of a map column as one text, in the order of names and parts."""
    entries = F.filter(F.map_entries(attributes), lambda e: e["key"].rlike("(?i)^(" + "|".join(names) + r")(\.[0-9])?$"))
    ordered = F.array_sort(entries)
    return df.withColumn("dump", F.array_join(F.transform(ordered, lambda e: e["value"]), "\n"))


#: What a raster info text says (fixed patterns).
INFO = {
    "x": r"Size is (\d+), *\d+", "y": r"Size is \d+, *(\d+)", "xo": r"Origin = \(([-0-9.eE]+),", "yo": r"Origin = \([-0-9.eE]+, *([-0-9.eE]+)\)",
    "xd": r"Pixel Size = \(([-0-9.eE]+),", "yd": r"Pixel Size = \([-0-9.eE]+, *([-0-9.eE]+)\)",
}


def raster_info(df: DataFrame, text: str) -> DataFrame:
    """Size, origin, pixel size, band count, type and mask flags of a raster's info text."""
    numbers = {k: F.regexp_extract(text, p, 1).try_cast("int" if k in "xy" else "double") for k, p in INFO.items()}
    return df.withColumns(
        numbers
        | {
            "nbands": F.regexp_count(text, F.lit(r"(?m)^Band \d+")).cast("int"),
            "type": F.regexp_extract(text, r"Band 1 .*?Type=(\w+)", 1),
            "has_alpha": F.col(text).contains("ColorInterp=Alpha"),
            "has_mask": F.col(text).contains("PER_DATASET") & ~F.col(text).contains("ALPHA"),
            "is_wgs84": F.col(text).rlike(r'GEOGCS\["WGS 84"|EPSG.*4326'),
        }
    )
