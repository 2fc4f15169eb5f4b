"""The integerized sinusoidal grid: every row of cells has its own whole number of columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First line within a pixel and distance of the lines that are nested in it, for 2 and 4 rows (fixed values).
NESTED = {1: (0.0, 0.0), 2: (-0.25, 0.5), 4: (-0.375, 0.25)}


@dataclass(frozen=True)
class Grid:
    """``rows`` from pole to pole. ``justify``: 0 and 1 round the number of columns of a row, 2 makes it even."""

    rows: int
    justify: int = 1
    centre: float = 0.0
    radius: float = 6371007.181

    @property
    def pitch(self) -> float:
        """The width of a column at the equator."""
        half = self.rows // 2
        around = math.cos(math.pi / 2 * (1 - (half - 0.5) / half)) * self.rows
        n = 2 * int(around + 0.5) if self.justify == 2 else int(2 * around + 0.5)
        return 2 * math.pi * self.radius / max(n, 1 if self.justify == 0 else 2)

    def row(self, lat: Column) -> Column:
        """The row of a latitude, from the north pole; null beyond the poles."""
        found = F.least(F.floor((90.0 - lat) / 180.0 * self.rows), F.lit(self.rows - 1).cast("long"))
        return F.when(F.abs(lat) <= 90.0, found)

    def columns(self, row: Column) -> Column:
        """How many columns a row has: as many as fit its middle parallel. The hemispheres mirror each other."""
        half = self.rows // 2
        near = F.least(row, F.lit(self.rows - 1) - row)
        around = F.cos(F.lit(math.pi / 2) * (1.0 - (near + 0.5) / F.lit(float(half)))) * self.rows
        n = 2 * F.floor(around + 0.5) if self.justify == 2 else F.floor(2 * around + 0.5)
        return F.when(row.isNotNull(), F.greatest(n, F.lit(1 if self.justify == 0 else 2).cast("long")))

    def middle(self, row: Column) -> Column:
        """The column at the central meridian."""
        return F.floor((self.columns(row) + 1) / 2)

    def share(self, lon: Column) -> Column:
        """How far around a longitude is, from the edge opposite the central meridian: 0 to 1."""
        return F.pmod(lon - self.centre + 180.0, F.lit(360.0)) / 360.0

    def cell(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """Row and column of the cell with a point."""
        row = self.row(lat)
        n = self.columns(row)
        return row, F.least(F.floor(self.share(lon) * n), n - 1)

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """x, y of a point. Rows have gaps between them where their numbers of columns differ."""
        row = self.row(lat)
        return (self.share(lon) * self.columns(row) - self.middle(row)) * self.pitch, F.radians(lat) * self.radius

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Longitude and latitude; null where the row has no column there, and beyond the poles."""
        lat = F.degrees(y / self.radius)
        row = self.row(lat)
        share = (self.middle(row) + x / self.pitch) / self.columns(row)
        good = (share >= 0) & (share <= 1)
        lon = F.pmod(share * 360.0 - 180.0 + self.centre + 180.0, F.lit(360.0)) - 180.0
        return F.when(good, lon), F.when(good, lat)

    def nested(self, line: Column, sample: Column, ulx: float, uly: float, pixel: float, nest: int) -> tuple[Column, Column]:
        """Longitude and latitude of a pixel of an image in the grid's plane whose lines hold 1, 2 or 4 rows each: the
        mean of the places in all rows that reach so far; null if none does."""
        first, step = NESTED[nest]
        x = F.lit(ulx) + sample * pixel
        places = [self.inverse(x, F.lit(uly) - (line + first + k * step) * pixel) for k in range(nest)]
        n = sum(F.when(lon.isNotNull(), 1).otherwise(0) for lon, _ in places)
        mean = lambda i: F.when(n > 0, sum(F.coalesce(p[i], F.lit(0.0)) for p in places) / n)
        return mean(0), mean(1)
