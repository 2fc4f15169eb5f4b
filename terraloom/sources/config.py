"""Job configuration: parameter text to a checked record."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.functions.geo import Grid

#: Projection names by number (fixed values).
PROJECTIONS = {"GEO": 0, "UTM": 1, "ALBERS": 3, "LAMCC": 4, "MERCAT": 5, "PS": 6, "TM": 9, "LAMAZ": 11, "EQRECT": 17, "SNSOID": 16, "GOOD": 24, "MOLL": 25, "HAM": 27, "ISINUS": 31}
KERNELS, TYPES = ("NN", "BI", "CC"), ("CHAR8", "UINT8", "INT8", "INT16", "UINT16", "INT32", "UINT32", "FLOAT32")


def clean_line(line: str) -> str:
    """Without its remark, cut at the first unprintable character, $(NAME) filled from the environment."""
    line = re.sub(r"[^\x20-\x7e\t].*$", "", line.split("#", 1)[0]).strip()
    return re.sub(r"\$\((\w+)\)", lambda m: os.environ.get(m[1], ""), line)


def parse_text(text: str) -> dict[str, str]:
    """NAME = VALUE lines, names in upper case; the last one of a name counts."""
    pairs = (line.partition("=") for line in map(clean_line, text.splitlines()) if "=" in line)
    return {k.strip().upper(): v.strip().strip('"') for k, _, v in pairs}


def projection_number(name: str) -> int:
    name = name.strip().upper()
    if name in PROJECTIONS:
        return PROJECTIONS[name]
    if name.isdigit():
        return int(name)
    raise ValueError(f"unknown projection {name}")


@dataclass(frozen=True)
class ResampleJob:
    """A swath-to-grid job."""

    input: str
    output: str
    geolocation: str
    projection: int = 0
    parameters: tuple[float, ...] = field(default_factory=lambda: (0.0,) * 15)
    kernel: str = "NN"
    sds: tuple[str, ...] = ()
    pixel: float | None = None
    ulx: float | None = None
    uly: float | None = None
    type: str | None = None

    def __post_init__(self):
        for name in ("input", "output", "geolocation"):
            if not getattr(self, name):
                raise ValueError(f"{name} is missing")
        if self.kernel not in KERNELS:
            raise ValueError(f"unknown kernel {self.kernel}")
        if self.type is not None and self.type not in TYPES:
            raise ValueError(f"unknown type {self.type}")
        if len(self.parameters) != 15:
            raise ValueError("15 projection parameters are needed")
        if self.pixel is not None and (self.pixel <= 0 or self.projection == 0 and self.pixel > 1):
            raise ValueError("pixel size out of range; that of geographic output is in degrees, at most 1")

    @classmethod
    def parse(cls, text: str) -> ResampleJob:
        p = parse_text(text)
        numbers = tuple(float(x) for x in p.get("OUTPUT_PROJECTION_PARAMETER", "").replace(",", " ").split())
        number = lambda k: float(p[k]) if k in p else None
        return cls(
            p.get("INPUT_FILENAME", ""), p.get("OUTPUT_FILENAME", ""), p.get("GEOLOCATION_FILENAME", ""), projection_number(p.get("OUTPUT_PROJECTION_NUMBER", "GEO")), (numbers + (0.0,) * 15)[:15] if len(numbers) <= 15 else numbers,
            p.get("KERNEL_TYPE", "NN").upper(), tuple(x.strip() for x in p.get("INPUT_SDS_NAME", "").split(";") if x.strip()), number("OUTPUT_PIXEL_SIZE"), number("ULX"), number("ULY"), p.get("OUTPUT_DATA_TYPE"),
        )

    def grid(self, lines: int, samples: int) -> Grid:
        return Grid(self.ulx or 0.0, self.uly or 0.0, self.pixel or 1.0, lines, samples)


# -- settings of many datasets at once

#: What every dataset has to set, and what holds where it does not (fixed values); without a limit as many tasks run
#: as there are processors, else this many.
REQUIRED = ("dsname", "outdir", "indir", "mapserverpath")
DEFAULTS = {"resample": "average", "doovr": "yes", "dolatest": "yes", "overview_ratio": "0.5"}
LEAST_LIMIT = 4


def with_defaults(settings: Column, defaults: dict[str, str] = DEFAULTS, cpus: int | None = None) -> Column:
    """A map of settings with the defaults of those it lacks or leaves empty."""
    every = {**defaults, "limit": str(cpus or os.cpu_count() or LEAST_LIMIT)}
    given = F.map_filter(settings, lambda _, v: F.coalesce(F.trim(v) != "", F.lit(False)))
    base = F.create_map(*[F.lit(x) for pair in every.items() for x in pair])
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(given, k)), given)


def missing(settings: Column, required: tuple[str, ...] = REQUIRED) -> Column:
    """The required settings that are not there or empty, in their order; an empty list where all is well."""
    return F.filter(F.array(*map(F.lit, required)), lambda n: F.coalesce(F.trim(F.try_element_at(settings, n)) == "", F.lit(True)))


def parsed_jobs(texts: DataFrame, text: str, *keys: str) -> DataFrame:
    """keys, input, output, projection, kernel, sds, pixel and error of parameter texts, many at once. A text that is
    no valid job has an error, and does not stop the others."""
    kinds = ", ".join(f"{k} {texts.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for t in pdf[text]:
                try:
                    j = ResampleJob.parse(t or "")
                    rows.append((j.input, j.output, j.projection, j.kernel, list(j.sds), j.pixel, None))
                except ValueError as e:
                    rows.append((None, None, None, None, None, None, str(e)))
            made = pd.DataFrame(rows, columns=["input", "output", "projection", "kernel", "sds", "pixel", "error"], index=pdf.index).astype({"projection": "Int32", "pixel": "Float64"})
            yield pd.concat([pdf[list(keys)], made], axis=1)

    return texts.select(*keys, text).mapInPandas(run, f"{kinds}, input string, output string, projection int, kernel string, sds array<string>, pixel double, error string")
