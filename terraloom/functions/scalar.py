"""Column expressions for dates, paths, urls, flags and packed numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names, full ones before abbreviations, in calendar order (fixed values).
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
)


def _ymd(c: Column, pattern: str, y: int, m: int, d: int) -> Column:
    """Days beyond a month's end roll forward, as do months beyond a year's."""
    part = lambda k: F.try_to_number(F.regexp_extract(c, pattern, k), F.lit("9999")).cast("int")
    first = F.make_date(part(y), F.lit(1), F.lit(1))
    whole = F.date_add(F.add_months(first, part(m) - 1), part(d) - 1)
    return F.when(c.rlike(pattern), whole)


def _julian(c: Column, pattern: str) -> Column:
    year = F.regexp_extract(c, pattern, 1).try_cast("int")
    day = F.regexp_extract(c, pattern, 2).try_cast("int")
    return F.when(c.rlike(pattern), F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day - 1))


def date_of_name(c: Column, year: int) -> Column:
    """yyyymmdd of a file name or download line by the first naming rule that fits, else null. ``year`` completes
    names that hold only a month and a day."""
    rules = [
        _ymd(c, r".*/[A-Z]{2}[0-9]{2}[0-9]{6}([0-9]{4})([0-9]{2})([0-9]{2})", 1, 2, 3),
        _ymd(c, r".*/[A-Z]{2}[0-9]{2}[NS][0-9]{2}_[0-9]{6}[EW][0-9]{3}_[0-9]{6}([0-9]{4})([0-9]{2})([0-9]{2})", 1, 2, 3),
        _ymd(c, r".*/AST_L1[AB]E_[0-9]{3}_[0-9]{8}[0-9]{6}_([0-9]{2})([0-9]{2})([0-9]{4})", 3, 1, 2),
        _ymd(c, r".*/AST_L1B_[0-9]{3}([0-9]{2})([0-9]{2})([0-9]{4})", 3, 1, 2),
        _julian(c, r".*/[^/]*\.[A-Z]([0-9]{4})([0-9]{3})\."),
        _month_name(c, year),
        _julian(c, r"(?i).*/[^/]*\.([0-9]{4})([0-9]{3})\.(?:aqua|terra)"),
        _julian(c, r".*[/=]EO1[AH][0-9]{6}([0-9]{4})([0-9]{3})"),
        _julian(c, r".*[/=]LT[0-9][0-9]{6}([0-9]{4})([0-9]{3})"),
        _julian(c, r".*[/=]LE[0-9][0-9]{6}([0-9]{4})([0-9]{3})"),
    ]
    return F.date_format(F.coalesce(*rules), "yyyyMMdd").cast("int")


def _month_name(c: Column, year: int) -> Column:
    pattern = "(?i)(" + "|".join([*MONTHS, *(m[:3] for m in MONTHS)]) + ")([0-9]{2})"
    name = F.lower(F.substring(F.regexp_extract(c, pattern, 1), 1, 3))
    month = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), name).cast("int")
    day = F.regexp_extract(c, pattern, 2).try_cast("int")
    return F.when(c.rlike(pattern), F.date_add(F.make_date(F.lit(year), month, F.lit(1)), day - 1))


def julian_day(c: Column) -> Column:
    """yyyymmdd of a yyyyddd text or number."""
    s = c.cast("string")
    day = F.date_add(F.make_date(F.substring(s, 1, 4).try_cast("int"), F.lit(1), F.lit(1)), F.substring(s, 5, 3).try_cast("int") - 1)
    return F.date_format(day, "yyyyMMdd").cast("int")


def url_query(c: Column) -> Column:
    return F.regexp_extract(c, r"^[^?#]*(\?[^#]*)", 1)


def url_hash(c: Column) -> Column:
    return F.regexp_extract(c, r"^[^#]*(#.*)$", 1)


def url_path(c: Column) -> Column:
    """The path with its leading slash; without one, a slash and the host."""
    bare = F.regexp_extract(c, r"^(?:[^:/?#]+://)?([^?#]*)", 1)
    path = F.regexp_extract(bare, r"^[^/]*(/.*)$", 1)
    return F.when(path != "", path).otherwise(F.concat(F.lit("/"), bare))


def url_host(c: Column) -> Column:
    """Host without user and port."""
    return F.regexp_extract(c, r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def url_proto(c: Column) -> Column:
    """What stands before ://, or else the whole string."""
    return F.substring_index(c, "://", 1)


def form_encode(c: Column) -> Column:
    """Form encoding with lower-case hex: a space is +, line breaks go, letters, digits and .*()- stay."""
    plain = F.regexp_replace(c, r"[\r\n]", "")
    pieces = F.transform(
        F.split(plain, ""),
        lambda x: F.when(x == " ", "+").when(x.rlike(r"^[a-zA-Z0-9.*()\-]$"), x).otherwise(F.lower(F.regexp_replace(F.hex(F.encode(x, "UTF-8")), "(..)", "%$1"))),
    )
    return F.when(plain == "", "").otherwise(F.array_join(pieces, ""))


def base_name(c: Column) -> Column:
    """File name without directory and extension; .tar.* is one extension."""
    name = F.regexp_replace(c, r"^.*/", "")
    return F.regexp_replace(name, r"(?i)(\.tar\.[^.]*|\.[^.]*)$", "")


def extension(c: Column) -> Column:
    name = F.regexp_replace(c, r"^.*/", "")
    return F.lower(F.regexp_extract(name, r"(?i)\.(tar\.[^.]*|[^.]*)$", 1))


def directory(c: Column) -> Column:
    return F.regexp_extract(c, r"^(.*)/[^/]*$", 1)


def fix_path(c: Column) -> Column:
    return F.regexp_replace(c, "/+", "/")


def is_true(c: Column, default: bool = False) -> Column:
    x = F.lower(F.trim(c))
    return F.when(x.isin("yes", "true", "1"), True).when(x.isin("no", "false", "0"), False).otherwise(default)


def pack_dms(degrees: Column, limit: float = 360.0) -> Column:
    """Degrees as sign * (d * 1e6 + m * 1e3 + s); null beyond the limit."""
    a = F.abs(degrees)
    d = F.floor(a)
    m = F.floor((a - d) * 60)
    s = ((a - d) * 60 - m) * 60
    return F.when(a <= limit, F.signum(degrees) * (d * 1000000 + m * 1000 + s))


def sci_to_decimal(c: Column) -> Column:
    return c.try_cast("double")


def strip_comment(c: Column, variables: dict[str, str] | None = None) -> Column:
    """A configuration line with $(NAME) expanded, its # comment and all from the first unprintable character cut."""
    for name, value in (variables or {}).items():
        c = F.replace(c, F.lit(f"$({name})"), F.lit(value))
    c = F.regexp_replace(c, r"#.*$", "")
    return F.rtrim(F.regexp_replace(c, r"[^\x20-\x7e\t].*$", ""))


def comma_remove(c: Column, item: Column) -> Column:
    return F.array_join(F.array_remove(F.split(c, ","), item), ",")


def comma_add(c: Column, item: Column) -> Column:
    parts = F.split(c, ",")
    return F.when(F.array_contains(parts, item), c).when(c == "", item).otherwise(F.concat(c, F.lit(","), item))


def first_class(v: Column, steps: list[tuple[float, str]]) -> Column:
    """Name of the first class whose threshold is at or above the value."""
    out = F
    for limit, name in steps:
        out = out.when(v <= limit, name)
    return out.otherwise("none")


#: Lowest and highest value of each raster type (fixed values; the low end of int32 is one above the type's).
TYPE_RANGE = {
    "char8": (-128.0, 127.0), "uint8": (0.0, 255.0), "int8": (-128.0, 127.0), "int16": (-32768.0, 32767.0), "uint16": (0.0, 65535.0),
    "int32": (-2147483647.0, 2147483647.0), "uint32": (0.0, 4294967295.0), "float32": (-1e37, 1e37),
}


def convert_type(v: Column, source: str, target: str) -> Column:
    """Number in another raster type: rescaled by the ranges, rounded half away from zero, clamped."""
    low, high = TYPE_RANGE[target]
    s_low, s_high = TYPE_RANGE[source]
    x = v if source == target else F.lit(low) + v * F.lit((high - low) / (s_high - s_low))
    if target != "float32":
        x = F.when(x < 0, F.ceil(x - 0.5)).otherwise(F.floor(x + 0.5)).cast("double")
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))
