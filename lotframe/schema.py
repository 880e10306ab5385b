"""The listing record, and the four meanings of *missing*."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotframe.functions.text import py_strip

NA = "N/A"

_TEXT, _LIST = T.StringType(), T.ArrayType(T.StringType())
_KINDS: dict[str, T.DataType] = {"price": T.LongType(), "number_of_bids": T.IntegerType(), "year": T.IntegerType(), "mileage": T.IntegerType(), "convertible": T.BooleanType(), "listing_details": _LIST, "excerpt": _LIST}
_NAMES = (
    "url source title lot_number seller seller_type result high_bidder price sale_date number_of_bids vin year make model variant convertible "
    "engine transmission exterior_color interior_color mileage location country listing_details excerpt"
)
LISTING_SCHEMA = T.StructType([T.StructField(n, _KINDS.get(n, _TEXT)) for n in _NAMES.split()])
TYPES = {f.name: f.dataType for f in LISTING_SCHEMA}
#: Columns that are never rendered as N/A: numbers and the flag stay null.
_NOT_TEXT = {n for n, t in TYPES.items() if not isinstance(t, T.StringType)}


def render_missing(c: Column) -> Column:
    """Null or empty text is written as N/A."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(NA))


def quality_missing(c: Column, kind: T.DataType | None = None) -> Column:
    """Null, N/A or an empty list; a blank text is not missing."""
    if isinstance(kind, T.ArrayType):
        return c.isNull() | (F.size(c) == 0)
    if kind is None or isinstance(kind, T.StringType):
        return c.isNull() | (c.cast("string") == NA)
    return c.isNull()


def infer_missing(c: Column, kind: T.DataType | None = None) -> Column:
    """Null, N/A or a text of white space; other values never."""
    if kind is not None and not isinstance(kind, T.StringType):
        return c.isNull()
    return c.isNull() | (c == NA) | (py_strip(c) == "")


def value_match(c: Column, target, present: Column | None = None) -> Column:
    """The key is there and equals the target (null equals null). A typed column counts as there; pass ``present`` where
    the source knows better."""
    equal = c.eqNullSafe(F.lit(target))
    return equal if present is None else equal & present


_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def field_matches(df: DataFrame, name: str, target) -> Column | None:
    """``value_match`` of a column, by value as Python compares: numbers equal numbers of any width, and true and false equal
    1 and 0. None if no value of the column's type can equal the target."""
    kind, c = df.schema[name].dataType, F.col(name)
    if target is None:
        return c.isNull()
    if isinstance(target, str):
        return value_match(c, target) if isinstance(kind, T.StringType) else None
    if isinstance(kind, T.BooleanType):
        return value_match(c, bool(target)) if target in (0, 1) else F.lit(False)
    if not isinstance(kind, _NUMBERS):
        return None
    return F.coalesce(c == F.lit(int(target) if isinstance(target, bool) else target), F.lit(False))


def render(df: DataFrame) -> DataFrame:
    """A listing as it is written: text rendered by ``render_missing``, no country."""
    return df.select(*(F.col(c) if c in _NOT_TEXT else render_missing(F.col(c)).alias(c) for c in df.columns if c in TYPES and c != "country"))


def with_defaults(df: DataFrame, *others: str) -> DataFrame:
    """A listing as it is read: absent columns are added, and source, url, title, convertible and the lists get their
    defaults. N/A stays text. ``others`` are columns to keep in front."""
    default = {"source": F.lit("unknown"), "url": F.lit(""), "title": F.lit(""), "convertible": F.lit(False)}
    columns = []
    for f in LISTING_SCHEMA:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, T.ArrayType):
            c = F.coalesce(c, F.array().cast(f.dataType))
        elif f.name in default:
            c = F.coalesce(c, default[f.name])
        columns.append(c.alias(f.name))
    return df.select(*others, *columns)


def normalize_na(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """N/A back to null in text columns."""
    names = set(columns) if columns is not None else {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns({c: F.nullif(F.col(c), F.lit(NA)) for c in names})
