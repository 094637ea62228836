"""Column helpers. Each returns a Column built from Spark's own functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def cast_or_default(column: str | Column, type: str, default: object = None) -> Column:
    """Cast; text that does not parse gives the default."""
    value = _c(column).try_cast(type)
    return value if default is None else F.coalesce(value, F.lit(default))


def case_flip(column: str | Column) -> Column:
    """Upper-case text becomes lower case, anything else upper case."""
    c = _c(column)
    return F.when(F.upper(c) == c, F.lower(c)).otherwise(F.upper(c))


def recode(column: str | Column, mapping: dict, default: object = None) -> Column:
    """Map values by a dictionary; a value that is not listed gives the default."""
    c = _c(column)
    out = None
    for key, value in mapping.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out.otherwise(F.lit(default))


def keep_or_other(column: str | Column, kept: Sequence, other: str = "Other") -> Column:
    c = _c(column)
    return F.when(c.isin(list(kept)), c).otherwise(F.lit(other))


def is_numeric_text(column: str | Column) -> Column:
    return _c(column).rlike("^[0-9]+$")


def safe_ratio(top: str | Column, bottom: str | Column, default: object = None) -> Column:
    """Division that gives the default when the denominator is zero or null."""
    return F.when(_c(bottom) > 0, _c(top) / _c(bottom)).otherwise(F.lit(default))


def whole(column: str | Column) -> Column:
    """Truncate to an integer."""
    return _c(column).cast("int")


def first_parsed(column: str | Column, formats: Sequence[str]) -> Column:
    """Timestamp by the first format that fits."""
    return F.coalesce(*[F.try_to_timestamp(_c(column), F.lit(f)) for f in formats])


def month_key(column: str | Column) -> Column:
    return F.date_format(_c(column), "yyyyMM")


def weekday_name(column: str | Column) -> Column:
    return F.date_format(_c(column), "EEEE")


def month_name(column: str | Column) -> Column:
    return F.date_format(_c(column), "MMMM")


def json_primary(column: str | Column, schema: str, position: int = 0) -> Column:
    """One element of a JSON list; null when the text does not parse or is too short."""
    return F.get(F.from_json(_c(column), schema), F.lit(position))


def parse_map_literal(column: str | Column) -> Column:
    """A map written as a Python literal with single quotes."""
    return F.from_json(F.regexp_replace(_c(column), "'", '"'), "map<string,string>")


def left_text(column: str | Column, n: int) -> Column:
    return F.substring(_c(column), 1, n)


def drop_first(column: str | Column) -> Column:
    c = _c(column)
    return F.substring(c, 2, 1 << 30)


def first_of(column: str | Column, separator: str = ":::") -> Column:
    """First entry of a separated list, in lower case."""
    return F.lower(F.element_at(F.split(_c(column), separator), 1))


def keys_of(columns: Sequence[str]) -> Column:
    """``KEYS(n)``: names of the columns that have a value in this row."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns]))


def properties_of(columns: Sequence[str]) -> Column:
    """``PROPERTIES(n)``: the values present, as a map of text."""
    entries = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in columns])
    return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))


def any_in_list(column: str | Column, words: Sequence[str]) -> Column:
    """True when the text contains any of the words."""
    c = _c(column)
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(c, w))


def hash_bucket(key: str | Column, seed: int | str, buckets: int = 1000) -> Column:
    """Bucket 0..buckets-1 of a key, the same on any partitioning (first 32 bits of an md5)."""
    text = F.concat(F.lit(f"{seed}:"), _c(key).cast("string"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))
