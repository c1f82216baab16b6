"""Column naming and coercion helpers."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Raw names that have a canonical spelling.
CANONICAL_NAMES = {"userid": "user_id", "movieid": "movie_id", "zipcode": "zip_code"}

# Largest epoch second a nanosecond clock can hold (year 2262).
MAX_EPOCH_SECOND = 9223372036


def snake_name(name: str) -> str:
    """The runs of ASCII letters and digits, in lower case, joined by underscores."""
    return "_".join(re.findall("[a-z0-9]+", name.lower()))


def standardize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])


def canonicalize_names(df: DataFrame) -> DataFrame:
    """Snake names, canonical spellings, and only the first column of each name.

    Renamed by position first: Spark resolves names without case, so two raw
    spellings of one name cannot be told apart by name.
    """
    names = [CANONICAL_NAMES.get(snake_name(c), snake_name(c)) for c in df.columns]
    positions = [f"_c{i}" for i in range(len(names))]
    first = {name: pos for name, pos in reversed(list(zip(names, positions)))}
    return df.toDF(*positions).select(*[F.col(first[n]).alias(n) for n in dict.fromkeys(names)])


def require_columns(tables: dict[str, tuple[DataFrame, Iterable[str]]]) -> None:
    """One error that lists every missing column of every table."""
    gaps = []
    for name, (df, required) in tables.items():
        missing = sorted(set(required) - set(df.columns))
        if missing:
            gaps.append(f"{name}: {', '.join(missing)}")
    if gaps:
        raise ValueError("missing required columns - " + "; ".join(gaps))


def require_rows(tables: dict[str, DataFrame]) -> None:
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise ValueError("no rows in: " + ", ".join(empty))


def time_column(df: DataFrame) -> str:
    for name in ("timestamp_dt", "timestamp"):
        if name in df.columns:
            return name
    raise ValueError("expected a timestamp_dt or timestamp column")


def numeric(col: Column) -> Column:
    """Text as double, or NULL where it is no plain decimal number.

    The cast alone would also take Java literals (``1d``, ``0x1p3``), ``NaN`` and ``Infinity``:
    a plain number ends in a digit or a point and has no ``x``.
    """
    text = col.cast("string")
    last = F.substring(F.rtrim(text), -1, 1)
    plain = last.isin(*"0123456789.") & ~F.contains(text, F.lit("x")) & ~F.contains(text, F.lit("X"))
    return F.when(plain, text.try_cast("double"))


def numeric_column(df: DataFrame, name: str) -> Column:
    """``numeric`` of a text column; a column that is a number already is only cast, NaN to NULL."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return plain_number(df, name).cast("double")
    return numeric(F.col(name))


def with_numbers(df: DataFrame, names: Iterable[str], suffix: str = "_number", whole: bool = False) -> DataFrame:
    """Adds the numeric value of each named column.

    Values of text pass through a one-row generator: the optimizer copies a plain projection into
    every later filter and join condition and would parse each text again there. Numbers stay plain, and with
    ``whole`` those of integral types keep their type, so a filter on them reaches the scan.
    """
    names = list(names)
    texts = [n for n in names if not isinstance(df.schema[n].dataType, T.NumericType)]
    if texts:
        df = df.select("*", F.inline(F.array(F.struct(*[numeric_column(df, n).alias(n + suffix) for n in texts]))))
    return df.withColumns({n + suffix: plain_number(df, n) if whole else plain_number(df, n).cast("double") for n in names if n not in texts})


def plain_number(df: DataFrame, name: str) -> Column:
    """A number column as it is, of fractional types as double with NULL for NaN."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name)
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def epoch_timestamp(seconds: Column) -> Column:
    """Timestamp of epoch seconds, NULL outside the range a nanosecond clock holds."""
    inside = (seconds >= -MAX_EPOCH_SECOND) & (seconds <= MAX_EPOCH_SECOND)
    return F.timestamp_seconds(F.when(inside, seconds))


def interaction_projection(df: DataFrame) -> DataFrame:
    return df.select("user_id", "movie_id", "rating")
