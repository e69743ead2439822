"""Casts, text rules and column selection, all as built-in expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_timestamp(c: Column) -> Column:
    """String to timestamp in the default formats; unreadable text becomes NULL."""
    return F.try_to_timestamp(c)


def parse_boolean(c: Column) -> Column:
    return c.try_cast("boolean")


def parse_double(c: Column) -> Column:
    return c.try_cast("double")


def mentions(c: Column, word: str) -> Column:
    """1 if the text holds the word in any case, else 0; NULL text gives 0."""
    return F.when(F.lower(c).contains(word.lower()), 1).otherwise(0)


def is_blank(c: Column) -> Column:
    """NULL, empty or spaces only. Tabs count as text."""
    return c.isNull() | (F.trim(c) == "")


def default_url(url: Column, media_id: Column, base_url: str) -> Column:
    return F.when(is_blank(url), F.concat(F.lit(base_url), media_id)).otherwise(url)


# What counts as a number in text. A cast alone also takes Java's type suffixes ("1d"),
# hexadecimal floats and "nan", and turns numbers out of range into infinity.
DECIMAL_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$"
INFINITE_TEXT = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def lenient_number(df: DataFrame, name: str) -> Column:
    """Number in a text or numeric column; anything unreadable becomes NULL.

    Whole numbers and decimals stay as they are: as doubles they would lose digits.
    """
    c = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return c
    if not isinstance(kind, T.StringType):
        return skip_nan(c)
    number = c.try_cast("double")
    in_range = F.abs(number) != float("inf")
    return F.when((c.rlike(DECIMAL_TEXT) & in_range) | c.rlike(INFINITE_TEXT), number)


def whole_count(df: DataFrame, name: str) -> Column:
    """Lenient number, NULL as 0, cut toward zero; infinity raises."""
    return F.coalesce(lenient_number(df, name), F.lit(0)).cast("bigint")


def skip_nan(c: Column) -> Column:
    """NaN as NULL, so that aggregates pass over it."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def amount(df: DataFrame, name: str) -> Column:
    """Column to be summed: decimals and integers as they are (exact), NaN as NULL."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return skip_nan(F.col(name))
    return F.col(name)


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, and 0 when there is no whole."""
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def round_percent(x: Column) -> Column:
    """Two decimals, judged on the exact binary value, exact halves to even.

    Valid for 0 <= x <= 100. The value is scaled by a power of two, which is exact, so
    the comparison with one half runs on integers: 2.675 (stored slightly below) gives
    2.67, 3.125 (stored exactly) gives 3.12. bround() looks at the shortest decimal text
    instead and would give 2.68 for the first.
    """
    unit = 1 << 46
    scaled = x * F.lit(float(unit))
    whole = F.floor(scaled).cast("bigint")
    rest = (scaled - whole) * 100
    hundredths = whole * 100 + F.floor(rest).cast("bigint")
    low = F.shiftright(hundredths, 46)
    left_over = hundredths - F.shiftleft(low, 46)
    half = F.lit(unit >> 1)
    more = (left_over > half) | (
        (left_over == half) & ((rest > F.floor(rest)) | (low % 2 == 1))
    )
    return (low + F.when(more, 1).otherwise(0)) / F.lit(100.0)


def run_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd_HH-mm-ss")


def rename(df: DataFrame, old: str, new: str, optional: bool = False) -> DataFrame:
    """Rename that raises where the built-in one would do nothing or make a duplicate."""
    if old not in df.columns:
        if optional:
            return df
        raise ValueError(f"no column {old!r} to rename; found {df.columns}")
    if new in df.columns and new != old:
        raise ValueError(f"cannot rename {old!r}: column {new!r} already exists")
    return df.withColumnRenamed(old, new)


def transform_present(
    df: DataFrame, changes: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """Apply each change to its column in place, skipping columns the table lacks."""
    present = {c: change(F.col(c)) for c, change in changes.items() if c in df.columns}
    return df.withColumns(present) if present else df


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)
