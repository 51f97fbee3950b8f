"""Casts, keys and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def to_long(value: Column) -> Column:
    """Whole number or null. ``512.0``, as exports write a column with gaps, is 512."""
    return F.coalesce(
        value.try_cast("bigint"), value.try_cast("decimal(38,6)").try_cast("bigint")
    )


def to_decimal(value: Column, kind: str) -> Column:
    """Exact amount or null; text that is no number, and NaN, give null."""
    return value.try_cast(kind)


def to_date(value: Column) -> Column:
    """Date from ``yyyy-MM-dd`` text, or null; month 13 gives null, not an error.

    The shape is checked apart because the cast also takes ``2024`` or ``2024-1-1``; both
    together cost half of what parsing with a pattern does.
    """
    return F.when(value.rlike(DATE_SHAPE), value.try_cast("date"))


def to_instant(value: Column) -> Column:
    """Timestamp in Spark's default format, or null."""
    return F.try_to_timestamp(value)


def blank(value: Column) -> Column:
    """Null or empty."""
    return value.isNull() | (value == "")


def typed_null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def minute_of(instant: Column) -> Column:
    return F.date_trunc("minute", instant)


def month_key(instant: Column) -> Column:
    """``yyyyMM`` text."""
    return F.date_format(instant, "yyyyMM")


def date_key(day: Column) -> Column:
    """``yyyyMMdd`` as an int, by arithmetic; years before 1, which the format counts backwards, by the format."""
    parts = F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)
    return F.when(F.year(day) > 0, parts).otherwise(F.date_format(day, "yyyyMMdd").cast("int"))


def weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def clamp(value: Column, low, high) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the number with leading zeros, longer numbers in full."""
    return F.format_string(f"{prefix}%0{width}d", number)


def leading_number(name: Column) -> Column:
    """First run of digits in a file name: 779 for ``779.parquet``, 12 for ``part-00012-x``."""
    return F.regexp_substr(name, F.lit("[0-9]+")).try_cast("bigint")
