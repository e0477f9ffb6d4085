"""Small column expressions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The day number of 1995-01-01 in the integer calendar keys.
DAY_KEY_EPOCH = "1995-01-01"
DAY_KEY_OFFSET = 2449719


def yes_flag(name: str) -> Column:
    """1 for a Y in either case, 0 for anything else including NULL."""
    return F.when(F.upper(F.trim(name)) == "Y", 1).otherwise(0)


def open_ended_flag(end_date: str) -> Column:
    """1 while a record version has no end date."""
    return F.when(F.col(end_date).isNull(), 1).otherwise(0)


def quotient(part: str | Column, whole: str | Column) -> Column:
    """part / whole as double, NULL when ``whole`` is 0 or NULL."""
    part, whole = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def ratio(part: str | Column, whole: str | Column, scale: int = 4) -> Column:
    """part / whole as decimal with ``scale`` digits, halves rounded away from zero.

    Both are amounts in hundredths or whole numbers. They are divided as whole numbers, so
    sums of any length keep all digits. NULL when ``whole`` is 0 or NULL.
    """
    part, whole = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    n, d = ((c.cast("decimal(26,2)") * 100).cast("decimal(28,0)") for c in (part, whole))
    twice = F.abs(n) * (2 * 10**scale) + F.abs(d)
    size = F.call_function("div", twice, F.nullif(F.abs(d) * 2, F.lit(0).cast("decimal(28,0)")))
    sign = F.when((n < 0) != (d < 0), -1).otherwise(1)
    return ((size * sign).cast("decimal(19,0)") / 10**scale).cast(f"decimal(18,{scale})")


def zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def day_key(day: Column) -> Column:
    """Integer calendar key of a date."""
    return F.datediff(day.cast("date"), F.lit(DAY_KEY_EPOCH).cast("date")) + DAY_KEY_OFFSET


def date_bucket(key: str | Column, low: Column, high: Column, width: int = 365) -> Column:
    """Bucket number of a date key: NULL when unknown, -1 outside [low, high]."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(key.between(low, high), F.floor((key - low) / width).cast("int")).otherwise(
        F.when(key.isNotNull(), F.lit(-1))
    )
