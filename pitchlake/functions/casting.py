"""Casts that turn bad text into NULL. ANSI mode stays on, so untrusted text always uses ``try_*``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_int(c: Column, via_double: bool = False) -> Column:
    """``'7'`` -> 7, ``'x'``/``''``/``'12.0'`` -> NULL; ``via_double`` also accepts ``'12.0'``."""
    return (c.try_cast("double") if via_double else c).try_cast("int")


def safe_long(c: Column, via_double: bool = False) -> Column:
    """64-bit variant; ``via_double`` truncates decimals (``'1000.7'`` -> 1000)."""
    return (c.try_cast("double") if via_double else c).try_cast("bigint")


def safe_double(c: Column) -> Column:
    return c.try_cast("double")


def safe_float(c: Column) -> Column:
    return c.try_cast("float")


def safe_date(c: Column) -> Column:
    return F.try_to_date(c)


def day_of(c: Column) -> Column:
    """Keep the day of a timestamp."""
    return F.to_date(c)


def flag01(predicate: Column) -> Column:
    """Comparison as 1/0; an unknown comparison stays NULL."""
    return predicate.cast("int")


def regex_int(c: Column, pattern: str, group: int = 1) -> Column:
    """Number captured by ``pattern``, NULL without a match."""
    return F.regexp_extract(c, pattern, group).try_cast("int")


def value_as_string(c: Column) -> Column:
    """Binary message payload as text."""
    return c.cast("string")


def parse_money(c: Column) -> Column:
    """Text such as ``+€5.90m``, ``€-131k`` or ``+-0`` as whole euros.

    The arithmetic is decimal, so ``€16.06m`` gives 16,060,000 and not one euro less.
    """
    text = F.lower(F.trim(c))
    amount = F.regexp_replace(text, "[^0-9.]", "").try_cast("decimal(20,4)")
    unit = (
        F.when(text.endswith("bn"), 1_000_000_000)
        .when(text.endswith("m"), 1_000_000)
        .when(text.endswith("k"), 1_000)
        .otherwise(1)
        .cast("decimal(10,0)")
    )
    sign = F.when(text.contains("-"), F.lit(-1)).otherwise(F.lit(1)).cast("decimal(1,0)")
    return (amount * unit * sign).try_cast("bigint")
