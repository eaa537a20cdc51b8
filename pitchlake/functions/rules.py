"""NULL handling, domain rules and small predicates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    """NULL or nothing but spaces."""
    return c.isNull() | (F.trim(c) == "")


def blank_as_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def null_if(c: Column, sentinel) -> Column:
    return F.nullif(c, F.lit(sentinel))


def null_unless(c: Column, low=None, high=None) -> Column:
    """Keep values inside the bounds (either may be open), everything else becomes NULL."""
    inside = F.lit(True)
    if low is not None:
        inside = inside & (c >= low)
    if high is not None:
        inside = inside & (c <= high)
    return F.when(inside, c)


def remap(c: Column, mapping: Mapping[str, str], ignore_case: bool = False) -> Column:
    """Replace listed values, keep the others."""
    probe = F.lower(c) if ignore_case else c
    out = None
    for old, new in mapping.items():
        hit = probe == (old.lower() if ignore_case else old)
        out = F.when(hit, F.lit(new)) if out is None else out.when(hit, F.lit(new))
    return c if out is None else out.otherwise(c)


def blank_to(c: Column, default: str) -> Column:
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)


def fallback(first: Column, *others: Column) -> Column:
    return F.coalesce(first, *others)


def coalesce_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def falsy_default(c: Column, default) -> Column:
    """Value for a point field: NULL becomes the default (zero and '' already are their defaults)."""
    return F.coalesce(c, F.lit(default))


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero denominator."""
    return F.try_divide(numerator, denominator)


def ratio(numerator: Column, denominator: Column, scale: int = 1, digits: int = 2) -> Column:
    """``numerator * scale / denominator`` of whole numbers, rounded half away from zero.

    Division happens in decimal, so a tie such as 0.025 is rounded as written and not as its
    binary neighbour. A zero denominator gives NULL.
    """
    top = numerator.cast("decimal(20,0)") * F.lit(scale).cast("decimal(6,0)")
    bottom = F.nullif(denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(top / bottom, digits).cast("double")


# --- predicates ---------------------------------------------------------------------------------


def between(name: str, low, high, keep_null: bool = False) -> Column:
    c = F.col(name)
    inside = c.between(low, high)
    return (c.isNull() | inside) if keep_null else inside


def nonblank(name: str) -> Column:
    return ~is_blank(F.col(name))


def keep_in(name: str, values: Sequence) -> Column:
    return F.col(name).isin(list(values))


def contains(name: str, text: str) -> Column:
    """Case-sensitive substring test."""
    return F.col(name).contains(text)


def within_last(name: str, hours: int, now: dt.datetime | None = None) -> Column:
    """Rows of the ``hours`` that end now; a fixed ``now`` makes the window repeatable."""
    upper = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    return F.col(name).between(upper - F.make_dt_interval(hours=F.lit(hours)), upper)


def bad_format(name: str, pattern: str) -> Column:
    """Non-blank text that does not match ``pattern``."""
    c = F.col(name)
    return ~is_blank(c) & ~c.rlike(pattern)


def cast_failure(name: str, type_name: str) -> Column:
    """Non-blank text whose safe cast is NULL."""
    c = F.col(name)
    cast = F.try_to_date(c) if type_name == "date" else c.try_cast(type_name)
    return ~is_blank(c) & cast.isNull()
