"""Seasons, date parts and ages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SEASON_START_MONTH = 7


def season_label(start_year: Column) -> Column:
    """2024 -> '2024/25'."""
    return F.concat(
        start_year.cast("string"), F.lit("/"), F.right((start_year + 1).cast("string"), F.lit(2))
    )


def season_start(day: Column) -> Column:
    """Year in which the season of ``day`` began; a season begins in July."""
    return F.year(day) - F.when(F.month(day) >= SEASON_START_MONTH, 0).otherwise(1)


def season_of(day: Column) -> Column:
    return season_label(season_start(day))


def date_parts(day: Column) -> dict[str, Column]:
    """Calendar attributes; days of the week count from 0 = Sunday, weeks are ISO weeks."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day) - 1,
        "day_name": F.date_format(day, "E"),
        "month_name": F.date_format(day, "MMM"),
        "quarter": F.quarter(day),
        "week_of_year": F.weekofyear(day),
    }


def age(born: Column, as_of: dt.date | None = None) -> Column:
    """Completed years on ``as_of`` (today when not given)."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.floor(F.months_between(today, born) / 12).cast("int")
