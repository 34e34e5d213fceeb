"""Date and time components."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def year_week(ts: str | Column) -> tuple[Column, Column]:
    """C4: calendar year and ISO week of a timestamp.

    Mixed on purpose, as in the reference: 2018-12-31 is (2018, week 1).
    """
    t = _c(ts)
    return F.year(t).alias("year"), F.weekofyear(t).alias("week_of_year")


def time_part(ts: str | Column, part: str) -> Column:
    """C4: one component; day of week counts Sunday as 1."""
    t = _c(ts)
    fn = {"hour": F.hour, "day_of_week": F.dayofweek, "month": F.month,
          "year": F.year, "week_of_year": F.weekofyear}[part]
    return fn(t)


def month_label(ts: str | Column) -> Column:
    """``yyyy-MM`` label of a timestamp."""
    return F.date_format(_c(ts), "yyyy-MM")


def utc_month_label(ts: str | Column) -> Column:
    """``yyyy-MM`` of an instant in UTC, whatever the session time zone."""
    return F.date_format(F.to_utc_timestamp(_c(ts), F.current_timezone()), "yyyy-MM")


def next_week(year: str | Column, week: str | Column, last_week: int = 52) -> tuple[Column, Column]:
    """C20: the week after (year, week); weeks >= ``last_week`` roll the year.

    Both outputs are computed from the original week in one projection (the
    reference rolled the year off the already advanced week, so the roll
    happened one week early).
    """
    y, w = _c(year), _c(week)
    roll = w >= last_week
    return (F.when(roll, y + 1).otherwise(y).alias("year"),
            F.when(roll, F.lit(1)).otherwise(w + 1).alias("week_of_year"))
