"""Safe parsing of dirty text columns.

ANSI mode is on in Spark 4: plain casts and ``to_date`` raise on bad input.
Everything here uses the ``try_`` family so a bad cell becomes NULL and the
row is kept, which is what the batch jobs expect from dirty CSV input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Input text formats of the incident and market files.
EVENT_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"
MARKET_DATE_FORMAT = "yyyy-MM-dd"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_date(col: str | Column, fmt: str = EVENT_TS_FORMAT) -> Column:
    """Text -> date, NULL when it does not parse."""
    return F.try_to_date(_c(col), fmt)


def safe_timestamp(col: str | Column, fmt: str = EVENT_TS_FORMAT) -> Column:
    """Text -> timestamp, NULL when it does not parse."""
    return F.try_to_timestamp(_c(col), F.lit(fmt))


def year_or_null(col: str | Column, fmt: str = EVENT_TS_FORMAT) -> Column:
    """Calendar year of a text timestamp; NULL (row kept) when unparsable."""
    return F.year(safe_timestamp(col, fmt))


def pad_key(col: str | Column, width: int = 4, fill: str = "0") -> Column:
    """Left-pad a key to ``width``; like the reference it also truncates."""
    return F.lpad(_c(col).cast("string"), width, fill)


def cast_columns(df: DataFrame, rule: Callable[[str], DataType | None]) -> DataFrame:
    """Cast every column by a name rule in one projection.

    ``rule(name)`` returns the target type or ``None`` to leave the column
    alone. ``try_cast`` keeps bad cells as NULL instead of failing the job.
    """
    cols = []
    for name in df.columns:
        target = rule(name)
        cols.append(F.col(name) if target is None
                    else F.col(name).try_cast(target).alias(name))
    return df.select(*cols)


def bool_text_flag(col: str | Column, null_as_zero: bool = True) -> Column:
    """Boolean text -> 0/1.

    ``null_as_zero=True`` is the weekly-feature form: anything but a
    case-insensitive ``true`` is 0. ``False`` is the rate-report form: exact
    ``'true'`` is 1, other text 0, and NULL stays NULL (skipped by ``sum``).
    """
    c = _c(col).cast("string")
    if null_as_zero:
        return F.when(F.lower(F.trim(c)) == "true", 1).otherwise(0)
    return (c == "true").cast("int")


def in_list_flag(col: str | Column, values: Iterable) -> Column:
    """1 when the value is in ``values``; 0 otherwise, NULL included."""
    return F.when(_c(col).isin(list(values)), 1).otherwise(0)


def first_matching_label(col: str | Column, labels: Iterable[str]) -> Column:
    """C11: first label (in list order) that occurs in the text, else NULL.

    Case-sensitive substring test; one label per value.
    """
    c = _c(col)
    return F.coalesce(*[F.when(c.contains(lab), F.lit(lab)) for lab in labels])


def int_text_in_range(col: str | Column, low_exclusive: int, high_inclusive: int) -> Column:
    """True when the text is an integer with low < value <= high."""
    v = _c(col).try_cast("int")
    return v.isNotNull() & (v > low_exclusive) & (v <= high_inclusive)


def header_or_unknown(col: str | Column, default: str = "unknown") -> Column:
    """Missing or empty header value -> ``default``."""
    return F.coalesce(F.nullif(_c(col), F.lit("")), F.lit(default))


def digits_only(col: str | Column) -> Column:
    """D3 helper: the text is a non-empty run of ASCII digits."""
    return _c(col).rlike("^[0-9]+$")
