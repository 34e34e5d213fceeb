"""Keyed message table and its scans.

The parsed table is one row per row key, latest put wins. The scans are
plain column predicates, so on a Parquet copy of the table they become
pushed filters on the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import utc_month_label
from ..sources.text import parse_messages
from .aggregates import latest_per_key


def message_table(raw: DataFrame, path: str = "path", text: str = "text",
                  put_order: str | None = None) -> DataFrame:
    """A8 + B8: parse messages and keep one row per key: the greatest
    ``put_order``, a column of ``raw`` that each message carries along (the
    parsed timestamp when not given)."""
    if put_order is not None:
        parsed = parse_messages(raw, path, text, keep=[put_order])
        return latest_per_key(parsed, "row_key", put_order).drop(put_order)
    parsed = parse_messages(raw, path, text)
    return latest_per_key(parsed.withColumn("_v", version_order(parsed, "ts")), "row_key", "_v").drop("_v")


def version_order(parsed: DataFrame, order: str = "ts"):
    """Order of versions of one key: the timestamp, ties broken by a content
    hash, so reruns (and retried tasks) pick the same version."""
    return F.struct(F.col(order).alias("o"), F.xxhash64(*[F.col(c) for c in parsed.columns]).alias("h"))


def message_condition(recipient: str | None = None, date_substring: str | None = None,
                      month: str | None = None):
    """D8-D10 predicate: exact recipient AND case-insensitive date-text
    substring AND typed ``yyyy-MM`` month (UTC) of the parsed timestamp."""
    cond = F.lit(True)
    if recipient is not None:
        cond = cond & (F.col("recipient") == F.lit(recipient))
    if date_substring is not None:
        cond = cond & F.lower(F.col("date_text")).contains(date_substring.lower())
    if month is not None:
        cond = cond & (utc_month_label("ts") == F.lit(month))
    return cond


def scan_latest(parsed: DataFrame, cond, key: str = "row_key", order: str = "ts",
                columns: tuple[str, ...] = ("row_key", "recipient", "date_text", "body")) -> DataFrame:
    """D8-D10 over the keyed table without building it: one pass and one
    grouping by key keep, of the latest version, whether it matches and, only
    if it does, the columns asked for. Same rows as filtering
    ``message_table``, but bodies that do not match are never shuffled."""
    hit = F.coalesce(cond, F.lit(False))
    found = F.struct(hit.alias("hit"), F.when(hit, F.struct(*columns)).alias("row"))
    latest = parsed.groupBy(key).agg(F.max_by(found, version_order(parsed, order)).alias("m"))
    return latest.where("m.hit").select("m.row.*")


def filter_messages(table: DataFrame, recipient: str | None = None, date_substring: str | None = None,
                    month: str | None = None, columns: tuple[str, ...] = ("row_key", "recipient",
                                                                          "date_text", "body")) -> DataFrame:
    """Exact recipient AND case-insensitive substring of the date
    text (and/or the typed ``yyyy-MM`` month of the parsed timestamp), then
    the requested columns."""
    return table.where(message_condition(recipient, date_substring, month)).select(*columns)
