"""Text and CSV sources.

File readers take an explicit schema wherever the reference relied on
inference: inference is an extra full pass over the input. The line-level
parsers (``parse_csv_lines``, ``naive_split``, ``parse_ngram_lines``,
``parse_messages``) work on any frame holding a text column, so the same
logic serves files and text derived from tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.parsing import digits_only, header_or_unknown, int_text_in_range


# ---------------------------------------------------------------- A1 / A3 / A5
def read_header_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
                    sep: str = ",") -> DataFrame:
    """A1/A3: header CSV. Without a schema every column is a string
    (no inference pass); quoted separators are honoured."""
    reader = (spark.read.option("header", True).option("sep", sep)
              .option("mode", "PERMISSIVE").option("multiLine", False))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_declared_table(spark: SparkSession, path: str, ddl: str, sep: str = ",") -> DataFrame:
    """A5: headerless delimited file with a declared schema (Hive
    ``ROW FORMAT DELIMITED``). An unparsable cell becomes NULL, so a stray
    header line turns into an all-NULL row."""
    return spark.read.schema(ddl).option("sep", sep).option("mode", "PERMISSIVE").csv(path)


def declare_table(spark: SparkSession, name: str, ddl: str, location: str, sep: str = ",") -> None:
    """A5: declare a delimited folder as a catalogue table, read by name from
    then on; ``load_table`` fills it."""
    quoted = {"\t": "\\t"}.get(sep, sep)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING csv OPTIONS (sep '{quoted}', mode 'PERMISSIVE') "
              f"LOCATION '{location}'")


def load_table(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """A5: bulk load: the rows are added to the files of a declared table."""
    rows.select(*spark.table(name).columns).write.insertInto(name)


# ---------------------------------------------------------------- A7
def read_csv_dir(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """The lines (``value``) of every ``glob`` file of a folder; no file
    decides on the columns of the others."""
    return spark.read.option("pathGlobFilter", glob).text(path)


def csv_field_count(line: str | Column) -> Column:
    """Fields of a CSV line: its commas outside of quotes, plus one. Empty
    fields count, whatever their place."""
    plain = F.regexp_replace(F.col(line) if isinstance(line, str) else line, r'"(?:[^"]|"")*"', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1


def artist_durations(lines: DataFrame, line: str = "value", artist_pos: int = 2,
                     duration_pos: int = 3, min_columns: int = 4) -> DataFrame:
    """A7 mapper: (artist, duration) from positional CSV fields.

    Lines with fewer than ``min_columns`` fields are skipped, as are durations
    that are not numbers (which also removes header rows). Each line is judged
    by its own fields; empty ones are fields too, and a doubled quote inside quotes is a
    quote.
    """
    width = max(artist_pos, duration_pos) + 1
    ddl = ", ".join(f"c{i} string" for i in range(width))
    cells = F.from_csv(F.col(line), ddl, {"mode": "PERMISSIVE", "escape": '"'})
    rows = lines.where(csv_field_count(line) >= min_columns).select(cells.alias("c"))
    duration = F.trim(F.col(f"c.c{duration_pos}")).try_cast("double")
    return (rows.select(F.trim(F.coalesce(F.col(f"c.c{artist_pos}"), F.lit(""))).alias("artist"),
                        duration.alias("duration"))
            .where(F.col("duration").isNotNull() & ~F.isnan("duration")))


# ---------------------------------------------------------------- A4
def parse_csv_lines(df: DataFrame, line: str, ddl: str, header: str | None = None) -> DataFrame:
    """Quote-aware parse of CSV text lines (same parser as the CSV reader).

    ``header``: a line equal to it is removed first (value equality, so any
    repeat of the header inside the data goes too).
    """
    src = df if header is None else df.where(F.col(line) != F.lit(header))
    parsed = F.from_csv(F.col(line), ddl, {"mode": "PERMISSIVE"})
    return src.select("*", parsed.alias("_csv")).select("*", "_csv.*").drop("_csv")


def naive_split(df: DataFrame, line: str, positions: dict[str, int],
                header: str | None = None) -> DataFrame:
    """A4: positional comma split of raw lines, as the RDD jobs did.

    A quoted comma shifts every later field; a missing position gives NULL.
    """
    src = df if header is None else df.where(F.col(line) != F.lit(header))
    parts = F.split(F.col(line), ",")
    return src.select("*", *[F.try_element_at(parts, F.lit(i + 1)).alias(name)
                             for name, i in positions.items()])


# ---------------------------------------------------------------- A6
def read_ngram_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_ngram_lines(spark.read.text(path), "value")


def parse_ngram_lines(df: DataFrame, line: str, max_year: int = 2024) -> DataFrame:
    """``word year occurrences volume`` whitespace lines.

    Lines with fewer than four tokens or with a year outside
    ``0 < year <= max_year`` are dropped. ``year`` keeps its original text.
    """
    tokens = F.split(F.trim(F.col(line)), r"\s+")
    t = df.select(tokens.alias("t"))
    return (t.where(F.size("t") >= 4)
            .select(F.col("t")[0].alias("word"), F.col("t")[1].alias("year"),
                    F.col("t")[2].alias("occurrences"),
                    F.col("t")[3].try_cast("double").alias("volume"))
            .where(int_text_in_range("year", 0, max_year)))


# ---------------------------------------------------------------- A8
def _message_bytes(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", "length", F.try_validate_utf8(F.col("content").cast("string")).alias("text"))


def read_message_files(spark: SparkSession, root: str) -> DataFrame:
    """One message per file anywhere below ``root`` -> (path, text). Bytes are
    decoded strictly; a file that is not UTF-8 is no message and is skipped (see
    ``unreadable_messages``). Spark packs small files into tasks by size."""
    return _message_bytes(spark, root).where("text is not null").select("path", "text")


def unreadable_messages(spark: SparkSession, root: str) -> DataFrame:
    """The files that ``read_message_files`` skips: path, length."""
    return _message_bytes(spark, root).where("text is null").select("path", "length")


def _header(block: Column, name: str) -> Column:
    # Header value plus folded continuation lines (lines starting with blank).
    return F.regexp_extract(block, rf"(?im)^{name}:[ \t]*(.*(?:\r?\n[ \t]+.*)*)", 1)


def parse_messages(df: DataFrame, path: str = "path", text: str = "text",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Mail-style text -> (row_key, recipient, date_text, sender, body, ts).

    The row key is the last two path parts (``folder/file``). Header block
    ends at the first blank line; without one the body is empty. Missing
    headers become ``'unknown'``; line breaks and tabs are removed from the
    recipient only. ``ts`` parses ``d MMM yyyy HH:mm:ss Z`` out of the date
    text (Spark cannot parse day names or zone names). Columns in ``keep``
    come along.
    """
    t = F.col(text)
    sep = F.regexp_instr(t, F.lit(r"\r?\n\r?\n"))
    block = F.when(sep > 0, F.substring(t, F.lit(1), sep - 1)).otherwise(t)
    body = F.when(sep > 0, F.regexp_extract(t, r"(?s)^.*?\r?\n\r?\n(.*)$", 1)).otherwise(F.lit(""))
    recipient = F.translate(_header(block, "to"), "\n\t\r", "")
    date_text = _header(block, "date")
    stamp = F.regexp_extract(date_text, r"(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} [+-]\d{4})", 1)
    ts = F.try_to_timestamp(F.initcap(stamp), F.lit("d MMM yyyy HH:mm:ss Z"))
    return df.select(
        F.regexp_extract(F.col(path), r"([^/]+/[^/]+)$", 1).alias("row_key"),
        header_or_unknown(recipient).alias("recipient"),
        header_or_unknown(date_text).alias("date_text"),
        header_or_unknown(_header(block, "from")).alias("sender"),
        body.alias("body"),
        ts.alias("ts"),
        *keep,
    )


__all__ = ["read_header_csv", "read_declared_table", "read_csv_dir", "artist_durations",
           "parse_csv_lines", "naive_split", "read_ngram_lines", "parse_ngram_lines",
           "read_message_files", "unreadable_messages", "parse_messages", "digits_only"]
