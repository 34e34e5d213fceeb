"""Line-oriented jobs: substring label means and file merging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import first_matching_label

# Substrings searched in the n-gram words, in match order.
NGRAM_SUBSTRINGS = ("nu", "chi", "haw")


def label_mean_by_year(ngrams: DataFrame, labels: Sequence[str] = NGRAM_SUBSTRINGS,
                       word: str = "word", year: str = "year", volume: str = "volume",
                       out: str = "avg_volume") -> DataFrame:
    """Mean volume per (year text, first matching substring).

    A word counts once, under the first label of ``labels`` it contains
    (case-sensitive); words with no label are dropped.
    """
    labeled = ngrams.select(F.col(year).alias("year"),
                            first_matching_label(word, labels).alias("substring"),
                            F.col(volume).alias("volume"))
    return (labeled.where(F.col("substring").isNotNull())
            .groupBy("year", "substring").agg(F.avg("volume").alias(out)))


def words_of(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every whitespace token of every text, whole texts, in one generator."""
    tokens = F.filter(F.split(F.col(text), r"\s+"), lambda t: t != "")
    return df.select(*keep, F.explode(tokens).alias("word"))


def text_lines(df: DataFrame, text: str, key: Sequence[str]) -> DataFrame:
    """Lines of a text column with their position, keyed for stable order."""
    return df.select(*key, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def merge_lines(sources: Mapping[str, DataFrame], order_key: Sequence[str]) -> DataFrame:
    """Concatenation of several line frames in argument order.

    Each frame must hold ``order_key`` columns and ``line``; the result
    carries (source_no, *order_key) so a later ``orderBy`` or sorted write
    reproduces the concatenated file order.
    """
    parts = [df.select(F.lit(i).alias("source_no"), F.lit(name).alias("source"), *order_key, "line")
             for i, (name, df) in enumerate(sources.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
