"""Mixing sources to target weights along a time-varying curriculum.

Every source has a base weight and a schedule: how its share of the batch
changes while training runs from t = 0 to t = 1. The schedule is integrated to
the cumulative demand of the source at t; a document that starts after ``c``
words of its source is needed when that demand reaches ``c``, so inverting the
demand gives the document its training position. A range sort by position
writes the curriculum in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, id_text, root_buckets, stored, text_or_empty, unit, with_task

# Share of a source over training time as (t, height) knots, linear between
# them; dealt to the sources in turn: falling, flat, rising.
SCHEDULES: tuple[tuple[tuple[float, float], ...], ...] = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)


def word_count(col: str = "text") -> Column:
    """Words of a text; null and empty texts have none."""
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float] = (1, 2, 3),
                   max_repeats: int = 3) -> DataFrame:
    """One row per source: ``source, docs, source_size, weight, rank, target``.

    Sources in code-point order, null last, take the weights in turn. The
    targets share out the size of all sources by weight; a target stops at
    ``max_repeats`` times its source and the excess goes to the others by
    weight. With L the words per unit of weight, target = min(L * weight,
    max_repeats * size): sources are capped in the order of cap / weight, so L
    follows from running sums in that order. The windows run over one row per
    source. Sources without words get the target 0.
    """
    by_source = sized.groupBy("source").agg(F.count(F.lit(1)).alias("docs"),
                                            F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(order) - 1
    ranked = by_source.withColumn("rank", turn.cast("long"))
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(
        wheel, (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("rank"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding,
                                                      Window.unboundedFollowing)
    total = F.sum("source_size").over(everything).cast("double")
    level = ((total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(onward))
    ranked = ranked.withColumn("level", level)
    # The first source in cap order that the level leaves below its cap; all
    # from there on share that level.
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    ranked = ranked.withColumn("shared", F.first(fits, ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.coalesce(F.col("shared") * F.col("weight"), F.col("cap")), F.col("cap"))
    return ranked.select("source", "docs", "source_size", "weight", "rank",
                         target.alias("target"))


def _demand_time(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Time at which the demand of a schedule reaches ``share`` (0 to 1) of its
    whole: the integral of a piecewise linear height is a quadratic in each
    piece, solved there."""
    areas = [(t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(knots, knots[1:])]
    whole = sum(areas)
    if whole <= 0:
        raise ValueError("a schedule needs a positive area")
    want, done, time = share * F.lit(whole), 0.0, None
    for ((t0, a), (t1, b)), area in zip(zip(knots, knots[1:]), areas):
        slope, rest = (b - a) / (t1 - t0), want - F.lit(done)
        if slope:
            root = F.sqrt(F.greatest(F.lit(0.0), F.lit(a * a) + rest * (2 * slope)))
            here = F.lit(t0) + (root - a) / slope
        elif a:
            here = F.lit(t0) + rest / a
        else:
            here = F.lit(t1)
        done += area
        inside = want <= F.lit(done)
        time = F.when(inside, here) if time is None else time.when(inside, here)
    return time.otherwise(F.lit(float(knots[-1][0])))


def position_of(words: Column, target: Column, rank: Column,
                schedules: Sequence = SCHEDULES) -> Column:
    """Training position in [0, 1] of the word after ``words`` words of a
    source with this target; beyond the target, 1 and up by the excess."""
    share = F.when(target > 0, words / target).otherwise(F.lit(1.0) + words)
    inside = None
    for k, knots in enumerate(schedules):
        mine = (rank % len(schedules)) == k
        time = _demand_time(share, knots)
        inside = F.when(mine, time) if inside is None else inside.when(mine, time)
    return F.when(share < 1.0, inside).otherwise(share)


def _before(value: Column, of: Sequence[str], order: Sequence[str]) -> Column:
    """Sum of ``value`` over the rows before, 0 for the first."""
    over = Window.partitionBy(*of).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(over), F.lit(0))


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeats: int = 3,
        schedules: Sequence = SCHEDULES, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Mix documents to target weights.

    Returns ``keep`` plus ``source, size, source_size, target, taken, copies,
    position``: ``taken`` is how many words the mix takes of the document,
    repeats counted, ``copies`` in how many passes it takes some, ``position``
    when its first words come. Within a source documents stand in the order of
    the digest of their id; pass after pass runs through the source and the
    last one stops at the target word, so the taken words of a source are its
    target rounded down, unless all passes end before.

    The running count of words before a document is a sum over whole digest
    buckets plus a sum inside one; a source has as many buckets as the root of
    its rows, so no task holds a source, however large its share. Rows that
    share id and size are counted first, by the task that wrote them; their
    places follow from the counts, so a repeated or null id is spread as well.

    Null texts are empty: size 0, nothing taken. A null source is a source of
    its own, after the others. Ties in the digest order (repeated ids) fall to
    the smaller size; repeated rows are taken one after the other. No rows
    give no rows. Other columns are ignored.
    """
    sized = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep],
                        F.md5(id_text().cast("binary")).alias("digest"),
                        F.col("source").cast("string").alias("source"),
                        word_count().alias("size"))
    sized = stored(with_task(sized))
    # Written, so that Spark knows its size when it plans the join: one row per
    # source is broadcast if that is small, and texts need no shuffle for it.
    targets = stored(source_targets(sized, weights, max_repeats))
    a, b = sized.alias("a"), targets.alias("b")
    rows = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source"))) \
        .select("a.*", "b.docs", "b.source_size", "b.rank", "b.target")
    rows = rows.withColumn("bucket", F.floor(unit(F.col("digest"))
                                             * root_buckets(F.col("docs"))).cast("long"))
    # A struct is never null, so the join below is a plain one on the columns
    # that the window has dealt the rows by.
    rows = rows.withColumn("of", F.struct("source"))
    # From rows to (digest, size) to bucket, each step a sum of the one before.
    same = ["of", "bucket", "digest", "size"]
    by_task = rows.groupBy(*same, "task").agg(F.count(F.lit(1)).alias("n"))
    alike = by_task.groupBy(*same).agg(F.sum("n").alias("n"))
    words = F.col("size") * F.col("n")
    sums = alike.groupBy("of", "bucket").agg(F.sum(words).alias("words"))
    sums = sums.select("of", "bucket", _before(F.col("words"), ["of"], ["bucket"]).alias("earlier"))
    alike = alike.withColumn("within", _before(words, ["of", "bucket"], ["digest", "size"])) \
        .join(sums, ["of", "bucket"]).drop("n")
    firsts = by_task.withColumn("copies", _before(F.col("n"), same, ["task"])).join(alike, same) \
        .select(*same, "task", (F.col("earlier") + F.col("within")
                                + F.col("copies") * F.col("size")).alias("first"))
    place = F.row_number().over(Window.partitionBy(*same, "task").orderBy("row")) - 1
    rows = rows.withColumn("place", place).join(firsts, [*same, "task"]) \
        .withColumn("start", F.col("first") + F.col("place") * F.col("size"))
    goal = F.floor("target").cast("long")
    taken, copies = F.lit(0).cast("long"), F.lit(0)
    for k in range(max_repeats):
        left = goal - F.col("source_size") * k - F.col("start")
        part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))
        taken, copies = taken + part, copies + (part > 0).cast("int")
    position = position_of(F.col("start").cast("double"), F.col("target"), F.col("rank"), schedules)
    if "source" not in keep:
        rows = rows.withColumn("k_source", F.col("source"))
    names = [*keep, *(["source"] if "source" not in keep else [])]
    return rows.select(*[F.col(f"k_{c}").alias(c) for c in names], "size", "source_size",
                       "target", taken.alias("taken"), copies.alias("copies"),
                       position.alias("position"), "digest", "rank", "start")


def passes(mixed: DataFrame, schedules: Sequence = SCHEDULES) -> DataFrame:
    """One row per copy that the mix takes, ``position`` being that copy's own."""
    each = mixed.where(F.col("copies") > 0).withColumn(
        "pass", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    words = (F.col("start") + F.col("pass") * F.col("source_size")).cast("double")
    return each.withColumn("position", position_of(words, F.col("target"), F.col("rank"), schedules))


def in_order(mixed: DataFrame) -> DataFrame:
    """Range sort by training position: each output part is a stretch of the
    curriculum. Ties go by digest."""
    return mixed.orderBy("position", "digest")
