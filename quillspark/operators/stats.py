"""Correlation of entity series and the two-period test.

``pair_correlation`` works on per-(entity, period) counts, never on raw rows.
Each entity becomes one dense vector over the observed periods (zero-filled,
standardised with built-in array functions), so a Pearson coefficient is a
dot product. Pairs are produced block-by-block: entities are hashed into
``B`` blocks and every block pair (i <= j) is one equi-join key, so no join
group exceeds ``block_size`` x ``block_size`` pairs and no cross join or
per-period all-pairs explosion is planned. The pair count is E^2/2 by the
nature of the question; the blocks only keep it evenly spread.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def entity_vectors(counts: DataFrame, entity: str, period: str, value: str) -> DataFrame:
    """Dense zero-filled vector per entity over all observed periods, plus the
    standardised vector ``z`` (unit norm, zero mean). Constant entities
    (norm 0) are dropped: their correlation is undefined."""
    periods = counts.select(F.sort_array(F.collect_set(period))).scalar()
    grouped = counts.groupBy(entity).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(period), F.col(value).cast("double")))).alias("_m"))
    # The period list is a one-row scalar subquery; it is bound to a column
    # first because higher-order functions cannot hold subqueries.
    x = F.transform("_p", lambda p: F.coalesce(F.col("_m")[p], F.lit(0.0)))
    dense = grouped.select(entity, "_m", periods.alias("_p")).select(entity, x.alias("x"))
    mean = F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v) / F.size("x")
    centered = dense.select(entity, "x", F.transform("x", lambda v: v - mean).alias("_c"))
    norm = F.sqrt(F.aggregate("_c", F.lit(0.0), lambda acc, v: acc + v * v))
    withnorm = centered.select(entity, "x", "_c", norm.alias("_norm")).where(F.col("_norm") > 0)
    return withnorm.select(entity, "x", F.transform("_c", lambda v: v / F.col("_norm")).alias("z"))


def pair_correlation(counts: DataFrame, entity: str, period: str, value: str,
                     block_size: int = 1024) -> DataFrame:
    """L1: Pearson correlation of every entity pair (entity_a < entity_b) of
    zero-filled per-period series."""
    # One row per entity (a period-length vector each): small, and read by
    # both join sides and the block count, so it is computed once.
    vecs = materialize(entity_vectors(counts, entity, period, value))
    n_blocks = max(1, math.ceil(vecs.count() / block_size))
    blocked = vecs.select(entity, "z", F.pmod(F.xxhash64(entity), F.lit(n_blocks)).cast("int").alias("blk"),
                          F.lit(n_blocks).alias("nb"))
    left = blocked.select(F.col(entity).alias("a"), F.col("z").alias("za"), F.col("blk").alias("bi"),
                          F.explode(F.sequence(F.col("blk"), F.col("nb") - 1)).alias("bj"))
    right = blocked.select(F.col(entity).alias("b"), F.col("z").alias("zb"), F.col("blk").alias("bj_r"),
                           F.explode(F.sequence(F.lit(0), F.col("blk"))).alias("bi_r"))
    pairs = left.join(right, (F.col("bi") == F.col("bi_r")) & (F.col("bj") == F.col("bj_r"))
                      & ((F.col("bi") < F.col("bj")) | (F.col("a") < F.col("b"))))
    dot = F.aggregate(F.zip_with("za", "zb", lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)
    return pairs.select(F.least("a", "b").alias("entity_a"), F.greatest("a", "b").alias("entity_b"),
                        dot.alias("corr"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)


def _angle(a: Column, b: Column) -> Column:
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), _dot(a, b))))


def pivot_angles(vecs: DataFrame, entity: str, pivots: int) -> DataFrame:
    """``entity, z, angles, blk, ring``: the angles of every vector to ``pivots``
    of the vectors, picked by hash (one bounded row), the nearest pivot, and the
    angle to it."""
    picked = vecs.orderBy(F.xxhash64(entity), entity).limit(pivots).agg(F.collect_list("z")).scalar()
    rows = vecs.select(entity, "z", picked.alias("picked")).select(
        entity, "z", F.transform("picked", lambda c: _angle(F.col("z"), c)).alias("angles"))
    near = F.array_min("angles")
    return rows.select(entity, "z", "angles", (F.array_position("angles", near) - 1).cast("int").alias("blk"),
                       near.alias("ring"))


def top_correlations(counts: DataFrame, entity: str, period: str, value: str, k: int = 10, digits: int = 6,
                     pivots: int = 128, checked: int = 16) -> DataFrame:
    """L1/H3: the ``k`` highest correlations ``entity_a, entity_b, corr`` (rounded
    to ``digits``, ties to smaller entities) without computing all pairs.

    A correlation is the cosine of the angle between two series. Neighbours by
    angle around the pivots give a value that ``k`` pairs reach, and so the widest
    angle a better pair can have. Two series whose angles to any one pivot differ
    by more than that are further apart (triangle inequality): a series meets
    those of a pivot only in the rings of angles that are left, and a met pair is
    multiplied out only where ``checked`` further pivots allow it, too. What is
    left out cannot be in the result, which is that of all pairs.

    Of series that are equal only the ``k + 1`` smallest entities take part: more
    cannot come in. Series that are alike, but not equal, meet in pairs as far as
    the result depends on them.
    """
    vecs = entity_vectors(counts, entity, period, value).select(entity, "z")
    same = F.row_number().over(Window.partitionBy("z").orderBy(entity))
    vecs = materialize(vecs.withColumn("_same", same).where(F.col("_same") <= k + 1).drop("_same"))
    rows = materialize(pivot_angles(vecs, entity, pivots))
    around = Window.partitionBy("blk", F.floor(F.col("ring") * 64)).orderBy("ring", entity)
    before = F.array(*[F.lag(F.struct(F.col(entity).alias("e"), "z"), n).over(around) for n in range(1, 5)])
    near = rows.select(F.col(entity).alias("b"), F.col("z").alias("zb"), before.alias("before")) \
        .select("b", "zb", F.explode("before").alias("p")).where("p is not null") \
        .select(F.col("p.e").alias("a"), "b", F.col("p.z").alias("za"), "zb")
    floor = _highest(_correlated(near), k, digits).agg(F.min("corr"), F.count(F.lit(1))).first()
    reach = floor[0] - 2 * 10.0 ** -digits if floor[1] == k else -1.0
    limit = math.acos(max(-1.0, min(1.0, reach))) + 1e-7
    return _highest(_correlated(_met(rows, entity, limit, checked)), k, digits)


def _met(rows: DataFrame, entity: str, limit: float, checked: int) -> DataFrame:
    """Pairs of series that can be within ``limit`` of each other, each once:
    ``a, b, za, zb``."""
    own = rows.select(F.col(entity).alias("b"), F.col("z").alias("zb"), F.col("blk"), F.slice("angles", 1, checked)
                      .alias("pb"), F.col("ring").alias("rb"), F.floor(F.col("ring") / limit).alias("band"))
    # A series meets the blocks from its own on; the others meet it.
    to = F.filter(F.transform("angles", lambda v, i: F.struct(i.alias("blk"), v.alias("ra"))),
                  lambda p: p["blk"] >= F.col("blk"))
    meets = rows.select(F.col(entity).alias("a"), F.col("z").alias("za"), F.col("blk").alias("ba"),
                        F.slice("angles", 1, checked).alias("pa"), F.explode(to).alias("to")) \
        .select("a", "za", "ba", "pa", "to.blk", "to.ra", F.explode(F.sequence(
            F.floor(F.col("to.ra") / limit) - 1, F.floor(F.col("to.ra") / limit) + 1)).alias("band"))
    close = F.forall(F.zip_with("pa", "pb", lambda p, q: F.abs(p - q)), lambda d: d <= limit)
    return meets.join(own, ["blk", "band"]).where(
        ((F.col("ba") < F.col("blk")) | (F.col("a") < F.col("b"))) & (F.abs(F.col("ra") - F.col("rb")) <= limit)
        & close).select("a", "b", "za", "zb")


def _correlated(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("entity_a"), F.greatest("a", "b").alias("entity_b"),
                        _dot(F.col("za"), F.col("zb")).alias("corr"))


def _highest(pairs: DataFrame, k: int, digits: int) -> DataFrame:
    rounded = pairs.select("entity_a", "entity_b", F.round("corr", digits).alias("corr"))
    return rounded.orderBy(F.desc("corr"), F.asc("entity_a"), F.asc("entity_b")).limit(k)


def two_period_counts(df: DataFrame, key: str, ts: str | Column,
                      first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Per key, rows in [first) and in [second) from one scan.

    Keys present in either period appear (a missing side counts 0), which
    is the full outer join of the two per-period counts.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    in1 = (t >= F.lit(first[0]).cast("timestamp_ntz")) & (t < F.lit(first[1]).cast("timestamp_ntz"))
    in2 = (t >= F.lit(second[0]).cast("timestamp_ntz")) & (t < F.lit(second[1]).cast("timestamp_ntz"))
    return (df.where(in1 | in2).groupBy(key)
            .agg(F.count_if(in1).alias("n_first"), F.count_if(in2).alias("n_second")))


def two_period_summary(per_key: DataFrame, first: str = "n_first", second: str = "n_second",
                       digits: int | None = None) -> DataFrame:
    """F14 + pooled t statistic: mean and population sd per period, key count,
    Student t (equal variances, sample variances pooled) and degrees of
    freedom. Zero pooled variance gives a NULL t."""
    n = F.count(F.lit(1))
    v1, v2 = F.var_samp(first), F.var_samp(second)
    t = F.try_divide(F.avg(first) - F.avg(second), F.sqrt((v1 + v2) / n))

    def r(c: Column) -> Column:
        return F.round(c, digits) if digits is not None else c
    return per_key.agg(n.alias("n_keys"), r(F.avg(first)).alias("mean_first"),
                       r(F.stddev_pop(first)).alias("sd_first"), r(F.avg(second)).alias("mean_second"),
                       r(F.stddev_pop(second)).alias("sd_second"), r(t).alias("t_stat"),
                       (2 * n - 2).alias("dof"))


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0: Stirling's series ten steps
    further on, brought back by the recurrence."""
    z = x + 10
    series = (1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5)))
              - 1 / (1680 * F.pow(z, F.lit(7))))
    back = F.aggregate(F.sequence(F.lit(0), F.lit(9)), F.lit(0.0), lambda acc, k: acc + F.log(x + k))
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series - back


def incomplete_beta(x: Column, a: Column, b: Column, steps: int = 300) -> Column:
    """Regularised incomplete beta function for 0 <= x <= 1, by its continued
    fraction (the one of x or of 1 - x, whichever converges faster), folded over
    ``steps`` terms."""
    tiny = 1e-300

    def safe(v: Column) -> Column:
        return F.when(F.abs(v) < tiny, F.lit(tiny)).otherwise(v)

    def fraction(x: Column, a: Column, b: Column) -> Column:
        def term(state: Column, k: Column) -> Column:
            m = F.floor(k / 2).cast("double")
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            d = F.when(k % 2 == 0, even).otherwise(odd)
            den = 1 / safe(1 + d * state["den"])
            num = safe(1 + d / state["num"])
            return F.struct(num.alias("num"), den.alias("den"), (state["value"] * num * den).alias("value"))

        first = 1 / safe(1 - (a + b) * x / (a + 1))
        start = F.struct(F.lit(1.0).alias("num"), first.alias("den"), first.alias("value"))
        front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x)) / a
        return front * F.aggregate(F.sequence(F.lit(2), F.lit(steps + 1)), start, term, lambda s: s["value"])

    direct = x < (a + 1) / (a + b + 2)
    return F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)) \
        .when(direct, fraction(x, a, b)).otherwise(1 - fraction(1 - x, b, a))


def t_p_value(t: Column, dof: Column) -> Column:
    """Two-sided p-value of a t statistic."""
    v = dof.cast("double")
    return incomplete_beta(v / (v + t * t), v / 2, F.lit(0.5))


def pooled_t_test(per_key: DataFrame, first: str = "n_first", second: str = "n_second") -> DataFrame:
    """L2: one lazy row ``n_keys, t_stat, dof, p_value`` of the pooled two-sample
    t-test; no variance gives NULLs."""
    s = two_period_summary(per_key, first, second).select("n_keys", "t_stat", "dof")
    return s.withColumn("p_value", t_p_value(F.col("t_stat"), F.col("dof")))
