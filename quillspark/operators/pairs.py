"""Co-liked item pairs and item recommendations.

``pair_counts`` is the full pair table: quadratic per user by definition.
To keep one heavy user from landing in one task, a user with more than
``max_items`` liked rows is split: their items are hashed into ``s``
buckets and the self-join runs on (user, bucket_a, bucket_b), so each join
group holds at most about ``max_items`` x ``max_items`` pairs. Users below
the limit get a single bucket and no replication.

``recommend`` never builds the pair table: for one target item the pair
count of (m, target) is sum over users of c(u, m) * c(u, target), which is a
linear join of per-user counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, tasks_for


def _likes(ratings: DataFrame, user: str, item: str, liked: Column | None) -> DataFrame:
    src = ratings if liked is None else ratings.where(liked)
    return src.select(F.col(user).alias("user"), F.col(item).alias("item"))


def pair_counts(ratings: DataFrame, user: str, item: str, liked: Column | None = None,
                max_items: int = 2000) -> DataFrame:
    """``count(*)`` of (m1, m2), m1 < m2, over pairs of liked rows of
    the same user. Duplicate (user, item) rows multiply, as in SQL."""
    # One row per (user, item) with its count: repeats of a row never multiply
    # in the join. Nulls pair with nothing.
    rows = _likes(ratings, user, item, liked).where(F.col("user").isNotNull() & F.col("item").isNotNull())
    likes = materialize(rows.repartition(tasks_for(rows.count()), "user", "item").groupBy("user", "item")
                        .agg(F.count(F.lit(1)).alias("c")))
    per_user = likes.groupBy("user").agg(F.count(F.lit(1)).alias("n_u")) \
        .withColumn("s", F.ceil(F.col("n_u") / max_items).cast("int"))
    # The pairs are dealt to as many tasks as they need. The join was seen to run
    # in the session's shuffle partitions all the same.
    n = F.col("n_u").cast("double")
    need = per_user.agg(F.sum(n * F.col("s")).alias("sides"), F.sum(n * (n - 1) / 2).alias("pairs")).first()
    split = per_user.where(F.col("s") > 1).select("user", "s")
    salted = (likes.join(split, "user", "left")
              .withColumn("s", F.coalesce("s", F.lit(1)))
              .withColumn("b", F.pmod(F.xxhash64("item"), F.col("s")).cast("int")))
    left = salted.select("user", F.col("item").alias("m1"), F.col("c").alias("c1"), F.col("b").alias("ba"),
                         F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("bb"))
    right = salted.select(F.col("user").alias("user_r"), F.col("item").alias("m2"),
                          F.col("c").alias("c2"), F.col("b").alias("bb_r"),
                          F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("ba_r"))
    tasks = tasks_for(need["sides"])
    left = left.repartition(tasks, "user", "ba", "bb")
    right = right.repartition(tasks, "user_r", "ba_r", "bb_r")
    joined = left.join(right, (F.col("user") == F.col("user_r")) & (F.col("ba") == F.col("ba_r"))
                       & (F.col("bb") == F.col("bb_r")) & (F.col("m1") < F.col("m2")))
    return joined.select("m1", "m2", (F.col("c1") * F.col("c2")).alias("c")) \
        .repartition(tasks_for(need["pairs"]), "m1", "m2") \
        .groupBy("m1", "m2").agg(F.sum("c").alias("pair_cnt"))


def recommend(ratings: DataFrame, user: str, item: str, target, liked: Column | None = None,
              k: int | None = 50, symmetric: bool = False) -> DataFrame:
    """Items co-liked with ``target`` ranked by pair count.

    Parity (``symmetric=False``) keeps the stored-pair direction of the
    reference, where the target had to be the larger id, so only smaller
    ids are recommended. ``symmetric=True`` scores every other item.
    """
    likes = _likes(ratings, user, item, liked)
    holders = (likes.where(F.col("item") == F.lit(target))
               .groupBy("user").agg(F.count(F.lit(1)).alias("t_n")))
    other = F.col("item") != F.lit(target) if symmetric else F.col("item") < F.lit(target)
    # Each liked (user, item) row contributes the user's target count:
    # sum over rows = sum over users of c(u, m) * c(u, target).
    scores = (likes.where(other).join(holders, "user")
              .groupBy("item").agg(F.sum("t_n").alias("rec_score"))
              .select(F.col("item").alias("recommended_item"), "rec_score"))
    if k is None:
        return scores
    return scores.orderBy(F.desc("rec_score"), F.asc("recommended_item")).limit(k)
