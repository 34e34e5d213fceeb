"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node that each linked node can reach: ``node, root``.

    A round points every node at its smallest neighbour (or at itself),
    follows the pointers to their ends, and links the ends that the remaining
    links join. All but local minima vanish in a round, so the table at least
    halves and the rounds are logarithmic in the longest chain. Neighbours are
    met by a partial minimum, so a node with a large share of the links does
    not gather them. Every round is written to the shared folder; the driver
    sees counts only.
    """
    edges = stored(links.select(F.col(a).alias("a"), F.col(b).alias("b"))
                   .where("a <> b").distinct())
    found: DataFrame | None = None
    while edges.limit(1).count():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.min("b").alias("low"))
                    .select("node", F.least("node", "low").alias("up")))
        while True:  # pointers only go down, so they end; each round doubles the reach
            over = up.select(F.col("node").alias("up"), F.col("up").alias("next"))
            up = stored(up.join(over, "up").select("node", F.col("next").alias("up"),
                                                   (F.col("next") != F.col("up")).alias("moved")))
            moved = up.where("moved").limit(1).count()
            up = up.select("node", "up")
            if not moved:
                break
        if found is None:
            found = up.select("node", F.col("up").alias("root"))
        else:
            step = up.select(F.col("node").alias("root"), F.col("up").alias("further"))
            found = found.join(step, "root", "left") \
                .select("node", F.coalesce("further", "root").alias("root"))
        found = stored(found)
        left = up.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        right = up.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        edges = stored(edges.join(left, "a").join(right, "b")
                       .select(F.col("ra").alias("a"), F.col("rb").alias("b"))
                       .where("a <> b").distinct())
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
