"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmarts.llm.common import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.join(low, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (a, b of one orderable type) -> (node, root), root = smallest node reachable.

    Each round is one large-star and one small-star step; a hub with many
    links is first reduced to its smallest neighbour by a partial aggregate.
    Rounds are stored tables, never driver data.  Nodes without a link do not
    appear.  Raises if ``max_rounds`` do not suffice (rounds grow with the
    logarithm of the longest chain).
    """
    e = stored(links.filter("a <> b").select("a", "b").distinct(), "links")
    sign = None
    for _ in range(max_rounds):
        e = stored(_small_star(_large_star(e)), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == sign:
            roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        sign = tuple(now)
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
