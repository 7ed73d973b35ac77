"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.storage import materialize, release


def _large(edges: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour (or itself) to its larger neighbours."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour to itself and its smaller neighbours. Edges come as a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    down = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    return down.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node still has two parents, or a parent that has one itself."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not per.where("up > 1 or (up > 0 and down > 0)").limit(1).isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """node, component: component is the smallest node reachable. Only nodes with an edge to another node appear;
    null ends and loops are ignored, repeated edges count once. Nothing is collected: each round is two joins on
    the node, written to the shared folder, and rounds grow with the logarithm of the longest path."""
    now = materialize(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                      .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a > b").distinct())
    for _ in range(max_rounds):
        if not _unfinished(now):
            break
        large = materialize(_large(now))
        release(now)
        now = materialize(_small(large))
        release(large)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
