"""Connected components of an edge list by alternating star contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _smallest(edges: DataFrame) -> DataFrame:
    """Per node ``u`` the smallest of its neighbours and itself."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = both.join(_smallest(both), "u")
    return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    linked = down.join(_smallest(down), "u")
    out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(linked.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """``node, root`` for every node of ``edges(u, v)`` that is not its own root; ``root`` is the smallest
    node of its component.

    Each round pulls every node to the smallest node it can see and is written to the shared folder;
    the number of rounds grows with the logarithm of the longest path. Raises when ``rounds`` do not suffice.
    """
    state = materialise(edges.select("u", "v").where("u <> v").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        state = materialise(_small_star(_large_star(state)), "stars")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
