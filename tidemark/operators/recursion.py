"""Recursion without a bound on its levels: rounds over what is new, and doubling where links form trees."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import checkpoint, scratch_folder
from .hierarchy import resolve_ancestor


def fixpoint(seed: DataFrame, step: Callable[[DataFrame], DataFrame], key: Sequence[str],
             max_rounds: int | None = None) -> DataFrame:
    """All rows that ``step`` reaches from ``seed``: one per key, that of the earliest round.

    ``step`` gets the rows that were new in the round before and returns rows of the same columns. Of rows of one key
    in one round the smallest counts, by the other columns in order, so those must be comparable. NULL keys are equal
    to each other. Cycles end, since only keys never seen before go on; the recursion ends with a round that has none.
    More than ``max_rounds`` rounds are an error; nothing is cut off.

    Every round is written to a folder of its own in the shared scratch folder, so lineage does not grow and a lost
    executor costs one round. A round joins the known keys with its candidates first: while the candidates are few
    Spark broadcasts them and does not shuffle what is known. There is a round per level: for long chains of single
    links use ``descend``.
    """
    spark, columns, key = seed.sparkSession, seed.columns, list(key)
    rest = [c for c in columns if c not in key]
    folder = scratch_folder(spark, "fixpoint")

    def one_per_key(df: DataFrame) -> DataFrame:
        if not rest:
            return df.select(*columns).distinct()
        best = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__best"))
        return best.select(*key, "__best.*").select(*columns)

    fresh, n = _written(one_per_key(seed), seed, f"{folder}/round=0")
    number = 0
    while n:
        number += 1
        if max_rounds is not None and number > max_rounds:
            raise ValueError(f"new rows after {max_rounds} rounds")
        candidates = checkpoint(one_per_key(step(fresh)))
        known = spark.read.schema(seed.schema).parquet(*[f"{folder}/round={i}" for i in range(number)]).select(*key)
        met = _match(known, candidates.select(*key), key, "left_semi")
        fresh, n = _written(_match(candidates, met, key, "left_anti").select(*columns), seed, f"{folder}/round={number}")
    return spark.read.schema(seed.schema).parquet(*[f"{folder}/round={i}" for i in range(number + 1)])


def unroll(seed: DataFrame, step: Callable[[DataFrame], DataFrame], max_rounds: int | None = None) -> DataFrame:
    """All rows of ``seed`` and of every round of ``step``, repeated rows included: ``WITH RECURSIVE`` by UNION ALL.

    ``step`` gets the rows of the round before and returns rows of the same columns; the recursion ends with a round
    without rows, so links that run in circles need ``max_rounds`` (more rounds are an error; nothing is cut off) or
    ``fixpoint``. Neither rows nor levels have a bound of their own. Every round is written to a folder of its own in
    the shared scratch folder: what a round reads is the round before and whatever ``step`` joins.
    """
    spark, folder, number = seed.sparkSession, scratch_folder(seed.sparkSession, "unroll"), 0
    fresh, n = _written(seed, seed, f"{folder}/round=0")
    while n:
        number += 1
        if max_rounds is not None and number > max_rounds:
            raise ValueError(f"new rows after {max_rounds} rounds")
        fresh, n = _written(step(fresh).select(*seed.columns), seed, f"{folder}/round={number}")
    return spark.read.schema(seed.schema).parquet(*[f"{folder}/round={i}" for i in range(number + 1)])


def _written(df: DataFrame, seed: DataFrame, path: str) -> tuple[DataFrame, int]:
    """``df`` written and read again with the columns of ``seed``, and its number of rows, from one job."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return df.sparkSession.read.schema(seed.schema).parquet(path), seen.get["n"]


def _match(left: DataFrame, right: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Rows of ``left`` with (or without) an equal key in ``right``; NULLs are equal."""
    there = right.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(key)])
    same = [F.col(c).eqNullSafe(F.col(f"__{i}")) for i, c in enumerate(key)]
    return left.join(there, same, how)


def descend(links: DataFrame, roots: DataFrame, node: str = "node", parent: str = "parent",
            root: str = "root") -> DataFrame:
    """``node, root, depth`` of every node below a root, roots included at depth 0.

    A node has one parent (of repeated ones the smallest counts); a node below several roots belongs to the nearest, and
    a root that is below another stays a root of its own. Nodes without a root above them, also those of a cycle
    without one, have no row. Depth has no bound: links are doubled, so a chain of n levels takes log2(n) rounds
    of one row per distinct parent, where a recursive query takes n.
    """
    tops = checkpoint(roots.select(F.col(root)).where(F.col(root).isNotNull()).distinct())
    below = links.join(tops, F.col(node) == F.col(root), "left_anti")
    bound = max(links.select(parent).distinct().count() + 1, 1)
    found = resolve_ancestor(below, tops, bound, node, parent, root).where(F.col(root).isNotNull())
    start = tops.select(F.col(root).alias(node), root, F.lit(0).alias("depth"))
    return start.unionByName(found.select(node, root, "depth"))
