"""Nearest target ancestor in a parent-link hierarchy."""

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import checkpoint
from .relational import split_on_null

MAX_DEPTH = 6
_OPEN = "found IS NULL AND next IS NOT NULL"


def dedupe_edges(edges: DataFrame, worker: str, manager: str) -> DataFrame:
    """One manager per worker: the smallest. A row without a manager counts only when it is the only one."""
    return edges.groupBy(worker).agg(F.min(manager).alias(manager))


def _counted(state: DataFrame) -> tuple[DataFrame, int]:
    """The written state and how many of its nodes are unresolved, from one job."""
    seen = Observation()
    written = checkpoint(state.observe(seen, F.count_if(F.expr(_OPEN)).alias("open")))
    return written, seen.get["open"]


def resolve_ancestor(edges: DataFrame, targets: DataFrame, max_depth: int = MAX_DEPTH,
                     worker: str = "worker_id", manager: str = "manager_id",
                     target: str = "target_id", with_path: bool = False) -> DataFrame:
    """For each worker the first ancestor that is a target, within ``max_depth`` links, and its depth.

    ``with_path`` adds ``path``: the ids from the worker up to its target, both included, NULL without one. Rounds
    put path segments together as they double the links, so a path never holds more than twice ``max_depth`` ids.

    Links are followed by doubling: every manager first knows whether it is a target and its own
    parent; each round lets it look through its jump target, so depth d takes log2(d) rounds. Rounds
    work on distinct managers only, each round is checkpointed and counts the unresolved on its way,
    and rounds stop when there are none. Cycles end at the depth bound.
    """
    links = checkpoint(dedupe_edges(edges, worker, manager).select(
        F.col(worker).alias("node"), F.col(manager).alias("parent")))
    goals = targets.select(F.col(target).alias("node")).where("node IS NOT NULL").distinct()

    def segment(path: Column) -> list[Column]:
        return [path.alias("path")] if with_path else []

    # state of a manager: target found and its distance, else the node to go on from after `hops` links
    managers = links.select(F.col("parent").alias("node")).where("node IS NOT NULL").distinct()
    hit = goals.withColumn("is_goal", F.lit(True))
    state, unresolved = _counted(
        managers.join(hit, "node", "left").join(links, "node", "left").select(
            "node", F.when(F.col("is_goal"), F.col("node")).alias("found"),
            F.when(F.col("is_goal"), 0).otherwise(1).alias("hops"),
            F.when(F.col("is_goal").isNull(), F.col("parent")).alias("next"), *segment(F.array("node"))))
    for _ in range(math.ceil(math.log2(max(max_depth, 1)))):
        if not unresolved:
            break
        open_nodes = state.where(_OPEN)
        beyond = state.select(F.col("node").alias("next"), F.col("found").alias("f"),
                              F.col("hops").alias("h"), F.col("next").alias("n"), *[F.col("path").alias("p")] * with_path)
        moved = open_nodes.drop("found").join(beyond, "next").select(
            "node", F.col("f").alias("found"), (F.col("hops") + F.col("h")).alias("hops"), F.col("n").alias("next"),
            *segment(F.concat("path", "p") if with_path else F.lit(None)))
        state, unresolved = _counted(state.where(f"NOT ({_OPEN})").unionByName(moved))
    known = state.where("found IS NOT NULL").select(F.col("node").alias("parent"), "found", (F.col("hops") + 1).alias("depth"), *[F.col("path")] * with_path)
    near = F.col("depth") <= max_depth
    return links.join(known, "parent", "left").select(
        F.col("node").alias(worker), F.col("parent").alias(manager),
        F.when(near, F.col("found")).alias(target), F.when(near, F.col("depth")).alias("depth"),
        *segment(F.when(near, F.concat(F.array("node"), F.col("path"))) if with_path else F.lit(None)))


def split_found(resolved: DataFrame, target: str = "target_id") -> tuple[DataFrame, DataFrame]:
    """Workers with a target ancestor and workers without one."""
    return split_on_null(resolved, target)


def level_counts(resolved: DataFrame) -> DataFrame:
    """Workers per depth; depth NULL holds those without a target."""
    return resolved.groupBy("depth").agg(F.count(F.lit(1)).alias("n"))
