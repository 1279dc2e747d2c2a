"""Nearest target ancestor over parent links derived from the tables."""

from pyspark.sql import functions as F

from ..operators import hierarchy as H
from .base import query, table

# parts form a tree of three children per node; a supplier number marks a target
_TREE = ("edges AS (SELECT p_partkey AS w, CASE WHEN p_partkey > 0 THEN (p_partkey - 1) // 3 END AS m FROM part), "
         "goals AS (SELECT s_suppkey AS g FROM supplier WHERE s_acctbal > 7000)")


def _climb(depth: int) -> str:
    """First target within ``depth`` links as a recursive query."""
    return (f"WITH RECURSIVE {{edges}}, climb AS (SELECT w, m AS node, 1 AS depth FROM edges UNION ALL "
            f"SELECT c.w, e.m, c.depth + 1 FROM climb c JOIN edges e ON e.w = c.node WHERE c.depth < {depth} AND c.node NOT IN (SELECT g FROM goals)), "
            "hits AS (SELECT w, node AS target_id, depth FROM climb WHERE node IN (SELECT g FROM goals)) ")


def _tree(spark, sf):
    key = F.col("p_partkey")
    edges = table(spark, sf, "part").select(key.alias("worker_id"), F.when(key > 0, F.floor((key - 1) / 3)).alias("manager_id"))
    goals = table(spark, sf, "supplier").where("s_acctbal > 7000").select(F.col("s_suppkey").alias("target_id"))
    return edges, goals


def _sql(depth: int, edges: str = _TREE) -> str:
    return _climb(depth).replace("{edges}", edges)


@query("hr1_nearest_ancestor", _sql(6) + "SELECT e.w AS worker_id, e.m AS manager_id, target_id, CAST(depth AS INTEGER) AS depth FROM edges e LEFT JOIN hits h ON h.w = e.w")
def _(spark, sf):
    return H.resolve_ancestor(*_tree(spark, sf))


@query("hr2_found_split", _sql(6) + "SELECT CASE WHEN target_id IS NULL THEN 'not found' ELSE 'found' END AS part, count(*) AS n FROM edges e LEFT JOIN hits h ON h.w = e.w GROUP BY 1")
def _(spark, sf):
    found, lost = H.split_found(H.resolve_ancestor(*_tree(spark, sf)))
    n = F.count(F.lit(1)).alias("n")
    return found.groupBy(F.lit("found").alias("part")).agg(n).unionByName(lost.groupBy(F.lit("not found").alias("part")).agg(n))


@query("hr3_depth_counts", _sql(3) + "SELECT CAST(depth AS INTEGER) AS depth, count(*) AS n FROM edges e LEFT JOIN hits h ON h.w = e.w GROUP BY 1")
def _(spark, sf):
    return H.level_counts(H.resolve_ancestor(*_tree(spark, sf), max_depth=3))


def _paths(depth: int, edges: str) -> str:
    """The ids from every worker up to its first target."""
    climb = _sql(depth, edges).replace("1 AS depth FROM edges", "1 AS depth, [w, m] AS path FROM edges").replace(
        "c.depth + 1 FROM climb", "c.depth + 1, list_append(c.path, e.m) FROM climb").replace("node AS target_id, depth FROM", "node AS target_id, depth, path FROM")
    return climb + ("SELECT e.w AS worker_id, CAST(target_id AS BIGINT) AS target_id, CAST(depth AS INTEGER) AS depth, array_to_string(path, '>') AS path "
                    "FROM edges e LEFT JOIN hits h ON h.w = e.w")


def _with_path(edges, goals, depth: int):
    found = H.resolve_ancestor(edges, goals, max_depth=depth, with_path=True)
    return found.select("worker_id", F.col("target_id").cast("bigint").alias("target_id"), "depth", F.array_join("path", ">").alias("path"))


@query("hr3_paths", _paths(5, _TREE))
def _(spark, sf):
    return _with_path(*_tree(spark, sf), 5)


# customers: a third report to one manager, rows repeat with different managers, and some form a cycle
_CROWD = ("raw AS (SELECT c_custkey AS w, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 5 WHEN c_mktsegment = 'HOUSEHOLD' THEN c_custkey ^ 1 ELSE c_custkey // 2 END AS m FROM customer "
          "UNION ALL SELECT c_custkey, c_custkey // 4 FROM customer WHERE c_acctbal > 5000), "
          "edges AS (SELECT w, min(m) AS m FROM raw GROUP BY w), goals AS (SELECT n_nationkey AS g FROM nation WHERE n_regionkey = 1)")


_CROWD = _CROWD.replace("c_custkey ^ 1", "xor(c_custkey, 1)")


@query("hr4_cycles_and_repeats", _sql(6, _CROWD) +
       "SELECT e.w AS worker_id, CAST(e.m AS BIGINT) AS manager_id, CAST(target_id AS BIGINT) AS target_id, CAST(depth AS INTEGER) AS depth FROM edges e LEFT JOIN hits h ON h.w = e.w")
def _(spark, sf):
    return H.resolve_ancestor(*_crowd(spark, sf))


@query("hr3_paths_with_cycles", _paths(6, _CROWD))
def _(spark, sf):
    return _with_path(*_crowd(spark, sf), 6)


def _crowd(spark, sf):
    customers, key = table(spark, sf, "customer"), F.col("c_custkey")
    manager = (F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.lit(5).cast("bigint"))
               .when(F.col("c_mktsegment") == "HOUSEHOLD", key.bitwiseXOR(F.lit(1).cast("bigint"))).otherwise(F.floor(key / 2)))
    edges = customers.select(key.alias("worker_id"), manager.alias("manager_id")).unionByName(
        customers.where("c_acctbal > 5000").select(key.alias("worker_id"), F.floor(key / 4).alias("manager_id")))
    goals = table(spark, sf, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").cast("bigint").alias("target_id"))
    return edges, goals
