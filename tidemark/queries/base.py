"""Registry of the runnable queries and the SQL each must agree with."""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_folder as scratch  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

AS_OF = dt.date(2024, 1, 30)
RUN_DATE = dt.date(1998, 6, 1)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its independent form, None when SQL cannot say it."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Definitions derived from `part`, one per row, with every kind of flaw. The expressions read the
# same in both engines.
DEFS = {
    "record_index": "p_partkey",
    "metric_id": "CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN '  ' WHEN p_size < 10 THEN ' ' || p_brand || ' '"
                 " ELSE 'M_' || CAST(p_partkey AS VARCHAR(20)) END",
    "metric_name": "CASE WHEN p_size = 3 THEN '' ELSE nullif(p_name, 'red widget') END",
    "metric_type": "nullif(p_type, 'LARGE')",
    "sql": "CASE p_type"
           " WHEN 'ECONOMY' THEN 'SELECT count(*) AS metric_output FROM `w.retail.orders` WHERE partition_dt = {currently}'"
           " WHEN 'SMALL' THEN 'SELECT count(*) AS metric_output FROM `w.retail.' || replace(p_brand, 'Brand#', 'b') || '` WHERE partition_dt = {partition_info}'"
           " WHEN 'MEDIUM' THEN 'SELECT 1 AS metric_output'"
           " WHEN 'PROMO' THEN 'SELECT 1 FROM `w.retail.orders` a WHERE a.partition_dt = {currently} AND EXISTS (SELECT 1 FROM `w.stock.part` b WHERE b.partition_dt = {partition_info})'"
           " WHEN 'STANDARD' THEN 'SELECT 1 FROM t WHERE partition_dt = {partition_info}'"
           " ELSE 'SELECT 1 FROM `w.retail.orders` a, `w.stock.part` b WHERE a.d = {run_date} AND b.d = {run_date}' END",
    "dependency": "CASE WHEN p_size > 40 THEN NULL ELSE p_type END",
    "target_table": "CASE WHEN p_size < 5 THEN 'w.metrics' WHEN p_size < 8 THEN 'w..daily' WHEN p_size < 10 THEN '   ' ELSE 'w.metrics.daily' END",
    "partition_mode": "CASE WHEN p_size < 20 THEN NULL WHEN p_size < 30 THEN 'currently' WHEN p_size < 40 THEN 'currently|partition_info' ELSE 'currently|weekly' END",
}
DEFS_SQL = "defs AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in DEFS.items()) + " FROM part)"


def derived_defs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*[f"{e} AS {n}" for n, e in DEFS.items()])
