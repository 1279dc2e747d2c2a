"""Alignment to a target schema, overwrite by key, deletes and rollback."""

import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import JOB_ERRORS
from ..operators import upsert as U
from ..operators.align import align, align_decimals
from ..plans.run import run_definitions
from .base import query, scratch, table

_TARGET = T.StructType([
    T.StructField("day", T.DateType()), T.StructField("price", T.DecimalType(38, 9)),
    T.StructField("o_orderkey", T.LongType()), T.StructField("note", T.StringType()),
])


def _for_target(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"),
                                             F.col("o_orderdate").cast("string").alias("day_text"),
                                             F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("up01_align_skip", "SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(CAST(o_totalprice AS DECIMAL(38,9)) AS DOUBLE) AS price, o_orderkey FROM orders")
def _(spark, sf):
    rows = align(_for_target(spark, sf), _TARGET)
    return rows.select(F.col("day").cast("string"), F.col("price").cast("double"), *rows.columns[2:])


@query("up01_align_null", "SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(CAST(o_totalprice AS DECIMAL(38,9)) AS DOUBLE) AS price, o_orderkey, CAST(NULL AS VARCHAR) AS note FROM orders")
def _(spark, sf):
    rows = align(_for_target(spark, sf), _TARGET, missing="null")
    return rows.select(F.col("day").cast("string"), F.col("price").cast("double"), *rows.columns[2:])


@query("up02_align_decimals", "SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS l_extendedprice FROM lineitem")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)"))
    target = T.StructType([T.StructField("l_extendedprice", T.DecimalType(20, 1))])
    return align_decimals(lines, target).withColumn("l_extendedprice", F.col("l_extendedprice").cast("double"))


# a run re-computes the metrics of some customers for the days they ordered on, and adds new ones
_EXISTING = "SELECT 'c' || o_custkey AS metric_id, strftime(o_orderdate, '%Y-%m') AS partition_dt, o_orderkey AS value FROM orders WHERE o_orderstatus <> 'P'"
_INCOMING = "SELECT 'c' || o_custkey AS metric_id, strftime(o_orderdate, '%Y-%m') AS partition_dt, -o_orderkey AS value FROM orders WHERE o_orderstatus = 'P'"


def _tables(spark, sf):
    shape = lambda df, value: df.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("metric_id"),
                                        F.date_format("o_orderdate", "yyyy-MM").alias("partition_dt"), value.alias("value"))
    orders = table(spark, sf, "orders")
    return (shape(orders.where("o_orderstatus <> 'P'"), F.col("o_orderkey")),
            shape(orders.where("o_orderstatus = 'P'"), -F.col("o_orderkey")))


_AFTER = (f"SELECT * FROM ({_EXISTING}) e WHERE NOT EXISTS (SELECT 1 FROM ({_INCOMING}) i WHERE i.metric_id = e.metric_id AND i.partition_dt = e.partition_dt) "
          f"UNION ALL SELECT * FROM ({_INCOMING})")


@query("up03_overwrite_by_key", _AFTER)
def _(spark, sf):
    existing, incoming = _tables(spark, sf)
    return U.overwrite_by_key(existing, incoming)


@query("io05_overwrite_partitions", _AFTER)
def _(spark, sf):
    existing, incoming = _tables(spark, sf)
    path = scratch(spark, "metrics")
    U.overwrite_partitions(spark, path, existing)
    U.overwrite_partitions(spark, path, incoming)
    return spark.read.parquet(path).select("metric_id", F.col("partition_dt").cast("string").alias("partition_dt"), "value")


@query("up04_existing_keys", f"SELECT DISTINCT i.metric_id, i.partition_dt FROM ({_INCOMING}) i WHERE (i.metric_id, i.partition_dt) IN (SELECT metric_id, partition_dt FROM ({_EXISTING}))")
def _(spark, sf):
    return U.existing_keys(*_tables(spark, sf))


@query("up05_delete_by_key", f"SELECT * FROM ({_EXISTING}) e WHERE NOT EXISTS (SELECT 1 FROM ({_INCOMING}) i WHERE i.metric_id = e.metric_id AND i.partition_dt = e.partition_dt)")
def _(spark, sf):
    return U.delete_by_key(*_tables(spark, sf))


@query("up06_classify_keys",
       f"SELECT DISTINCT metric_id, partition_dt, CASE WHEN (metric_id, partition_dt) IN (SELECT metric_id, partition_dt FROM ({_EXISTING})) THEN 'overwritten' ELSE 'new' END AS change FROM ({_INCOMING})")
def _(spark, sf):
    return U.classify_keys(*_tables(spark, sf))


@query("up07_rollback",
       "SELECT event_id, user_id FROM events WHERE NOT (user_id IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 200) AND ts >= TIMESTAMP '2024-01-30 11:00:00')")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    added = events.where("event_type = 'error' AND value > 200").select("user_id")
    left = U.rollback(events, added, dt.datetime(2024, 1, 30, 23), hours=12, keys=["user_id"], written_at="ts")
    return left.select("event_id", "user_id")


@query("up07_restored_partitions", _EXISTING)
def _(spark, sf):
    existing, incoming = _tables(spark, sf)
    path, undo = scratch(spark, "restored"), scratch(spark, "undo")
    U.overwrite_partitions(spark, path, existing)
    U.overwrite_partitions(spark, path, incoming, undo=undo)
    U.restore(spark, path, undo)
    return U.read_partitioned(spark, path, "partition_dt", existing)


_STORED = ("SELECT 'status_' || o_orderstatus AS metric_id, CAST(count(*) AS DOUBLE) AS metric_output, strftime(o_orderdate, '%Y-%m-01') AS partition_dt "
           "FROM orders GROUP BY o_orderstatus, strftime(o_orderdate, '%Y-%m-01')")


@query("up07_failed_run", f"SELECT *, 'Failed' AS status FROM ({_STORED})")
def _(spark, sf):
    # the run overwrites the metrics of a month, then its second target has no place
    orders, path, recon = table(spark, sf, "orders"), scratch(spark, "metrics"), scratch(spark, "recon")
    stored = orders.groupBy(F.concat(F.lit("status_"), "o_orderstatus").alias("metric_id"), F.date_format("o_orderdate", "yyyy-MM-01").alias("partition_dt")).agg(
        F.count(F.lit(1)).cast("decimal(38,9)").alias("metric_output"))
    U.overwrite_partitions(spark, path, stored)
    sql = "SELECT count(*) AS metric_output, {currently} AS business_data_date FROM `w.retail.orders` WHERE o_orderdate <= {currently}"
    names = [("status_F", "w.m.daily"), ("added", "w.m.daily"), ("lost", "w.m.late")]
    defs = json.dumps([{"metric_id": name, "metric_name": name, "metric_type": "Count", "dependency": "daily", "sql": sql, "target_table": to} for name, to in names])
    source = scratch(spark, "definitions")
    spark.createDataFrame([(defs,)], "value string").write.text(source)
    info = orders.select(F.lit("retail").alias("project_dataset"), F.lit("orders").alias("table_name"), F.to_date("o_orderdate").alias("partition_dt"))
    try:
        run_definitions(spark, source, info, "2001-07-01", "daily", {"w.retail.orders": orders}, {"w.m.daily": path, "w.m.late": "no_such_schema.metrics"},
                        recon, "test", executed_at=dt.datetime(2001, 7, 2), all_or_nothing=True)
    except JOB_ERRORS:
        pass  # the failure is the point: the rows below tell what it left
    status = spark.read.parquet(recon).agg(F.array_join(F.collect_set("rcncln_exact_pass_in"), ",")).scalar()
    left = U.read_partitioned(spark, path, "partition_dt", stored)
    return left.select("metric_id", F.col("metric_output").cast("double"), "partition_dt", status.alias("status"))


@query("up08_empty_input", _EXISTING)
def _(spark, sf):
    existing, incoming = _tables(spark, sf)
    path = scratch(spark, "unchanged")
    U.overwrite_partitions(spark, path, existing)
    written = U.overwrite_partitions(spark, path, incoming.limit(0))
    kept = U.read_partitioned(spark, path, "partition_dt", existing)
    return kept.where(F.lit(written is None))
