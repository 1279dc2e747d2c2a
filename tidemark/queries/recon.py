"""Reconciliation and monitoring, with orders standing for metric outcomes."""

import datetime as dt

from pyspark.sql import functions as F

from ..functions import clean_error, format_error
from ..operators import recon as R
from .base import query, table

_LOADED = dt.datetime(2001, 8, 2, 6, 30)
_DAY = dt.date(2001, 8, 1)

# every order is a metric: F written, O failed to run, P failed to write or vanished
_DEFS_SQL = ("d AS (SELECT 'm' || o_orderkey AS metric_id, o_orderstatus AS s, o_orderpriority AS p, "
             "CASE WHEN o_orderpriority = '5-LOW' THEN 'w.m.low' ELSE 'w.m.rest' END AS target_table FROM orders)")
_OUTCOME_SQL = (
    "out AS (SELECT metric_id, target_table, s = 'F' AS is_success, CASE WHEN s = 'F' THEN NULL WHEN s = 'O' THEN 'Syntax error near ' || p "
    "WHEN p < '3' THEN 'Disk full' ELSE 'Unknown failure occurred during processing' END AS error_message, "
    "CASE WHEN s = 'F' THEN NULL WHEN s = 'O' THEN 'SQL_EXECUTION_ERROR' WHEN p < '3' THEN 'BIGQUERY_WRITE_ERROR' ELSE 'UNKNOWN_ERROR' END AS error_category FROM d)")


def _outcomes(spark, sf):
    orders = table(spark, sf, "orders")
    metric_id = F.concat(F.lit("m"), F.col("o_orderkey").cast("string")).alias("metric_id")
    target = F.when(F.col("o_orderpriority") == "5-LOW", "w.m.low").otherwise("w.m.rest").alias("target_table")
    sql = F.when(F.col("o_orderpriority") == "5-LOW", "SELECT 1").otherwise("SELECT 1 FROM `w.retail.orders` o, `w.x.y` WHERE d = {currently}").alias("sql")
    defs = orders.select(metric_id, F.col("o_orderpriority").alias("metric_name"), sql, target)
    written = orders.where("o_orderstatus = 'F'").select(metric_id, target)
    broken = orders.where("o_orderstatus = 'O'").select(metric_id, F.concat(F.lit("Syntax error near "), F.col("o_orderpriority")).alias("error_message"))
    unwritten = orders.where("o_orderstatus = 'P' AND o_orderpriority < '3'").select(metric_id, F.lit("Disk full").alias("error_message"))
    return R.classify(defs, written, broken, unwritten)


def _recon(spark, sf):
    return R.recon_rows(_outcomes(spark, sf), "2001-08-01", "bld", _DAY, _LOADED)


@query("rc01_classify", f"WITH {_DEFS_SQL}, {_OUTCOME_SQL} SELECT metric_id, target_table, is_success, error_message, error_category FROM out")
def _(spark, sf):
    return _outcomes(spark, sf).select("metric_id", "target_table", "is_success", "error_message", "error_category")


_NA = ", ".join(f"'NA' AS {c}" for c in R.NOT_APPLICABLE)
_ROWS_SQL = (
    f"SELECT '103' AS module_id, 'Metrics' AS module_type_nm, CASE WHEN p = '5-LOW' THEN 'UNKNOWN' ELSE 'retail' END AS source_databs_nm, "
    f"CASE WHEN p = '5-LOW' THEN 'UNKNOWN' ELSE 'orders' END AS source_table_nm, 'bld' AS source_server_nm, 'm' AS target_databs_nm, "
    f"CASE WHEN p = '5-LOW' THEN 'low' ELSE 'rest' END AS target_table_nm, 'bld' AS target_server_nm, '0' AS source_vl, "
    "CASE WHEN is_success THEN '0' ELSE '1' END AS target_vl, CASE WHEN is_success THEN 'Success' ELSE 'Failed' END AS clcltn_ds, CASE WHEN is_success THEN '0' ELSE '1' END AS excldd_vl, "
    "CASE WHEN is_success THEN 'Metric data was successfully written.' ELSE 'Metric data was failed written. [' || error_category || '] ' || "
    "CASE error_category WHEN 'SQL_EXECUTION_ERROR' THEN 'SQL query execution failed' WHEN 'BIGQUERY_WRITE_ERROR' THEN 'BigQuery write operation failed' ELSE 'Unknown error occurred' END "
    "|| ': ' || error_message END AS excldd_reason_tx, CASE WHEN is_success THEN 'Passed' ELSE 'Failed' END AS rcncln_exact_pass_in, "
    "'2001-08-01' AS latest_source_parttn_dt, '2001-08-01' AS latest_target_parttn_dt, '2001-08-02 06:30:00' AS load_ts, '2001-08-01' AS schdld_dt, "
    f"metric_id AS source_system_id, 2001 AS schdld_yr, p AS \"Job_Name\", {_NA} FROM out JOIN d USING (metric_id)")


@query("rc02_recon_rows", f"WITH {_DEFS_SQL}, {_OUTCOME_SQL} {_ROWS_SQL}")
def _(spark, sf):
    return _recon(spark, sf).withColumn("schdld_dt", F.col("schdld_dt").cast("string"))


_CLEAN = "regexp_replace(replace(replace(text, chr(10), ' '), chr(13), ' '), '^[\\s\\v\\p{Z}]+|[\\s\\v\\p{Z}]+$', '', 'g')"


@query("rc03_clean_error", f"SELECT doc_id, CASE WHEN length(t) > 500 THEN substr(t, 1, 497) || '...' ELSE t END AS error FROM (SELECT doc_id, {_CLEAN} AS t FROM documents)")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", clean_error(F.col("text")).alias("error"))


@query("rc04_format_error",
       f"SELECT doc_id, '[' || code || '] ' || CASE code WHEN 'GCS_READ_ERROR' THEN 'Failed to read JSON from GCS' WHEN 'JSON_VALIDATION_ERROR' THEN 'JSON data validation failed' ELSE code END || ': ' || "
       f"CASE WHEN length(t) > 500 THEN substr(t, 1, 497) || '...' ELSE t END AS error FROM (SELECT doc_id, {_CLEAN} AS t, "
       "CASE lang WHEN 'en' THEN 'GCS_READ_ERROR' WHEN 'fr' THEN 'JSON_VALIDATION_ERROR' ELSE 'OTHER' END AS code FROM documents)")
def _(spark, sf):
    code = F.when(F.col("lang") == "en", "GCS_READ_ERROR").when(F.col("lang") == "fr", "JSON_VALIDATION_ERROR").otherwise("OTHER")
    return table(spark, sf, "documents").select("doc_id", format_error(F.col("text"), code).alias("error"))


@query("rc05_failure_rows",
       "SELECT 'm' || o_orderkey AS source_system_id, coalesce(nullif(o_orderpriority, '5-LOW'), 'UNKNOWN') AS \"Job_Name\", '1' AS source_vl, '1' AS target_vl, 'UNKNOWN' AS source_table_nm, 'Failed' AS rcncln_exact_pass_in, "
       "'Failed to create recon record: [RECON_CREATION_ERROR] Recon record creation failed: [PIPELINE_EXECUTION_ERROR] Pipeline failed: no cluster' AS excldd_reason_tx FROM orders")
def _(spark, sf):
    defs = table(spark, sf, "orders").select(F.concat(F.lit("m"), F.col("o_orderkey").cast("string")).alias("metric_id"),
                                             F.nullif("o_orderpriority", F.lit("5-LOW")).alias("metric_name"))
    rows = R.failure_rows(defs, "no cluster", "2001-08-01", "bld", _DAY, _LOADED, "PIPELINE_EXECUTION_ERROR")
    return rows.select("source_system_id", "Job_Name", "source_vl", "target_vl", "source_table_nm", "rcncln_exact_pass_in", "excldd_reason_tx")


@query("rc06_status_counts", "SELECT CASE o_orderstatus WHEN 'F' THEN 'Passed' ELSE 'Failed' END AS rcncln_exact_pass_in, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    return R.status_counts(_recon(spark, sf), _DAY)


@query("rc07_failed_list", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate = DATE '2000-02-29'")
def _(spark, sf):
    return R.failed_list(table(spark, sf, "orders"), dt.date(2000, 2, 29), ["o_orderkey", "o_orderpriority"], "o_orderstatus <> 'F'", "o_orderdate")


@query("rc08_recent_runs", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS load_ts FROM events ORDER BY ts DESC, event_id")
def _(spark, sf):
    rows = R.recent(table(spark, sf, "events"), order=[F.desc("ts"), "event_id"])
    return rows.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("load_ts"))


@query("rc09_health",
       "SELECT month, total, passed, round(passed * 100.0 / total, 2)::DOUBLE AS success_rate, CASE WHEN 1 - passed / total > 0.5 THEN 'critical' WHEN 1 - passed / total > 0.2 THEN 'warning' "
       "WHEN passed / total < 0.95 THEN 'below_target' ELSE 'ok' END AS alert FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS total, count(*) FILTER (o_orderstatus <> 'F' OR o_orderpriority > '3') AS passed FROM orders GROUP BY 1)")
def _(spark, sf):
    return R.health(table(spark, sf, "orders"), [F.date_format("o_orderdate", "yyyy-MM").alias("month")], "o_orderstatus <> 'F' OR o_orderpriority > '3'")


@query("rc10_run_stats",
       f"WITH {_DEFS_SQL} SELECT target_table, count(*) AS processed, count(*) FILTER (s = 'F') AS written, count(*) FILTER (s <> 'F') AS failed, "
       "count(*) FILTER (s = 'F' AND p < '3') AS overwritten, count(*) FILTER (s = 'F' AND p >= '3') AS new FROM d GROUP BY 1")
def _(spark, sf):
    changes = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.concat(F.lit("m"), F.col("o_orderkey").cast("string")).alias("metric_id"),
        F.when(F.col("o_orderpriority") < "3", "overwritten").otherwise("new").alias("change"))
    return R.run_stats(_outcomes(spark, sf), changes)
