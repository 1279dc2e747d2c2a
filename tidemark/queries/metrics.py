"""Metric aggregates, metric runs and the checks on their values."""

import datetime as dt

from pyspark.sql import functions as F

from ..functions import denominator_status, numeric_warning, ratio_percent, to_metric_decimal
from ..functions.dates import business_date
from ..operators import partitions as P
from ..operators.agg_states import load_states, merge_states, pending
from ..operators.aggregates import Measure, measure
from ..operators.relational import combine_one_row
from ..plans import metrics as M
from ..plans.columns import ColumnMap
from .base import query, scratch, table

_MOMENT = dt.datetime(2001, 8, 2)
_DAY = dt.date(2001, 8, 1)


@query("ag01_count", "SELECT count(*) AS n, count(*) FILTER (o_totalprice > 100000) AS dear FROM orders")
def _(spark, sf):
    return measure(table(spark, sf, "orders"), [Measure("n"), Measure("dear", where="o_totalprice > 100000")])


@query("ag02_count_distinct", "SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT nullif(o_orderstatus, 'P')) AS statuses FROM orders")
def _(spark, sf):
    return measure(table(spark, sf, "orders"), [
        Measure("customers", "count_distinct", "o_custkey"), Measure("statuses", "count_distinct", "nullif(o_orderstatus, 'P')")])


@query("ag03_sum_default",
       "SELECT CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, CAST(coalesce(sum(CASE WHEN l_quantity < 0 THEN CAST(l_quantity AS BIGINT) END), 0) AS BIGINT) AS negative, "
       "CAST(sum(CASE WHEN l_quantity < 0 THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS no_default FROM lineitem")
def _(spark, sf):
    q = "cast(l_quantity AS bigint)"
    return measure(table(spark, sf, "lineitem"), [
        Measure("quantity", "sum", q), Measure("negative", "sum", q, where="l_quantity < 0", default=0),
        Measure("no_default", "sum", q, where="l_quantity < 0")])


@query("ag04_count_if", "SELECT count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (nullif(o_orderstatus, 'P') <> 'F') AS open FROM orders")
def _(spark, sf):
    return measure(table(spark, sf, "orders"), [
        Measure("finished", "count_if", condition="o_orderstatus = 'F'"),
        Measure("open", "count_if", condition="nullif(o_orderstatus, 'P') <> 'F'")])


@query("ag05_conditional",
       "SELECT CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS revenue, "
       "count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS buyers, count(DISTINCT user_id) AS users FROM events")
def _(spark, sf):
    row = measure(table(spark, sf, "events"), [
        Measure("revenue", "sum_if", "cast(value AS decimal(18,2))", condition="event_type = 'purchase'"),
        Measure("buyers", "count_distinct_if", "user_id", condition="event_type = 'purchase'"),
        Measure("users", "count_distinct", "user_id")])
    return row.withColumn("revenue", F.col("revenue").cast("double"))


@query("ag06_safe_divide",
       "SELECT user_id, round(count(*) FILTER (event_type = 'purchase') / CAST(nullif(count(*) FILTER (event_type = 'signup'), 0) AS DOUBLE), 6) AS rate FROM events GROUP BY user_id")
def _(spark, sf):
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    return table(spark, sf, "events").groupBy("user_id").agg(F.round(F.try_divide(n("purchase"), n("signup")), 6).alias("rate"))


@query("ag07_max_date", "SELECT event_type, strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') AS last_day, max(value) AS top FROM events GROUP BY event_type")
def _(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.max(F.to_date("ts")).cast("string").alias("last_day"), F.max("value").alias("top"))


def _percentage(spark, sf):
    """Share of finished orders of the run date as one checked metric row."""
    definition = {"metric_id": "1010", "sql": (
        "SELECT count_if(o_orderstatus = 'F') AS numerator_value, count(*) AS denominator_value, "
        "round(count_if(o_orderstatus = 'F') * 100.0 / count(*), 2) AS metric_output, {currently} AS business_data_date "
        "FROM `w.retail.orders` WHERE o_orderdate <= {currently}")}
    with M.table_views(spark, {"w.retail.orders": table(spark, sf, "orders")}):
        return M.run_metric(spark, definition, [_DAY, _DAY])


def _as_double(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


@query("ag09_percentage_metric",
       "SELECT CAST(f AS DOUBLE) AS numerator_value, CAST(n AS DOUBLE) AS denominator_value, CAST(round(f * 100.0 / n, 2) AS DOUBLE) AS metric_output, "
       "'2001-08-01' AS business_data_date FROM (SELECT count(*) FILTER (o_orderstatus = 'F') AS f, count(*) AS n FROM orders WHERE o_orderdate <= DATE '2001-08-01')")
def _(spark, sf):
    row = _percentage(spark, sf).select("numerator_value", "denominator_value", "metric_output", "business_data_date")
    return _as_double(row, "numerator_value", "denominator_value", "metric_output")


@query("ag09_ratio_by_group", "SELECT o_orderpriority, round(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 2) AS share FROM orders GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        ratio_percent(F.count_if(F.col("o_orderstatus") == "F"), F.count(F.lit(1))).alias("share"))


@query("ag10_one_metric", "SELECT CAST(count(*) AS DOUBLE) AS metric_output, '2001-07-31' AS business_data_date, true AS no_numerator FROM orders")
def _(spark, sf):
    definition = {"metric_id": "m", "sql": "SELECT count(*) AS metric_output, DATE '2001-07-31' AS business_data_date FROM `w.retail.orders`"}
    with M.table_views(spark, {"w.retail.orders": table(spark, sf, "orders")}):
        row = M.run_metric(spark, definition)
    return row.select(F.col("metric_output").cast("double"), "business_data_date", F.col("numerator_value").isNull().alias("no_numerator"))


_SQL = {
    "count": "SELECT count(*) AS metric_output, {currently} AS business_data_date FROM `w.retail.orders` WHERE o_orderdate <= {currently}",
    "finished": "SELECT count_if(o_orderstatus = 'F') AS numerator_value, count(*) AS denominator_value, "
                "round(100.0 * count_if(o_orderstatus = 'F') / count(*), 2) AS metric_output, {currently} AS business_data_date "
                "FROM `w.retail.orders` WHERE o_orderdate <= {currently}",
    "customers": "SELECT count(DISTINCT o_custkey) AS metric_output, 'override' AS metric_name, {currently} AS business_data_date FROM `w.retail.orders` WHERE o_orderdate <= {currently}",
    "latest_lines": "SELECT count(*) AS metric_output, max(l_shipdate) AS business_data_date FROM `w.retail.lineitem` WHERE l_shipdate = {partition_info}",
    "no_date": "SELECT count(*) AS metric_output FROM `w.retail.orders` WHERE o_orderdate <= {currently}",
    "zero": "SELECT count(*) AS numerator_value, 0 AS denominator_value, {currently} AS business_data_date FROM `w.retail.orders` WHERE o_orderdate = {currently}",
    "no_table": "SELECT count(*) AS metric_output, {currently} AS business_data_date FROM `w.retail.nothing` WHERE d = {currently}",
    "no_partition": "SELECT count(*) AS metric_output FROM `w.retail.unlisted` WHERE d = {partition_info}",
}


def _run(spark, sf):
    tables = {"w.retail.orders": table(spark, sf, "orders"), "w.retail.lineitem": table(spark, sf, "lineitem")}
    rows = [(k, f"Metric {k}", "Count", sql, "daily", " w.m.late " if k == "latest_lines" else "w.m.daily") for k, sql in _SQL.items()]
    defs = spark.createDataFrame(rows, "metric_id string, metric_name string, metric_type string, sql string, dependency string, target_table string")
    info = tables["w.retail.lineitem"].select(F.lit("retail").alias("project_dataset"), F.lit("lineitem").alias("table_name"), F.to_date("l_shipdate").alias("partition_dt"))
    return M.run_metrics(spark, defs, _DAY, P.latest_partition(info), tables, executed_at=_MOMENT)


_RUN_SQL = (
    "WITH o AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f, count(DISTINCT o_custkey) AS c FROM orders WHERE o_orderdate <= DATE '2001-08-01'), "
    "l AS (SELECT max(l_shipdate) AS d FROM lineitem), x AS (SELECT count(*) AS n FROM lineitem WHERE l_shipdate = (SELECT d FROM l)) "
    "SELECT 'w.m.daily' AS target_table, 'count' AS metric_id, 'Metric count' AS metric_name, CAST(NULL AS DOUBLE) AS numerator_value, CAST(NULL AS DOUBLE) AS denominator_value, "
    "CAST(n AS DOUBLE) AS metric_output, '2001-08-01' AS business_data_date, '2001-08-01' AS partition_dt FROM o "
    "UNION ALL SELECT 'w.m.daily', 'finished', 'Metric finished', f, n, CAST(round(100.0 * f / n, 2) AS DOUBLE), '2001-08-01', '2001-08-01' FROM o "
    "UNION ALL SELECT 'w.m.daily', 'customers', 'override', NULL, NULL, c, '2001-08-01', '2001-08-01' FROM o "
    "UNION ALL SELECT 'w.m.late', 'latest_lines', 'Metric latest_lines', NULL, NULL, n, (SELECT strftime(d, '%Y-%m-%d') FROM l), '2001-08-01' FROM x")


@query("ag11_metric_run", _RUN_SQL)
def _(spark, sf):
    good, _ = _run(spark, sf)
    kept = good.select("target_table", "metric_id", "metric_name", "numerator_value", "denominator_value",
                       "metric_output", "business_data_date", "partition_dt")
    return _as_double(kept, "numerator_value", "denominator_value", "metric_output")


@query("ag11_metric_failures",
       "SELECT * FROM (VALUES ('no_date', 'date'), ('zero', 'denominator'), ('no_table', 'table'), ('no_partition', 'partition')) f(metric_id, reason) "
       "WHERE (SELECT count(*) FROM orders) > 0")
def _(spark, sf):
    _, failed = _run(spark, sf)
    text = F.col("error_message")
    reason = (F.when(text.contains("business_data_date"), "date").when(text.contains("denominator_value is 0"), "denominator")
              .when(text.contains("TABLE_OR_VIEW_NOT_FOUND"), "table").when(text.contains("no partition date"), "partition").otherwise(text))
    return failed.select("metric_id", reason.alias("reason"))


@query("ag11_shared_scan",
       "SELECT count(*) AS lines, count(*) FILTER (l_returnflag = 'R') AS returned, CAST(sum(CASE WHEN l_discount > 0.05 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS discounted, "
       "count(DISTINCT l_partkey) AS parts, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS parts_returned, count(DISTINCT l_suppkey) AS suppliers, max(l_quantity) AS most FROM lineitem")
def _(spark, sf):
    row = measure(table(spark, sf, "lineitem"), [
        Measure("lines"), Measure("returned", where="l_returnflag = 'R'"),
        Measure("discounted", "sum", "cast(l_extendedprice AS decimal(18,2))", where="l_discount > 0.05"),
        Measure("parts", "count_distinct", "l_partkey"), Measure("parts_returned", "count_distinct", "l_partkey", where="l_returnflag = 'R'"),
        Measure("suppliers", "count_distinct", "l_suppkey"), Measure("most", "max", "l_quantity")])
    return _as_double(row, "discounted")


_DAILY = [Measure("events"), Measure("purchases", where="event_type = 'purchase'"), Measure("spent", "sum", "cast(value AS decimal(18,2))", where="event_type = 'purchase'", default=0),
          Measure("users", "count_distinct", "user_id"), Measure("buyers", "count_distinct", "user_id", where="event_type = 'purchase'"), Measure("top", "max", "value")]


def _loaded_by_day(spark, sf, measures, exact=True):
    """States of the events, half of the days first, then what is pending, then one day again."""
    events, place = table(spark, sf, "events").withColumn("day", F.to_date("ts")), scratch(spark, "states")
    days = pending(spark, place, events, "day")
    load_states(spark, place, events, measures, "day", days[:len(days) // 2], exact)
    load_states(spark, place, events, measures, "day", pending(spark, place, events, "day"), exact)
    load_states(spark, place, events, measures, "day", days[:1], exact)
    return place


@query("ag11_merged_states",
       "SELECT count(*) AS events, count(*) FILTER (event_type = 'purchase') AS purchases, CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'purchase'), 0) AS DOUBLE) AS spent, "
       "count(DISTINCT user_id) AS users, count(DISTINCT user_id) FILTER (event_type = 'purchase') AS buyers, max(value) AS top FROM events")
def _(spark, sf):
    return _as_double(merge_states(spark, _loaded_by_day(spark, sf, _DAILY), _DAILY), "spent")


@query("ag02_merged_sketches", "SELECT count(*) AS events, true AS users_near, true AS buyers_near FROM events")
def _(spark, sf):
    merged = merge_states(spark, _loaded_by_day(spark, sf, _DAILY, exact=False), _DAILY, exact=False)
    true = measure(table(spark, sf, "events"), _DAILY).select(F.col("users").alias("u"), F.col("buyers").alias("b"))
    near = lambda found, exact: F.abs(F.col(found) - F.col(exact)) <= 0.03 * F.col(exact)
    return combine_one_row(spark, [merged, true]).select("events", near("users", "u").alias("users_near"), near("buyers", "b").alias("buyers_near"))


# raw numbers in every shape a metric may return
_RAW = ("CASE event_type WHEN 'click' THEN 'n/a' WHEN 'view' THEN '' || CAST(event_id AS VARCHAR(20)) || '.5' "
        "WHEN 'signup' THEN '123456789012345678901234567890123456' WHEN 'error' THEN NULL ELSE '-' || CAST(event_id AS VARCHAR(20)) END")


@query("ag12_numeric_normalise",
       f"SELECT event_id, CAST(TRY_CAST(raw AS DECIMAL(38,9)) AS DOUBLE) AS number, CASE WHEN raw IS NOT NULL AND TRY_CAST(raw AS DECIMAL(38,9)) IS NULL "
       f"THEN 'v: not a DECIMAL(38,9)' END AS warning FROM (SELECT event_id, {_RAW} AS raw FROM events)")
def _(spark, sf):
    raw = table(spark, sf, "events").selectExpr("event_id", f"{_RAW} AS raw")
    return raw.select("event_id", to_metric_decimal(F.col("raw")).cast("double").alias("number"), numeric_warning("v", F.col("raw")).alias("warning"))


_DENOMINATOR = ("CASE event_type WHEN 'click' THEN 0.0 WHEN 'view' THEN -value WHEN 'signup' THEN NULL WHEN 'error' THEN value * 1e-10 ELSE value END")


@query("ag13_denominator",
       f"SELECT event_id, CASE WHEN d IS NULL THEN 'SKIP' WHEN d = 0 THEN 'ZERO' WHEN d < 0 THEN 'NEGATIVE' WHEN d < 1e-7 THEN 'TINY' ELSE 'OK' END AS status "
       f"FROM (SELECT event_id, {_DENOMINATOR} AS d FROM events)")
def _(spark, sf):
    raw = table(spark, sf, "events").selectExpr("event_id", f"{_DENOMINATOR} AS d")
    return raw.select("event_id", denominator_status(F.col("d")).alias("status"))


_DATE_TEXT = ("CASE event_type WHEN 'click' THEN 'soon' WHEN 'view' THEN '2024-13-01' WHEN 'signup' THEN NULL ELSE substr(CAST(ts AS VARCHAR(40)), 1, 10) END")


@query("ag14_business_date",
       f"SELECT event_id, CASE WHEN regexp_full_match(s, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST(s AS DATE) IS NOT NULL THEN s END AS from_text, "
       f"strftime(ts, '%Y-%m-%d') AS from_timestamp, CAST(NULL AS VARCHAR) AS from_number FROM (SELECT event_id, ts, {_DATE_TEXT} AS s FROM events)")
def _(spark, sf):
    raw = table(spark, sf, "events").selectExpr("event_id", "ts", f"{_DATE_TEXT} AS s", "value")
    types = {f.name: f.dataType for f in raw.schema}
    return raw.select("event_id", business_date(F.col("s"), types["s"]).alias("from_text"),
                      business_date(F.col("ts"), types["ts"]).alias("from_timestamp"),
                      business_date(F.col("value"), types["value"]).alias("from_number"))


@query("ag15_column_map",
       "SELECT CAST(count(*) AS DOUBLE) AS metric_output, CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) AS numerator_value, max(o_orderpriority) AS top_priority, "
       "strftime(max(o_orderdate), '%Y-%m-%d') AS business_data_date FROM orders")
def _(spark, sf):
    columns = (ColumnMap().update({"metric_output": "total", "numerator_value": "done", "business_data_date": "as_at"})
               .add("top_priority", "prio"))
    definition = {"metric_id": "m", "sql": "SELECT count(*) AS total, count_if(o_orderstatus = 'F') AS done, max(o_orderpriority) AS prio, "
                                           "max(o_orderdate) AS as_at FROM `w.retail.orders`"}
    with M.table_views(spark, {"w.retail.orders": table(spark, sf, "orders")}):
        row = M.run_metric(spark, definition, columns=columns)
    return _as_double(row.select("metric_output", "numerator_value", "top_priority", "business_data_date"), "metric_output", "numerator_value")


@query("ag16_build_records",
       "SELECT 'status_' || o_orderstatus AS metric_id, CASE o_orderstatus WHEN 'F' THEN 'from SQL' ELSE 'Orders ' || o_orderstatus END AS metric_name, "
       "CAST(count(*) AS DOUBLE) AS metric_output, '2001-08-01' AS partition_dt, '2001-08-02 00:00:00' AS pipeline_execution_ts FROM orders GROUP BY o_orderstatus")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    key = F.concat(F.lit("status_"), F.col("o_orderstatus"))
    counts = orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("string")
    values = counts.select(
        key.alias("key"), none.alias("metric_id"), F.when(F.col("o_orderstatus") == "F", "from SQL").alias("metric_name"),
        none.alias("metric_type"), none.alias("metric_description"), none.alias("frequency"),
        *[F.lit(None).cast("decimal(38,9)").alias(c) for c in ("numerator_value", "denominator_value")],
        F.col("n").cast("decimal(38,9)").alias("metric_output"), F.lit("2001-08-01").alias("business_data_date"))
    defs = counts.select(key.alias("metric_id"), F.concat(F.lit("Orders "), F.col("o_orderstatus")).alias("metric_name"),
                         F.lit("Count").alias("metric_type"), none.alias("metric_description"), none.alias("frequency"),
                         F.lit("w.m.daily").alias("target_table"))
    rows = M.build_records(values, defs, _DAY, _MOMENT)
    return rows.select("metric_id", "metric_name", F.col("metric_output").cast("double"), "partition_dt",
                       F.date_format("pipeline_execution_ts", "yyyy-MM-dd HH:mm:ss").alias("pipeline_execution_ts"))


@query("ag17_time_limit", "SELECT 'all' AS metric_id, count(*) AS n, 'done' AS state FROM orders UNION ALL SELECT 'open', count(*), 'done' FROM orders WHERE o_orderstatus <> 'F' "
       "UNION ALL SELECT 'slow', NULL, 'cancelled' FROM (SELECT count(*) FROM orders)")
def _(spark, sf):
    sqls = {"all": "SELECT count(*) AS metric_output, {currently} AS business_data_date FROM `w.retail.orders`",
            "slow": "SELECT count_if(id % 7 = (SELECT count(*) % 7 FROM `w.retail.orders`)) AS metric_output, {currently} AS business_data_date FROM range(5000000000000)",
            "open": "SELECT count(*) AS metric_output, {currently} AS business_data_date FROM `w.retail.orders` WHERE o_orderstatus <> 'F'"}
    defs = spark.createDataFrame([(k, k, "Count", sql, "daily", "w.m.daily") for k, sql in sqls.items()],
                                 "metric_id string, metric_name string, metric_type string, sql string, dependency string, target_table string")
    info = table(spark, sf, "orders").select(F.lit("retail").alias("project_dataset"), F.lit("orders").alias("table_name"), F.to_date("o_orderdate").alias("partition_dt"))
    good, failed = M.run_metrics(spark, defs, _DAY, P.latest_partition(info), {"w.retail.orders": table(spark, sf, "orders")}, timeout=10)
    done = good.select("metric_id", F.col("metric_output").cast("bigint").alias("n"), F.lit("done").alias("state"))
    cut = failed.select("metric_id", F.lit(None).cast("bigint").alias("n"), F.when(F.lower("error_message").contains("cancel"), "cancelled").otherwise("failed").alias("state"))
    return done.unionByName(cut)


@query("ag18_result_columns", "SELECT 'as_at' AS required_missing, 'done' AS optional_missing, count(*) AS metric_output FROM orders")
def _(spark, sf):
    columns = ColumnMap({"metric_output": "total", "numerator_value": "done", "business_data_date": "as_at"})
    result = table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("total"))
    required, optional = columns.missing(result)
    return result.select(F.lit(",".join(required)).alias("required_missing"), F.lit(",".join(optional)).alias("optional_missing"),
                         columns.value(result, "metric_output").alias("metric_output"))


flagship = _percentage
