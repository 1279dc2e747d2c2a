"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8).
"""

import datetime as dt
import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.operators import partitions as P
from tidemark.operators.aggregates import Measure, measure
from tidemark.plans import metrics as M
from tidemark.plans import quality as Q
from tidemark.queries import QUERIES
from tidemark.queries.base import table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# registered queries that carry the load of a daily run
HEADLINE = [
    "ag09_percentage_metric", "ag11_shared_scan", "pt05_latest_partitions_batched", "rl05_left_join_hot_key",
    "rl07_inner_join", "up03_overwrite_by_key", "io05_overwrite_partitions", "dq08_unique_composite", "dq09_orphans",
    "dq14_bindings", "rc02_recon_rows", "sc01_classify_all_days", "sc06_build_history", "hr1_nearest_ancestor",
    "cp1_compare_tables", "vd_all_problems",
]


def hundred_measures():
    """100 metrics of lineitem with their own filters."""
    kinds = [("count", None), ("sum", "cast(l_quantity AS bigint)"), ("max", "l_extendedprice"), ("min", "l_discount")]
    return [Measure(f"m{i}_{k}", kinds[k][0], kinds[k][1], where=f"l_quantity > {i * 2} AND l_returnflag <> 'N'")
            for i in range(25) for k in range(4)]


def metrics_one_scan(spark):
    return measure(table(spark, SF_DIR, "lineitem"), hundred_measures())


def metrics_one_query_each(spark):
    lines = table(spark, SF_DIR, "lineitem")
    for m in hundred_measures():
        measure(lines, [m]).collect()
    return None


def metrics_sql_run(spark):
    """100 SQL definitions over two tables and two dates, checked and built into rows."""
    tables = {"w.retail.orders": table(spark, SF_DIR, "orders"), "w.retail.lineitem": table(spark, SF_DIR, "lineitem")}
    text = {"orders": "SELECT count_if(o_totalprice > {n}000) AS numerator_value, count(*) AS denominator_value, {{currently}} AS business_data_date "
                      "FROM `w.retail.orders` WHERE o_orderdate <= {{currently}}",
            "lineitem": "SELECT count_if(l_quantity > {n} / 2) AS metric_output, max(l_shipdate) AS business_data_date "
                        "FROM `w.retail.lineitem` WHERE l_shipdate <= {{partition_info}}"}
    rows = [(f"{name}_{n}", f"{name} {n}", "Count", sql.format(n=n), "daily", "w.m.daily") for name, sql in text.items() for n in range(50)]
    defs = spark.createDataFrame(rows, "metric_id string, metric_name string, metric_type string, sql string, dependency string, target_table string")
    info = tables["w.retail.lineitem"].select(F.lit("retail").alias("project_dataset"), F.lit("lineitem").alias("table_name"),
                                              F.to_date("l_shipdate").alias("partition_dt"))
    good, failed = M.run_metrics(spark, defs, dt.date(2001, 8, 1), P.latest_partition(info), tables)
    assert failed.isEmpty()
    return good


def fifty_rules(spark, together=True):
    """50 row rules on lineitem in one scan, or in one run each."""
    uri = "projects/w/datasets/retail/tables/lineitem"
    rules = {f"R{i}": {"rule_type": "RANGE", "dimension": "validity", "params": {"min": i, "max": 50}} for i in range(50)}
    bindings = {f"B{i}": {"entity_uri": uri, "column_id": "l_quantity", "row_filter_id": "NONE", "rule_ids": [f"R{i}"]} for i in range(50)}
    lines = {"w.retail.lineitem": table(spark, SF_DIR, "lineitem")}
    if together:
        return Q.run_dq(spark, {"rules": rules, "rule_bindings": bindings}, lines, dt.date(2001, 8, 1))
    for name, binding in bindings.items():
        Q.run_dq(spark, {"rules": rules, "rule_bindings": {name: binding}}, lines, dt.date(2001, 8, 1)).collect()
    return None


def timed(run):
    start = time.perf_counter()
    df = run()
    if df is not None:
        df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main():
    spark = (SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    table(spark, SF_DIR, "orders").groupBy("o_orderstatus").count().collect()
    # the better of two runs, so that class loading and compilation are not counted
    seconds = {name: min(timed(lambda: QUERIES[name](spark, SF_DIR)) for _ in range(2)) for name in HEADLINE}
    seconds["metrics_100_one_scan"] = timed(lambda: metrics_one_scan(spark))
    seconds["metrics_100_one_query_each"] = timed(lambda: metrics_one_query_each(spark))
    seconds["metrics_100_sql_definitions"] = timed(lambda: metrics_sql_run(spark))
    seconds["dq_50_rules_one_scan"] = timed(lambda: fifty_rules(spark))
    seconds["dq_50_rules_one_run_each"] = timed(lambda: fifty_rules(spark, together=False))
    compared = ("metrics_100_one_query_each", "dq_50_rules_one_run_each")
    total = sum(s for name, s in seconds.items() if name not in compared)
    print(json.dumps({"metric": "headline queries, total", "value": round(total, 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
