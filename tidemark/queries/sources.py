"""Files and tables written by Spark from the given data and read back."""

import datetime as dt

from pyspark.sql import functions as F

from ..sources import (append, bad_cells, export_csv, load_csv_folder, load_csv_typed, row_hash, schema_from_ddl, stamp_audit,
                       write_targets, write_targets_staged)
from ..sources.definitions import check_path, read_metric_defs
from .base import DEFS_SQL, derived_defs, query, scratch, table


_DEFINITION = "metric_id, metric_name, metric_type, sql, dependency, target_table, partition_mode"


@query("io01_definition_files", f"WITH {DEFS_SQL}, r AS (SELECT count(*) AS n FROM part) SELECT {_DEFINITION}, n AS numbered FROM defs, r")
def _(spark, sf):
    # files of at most 500 definitions, each a JSON array
    path = scratch(spark, "definitions")
    records = derived_defs(spark, sf).withColumn("file", F.floor(F.col("record_index") / 500)).drop("record_index")
    arrays = records.groupBy("file").agg(F.array_join(F.collect_list(F.to_json(F.struct(*[c for c in records.columns if c != "file"]))), ",").alias("items"))
    arrays.select("file", F.concat(F.lit("["), "items", F.lit("]")).alias("value")).write.partitionBy("file").text(path)
    found = read_metric_defs(spark, check_path(spark, path, require_scheme=False))
    numbered = found.agg(F.count_distinct("record_index")).scalar()
    return found.selectExpr(*_DEFINITION.split(", ")).withColumn("numbered", numbered)


@query("io04_append", "SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY o_orderstatus")
def _(spark, sf):
    orders, path = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), scratch(spark, "append")
    append(orders.where("o_orderstatus = 'F'"), path, ["o_orderstatus"])
    append(orders.where("o_orderstatus <> 'F'"), path, ["o_orderstatus"])
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("io06_multi_target",
       "SELECT CASE o_orderstatus WHEN 'F' THEN 'done' ELSE 'open' END AS target, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "w.m.done").otherwise("w.m.open").alias("target_table"))
    done, open_ = scratch(spark, "done"), scratch(spark, "open")
    write_targets(orders, {"w.m.done": done, "w.m.open": open_})
    both = spark.read.parquet(done).withColumn("target", F.lit("done")).unionByName(
        spark.read.parquet(open_).withColumn("target", F.lit("open")))
    return both.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("io06_many_targets",
       "SELECT CAST(o_custkey % 200 AS INT) AS target, o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1, 2")
def _(spark, sf):
    # two hundred targets, written twice, each partitioned; half of the orders first
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_custkey") % 200).cast("string").alias("target_table"))
    place = scratch(spark, "many")
    routes = {str(i): f"{place}/target={i}" for i in range(200)}
    for part in (orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 <> 0")):
        write_targets_staged(part, routes, ["o_orderstatus"])
    return spark.read.parquet(place).groupBy("target", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("io07_csv_typed", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, c_acctbal > 0 AS rich FROM customer")
def _(spark, sf):
    customers = table(spark, sf, "customer").withColumns({
        "c_mktsegment": F.nullif("c_mktsegment", F.lit("BUILDING")), "rich": F.col("c_acctbal") > 0,
        "c_acctbal": F.col("c_acctbal").cast("decimal(18,2)")})
    path = scratch(spark, "csv")
    export_csv(customers, path)
    return load_csv_typed(spark, path).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("io07_bad_cells",
       "SELECT CAST(o_orderkey AS VARCHAR) AS first_cell, 'o_totalprice' AS column_name, 'about ' || CAST(o_totalprice AS DECIMAL(18,2)) AS cell, 'decimal(38,9)' AS data_type FROM orders WHERE o_orderstatus = 'P' "
       "UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'o_orderdate', '0000' || strftime(o_orderdate, '-%m-%d') || 'x', 'date' FROM orders WHERE o_orderpriority = '1-URGENT'")
def _(spark, sf):
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("about "), price)).otherwise(price).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("0000"), F.date_format("o_orderdate", "-MM-dd"), F.lit("x")))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"))
    path = scratch(spark, "bad")
    export_csv(orders, path)
    return bad_cells(spark, path, [{"name": "o_orderkey", "type": "INT64"}, {"name": "o_totalprice", "type": "NUMERIC"}, {"name": "o_orderdate", "type": "DATE"}])


@query("io07_csv_texts", "SELECT doc_id, lang, n_chars, md5(regexp_replace(text, '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g')) AS text_hash FROM documents")
def _(spark, sf):
    path = scratch(spark, "texts")
    export_csv(table(spark, sf, "documents").select("doc_id", "lang", "n_chars", "text"), path)
    rows = load_csv_typed(spark, path, multiline=True)
    return rows.select("doc_id", "lang", "n_chars", F.md5(F.regexp_replace("text", r"^[ \t\r\n]+|[ \t\r\n]+$", "")).alias("text_hash"))


@query("io08_csv_folder",
       "SELECT 'w-bld-77.w_bld.parties' AS table_name, CAST(c_custkey AS BIGINT) AS id, c_name AS name FROM customer UNION ALL SELECT 'w-bld-77.w_bld.parties', s_suppkey, s_name FROM supplier "
       "UNION ALL SELECT 'w-bld-77.w_bld.parts', p_partkey, p_name FROM part")
def _(spark, sf):
    folder = scratch(spark, "folder")
    for name, key, label in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("part", "p_partkey", "p_name"), ("nation", "n_nationkey", "n_name")):
        export_csv(table(spark, sf, name).select(F.col(key).alias("id"), F.col(label).alias("name")), f"{folder}/{name}.csv")
    parties, parts = "w-<env>-<project_code>.w_<env>.parties", "w-<env>-<project_code>.w_<env>.parts"
    tables, _ = load_csv_folder(spark, folder, {"customer.csv": parties, "supplier.csv": parties, "part.csv": parts}, "bld", {"w": "77"})
    one, two = [df.select(F.lit(name).alias("table_name"), "id", "name") for name, df in tables.items()]
    return one.unionByName(two)


@query("io09_export",
       "SELECT event_id || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN ts = date_trunc('second', ts) THEN '' ELSE strftime(ts, '.%f') END || '|' || strftime(ts, '%Y-%m-%d') || '|' || (value > 50) || '|' || coalesce(nullif(event_type, 'click'), '') AS line FROM events "
       "UNION ALL SELECT 'event_id|ts|day|high|event_type' WHERE (SELECT count(*) FROM events) > 0")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", F.to_date("ts").alias("day"), (F.col("value") > 50).alias("high"),
                                               F.nullif("event_type", F.lit("click")).alias("event_type"))
    path = scratch(spark, "export")
    export_csv(events, path, sep="|")
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    # each file repeats the header
    header = F.col("line").startswith("event_id|")
    return lines.where(~header).unionByName(lines.where(header).distinct())


_DDL = [{"name": "o_orderkey", "type": "INT64", "mode": "REQUIRED"}, {"name": "o_orderdate", "type": "date"},
        {"name": "o_totalprice", "type": "NUMERIC"}, {"name": "o_orderpriority", "type": "STRING"}, {"name": "is_big", "type": "BOOL"}]


@query("io10_ddl_load", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice, o_orderpriority, o_totalprice > 250000 AS is_big FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), F.col("o_totalprice").cast("decimal(18,2)"),
                                               "o_orderpriority", (F.col("o_totalprice") > 250000).alias("is_big"))
    path = scratch(spark, "ddl")
    export_csv(orders, path)
    rows = load_csv_typed(spark, path, _DDL)
    assert [f.dataType for f in rows.schema] == [f.dataType for f in schema_from_ddl(_DDL)]
    return rows.withColumns({"o_orderdate": F.col("o_orderdate").cast("string"), "o_totalprice": F.col("o_totalprice").cast("double")})


@query("io11_stamp_audit",
       "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS partition_dt, 'I' AS dml_type, 'ERP' AS source_system, 'B1' AS batch_id, '2001-08-02 01:00:00' AS load_ts, "
       "'orders_' || strftime(o_orderdate, '%Y%m%d') || '.dat' AS source_file_name FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("partition_dt"))
    rows = stamp_audit(orders, {"source_system": "ERP", "batch_id": "B1", "load_ts": dt.datetime(2001, 8, 2, 1)}, "orders_YYYYMMDD.dat")
    return rows.withColumns({"partition_dt": F.col("partition_dt").cast("string"), "load_ts": F.date_format("load_ts", "yyyy-MM-dd HH:mm:ss")})


@query("io11_file_suffix", "SELECT l_orderkey, l_linenumber, 'lines_' || strftime(l_shipdate, '%Y%m%d') || '.csv' AS source_file_name FROM lineitem")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return stamp_audit(lines, {}, "lines", day="l_shipdate").select("l_orderkey", "l_linenumber", "source_file_name")


@query("io12_row_hash",
       "SELECT o_orderkey, sha256('{\"o_orderkey\":' || o_orderkey || ',\"o_custkey\":' || o_custkey || ',\"o_orderstatus\":' || "
       "coalesce('\"' || nullif(o_orderstatus, 'P') || '\"', 'null') || '}') AS record_hash FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    return orders.select("o_orderkey", row_hash(orders).alias("record_hash"))
