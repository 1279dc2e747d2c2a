"""Scalar functions metrics use, on columns of the tables."""

from pyspark.sql import functions as F

from ..functions import safe_divide, strict_date
from .base import AS_OF, query, table


def _probe(name, source, key, sql, column):
    """Register ``column`` over a whole table, next to its key."""
    @query(name, f"SELECT {key}, {sql} AS result FROM {source}")
    def _(spark, sf):
        return table(spark, sf, source).select(key, column().alias("result"))


_probe("fn01_round", "lineitem", "l_orderkey", "CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) / 7, 2) AS DOUBLE)",
       lambda: F.round(F.col("l_extendedprice").cast("decimal(18,2)").cast("double") / 7, 2))
_probe("fn02_coalesce", "orders", "o_orderkey", "coalesce(nullif(o_orderstatus, 'P'), o_orderpriority)",
       lambda: F.coalesce(F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority"))
_probe("fn03_case", "orders", "o_orderkey",
       "CASE WHEN o_totalprice > 400000 THEN 'high' WHEN nullif(o_orderstatus, 'F') = 'O' THEN 'open' ELSE 'rest' END",
       lambda: F.when(F.col("o_totalprice") > 400000, "high").when(F.nullif("o_orderstatus", F.lit("F")) == "O", "open").otherwise("rest"))
_probe("fn04_as_of", "events", "event_id", "CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-01-30') AS INTEGER)",
       lambda: F.date_diff(F.lit(AS_OF), F.to_date("ts")))
_probe("fn05_date_of", "events", "event_id", "strftime(CAST(ts AS DATE), '%Y-%m-%d')", lambda: F.to_date("ts").cast("string"))
_probe("fn06_parse_format_date", "orders", "o_orderkey",
       "strftime(TRY_CAST(strftime(o_orderdate, '%Y-%m-') || lpad(CAST(o_orderkey % 40 AS VARCHAR), 2, '0') AS DATE), '%d/%m/%Y')",
       lambda: F.date_format(strict_date(F.concat(F.date_format("o_orderdate", "yyyy-MM-"),
                                                  F.lpad((F.col("o_orderkey") % 40).cast("string"), 2, "0"))), "dd/MM/yyyy"))
_probe("fn07_date_sub", "orders", "o_orderkey", "strftime(CAST(o_orderdate AS DATE) - 30, '%Y-%m-%d')",
       lambda: F.date_sub("o_orderdate", 30).cast("string"))
_probe("fn08_date_trunc", "orders", "o_orderkey", "strftime(date_trunc('month', o_orderdate), '%Y-%m-%d')",
       lambda: F.trunc("o_orderdate", "MM").cast("string"))
_probe("fn09_extract_year", "orders", "o_orderkey", "CAST(year(o_orderdate) AS INTEGER)", lambda: F.year("o_orderdate"))
_probe("fn10_timestamp_sub", "events", "event_id", "strftime(ts - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S')",
       lambda: F.date_format(F.col("ts") - F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd HH:mm:ss"))
_probe("fn11_infinity_nan", "events", "event_id",
       "CASE event_type WHEN 'click' THEN NULL WHEN 'view' THEN NULL ELSE CAST(CAST(value AS DECIMAL(38,9)) AS DOUBLE) END",
       lambda: F.when(F.col("event_type") == "click", F.lit(float("inf"))).when(F.col("event_type") == "view", F.lit(float("nan")))
       .otherwise(F.col("value")).try_cast("decimal(38,9)").cast("double"))
_probe("fn12_regex", "part", "p_partkey", "regexp_full_match(p_brand, 'Brand#[0-9]{2}')", lambda: F.col("p_brand").rlike("^Brand#[0-9]{2}$"))
_probe("fn13_text", "part", "p_partkey", "upper(trim(' ' || replace(p_brand, '#', '-') || ' ')) || substr(p_name, 1, 3)",
       lambda: F.concat(F.upper(F.trim(F.concat(F.lit(" "), F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit(" ")))), F.substring("p_name", 1, 3)))
_probe("fn14_json_hash", "orders", "o_orderkey", "sha256('{\"k\":' || o_orderkey || ',\"s\":\"' || o_orderstatus || '\"}')",
       lambda: F.sha2(F.to_json(F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))), 256))


@query("fn06_safe_divide", "SELECT event_id, round(100 / nullif(CAST(floor(value / 40) AS BIGINT), 0), 6) AS result FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(safe_divide(
        F.lit(100), F.floor(F.col("value") / 40)), 6).alias("result"))


@query("fn15_named_parameter", "SELECT p_partkey FROM part WHERE p_name = 'it''s'  OR p_name = 'red bolt'")
def _(spark, sf):
    # values with quotes go in as parameters, nothing is escaped into text
    return spark.sql("SELECT p_partkey FROM {part} WHERE p_name IN (:a, :b)", args={"a": "it's", "b": "red bolt"},
                     part=table(spark, sf, "part"))


@query("fn16_seeded_random", "SELECT count(*) AS n, true AS within, count(*) AS same FROM events")
def _(spark, sf):
    draw = lambda name: table(spark, sf, "events").select("event_id", F.rand(42).alias(name))
    both = draw("r").join(draw("again"), "event_id")
    return both.agg(F.count("r").alias("n"), ((F.min("r") >= 0) & (F.max("r") < 1)).alias("within"), F.count_if(F.col("r") == F.col("again")).alias("same"))
