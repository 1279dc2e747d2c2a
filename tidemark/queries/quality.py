"""Data-quality rules, one scan per table, and their summaries."""

import datetime as dt

from pyspark.sql import functions as F

from ..operators import rules as R
from ..plans import quality as Q
from .base import AS_OF, query, table

_NOW = dt.datetime(2024, 1, 30, 12)


def _summary_sql(source: str, checks: list[tuple]) -> str:
    """One SELECT per check: (binding, rule, column, filter, pass condition)."""
    parts = [
        f"SELECT '{b}' AS rule_binding_id, '{r}' AS rule_id, count(*) FILTER ({flt}) AS rows_validated, "
        f"count(*) FILTER (({flt}) AND ({ok})) AS success_count, count(*) FILTER (({flt}) AND NOT ({ok})) AS failed_count, "
        f"count(*) FILTER (({flt}) AND {col} IS NULL) AS null_count FROM {source}" for b, r, col, flt, ok in checks]
    return ("SELECT *, round(success_count * 100.0 / nullif(rows_validated, 0), 2)::DOUBLE AS success_percentage, "
            "round(failed_count * 100.0 / nullif(rows_validated, 0), 2)::DOUBLE AS failed_percentage, "
            "round(null_count * 100.0 / nullif(rows_validated, 0), 2)::DOUBLE AS null_percentage FROM (" + " UNION ALL ".join(parts) + ")")


_COUNTS = ["rule_binding_id", "rule_id", "rows_validated", "success_count", "failed_count", "null_count",
           "success_percentage", "failed_percentage", "null_percentage"]


def _spec(bindings: dict, rules: dict, filters: dict | None = None, table_name: str = "w.d.t") -> dict:
    uri = "bigquery://projects/{}/datasets/{}/tables/{}".format(*table_name.split("."))
    return {"row_filters": {n: {"filter_sql_expr": e} for n, e in (filters or {}).items()}, "rules": rules,
            "rule_bindings": {b: {"entity_uri": uri, "column_id": c, "row_filter_id": f, "rule_ids": r} for b, (c, f, r) in bindings.items()},
            "metadata_registry_defaults": {"dataplex": {"lakes": "lake", "zones": "raw"}}}


def _run(spark, df, spec, as_of=AS_OF, name="w.d.t", more=None):
    return Q.run_dq(spark, spec, {name: df, **(more or {})}, as_of, "inv-1", "run-1", _NOW)


def _rule(kind, dimension, **params):
    return {"rule_type": kind, "dimension": dimension, "params": params}


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_acctbal")


@query("dq01_not_null", _summary_sql("(SELECT *, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)", [("b", "NOT_NULL", "segment", "true", "segment IS NOT NULL")]))
def _(spark, sf):
    spec = _spec({"b": ("segment", "NONE", ["NOT_NULL"])}, {"NOT_NULL": _rule("NOT_NULL", "completeness")})
    return _run(spark, _customers(spark, sf), spec).select(_COUNTS)


_BLANKED = "CASE lang WHEN 'fr' THEN ' \t' WHEN 'de' THEN NULL ELSE text END"


@query("dq02_not_blank", _summary_sql(f"(SELECT {_BLANKED} AS body FROM documents)", [("b", "NOT_BLANK", "body", "true", "NOT regexp_full_match(body, '\\s*')")]))
def _(spark, sf):
    spec = _spec({"b": ("body", "NONE", ["NOT_BLANK"])}, {"NOT_BLANK": _rule("NOT_BLANK", "completeness")})
    docs = table(spark, sf, "documents").select(F.when(F.col("lang") == "fr", " \t").when(F.col("lang") == "de", None).otherwise(F.col("text")).alias("body"))
    return _run(spark, docs, spec).select(_COUNTS)


@query("dq03_regex", _summary_sql("part", [("b", "BRAND", "p_brand", "true", "regexp_full_match(p_brand, 'Brand#[0-9]{2}')")]))
def _(spark, sf):
    spec = _spec({"b": ("p_brand", "NONE", ["BRAND"])}, {"BRAND": _rule("REGEX", "conformance", pattern="^Brand#[0-9]{2}$")})
    return _run(spark, table(spark, sf, "part"), spec).select(_COUNTS)


@query("dq04_range", _summary_sql("lineitem", [("b", "CLOSED", "l_quantity", "true", "l_quantity BETWEEN 2 AND 49"), ("b", "OPEN", "l_quantity", "true", "l_quantity >= 10")]))
def _(spark, sf):
    spec = _spec({"b": ("l_quantity", "NONE", ["CLOSED", "OPEN"])}, {
        "CLOSED": _rule("RANGE", "validity", min=2, max=49), "OPEN": _rule("RANGE", "validity", min=10, max=None)})
    return _run(spark, table(spark, sf, "lineitem"), spec).select(_COUNTS)


@query("dq05_expression", _summary_sql("orders", [
    ("status", "SET", "o_orderstatus", "true", "nullif(o_orderstatus, 'P') IN ('F')"),
    ("day", "NOT_FUTURE", "o_orderdate", "true", "o_orderdate <= DATE '1999-12-31'")]))
def _(spark, sf):
    spec = _spec({"status": ("o_orderstatus", "NONE", ["SET"]), "day": ("o_orderdate", "NONE", ["NOT_FUTURE"])}, {
        "SET": _rule("CUSTOM_SQL_EXPR", "validity", custom_sql_expr="nullif($column, 'P') IN ('F')"),
        "NOT_FUTURE": _rule("CUSTOM_SQL_EXPR", "validity", custom_sql_expr="$column <= :as_of")})
    return _run(spark, table(spark, sf, "orders"), spec, dt.date(1999, 12, 31)).select(_COUNTS)


@query("dq06_statement",
       "WITH s AS (SELECT count(*) AS n FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey HAVING count(*) > 5)), t AS (SELECT count(*) AS r FROM orders WHERE o_orderstatus = 'F') "
       "SELECT 'b' AS rule_binding_id, 'BUSY' AS rule_id, r AS rows_validated, r - n AS success_count, n AS failed_count, 0::BIGINT AS null_count, "
       "round((r - n) * 100.0 / r, 2)::DOUBLE AS success_percentage, round(n * 100.0 / r, 2)::DOUBLE AS failed_percentage, 0::DOUBLE AS null_percentage FROM s, t")
def _(spark, sf):
    spec = _spec({"b": ("o_custkey", "DONE", ["BUSY"])}, {"BUSY": _rule("CUSTOM_SQL_STATEMENT", "uniqueness", custom_sql_statement=(
        "SELECT count(*) AS n FROM (SELECT o_custkey FROM $table GROUP BY o_custkey HAVING count(*) > 5)"))}, {"DONE": "o_orderstatus = 'F'"})
    return _run(spark, table(spark, sf, "orders"), spec).select(_COUNTS)


@query("dq13_filtered_unique",
       "WITH f AS (SELECT o_custkey, o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT'), m AS (SELECT count(*) AS r, max(o_orderdate) AS last FROM f), "
       "u AS (SELECT count(*) AS n FROM (SELECT o_custkey FROM f GROUP BY o_custkey HAVING count(*) > 1)) SELECT rule_id, r AS rows_validated, r - bad AS success_count, bad AS failed_count FROM "
       "(SELECT 'ONCE' AS rule_id, r, n AS bad FROM u, m UNION ALL SELECT 'MANY', r, CASE WHEN r < 1000000000 THEN 1::BIGINT ELSE 0 END FROM m UNION ALL "
       "SELECT 'FRESH', r, CASE WHEN last < DATE '2030-01-01' THEN 1::BIGINT ELSE 0 END FROM m)")
def _(spark, sf):
    rules = {"ONCE": _rule("UNIQUE", "uniqueness", keys=["o_custkey"]), "MANY": _rule("MIN_ROW_COUNT", "completeness", least=1_000_000_000), "FRESH": _rule("FRESHNESS", "timeliness")}
    spec = _spec({"b": ("o_orderdate", "URGENT", list(rules))}, rules, {"URGENT": "o_orderpriority = '1-URGENT'"})
    return _run(spark, table(spark, sf, "orders"), spec, dt.date(2030, 1, 1)).select("rule_id", "rows_validated", "success_count", "failed_count")


@query("dq07_unique_key", "SELECT count(*) AS n FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1)")
def _(spark, sf):
    return R.dup_keys(table(spark, sf, "orders"), ["o_custkey"])


_KEY_SETS = {"line": ["l_orderkey", "l_linenumber"], "order": ["l_orderkey"], "supply": ["l_partkey", "l_suppkey"], "shipped": ["l_shipdate", "l_partkey", "l_suppkey"],
             "again": ["l_linenumber", "l_orderkey"]}


@query("dq08_many_key_sets", " UNION ALL ".join(
    f"SELECT '{name}' AS key_set, count(*) AS n FROM (SELECT {', '.join(keys)} FROM lineitem GROUP BY ALL HAVING count(*) > 1)" for name, keys in _KEY_SETS.items()))
def _(spark, sf):
    return R.dup_key_sets(table(spark, sf, "lineitem"), _KEY_SETS)


@query("dq08_unique_composite", "SELECT count(*) AS n FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)")
def _(spark, sf):
    return R.dup_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _keyed(spark, sf, name, key, condition):
    """A whole table whose key is missing where the condition fails, so that some children have no parent."""
    return table(spark, sf, name).withColumn(key, F.when(F.expr(condition), F.col(key)))


@query("dq09_orphans", "SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')")
def _(spark, sf):
    return R.orphans(table(spark, sf, "lineitem"), _keyed(spark, sf, "orders", "o_orderkey", "o_orderstatus <> 'P'"), ["l_orderkey"], ["o_orderkey"])


@query("dq09_orphan_rows", "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)")
def _(spark, sf):
    return R.orphan_rows(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), _keyed(spark, sf, "customer", "c_custkey", "c_acctbal > 0"), ["o_custkey"], ["c_custkey"])


@query("dq10_freshness",
       "SELECT CASE WHEN max(CAST(ts AS DATE)) < DATE '2024-01-30' THEN 1 ELSE 0 END AS today, CASE WHEN max(CAST(ts AS DATE)) < DATE '2024-01-31' THEN 1 ELSE 0 END AS tomorrow FROM events")
def _(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").agg(R.stale_flag(ts, AS_OF).alias("today"), R.stale_flag(ts, dt.date(2024, 1, 31)).alias("tomorrow"))


@query("dq11_volume_drop",
       "WITH d AS (SELECT count(*) FILTER (CAST(ts AS DATE) = DATE '2024-01-30') AS now, count(*) FILTER (CAST(ts AS DATE) = DATE '2024-01-23') AS before FROM events WHERE event_type = 'click') "
       "SELECT CASE WHEN before > 0 AND now / before < 1.05 THEN 1 ELSE 0 END AS n FROM d")
def _(spark, sf):
    return R.volume_drop(table(spark, sf, "events"), "event_type = 'click'", "ts", AS_OF, 7, 1.05)


@query("dq12_min_rows", "SELECT CASE WHEN count(*) < 100 THEN 1 ELSE 0 END AS n FROM region")
def _(spark, sf):
    return R.below_min_rows(table(spark, sf, "region"), 100)


_FILTERS = {"DONE": "o_orderstatus = 'F'", "SINCE": "o_orderdate >= date_sub(:as_of, 30)", "YEAR": "year(o_orderdate) = year(:as_of)",
            "MONTH": "trunc(o_orderdate, 'MM') = trunc(:as_of, 'MM')", "URGENT": "o_orderpriority IN ('1-URGENT', '2-HIGH')"}
_FILTERS_SQL = {"DONE": "o_orderstatus = 'F'", "SINCE": "o_orderdate >= DATE '2001-06-30' - 30", "YEAR": "year(o_orderdate) = 2001",
                "MONTH": "date_trunc('month', o_orderdate) = DATE '2001-06-01'", "URGENT": "o_orderpriority IN ('1-URGENT', '2-HIGH')", "NONE": "true"}


@query("dq13_row_filters", _summary_sql("orders", [(f"b_{n}", "PRICE", "o_totalprice", sql, "o_totalprice >= 50000") for n, sql in _FILTERS_SQL.items()]))
def _(spark, sf):
    spec = _spec({f"b_{n}": ("o_totalprice", n, ["PRICE"]) for n in _FILTERS_SQL}, {"PRICE": _rule("RANGE", "validity", min=50000)}, _FILTERS)
    return _run(spark, table(spark, sf, "orders"), spec, dt.date(2001, 6, 30)).select(_COUNTS)


def _full_spec():
    """All rule kinds over two tables."""
    uri = "bigquery://projects/w/datasets/retail/tables/"
    bind = lambda t, c, f, *rules: {"entity_uri": uri + t, "column_id": c, "row_filter_id": f, "rule_ids": list(rules)}
    return {
        "row_filters": {"DONE": {"filter_sql_expr": "o_orderstatus = 'F'"}},
        "rules": {
            "NOT_NULL": _rule("NOT_NULL", "completeness"), "NOT_BLANK": _rule("NOT_BLANK", "completeness"),
            "PRIORITY": _rule("REGEX", "conformance", pattern="^[1-3]-"), "PRICE": _rule("RANGE", "validity", min=10000, max=490000),
            "ORDERED": _rule("CUSTOM_SQL_EXPR", "consistency", custom_sql_expr="$column < :as_of"),
            "UNIQUE": _rule("UNIQUE", "uniqueness"), "OWNER": _rule("FOREIGN_KEY", "integrity", parent="w.retail.customer", parent_keys=["c_custkey"]),
            "FRESH": _rule("FRESHNESS", "timeliness"), "ROWS": _rule("MIN_ROW_COUNT", "completeness", least=100),
            "DROP": _rule("VOLUME_DROP", "completeness", ts="o_orderdate", condition="o_orderstatus = 'F'")},
        "rule_bindings": {
            "STATUS": bind("orders", "o_orderstatus", "NONE", "NOT_NULL", "NOT_BLANK"), "PRIORITY": bind("orders", "o_orderpriority", "DONE", "PRIORITY"),
            "PRICE": bind("orders", "o_totalprice", "DONE", "PRICE"), "DAY": bind("orders", "o_orderdate", "NONE", "ORDERED", "FRESH", "DROP"),
            "KEY": bind("orders", "o_orderkey", "NONE", "UNIQUE", "ROWS"), "OWNER": bind("orders", "o_custkey", "NONE", "OWNER"),
            "SEGMENT": bind("customer", "c_mktsegment", "NONE", "NOT_NULL"), "NATION": bind("customer", "c_nationkey", "NONE", "UNIQUE")},
        "metadata_registry_defaults": {"dataplex": {"lakes": "lake", "zones": "raw"}}}


_DAY = dt.date(2001, 7, 1)


def _full(spark, sf):
    tables = {"w.retail.orders": table(spark, sf, "orders"), "w.retail.customer": _keyed(spark, sf, "customer", "c_custkey", "c_acctbal > -500")}
    return Q.run_dq(spark, _full_spec(), tables, _DAY, "inv-1", "run-1", _NOW)


_ON = lambda d: f"CAST(o_orderdate AS DATE) = DATE '{d}'"
_FULL_SQL = (
    "WITH c AS (SELECT * REPLACE (CASE WHEN c_acctbal > -500 THEN c_custkey END AS c_custkey) FROM customer), r AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders), raw AS ("
    "SELECT 'STATUS' AS rule_binding_id, 'NOT_NULL' AS rule_id, 'orders' AS t, 'completeness' AS dimension, n AS rows_validated, 0 AS bad FROM r "
    "UNION ALL SELECT 'STATUS', 'NOT_BLANK', 'orders', 'completeness', n, 0 FROM r "
    "UNION ALL SELECT 'PRIORITY', 'PRIORITY', 'orders', 'conformance', f, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority >= '4') FROM r "
    "UNION ALL SELECT 'PRICE', 'PRICE', 'orders', 'validity', f, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND NOT o_totalprice BETWEEN 10000 AND 490000) FROM r "
    "UNION ALL SELECT 'DAY', 'ORDERED', 'orders', 'consistency', n, (SELECT count(*) FROM orders WHERE o_orderdate >= DATE '2001-07-01') FROM r "
    "UNION ALL SELECT 'DAY', 'FRESH', 'orders', 'timeliness', n, (SELECT CAST(max(o_orderdate) < DATE '2001-07-01' AS INT) FROM orders) FROM r "
    f"UNION ALL SELECT 'DAY', 'DROP', 'orders', 'completeness', n, (SELECT CASE WHEN b > 0 AND a / b < 0.8 THEN 1 ELSE 0 END FROM (SELECT count(*) FILTER ({_ON('2001-07-01')}) AS a, count(*) FILTER ({_ON('2001-06-24')}) AS b FROM orders WHERE o_orderstatus = 'F')) FROM r "
    "UNION ALL SELECT 'KEY', 'UNIQUE', 'orders', 'uniqueness', n, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) FROM r "
    "UNION ALL SELECT 'KEY', 'ROWS', 'orders', 'completeness', n, CASE WHEN n < 100 THEN 1 ELSE 0 END FROM r "
    "UNION ALL SELECT 'OWNER', 'OWNER', 'orders', 'integrity', n, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM c WHERE c_custkey IS NOT NULL)) FROM r "
    "UNION ALL SELECT 'SEGMENT', 'NOT_NULL', 'customer', 'completeness', (SELECT count(*) FROM c), 0 FROM r "
    "UNION ALL SELECT 'NATION', 'UNIQUE', 'customer', 'uniqueness', (SELECT count(*) FROM c), (SELECT count(*) FROM (SELECT c_nationkey FROM c GROUP BY 1 HAVING count(*) > 1)) FROM r), "
    "full_summary AS (SELECT rule_binding_id, rule_id, 'w.retail.' || t AS table_id, dimension, rows_validated, rows_validated - bad AS success_count, CAST(bad AS BIGINT) AS failed_count, "
    "round((rows_validated - bad) * 100.0 / rows_validated, 2)::DOUBLE AS success_percentage FROM raw) ")
_SHOWN = ["rule_binding_id", "rule_id", "table_id", "dimension", "rows_validated", "success_count", "failed_count", "success_percentage"]


@query("dq14_bindings", _FULL_SQL + "SELECT * FROM full_summary")
def _(spark, sf):
    return _full(spark, sf).select(_SHOWN)


@query("dq15_summary_counts", _summary_sql("(SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders)", [
    ("b", "NOT_NULL", "status", "o_totalprice > 100000", "status IS NOT NULL"), ("b", "IS_F", "status", "o_totalprice > 100000", "status = 'F'")]))
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_totalprice", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    spec = _spec({"b": ("status", "DEAR", ["NOT_NULL", "IS_F"])}, {"NOT_NULL": _rule("NOT_NULL", "completeness"), "IS_F": _rule("REGEX", "conformance", pattern="^F$")},
                 {"DEAR": "o_totalprice > 100000"})
    return _run(spark, orders, spec).select(_COUNTS)


@query("dq16_registry",
       "SELECT 'inv-1' AS invocation_id, '2024-01-30 12:00:00' AS execution_ts, 'b' AS rule_binding_id, 'PRICE' AS rule_id, 'w.retail_staging.orders' AS table_id, 'o_totalprice' AS column_id, "
       "'validity' AS dimension, count(*) AS rows_validated, count(*) FILTER (o_totalprice >= 50000) AS success_count, count(*) FILTER (o_totalprice < 50000) AS failed_count, 0::BIGINT AS null_count, "
       "'2024-01-30 12:00:00' AS last_modified, '{\"rule_type\":\"RANGE\",\"min\":50000,\"filter\":\"NONE\"}' AS metadata_json_string, 'lake' AS dataplex_lake, 'raw' AS dataplex_zone, "
       "'retail-staging-asset' AS dataplex_asset_id, 'run-1' AS dq_run_id FROM orders")
def _(spark, sf):
    name = "w.retail_staging.orders"
    spec = _spec({"b": ("o_totalprice", "NONE", ["PRICE"])}, {"PRICE": _rule("RANGE", "validity", min=50000)}, table_name=name)
    rows = _run(spark, table(spark, sf, "orders"), spec, name=name).drop("success_percentage", "failed_percentage", "null_percentage")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return rows.withColumns({"execution_ts": text("execution_ts"), "last_modified": text("last_modified")})


@query("dq17_statement_counts", _FULL_SQL + "SELECT rule_id, rows_validated, success_count, failed_count FROM full_summary WHERE rule_id = 'OWNER'")
def _(spark, sf):
    return _full(spark, sf).where("rule_id = 'OWNER'").select("rule_id", "rows_validated", "success_count", "failed_count")


@query("dq18_dimension_rollup", _FULL_SQL +
       "SELECT table_id, dimension, count(*) AS checks, round(avg(success_percentage), 2) AS avg_success_percentage, min(success_percentage) AS worst_success_percentage FROM full_summary GROUP BY ALL")
def _(spark, sf):
    return Q.rollup_dimensions(_full(spark, sf))


@query("dq19_threshold", _FULL_SQL + "SELECT rule_binding_id, rule_id, CASE WHEN success_percentage < 98.5 THEN 'FAIL' ELSE 'PASS' END AS status FROM full_summary")
def _(spark, sf):
    return Q.apply_threshold(_full(spark, sf), 98.5).select("rule_binding_id", "rule_id", "status")
