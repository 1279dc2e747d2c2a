"""Expectations on query results."""

from pyspark.sql import functions as F

from ..operators import expect as E
from .base import query, table


@query("ex1_numeric",
       "SELECT 'at_most' AS c, n::DOUBLE AS actual, CASE WHEN n <= 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT count(*) AS n FROM orders WHERE o_totalprice < 0) "
       "UNION ALL SELECT 'at_least', n::DOUBLE, CASE WHEN n >= 10 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT count(DISTINCT p_brand) AS n FROM part) "
       "UNION ALL SELECT 'equal', n::DOUBLE, CASE WHEN n = 4 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT count(DISTINCT event_type) AS n FROM events)")
def _(spark, sf):
    n = F.count(F.lit(1)).alias("n")
    checks = [("at_most", table(spark, sf, "orders").where("o_totalprice < 0").agg(n), "0"),
              ("at_least", table(spark, sf, "part").select("p_brand").distinct().agg(n), ">=10"),
              ("equal", table(spark, sf, "events").select("event_type").distinct().agg(n), "= 4")]
    parts = [E.expect_number(df, c).select(F.lit(name).alias("c"), "actual", "status") for name, df, c in checks]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("ex1_empty",
       "SELECT 'none' AS c, n::DOUBLE AS actual, 'FAIL' AS status FROM (SELECT max(n) AS n FROM (SELECT 1 AS n FROM orders WHERE o_totalprice < 0)) UNION ALL "
       "SELECT 'each', NULL, CASE WHEN min(n) >= 1 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    none = E.expect_number(orders.where("o_totalprice < 0").select(F.lit(1)), "5")
    each = E.expect_number(orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).select("n"), ">=1")
    return none.select(F.lit("none").alias("c"), "actual", "status").unionByName(each.select(F.lit("each").alias("c"), F.lit(None).cast("double").alias("actual"), "status"))


_TYPES = ["ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD"]


@query("ex2_set_match", "SELECT count(*) AS offending, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT DISTINCT p_type FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL', 'MEDIUM', 'PROMO', 'STANDARD'))")
def _(spark, sf):
    return E.expect_in_set(table(spark, sf, "part").select("p_type"), _TYPES)


@query("ex2_unexpected_values", "SELECT DISTINCT nullif(p_type, 'PROMO') AS value FROM part WHERE p_type IN ('LARGE', 'PROMO')")
def _(spark, sf):
    return E.unexpected_values(table(spark, sf, "part").select(F.nullif("p_type", F.lit("PROMO"))), _TYPES)


@query("ex3_not_in_result", "SELECT count(*) AS offending, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT DISTINCT event_type FROM events WHERE event_type IN ('error', 'INVALID'))")
def _(spark, sf):
    return E.expect_not_in(table(spark, sf, "events").select("event_type"), ["error", "INVALID"])


@query("ex4_row_match",
       "SELECT CAST(coalesce(sum(greatest(e - a, 0)), 0) AS BIGINT) AS missing, CAST(coalesce(sum(greatest(a - e, 0)), 0) AS BIGINT) AS extra, "
       "CASE WHEN coalesce(sum(abs(a - e)), 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT o_custkey, o_orderstatus, count(*) FILTER (side = 'a') AS a, count(*) FILTER (side = 'e') AS e FROM "
       "(SELECT 'a' AS side, o_custkey, o_orderstatus FROM orders UNION ALL SELECT 'e', o_custkey, CASE WHEN o_totalprice > 490000 THEN 'X' ELSE o_orderstatus END FROM orders) GROUP BY o_custkey, o_orderstatus)")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    expected = orders.select("o_custkey", F.when(F.col("o_totalprice") > 490000, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return E.expect_rows(orders.select("o_custkey", "o_orderstatus"), expected)


@query("ex4_row_match_list", "SELECT 0::BIGINT AS missing, 0::BIGINT AS extra, 'PASS' AS status FROM (SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1) HAVING count(*) = 5 AND min(n) = 5 AND max(n) = 5")
def _(spark, sf):
    per_region = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))
    return E.expect_rows(per_region, [{"n_regionkey": r, "n": 5} for r in range(5)])


@query("ex5_impacted_downstream",
       "SELECT 'errors' AS check_id, unnest(['reports', 'alerts']) AS impacted FROM (SELECT count(*) AS n FROM events WHERE event_type = 'error') WHERE n > 0 "
       "UNION ALL SELECT 'types', 'catalogue' FROM (SELECT count(*) AS n FROM part WHERE p_type = 'LARGE') WHERE n > 0")
def _(spark, sf):
    results = E.run_expectations(spark, [
        {"check_id": "errors", "sql": table(spark, sf, "events").select("event_type"), "comparison_type": "not_in_result",
         "expected_output": '["error"]', "impacted_downstream": ["reports", "alerts"]},
        {"check_id": "types", "sql": table(spark, sf, "part").select("p_type"), "comparison_type": "set_match",
         "expected_output": _TYPES, "impacted_downstream": ["catalogue"]},
        {"check_id": "sound", "sql": table(spark, sf, "orders").where("o_orderkey IS NULL").agg(F.count(F.lit(1)).alias("n")),
         "comparison_type": "numeric_condition", "expected_output": "0", "impacted_downstream": ["billing"]}])
    return E.explode_impacted(results)
