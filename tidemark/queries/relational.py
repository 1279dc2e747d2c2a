"""The query surface: projections, filters, joins, subqueries, ranks and step chains."""

import datetime as dt

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import relational as R
from ..operators.recursion import descend, fixpoint, unroll
from ..plans.steps import run_steps
from ..session import checkpoint
from ..sources.tables import read_partition
from .base import RUN_DATE, query, table


@query("rl01_select", "SELECT c_name, c_custkey FROM customer")
def _(spark, sf):
    return R.select(table(spark, sf, "customer"), ["c_name", "c_custkey"])


@query("rl02_rename", "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(spark, sf):
    return R.rename(table(spark, sf, "customer"), {"c_custkey": "customer_id", "c_name": "customer_name"})


@query("rl03_select_expr", "SELECT o_orderkey AS id, coalesce(nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '5-LOW'), 'none') AS label FROM orders")
def _(spark, sf):
    return R.select_expr(table(spark, sf, "orders"), [
        "o_orderkey AS id", "coalesce(nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '5-LOW'), 'none') AS label"])


@query("rl04_null_split",
       "SELECT CASE WHEN s IS NULL THEN 'null' ELSE 'given' END AS part, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys "
       "FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s FROM orders) GROUP BY 1")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("s"))
    given, absent = R.split_on_null(orders, "s")
    both = given.withColumn("part", F.lit("given")).unionByName(absent.withColumn("part", F.lit("null")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("rl05_left_join_condition",
       "SELECT o_orderkey, c_custkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def _(spark, sf):
    joined = R.join_left(table(spark, sf, "orders"), table(spark, sf, "customer"), "o_custkey = c_custkey AND c_acctbal > 0")
    return joined.select("o_orderkey", "c_custkey", "c_name")


# a third of the orders carry one key, some have none
_HOT_KEY = "CASE WHEN o_orderstatus = 'F' THEN 7 WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END"
_HOT_SQL = f"SELECT o_orderkey, {_HOT_KEY} AS custkey FROM orders"
_POOR_SQL = "SELECT c_custkey AS custkey, c_name FROM customer WHERE c_acctbal < 5000 OR c_custkey = 7"


def _hot_orders(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", f"{_HOT_KEY} AS custkey")


def _poor(spark, sf):
    return table(spark, sf, "customer").selectExpr("CASE WHEN c_acctbal < 5000 OR c_custkey = 7 THEN c_custkey END AS custkey", "c_name")


@query("rl05_left_join_hot_key", f"SELECT o_orderkey, o.custkey, c_name FROM ({_HOT_SQL}) o LEFT JOIN ({_POOR_SQL}) c ON o.custkey = c.custkey")
def _(spark, sf):
    return R.join_left(_hot_orders(spark, sf), _poor(spark, sf), on=["custkey"])


@query("rl06_join_chain",
       "SELECT r_name, count(*) AS n FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey "
       "LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA' GROUP BY r_name")
def _(spark, sf):
    chain = R.join_chain(table(spark, sf, "customer"), [
        (table(spark, sf, "nation"), "c_nationkey = n_nationkey"),
        (table(spark, sf, "region"), "n_regionkey = r_regionkey AND r_name <> 'ASIA'")])
    return chain.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"))


@query("rl07_inner_join",
       "SELECT o_orderpriority, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price "
       "FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderpriority")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("p"))
    # lines are summed per order first, so the join carries one row per order
    per_order = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("p"))
    joined = R.join_inner(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), per_order, on=["o_orderkey"])
    return joined.groupBy("o_orderpriority").agg(F.sum("n").alias("n"), F.sum("p").cast("double").alias("price"))


@query("rl07_inner_join_hot_key", f"SELECT o_orderkey, o.custkey, c_name FROM ({_HOT_SQL}) o JOIN ({_POOR_SQL}) c ON o.custkey = c.custkey")
def _(spark, sf):
    return R.join_inner(_hot_orders(spark, sf), _poor(spark, sf), on=["custkey"])


@query("rl08_semi_join", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(spark, sf):
    building = table(spark, sf, "customer").select(F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey")).alias("o_custkey"))
    return R.semi(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), building, ["o_custkey"])


@query("rl09_anti_join",
       f"SELECT o_orderkey, custkey FROM ({_HOT_SQL}) o WHERE NOT EXISTS (SELECT 1 FROM ({_POOR_SQL}) c WHERE c.custkey = o.custkey)")
def _(spark, sf):
    return R.anti(_hot_orders(spark, sf), _poor(spark, sf), ["custkey"])


@query("rl10_one_row_cross",
       "SELECT * FROM (SELECT count(*) AS n_orders, max(o_orderkey) AS max_order FROM orders), (SELECT count(*) AS n_customers FROM customer)")
def _(spark, sf):
    return R.combine_one_row(spark, [
        table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderkey").alias("max_order")),
        table(spark, sf, "customer").agg(F.count(F.lit(1)).alias("n_customers"))])


_CTE = ("WITH filled AS (SELECT count(*) AS done FROM {orders} WHERE o_orderstatus = 'F'), "
        "rest AS (SELECT count(*) AS left_over FROM {orders} WHERE o_orderstatus <> 'F') "
        "SELECT (SELECT done FROM filled) AS numerator_value, (SELECT done FROM filled) + (SELECT left_over FROM rest) AS denominator_value, "
        "round((SELECT done FROM filled) * 100.0 / ((SELECT done FROM filled) + (SELECT left_over FROM rest)), 2) AS metric_output")


@query("rl11_cte_ratio", _CTE.format(orders="orders").replace("round(", "CAST(round(").replace(", 2) AS metric", ", 2) AS DOUBLE) AS metric"))
def _(spark, sf):
    return spark.sql(_CTE, orders=table(spark, sf, "orders")).withColumn("metric_output", F.col("metric_output").cast("double"))


@query("rl12_scalar_counts",
       "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM events WHERE event_type = 'click') AS clicks")
def _(spark, sf):
    return R.scalar_counts(spark, {"orders": table(spark, sf, "orders"), "customers": table(spark, sf, "customer"),
                                   "clicks": table(spark, sf, "events").where("event_type = 'click'")})


_PREDICATE = ("(p_brand IN ('Brand#12', 'Brand#3') OR p_name LIKE '%bolt') AND p_size BETWEEN 5 AND 30 AND NOT nullif(p_type, 'PROMO') = 'LARGE'")


@query("rl13_predicates", f"SELECT p_partkey FROM part WHERE {_PREDICATE}")
def _(spark, sf):
    c = F.col
    keep = ((c("p_brand").isin("Brand#12", "Brand#3") | c("p_name").like("%bolt")) & c("p_size").between(5, 30)
            & ~(F.nullif("p_type", F.lit("PROMO")) == "LARGE"))
    return R.filter_rows(table(spark, sf, "part"), keep).select("p_partkey")


@query("rl14_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000")
def _(spark, sf):
    return R.top_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 1000)


_RECURSIVE = ("WITH RECURSIVE tree(id, depth) AS (SELECT p_partkey, 0 FROM part WHERE p_partkey = 0 UNION ALL "
              "SELECT p.p_partkey, t.depth + 1 FROM tree t JOIN part p ON CAST(floor((p.p_partkey - 1) / 8.0) AS BIGINT) = t.id WHERE p.p_partkey > 0) "
              "SELECT depth, count(*) AS n, max(id) AS last_id FROM tree GROUP BY depth")


@query("rl15_recursive_cte", _RECURSIVE)
def _(spark, sf):
    """The parts as a tree of eight branches per node; Spark's own recursion ends with an error at 1,000,000 rows."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    links = checkpoint(part.where("id > 0").select("id", F.expr("(id - 1) div 8").alias("parent")))
    tree = unroll(part.where("id = 0").withColumn("depth", F.lit(0)),
                  lambda new: links.join(new.select(F.col("id").alias("parent"), (F.col("depth") + 1).alias("depth")), "parent"))
    return tree.groupBy("depth").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last_id"))


@query("rl15_deep_chain",
       "WITH RECURSIVE links AS (SELECT p_partkey * 3 + j AS node, p_partkey * 3 + j - 1 AS parent FROM part, (VALUES (0), (1), (2)) AS t(j)), "
       "tree(node, depth) AS (SELECT node, 0 FROM links WHERE node = 0 UNION ALL SELECT l.node, t.depth + 1 FROM tree t JOIN links l ON l.parent = t.node) "
       "SELECT node, depth FROM tree")
def _(spark, sf):
    """A chain three times as long as the parts."""
    node = F.col("p_partkey") * 3 + F.col("j")
    links = table(spark, sf, "part").select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("j")).select(
        node.alias("node"), (node - 1).alias("parent"))
    return descend(links.where("node > 0"), links.where("node = 0").select(F.col("node").alias("root"))).select("node", "depth")


# a customer points at up to two others; several ways lead to many of them, some in circles
_WAYS = ("SELECT c_custkey AS a, (c_custkey * 3 + 1) % 1009 AS b FROM customer WHERE c_acctbal > 0 "
         "UNION ALL SELECT c_custkey, c_custkey + 37 FROM customer WHERE c_mktsegment <> 'BUILDING'")


@query("rl15_reachable_in_cycles",
       f"WITH RECURSIVE ways AS ({_WAYS}), "
       "found(id, depth) AS (SELECT c_custkey, 0 FROM customer WHERE c_custkey < 3 UNION SELECT w.b, f.depth + 1 FROM found f JOIN ways w ON w.a = f.id WHERE f.depth < 400) "
       "SELECT id, min(depth) AS depth FROM found GROUP BY id")
def _(spark, sf):
    """Everything that links lead to from three customers, with the least number of links; links run in circles."""
    ways = checkpoint(spark.sql(_WAYS.replace("customer", "{customer}"), customer=table(spark, sf, "customer")))
    seed = table(spark, sf, "customer").where("c_custkey < 3").select(F.col("c_custkey").alias("id"), F.lit(0).alias("depth"))
    return fixpoint(seed, lambda new: new.join(ways, F.col("id") == F.col("a")).select(F.col("b").alias("id"), (F.col("depth") + 1).alias("depth")), ["id"])


@query("rl16_rank_pivot",
       "WITH r AS (SELECT o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) "
       "SELECT o_orderpriority, count(*) FILTER (rn = 1) AS rank_1, count(*) FILTER (rn = 2) AS rank_2, count(*) FILTER (rn = 5) AS rank_5 "
       "FROM r WHERE rn <= 5 GROUP BY o_orderpriority")
def _(spark, sf):
    return R.pivot_rank(table(spark, sf, "orders"), ["o_orderpriority"], [F.desc("o_totalprice"), "o_orderkey"], [1, 2, 5], ["o_custkey"])


@query("rl17_except_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, sf):
    return R.drop_columns(table(spark, sf, "customer"), ["c_nationkey", "c_acctbal"])


@query("rl18_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def _(spark, sf):
    return R.distinct(table(spark, sf, "part"), ["p_brand", "p_type"])


@query("rl19_subselect",
       "SELECT n_events, count(*) AS users FROM (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id) GROUP BY n_events")
def _(spark, sf):
    per_user = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    return per_user.groupBy("n_events").agg(F.count(F.lit(1)).alias("users"))


_STEPS = [
    {"id": "tidy", "after": "link", "sourceTable": "linked", "transformation": "select", "targetTable": "labelled",
     "selectExpr": "order_id, COALESCE(c_name, 'nobody') AS owner, c_custkey"},
    {"id": "pick", "after": "", "sourceTable": "orders", "sourceTableColumn": "o_orderkey,o_custkey",
     "transformation": "select", "targetTable": "picked"},
    {"id": "name", "after": "pick", "sourceTable": "picked", "sourceTableColumn": "o_orderkey:order_id,o_custkey:owner_id",
     "transformation": "rename", "targetTable": "named"},
    {"id": "link", "after": "name", "sourceTable": "named", "transformation": "join", "joinType": "left",
     "condition": "owner_id = rich.c_custkey", "targetTable": "linked"},
    {"id": "found", "after": "tidy", "sourceTable": "labelled", "transformation": "filter",
     "condition": "c_custkey IS NOT NULL", "targetTable": "with_owner"},
    {"id": "lost", "after": "tidy", "sourceTable": "labelled", "transformation": "filter",
     "condition": "c_custkey IS NULL", "targetTable": "without_owner"},
]


@query("rl20_step_chain",
       "SELECT 'found' AS part, o_orderkey AS order_id, c_name AS owner FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal > 5000 "
       "UNION ALL SELECT 'lost', o_orderkey, 'nobody' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def _(spark, sf):
    results = run_steps(_STEPS, {"orders": table(spark, sf, "orders"), "rich": table(spark, sf, "customer").withColumn("c_custkey", F.when(F.col("c_acctbal") > 5000, F.col("c_custkey")))})
    found, lost = results["with_owner"], results["without_owner"]
    return found.select(F.lit("found").alias("part"), "order_id", "owner").unionByName(
        lost.select(F.lit("lost").alias("part"), "order_id", "owner"))


@query("rl21_current_snapshot", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate = DATE '1998-06-01'")
def _(spark, sf):
    steps = [{"id": "now", "after": "", "sourceTable": "lineitem", "sourceTableColumn": "l_orderkey,l_linenumber",
              "sourceTablePartitionField": "l_shipdate", "snapshotDuration": "Currently",
              "transformation": "select", "targetTable": "today"}]
    return run_steps(steps, {"lineitem": table(spark, sf, "lineitem")}, RUN_DATE)["today"]


@query("io03_partition_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate = DATE '1997-03-05'")
def _(spark, sf):
    day = read_partition(table(spark, sf, "lineitem"), dt.date(1997, 3, 5), "l_shipdate")
    return day.select("l_orderkey", "l_linenumber", "l_quantity")


@query("ag08_group_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12")
def _(spark, sf):
    return A.group_having(table(spark, sf, "orders"), ["o_custkey"], [F.count(F.lit(1)).alias("n")], "n > 12")
