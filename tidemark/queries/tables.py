"""Comparison of keyed tables and synthetic tables sized by the given ones."""

from pyspark.sql import functions as F

from ..operators import compare as C
from ..operators import synth as S
from ..operators.rules import orphans
from .base import query, table


def _envs(spark, sf):
    """Three environments that hold variants of the customers."""
    base = table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_nationkey").cast("string").alias("c_nationkey"), "c_mktsegment")
    second = base.where("c_mktsegment <> 'FURNITURE'").withColumn(
        "c_nationkey", F.when(F.col("c_mktsegment") == "BUILDING", "99").otherwise(F.col("c_nationkey")))
    third = base.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("MACHINERY"))).withColumn("owner", F.when(F.col("c_nationkey") == "3", "team"))
    return {"bld": base, "int": second, "pre": third}


_COMPARE = (
    "WITH a AS (SELECT c_custkey, c_mktsegment AS seg, CAST(c_nationkey AS VARCHAR) AS nat FROM customer), "
    "diff AS (SELECT c_custkey, 'c_nationkey' AS attribute, 'bld' AS left_env, nat AS left_value, 'int' AS right_env, '99' AS right_value FROM a WHERE seg = 'BUILDING' AND nat <> '99' "
    "UNION ALL SELECT c_custkey, 'c_mktsegment', 'bld', seg, 'pre', '<MISSING KEY>' FROM a WHERE seg = 'MACHINERY' "
    "UNION ALL SELECT c_custkey, 'owner', 'bld', '<MISSING KEY>', 'pre', 'team' FROM a WHERE nat = '3' AND seg <> 'FURNITURE') "
    "SELECT c_custkey, 'DIFFERENT' AS status, '' AS missing_in, attribute, left_env, left_value, right_env, right_value FROM diff "
    "UNION ALL SELECT c_custkey, 'MISSING', 'int', NULL, NULL, NULL, NULL, NULL FROM a WHERE seg = 'FURNITURE' "
    "UNION ALL SELECT c_custkey, 'EQUAL', '', NULL, NULL, NULL, NULL, NULL FROM a WHERE seg <> 'FURNITURE' AND c_custkey NOT IN (SELECT c_custkey FROM diff)")


@query("cp1_compare_tables", _COMPARE)
def _(spark, sf):
    return C.compare_tables(_envs(spark, sf), ["c_custkey"])


@query("cp2_missing_keys",
       "SELECT attribute, count(*) AS n FROM (SELECT 'c_mktsegment' AS attribute FROM customer WHERE c_mktsegment = 'MACHINERY' UNION ALL SELECT 'owner' FROM customer WHERE c_nationkey = 3 AND c_mktsegment <> 'FURNITURE') GROUP BY 1")
def _(spark, sf):
    rows = C.compare_tables(_envs(spark, sf), ["c_custkey"])
    marked = rows.where((F.col("left_value") == C.MISSING_KEY) | (F.col("right_value") == C.MISSING_KEY))
    return marked.groupBy("attribute").agg(F.count(F.lit(1)).alias("n"))


@query("cp3_last_duplicate",
       "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def _(spark, sf):
    return C.dedupe_last(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey"])


def _releases(spark, sf):
    """The orders in three environments that differ in a few rows."""
    base = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    second = base.where("o_orderkey % 701 <> 3").withColumn("o_orderstatus", F.when(F.expr("o_orderkey % 997 = 5"), "X").otherwise(F.col("o_orderstatus")))
    third = base.withColumn("o_orderpriority", F.when(F.expr("o_orderkey % 997 <> 5"), F.col("o_orderpriority")))
    return {"bld": base, "int": second, "pre": third}


_DIGESTS = (
    "WITH diff AS (SELECT o_orderkey, 'o_orderstatus' AS attribute, 'bld' AS left_env, o_orderstatus AS left_value, 'int' AS right_env, 'X' AS right_value FROM orders WHERE o_orderkey % 997 = 5 AND o_orderkey % 701 <> 3 "
    "UNION ALL SELECT o_orderkey, 'o_orderpriority', 'bld', o_orderpriority, 'pre', '<MISSING KEY>' FROM orders WHERE o_orderkey % 997 = 5 AND o_orderkey % 701 <> 3) "
    "SELECT o_orderkey, 'DIFFERENT' AS status, '' AS missing_in, attribute, left_env, left_value, right_env, right_value FROM diff "
    "UNION ALL SELECT o_orderkey, 'MISSING', 'int', NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 701 = 3 "
    "UNION ALL SELECT o_orderkey, 'EQUAL', '', NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 701 <> 3 AND o_orderkey % 997 <> 5")


@query("cp1_compare_by_digest", _DIGESTS)
def _(spark, sf):
    return C.compare_by_digest(_releases(spark, sf), ["o_orderkey"], unique_keys=True)


@query("sy2_children_of_parents", "SELECT (SELECT count(*) FROM orders) AS n, 0::BIGINT AS orphans, true AS spread")
def _(spark, sf):
    parents = table(spark, sf, "customer").select("c_custkey")
    n = table(spark, sf, "orders").count()
    ddl = [{"name": "order_id", "type": "INT64"}, {"name": "customer_key", "type": "INT64"}, {"name": "price", "type": "NUMERIC"}]
    children = S.synth_children({"customer_key": (parents, "c_custkey")}, ddl, n, seed=3, key="order_id", spark=spark)
    alone = orphans(children, parents, ["customer_key"], ["c_custkey"])
    per_parent = children.groupBy("customer_key").agg(F.count(F.lit(1)).alias("n"))
    return per_parent.agg(F.sum("n").alias("n"), (F.max("n") < 60).alias("spread")).select("n", alone.scalar().alias("orphans"), "spread")


@query("sy1_synth_table", "SELECT count(*) AS n, count(*) AS order_ids, count(*) AS defaults, true AS nulls_as_measured, true AS required_filled FROM orders")
def _(spark, sf):
    # as many rows as orders, with the share of finished ones as null rate
    n, share = table(spark, sf, "orders").agg(F.count(F.lit(1)), F.avg((F.col("o_orderstatus") == "F").cast("int"))).first()
    ddl = [{"name": "order_id", "type": "INT64", "mode": "REQUIRED"}, {"name": "price", "type": "NUMERIC", "mode": "REQUIRED"}, {"name": "note", "type": "STRING"},
           {"name": "state", "type": "STRING"}]
    made = S.synth_table(spark, ddl, n, seed=5, key="order_id", defaults={"state": "OPEN"}, null_rate=share)
    empty = F.avg(F.col("note").isNull().cast("int"))
    return made.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("order_id").alias("order_ids"), F.count_if(F.col("state") == "OPEN").alias("defaults"),
                    (F.abs(empty - share) < 5 * (share * (1 - share) / n) ** 0.5 + 0.0001).alias("nulls_as_measured"), (F.count("price") == F.count(F.lit(1))).alias("required_filled"))


# what the synthetic orders are held to: NULLs, bounds and tenths of a number, of dates, and shares of a text column
_LIKE_CUTS = [i / 10 for i in range(1, 10)]


def _like_checks(made, given, n):
    """Per column whether made rows follow the given ones, within five standard errors and the sketch's error."""
    near = 5 * (0.25 / n) ** 0.5 + 0.01
    days, price = F.unix_micros(F.col("o_orderdate").cast("timestamp")), F.col("o_totalprice")
    # the share of made values up to each tenth of the given ones
    cuts = given.agg(F.min(price).alias("low"), F.max(price).alias("high")).first()
    share = lambda flag: F.avg(flag.cast("int"))

    def follows(value, bounds):
        return F.array_max(F.array(*[F.abs(share(value <= b) / share(value.isNotNull()) - at) for at, b in zip(_LIKE_CUTS, bounds)])) < near

    wanted = dict(given.where("o_orderpriority IS NOT NULL").groupBy("o_orderpriority").count().collect())
    total = sum(wanted.values())
    parts = [F.abs(F.count_if(F.col("o_orderpriority") == name) / F.count("o_orderpriority") - count / total) < near for name, count in wanted.items()]
    gone = given.agg(share(F.col("o_orderpriority").isNull())).first()[0]
    return made.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("order_ids"), follows(price, S.exact_quantiles(given, price, _LIKE_CUTS)).alias("prices"), follows(days, S.exact_quantiles(given, days, _LIKE_CUTS)).alias("dates"),
                    ((F.min(price) >= cuts["low"]) & (F.max(price) <= cuts["high"])).alias("bounds"), F.forall(F.array(*parts), lambda ok: ok).alias("shares"),
                    (F.abs(share(F.col("o_orderpriority").isNull()) - gone) < near).alias("nulls"))


@query("sy1_orders_like_given", "SELECT count(*) AS n, count(*) AS order_ids, true AS prices, true AS dates, true AS bounds, true AS shares, true AS nulls FROM orders")
def _(spark, sf):
    # the priority is empty where it is the lowest one
    given = table(spark, sf, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    n = given.count()
    return _like_checks(S.synth_like(spark, S.profile(given), n, seed=8, key="o_orderkey"), given, n)


_LINKS = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
          ("supplier", "s_nationkey", "nation", "n_nationkey"), ("nation", "n_regionkey", "region", "r_regionkey")]


@query("sy3_infer_keys", " UNION ALL ".join(
    f"SELECT '{c}' AS child, '{cc}' AS child_column, '{p}' AS parent, '{pk}' AS parent_key WHERE NOT EXISTS (SELECT 1 FROM {c} WHERE {cc} IS NOT NULL AND {cc} NOT IN (SELECT {pk} FROM {p}))"
    for c, cc, p, pk in _LINKS))
def _(spark, sf):
    names = ["orders", "lineitem", "customer", "supplier", "nation"]
    tables = {n: table(spark, sf, n) for n in names + ["region"]}
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey", "region": "r_regionkey"}
    return S.infer_fks(tables, keys, lambda name: name.split("_", 1)[-1])
