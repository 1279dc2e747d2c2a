import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import relational as R
from tidemark.operators.aggregates import Measure, measure
from tidemark.operators.joins import equi_join, hot_keys

HOW = ["inner", "left", "left_semi", "left_anti"]


def sides(spark, seed):
    """Both sides with a key that holds a third of the rows, NULL keys, and exact copies."""
    draw = random.Random(seed)
    key = lambda: draw.choice([7, 7, 7, None, None] + [draw.randrange(40) for _ in range(5)])
    left = [(key(), draw.randrange(5)) for _ in range(400)]
    right = [(key(), draw.randrange(5)) for _ in range(60)]
    return (spark.createDataFrame(left, "k int, a int").repartition(5), spark.createDataFrame(right, "k int, b int"))


@pytest.mark.parametrize("split_right", [False, True])
@pytest.mark.parametrize("how", HOW)
def test_salted_join_equals_plain_join(spark, rows, how, split_right):
    left, right = sides(spark, 1)
    if how in ("left_semi", "left_anti"):
        split_right = False
    got = equi_join(left, right, ["k"], how, hot_share=0.05, salts=4, split_right=split_right)
    assert rows(got) == rows(left.join(right, "k", how).select(got.columns))


def test_salted_join_on_two_keys_and_other_shares(spark, rows):
    left, right = sides(spark, 2)
    left, right = left.withColumnRenamed("a", "k2"), right.withColumnRenamed("b", "k2").withColumn("v", right.k)
    for share in (0.01, 0.5, None):
        got = equi_join(left, right, ["k", "k2"], "left", hot_share=share, salts=3)
        assert rows(got) == rows(left.join(right, ["k", "k2"], "left").select(got.columns))


def test_join_edges(spark, rows):
    left, right = sides(spark, 5)
    mapped = left.selectExpr("k", "map('x', a) AS m", "array(named_struct('y', map(1, 2))) AS n")
    for share in (None, 0.05):
        assert equi_join(mapped, right, ["k"], "left", share).count() == left.join(right, "k", "left").count()
    with pytest.raises(ValueError, match="hot_share"):
        equi_join(left, right, ["k"], "left", 0.001)
    with pytest.raises(ValueError, match="rename"):
        equi_join(left, right.withColumnRenamed("b", "a"), ["k"])


def test_plain_joins_read_each_side_once(spark, capsys):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_custkey")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(F.col("l_orderkey").alias("o_orderkey"))
    for join in (R.semi, R.anti):
        join(orders, lines, ["o_orderkey"]).explain()
        assert capsys.readouterr().out.count("FileScan") == 2


def test_hot_keys_are_few(spark):
    left, _ = sides(spark, 3)
    keyed = left.where("k IS NOT NULL")
    counts = {r.k: r["count"] for r in keyed.groupBy("k").count().collect()}
    hot = {r.k for r in hot_keys(keyed, ["k"], 0.05).collect()}
    assert hot == {k for k, n in counts.items() if n > 0.05 * sum(counts.values())} and 7 in hot and len(hot) <= 20


def test_measures_equal_one_query_each(spark):
    left, _ = sides(spark, 4)
    wanted = [Measure("n"), Measure("f", where="a > 2"), Measure("s", "sum", "a", where="a > 9", default=0), Measure("s0", "sum", "a", where="a > 9"),
              Measure("d", "count_distinct", "k"), Measure("d2", "count_distinct", "k", where="a > 2"), Measure("e", "count_distinct_if", "a", condition="k = 7"),
              Measure("c", "count_if", condition="k = 7"), Measure("x", "max", "a"), Measure("si", "sum_if", "a", condition="k = 7")]
    row = measure(left, wanted).first()
    left.createOrReplaceTempView("t")
    one = lambda sql: spark.sql(f"SELECT {sql} FROM t").first()[0]
    assert row.asDict() == {
        "n": one("count(*)"), "f": one("count_if(a > 2)"), "s": 0, "s0": None, "d": one("count(DISTINCT k)"),
        "d2": one("count(DISTINCT CASE WHEN a > 2 THEN k END)"), "e": one("count(DISTINCT CASE WHEN k = 7 THEN a END)"),
        "c": one("count_if(k = 7)"), "x": one("max(a)"), "si": one("sum(CASE WHEN k = 7 THEN a END)")}


def test_measures_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k int, a int")
    row = measure(empty, [Measure("n"), Measure("d", "count_distinct", "k"), Measure("s", "sum", "a", default=0)]).first()
    assert (row.n, row.d, row.s) == (0, 0, 0)


def test_rank_pivot_without_partition(spark):
    df = spark.createDataFrame([("a", 3), ("b", 2), ("a", 1)], "k string, v int")
    assert {tuple(r) for r in R.pivot_rank(df, ["k"], ["v"], [1, 3]).collect()} == {("a", 1, 1), ("b", 0, 0)}


def test_rename_refuses_unknown_columns(spark):
    with pytest.raises(ValueError, match="nothing"):
        R.rename(spark.range(1), {"nothing": "x"})
