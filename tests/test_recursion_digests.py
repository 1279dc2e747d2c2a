"""Recursion, comparison by digest, tables like a given one, and one write for many targets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import compare as C
from tidemark.operators import synth as S
from tidemark.operators.recursion import descend, fixpoint, unroll
from tidemark.queries import QUERIES
from tidemark.sources import write_targets_staged


def test_fixpoint_equals_breadth_first_search(spark, rows):
    ways = [(i, (i * 7 + 3) % 60) for i in range(60)] + [(i, i + 1) for i in range(0, 50, 3)] + [(5, None), (None, 4)]
    links = spark.createDataFrame(ways, "a int, b int")
    seed = spark.createDataFrame([(0, 0), (0, 0), (7, 0)], "id int, depth int")
    found = fixpoint(seed, lambda new: new.join(links, new.id.eqNullSafe(links.a)).select(F.col("b").alias("id"), (F.col("depth") + 1).alias("depth")), ["id"])
    best, level = {0: 0, 7: 0}, {0, 7}
    while level:
        level = {b for a, b in ways if a in level and b not in best}
        best |= {b: max(best.values()) + 1 for b in level}
    assert rows(found) == sorted(best.items(), key=lambda r: ((r[0] is None, str(r[0])),))
    with pytest.raises(ValueError, match="after 1 rounds"):
        fixpoint(seed, lambda new: new.join(links, new.id == links.a).select(F.col("b").alias("id"), "depth"), ["id"], max_rounds=1)


def test_fixpoint_of_nothing_and_of_keys_only(spark):
    empty = spark.createDataFrame([], "id int")
    assert fixpoint(empty, lambda new: new, ["id"]).count() == 0
    some = spark.createDataFrame([(1,), (1,)], "id int")
    found = fixpoint(some, lambda new: new.where("id < 5").select((F.col("id") + 1).alias("id")), ["id"])
    assert sorted(r.id for r in found.collect()) == [1, 2, 3, 4, 5]


def test_descend_chain_branches_cycles_and_inner_roots(spark, rows):
    edges = [(i, i - 1) for i in range(1, 700)] + [(1000, 699), (2001, 2002), (2002, 2001), (3001, 3000), (300, 299), (4001, None)]
    links = spark.createDataFrame(edges, "node int, parent int")
    found = descend(links, spark.createDataFrame([(0,), (300,), (5000,), (None,)], "root int"))
    wanted = [(i, 0, i) for i in range(300)] + [(i, 300, i - 300) for i in range(300, 700)] + [(1000, 300, 400), (5000, 5000, 0)]
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)


def test_unroll_keeps_repeated_rows_and_refuses_circles(spark, rows):
    links = spark.createDataFrame([(0, 1), (0, 2), (1, 3), (2, 3), (3, 4), (3, 4), (None, 9), (9, None)], "a int, b int")
    step = lambda new: new.join(links, new.id == links.a).select(F.col("b").alias("id"), (F.col("depth") + 1).alias("depth"))
    found = unroll(spark.createDataFrame([(0, 0), (None, 0)], "id int, depth int"), step)
    assert rows(found) == rows(spark.createDataFrame([(0, 0), (None, 0), (1, 1), (2, 1)] + [(3, 2)] * 2 + [(4, 3)] * 4, "id int, depth int"))
    assert unroll(spark.createDataFrame([], "id int, depth int"), step).count() == 0
    ring = spark.createDataFrame([(0, 1), (1, 0)], "a int, b int")
    with pytest.raises(ValueError, match="after 5 rounds"):
        unroll(spark.createDataFrame([(0,)], "id int"), lambda new: new.join(ring, new.id == ring.a).select(F.col("b").alias("id")), max_rounds=5)


def test_recursion_over_more_rows_than_sparks_own_limit(spark, tmp_path):
    spark.range(1_000_100).withColumnRenamed("id", "p_partkey").write.parquet(str(tmp_path / "part.parquet"))
    found = sorted(tuple(r) for r in QUERIES["rl15_recursive_cte"](spark, str(tmp_path)).collect())
    assert sum(r[1] for r in found) == 1_000_100 and found[:3] == [(0, 1, 0), (1, 8, 8), (2, 64, 72)] and found[-1][2] == 1_000_099


def _sides(spark):
    base = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("v"), F.when(F.col("id") % 3 == 0, "x").alias("w"))
    other = base.where("k <> 17").withColumn("v", F.when(F.col("k") == 99, "new").otherwise(F.col("v"))).withColumn("extra", F.when(F.col("k") == 5, "e"))
    return {"a": base, "b": other.unionByName(spark.createDataFrame([(None, "n", None, None)], "k bigint, v string, w string, extra string"))}


@pytest.mark.parametrize("unique", [False, True])
def test_digests_give_the_rows_of_the_full_comparison(spark, rows, unique):
    sides = _sides(spark)
    assert rows(C.compare_by_digest(sides, ["k"], buckets=512, unique_keys=unique)) == rows(C.compare_tables(sides, ["k"]))
    assert 1 <= C.unequal_buckets(sides, ["k"], 512).count() <= 4


def test_digests_with_repeated_keys_and_orders(spark, rows):
    sides = {env: df.withColumn("seq", F.lit(1)).unionByName(df.withColumn("seq", F.lit(2)).where("k < 100")) for env, df in _sides(spark).items()}
    sides["c"] = sides["a"].withColumn("seq", F.col("seq") + F.when(F.col("k") == 40, 5).otherwise(0))
    found = C.compare_by_digest(sides, ["k"], order=["seq"], buckets=256, all_pairs=True)
    assert rows(found) == rows(C.compare_tables(sides, ["k"], order=["seq"], all_pairs=True))


def test_digests_of_empty_tables_and_unlike_keys(spark):
    sides = {env: df.where("false") for env, df in _sides(spark).items()}
    assert C.compare_by_digest(sides, ["k"]).count() == 0
    with pytest.raises(ValueError, match="unlike types"):
        C.compare_by_digest({"a": spark.range(1), "b": spark.range(1).select(F.col("id").cast("string").alias("id"))}, ["id"])


def test_profile_and_tables_like_it(spark):
    given = spark.range(20000).select(
        "id", (F.pow(F.col("id") / 20000, 2) * 1000).alias("skewed"), F.when(F.col("id") % 4 > 0, F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 365).cast("int"))).alias("day"),
        F.when(F.col("id") % 10 < 7, "many").when(F.col("id") % 10 < 9, "some").otherwise("few").alias("word"), F.lit(None).cast("double").alias("none"), (F.col("id") % 5 == 0).alias("a`b"))
    profiles = S.profile(given)
    made = S.synth_like(spark, profiles, 20000, seed=1, key="id").cache()
    assert made.dtypes == given.dtypes
    told = made.agg(F.count_distinct("id"), F.percentile("skewed", F.lit(0.5)), F.avg(F.col("day").isNull().cast("int")), F.min("day"), F.max("day"),
                    F.avg((F.col("word") == "many").cast("int")), F.avg((F.col("word") == "few").cast("int")), F.count("none"), F.avg(F.col("`a``b`").cast("int"))).first()
    ids, median, gone, first, last, many, few, none, fifth = told
    assert ids == 20000 and abs(median - 250) < 20 and abs(gone - 0.25) < 0.02 and none == 0
    assert dt.date(2020, 1, 1) <= first and last <= dt.date(2020, 12, 30)
    assert abs(many - 0.7) < 0.02 and abs(few - 0.1) < 0.02 and abs(fifth - 0.2) < 0.02
    again = S.synth_like(spark, profiles, 20000, seed=1, key="id").repartition(3)
    assert made.exceptAll(again).count() == 0
    assert S.synth_like(spark, S.profile(given.where("false")), 3).count() == 3


def test_staged_targets_one_write_and_failures_apart(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("x")
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "a b").when(F.col("id") % 3 == 1, "2024-01-01 00:00").alias("part"),
                                 F.when(F.col("id") < 300, "t1").when(F.col("id") < 600, "t2").when(F.col("id") < 800, "bad").alias("target_table"))
    routes = {"t1": str(tmp_path / "one"), "bad": str(blocked / "x"), "t2": str(tmp_path / "two"), "none": str(tmp_path / "none"), "table": "staged_table"}
    for _ in range(2):
        written, failed = write_targets_staged(df, routes, ["part"], piece_rows=70)
        assert written == ["t1", "t2", "none", "table"] and list(failed) == ["bad"]
    for name, low in (("one", 0), ("two", 300)):
        found = spark.read.schema("id bigint, part string").parquet(str(tmp_path / name))
        assert sorted((r.id, r.part) for r in found.collect()) == sorted((r.id, r.part) for r in df.where(f"id >= {low} AND id < {low + 300}").collect() * 2)
    assert not (tmp_path / "none").exists()


def test_staged_targets_jobs_do_not_grow(spark, tmp_path):
    def jobs(n):
        group = f"staged-{n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            write_targets_staged(spark.range(2000).select("id", (F.col("id") % n).cast("string").alias("target_table")), {str(i): str(tmp_path / f"{n}" / str(i)) for i in range(n)})
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(60) == jobs(3) <= 4
