import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scd2 as S
from tidemark.operators import stored_history as H

DAYS = [dt.date(2024, 3, 1) + dt.timedelta(days=d) for d in (0, 1, 3, 4, 9)]


@pytest.fixture
def place(spark):
    name = f"versions_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def snapshots(spark):
    rng = random.Random(8)
    rows = [(k, rng.choice("ab"), day, rng.choice([None, "x", "y"]), rng.choice([1, 1, 2])) for day in DAYS for k in range(40) if rng.random() < 0.7]
    return spark.createDataFrame(rows + rows[:9], "id int, part string, partition_dt date, name string, n int")


def shown(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("mode", ["delta", "full"])
def test_days_loaded_one_by_one_equal_all_at_once(spark, place, mode):
    df, keys = snapshots(spark), ["id", "part"]
    for day in DAYS:
        H.load_day(spark, place, df, keys, day, mode=mode, buckets=4)
    got, want = H.read_history(spark, place, keys), S.build_history(df, keys, mode=mode)
    assert shown(got.select(want.columns)) == shown(want)
    before = spark.table(place).count()
    H.load_day(spark, place, df, keys, DAYS[-1], mode=mode, buckets=4)
    assert spark.table(place).count() == before < df.distinct().count() + 40 * len(DAYS)
    with pytest.raises(ValueError):
        H.load_day(spark, place, df, keys, DAYS[0], mode=mode, buckets=4)


def test_the_stored_side_is_not_shuffled(spark, place):
    df, keys = snapshots(spark), ["id", "part"]
    H.load_day(spark, place, df, keys, DAYS[0], buckets=4)
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = S.one_per_key(df.where(F.col("partition_dt") == F.lit(DAYS[1])).drop("partition_dt"), keys).select(*keys, F.struct("name", "n").alias("v"))
        alone, met = plan(new), plan(H.changed_keys(spark.table(place), new, keys, "full"))
        # the snapshot's own shuffle and the one that deals it to the buckets at most
        assert met.count("Exchange") <= alone.count("Exchange") + 1 and "Bucketed: true" in met
        assert "Exchange" not in plan(H.read_history(spark, place, keys))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_and_empty_snapshots(spark, place):
    df = spark.createDataFrame([(1, DAYS[0], "a"), (None, DAYS[1], "b")], "id int, partition_dt date, v string")
    H.load_day(spark, place, df, ["id"], DAYS[0], buckets=2)
    with pytest.raises(ValueError):
        H.load_day(spark, place, df, ["id"], DAYS[1], buckets=2)
    H.load_day(spark, place, df.limit(0), ["id"], DAYS[2], mode="full", buckets=2)
    assert [(r.id, r.v, r.effective_end_date, r.is_current) for r in H.read_history(spark, place, ["id"]).collect()] == [(1, "a", DAYS[2] - dt.timedelta(days=1), False)]
