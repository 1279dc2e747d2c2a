import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.errors import SourceError
from tidemark.operators import upsert as U

SCHEMA = "metric_id string, value int, partition_dt string"
FIRST = [("a", 1, "2024-01-01"), ("b", 1, "2024-01-01"), ("a", 1, "2024-01-02"), ("z", 9, "2024-01-03")]
SECOND = [("a", 2, "2024-01-01"), ("c", 2, "2024-01-01"), ("a", 2, "2024-01-04")]
AFTER = [("a", 2, "2024-01-01"), ("a", 1, "2024-01-02"), ("a", 2, "2024-01-04"), ("b", 1, "2024-01-01"), ("c", 2, "2024-01-01"), ("z", 9, "2024-01-03")]


@pytest.fixture(params=["folder", "table"])
def place(request, spark, tmp_path):
    if request.param == "folder":
        yield str(tmp_path / "out")
    else:
        yield "kept_metrics"
        spark.sql("DROP TABLE IF EXISTS kept_metrics")


def stored(spark, place, like):
    return sorted((r.metric_id, r.value, r.partition_dt) for r in U.read_partitioned(spark, place, "partition_dt", like).collect())


def test_overwrite_touches_only_its_partitions(spark, place, tmp_path):
    first, second = spark.createDataFrame(FIRST, SCHEMA), spark.createDataFrame(SECOND, SCHEMA)
    assert {r.change for r in U.overwrite_partitions(spark, place, first).collect()} == {"new"}
    files = lambda: {f.name for f in tmp_path.rglob("partition_dt=2024-01-03/*.parquet")}
    untouched = files()
    changes = {(r.metric_id, r.partition_dt): r.change for r in U.overwrite_partitions(spark, place, second).collect()}
    assert changes == {("a", "2024-01-01"): "overwritten", ("c", "2024-01-01"): "new", ("a", "2024-01-04"): "new"}
    assert stored(spark, place, first) == sorted(AFTER) and files() == untouched
    U.overwrite_partitions(spark, place, second)
    assert stored(spark, place, first) == sorted(AFTER)
    assert U.overwrite_partitions(spark, place, second.limit(0)) is None


def test_null_partition_is_refused_and_stored_ones_stay(spark, place):
    first = spark.createDataFrame(FIRST + [("n", 5, None), ("m", 6, None)], SCHEMA)
    if "/" in place:
        first.write.partitionBy("partition_dt").parquet(place)
    else:
        first.write.partitionBy("partition_dt").saveAsTable(place)
    with pytest.raises(SourceError, match="1 rows have no"):
        U.overwrite_partitions(spark, place, spark.createDataFrame([("n", 7, None), ("a", 7, "2024-01-01")], SCHEMA))
    U.overwrite_partitions(spark, place, spark.createDataFrame(SECOND, SCHEMA))
    assert sorted(stored_any(spark, place, first), key=str) == sorted(AFTER + [("n", 5, None), ("m", 6, None)], key=str)


def stored_any(spark, place, like):
    return [(r.metric_id, r.value, r.partition_dt) for r in U.read_partitioned(spark, place, "partition_dt", like).collect()]


def test_partitions_that_look_like_numbers_stay_texts(spark, place):
    first = spark.createDataFrame([("a", 1, "01"), ("b", 1, "01"), ("a", 1, "1")], SCHEMA)
    U.overwrite_partitions(spark, place, first)
    U.overwrite_partitions(spark, place, spark.createDataFrame([("a", 2, "01")], SCHEMA), day="01")
    assert stored(spark, place, first) == [("a", 1, "1"), ("a", 2, "01"), ("b", 1, "01")]


def test_stored_columns_stay(spark, place):
    full = spark.createDataFrame([("a", 1, "x", "d1"), ("b", 1, "y", "d1")], "metric_id string, value int, note string, partition_dt string")
    U.overwrite_partitions(spark, place, full)
    U.overwrite_partitions(spark, place, full.where("metric_id = 'a'").drop("note"))
    rows = U.read_partitioned(spark, place, "partition_dt", full).select("metric_id", "value", "note").collect()
    assert sorted(map(tuple, rows)) == [("a", 1, None), ("b", 1, "y")]
    with pytest.raises(SourceError, match="extra"):
        U.overwrite_partitions(spark, place, full.withColumn("extra", F.lit(1)))


def test_null_keys_replace_null_keys(spark):
    rows = spark.createDataFrame([(None, 1, "d"), ("a", 1, "d")], SCHEMA)
    after = U.overwrite_by_key(rows, spark.createDataFrame([(None, 2, "d")], SCHEMA))
    assert sorted(map(tuple, after.collect()), key=str) == sorted([(None, 2, "d"), ("a", 1, "d")], key=str)


def test_restore_brings_the_former_rows_back(spark, place, tmp_path):
    first, second = spark.createDataFrame(FIRST, SCHEMA), spark.createDataFrame(SECOND + [("n'1", 5, "it's")], SCHEMA)
    U.overwrite_partitions(spark, place, first)
    undo = str(tmp_path / "undo")
    assert not U.holds_undo(spark, undo) and not U.restore(spark, place, undo)
    U.overwrite_partitions(spark, place, second, undo=undo)
    later = spark.createDataFrame([("later", 7, "2024-01-01")], SCHEMA)
    U.overwrite_partitions(spark, place, later)
    for _ in range(2):
        assert U.restore(spark, place, undo) and U.holds_undo(spark, undo)
        assert stored(spark, place, first) == sorted(FIRST + [("later", 7, "2024-01-01")])
    days = [r[0] for r in spark.sql(f"SHOW PARTITIONS {place}").collect()] if "/" not in place else [p.name for p in (tmp_path / "out").glob("partition_dt=*")]
    assert sorted(days) == ["partition_dt=2024-01-01", "partition_dt=2024-01-02", "partition_dt=2024-01-03"]


def test_restore_of_a_table_the_run_made(spark, place, tmp_path):
    first, undo = spark.createDataFrame(FIRST, SCHEMA), str(tmp_path / "undo")
    U.overwrite_partitions(spark, place, first, undo=undo)
    assert U.restore(spark, place, undo) and U.read_partitioned(spark, place, "partition_dt", first) is None
    U.overwrite_partitions(spark, place, first)
    assert stored(spark, place, first) == sorted(FIRST)


def test_restore_after_an_overwrite_that_failed(spark, place, tmp_path, monkeypatch):
    first, undo = spark.createDataFrame(FIRST, SCHEMA), str(tmp_path / "undo")
    U.overwrite_partitions(spark, place, first)
    with monkeypatch.context() as patched:
        patched.setattr(U, "_replace", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            U.overwrite_partitions(spark, place, spark.createDataFrame(SECOND, SCHEMA), undo=undo)
    assert U.restore(spark, place, undo) and stored(spark, place, first) == sorted(FIRST)


def test_every_scan_is_limited_to_the_run(spark, tmp_path, capsys):
    place = str(tmp_path / "out")
    U.overwrite_partitions(spark, place, spark.createDataFrame(FIRST, SCHEMA))
    incoming = spark.createDataFrame([("a", 2, "2024-01-01")], SCHEMA)
    touched = U.read_partitioned(spark, place, "partition_dt", incoming).where(F.col("partition_dt").between("2024-01-01", "2024-01-01"))
    for df in (U.classify_keys(touched, incoming), U.overwrite_by_key(touched, incoming)):
        df.explain()
        scans = [line for line in capsys.readouterr().out.splitlines() if "FileScan" in line]
        assert scans and all("partition_dt" in line.split("PartitionFilters:")[1].split("PushedFilters")[0] and ">=" in line for line in scans)


def test_absent_table_holds_nothing(spark):
    incoming = spark.createDataFrame(SECOND, SCHEMA)
    assert U.existing_keys(None, incoming).isEmpty() and U.overwrite_by_key(None, incoming).count() == 3
    assert {r.change for r in U.classify_keys(None, incoming).collect()} == {"new"}


def test_rollback_removes_fresh_new_rows_only(spark):
    now = dt.datetime(2024, 1, 2, 12)
    rows = [("new", "d", dt.datetime(2024, 1, 2, 11, 30)), ("new", "d", dt.datetime(2024, 1, 2, 10)), ("old", "d", dt.datetime(2024, 1, 2, 11, 30)), ("new", "e", None)]
    df = spark.createDataFrame(rows, "metric_id string, partition_dt string, pipeline_execution_ts timestamp_ntz")
    new = spark.createDataFrame([("new", "d"), ("new", "e")], "metric_id string, partition_dt string")
    assert sorted((r.metric_id, r.partition_dt, str(r.pipeline_execution_ts)) for r in U.rollback(df, new, now).collect()) == [
        ("new", "d", "2024-01-02 10:00:00"), ("new", "e", "None"), ("old", "d", "2024-01-02 11:30:00")]
