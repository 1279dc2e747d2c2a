import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import DefinitionError, SourceError
from tidemark.operators import compare as C
from tidemark.operators import synth as S
from tidemark.sources import (audit_last, bad_cells, export_csv, load_csv_folder, load_csv_typed, read_mapping, resolve_table, schema_from_ddl, write_targets)
from tidemark.sources.partition_listing import partition_info


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_cells_decide_the_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id , price,flag,mixed,name,empty\n1, 2.50,TRUE,1,' O''Neil ,\n-2,3,false,x,\"a,\"\"b\"\"\",\n3\n", "utf-8-sig")
    df = load_csv_typed(spark, path)
    assert df.dtypes == [("id", "bigint"), ("price", "decimal(38,9)"), ("flag", "boolean"), ("mixed", "string"), ("name", "string"), ("empty", "string")]
    assert [tuple(r) for r in df.collect()] == [
        (1, Decimal("2.500000000"), True, "1", "' O''Neil", None), (-2, Decimal(3), False, "x", 'a,"b"', None), (3, None, None, None, None, None)]


def test_schema_decides_the_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", "day,tags,raw\n2024-01-05,\"[\"\"a\"\",\"\"b\"\"]\",YWI=\nbad,,\n")
    ddl = [{"name": "day", "type": "DATE"}, {"name": "tags", "type": "STRING", "mode": "REPEATED"}, {"name": "raw", "type": "BYTES"}]
    assert [tuple(r) for r in load_csv_typed(spark, path, ddl, strict=False).collect()] == [(dt.date(2024, 1, 5), ["a", "b"], bytearray(b"ab")), (None, None, None)]
    with pytest.raises(SourceError, match="more"):
        load_csv_typed(spark, path, [{"name": "more", "type": "STRING"}])


def test_no_cell_is_lost(spark, tmp_path):
    big, fine = "1" * 36, "1.12345678901"
    path = write(tmp_path / "a.csv", f"a,b,c\n{big},{fine},1\n2,3,4\n")
    df = load_csv_typed(spark, path)
    assert df.dtypes == [("a", "string"), ("b", "string"), ("c", "bigint")] and df.first().a == big and df.first().b == fine
    wide = write(tmp_path / "b.csv", 'a,b\n1,2\n3,"x,y",5,6\n7\n')
    with pytest.raises(SourceError, match="1 lines have more cells"):
        load_csv_typed(spark, wide)
    assert [tuple(r) for r in load_csv_typed(spark, wide, strict=False).collect()] == [(1, "2"), (3, "x,y"), (7, None)]
    assert [tuple(r) for r in bad_cells(spark, wide).collect()] == [("3", None, "5", "none")]
    ddl = [{"name": "a", "type": "INT64"}, {"name": "b", "type": "NUMERIC"}]
    typed = write(tmp_path / "c.csv", "a,b\n1,2.500\nx,0.12345678901\n,nothing\n")
    with pytest.raises(SourceError, match="2 lines"):
        load_csv_typed(spark, typed, ddl)
    assert {tuple(r)[1:3] for r in bad_cells(spark, typed, ddl).collect()} == {("a", "x"), ("b", "0.12345678901"), ("b", "nothing")}


def test_types_are_those_of_all_files(spark, tmp_path):
    write(tmp_path / "one.csv", "code,v\n10,1\n20,2\n")
    write(tmp_path / "two.csv", "code,w\nX9,1.5\n")
    place = "acme-<env>-01-<project_code>.acme_<env>.t"
    tables, _ = load_csv_folder(spark, str(tmp_path), {"one.csv": place, "two.csv": place}, "bld", {"acme": "77"})
    (df,) = tables.values()
    assert dict(df.dtypes)["code"] == "string" and sorted(r.code for r in df.collect()) == ["10", "20", "X9"]


def test_export_is_in_utc(spark, tmp_path):
    moment = dt.datetime(2024, 1, 5, 12, 0, 0, 250000, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(moment,), (moment.replace(microsecond=0),)], "ts timestamp")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        export_csv(df, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    lines = {line for f in (tmp_path / "out").glob("*.csv") for line in f.read_text().splitlines()}
    assert lines == {"ts", "2024-01-05 12:00:00.250000 UTC", "2024-01-05 12:00:00 UTC"}


def test_export_reads_back(spark, tmp_path):
    day = dt.date(2024, 1, 5)
    df = spark.createDataFrame([(1, day, True, None, ["a"], "x|y \"q\""), (2, None, False, "", None, " ")],
                               "id long, day date, flag boolean, note string, tags array<string>, text string")
    export_csv(df, str(tmp_path / "out"), sep="|")
    lines = {line for f in (tmp_path / "out").glob("*.csv") for line in f.read_text().splitlines()}
    assert "id|day|flag|note|tags|text" in lines and '1|2024-01-05|true||"[""a""]"|"x|y ""q"""' in lines
    assert any(line.startswith("2||false||") for line in lines)


MAPPING = """# comment
orders.csv = acme-<env>-01-<project_code>.acme_<env>.orders

broken line
more.csv = acme-<env>-01-<project_code>.acme_<env>.orders
"""


def test_folder_to_tables(spark, tmp_path):
    for name, text in (("orders.csv", "id,v\n1,a\n"), ("more.csv", "id\n2\n"), ("loose.csv", "id\n9\n")):
        write(tmp_path / name, text)
    mapping = read_mapping(MAPPING.splitlines())
    tables, report = load_csv_folder(spark, str(tmp_path), mapping, "BLD", {"acme": "77"})
    assert {k: sorted(tuple(r) for r in v.collect()) for k, v in tables.items()} == {"acme-bld-01-77.acme_bld.orders": [(1, "a"), (2, None)]}
    assert {(r.file_name, r.table_name is None) for r in report.collect()} == {("orders.csv", False), ("more.csv", False), ("loose.csv", True)}
    for args in (("acme.t", "prd", {"acme": "1"}), ("other.t", "bld", {"acme": "1"})):
        with pytest.raises(DefinitionError):
            resolve_table(*args)


def test_schemas():
    schema = schema_from_ddl([{"name": "a", "type": "int64", "mode": "REQUIRED"}, {"name": "b", "type": "BIGNUMERIC"}, {"name": "c", "type": "geography"},
                              {"name": "d", "type": "RECORD", "fields": [{"name": "x", "type": "FLOAT"}]}, {"name": "e", "type": "DATETIME"}])
    assert schema.simpleString() == "struct<a:bigint,b:decimal(38,18),c:string,d:struct<x:double>,e:timestamp_ntz>" and not schema["a"].nullable
    for bad in ([], {}, ["x"], [{"name": "a"}], [{"type": "STRING"}]):
        with pytest.raises(DefinitionError):
            schema_from_ddl(bad)


def test_targets_fail_alone(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "target_table string, v int")
    blocked = tmp_path / "file"
    blocked.write_text("x")
    written, failed = write_targets(df, {"a": str(blocked / "x"), "b": str(tmp_path / "b")})
    assert written == ["b"] and list(failed) == ["a"]
    assert [r.v for r in spark.read.parquet(str(tmp_path / "b")).collect()] == [2]


def test_targets_without_rows_cost_nothing(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, 3)], "target_table string, v int")
    calls = []
    written, failed = write_targets(df, {"a": "x", "b": "y"}, write=lambda rows, place, by: calls.append((place, rows.count())))
    assert written == ["a", "b"] and not failed and calls == [("x", 1)]
    assert write_targets(df, {}) == ([], {})


def test_partition_information_from_listings(spark, tmp_path, capsys):
    rows = spark.createDataFrame([(1, "2024-01-02"), (2, "2024-01-09"), (3, "2024-13-01"), (4, None), (5, "2024-01-02")], "v int, partition_dt string")
    folder, name = str(tmp_path / "days"), f"days_{uuid.uuid4().hex}"
    rows.write.partitionBy("partition_dt").parquet(folder)
    rows.withColumn("region", F.lit("a/b=c")).write.partitionBy("region", "partition_dt").format("parquet").saveAsTable(name)
    rows.write.saveAsTable(f"{name}_flat")
    try:
        df = spark.read.schema("v int, partition_dt string").parquet(folder)
        info = partition_info(spark, {"p.d.listed": name, "p.d.files": df, "q.plain": rows})
        assert sorted((r.project_dataset, r.table_name, str(r.partition_dt)) for r in info.collect()) == [
            (dataset, table, day) for dataset, table in (("p.d", "files"), ("p.d", "listed"), ("q", "plain")) for day in ("2024-01-02", "2024-01-09")]
        partition_info(spark, {"p.d.files": df}).explain()
        scans = [line for line in capsys.readouterr().out.splitlines() if "FileScan" in line]
        assert scans and all("ReadSchema: struct<>" in line for line in scans)
        with pytest.raises(SourceError, match="not partitioned"):
            partition_info(spark, {"p.d.flat": f"{name}_flat"})
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}_flat")
    assert partition_info(spark, {}).dtypes == [("project_dataset", "string"), ("table_name", "string"), ("partition_dt", "date")]


def test_audit_columns_move_last(spark):
    df = spark.createDataFrame([(1, 2, 3)], "batch_id int, id int, load_ts int")
    assert audit_last(df).columns == ["id", "batch_id", "load_ts"]


def test_compare_environments(spark):
    make = lambda rows: spark.createDataFrame(rows, "metric_id string, name string, sql string, seq int")
    envs = {"bld": make([("A", "x", "s", 1), ("A", "old", "s", 0), ("B", "x", None, 1), ("C", "x", "s", 1)]),
            "int": make([("A", "x", "s", 5), ("B", "y", "s", 1), ("C", "x", "s", 1)]), "prd": make([("A", "x", "t", 1), ("B", "x", None, 1)])}
    got = {(r.metric_id, r.status, r.missing_in, r.attribute, r.left_value, r.right_env, r.right_value)
           for r in C.compare_tables(envs, ["metric_id"], order=["seq"]).collect()}
    assert got == {("A", "DIFFERENT", "", "sql", "s", "prd", "t"), ("B", "DIFFERENT", "", "name", "x", "int", "y"),
                   ("B", "DIFFERENT", "", "sql", C.MISSING_KEY, "int", "s"), ("C", "MISSING", "prd", None, None, None, None)}
    pairs = C.compare_tables(envs, ["metric_id"], order=["seq"], all_pairs=True)
    assert {(r.left_env, r.right_env) for r in pairs.where("status = 'DIFFERENT'").collect()} == {("bld", "int"), ("bld", "prd"), ("int", "prd")}


DDL = [{"name": "org_id", "type": "STRING", "mode": "REQUIRED"}, {"name": "region", "type": "STRING"}, {"name": "headcount", "type": "INT64"},
       {"name": "opened_date", "type": "DATE"}, {"name": "loaded", "type": "TIMESTAMP"}, {"name": "tags", "type": "STRING", "mode": "REPEATED"}]


def test_synthetic_rows_repeat_under_any_partitioning(spark, rows):
    first = S.synth_table(spark, DDL, 50, seed=1, key="org_id")
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    try:
        again = S.synth_table(spark, DDL, 50, seed=1, key="org_id")
        assert rows(first) == rows(again) and rows(again) != rows(S.synth_table(spark, DDL, 50, seed=2, key="org_id"))
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert {r.org_id for r in first.collect()} == {f"PK{i}" for i in range(1, 51)} and first.schema["headcount"].dataType == T.LongType()


def test_children_chain_through_values(spark):
    orgs = S.synth_table(spark, DDL, 6, seed=1, key="org_id")
    worker = [{"name": "worker_id", "type": "INT64"}, {"name": "org", "type": "STRING"}]
    workers = S.synth_children({"org": (orgs, "org_id")}, worker, 40, seed=2, key="worker_id", spark=spark)
    detail = [{"name": "detail_id", "type": "INT64"}, {"name": "org", "type": "STRING"}, {"name": "worker", "type": "INT64"}]
    details = S.synth_children({"org": (workers, "org"), "worker": (workers, "worker_id")}, detail, 30, key="detail_id", spark=spark)
    assert details.count() == 30 and {r.org for r in details.collect()} <= {r.org for r in workers.collect()} <= {r.org_id for r in orgs.collect()}
    found = S.infer_fks({"orgs": orgs.withColumnRenamed("org_id", "org"), "workers": workers}, {"orgs": "org"})
    assert [tuple(r) for r in found.collect()] == [("workers", "org", "orgs", "org")]


def test_dense_index_has_no_gaps(spark):
    df = spark.range(0, 1000, 7).repartition(6).withColumnRenamed("id", "k")
    got = S.dense_index(df, "k").collect()
    assert sorted(r[S.ROW] for r in got) == list(range(143)) and [r.k for r in sorted(got, key=lambda r: r[S.ROW])] == list(range(0, 1000, 7))


def test_exact_quantiles_are_those_of_percentile(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 11 > 0, F.pmod(F.hash("id"), F.lit(700)) / 7).alias("v"))
    marks = [0.0, 0.1, 0.25, 0.5, 0.777, 0.99, 1.0]
    assert S.exact_quantiles(df, F.col("v"), marks) == pytest.approx(df.agg(F.percentile("v", marks)).first()[0])
    assert S.exact_quantiles(df.where("v < 0"), F.col("v"), marks) is None
    assert S.exact_quantiles(spark.range(2), F.col("id"), [0.5]) == [0.5]


def test_profiles_and_made_rows_are_dealt_over_tasks(spark):
    def widest(job, group):
        spark.sparkContext.setJobGroup(group, group)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            job()
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        return max(s.numTasks for s in stages if s)

    one = spark.range(0, 20000, 1, 1)
    assert widest(lambda: S.profile(one), "profile") > 1
    assert S.synth_like(spark, S.profile(one), 9_000_000, key="id").rdd.getNumPartitions() > 8
