import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.errors import DefinitionError, MetricError, SourceError
from tidemark.operators.align import align
from tidemark.operators.partitions import latest_partition
from tidemark.plans import metrics as M
from tidemark.plans.columns import ColumnMap
from tidemark.plans.run import run_definitions
from tidemark.schemas import RECON_COLUMNS, RESULT_SCHEMA

DAY = dt.date(2024, 1, 15)
NOW = dt.datetime(2024, 1, 16, 5)


def staff(spark):
    return spark.createDataFrame([("a", "F", DAY), ("b", "M", DAY), ("c", "F", DAY), ("d", "F", dt.date(2024, 1, 10))],
                                 "id string, gender string, partition_dt date")


def run(spark, sqls, tables=None, **more):
    rows = [(k, f"N {k}", "Count", sql, "daily", "p.d.out") for k, sql in sqls.items()]
    defs = spark.createDataFrame(rows, "metric_id string, metric_name string, metric_type string, sql string, dependency string, target_table string")
    info = spark.createDataFrame([("d", "staff", dt.date(2024, 1, 10))], "project_dataset string, table_name string, partition_dt date")
    good, failed = M.run_metrics(spark, defs, DAY, latest_partition(info), tables or {"p.d.staff": staff(spark)}, executed_at=NOW, **more)
    return {r.metric_id: r for r in good.collect()}, {r.metric_id: r.error_message for r in failed.collect()}


def test_counts_and_dates(spark):
    good, failed = run(spark, {
        "now": "SELECT count(*) AS metric_output, {currently} AS business_data_date FROM `p.d.staff` WHERE partition_dt = {currently}",
        "last": "SELECT count(*) AS metric_output, '{currently}' AS business_data_date FROM `p.d.staff` WHERE partition_dt = '{partition_info}'",
        "share": "SELECT count_if(gender = 'F') AS numerator_value, count(*) AS denominator_value, round(count_if(gender = 'F') * 100.0 / count(*), 2) "
                 "AS metric_output, max(partition_dt) AS business_data_date FROM `p.d.staff` WHERE partition_dt = {currently}"})
    assert failed == {}
    assert good["now"].metric_output == 3 and good["last"].metric_output == 1
    assert good["share"].metric_output == Decimal("66.670000000") and good["share"].denominator_value == 3
    assert {r.business_data_date for r in good.values()} == {"2024-01-15"} and good["now"].partition_dt == "2024-01-15"
    assert [f for f in good["now"].asDict() if f != "target_table"] == RESULT_SCHEMA.fieldNames()


VALUES = "SELECT {} AS numerator_value, {} AS denominator_value, {} AS metric_output, {{currently}} AS business_data_date"


def case(n, d, m="1"):
    return VALUES.format(n, d, m)


def test_failures_stay_with_their_metric(spark):
    good, failed = run(spark, {
        "ok": case(1, 2), "zero": case(100, 0), "negative": case(100, -50), "syntax": "SELCT 1", "column": "SELECT nothing AS metric_output FROM `p.d.staff`",
        "function": "SELECT invalid_function(1) AS metric_output, {currently} AS business_data_date", "no_date": "SELECT 1 AS metric_output",
        "null_date": "SELECT 1 AS metric_output, CAST(NULL AS DATE) AS business_data_date", "bad_date": "SELECT 1 AS metric_output, '2024-13-01' AS business_data_date",
        "word_date": "SELECT 1 AS metric_output, 'soon' AS business_data_date", "number_date": "SELECT 1 AS metric_output, 20240101 AS business_data_date",
        "nothing": "SELECT id AS metric_output, {currently} AS business_data_date FROM `p.d.staff` WHERE id = 'zz'",
        "table": "SELECT 1 AS metric_output, {currently} AS business_data_date FROM `p.d.none`"})
    assert set(good) == {"ok"}
    assert "denominator_value is 0" in failed["zero"] and "negative" in failed["negative"]
    assert "PARSE_SYNTAX_ERROR" in failed["syntax"] and "UNRESOLVED_COLUMN" in failed["column"] and "UNRESOLVED_ROUTINE" in failed["function"]
    assert "TABLE_OR_VIEW_NOT_FOUND" in failed["table"]
    for name in ("no_date", "null_date", "nothing"):
        assert "required but was not returned" in failed[name]
    assert "'2024-13-01'" in failed["bad_date"] and "'soon'" in failed["word_date"] and "20240101" in failed["number_date"]


def test_run_time_failure_is_isolated(spark):
    good, failed = run(spark, {"ok": case(1, 2), "boom": "SELECT count(cast(gender AS int)) AS metric_output, {currently} AS business_data_date FROM `p.d.staff`"})
    assert set(good) == {"ok"} and "CAST_INVALID_INPUT" in failed["boom"]


def test_number_edges(spark):
    good, failed = run(spark, {
        "null": case("NULL", "NULL", "NULL"), "text": case("'not_a_number'", "'no'", "'x'"), "inf": case("1.0", "1.0", "double('Infinity')"),
        "nan": case("double('NaN')", "double('NaN')", "double('NaN')"), "large": case("1", "1", "12345678901234567890123456789.123456789"),
        "too_large": case("1", "1", "999999999999999999999999999999999999.99"), "tiny": case("1", "0.0000000001"), "limit": case("1", "0.0000001"), "number_text": case("'12.5'", "'4'")})
    assert failed == {}
    assert good["null"].metric_output is None and good["text"].denominator_value is None and good["inf"].metric_output is None and good["nan"].metric_output is None
    assert good["large"].metric_output == Decimal("12345678901234567890123456789.123456789") and good["too_large"].metric_output is None
    assert good["number_text"].numerator_value == Decimal("12.5")


def test_strict_mode_fails_lost_numbers(spark):
    good, failed = run(spark, {"text": case("'x'", 1), "ok": case(1, 1), "tiny": case(1, "0.0000000001")}, strict=True)
    assert set(good) == {"ok", "tiny"} and "numerator_value: not a DECIMAL" in failed["text"]


def test_tiny_denominator_warns_strictly_below(spark):
    warning = lambda d: M.run_metric(spark, {"sql": case(1, d)}, [DAY]).first().warning
    assert warning("0.0000000001") == "denominator_value: very small" and warning("0.0000001") is None


def test_first_row_only(spark):
    good, _ = run(spark, {"many": "SELECT id AS metric_name, 1 AS metric_output, {currently} AS business_data_date FROM `p.d.staff` ORDER BY id DESC"})
    assert good["many"].metric_name == "d"


def test_sql_values_win_over_the_definition(spark):
    good, _ = run(spark, {"a": "SELECT 'Z' AS metric_id, 'named' AS metric_name, 1 AS metric_output, {currently} AS business_data_date"})
    assert good["Z"].metric_name == "named" and good["Z"].metric_type == "Count"


def test_fail_fast(spark):
    with pytest.raises(MetricError, match="zero"):
        run(spark, {"zero": case(1, 0), "ok": case(1, 1)}, fail_fast=True)


def test_time_limit_cancels(spark):
    slow = "SELECT sum(hash(id)) AS metric_output, {currently} AS business_data_date FROM range(500000000000)"
    good, failed = run(spark, {"slow": slow}, timeout=2)
    assert good == {} and "cancel" in failed["slow"].lower()


def test_each_query_has_its_own_limit(spark):
    slow = "SELECT sum(hash(id)) AS metric_output, {currently} AS business_data_date FROM range(500000000000)"
    good, failed = run(spark, {"a": case(1, 1), "slow": slow, "b": case(2, 2), "boom": "SELECT raise_error('boom') AS metric_output, {currently} AS business_data_date",
                               "c": case(3, 3)}, timeout=8)
    assert set(good) == {"a", "b", "c"} and "cancel" in failed["slow"].lower() and "boom" in failed["boom"]


def test_repeated_ids_are_refused(spark):
    rows = [("a", "N", "Count", f"SELECT {n} AS metric_output, {{currently}} AS business_data_date", "daily", "p.d.out") for n in (1, 2)]
    defs = spark.createDataFrame(rows, "metric_id string, metric_name string, metric_type string, sql string, dependency string, target_table string")
    info = spark.createDataFrame([("d", "staff", DAY)], "project_dataset string, table_name string, partition_dt date")
    with pytest.raises(DefinitionError, match="repeated"):
        M.run_metrics(spark, defs, DAY, latest_partition(info), {})


def test_a_second_row_is_noticed(spark):
    query = lambda sql: M.checked_values(M.raw_values(spark.sql(sql))).collect()
    many = query("SELECT id AS metric_output, DATE'2024-01-01' AS business_data_date FROM range(5) ORDER BY id")
    assert [(r.metric_output, r.warning) for r in many] == [(0, M.SECOND_ROW)]
    assert query("SELECT count(*) AS metric_output, DATE'2024-01-01' AS business_data_date FROM range(5)")[0].warning is None
    assert query("SELECT id AS metric_output, DATE'2024-01-01' AS business_data_date FROM range(1)")[0].warning is None
    assert query("SELECT id AS metric_output, DATE'2024-01-01' AS business_data_date FROM range(0)") == []


def test_placeholders_in_texts(spark):
    assert M.parametrize("a = '{currently}' AND b = \"{partition_info}\" AND c = {run_date} AND d = 'it''s' AND `x y` = \"q\"") == \
        "a = :d0 AND b = :d1 AND c = :d2 AND d = 'it''s' AND `x y` = \"q\""
    for bad in ("'day {currently}'", "\"{currently}x\"", "`{currently}`"):
        with pytest.raises(MetricError, match="longer text"):
            M.parametrize(f"SELECT {bad}")
    good, failed = run(spark, {"double": "SELECT count(*) AS metric_output, \"{currently}\" AS business_data_date FROM `p.d.staff` WHERE partition_dt = \"{currently}\"",
                               "long": "SELECT 'on {currently}' AS metric_output, {currently} AS business_data_date"})
    assert good["double"].metric_output == 3 and "longer text" in failed["long"]


def test_views_of_the_caller_stay(spark):
    spark.range(3).createOrReplaceTempView("`p.d.mine`")
    with M.table_views(spark, {"p.d.mine": spark.range(7)}):
        assert spark.sql("SELECT * FROM `p.d.mine`").count() == 7
    assert spark.sql("SELECT * FROM `p.d.mine`").count() == 3
    spark.catalog.dropTempView("p.d.mine")


def test_metrics_of_one_slice_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "staff")
    staff(spark).write.parquet(path)
    table = spark.read.parquet(path)
    sql = "SELECT {} AS metric_output, {{currently}} AS business_data_date FROM `p.d.staff` WHERE partition_dt = {{currently}}"
    with M.table_views(spark, {"p.d.staff": table}):
        queries = {k: M.raw_values(M.bound_query(spark, sql.format(e), [DAY, DAY])) for k, e in
                   {"n": "count(*)", "f": "count_if(gender = 'F')", "top": "count(id)"}.items()}
    plan = M.evaluate(spark, queries)._jdf.queryExecution().optimizedPlan().toString()
    scans = {line.split("Relation")[1] for line in plan.splitlines() if "Relation [" in line}
    assert len(scans) == 1
    assert {r.key: int(r.metric_output) for r in M.evaluate(spark, queries).collect()} == {"n": 3, "f": 2, "top": 3}


def test_column_map(spark):
    columns = ColumnMap().update({"metric_output": "total"}).add("region", "area").add("weight", "kg", "numeric")
    assert columns.column("metric_output") == "total" and columns.internal("area") == "region" and columns.internal("x") == "x"
    assert [f.dataType.simpleString() for f in columns.schema()] == ["decimal(38,9)"] * 3 + ["string", "string", "decimal(38,9)"]
    good, failed = run(spark, {"a": "SELECT 5 AS total, 'EU' AS area, 2.5 AS kg, {currently} AS business_data_date"}, columns=columns)
    assert failed == {} and good["a"].metric_output == 5 and good["a"].region == "EU" and good["a"].weight == Decimal("2.5")
    _, failed = run(spark, {"a": "SELECT 5 AS total"}, columns=columns)
    assert "business_data_date is required" in failed["a"]


def test_align_drops_reorders_and_casts(spark):
    df = spark.createDataFrame([("1.5", "2024-01-15", "x", 7)], "n string, d string, extra string, k int")
    from pyspark.sql import types as T
    target = T.StructType([T.StructField("d", T.DateType()), T.StructField("n", T.DecimalType(38, 9)), T.StructField("k", T.LongType()), T.StructField("z", T.StringType())])
    assert align(df, target).dtypes == [("d", "date"), ("n", "decimal(38,9)"), ("k", "int")]
    assert align(df, target, missing="null").columns == ["d", "n", "k", "z"]


def definitions(tmp_path, *more):
    base = {"metric_type": "Count", "dependency": "daily", "target_table": "p.d.out", "frequency": "Daily"}
    sql = "SELECT count(*) AS metric_output, {currently} AS business_data_date FROM `p.d.staff` WHERE partition_dt = {partition_info}"
    defs = [{**base, "metric_id": "A", "metric_name": "First", "sql": sql}, {**base, "metric_id": "B", "metric_name": "Second", "sql": "SELECT 1 AS metric_output"},
            {**base, "metric_id": "C", "metric_name": "Third", "sql": sql, "target_table": "p.d.nowhere"},
            {**base, "metric_id": "E", "metric_name": "Fifth", "sql": sql.replace("p.d.staff", "p.d.unlisted")},
            {**base, "metric_id": "D", "metric_name": "Other", "sql": sql, "dependency": "weekly"}, *more]
    path = tmp_path / "defs.json"
    path.write_text(json.dumps(defs))
    return str(path)


def test_whole_run(spark, tmp_path):
    info = spark.createDataFrame([("p.d", "staff", "2024-01-10")], "project_dataset string, table_name string, partition_dt string")
    args = dict(partition_info=info, run_date="2024-01-15", dependencies="daily", tables={"p.d.staff": staff(spark)},
                targets={"p.d.out": str(tmp_path / "out")}, recon_target=str(tmp_path / "recon"), env="bld", executed_at=NOW)
    path = definitions(tmp_path)
    first = run_definitions(spark, path, **args)
    assert [(r.metric_id, r.change) for r in first.changes.collect()] == [("A", "new")]
    second = run_definitions(spark, path, **args)
    assert [(r.metric_id, r.change) for r in second.changes.collect()] == [("A", "overwritten")]
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.metric_id, r.metric_output, str(r.partition_dt)) for r in out] == [("A", 1, "2024-01-15")]
    recon = spark.read.parquet(str(tmp_path / "recon"))
    assert set(recon.columns) == set(RECON_COLUMNS) and recon.count() == 8
    assert [p.name for p in (tmp_path / "recon").glob("schdld_dt=*")] == ["schdld_dt=2024-01-15"]
    status = {r.source_system_id: (r.rcncln_exact_pass_in, r.excldd_reason_tx) for r in second.recon.collect()}
    assert status["A"] == ("Passed", "Metric data was successfully written.")
    assert status["B"][1].startswith("Metric data was failed written. [SQL_EXECUTION_ERROR] SQL query execution failed: business_data_date is required")
    assert status["C"][1].endswith("no place is given for target table p.d.nowhere") and "[BIGQUERY_WRITE_ERROR]" in status["C"][1]
    assert status["E"] == ("Failed", "Failed to create recon record: [RECON_CREATION_ERROR] Recon record creation failed: Recon record creation failed: "
                                     "no partition date for p.d.unlisted")
    fallback = second.recon.where("source_system_id = 'E'").first()
    assert (fallback.source_vl, fallback.source_table_nm, fallback.target_table_nm, fallback.source_column_nm) == ("1", "UNKNOWN", "UNKNOWN", "NA")
    stats = {r.target_table: r.asDict() for r in second.stats.collect()}
    assert stats["p.d.out"] == {"target_table": "p.d.out", "processed": 3, "written": 1, "failed": 2, "overwritten": 1, "new": 0}


def test_run_refuses_bad_input(spark, tmp_path):
    info = spark.createDataFrame([("p.d", "staff", "2024-01-10")], "project_dataset string, table_name string, partition_dt string")
    args = dict(partition_info=info, tables={}, targets={}, recon_target=str(tmp_path / "recon"), env="bld")
    path = definitions(tmp_path)
    for run_date, dependencies in (("2024-15-01", "daily"), ("2024-01-15", "missing"), ("2024-01-15", " , ")):
        with pytest.raises(DefinitionError):
            run_definitions(spark, path, run_date=run_date, dependencies=dependencies, **args)
    with pytest.raises(DefinitionError, match="Record 5"):
        run_definitions(spark, definitions(tmp_path, {"metric_id": "A"}), run_date="2024-01-15", dependencies="daily", **args)


def test_failed_validation_leaves_failure_rows(spark, tmp_path, monkeypatch):
    from tidemark.plans import run as module
    info = spark.createDataFrame([("p.d", "staff", "2024-01-10")], "project_dataset string, table_name string, partition_dt string")
    for name, more, wanted, ids in (("blank", [{"metric_id": "F", "metric_name": " "}], "daily", {"A", "B", "C", "D", "E", "F"}), ("missing", [], "monthly", {"A", "B", "C", "D", "E"})):
        target = str(tmp_path / name)
        with pytest.raises(DefinitionError):
            run_definitions(spark, definitions(tmp_path, *more), info, "2024-01-15", wanted, {}, {}, target, "bld", executed_at=NOW)
        rows = spark.read.parquet(target).collect()
        assert {r.source_system_id for r in rows} == ids and all("[PIPELINE_VALIDATION_ERROR]" in r.excldd_reason_tx for r in rows)
    monkeypatch.setattr(module, "append", lambda *args: 1 / 0)
    with pytest.raises(DefinitionError) as caught:
        run_definitions(spark, definitions(tmp_path), info, "2024-01-15", "monthly", {}, {}, str(tmp_path / "x"), "bld", executed_at=NOW)
    assert "could not be written" in caught.value.__notes__[0]


def test_failed_run_leaves_failure_rows(spark, tmp_path, monkeypatch):
    from tidemark.plans import run as module
    info = spark.createDataFrame([("p.d", "staff", "2024-01-10")], "project_dataset string, table_name string, partition_dt string")
    def broken(*args, **kwargs):
        raise RuntimeError("cluster\nlost")
    monkeypatch.setattr(module, "run_metrics", broken)
    with pytest.raises(RuntimeError):
        run_definitions(spark, definitions(tmp_path), info, "2024-01-15", "daily", {}, {}, str(tmp_path / "recon"), "bld", executed_at=NOW)
    rows = spark.read.parquet(str(tmp_path / "recon")).collect()
    assert {r.source_system_id for r in rows} == {"A", "B", "C", "E"} and {r.rcncln_exact_pass_in for r in rows} == {"Failed"}
    assert rows[0].excldd_reason_tx.endswith("[PIPELINE_EXECUTION_ERROR] Pipeline failed: cluster lost")


def _four(spark, slow=()):
    burn = "SELECT count(*) AS metric_output, '2024-01-10' AS business_data_date FROM range(5000000000000) WHERE id % 7 = {}"
    quick = "SELECT {} AS metric_output, '2024-01-10' AS business_data_date"
    rows = [(f"m{i}", (burn if i in slow else quick).format(i), "w.m.t") for i in range(4)]
    return spark.createDataFrame(rows, "metric_id string, sql string, target_table string")


def test_a_plan_has_the_time_of_all_its_queries_and_each_runs_twice_at_most(spark, monkeypatch):
    calls, limits = [], []
    plain_evaluate, plain_limit = M.evaluate, M.time_limit
    monkeypatch.setattr(M, "evaluate", lambda spark, raws: (calls.append(list(raws)), plain_evaluate(spark, raws))[1])
    monkeypatch.setattr(M, "time_limit", lambda spark, seconds: (limits.append(seconds), plain_limit(spark, seconds))[1])
    none = spark.createDataFrame([], "project_dataset string, table_name string, partition_dt date")
    good, failed = M.run_metrics(spark, _four(spark), dt.date(2024, 1, 11), none, timeout=30)
    assert good.count() == 4 and failed.count() == 0 and limits == [120] and calls == [["m0", "m1", "m2", "m3"]]

    calls.clear(), limits.clear()
    good, failed = M.run_metrics(spark, _four(spark, slow={2}), dt.date(2024, 1, 11), none, timeout=2)
    assert [r.metric_id for r in failed.collect()] == ["m2"] and good.count() == 3
    assert limits == [8, 2, 2, 2, 2] and calls == [["m0", "m1", "m2", "m3"], ["m0"], ["m1"], ["m2"], ["m3"]]


def runs(spark, tmp_path):
    """Arguments of a run with two targets, of which the second may be no place to write to."""
    info = spark.createDataFrame([("p.d", "staff", "2024-01-10")], "project_dataset string, table_name string, partition_dt string")
    return lambda second, **more: run_definitions(
        spark, definitions(tmp_path), info, "2024-01-15", "daily", {"p.d.staff": staff(spark)}, {"p.d.out": str(tmp_path / "out"), "p.d.nowhere": second},
        str(tmp_path / "recon"), "bld", executed_at=NOW, **more)


def told(spark, path):
    return sorted((r.metric_id, str(r.partition_dt), r.metric_output) for r in spark.read.parquet(str(path)).collect())


def test_all_or_nothing_leaves_the_targets_as_before(spark, tmp_path):
    run = runs(spark, tmp_path)
    run(str(tmp_path / "more"))
    before = told(spark, tmp_path / "out"), told(spark, tmp_path / "more")
    marked = spark.read.parquet(str(tmp_path / "out")).withColumn("metric_output", F.lit(77).cast("decimal(38,9)")).cache()
    assert marked.count() == 1
    marked.write.mode("overwrite").partitionBy("partition_dt").parquet(str(tmp_path / "out"))
    with pytest.raises(Exception, match="SCHEMA_NOT_FOUND|absent_db"):
        run("absent_db.metrics", all_or_nothing=True)
    assert told(spark, tmp_path / "out") == [("A", "2024-01-15", 77)] and told(spark, tmp_path / "more") == before[1]
    recon = spark.read.parquet(str(tmp_path / "recon")).where("rcncln_exact_pass_in = 'Failed' AND source_system_id = 'A'")
    assert recon.count() == 1
    run("absent_db.metrics")
    assert told(spark, tmp_path / "out") == before[0]


def test_targets_are_restored_when_the_reconciliation_fails(spark, tmp_path, monkeypatch):
    from tidemark.plans import run as module
    run, undo = runs(spark, tmp_path), str(tmp_path / "undo")
    with monkeypatch.context() as patched:
        patched.setattr(module, "_reconcile", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(str(tmp_path / "more"), undo=undo)
    assert not list(tmp_path.glob("out/partition_dt=*")) and not list(tmp_path.glob("more/partition_dt=*"))
    with pytest.raises(SourceError, match="another run"):
        run(str(tmp_path / "more"), undo=undo)
    run(str(tmp_path / "more"))
    assert [r[0] for r in told(spark, tmp_path / "out") + told(spark, tmp_path / "more")] == ["A", "C"]
