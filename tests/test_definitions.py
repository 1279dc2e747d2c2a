import datetime as dt
import json

import pytest

from tidemark.errors import DefinitionError, SourceError
from tidemark.operators import partitions as P
from tidemark.operators import validate as V
from tidemark.sources import check_path, read_metric_defs


def definition(**changes):
    base = {"metric_id": "M1", "metric_name": "Orders", "metric_type": "Count", "dependency": "daily", "target_table": "p.d.t",
            "sql": "SELECT count(*) AS metric_output FROM `p.d.src` WHERE partition_dt = {currently}"}
    return {k: v for k, v in {**base, **changes}.items() if v != "ABSENT"}


def write(tmp_path, content):
    path = tmp_path / "defs.json"
    path.write_text(content if isinstance(content, str) else json.dumps(content, indent=2))
    return f"file://{path}"


def problems(spark, tmp_path, *defs, check=V.validate):
    found = check(read_metric_defs(spark, write(tmp_path, list(defs))))
    return sorted((r.record_index, r.severity, r.code) for r in found.collect())


def test_reads_definitions_in_order(spark, tmp_path):
    defs = read_metric_defs(spark, write(tmp_path, [definition(metric_id="A"), definition(metric_id="B", frequency="Daily")]))
    assert [(r.record_index, r.metric_id, r.frequency) for r in defs.collect()] == [(0, "A", None), (1, "B", "Daily")]


@pytest.mark.parametrize("content", ["{}", "[]", "[{]", "not json"])
def test_unusable_files_are_errors(spark, tmp_path, content):
    with pytest.raises(SourceError):
        read_metric_defs(spark, write(tmp_path, content))


def test_path_check(spark, tmp_path):
    good = write(tmp_path, [definition()])
    assert check_path(spark, good) == good
    for bad in ("defs.json", "s3a://", "s3a://bucket", "s3a:///object", f"file://{tmp_path}/nothing.json"):
        with pytest.raises(SourceError):
            check_path(spark, bad)


@pytest.mark.parametrize("change, code", [
    ({"metric_id": "ABSENT"}, "MISSING_FIELD"), ({"metric_name": None}, "MISSING_FIELD"), ({"sql": "ABSENT"}, "MISSING_FIELD"),
    ({"target_table": "ABSENT"}, "MISSING_FIELD"), ({"metric_id": ""}, "BLANK_FIELD"), ({"metric_type": "   "}, "BLANK_FIELD"),
    ({"target_table": "p.t"}, "TARGET_TABLE_FORMAT"), ({"target_table": "p..t"}, "TARGET_TABLE_PART"),
    ({"target_table": "p.d.t.x"}, "TARGET_TABLE_FORMAT"), ({"partition_mode": "currently|"}, "PARTITION_MODE"),
    ({"partition_mode": "weekly"}, "PARTITION_MODE")])
def test_one_flaw_is_one_error(spark, tmp_path, change, code):
    assert (0, "error", code) in problems(spark, tmp_path, definition(**change))


def test_good_definition_has_no_problem(spark, tmp_path):
    assert problems(spark, tmp_path, definition(partition_mode="currently | partition_info")) == []


def test_duplicate_ids_after_trim(spark, tmp_path):
    assert problems(spark, tmp_path, definition(), definition(metric_id=" M1 "), definition(metric_id="M2")) == [
        (1, "error", "DUPLICATE_ID"), (1, "warning", "ID_PATTERN")]


def test_unknown_placeholder_is_a_warning(spark, tmp_path):
    assert problems(spark, tmp_path, definition(sql="SELECT 1 WHERE d = '{current}'")) == [(0, "warning", "NO_PLACEHOLDER")]


def test_limits(spark, tmp_path):
    assert problems(spark, tmp_path, definition(metric_id="x" * 101, metric_name="n" * 256)) == [
        (0, "warning", "ID_LENGTH"), (0, "warning", "NAME_LENGTH")]


def test_raise_gives_the_first_error(spark, tmp_path):
    defs = read_metric_defs(spark, write(tmp_path, [definition(), definition(metric_id="B", target_table="x"), definition(metric_id=None)]))
    with pytest.raises(DefinitionError, match="Record 1: target_table 'x'"):
        V.raise_on_error(V.validate(defs))
    V.raise_on_error(V.check_limits(defs))


def test_dependencies(spark, tmp_path):
    defs = read_metric_defs(spark, write(tmp_path, [definition(), definition(metric_id="B", dependency="weekly")]))
    V.require_dependencies(defs, ["daily"])
    with pytest.raises(DefinitionError, match=r"\['none'\].*\['daily', 'weekly'\]"):
        V.require_dependencies(defs, ["daily", "none"])
    assert [r.metric_id for r in V.filter_dependencies(defs, ["weekly"]).collect()] == ["B"]
    with pytest.raises(DefinitionError):
        V.filter_dependencies(defs, ["none"], required=True)


def test_arguments():
    assert V.parse_dependencies(" a, ,b,") == ["a", "b"]
    assert V.check_run_date("2024-02-29") == dt.date(2024, 2, 29)
    for bad in ("2024-02-30", "2024-1-5", "20240105", "", None):
        with pytest.raises(DefinitionError):
            V.check_run_date(bad)
    with pytest.raises(DefinitionError):
        V.parse_dependencies(" , ")


INFO = [("p.d", "src", "2024-01-15"), ("p.d", "src", "2024-01-14"), ("d", "other", "2024-01-10"), ("d", "src", "2023-01-01"),
        ("d", "empty", None), ("d", "bad", "2024-13-01")]


def info(spark):
    return spark.createDataFrame(INFO, "project_dataset string, table_name string, partition_dt string")


def test_latest_partition_ignores_null_and_invalid(spark):
    latest = {(r.project_dataset, r.table_name): str(r.partition_dt) for r in P.latest_partition(info(spark)).collect()}
    assert latest == {("p.d", "src"): "2024-01-15", ("d", "other"): "2024-01-10", ("d", "src"): "2023-01-01"}


def bindings(spark, sql, **more):
    defs = spark.createDataFrame([("m", sql, more.get("mode"))], "metric_id string, sql string, partition_mode string")
    bind = P.bind_positional if more else P.bind_dates
    found = bind(defs, dt.date(2024, 1, 20), P.latest_partition(info(spark)))
    return [(r.ordinal, str(r.bound_date) if r.bound_date else None, r.error) for r in found.orderBy("ordinal").collect()]


def test_nearest_table_before_the_placeholder(spark):
    sql = ("SELECT 1 FROM `p.d.src` a WHERE a.d = {partition_info} AND a.e = '{currently}' "
           "AND EXISTS (SELECT 1 FROM `p.d.other` b WHERE b.d = {partition_info})")
    assert bindings(spark, sql) == [(0, "2024-01-15", None), (1, "2024-01-20", None), (2, "2024-01-10", None)]


def test_unbound_placeholders_say_why(spark):
    assert bindings(spark, "SELECT 1 FROM t WHERE d = {partition_info}")[0][2] == "no table reference before the placeholder"
    assert bindings(spark, "SELECT 1 FROM `p.d.empty` WHERE d = {partition_info}")[0][2] == "no partition date for p.d.empty"


def test_positional_dates(spark):
    sql = "SELECT 1 FROM `p.d.src` a, `p.d.other` b WHERE a.d = {run_date} AND b.d = {run_date}"
    assert bindings(spark, sql, mode="currently|partition_info") == [(0, "2024-01-20", None), (1, "2024-01-10", None)]
    assert "differ in number" in bindings(spark, sql, mode="currently")[0][2]


def test_partition_info_needs_its_columns(spark):
    assert P.validate_partition_info(info(spark)) == len(INFO)
    with pytest.raises(DefinitionError, match="partition_dt"):
        P.validate_partition_info(info(spark).drop("partition_dt"))


def test_lookback_bounds_all_tables(spark):
    dated = info(spark).selectExpr("project_dataset", "table_name", "try_cast(partition_dt as date) as partition_dt")
    refs = dated.select("project_dataset", "table_name")
    found = P.latest_partitions(dated, refs, dt.date(2024, 1, 20), 30)
    assert {(r.project_dataset, r.table_name) for r in found.collect()} == {("p.d", "src"), ("d", "other")}
    assert ("d", "src") in {tuple(r) for r in P.missing_partitions(refs, found).collect()}
    # text dates, some of them no dates, give the same
    as_text = P.latest_partitions(info(spark), refs, dt.date(2024, 1, 20), 30)
    assert sorted(tuple(r) for r in as_text.collect()) == sorted(tuple(r) for r in found.collect())
