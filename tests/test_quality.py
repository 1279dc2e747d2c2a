import datetime as dt

import pytest

from tidemark.errors import DefinitionError
from tidemark.operators import expect as E
from tidemark.operators import rules as R
from tidemark.plans import quality as Q
from tidemark.schemas import DQ_SUMMARY_SCHEMA

DAY = dt.date(2024, 3, 15)
URI = "bigquery://projects/p/datasets/d/tables/staff"


def staff(spark):
    rows = [("A1234567", "ACTIVE", "Ann", 1.5, DAY), ("A1234567", "LEAVER", " \t", 400.0, DAY), ("b1", "ACTIVE", None, None, dt.date(2024, 3, 8)),
            (None, "ACTIVE", "", 0.25, DAY)]
    return spark.createDataFrame(rows, "id string, status string, name string, days double, loaded date")


def spec(rule_ids, rules, column="id", row_filter="NONE"):
    return {"row_filters": {"ACTIVE": {"filter_sql_expr": "status = 'ACTIVE'"}}, "rules": rules,
            "rule_bindings": {"B": {"entity_uri": URI, "column_id": column, "row_filter_id": row_filter, "rule_ids": rule_ids}}}


def counts(spark, kind, column, row_filter="NONE", dimension="validity", **params):
    one = spec(["R"], {"R": {"rule_type": kind, "dimension": dimension, "params": params}}, column, row_filter)
    r = Q.run_dq(spark, one, {"p.d.staff": staff(spark)}, DAY).first()
    return r.rows_validated, r.success_count, r.failed_count, r.null_count


def test_row_rules(spark):
    assert counts(spark, "NOT_NULL", "id") == (4, 3, 1, 1)
    assert counts(spark, "NOT_BLANK", "name") == (4, 1, 2, 1)
    assert counts(spark, "REGEX", "id", pattern="^[A-Z][0-9]{7}$") == (4, 2, 1, 1)
    assert counts(spark, "RANGE", "days", min=0.5, max=365) == (4, 1, 2, 1)
    assert counts(spark, "RANGE", "days", min=1, max=None) == (4, 2, 1, 1)
    assert counts(spark, "RANGE", "days") == (4, 3, 0, 1)
    assert counts(spark, "RANGE", "days", "ACTIVE", min=0.5) == (3, 1, 1, 1)
    assert counts(spark, "CUSTOM_SQL_EXPR", "status", custom_sql_expr="$column IN ('ACTIVE', 'LEAVER')") == (4, 4, 0, 0)
    assert counts(spark, "CUSTOM_SQL_EXPR", "days", custom_sql_expr="NOT (status = 'ACTIVE' AND $column IS NULL)") == (4, 3, 1, 1)
    assert counts(spark, "CUSTOM_SQL_EXPR", "loaded", custom_sql_expr="$column >= :as_of") == (4, 3, 1, 0)


def test_statement_and_native_rules_agree(spark):
    unique = "SELECT COUNT(*) AS n FROM (SELECT id FROM $table GROUP BY id HAVING COUNT(*) > 1)"
    assert counts(spark, "CUSTOM_SQL_STATEMENT", "id", custom_sql_statement=unique) == counts(spark, "UNIQUE", "id") == (4, 3, 1, 1)
    fresh = "SELECT CASE WHEN MAX(DATE(loaded)) < :as_of THEN 1 ELSE 0 END AS n FROM $table"
    assert counts(spark, "CUSTOM_SQL_STATEMENT", "loaded", custom_sql_statement=fresh) == counts(spark, "FRESHNESS", "loaded") == (4, 4, 0, 0)
    few = "SELECT CASE WHEN COUNT(*) < 100 THEN 1 ELSE 0 END AS n FROM $table"
    assert counts(spark, "CUSTOM_SQL_STATEMENT", "id", custom_sql_statement=few) == counts(spark, "MIN_ROW_COUNT", "id") == (4, 3, 1, 1)
    drop = ("WITH now AS (SELECT COUNT(*) AS c FROM $table WHERE status = 'ACTIVE' AND DATE(loaded) = :as_of), before AS (SELECT COUNT(*) AS c FROM $table "
            "WHERE status = 'ACTIVE' AND DATE(loaded) = DATE_SUB(:as_of, 7)) SELECT CASE WHEN before.c > 0 AND now.c / before.c < 0.8 THEN 1 ELSE 0 END AS n FROM now, before")
    assert counts(spark, "CUSTOM_SQL_STATEMENT", "id", custom_sql_statement=drop) == counts(spark, "VOLUME_DROP", "id", ts="loaded", condition="status = 'ACTIVE'")
    parent = spark.createDataFrame([("A1234567",)], "id string")
    foreign = spec(["R"], {"R": {"rule_type": "FOREIGN_KEY", "dimension": "integrity", "params": {"parent": "p.d.master"}}})
    row = Q.run_dq(spark, foreign, {"p.d.staff": staff(spark), "p.d.master": parent}, DAY).first()
    assert (row.success_count, row.failed_count) == (2, 2)
    sql = "SELECT COUNT(*) AS n FROM $table AS a WHERE NOT EXISTS (SELECT 1 FROM `p.d.master` AS e WHERE e.id = a.id)"
    stated = spec(["R"], {"R": {"rule_type": "CUSTOM_SQL_STATEMENT", "dimension": "integrity", "params": {"custom_sql_statement": sql}}})
    assert Q.run_dq(spark, stated, {"p.d.staff": staff(spark), "p.d.master": parent}, DAY).first().failed_count == 2


def test_freshness_of_an_empty_table(spark):
    empty = staff(spark).limit(0)
    assert R.is_stale(empty, "loaded", DAY).first().n == 0 and R.is_stale(empty, "loaded", DAY, empty_is_stale=True).first().n == 1
    assert R.is_stale(staff(spark), "loaded", dt.date(2024, 3, 16)).first().n == 1


def test_summary_layout_and_percentages(spark):
    one = spec(["NOT_NULL"], {"NOT_NULL": {"rule_type": "NOT_NULL", "dimension": "completeness"}}, "name")
    df = Q.run_dq(spark, one, {"p.d.staff": staff(spark)}, DAY, "inv", "run", dt.datetime(2024, 3, 15, 2))
    assert df.columns == DQ_SUMMARY_SCHEMA.fieldNames()
    row = df.first()
    assert (row.success_percentage, row.failed_percentage, row.null_percentage) == (75.0, 25.0, 25.0) and row.table_id == "p.d.staff"
    empty = Q.run_dq(spark, one, {"p.d.staff": staff(spark).limit(0)}, DAY)
    assert empty.first().success_percentage is None and Q.apply_threshold(empty, 90).first().status is None


def test_percentages_of_known_counts(spark):
    df = spark.createDataFrame([(50000, 49983, 17, 17), (42300, 34923, 7377, 0), (18500, 18487, 13, 0)],
                               "rows_validated long, success_count long, failed_count long, null_count long")
    got = [(r.success_percentage, r.failed_percentage, r.null_percentage) for r in Q.add_percentages(df).collect()]
    assert got == [(99.97, 0.03, 0.03), (82.56, 17.44, 0.0), (99.93, 0.07, 0.0)]


def test_bad_specifications(spark):
    good = {"R": {"rule_type": "NOT_NULL", "dimension": "completeness"}}
    for bad in (spec(["X"], good), spec(["R"], {"R": {"rule_type": "ODD", "dimension": "validity"}}), spec(["R"], {"R": {"rule_type": "NOT_NULL", "dimension": "odd"}}),
                spec(["R"], good, row_filter="NOWHERE")):
        with pytest.raises(DefinitionError):
            Q.expand_bindings(bad)
    with pytest.raises(DefinitionError, match="no table"):
        Q.run_dq(spark, spec(["R"], good), {}, DAY)


@pytest.mark.parametrize("condition, status", [("0", "FAIL"), ("3", "PASS"), ("5", "PASS"), (">=3", "PASS"), ("> 3", "FAIL"), ("<3", "FAIL"), ("<=3", "PASS"), ("=3", "PASS")])
def test_numeric_conditions(spark, condition, status):
    assert E.expect_number(spark.createDataFrame([(3,)], "n int"), condition).first().status == status


def test_value_and_row_expectations(spark):
    names = spark.createDataFrame([("Ann",), ("Bob",), ("Bob",)], "name string")
    status = lambda df: df.first().status
    assert status(E.expect_in_set(names, ["Ann", "Bob", "Cy"])) == "PASS" and status(E.expect_in_set(names, ["Ann"])) == "FAIL"
    assert status(E.expect_not_in(names, ["Cy"])) == "PASS" and status(E.expect_not_in(names, ["Bob"])) == "FAIL"
    assert status(E.expect_rows(names, [{"name": "Bob"}, {"name": "Ann"}, {"name": "Bob"}])) == "PASS"
    short = E.expect_rows(names, [{"name": "Bob"}, {"name": "Ann"}, {"name": "Cy"}]).first()
    assert (short.missing, short.extra, short.status) == (1, 1, "FAIL")
    with pytest.raises(DefinitionError):
        E.expect_number(names, "about 3")


def test_filters_scope_every_rule(spark):
    assert counts(spark, "UNIQUE", "id", "ACTIVE") == (3, 3, 0, 1)
    statement = "SELECT 10 AS n FROM $table LIMIT 1"
    assert counts(spark, "CUSTOM_SQL_STATEMENT", "id", "ACTIVE", custom_sql_statement=statement) == (3, 0, 10, 1)
    assert counts(spark, "MIN_ROW_COUNT", "id", "ACTIVE", least=4) == (3, 2, 1, 1)
    assert counts(spark, "MIN_ROW_COUNT", "id", least=4) == (4, 4, 0, 1)
    assert counts(spark, "FRESHNESS", "loaded", "ACTIVE") == (3, 3, 0, 0)


def test_a_failing_check_leaves_the_others(spark):
    rules = {"GOOD": {"rule_type": "NOT_NULL", "dimension": "validity"},
             "UNKNOWN": {"rule_type": "CUSTOM_SQL_EXPR", "dimension": "validity", "params": {"custom_sql_expr": "no_such_column > 1"}},
             "RUNTIME": {"rule_type": "CUSTOM_SQL_EXPR", "dimension": "validity", "params": {"custom_sql_expr": "raise_error('boom') IS NULL"}},
             "ALSO": {"rule_type": "NOT_BLANK", "dimension": "validity"}}
    out = {r.rule_id: r for r in Q.run_dq(spark, spec(list(rules), rules), {"p.d.staff": staff(spark)}, DAY).collect()}
    assert out["GOOD"].failed_count == 1 and out["ALSO"].failed_count == 0
    assert out["UNKNOWN"].success_count is None and "no_such_column" in out["UNKNOWN"].metadata_json_string
    assert out["RUNTIME"].failed_count is None and "boom" in out["RUNTIME"].metadata_json_string


def test_bindings_name_their_own_registry(spark):
    given = spec(["R"], {"R": {"rule_type": "NOT_NULL", "dimension": "validity"}})
    given["metadata_registry_defaults"] = {"dataplex": {"lakes": "lake", "zones": "raw"}}
    given["rule_bindings"]["C"] = {**given["rule_bindings"]["B"], "metadata_registry": {"dataplex": {"zones": "own"}}}
    out = {r.rule_binding_id: (r.dataplex_lake, r.dataplex_zone) for r in Q.run_dq(spark, given, {"p.d.staff": staff(spark)}, DAY).collect()}
    assert out == {"B": ("lake", "raw"), "C": ("lake", "own")}


def test_empty_results_and_lists_and_failing_expectations(spark):
    numbers = spark.createDataFrame([(1,), (None,)], "n int")
    assert E.expect_number(numbers.limit(0), "5").first().status == "FAIL" and E.expect_number(numbers, "5").first().status == "FAIL"
    assert E.expect_rows(numbers.limit(0), []).first().status == "PASS" and E.expect_rows(numbers, []).first().extra == 2
    check = lambda key, sql: {"check_id": key, "sql": sql, "comparison_type": "numeric_condition", "expected_output": "1", "impacted_downstream": ["x"]}
    out = {r.check_id: r for r in E.run_expectations(spark, [check("a", "SELECT 1"), check("b", "SELECT nothing FROM nowhere"), check("c", "SELECT raise_error('boom')"), check("d", "SELECT 2")]).collect()}
    assert [out[k].status for k in "abcd"] == ["PASS", "ERROR", "ERROR", "FAIL"] and "nowhere" in out["b"].error_message


YAML = """
row_filters:
  NONE:
    filter_sql_expr: "True"
  ACTIVE:
    filter_sql_expr: >
      status = 'ACTIVE'
rules:
  NOT_BLANK: {rule_type: NOT_BLANK, dimension: completeness}
  DAYS: {rule_type: RANGE, dimension: validity, params: {min: 0.5, max: null}}
rule_bindings:
  NAME: {entity_uri: "bigquery://projects/p/datasets/d/tables/staff", column_id: name, row_filter_id: NONE, rule_ids: [NOT_BLANK]}
  DAYS: {entity_uri: "bigquery://projects/p/datasets/d/tables/staff", column_id: days, row_filter_id: ACTIVE, rule_ids: [DAYS, NOT_BLANK]}
"""


def test_specification_file(spark, tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "rules.yml"
    path.write_text(YAML)
    summary = Q.run_dq(spark, Q.read_spec(spark, str(path)), {"p.d.staff": staff(spark)}, DAY)
    got = {(r.rule_binding_id, r.rule_id): (r.rows_validated, r.success_count, r.failed_count, r.null_count) for r in summary.collect()}
    assert got == {("NAME", "NOT_BLANK"): (4, 1, 2, 1), ("DAYS", "DAYS"): (3, 1, 1, 1), ("DAYS", "NOT_BLANK"): (3, 2, 0, 1)}
    json_path = tmp_path / "rules.json"
    json_path.write_text('{"rules": {}, "rule_bindings": {}}')
    assert Q.read_spec(spark, str(json_path)) == {"rules": {}, "rule_bindings": {}}


def test_key_sets_share_one_shuffle_and_tell_nulls_from_absent_columns(spark):
    rows = [(1, None, "a"), (1, None, "a"), (2, "x", None), (2, "y", None), (None, "x", "b"), (None, None, None)]
    df = spark.createDataFrame(rows, "a int, b string, c string")
    sets = {"ab": ["a", "b"], "ba": ["b", "a"], "a": ["a"], "c": ["c"], "abc": ["a", "b", "c"]}
    out = R.dup_key_sets(df, sets)
    assert {r.key_set: r.n for r in out.collect()} == {name: R.dup_keys(df, keys).first().n for name, keys in sets.items()}
    assert {r.key_set: r.n for r in R.dup_key_sets(df.limit(0), sets).collect()} == dict.fromkeys(sets, 0)
    plan = R.dup_key_sets(df, sets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("hashpartitioning(a") == 1
