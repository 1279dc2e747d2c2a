"""Run a data-quality specification: one scan per table for all its row rules.

The specification is a plain dict::

    {"row_filters": {name: {"filter_sql_expr": sql}},
     "rules": {id: {"rule_type", "dimension", "params"}},
     "rule_bindings": {id: {"entity_uri", "column_id", "row_filter_id", "rule_ids"}},
     "metadata_registry_defaults": {"dataplex": {"lakes", "zones"}}}

Expressions are Spark SQL and use ``:as_of`` for the current date.
"""

import datetime as dt
import json
import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DefinitionError
from ..operators import rules as R
from ..operators.isolate import run_apart
from ..schemas import DQ_SUMMARY_SCHEMA
from ..session import checkpoint

# Rule types of the specification, and the seven dimensions.
ROW_RULES = ["NOT_NULL", "NOT_BLANK", "REGEX", "RANGE", "CUSTOM_SQL_EXPR"]
STATEMENT_RULE = "CUSTOM_SQL_STATEMENT"
DIMENSIONS = ["completeness", "validity", "conformance", "uniqueness", "consistency", "integrity", "timeliness"]

# Native forms of common statement rules: they need no SQL text, and the last three cost no scan.
NATIVE_RULES = ["UNIQUE", "FOREIGN_KEY", "FRESHNESS", "VOLUME_DROP", "MIN_ROW_COUNT"]

_URI = re.compile(r"projects/([^/]+)/datasets/([^/]+)/tables/([^/]+)")


@dataclass(frozen=True)
class Check:
    """One rule bound to one column of one table."""

    binding: str
    rule: str
    table: str
    column: str
    filter_name: str
    filter_sql: str
    rule_type: str
    dimension: str
    params: Mapping
    lake: str | None = None
    zone: str | None = None


def read_spec(spark: SparkSession, path: str) -> dict:
    """A specification from a JSON file, or from a YAML file where a YAML reader is installed."""
    text = spark.read.text(path, wholetext=True).first()[0]
    try:
        return json.loads(text)
    except ValueError:
        pass
    try:
        import yaml
    except ImportError as error:
        raise DefinitionError(f"{path!r} is not JSON, and no YAML reader is installed") from error
    return yaml.safe_load(text)


def table_of(entity_uri: str) -> str:
    """``project.dataset.table`` of an entity URI; any other text is the table name itself."""
    found = _URI.search(entity_uri)
    return ".".join(found.groups()) if found else entity_uri


def expand_bindings(spec: Mapping) -> list[Check]:
    """Every (binding, rule) pair with its filter, parameters and registry values resolved."""
    filters = {**spec.get("row_filters", {}), "NONE": {"filter_sql_expr": "true"}}
    defaults = (spec.get("metadata_registry_defaults") or {}).get("dataplex") or {}
    checks = []
    for binding_id, binding in spec["rule_bindings"].items():
        name = binding.get("row_filter_id") or "NONE"
        if name not in filters:
            raise DefinitionError(f"{binding_id}: unknown row filter {name!r}")
        # a binding may name its own place in the registry
        own = {**defaults, **((binding.get("metadata_registry") or {}).get("dataplex") or {})}
        for rule_id in binding["rule_ids"]:
            rule = spec["rules"].get(rule_id)
            if rule is None:
                raise DefinitionError(f"{binding_id}: unknown rule {rule_id!r}")
            kind = rule["rule_type"]
            if kind not in ROW_RULES + [STATEMENT_RULE] + NATIVE_RULES:
                raise DefinitionError(f"{rule_id}: unknown rule type {kind!r}")
            if rule.get("dimension") not in DIMENSIONS:
                raise DefinitionError(f"{rule_id}: unknown dimension {rule.get('dimension')!r}")
            checks.append(Check(binding_id, rule_id, table_of(binding["entity_uri"]), binding["column_id"],
                                name, filters[name]["filter_sql_expr"], kind, rule["dimension"],
                                rule.get("params") or {}, own.get("lakes"), own.get("zones")))
    return checks


def _dated(sql: str, as_of: dt.date) -> str:
    return sql.replace(":as_of", f"DATE '{as_of.isoformat()}'")


def _row_pass(check: Check, as_of: dt.date) -> Column:
    c, p = F.col(f"`{check.column}`"), check.params
    if check.rule_type == "NOT_NULL":
        return R.rule_not_null(c)
    if check.rule_type == "NOT_BLANK":
        return R.rule_not_blank(c)
    if check.rule_type == "REGEX":
        return R.rule_regex(c, p["pattern"])
    if check.rule_type == "RANGE":
        return R.rule_range(c, p.get("min"), p.get("max"))
    return R.rule_expr(_dated(p["custom_sql_expr"], as_of), check.column)


def _table_flag(check: Check, as_of: dt.date) -> Column | None:
    """Failing count of the native rules that are aggregates of the same scan."""
    p, within = check.params, F.expr(_dated(check.filter_sql, as_of))
    if check.rule_type == "FRESHNESS":
        return R.stale_flag(F.when(within, F.col(f"`{check.column}`")), as_of, p.get("empty_is_stale", False))
    if check.rule_type == "VOLUME_DROP":
        return R.drop_flag(within & F.expr(p.get("condition", "true")), F.col(p["ts"]), as_of,
                           p.get("days", 7), p.get("floor", 0.8))
    if check.rule_type == "MIN_ROW_COUNT":
        return F.when(F.count_if(within) < p.get("least", 100), 1).otherwise(0)
    return None


def _own_plan(check: Check, spark: SparkSession, tables: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame | None:
    """Failing count of the rules that need their own shuffle or query."""
    table, p = tables[check.table], check.params
    if check.filter_name != "NONE":
        table = table.where(_dated(check.filter_sql, as_of))
    if check.rule_type == "UNIQUE":
        return R.dup_keys(table, p.get("keys") or [check.column])
    if check.rule_type == "FOREIGN_KEY":
        keys = p.get("keys") or [check.column]
        return R.orphans(table, tables[p["parent"]], keys, p.get("parent_keys"))
    if check.rule_type == STATEMENT_RULE:
        from .metrics import table_views
        with table_views(spark, tables):
            return R.rule_statement(spark, _dated(p["custom_sql_statement"], as_of), table)
    return None


def _metadata(check: Check) -> str:
    shown = {k: v for k, v in check.params.items() if k in ("pattern", "min", "max")}
    return json.dumps({"rule_type": check.rule_type, **shown, "filter": check.filter_name}, separators=(",", ":"))


def table_summary(spark: SparkSession, checks: list[Check], tables: Mapping[str, DataFrame],
                  as_of: dt.date) -> DataFrame:
    """Counts of all checks of one table.

    Row counts per filter, NULL counts per filter and column, failures per row rule and the table
    flags are conditional aggregates of one scan; what follows from them is not counted again. Only
    uniqueness, integrity and free statements add plans, as scalar subqueries of the same row.
    """
    df = tables[checks[0].table]
    filters: dict[str, int] = {}
    columns: dict[str, int] = {}
    aggregates: dict[str, Column] = {}
    own: dict[int, DataFrame] = {}
    packed = []
    for i, check in enumerate(checks):
        f = filters.setdefault(check.filter_sql, len(filters))
        c = columns.setdefault(check.column, len(columns))
        rows, nulls = f"rows_{f}", f"nulls_{f}_{c}"
        if rows not in aggregates:
            aggregates[rows] = F.expr(f"count_if({_dated(check.filter_sql, as_of)})")
        if nulls not in aggregates:
            aggregates[nulls] = F.expr(f"count_if(({_dated(check.filter_sql, as_of)}) AND `{check.column}` IS NULL)")
        # a flag or a free statement may count more than there are rows
        ok, bad = f"greatest({rows} - n_{i}, 0)", f"n_{i}"
        if check.rule_type == "NOT_NULL":
            ok, bad = f"{rows} - {nulls}", nulls
        elif check.rule_type in ROW_RULES:
            passes = _row_pass(check, as_of)
            within = lambda c: c if check.filter_name == "NONE" else F.expr(_dated(check.filter_sql, as_of)) & c
            aggregates[f"n_{i}"] = F.count_if(within(~passes))
            if check.rule_type == "CUSTOM_SQL_EXPR":
                aggregates[f"ok_{i}"] = F.count_if(within(passes))
                ok = f"ok_{i}"
            else:  # undecided exactly where the column is NULL
                ok = f"{rows} - {nulls} - n_{i}"
        elif (flag := _table_flag(check, as_of)) is not None:
            aggregates[f"n_{i}"] = flag.cast("bigint")
        else:
            own[i] = _own_plan(check, spark, tables, as_of)
        packed.append(f"struct({rows} AS rows, {ok} AS ok, {bad} AS bad, {nulls} AS nulls)")
    counted = df.agg(*[column.alias(name) for name, column in aggregates.items()])
    if own:
        counted = counted.select("*", *[plan.scalar().alias(f"n_{i}") for i, plan in own.items()])
    rows = counted.selectExpr("posexplode(array(" + ", ".join(packed) + ")) AS (pos, s)")
    known = _described(spark, [(check, _metadata(check)) for check in checks])
    # one row per check on both sides
    return rows.join(known, "pos").select(
        *_KNOWN, F.col("s.rows").alias("rows_validated"),
        F.col("s.ok").alias("success_count"), F.col("s.bad").alias("failed_count"), F.col("s.nulls").alias("null_count"))


_KNOWN = ["rule_binding_id", "rule_id", "table_id", "column_id", "dimension", "metadata_json_string", "lake", "zone"]


def _described(spark: SparkSession, checks: list[tuple[Check, str]]) -> DataFrame:
    """The describing columns of each check, by its place in the list."""
    return spark.createDataFrame(
        [(i, c.binding, c.rule, c.table, c.column, c.dimension, text, c.lake, c.zone) for i, (c, text) in enumerate(checks)],
        "pos int, " + ", ".join(f"{name} string" for name in _KNOWN))


def _broken(spark: SparkSession, failed: list[tuple[Check, str]]) -> DataFrame:
    """A row per check that could not run: no counts, and the reason among its metadata."""
    texts = [(check, json.dumps({**json.loads(_metadata(check)), "error": reason}, separators=(",", ":"))) for check, reason in failed]
    counts = [F.lit(None).cast("bigint").alias(n) for n in ("rows_validated", "success_count", "failed_count", "null_count")]
    return _described(spark, texts).select(*_KNOWN, *counts)


def percent(part: Column, whole: Column) -> Column:
    """Share of ``whole`` in percent at two places; NULL for an empty table."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def add_percentages(summary: DataFrame) -> DataFrame:
    rows = F.col("rows_validated")
    return summary.withColumns({
        f"{name}_percentage": percent(F.col(f"{name}_count"), rows) for name in ("success", "failed", "null")
    })


def stamp_registry(summary: DataFrame, spec: Mapping, invocation_id: str, run_id: str,
                   executed_at: dt.datetime, asset_id: str | None = None) -> DataFrame:
    """Run and registry columns; the result has the 20 summary columns."""
    place = (spec.get("metadata_registry_defaults") or {}).get("dataplex") or {}
    own = {"lakes": "lake", "zones": "zone"}  # per binding where the rows have it
    registry = lambda name: F.col(own[name]) if own[name] in summary.columns else F.lit(place.get(name))
    moment = F.lit(executed_at).cast("timestamp")
    asset = F.lit(asset_id) if asset_id else F.concat(
        F.replace(F.element_at(F.split("table_id", r"\."), -2), F.lit("_"), F.lit("-")), F.lit("-asset"))
    full = summary.withColumns({
        "invocation_id": F.lit(invocation_id), "execution_ts": moment, "last_modified": moment,
        "dataplex_lake": registry("lakes"), "dataplex_zone": registry("zones"),
        "dataplex_asset_id": asset, "dq_run_id": F.lit(run_id),
    })
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DQ_SUMMARY_SCHEMA])


def run_dq(spark: SparkSession, spec: Mapping, tables: Mapping[str, DataFrame], as_of: dt.date,
           invocation_id: str = "inv", run_id: str = "run", executed_at: dt.datetime | None = None) -> DataFrame:
    """Summary rows of all checks. ``tables`` maps ``project.dataset.table`` to its rows.

    The checks of a table run as one plan and are written to the checkpoint folder. A check that does
    not analyse or fails at run time gives a row without counts, its reason under ``error`` in
    ``metadata_json_string``, and the others finish. A specification that is not sound (an unknown
    rule, filter or table) is an error.
    """
    groups: dict[str, list[Check]] = {}
    for check in expand_bindings(spec):
        if check.table not in tables:
            raise DefinitionError(f"{check.binding}: no table {check.table!r} given")
        groups.setdefault(check.table, []).append(check)
    parts, failed = [], []
    fail = lambda check, reason: failed.append((check, reason))
    for checks in groups.values():
        parts += run_apart(checks, lambda some: checkpoint(table_summary(spark, list(some), tables, as_of)), fail)
    if failed:
        parts.append(_broken(spark, failed))
    moment = executed_at or dt.datetime.now(dt.timezone.utc)
    return stamp_registry(add_percentages(reduce(DataFrame.unionByName, parts)), spec, invocation_id, run_id, moment)


def rollup_dimensions(summary: DataFrame) -> DataFrame:
    """Average and worst success per table and dimension."""
    return summary.groupBy("table_id", "dimension").agg(
        F.count(F.lit(1)).alias("checks"),
        F.round(F.avg("success_percentage"), 2).alias("avg_success_percentage"),
        F.min("success_percentage").alias("worst_success_percentage"))


def apply_threshold(summary: DataFrame, least: float) -> DataFrame:
    """PASS or FAIL per check by its success percentage; an empty table has no verdict."""
    share = F.col("success_percentage")
    return summary.withColumn("status", F.when(share.isNull(), None).when(share < least, "FAIL").otherwise("PASS"))
