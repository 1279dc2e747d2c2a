"""Expectations on query results."""

import json
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DefinitionError
from ..session import checkpoint
from .isolate import run_apart

# The comparison types.
COMPARISONS = ["numeric_condition", "set_match", "not_in_result", "row_match"]

_CONDITION = re.compile(r"^\s*(>=|<=|>|<|=)?\s*(-?\d+(?:\.\d+)?)\s*$")


def expect_number(df: DataFrame, condition: str) -> DataFrame:
    """One row: the number of a one-row result against ``n`` (meaning at most n) or ``>=n`` etc.

    Every row of a longer result must hold; an empty result and a NULL number fail.
    """
    found = _CONDITION.match(str(condition))
    if not found:
        raise DefinitionError(f"not a numeric condition: {condition!r}")
    op, bound = found[1] or "<=", F.lit(float(found[2]))
    actual = F.col(f"`{df.columns[0]}`").cast("double")
    holds = {">=": actual >= bound, "<=": actual <= bound, ">": actual > bound,
             "<": actual < bound, "=": actual == bound}[op]
    held = F.bool_and(F.coalesce(F.col("holds"), F.lit(False)))
    return df.select(actual.alias("actual"), holds.alias("holds")).agg(
        F.first("actual").alias("actual"), F.when(held, "PASS").otherwise("FAIL").alias("status"))


def _values(df: DataFrame) -> DataFrame:
    return df.select(F.col(f"`{df.columns[0]}`").cast("string").alias("value")).distinct()


def unexpected_values(df: DataFrame, allowed: Sequence) -> DataFrame:
    """Returned values outside the allowed list; NULL is outside too."""
    keep = F.col("value").isin([str(v) for v in allowed])
    return _values(df).where(~F.coalesce(keep, F.lit(False)))


def forbidden_values(df: DataFrame, forbidden: Sequence) -> DataFrame:
    """Returned values of the forbidden list."""
    return _values(df).where(F.col("value").isin([str(v) for v in forbidden]))


def _verdict(offending: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return offending.agg(n.alias("offending"), F.when(n == 0, "PASS").otherwise("FAIL").alias("status"))


def expect_in_set(df: DataFrame, allowed: Sequence) -> DataFrame:
    """PASS when every returned value is allowed."""
    return _verdict(unexpected_values(df, allowed))


def expect_not_in(df: DataFrame, forbidden: Sequence) -> DataFrame:
    """PASS when no forbidden value is returned."""
    return _verdict(forbidden_values(df, forbidden))


def row_differences(df: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows of two multisets that differ, with ``side`` (missing or extra) and how often.

    Both sides are counted per distinct row first, so copies of a row meet as numbers.
    """
    columns = expected.columns
    signed = (df.select(*columns).withColumn("__w", F.lit(1))
              .unionByName(expected.withColumn("__w", F.lit(-1))))
    weight = signed.groupBy(*columns).agg(F.sum("__w").alias("__w")).where("__w <> 0")
    return weight.select(*columns, F.when(F.col("__w") > 0, "extra").otherwise("missing").alias("side"),
                         F.abs("__w").alias("times"))


def expect_rows(df: DataFrame, expected: DataFrame | Sequence[Mapping]) -> DataFrame:
    """PASS when the result is exactly the expected multiset of rows; an empty list expects no rows."""
    if not isinstance(expected, DataFrame) and not expected:
        expected = df.limit(0)
    if not isinstance(expected, DataFrame):
        names = list(expected[0])
        given = df.sparkSession.createDataFrame([tuple(r[n] for n in names) for r in expected], names)
        expected = given.select(*[F.col(f"`{n}`").cast(df.schema[n].dataType).alias(n) for n in names])
    sides = row_differences(df, expected).agg(
        F.coalesce(F.sum(F.when(F.col("side") == "missing", F.col("times"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(F.col("side") == "extra", F.col("times"))), F.lit(0)).alias("extra"))
    clean = (F.col("missing") == 0) & (F.col("extra") == 0)
    return sides.withColumn("status", F.when(clean, "PASS").otherwise("FAIL"))


def run_expectations(spark: SparkSession, checks: Sequence[Mapping]) -> DataFrame:
    """``check_id``, ``comparison_type``, ``status``, ``impacted_downstream`` and ``error_message`` of each check.

    A check's ``sql`` is a query or a DataFrame. All checks run as one plan, written to the checkpoint
    folder. One that does not analyse or fails at run time has the status ERROR and its reason; the others
    finish. An unknown ``comparison_type`` is an error of the specification.
    """
    for check in checks:
        if check["comparison_type"] not in COMPARISONS:
            raise DefinitionError(f"unknown comparison_type {check['comparison_type']!r}")

    def row(check: Mapping, status: DataFrame, error: str | None = None) -> DataFrame:
        impacted = [F.lit(name) for name in check.get("impacted_downstream") or []]
        return status.select(
            F.lit(check["check_id"]).alias("check_id"), F.lit(check["comparison_type"]).alias("comparison_type"), "status",
            F.array(*impacted).cast("array<string>").alias("impacted_downstream"), F.lit(error).cast("string").alias("error_message"))

    def one(check: Mapping) -> DataFrame:
        kind, wanted = check["comparison_type"], check["expected_output"]
        df = check["sql"] if isinstance(check["sql"], DataFrame) else spark.sql(check["sql"])
        if kind != "numeric_condition" and isinstance(wanted, str):
            wanted = json.loads(wanted)
        run = {"numeric_condition": expect_number, "set_match": expect_in_set,
               "not_in_result": expect_not_in, "row_match": expect_rows}[kind]
        return row(check, run(df, wanted))

    parts = []
    fail = lambda check, reason: parts.append(row(check, spark.range(1).select(F.lit("ERROR").alias("status")), reason))
    parts += run_apart(list(checks), lambda some: checkpoint(reduce(DataFrame.unionByName, map(one, some))), fail)
    return reduce(DataFrame.unionByName, parts)


def explode_impacted(results: DataFrame) -> DataFrame:
    """One row per check that failed or could not run, and downstream system it may break."""
    return (results.where("status <> 'PASS'")
            .select("check_id", F.explode("impacted_downstream").alias("impacted")))
