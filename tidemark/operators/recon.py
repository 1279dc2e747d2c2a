"""Reconciliation rows of a run, and monitoring on them."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_error, format_error
from ..schemas import RECON_SCHEMA
from .partitions import source_columns

# Constants and texts of reconciliation rows.
MODULE_ID, MODULE_TYPE = "103", "Metrics"
NOT_APPLICABLE = ["source_column_nm", "source_file_nm", "source_contrl_file_nm", "target_column_nm",
                  "target_file_nm", "target_contrl_file_nm", "tolrnc_pc", "rcncln_tolrnc_pass_in"]
WRITTEN_TEXT = "Metric data was successfully written."
FAILED_TEXT = "Metric data was failed written."
UNKNOWN_FAILURE = "Unknown failure occurred during processing"
FALLBACK_TEXT = "Failed to create recon record: "


def classify(defs: DataFrame, written: DataFrame, exec_fail: DataFrame, write_fail: DataFrame) -> DataFrame:
    """Definitions with ``is_success``, ``error_message`` and ``error_category``.

    Success is an id written to its own target. Otherwise the reason is the execution failure, else
    the write failure, else unknown. All three sides have one row per metric.
    """
    none = F.lit(None).cast("string")
    side = lambda df, target, ran, wrote: df.select("metric_id", target.alias("__target"), ran.alias("__exec"), wrote.alias("__write"))
    sides = (side(written, F.col("target_table"), none, none).unionByName(side(exec_fail, none, F.col("error_message"), none))
             .unionByName(side(write_fail, none, none, F.col("error_message"))))
    # at most one entry per target in the set; one shuffle of the outcomes and one of the definitions
    outcome = sides.groupBy("metric_id").agg(F.collect_set("__target").alias("__targets"), F.max("__exec").alias("__exec"), F.max("__write").alias("__write"))
    joined = defs.join(outcome, "metric_id", "left")
    ok = F.coalesce(F.array_contains("__targets", F.trim("target_table")), F.lit(False))
    message = F.coalesce("__exec", "__write", F.lit(UNKNOWN_FAILURE))
    category = (F.when(F.col("__exec").isNotNull(), "SQL_EXECUTION_ERROR")
                .when(F.col("__write").isNotNull(), "BIGQUERY_WRITE_ERROR").otherwise("UNKNOWN_ERROR"))
    return joined.select(*defs.columns, ok.alias("is_success"), F.when(~ok, message).alias("error_message"),
                         F.when(~ok, category).alias("error_category"))


def _layout(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    return df.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in RECON_SCHEMA])


def _common(run_date: str, env: str, partition_dt: dt.date, loaded_at: dt.datetime,
            module_id: str, module_type: str) -> dict[str, Column]:
    return {
        "module_id": F.lit(module_id), "module_type_nm": F.lit(module_type),
        "source_server_nm": F.lit(env), "target_server_nm": F.lit(env),
        "latest_source_parttn_dt": F.lit(run_date), "latest_target_parttn_dt": F.lit(run_date),
        "load_ts": F.lit(loaded_at.strftime("%Y-%m-%d %H:%M:%S")),
        "schdld_dt": F.lit(partition_dt), "schdld_yr": F.lit(loaded_at.year),
        **{name: F.lit("NA") for name in NOT_APPLICABLE},
    }


def recon_rows(outcomes: DataFrame, run_date: str, env: str, partition_dt: dt.date, loaded_at: dt.datetime,
               module_id: str = MODULE_ID, module_type: str = MODULE_TYPE) -> DataFrame:
    """One 29-column row per classified metric."""
    ok = F.col("is_success")
    reason = F.when(F.col("error_category").isNotNull(), format_error(F.col("error_message"), F.col("error_category"))
                    ).otherwise(F.concat(F.lit("Error: "), clean_error(F.col("error_message"))))
    target = F.split(F.trim("target_table"), r"\.")
    part = lambda i: F.coalesce(F.nullif(F.get(target, i), F.lit("")), F.lit("UNKNOWN"))
    return _layout(outcomes.select("*", *source_columns()), _common(run_date, env, partition_dt, loaded_at, module_id, module_type) | {
        "source_databs_nm": F.col("source_dataset"), "source_table_nm": F.col("source_table_name"),
        "target_databs_nm": part(1), "target_table_nm": part(2),
        "source_vl": F.lit("0"), "target_vl": F.when(ok, "0").otherwise("1"),
        "clcltn_ds": F.when(ok, "Success").otherwise("Failed"),
        "excldd_vl": F.when(ok, "0").otherwise("1"),
        "excldd_reason_tx": F.when(ok, WRITTEN_TEXT).when(F.col("error_message").isNull(), FAILED_TEXT)
                             .otherwise(F.concat(F.lit(FAILED_TEXT + " "), reason)),
        "rcncln_exact_pass_in": F.when(ok, "Passed").otherwise("Failed"),
        "source_system_id": F.col("metric_id"), "Job_Name": F.col("metric_name"),
    })


def failure_rows(defs: DataFrame, message: str | Column, run_date: str, env: str, partition_dt: dt.date,
                 loaded_at: dt.datetime, run_category: str | None = None,
                 module_id: str = MODULE_ID, module_type: str = MODULE_TYPE) -> DataFrame:
    """Rows for metrics whose own row could not be built; ``message`` is a text or a column of ``defs``.

    With ``run_category`` the whole run failed and the text says so.
    """
    text = message if isinstance(message, Column) else F.lit(message)
    start = f"[{run_category}] Pipeline failed: " if run_category else "Recon record creation failed: "
    reason = F.concat(F.lit(FALLBACK_TEXT), format_error(F.concat(F.lit(start), text), F.lit("RECON_CREATION_ERROR")))
    unknown = F.lit("UNKNOWN")
    return _layout(defs, _common(run_date, env, partition_dt, loaded_at, module_id, module_type) | {
        "source_databs_nm": unknown, "source_table_nm": unknown,
        "target_databs_nm": unknown, "target_table_nm": unknown,
        "source_vl": F.lit("1"), "target_vl": F.lit("1"), "clcltn_ds": F.lit("Failed"),
        "excldd_vl": F.lit("1"), "excldd_reason_tx": reason, "rcncln_exact_pass_in": F.lit("Failed"),
        "source_system_id": F.coalesce("metric_id", unknown), "Job_Name": F.coalesce("metric_name", unknown),
    })


def status_counts(recon: DataFrame, day: dt.date | None = None, status: str = "rcncln_exact_pass_in",
                  day_column: str = "schdld_dt") -> DataFrame:
    """Rows per status, of one day or of all."""
    rows = recon if day is None else recon.where(F.col(day_column) == F.lit(day))
    return rows.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def failed_list(recon: DataFrame, day: dt.date, columns: Sequence[str] = ("source_system_id", "Job_Name", "excldd_reason_tx"),
                failed: str | Column = "rcncln_exact_pass_in = 'Failed'", day_column: str = "schdld_dt") -> DataFrame:
    """Id, name and reason of the failed rows of a day."""
    return recon.where(F.col(day_column) == F.lit(day)).where(failed).select(*columns)


def recent(recon: DataFrame, n: int | None = None, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Rows from newest to oldest load; the sort is spread over range partitions."""
    rows = recon.orderBy(*(order or [F.desc("load_ts")]))
    return rows if n is None else rows.limit(n)


def health(recon: DataFrame, groups: Sequence[str | Column] = ("schdld_dt",),
           passed: str | Column = "rcncln_exact_pass_in = 'Passed'") -> DataFrame:
    """Success rate per group and its alert level.

    critical above 50 % failures, warning above 20 %, below_target under 95 % success, else ok.
    """
    good = F.expr(passed) if isinstance(passed, str) else passed
    rated = recon.groupBy(*groups).agg(F.count(F.lit(1)).alias("total"), F.count_if(good).alias("passed"))
    success = F.col("passed") / F.col("total")
    alert = (F.when(1 - success > 0.5, "critical").when(1 - success > 0.2, "warning")
             .when(success < 0.95, "below_target").otherwise("ok"))
    return rated.select("*", F.round(success * 100, 2).alias("success_rate"), alert.alias("alert"))


def run_stats(outcomes: DataFrame, changes: DataFrame) -> DataFrame:
    """Per target: processed, written, failed, overwritten and new metrics.

    ``changes`` has one row per written metric with ``change`` (overwritten or new).
    """
    change = changes.groupBy("metric_id").agg(F.max("change").alias("change"))
    ok = F.col("is_success")
    return (outcomes.join(change, "metric_id", "left").groupBy(F.trim("target_table").alias("target_table")).agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(ok).alias("written"), F.count_if(~ok).alias("failed"),
        F.count_if(ok & (F.col("change") == "overwritten")).alias("overwritten"),
        F.count_if(ok & (F.col("change") == "new")).alias("new")))
