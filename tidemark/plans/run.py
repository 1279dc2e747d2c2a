"""A whole metrics run: read, validate, bind, compute, write by key, and reconcile."""

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import JOB_ERRORS, SourceError, first_line
from ..operators import partitions as P
from ..operators import recon as R
from ..operators import upsert as U
from ..operators import validate as V
from ..operators.align import align
from ..session import checkpoint, scratch_folder
from ..sources.definitions import read_metric_defs
from ..sources.tables import append, routed
from .columns import ColumnMap
from .metrics import QUERY_TIMEOUT_SECONDS, run_metrics


RECON_PARTITION = ["schdld_dt"]


@dataclass(frozen=True)
class RunReport:
    """What a run leaves: results, failures, reconciliation rows, key changes and counts per target."""

    results: DataFrame
    failures: DataFrame
    recon: DataFrame
    changes: DataFrame
    stats: DataFrame


def run_definitions(spark: SparkSession, defs_path: str, partition_info: DataFrame, run_date: str,
                    dependencies: str | Sequence[str], tables: Mapping[str, DataFrame],
                    targets: Mapping[str, str], recon_target: str, env: str,
                    partition_dt: dt.date | None = None, executed_at: dt.datetime | None = None,
                    columns: ColumnMap | None = None, positional: bool = False, strict: bool = False,
                    lookback_days: int | None = None,
                    timeout: float | None = QUERY_TIMEOUT_SECONDS, all_or_nothing: bool = False,
                    undo: str | None = None) -> RunReport:
    """Run the definitions of ``dependencies`` and write results and reconciliation rows.

    ``tables`` gives the source tables by ``project.dataset.table``, ``targets`` the place of each
    target table (a parquet folder or a catalog table). A failing metric or target does not stop the others,
    unless ``all_or_nothing``, with which a target that cannot be written fails the run.
    When validation or the run itself fails after the definitions are read, the targets are put back to what they
    were, a failure row per definition (per requested one, once validation has passed) is written and the error is
    raised again. ``undo`` is a new shared folder for the rows that are overwritten, by default one next to the
    checkpoints; with it ``undo_run`` can put the targets back after the driver was lost. Reconciliation
    rows are partitioned by ``schdld_dt``, so that reports of a day read that day.
    """
    day = V.check_run_date(run_date)
    wanted = V.parse_dependencies(dependencies) if isinstance(dependencies, str) else list(dependencies)
    partition_dt = partition_dt or day
    executed_at = executed_at or dt.datetime.now(dt.timezone.utc)
    P.require_partition_columns(partition_info)
    defs = read_metric_defs(spark, defs_path)
    chosen, category = defs, "PIPELINE_VALIDATION_ERROR"
    undo = undo or scratch_folder(spark, "undo")
    if any(U.holds_undo(spark, f"{undo}/{number}") for number in range(len(targets))):
        raise SourceError(f"{undo} holds the rows of another run")
    try:
        V.raise_on_error(V.validate(defs, positional))
        V.require_dependencies(defs, wanted)
        chosen = V.filter_dependencies(defs, wanted, required=True)
        category = "PIPELINE_EXECUTION_ERROR"
        latest = _latest(partition_info, chosen, day, lookback_days)
        results, failures = run_metrics(spark, chosen, day, latest, tables, partition_dt, executed_at,
                                        columns, positional, strict, timeout=timeout)
        written, changes, unwritten = _write(spark, results, targets, partition_dt.isoformat(), undo, all_or_nothing)
        outcomes = checkpoint(R.classify(chosen, written, failures, unwritten))
        recon = checkpoint(_reconcile(outcomes, failures, run_date, env, partition_dt, executed_at))
        append(recon, recon_target, RECON_PARTITION)
    except Exception as error:
        standing = "".join(f"; rows of the run may stand in {target}: {why}" for target, why in undo_run(spark, targets, undo).items())
        if standing:
            error.add_note(standing[2:])
        try:
            append(R.failure_rows(chosen, str(error) + standing, run_date, env, partition_dt, executed_at, category), recon_target, RECON_PARTITION)
        except Exception as second:  # the first error is the one to report
            error.add_note(f"the failure rows could not be written either: {second}")
        raise
    return RunReport(results, failures, recon, changes, R.run_stats(outcomes, changes))


def undo_run(spark: SparkSession, targets: Mapping[str, str], undo: str) -> dict[str, str]:
    """Put all targets back to what they were before the run that kept ``undo``; the reason per target where that failed."""
    failed = {}
    for number, (target, path) in enumerate(targets.items()):
        try:
            U.restore(spark, path, f"{undo}/{number}")
        except JOB_ERRORS as error:
            failed[target] = first_line(error)
    return failed


def _latest(info: DataFrame, defs: DataFrame, day: dt.date, lookback_days: int | None) -> DataFrame:
    """Latest dates of all referenced tables in one pass, by dataset or project and dataset."""
    refs = P.distinct_refs(defs)
    both = refs.select(F.explode(F.array(
        F.col("dataset"), F.concat_ws(".", "project", "dataset"))).alias("project_dataset"), "table_name")
    return P.latest_partitions(info, both, day if lookback_days is not None else None, lookback_days)


def _reconcile(outcomes: DataFrame, failures: DataFrame, run_date: str, env: str, partition_dt: dt.date,
               executed_at: dt.datetime) -> DataFrame:
    """One row per metric; a metric without dates has no resolved source, so it gets a failure row."""
    unbound = failures.where("stage = 'bind'").select("metric_id")
    rows = R.recon_rows(outcomes.join(unbound, "metric_id", "left_anti"), run_date, env, partition_dt, executed_at)
    broken = outcomes.join(unbound, "metric_id", "left_semi")
    return rows.unionByName(R.failure_rows(broken, F.col("error_message"), run_date, env, partition_dt, executed_at))


def _write(spark: SparkSession, results: DataFrame, targets: Mapping[str, str], day: str, undo: str,
           all_or_nothing: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written ids with their target, their key changes, and an error per id that was not written."""
    failures, changed, filled = [], [], routed(results, targets)
    for number, (target, path) in enumerate(targets.items()):
        if target not in filled:
            continue
        rows = results.where(F.col("target_table") == target).drop("target_table")
        try:
            existing = U.read_partitioned(spark, path, "partition_dt", rows)
            fitted = rows if existing is None else align(rows, existing.schema, missing="null")
            changes = U.overwrite_partitions(spark, path, fitted, day=day, undo=f"{undo}/{number}")
            if changes is not None:
                changed.append(changes.withColumn("target_table", F.lit(target)))
        except JOB_ERRORS as error:
            if all_or_nothing:
                raise
            failures.append(rows.select("metric_id", F.lit(str(error)).alias("error_message")))
    unrouted = results.where(~F.col("target_table").isin(list(targets)))
    failures.append(unrouted.select("metric_id", F.concat(
        F.lit("no place is given for target table "), F.col("target_table")).alias("error_message")))
    changes = reduce(DataFrame.unionByName, changed) if changed else spark.createDataFrame(
        [], "metric_id string, partition_dt string, change string, target_table string")
    return changes.select("metric_id", "target_table"), changes, reduce(DataFrame.unionByName, failures)
