"""Partitioned tables: scan one partition, append, and write to several targets."""

import datetime as dt
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import JOB_ERRORS
from ..session import scratch_folder


def read_partition(source: DataFrame | str, day: dt.date | None, column: str = "partition_dt",
                   spark: SparkSession | None = None) -> DataFrame:
    """The slice of a table for one partition date.

    The date is a typed literal, so it prunes partition folders or reaches the scan as a filter.
    """
    table = source
    if isinstance(source, str):
        table = (spark or SparkSession.active()).table(source)
    return table.where(F.col(column) == F.lit(day))


def append(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Append to a catalog table, or to a parquet folder when ``target`` is a path."""
    writer = df.write.mode("append").partitionBy(*partition_by)
    if "/" in target:
        writer.parquet(target)
    elif df.sparkSession.catalog.tableExists(target):
        df.writeTo(target).append()
    else:
        writer.saveAsTable(target)


def routed(df: DataFrame, routes: Mapping[str, str], target_column: str = "target_table") -> set[str]:
    """Targets of ``routes`` that have rows, by one job over all of them."""
    return {r[0] for r in df.where(F.col(target_column).isin(list(routes))).select(target_column).distinct().collect()}


def write_targets(df: DataFrame, routes: Mapping[str, str], partition_by: Sequence[str] = (),
                  target_column: str = "target_table", write=append) -> tuple[list[str], dict[str, str]]:
    """Write the rows of each target to its place; one failing target does not stop the others.

    ``routes`` maps the value of ``target_column`` to a table name or path. Returns the targets
    written and an error text per failed one. The rows should be materialised (a checkpointed
    metric result is), since each target filters them once. A target without rows counts as written and costs no
    job; it is not made when there is none.
    """
    written, failed, filled = [], {}, routed(df, routes, target_column)
    for target, place in routes.items():
        if target not in filled:
            written.append(target)
            continue
        rows = df.where(F.col(target_column) == target).drop(target_column)
        try:
            write(rows, place, partition_by)
            written.append(target)
        except JOB_ERRORS as error:
            failed[target] = str(error)
    return written, failed


def write_targets_staged(df: DataFrame, routes: Mapping[str, str], partition_by: Sequence[str] = (),
                         target_column: str = "target_table", piece_rows: int = 2_000_000) -> tuple[list[str], dict[str, str]]:
    """As ``write_targets``, for many targets: a count and a write of all rows, whatever the number of targets.

    Rows are written once to the shared scratch folder, apart by target, then their files are moved to the
    folders of the targets: work of the file system, not a job per target. A target is dealt to a task per
    ``piece_rows`` rows, so one with a third of all rows is split and a small one gives one file per partition. When a file cannot be moved, those of its target
    that were moved are taken back and the target is reported as failed; the others are written. A target is not
    published at once: readers may see some of its files before the last. Catalog tables, and folders on
    another file system than the scratch folder, are appended to one by one from the written rows.
    """
    spark, names = df.sparkSession, list(routes)
    stage, mark = scratch_folder(spark, "targets"), "__target"
    routed_rows = df.where(F.col(target_column).isin(names))
    sizes = dict(routed_rows.groupBy(target_column).count().collect())
    if not sizes:
        return names, {}
    pieces = [max(1, math.ceil(sizes.get(name, 0) / piece_rows)) for name in names]
    place_of = F.array_position(F.lit(names), F.col(target_column)).cast("int")
    numbered = (routed_rows.withColumn(mark, place_of).drop(target_column)
                .withColumn("__piece", F.pmod(F.monotonically_increasing_id(), F.get(F.lit(pieces), F.col(mark) - 1))))
    (numbered.repartition(sum(pieces), mark, "__piece").drop("__piece")
     .write.partitionBy(mark, *partition_by).parquet(stage))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    system = path(stage).getFileSystem(conf)
    written, failed = [], {}
    for number, (target, place) in enumerate(routes.items(), 1):
        source = path(f"{stage}/{mark}={number}")
        try:
            if target in sizes:
                if "/" in place and path(place).getFileSystem(conf).getUri().equals(system.getUri()):
                    _move_files(jvm, system, source, path(place))
                else:
                    append(spark.read.schema(df.drop(target_column).schema).parquet(source.toString()), place, partition_by)
            written.append(target)
        except (*JOB_ERRORS, OSError) as error:
            failed[target] = str(error)
    return written, failed


def _move_files(jvm, system, source, place) -> None:
    """Move what is below ``source`` to the same places below ``place``, or nothing. Folders that are new there move whole."""
    path, moved = jvm.org.apache.hadoop.fs.Path, []

    def move(old, new, is_folder):
        if is_folder and system.exists(new):
            for child in system.listStatus(old):
                move(child.getPath(), path(new, child.getPath().getName()), child.isDirectory())
        elif system.rename(old, new):
            moved.append((new, old))
        else:
            raise OSError(f"{old.toString()} could not be moved to {new.toString()}")

    try:
        system.mkdirs(place.getParent())
        move(source, place, True)
    except Exception:
        for new, old in moved:
            system.rename(new, old)
        raise
