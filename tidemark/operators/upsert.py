"""Overwrite, delete, roll back and restore rows by key within a partition."""

import datetime as dt
from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SourceError
from ..session import checkpoint, delete_folder

RESULT_KEYS = ("metric_id", "partition_dt")


def _keys_of(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    return incoming.select(*keys).distinct()


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys; NULL equals NULL."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def existing_keys(existing: DataFrame | None, incoming: DataFrame,
                  keys: Sequence[str] = RESULT_KEYS) -> DataFrame:
    """Keys of ``incoming`` that the table already holds; a table that does not exist holds none."""
    wanted = _keys_of(incoming, keys)
    if existing is None:
        return wanted.limit(0)
    # the side that is kept is distinct, so no key is hot in it
    known = existing.select(*keys).distinct()
    return wanted.join(known, _same(wanted, known, keys), "left_semi")


def classify_keys(existing: DataFrame | None, incoming: DataFrame,
                  keys: Sequence[str] = RESULT_KEYS) -> DataFrame:
    """One row per incoming key with ``change``: overwritten or new."""
    wanted = _keys_of(incoming, keys)
    if existing is None:
        return wanted.withColumn("change", F.lit("new"))
    known = existing.select(*keys).distinct().withColumn("__known", F.lit(True))
    change = F.when(F.col("__known"), "overwritten").otherwise("new")
    return wanted.join(known, _same(wanted, known, keys), "left").select(*[wanted[k] for k in keys], change.alias("change"))


def delete_by_key(existing: DataFrame, doomed: DataFrame, keys: Sequence[str] = RESULT_KEYS) -> DataFrame:
    """Rows of the table whose key is not in ``doomed``; a NULL key is a key like any other."""
    gone = _keys_of(doomed, keys)
    return existing.join(gone, _same(existing, gone, keys), "left_anti")


def overwrite_by_key(existing: DataFrame | None, incoming: DataFrame,
                     keys: Sequence[str] = RESULT_KEYS) -> DataFrame:
    """The table after the rows with an incoming key are replaced by the incoming rows.

    The table keeps all its columns: those the incoming rows lack are NULL in the new rows. A column
    the table does not have is an error.
    """
    if existing is None:
        return incoming
    unknown = [c for c in incoming.columns if c not in existing.columns]
    if unknown:
        raise SourceError(f"the table has no columns {unknown}")
    kept = delete_by_key(existing, incoming, keys)
    return kept.unionByName(incoming, allowMissingColumns=True).select(*existing.columns)


def overwrite_partitions(spark: SparkSession, place: str, incoming: DataFrame, keys: Sequence[str] = RESULT_KEYS,
                         partition: str = "partition_dt", day: object = None, undo: str | None = None) -> DataFrame | None:
    """Overwrite by key in a partitioned table and rewrite only the touched partitions.

    ``place`` is a parquet folder (it holds a slash) or a catalog table. ``day`` names the one partition
    of a run; without it the range of the incoming partitions is found first. Every scan of the table is
    limited to that range, and only partitions with incoming rows are rewritten. Returns the
    overwritten/new split per key, or None when there was nothing to write. The new partitions are written
    whole beside the table and swapped in when the job commits, so a task or executor that fails before
    that leaves the table as it was. ``incoming`` is read several times: materialise an expensive one.
    A NULL partition is refused, for its rows could not be told from others of the NULL partition.
    ``undo`` is a new shared folder that gets the former rows of the incoming keys before anything is
    written; ``restore`` puts the table back with them.
    """
    seen = incoming.agg(F.count(F.lit(1)).alias("rows"), F.count(partition).alias("dated"), F.min(partition).alias("low"),
                        F.max(partition).alias("high")).first()
    if not seen.rows:
        return None
    if seen.dated < seen.rows:
        raise SourceError(f"{seen.rows - seen.dated} rows have no {partition}")
    if day is not None and (seen.low != day or seen.high != day):
        raise SourceError(f"{partition} is {seen.low!r} to {seen.high!r}, not {day!r}")
    existing = read_partitioned(spark, place, partition, incoming)
    touched = None
    if existing is not None:
        # literals prune the scan; the join leaves out untouched partitions of the range
        touched = existing.where(F.col(partition).between(F.lit(seen.low), F.lit(seen.high)))
        if seen.low != seen.high:
            touched = touched.join(incoming.select(partition).distinct(), partition, "left_semi").select(*existing.columns)
    changes = checkpoint(classify_keys(touched, incoming, keys))
    if undo is not None:
        _keep_former(touched, incoming, changes, undo, keys, partition)
    _replace(spark, place, overwrite_by_key(touched, incoming, keys), [partition], existing is None)
    return changes


def replace_partitions(spark: SparkSession, place: str, rows: DataFrame, partitions: Sequence[str]) -> None:
    """Replace the partitions that ``rows`` hold; those without rows stay. ``place`` is made when there is none."""
    _replace(spark, place, rows, partitions, "/" not in place and not spark.catalog.tableExists(place))


def _replace(spark: SparkSession, place: str, rows: DataFrame, partitions: Sequence[str], create: bool) -> None:
    # one set of evenly sized files per partition, however the rows were made
    result = rows.hint("rebalance", *partitions)
    writer = result.write.mode("overwrite").format("parquet").option("partitionOverwriteMode", "dynamic")
    if "/" in place:
        writer.partitionBy(*partitions).save(place)
    elif create:
        writer.partitionBy(*partitions).saveAsTable(place)
    else:
        # by position: the partition columns come last in a table
        order = spark.table(place).columns
        with _dynamic_overwrite(spark):
            result.select(*order).write.mode("overwrite").insertInto(place)


def _keep_former(touched: DataFrame | None, incoming: DataFrame, changes: DataFrame, undo: str,
                 keys: Sequence[str], partition: str) -> None:
    """Former rows, partitions and keys of an overwrite; the keys come last and mark the rest as whole."""
    if touched is not None:
        former = touched.join(changes, _same(touched, changes, keys), "left_semi")
        former.write.parquet(f"{undo}/rows")
    incoming.select(partition).distinct().write.parquet(f"{undo}/partitions")
    changes.write.parquet(f"{undo}/keys")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet folder, or None when it is absent or holds no file."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def holds_undo(spark: SparkSession, undo: str) -> bool:
    """Whether an overwrite has kept its former rows in ``undo``."""
    return _read(spark, f"{undo}/keys") is not None


def restore(spark: SparkSession, place: str, undo: str, keys: Sequence[str] = RESULT_KEYS,
            partition: str = "partition_dt") -> bool:
    """Put a table back to what it was before the ``overwrite_partitions`` that kept ``undo``.

    Rows of the keys it wrote go and their former rows come back; rows of other keys stay, also those written
    since. Partitions left without rows are dropped, and a catalog table that the overwrite made goes when it is
    empty. Only the partitions of the overwrite are read and rewritten. May be repeated, and does no harm when
    the overwrite failed before its commit. False when ``undo`` was not finished, so that nothing was written.
    """
    changes = _read(spark, f"{undo}/keys")
    if changes is None:
        return False
    days, former = spark.read.parquet(f"{undo}/partitions"), _read(spark, f"{undo}/rows")
    current = read_partitioned(spark, place, partition, days)
    if current is None:
        if former is not None and not former.isEmpty():
            replace_partitions(spark, place, former, [partition])
        return True
    span = days.agg(F.min(partition).alias("low"), F.max(partition).alias("high")).first()
    ranged = current.where(F.col(partition).between(F.lit(span.low), F.lit(span.high)))
    touched = ranged.join(days, partition, "left_semi").select(*current.columns)
    result = delete_by_key(touched, changes, keys)
    if former is not None:
        result = result.unionByName(former, allowMissingColumns=True).select(*current.columns)
    emptied = checkpoint(days.join(result.select(partition).distinct(), partition, "left_anti"))
    # bounded by the partitions of the overwrite
    if "/" in place:
        files = ranged.select(partition, F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder"))
        gone = [r.folder for r in files.join(emptied, partition, "left_semi").select("folder").distinct().collect()]
    else:
        gone = [str(r[0]) for r in emptied.collect()]
    replace_partitions(spark, place, result, [partition])
    for name in gone:
        if "/" in place:
            delete_folder(spark, name)
        else:
            literal = name.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {place} DROP IF EXISTS PARTITION (`{partition}` = '{literal}')")
    if "/" not in place and former is None and spark.table(place).isEmpty():
        spark.sql(f"DROP TABLE {place}")
    return True


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """Replace only the partitions that are written; a table made elsewhere does not carry the option itself."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_partitioned(spark: SparkSession, place: str, partition: str, like: DataFrame) -> DataFrame | None:
    """The table at ``place``, or None when there is none yet.

    A partition folder name carries no type: it is read as that of ``like``, never guessed, so that
    texts such as ``01`` stay as they are.
    """
    kind = like.schema[partition].dataType
    if "/" not in place:
        if not spark.catalog.tableExists(place):
            return None
        table = spark.table(place)
        return table.withColumn(partition, F.col(partition).cast(kind))
    found = _read(spark, place)
    if found is None:
        return None
    fields = [T.StructField(f.name, kind if f.name == partition else f.dataType) for f in found.schema]
    return spark.read.schema(T.StructType(fields)).parquet(place)


def rollback(df: DataFrame, new_keys: DataFrame, now: dt.datetime, hours: int = 1,
             keys: Sequence[str] = RESULT_KEYS, written_at: str = "pipeline_execution_ts") -> DataFrame:
    """The table without the rows a failed run added.

    Only keys the run created go, and only rows written within the last ``hours``. Overwritten keys
    stay, as ``classify_keys`` reports; ``restore`` brings their former rows back.
    """
    recent = F.col(written_at) >= F.lit(now - dt.timedelta(hours=hours))
    doomed = new_keys.select(*keys).distinct().withColumn("__new", F.lit(True))
    # a fresh row of a new key goes; rows of other keys and older rows stay
    marked = df.join(doomed, list(keys), "left")
    return marked.where(F.col("__new").isNull() | ~F.coalesce(recent, F.lit(False))).select(*df.columns)
