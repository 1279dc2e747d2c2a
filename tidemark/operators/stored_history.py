"""Type 2 history kept in a table that grows by changes only, loaded one partition date after the other.

The table holds a row per version start and, in full mode, a row that marks a key as gone. It is bucketed by the
business key: the current state of all keys and their versions come from it without a shuffle, and a day's snapshot is the only
thing dealt out to meet it. A load appends the keys that changed and rewrites nothing.
"""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scd2 import OPEN_END, _tracked, one_per_key

START, GONE = "effective_start_date", "__gone"
BUCKETS = 64


def _state(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys``, ``old`` values and whether the key is gone, as of the last load."""
    tracked = [c for c in stored.columns if c not in (*keys, START, GONE)]
    last = stored.groupBy(*keys).agg(F.max_by(F.struct(F.struct(*tracked).alias("v"), GONE), START).alias("__last"))
    return last.select(*keys, F.col("__last.v").alias("__old"), F.col(f"__last.{GONE}").alias(GONE))


def changed_keys(stored: DataFrame, snapshot: DataFrame, keys: Sequence[str], mode: str = "delta") -> DataFrame:
    """``keys``, ``v`` and the gone mark of every key whose version the snapshot (``keys``, ``v``) ends or starts."""
    joined = _state(stored, keys).join(snapshot.withColumn("__here", F.lit(True)), list(keys), "full" if mode == "full" else "right")
    missing = F.col("__here").isNull()
    ends = missing & ~F.col(GONE)
    starts = ~missing & (F.coalesce(F.col(GONE), F.lit(True)) | ~F.col("v").eqNullSafe(F.col("__old")))
    return joined.where(ends | starts).select(*keys, "v", missing.alias(GONE))


def load_day(spark: SparkSession, place: str, snapshots: DataFrame, keys: Sequence[str], date: dt.date, day: str = "partition_dt",
             tracked: Sequence[str] | None = None, order: Sequence[str] = (), mode: str = "delta", buckets: int = BUCKETS) -> None:
    """Load the snapshot of ``date`` into the catalog table ``place``, which is made when there is none.

    In ``full`` mode keys that the snapshot lacks are closed. Dates must ascend; loading the last one again changes nothing when it is
    the same, and an earlier one is refused, as is a NULL key. Of rows that repeat a key the greatest by ``order`` counts.
    """
    if mode not in ("full", "delta"):
        raise ValueError(f"mode must be 'full' or 'delta', not {mode!r}")
    tracked = list(tracked or _tracked(snapshots, [*keys, day], ()))
    rows = one_per_key(snapshots.where(F.col(day) == F.lit(date)).select(*keys, *tracked), keys, order)
    new = rows.select(*keys, F.struct(*tracked).alias("v"))
    nulls = new.where(" OR ".join(f"`{k}` IS NULL" for k in keys))
    if not nulls.isEmpty():
        raise ValueError("a business key is NULL")
    if spark.catalog.tableExists(place):
        stored = spark.table(place)
        last = stored.agg(F.max(START)).first()[0]
        if last is not None and date < last:
            raise ValueError(f"{date} is before the last loaded date {last}")
        changed = changed_keys(stored, new, keys, mode)
    else:
        changed = new.withColumn(GONE, F.lit(False))
    written = changed.select(*keys, "v.*", GONE, F.lit(date).alias(START)).repartition(buckets, *keys)
    written.write.format("parquet").mode("append").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(place)


def read_history(spark: SparkSession, place: str, keys: Sequence[str]) -> DataFrame:
    """Versions with effective dates, as ``build_history`` makes them from all snapshots at once."""
    by_key = Window.partitionBy(*keys).orderBy(START)
    stored = spark.table(place)
    tracked = [c for c in stored.columns if c not in (*keys, START, GONE)]
    told = stored.withColumn("__next", F.lead(START).over(by_key)).withColumn("version", F.count_if(~F.col(GONE)).over(by_key).cast("int"))
    return told.where(~F.col(GONE)).select(*keys, *tracked, START, F.coalesce(F.date_sub("__next", 1), F.lit(OPEN_END)).alias("effective_end_date"),
                                           "version", F.col("__next").isNull().alias("is_current"))
