"""Partition information from what Spark knows of a table's partitions, instead of from its rows."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import SourceError
from ..functions.dates import strict_date

_LAYOUT = "project_dataset string, table_name string, partition_dt date"


def _named(df: DataFrame, name: str) -> DataFrame:
    dataset, _, table = name.rpartition(".")
    return df.select(F.lit(dataset).alias("project_dataset"), F.lit(table).alias("table_name"), "partition_dt")


def _from_catalog(spark: SparkSession, place: str, column: str) -> DataFrame:
    """Partition dates of a catalog table by the catalog's own list, which holds escaped ``name=value`` parts."""
    if column.lower() not in [c.name.lower() for c in spark.catalog.listColumns(place) if c.isPartition]:
        raise SourceError(f"{place} is not partitioned by {column}")
    listed = spark.sql(f"SHOW PARTITIONS {place}")
    part = F.filter(F.split("partition", "/"), lambda p: F.lower(F.substring_index(p, "=", 1)) == column.lower())[0]
    # dates need no escapes; what is no date (the NULL partition, say) is none
    return listed.select(strict_date(F.substring_index(part, "=", -1)).alias("partition_dt")).where("partition_dt IS NOT NULL")


def _from_files(df: DataFrame, column: str) -> DataFrame:
    """Partition dates of a folder table: the column comes from folder names, so files are opened for row counts only."""
    value = F.col(column)
    day = strict_date(value) if dict(df.dtypes)[column] == "string" else value.cast("date")
    # reduced per task, so a row per partition and task is shuffled
    return df.select(day.alias("partition_dt")).where("partition_dt IS NOT NULL").distinct()


def partition_info(spark: SparkSession, tables: Mapping[str, DataFrame | str], column: str = "partition_dt") -> DataFrame:
    """One row per table and partition date, the form ``partition_info`` takes everywhere.

    ``tables`` maps ``project.dataset.table`` to the name of a catalog table, whose partitions the catalog lists
    without a look at its files, or to a DataFrame, of which only the partition column is read: with
    a folder partitioned by it no data column. Dates that are none are left out; partitions a catalog lists count
    even when they hold no rows.
    """
    parts = [_named(_from_catalog(spark, source, column) if isinstance(source, str) else _from_files(source, column), name)
             for name, source in tables.items()]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _LAYOUT)
