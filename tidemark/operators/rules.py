"""Data-quality rules as columns and aggregates."""

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import equi_join, keyed_count


def rule_not_null(c: Column) -> Column:
    """TRUE for a value, FALSE for NULL."""
    return c.isNotNull()


def rule_not_blank(c: Column) -> Column:
    """FALSE for empty or whitespace-only text; NULL stays NULL."""
    return ~c.rlike(r"^\s*$")


def rule_regex(c: Column, pattern: str) -> Column:
    """TRUE where the pattern is found (anchor it to match whole values)."""
    return c.rlike(pattern)


def rule_range(c: Column, low=None, high=None) -> Column:
    """TRUE inside the inclusive bounds; None leaves a side open."""
    if low is None and high is None:
        return F.when(c.isNotNull(), F.lit(True))
    # plain comparisons are NULL for a NULL value, and compile far tighter than a CASE
    if high is None:
        return c >= F.lit(low)
    if low is None:
        return c <= F.lit(high)
    return (c >= F.lit(low)) & (c <= F.lit(high))


def rule_expr(sql: str, column: str) -> Column:
    """A boolean Spark SQL expression with ``$column`` standing for the bound column."""
    return F.expr(sql.replace("$column", f"`{column}`"))


def dup_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once (``n``)."""
    return keyed_count(df, keys).where("n > 1").agg(F.count(F.lit(1)).alias("n"))


def dup_key_sets(df: DataFrame, key_sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """``key_set`` and ``n``, the number of keys that occur more than once, for each named set of key columns.

    All sets share one scan and one shuffle: rows are counted by grouping sets, and the grouping number tells
    a NULL key from a column outside a set. NULLs are keys like any other.
    """
    columns = list(dict.fromkeys(c for keys in key_sets.values() for c in keys))
    sets = {frozenset(keys): list(keys) for keys in key_sets.values()}
    number = {own: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in own) for own in sets}
    if len(columns) > 63:
        raise ValueError("at most 63 key columns")
    rows = df.select(*columns)
    counted = rows.groupingSets(list(sets.values()), *columns).agg(F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set"))
    found = counted.groupBy("__set").agg(F.count_if(F.col("__n") > 1).alias("n"))
    names = df.sparkSession.createDataFrame([(name, number[frozenset(keys)]) for name, keys in key_sets.items()], "key_set string, __set bigint")
    return names.join(found, "__set", "left").select("key_set", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str],
            parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Number of child rows without a parent (``n``); a NULL key has none.

    Child rows are counted per key before the join, so the join sees each key once.
    """
    parents = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_keys or keys, keys)]).distinct()
    alone = keyed_count(child, keys).join(parents, list(keys), "left_anti")
    return alone.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def orphan_rows(child: DataFrame, parent: DataFrame, keys: Sequence[str],
                parent_keys: Sequence[str] | None = None) -> DataFrame:
    """The child rows themselves."""
    parents = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_keys or keys, keys)])
    return equi_join(child, parents, keys, "left_anti")


def stale_flag(ts: Column, as_of: dt.date, empty_is_stale: bool = False) -> Column:
    """1 when the latest day is before ``as_of``; an empty table counts as fresh by default."""
    late = F.max(F.to_date(ts)) < F.lit(as_of)
    return F.when(F.coalesce(late, F.lit(empty_is_stale)), 1).otherwise(0)


def is_stale(df: DataFrame, ts: str, as_of: dt.date, empty_is_stale: bool = False) -> DataFrame:
    """Freshness of a table as one row ``n``."""
    return df.agg(stale_flag(F.col(ts), as_of, empty_is_stale).alias("n"))


def _on_day(ts: Column, day: dt.date) -> Column:
    # a range on the raw column, so that it can reach the scan
    return (ts >= F.lit(day)) & (ts < F.lit(day + dt.timedelta(days=1)))


def drop_flag(condition: Column, ts: Column, as_of: dt.date, days: int = 7, floor: float = 0.8) -> Column:
    """1 when rows of ``as_of`` are below ``floor`` of those ``days`` before; no prior rows is fine."""
    now = F.count_if(condition & _on_day(ts, as_of))
    before = F.count_if(condition & _on_day(ts, as_of - dt.timedelta(days=days)))
    return F.when((before > 0) & (now / F.nullif(before, F.lit(0)) < F.lit(floor)), 1).otherwise(0)


def volume_drop(df: DataFrame, condition: str, ts: str, as_of: dt.date, days: int = 7,
                floor: float = 0.8) -> DataFrame:
    """The drop check as one row ``n``; only the two days are read."""
    c = F.col(ts)
    days_read = df.where(_on_day(c, as_of) | _on_day(c, as_of - dt.timedelta(days=days)))
    return days_read.agg(drop_flag(F.expr(condition), c, as_of, days, floor).alias("n"))


def below_min_rows(df: DataFrame, least: int = 100) -> DataFrame:
    """1 when the table has fewer rows than ``least``."""
    return df.agg(min_rows_flag(least).alias("n"))


def min_rows_flag(least: int = 100) -> Column:
    return F.when(F.count(F.lit(1)) < least, 1).otherwise(0)


def rule_statement(spark, sql: str, table: DataFrame) -> DataFrame:
    """A query with ``$table`` standing for the checked table; its first column is the failing count."""
    view = f"tidemark_checked_{uuid.uuid4().hex}"
    table.createOrReplaceTempView(view)
    try:
        result = spark.sql(sql.replace("$table", view))
    finally:
        spark.catalog.dropTempView(view)
    return result.select(F.col(f"`{result.columns[0]}`").cast("bigint").alias("n"))
