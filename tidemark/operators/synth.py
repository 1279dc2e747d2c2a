"""Repeatable synthetic tables: every value is a hash of seed, row number and column name.

Rows need no shared counter and no driver loop, and come out the same under any partitioning.
"""

import datetime as dt
import math
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint
from ..sources.ddl import schema_from_ddl
from .rules import orphans

ROW = "__row"
#: Rows a task makes at most, so that tasks grow in number and not in length.
_TASK_ROWS = 1 << 19

# Name patterns that hint at the kind of value, and small value sets.
_HINTS = [
    ("email", r"email"), ("phone", r"phone"), ("percent", r"(_pct|rate|ratio)$"),
    ("status", r"status"), ("flag", r"(^is_|^has_|flag)"),
    ("country", r"country"), ("currency", r"currency"),
]
_STATUS = ["ACTIVE", "INACTIVE", "PENDING"]
_COUNTRIES = ["GB", "IN", "US", "DE", "FR"]
_CURRENCIES = ["GBP", "INR", "USD", "EUR"]


def _numbered(spark: SparkSession, n: int) -> DataFrame:
    """``n`` row numbers; what is drawn from them does not depend on the partitions."""
    parts = max(spark.sparkContext.defaultParallelism, -(-n // _TASK_ROWS))
    return spark.range(0, n, 1, parts).withColumnRenamed("id", ROW)


def _hash(seed: int, name: str) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(name), F.col(ROW))


def _pick(h: Column, values: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(h, F.lit(len(values))) + 1).cast("int"))


def _kind(name: str) -> str | None:
    return next((kind for kind, pattern in _HINTS if re.search(pattern, name.lower())), None)


def _value(field: T.StructField, seed: int, day: dt.date) -> Column:
    h, kind, t = _hash(seed, field.name), _kind(field.name), field.dataType
    if isinstance(t, T.LongType):
        low, high = (0, 1) if kind == "flag" else (0, 100) if kind == "percent" else (100, 1000)
        return F.pmod(h, F.lit(high - low + 1)) + low
    if isinstance(t, (T.DoubleType, T.DecimalType)):
        low, high = (0, 10000) if kind == "percent" else (1000, 100000)
        return F.round((F.pmod(h, F.lit(high - low + 1)) + low) / 100.0, 2).cast(t)
    if isinstance(t, T.BooleanType):
        return F.pmod(h, F.lit(2)) == 0
    if isinstance(t, T.DateType):
        return F.lit(day)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(dt.datetime.combine(day, dt.time())).cast(t)
    if isinstance(t, T.BinaryType):
        return F.encode(F.hex(h), "utf-8")
    if isinstance(t, T.ArrayType):
        return F.array(_value(T.StructField(field.name, t.elementType), seed, day))
    if isinstance(t, T.StructType):
        return F.struct(*[_value(T.StructField(f.name, f.dataType), seed, day).alias(f.name) for f in t])
    text = F.lower(F.hex(h))
    if kind == "email":
        return F.concat(F.substring(text, 1, 10), F.lit("@example.com"))
    if kind == "phone":
        return F.concat(F.lit("+44"), F.lpad(F.pmod(h, F.lit(10 ** 10)).cast("string"), 10, "0"))
    if kind == "status":
        return _pick(h, _STATUS)
    if kind == "country":
        return _pick(h, _COUNTRIES)
    if kind == "currency":
        return _pick(h, _CURRENCIES)
    if kind == "flag":
        return F.when(F.pmod(h, F.lit(2)) == 0, "Y").otherwise("N")
    return F.substring(text, 1, 10)


def _key(field: T.StructField, start: int) -> Column:
    number = F.col(ROW) + start
    return number if isinstance(field.dataType, T.LongType) else F.concat(F.lit("PK"), number.cast("string"))


def _fill(rows: DataFrame, ddl: Sequence[Mapping], seed: int, key: str | None, day: dt.date,
          defaults: Mapping[str, object], null_rate: float, given: Sequence[str], start: int) -> DataFrame:
    """``rows`` (with a row number and the ``given`` columns) with all columns of the schema."""
    columns = []
    for f in schema_from_ddl(ddl):
        if f.name in given:
            value = F.col(f.name).cast(f.dataType)
        elif f.name == key:
            value = _key(f, start).cast(f.dataType)
        elif f.name == "partition_dt":
            value = F.lit(day).cast(f.dataType)
        elif f.name in defaults:
            value = F.lit(str(defaults[f.name])).try_cast(f.dataType)
        else:
            value = _value(f, seed, day).cast(f.dataType)
            if f.nullable and null_rate > 0:
                chance = F.pmod(_hash(seed, f.name + "/null"), F.lit(10000))
                value = F.when(chance >= int(null_rate * 10000), value)
        columns.append(value.alias(f.name))
    return rows.select(ROW, *columns)


def synth_table(spark: SparkSession, ddl: Sequence[Mapping], n: int, seed: int = 0, key: str | None = None,
                day: dt.date = dt.date(2024, 1, 1), defaults: Mapping[str, object] | None = None,
                null_rate: float = 0.0, start: int = 1, keep_row: bool = False) -> DataFrame:
    """``n`` rows of a schema. ``key`` is sequential (``PK<n>`` when it is text).

    ``null_rate`` empties that share of each nullable column; REQUIRED columns, keys and defaults
    never are. ``keep_row`` keeps the row number ``__row``, which children draw on.
    """
    rows = _numbered(spark, n)
    table = _fill(rows, ddl, seed, key, day, defaults or {}, null_rate, (), start)
    return table if keep_row else table.drop(ROW)


def dense_index(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a gapless ``__row`` from 0, without sorting everything in one task.

    Rows are numbered inside range partitions of ``key``; the first number of each partition is a
    sum over the per-partition counts, one row per partition. The partitioned rows are checkpointed
    so both reads see the same partitions.
    """
    placed = checkpoint(df.repartitionByRange(F.col(key)).sortWithinPartitions(key)
                        .withColumn("__part", F.spark_partition_id()))
    local = placed.withColumn("__id", F.monotonically_increasing_id())
    sizes = local.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("first"))
    # a running sum over one row per partition
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    joined = local.join(F.broadcast(offsets), "__part")
    return joined.select(*df.columns, (F.col("__id") - F.col("first") + F.col("offset")).alias(ROW))


def synth_children(parents: Mapping[str, tuple[DataFrame, str]], ddl: Sequence[Mapping], n: int, seed: int = 0,
                   key: str | None = None, day: dt.date = dt.date(2024, 1, 1),
                   defaults: Mapping[str, object] | None = None, null_rate: float = 0.0, start: int = 1,
                   keep_row: bool = False, spark: SparkSession | None = None) -> DataFrame:
    """``n`` rows whose foreign keys come from parent values.

    ``parents`` maps a child column to a parent table and its column. A parent has zero to many
    children. Draws are spread evenly by hash, so no parent value is hot.
    """
    rows = _numbered(spark or SparkSession.active(), n)
    for column, (parent, parent_key) in parents.items():
        pool = parent.select(F.col(parent_key).alias(column)).where(F.col(column).isNotNull()).distinct()
        indexed = dense_index(pool, column).withColumnRenamed(ROW, "__draw")
        size = indexed.count()
        if not size:
            raise ValueError(f"no parent value for {column!r}")
        rows = rows.withColumn("__draw", F.pmod(_hash(seed, column), F.lit(size))).join(indexed, "__draw").drop("__draw")
    table = _fill(rows, ddl, seed, key, day, defaults or {}, null_rate, list(parents), start)
    return table if keep_row else table.drop(ROW)


def infer_fks(tables: Mapping[str, DataFrame], keys: Mapping[str, str],
              normalise: Callable[[str], str] = str.lower) -> DataFrame:
    """Column pairs with the same name as another table's key whose values are all contained in it.

    One plan tests all candidate pairs: distinct values per pair, without a parent, counted.
    """
    result = None
    for child, df in tables.items():
        for parent, key in keys.items():
            for column in df.columns:
                if child == parent or normalise(column) != normalise(key):
                    continue
                tested = orphans(df.where(F.col(column).isNotNull()), tables[parent], [column], [key]).select(
                    F.lit(child).alias("child"), F.lit(column).alias("child_column"),
                    F.lit(parent).alias("parent"), F.lit(key).alias("parent_key"), F.col("n").alias("orphans"))
                result = tested if result is None else result.unionByName(tested)
    if result is None:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "child string, child_column string, parent string, parent_key string")
    return result.where("orphans = 0").drop("orphans")


@dataclass(frozen=True)
class ColumnProfile:
    """What values of a column are drawn from: a share of NULLs and either quantiles or frequent values with shares."""

    field: T.StructField
    null_rate: float
    quantiles: tuple[float, ...] = ()
    frequent: tuple[tuple[str, float], ...] = ()


def _number(field: T.StructField) -> Column | None:
    """A column as a number that quantiles are taken of: days of dates, microseconds of timestamps."""
    column, t = F.col("`" + field.name.replace("`", "``") + "`"), field.dataType
    if isinstance(t, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double") if isinstance(t, T.NumericType) else None


def profile(df: DataFrame, quantiles: int = 100, frequent: int = 200) -> list[ColumnProfile]:
    """Null rates, quantile sketches of numbers and dates, and frequent values of the others, from one scan.

    Rows are dealt out evenly first: sketches cost far more than reading, and a file of few row groups is read by few tasks.
    What reaches the driver is one row of ``quantiles`` + 1 numbers or ``frequent`` values per column. Sketches merge
    before the shuffle; their rank error is a tenth of the distance of two quantiles. Values that are not among the
    frequent ones of a text column (more distinct than ``frequent``, such as names) are drawn freely instead. Columns
    of nested types are drawn freely too, with their null rate.
    """
    marks, asked = [i / quantiles for i in range(quantiles + 1)], [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(df.schema):
        column, number = F.col("`" + f.name.replace("`", "``") + "`"), _number(f)
        asked.append(F.count(column).alias(f"c{i}"))
        if number is not None:
            number = F.when(~F.isnan(number), number)
            asked.append(F.percentile_approx(number, marks, 10 * quantiles).alias(f"q{i}"))
            asked += [F.min(number).alias(f"low{i}"), F.max(number).alias(f"high{i}")]
        elif isinstance(f.dataType, (T.StringType, T.BooleanType)):
            quoted = f.name.replace("`", "``")
            asked.append(F.expr(f"approx_top_k(CAST(`{quoted}` AS STRING), {frequent}, {20 * frequent})").alias(f"t{i}"))
    found = df.hint("rebalance").agg(*asked).first()
    profiles = []
    for i, f in enumerate(df.schema):
        filled = found[f"c{i}"]
        cuts = found[f"q{i}"] if _number(f) is not None else None
        cuts = (found[f"low{i}"], *cuts[1:-1], found[f"high{i}"]) if cuts else ()
        top = found[f"t{i}"] if f"t{i}" in found else None
        shares = tuple((row["item"], row["count"] / filled) for row in top or [] if row["item"] is not None)
        profiles.append(ColumnProfile(f, 1 - filled / found["n"] if found["n"] else 0.0, tuple(cuts), shares))
    return profiles


def exact_quantiles(df: DataFrame, value: Column, marks: Sequence[float]) -> list[float] | None:
    """The quantiles ``percentile`` gives, interpolated between neighbours, of values no task sees all of.

    Values are counted, the distinct ones range-partitioned, and ranks follow from one sum per range. Only the values
    at the asked ranks reach the driver. None without values.
    """
    distinct = df.select(value.cast("double").alias("v")).where("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    placed = checkpoint(distinct.repartitionByRange("v").withColumn("part", F.spark_partition_id()))
    sizes = placed.groupBy("part").agg(F.sum("n").alias("rows"))
    total = sizes.agg(F.sum("rows")).first()[0]
    if total is None:
        return None
    places = [mark * (total - 1) for mark in marks]
    ranks = sorted({rank for place in places for rank in (math.floor(place), math.ceil(place))})
    # a running sum over one row per range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"), "rows")
    asked = offsets.select("part", "offset", F.explode(F.lit(ranks).cast("array<bigint>")).alias("rank"), "rows").where("rank >= offset AND rank < offset + rows")
    ranges = asked.groupBy("part").agg(F.first("offset").alias("offset"), F.collect_list("rank").alias("ranks"))
    upto = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.join(F.broadcast(ranges), "part").withColumn("upto", F.col("offset") + F.sum("n").over(upto))
    met = summed.withColumn("rank", F.explode(F.filter("ranks", lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))))
    at = dict(met.select("rank", "v").collect())
    return [at[math.floor(p)] if p == math.floor(p) else (math.ceil(p) - p) * at[math.floor(p)] + (p - math.floor(p)) * at[math.ceil(p)] for p in places]


def _drawn(p: ColumnProfile, seed: int, day: dt.date) -> Column:
    """A value by inverse distribution function, repeatable per row."""
    f, t = p.field, p.field.dataType
    chance = F.pmod(_hash(seed, f.name + "/draw"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    if p.quantiles:
        cuts, steps = F.lit(list(p.quantiles)), len(p.quantiles) - 1
        place = (chance * steps).cast("int")
        low, high = F.get(cuts, place), F.get(cuts, place + 1)
        value = low + (high - low) * (chance * steps - place)
        if isinstance(t, T.DateType):
            return F.date_from_unix_date(F.round(value).cast("int"))
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            return F.timestamp_micros(F.round(value).cast("bigint")).cast(t)
        return (F.round(value) if isinstance(t, T.IntegralType) else value).cast(t)
    value = _value(f, seed, day).cast(t)
    if not p.frequent:
        return value
    total, bounds = 0.0, []
    for text, share in p.frequent:
        total += share
        bounds.append(F.struct(F.lit(total).alias("upto"), F.lit(text).alias("text")))
    # rounding of shares that sum to all rows must leave no gap at the end
    whole = F.lit(total) if abs(total - 1) < 1e-9 else F.lit(1.0)
    met = F.filter(F.array(*bounds), lambda b: b["upto"] > chance * whole)
    return F.coalesce(F.get(met, 0)["text"].cast(t), value)


def synth_like(spark: SparkSession, profiles: Sequence[ColumnProfile], n: int, seed: int = 0, key: str | None = None,
               day: dt.date = dt.date(2024, 1, 1), start: int = 1) -> DataFrame:
    """``n`` rows that follow the profile of a table, column by column; ``key`` is sequential.

    Quantile bounds, null rates and shares of frequent values are those of the given table; columns are independent of
    each other. Every value is a function of seed, column and row number, so a repeated task makes the same rows.
    """
    rows = _numbered(spark, n)
    columns = []
    for p in profiles:
        if p.field.name == key:
            value = _key(p.field, start).cast(p.field.dataType)
        else:
            gone = F.pmod(_hash(seed, p.field.name + "/null"), F.lit(1 << 30)) < F.lit(round(p.null_rate * (1 << 30)))
            value = F.when(~gone, _drawn(p, seed, day))
        columns.append(value.alias(p.field.name))
    return rows.select(*columns)
