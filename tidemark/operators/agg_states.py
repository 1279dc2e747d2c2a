"""Aggregate states kept per partition and merged, so that a run reads only partitions that are new or changed.

A state table has one row per partition with a state per measure (``state_set`` 0) and, for exact distinct counts,
a row per partition and distinct value (``state_set`` 1 and on, one set per value expression). Both are written by one job, which
replaces the states of the partitions it was given. With ``exact=False`` distinct counts are HyperLogLog
sketches in the one row, so that a merge reads rows per partition only.
"""

import hashlib
from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DefinitionError, SourceError
from .aggregates import Measure
from .upsert import replace_partitions

SET, MARK = "state_set", "state_of"
SKETCH_BITS = 14  # a relative error of about 0.65 %
_HASHED = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def _mark(measures: Sequence[Measure], exact: bool) -> str:
    """Tells states of unlike measures apart; a default is applied after the merge and does not count."""
    return hashlib.sha256(repr(([replace(m, default=None) for m in measures], exact)).encode()).hexdigest()[:16]


def _sets(measures: Sequence[Measure], exact: bool) -> list[tuple[str, list[Measure]]]:
    sets: dict[str, list[Measure]] = {}
    for m in measures:
        if m.is_distinct and exact:
            sets.setdefault(m.value, []).append(m)
    return list(sets.items())


def _check(measures: Sequence[Measure], partition: str) -> None:
    names = [m.name.lower() for m in measures]
    taken = {partition.lower(), SET, MARK}
    if len(set(names)) < len(names) or taken & set(names):
        raise DefinitionError(f"measures need names of their own, unlike {sorted(taken)}: {names}")


def _state(df: DataFrame, m: Measure) -> list[Column]:
    """State of one measure over the rows of a partition."""
    kind = m.kind.removesuffix("_if")
    if m.is_distinct or kind == "avg":
        value, of = F.expr(m.value), df.select(F.expr(m.value)).schema[0].dataType
        kept = value if m.rows is None else F.when(m.rows, value)
        if m.is_distinct:
            hashed = kept if isinstance(of, _HASHED) else kept.cast("string")
            return [F.hll_sketch_agg(hashed, F.lit(SKETCH_BITS)).alias(m.name)]
        summed = kept if isinstance(of, T.DecimalType) else kept.cast("double")
        return [F.avg(kept).alias(m.name), F.sum(summed).alias(f"{m.name}__sum"), F.count(kept).alias(f"{m.name}__n")]
    return [replace(m, default=None).column()]


def partition_states(df: DataFrame, measures: Sequence[Measure], partition: str, exact: bool = True) -> DataFrame:
    """States of every partition of ``df``; all measures but exact distinct counts come from one scan."""
    _check(measures, partition)
    sets = _sets(measures, exact)
    plain = [c for m in measures if not (m.is_distinct and exact) for c in _state(df, m)]
    states = df.groupBy(partition).agg(F.lit(_mark(measures, exact)).alias(MARK), *plain).withColumn(SET, F.lit(0))
    for number, (value, wanted) in enumerate(sets, 1):
        # rows collapse to one per partition and value before the shuffle, as in a full scan
        flags = [F.max(F.lit(True) if m.rows is None else F.coalesce(m.rows, F.lit(False))).alias(f"flag_{number}_{i}")
                 for i, m in enumerate(wanted)]
        found = df.groupBy(partition, F.expr(value).alias(f"value_{number}")).agg(*flags).where(f"value_{number} IS NOT NULL")
        states = states.unionByName(found.withColumn(SET, F.lit(number)), allowMissingColumns=True)
    return states


def load_states(spark: SparkSession, place: str, df: DataFrame, measures: Sequence[Measure], partition: str,
                values: Sequence, exact: bool = True) -> None:
    """Compute the states of the partitions ``values`` and put them in the place of their old ones.

    ``place`` is a folder (it holds a slash) or a catalog table. Only these partitions of ``df`` are read; None names the rows without
    a partition. A partition that has no rows left gets empty states. Loading again gives the same table.
    """
    wanted = list(dict.fromkeys(values))
    if not wanted:
        return
    known = [v for v in wanted if v is not None]
    tests = ([F.col(partition).isin(known)] if known else []) + ([F.col(partition).isNull()] if None in wanted else [])
    states = partition_states(df.where(reduce(Column.__or__, tests)), measures, partition, exact)
    # a row per partition and set, so that all of them are replaced; its value is NULL and counts nowhere
    numbers = range(len(_sets(measures, exact)) + 1)
    shape = T.StructType([T.StructField(partition, df.schema[partition].dataType), T.StructField(SET, T.IntegerType())])
    blank = spark.createDataFrame([(v, n) for v in wanted for n in numbers], shape)
    states = states.unionByName(blank.withColumn(MARK, F.lit(_mark(measures, exact))), allowMissingColumns=True)
    order = [c for c in states.columns if c not in (partition, SET)]
    replace_partitions(spark, place, states.select(*order, partition, SET), [partition, SET])


def _stored(spark: SparkSession, place: str) -> DataFrame:
    return spark.read.parquet(place) if "/" in place else spark.table(place)


def pending(spark: SparkSession, place: str, df: DataFrame, partition: str) -> list:
    """Partitions of ``df`` without a state, ascending; a table that does not exist has none. Reads no other column."""
    found = df.select(partition).distinct()
    if "/" in place:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    else:
        exists = spark.catalog.tableExists(place)
    if exists:
        known = _stored(spark, place).where(F.col(SET) == 0).select(F.col(partition).cast(df.schema[partition].dataType).alias(partition)).distinct()
        found = found.join(known, found[partition].eqNullSafe(known[partition]), "left_anti")
    # one value per partition
    return sorted((r[0] for r in found.collect()), key=lambda v: (v is not None, v if v is not None else 0))


def _merged(stored: DataFrame, m: Measure) -> Column:
    state, kind = F.col(m.name), m.kind.removesuffix("_if")
    if m.is_distinct:
        result = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(state)), F.lit(0))
    elif kind == "count":
        result = F.coalesce(F.sum(state), F.lit(0))
    elif kind == "avg":
        result = F.try_divide(F.sum(f"{m.name}__sum"), F.sum(f"{m.name}__n"))
    else:
        result = getattr(F, kind)(state)
    result = result if m.is_distinct else result.cast(stored.schema[m.name].dataType)
    if m.default is not None and not (m.is_distinct or kind == "count"):
        result = F.coalesce(result, F.lit(m.default))
    return result.alias(m.name)


def merge_states(spark: SparkSession, place: str, measures: Sequence[Measure], where: str | None = None,
                 exact: bool = True) -> DataFrame:
    """One row with one column per measure, as ``aggregates.measure`` gives over all rows of the partitions.

    ``where`` is a condition on the partition column and prunes folders. States of other measures are an error. Sums and averages of
    doubles may differ from a full scan in their last digits, for they are added in another order.
    """
    stored = _stored(spark, place)
    if where is not None:
        stored = stored.where(where)
    states = stored.where(F.col(SET) == 0)
    mark = _mark(measures, exact)
    if not states.where(F.col(MARK) != mark).isEmpty():
        raise SourceError(f"{place} holds states of other measures")
    parts = []
    plain = [m for m in measures if not (m.is_distinct and exact)]
    if plain:
        parts.append(states.agg(*[_merged(stored, m) for m in plain]))
    for number, (_, wanted) in enumerate(_sets(measures, exact), 1):
        flags = [f"flag_{number}_{i}" for i in range(len(wanted))]
        per_value = (stored.where((F.col(SET) == number) & F.col(f"value_{number}").isNotNull())
                     .groupBy(f"value_{number}").agg(*[F.max(f).alias(f) for f in flags]))
        parts.append(per_value.agg(*[F.count_if(F.col(f)).alias(m.name) for f, m in zip(flags, wanted)]))
    if len(parts) == 1:
        return parts[0].select(*[m.name for m in measures])
    from .relational import combine_one_row
    return combine_one_row(spark, parts).select(*[m.name for m in measures])
