"""Compare keyed tables of several environments."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint

# Fixed value: what stands for an attribute that one side lacks.
MISSING_KEY = "<MISSING KEY>"


def dedupe_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in load order."""
    from .scd2 import one_per_key
    return one_per_key(df, key, order)


def attributes(df: DataFrame, key: Sequence[str]) -> Column:
    """Present attributes of a row as name -> text; a NULL attribute is absent."""
    entries = [F.struct(F.lit(c).alias("k"), F.col(f"`{c}`").cast("string").alias("v"))
               for c in df.columns if c not in key]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["v"].isNotNull()))


def compare_tables(tables: Mapping[str, DataFrame], key: Sequence[str], missing: str = MISSING_KEY,
                   order: Sequence[str] = (), all_pairs: bool = False) -> DataFrame:
    """Per key: MISSING (in which environments), EQUAL, or one DIFFERENT row per attribute and pair.

    Every environment is compared with the first, or with each other one (``all_pairs``). ``order``
    decides which row of a repeated key counts; those columns are not compared. All environments
    meet in one shuffle by key, one row per key and environment at most.
    """
    names, key = list(tables), list(key)
    parts = []
    for env, df in tables.items():
        last = dedupe_last(df, key, order)
        compared = last.drop(*order)
        parts.append(compared.select(*key, F.lit(env).alias("env"), attributes(compared, key).alias("attrs")))
    merged = reduce(DataFrame.unionByName, parts).groupBy(*key).agg(*[
        F.first(F.when(F.col("env") == env, F.col("attrs")), ignorenulls=True).alias(f"e{i}")
        for i, env in enumerate(names)])
    absent = F.filter(F.array(*[F.when(F.col(f"e{i}").isNull(), F.lit(env)) for i, env in enumerate(names)]),
                      lambda e: e.isNotNull())
    pairs = ([(i, j) for i in range(len(names)) for j in range(i + 1, len(names))] if all_pairs
             else [(0, j) for j in range(1, len(names))])
    diffs = F.concat(*[_differences(names, i, j, missing) for i, j in pairs])
    judged = merged.select(*key, absent.alias("missing_in"), diffs.alias("diffs"))
    blank = F.struct(*[F.lit(None).cast("string").alias(c) for c in
                       ("attribute", "left_env", "left_value", "right_env", "right_value")])
    status = (F.when(F.size("missing_in") > 0, "MISSING").when(F.size("diffs") > 0, "DIFFERENT").otherwise("EQUAL"))
    rows = F.when(status == "DIFFERENT", F.col("diffs")).otherwise(F.array(blank))
    return (judged.select(*key, status.alias("status"), F.array_join("missing_in", ", ").alias("missing_in"),
                          F.explode(rows).alias("d"))
            .select(*key, "status", "missing_in", "d.*"))


def digests(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Rows and digest of each bucket of keys: equal for equal rows in any order, NULL attributes and absent ones alike.

    The digest is two sums of 64-bit hashes. Partial sums are made before the shuffle, so it carries ``buckets`` rows
    per task at most.
    """
    row = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in sorted(df.columns)]))
    number = [F.xxhash64(*salt, "row").cast("decimal(20,0)") for salt in ((), (F.lit(1),))]
    return (df.select(bucket_of(key, buckets).alias("bucket"), row.alias("row"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(f"d{i}") for i, h in enumerate(number)]))


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets))


def unequal_buckets(tables: Mapping[str, DataFrame], key: Sequence[str], buckets: int) -> DataFrame:
    """Buckets of keys whose rows are not the same in all tables: ``buckets`` rows at most."""
    every = reduce(DataFrame.unionByName, [digests(df, key, buckets) for df in tables.values()])
    sides = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("sides"), *[
        (F.min(c) == F.max(c)).alias(f"same_{c}") for c in ("n", "d0", "d1")])
    return sides.where(~((F.col("sides") == len(tables)) & F.col("same_n") & F.col("same_d0") & F.col("same_d1"))).select("bucket")


def compare_by_digest(tables: Mapping[str, DataFrame], key: Sequence[str], missing: str = MISSING_KEY,
                      order: Sequence[str] = (), all_pairs: bool = False, buckets: int = 4096,
                      unique_keys: bool = False) -> DataFrame:
    """The rows of ``compare_tables``, for tables that are mostly equal.

    Buckets of keys are first compared by digest; only rows of those that differ are shuffled and compared one by one.
    Keys of the others are EQUAL: they are read from the first table, and only keys travel, to be told once each;
    ``unique_keys`` promises that the first table repeats none, then nothing does. Tables are read twice. ``buckets``
    bounds what is broadcast (a number per bucket); take some tens of times the number of keys expected to differ. Where more
    differ the result is the same, at the price of one scan more than ``compare_tables``.
    """
    key = list(key)
    kinds = {tuple(df.schema[c].dataType.simpleString() for c in key) for df in tables.values()}
    if len(kinds) > 1:
        raise ValueError(f"key columns {key} have unlike types: {sorted(kinds)}")
    unequal = checkpoint(unequal_buckets(tables, key, buckets))
    mark = "__bucket"

    def marked(df: DataFrame, how: str) -> DataFrame:
        there = F.broadcast(unequal.select(F.col("bucket").alias(mark)))
        return df.join(there, bucket_of(key, buckets) == F.col(mark), how)

    rows = compare_tables({env: marked(df, "left_semi") for env, df in tables.items()}, key, missing, order, all_pairs)
    equal = marked(next(iter(tables.values())).select(*key), "left_anti")
    equal = equal if unique_keys else equal.distinct()
    blank = [F.lit(None).cast("string").alias(c) for c in rows.columns[len(key) + 2:]]
    return rows.unionByName(equal.select(*key, F.lit("EQUAL").alias("status"), F.lit("").alias("missing_in"), *blank))


def _differences(names: Sequence[str], i: int, j: int, missing: str) -> Column:
    """Attributes of two environments that differ; none when either lacks the key."""
    left, right = F.col(f"e{i}"), F.col(f"e{j}")
    everything = F.array_sort(F.array_union(F.map_keys(left), F.map_keys(right)))
    unequal = F.filter(everything, lambda a: ~F.element_at(left, a).eqNullSafe(F.element_at(right, a)))
    rows = F.transform(unequal, lambda a: F.struct(
        a.alias("attribute"), F.lit(names[i]).alias("left_env"),
        F.coalesce(F.element_at(left, a), F.lit(missing)).alias("left_value"),
        F.lit(names[j]).alias("right_env"),
        F.coalesce(F.element_at(right, a), F.lit(missing)).alias("right_value")))
    empty = F.filter(F.transform(F.array(F.lit("")), lambda a: F.struct(
        a.alias("attribute"), a.alias("left_env"), a.alias("left_value"), a.alias("right_env"),
        a.alias("right_value"))), lambda _: F.lit(False))
    return F.coalesce(rows, empty)
