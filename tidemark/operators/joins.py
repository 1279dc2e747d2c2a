"""Equi-joins, on request with very frequent keys spread over many tasks.

Adaptive execution splits a skewed side of most joins at run time, so a plain join is the default.
Where that does not help (adaptive execution off, or a key that is hot on both sides), ``hot_share``
asks for salting: keys that hold more than that share of the left rows are found by an aggregate
(partial sums before its shuffle), and only those keys are spread over ``salts`` buckets on both sides.
At most ``1 / hot_share`` keys can be hot, and shares below 0.01 are refused, which bounds the broadcast
of the hot-key list.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_SHARE = 0.05
LEAST_SHARE = 0.01
SALTS = 64

_SALT, _SALT_RIGHT, _HOT, _N = "__salt", "__salt_right", "__hot", "__n"


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of the rows; never more than ``1 / share`` of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N))
    total = counts.agg(F.sum(_N)).scalar()
    return counts.where(F.col(_N) > total * F.lit(share)).select(*keys)


def _row_salt(df: DataFrame, salts: int) -> Column:
    """Bucket of a row that a retried task computes again: from its values and its partition.

    The partition number spreads exact copies of a row that sit in different partitions.
    """
    hashable = [F.col(f"`{f.name}`") for f in df.schema if not _holds_map(f.dataType)]
    return F.pmod(F.xxhash64(*hashable, F.spark_partition_id()), F.lit(salts))


def _holds_map(kind: T.DataType) -> bool:
    """Whether a type has a map in it, which Spark cannot hash."""
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return _holds_map(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, (T.MapType, T.VariantType))


def _mark(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with a flag on the rows of hot keys; NULL keys are flagged on their own."""
    flags = F.broadcast(hot.withColumn(_HOT, F.lit(True)))
    return df.join(flags, list(keys), "left")


def _spread(df: DataFrame, hot: DataFrame, keys: Sequence[str], salts: int, salt: str) -> DataFrame:
    """Rows of hot keys over ``salts`` buckets, all others in bucket 0; NULL keys are spread too."""
    apart = F.coalesce(F.col(_HOT), F.lit(False)) | ~_keyed(keys)
    bucket = F.when(apart, _row_salt(df, salts)).otherwise(F.lit(0).cast("bigint"))
    return _mark(df, hot, keys).withColumn(salt, bucket).drop(_HOT)


def _copy(df: DataFrame, hot: DataFrame, keys: Sequence[str], salts: int, salt: str) -> DataFrame:
    """Rows of hot keys once per bucket, all others in bucket 0."""
    number = lambda n: F.lit(n).cast("bigint")
    buckets = F.when(F.coalesce(F.col(_HOT), F.lit(False)), F.sequence(number(0), number(salts - 1))
                     ).otherwise(F.array(number(0)))
    return _mark(df, hot, keys).withColumn(salt, F.explode(buckets)).drop(_HOT)


def _keyed(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def equi_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
              hot_share: float | None = None, salts: int = SALTS, split_right: bool = False) -> DataFrame:
    """Inner, left, left semi or left anti join on equal ``keys``; with ``hot_share``, hot left keys salted.

    The result equals the plain join. Columns are those of ``left`` (keys in place), then the
    others of ``right``. Rows with a NULL key match nothing and are spread as well. Semi and anti
    joins reduce the right side to its distinct keys. ``split_right`` also salts the keys that are
    hot on the right side of an inner or left join; without it the right side should be a lookup.
    The key columns of a side are read once more to find its hot keys: materialise an expensive side.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = list(keys)
    if hot_share is not None and hot_share < LEAST_SHARE:
        raise ValueError(f"hot_share must be {LEAST_SHARE} or more: it bounds the list of hot keys")
    if how in ("inner", "left"):
        both = [c for c in left.columns if c not in keys and c in right.columns]
        if both:
            raise ValueError(f"both sides have the columns {both}: rename them first")
    if hot_share is None:
        extra = [c for c in right.columns if c not in keys] if how in ("inner", "left") else []
        return left.join(right, keys, how).select(*[F.col(f"`{c}`") for c in left.columns + extra])
    right = right.where(_keyed(keys))
    if how in ("left_semi", "left_anti"):
        right = right.select(*keys).distinct()
    extra = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in keys]
    columns = [F.col(f"`{c}`") for c in left.columns + extra]
    hot = hot_keys(left.where(_keyed(keys)), keys, hot_share)
    if split_right and how == "left":
        # a copied left row must not come out unmatched once per copy: matches and the rest apart
        matched = equi_join(left, right, keys, "inner", hot_share, salts, split_right=True)
        rest = equi_join(left, right, keys, "left_anti", hot_share, salts)
        return matched.unionByName(rest, allowMissingColumns=True)
    near, far = _spread(left, hot, keys, salts, _SALT), _copy(right, hot, keys, salts, _SALT)
    on = keys + [_SALT]
    if split_right and how == "inner":
        hot_right = hot_keys(right, keys, hot_share)
        near, far = _copy(near, hot_right, keys, salts, _SALT_RIGHT), _spread(far, hot_right, keys, salts, _SALT_RIGHT)
        on = on + [_SALT_RIGHT]
    return near.join(far, on, how).select(*columns)


def keyed_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, summed before the shuffle: a hot key travels as one row per map task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
