"""The query surface of transform steps and metrics, as DataFrame calls."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .joins import equi_join


def select(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns in the listed order."""
    return df.select(*columns)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename old -> new and keep all other columns; an unknown old name is an error."""
    unknown = [old for old in names if old not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.withColumnsRenamed(dict(names))


def select_expr(df: DataFrame, exprs: Sequence[str]) -> DataFrame:
    """Spark SQL expressions with aliases."""
    return df.selectExpr(*exprs)


def filter_rows(df: DataFrame, condition: str | Column) -> DataFrame:
    """Rows where the condition is TRUE (not FALSE, not NULL)."""
    return df.where(condition)


def split_on_null(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a value and rows without one."""
    return df.where(F.col(column).isNotNull()), df.where(F.col(column).isNull())


def join_left(left: DataFrame, right: DataFrame, condition: str | None = None,
              on: Sequence[str] | None = None, hot_share: float | None = None, split_right: bool = False) -> DataFrame:
    """All left rows with their matches: by SQL condition, or by equal keys.

    Skew is left to adaptive execution, which splits the left side of a left join; ``hot_share`` salts
    the keys that hold more of the rows.
    """
    if on is not None:
        return equi_join(left, right, on, "left", hot_share, split_right=split_right)
    return left.join(right, F.expr(condition), "left")


def join_chain(df: DataFrame, links: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Left joins one after the other; several matches multiply the row."""
    for right, condition in links:
        df = join_left(df, right, condition)
    return df


def join_inner(left: DataFrame, right: DataFrame, condition: str | None = None,
               on: Sequence[str] | None = None, hot_share: float | None = None, split_right: bool = True) -> DataFrame:
    """Matching rows only; by equal ``on`` keys, with ``hot_share`` hot keys of both sides are salted."""
    if on is not None:
        return equi_join(left, right, on, "inner", hot_share, split_right=split_right)
    return left.join(right, F.expr(condition), "inner")


def semi(left: DataFrame, right: DataFrame, keys: Sequence[str], hot_share: float | None = None) -> DataFrame:
    """Left rows with a match in ``right``, never multiplied (IN subquery)."""
    return equi_join(left, right, keys, "left_semi", hot_share)


def anti(left: DataFrame, right: DataFrame, keys: Sequence[str], hot_share: float | None = None) -> DataFrame:
    """Left rows without a match; a NULL key has none (NOT EXISTS, not NOT IN)."""
    return equi_join(left, right, keys, "left_anti", hot_share)


def scalars(spark: SparkSession, values: Mapping[str, DataFrame]) -> DataFrame:
    """One row with one column per name, each the single value of a one-row DataFrame.

    The parts become scalar subqueries, so equal scans are merged and nothing is joined.
    """
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in values.items()])


def scalar_counts(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the row count of each named DataFrame."""
    return scalars(spark, {name: df.agg(F.count(F.lit(1)).alias("n")) for name, df in tables.items()})


def combine_one_row(spark: SparkSession, rows: Sequence[DataFrame]) -> DataFrame:
    """Columns of several one-row DataFrames side by side in one row."""
    parts = [(df.select(F.struct(*df.columns).alias("r")).scalar(), df.columns) for df in rows]
    packed = spark.range(1).select(*[part.alias(f"p{i}") for i, (part, _) in enumerate(parts)])
    return packed.select(*[
        F.col(f"p{i}").getField(name).alias(name)
        for i, (_, names) in enumerate(parts) for name in names
    ])


def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of a total order; each task keeps ``n`` rows, the merge takes ``n``."""
    return df.orderBy(*order).limit(n)


def row_numbers(df: DataFrame, order: Sequence[str | Column], n: int,
                partition: Sequence[str] = (), name: str = "rn") -> DataFrame:
    """Rows with their 1-based rank, up to rank ``n``.

    Without a partition only the top ``n`` rows meet in one task. With one, the ``<= n`` filter lets
    Spark drop the lower ranks of each group before the shuffle, so a hot group stays small.
    """
    if not partition:
        df = top_n(df, order, n)
    window = Window.partitionBy(*[F.col(c) for c in partition]).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def pivot_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
               ranks: Sequence[int], partition: Sequence[str] = ()) -> DataFrame:
    """Count of rows per listed rank, as one column per rank."""
    ranked = row_numbers(df, order, max(ranks), partition)
    return ranked.groupBy(*keys).agg(*[
        F.count_if(F.col("rn") == rank).alias(f"rank_{rank}") for rank in ranks
    ])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All columns but the listed ones."""
    return df.drop(*columns)


def distinct(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Unique rows of the listed columns."""
    return (df.select(*columns) if columns else df).distinct()
