"""Metric aggregates: many metrics of one table from one scan."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DefinitionError

_KINDS = ("count", "count_distinct", "sum", "count_if", "sum_if", "count_distinct_if", "max", "min", "avg")


@dataclass(frozen=True)
class Measure:
    """One aggregate over the rows that meet ``where``.

    ``value`` is a Spark SQL expression; ``condition`` restricts the ``*_if`` kinds; ``default``
    replaces a NULL result (a sum over no rows).
    """

    name: str
    kind: str = "count"
    value: str | None = None
    where: str | None = None
    condition: str | None = None
    default: object = None

    def __post_init__(self):
        if self.kind not in _KINDS:
            raise DefinitionError(f"unknown aggregate {self.kind!r}")
        if self.value is None and self.kind not in ("count", "count_if"):
            raise DefinitionError(f"{self.kind} of {self.name!r} needs a value")
        if self.kind.endswith("_if") and self.condition is None:
            raise DefinitionError(f"{self.kind} of {self.name!r} needs a condition")

    @property
    def rows(self) -> Column | None:
        """Condition a row must meet, or None for all rows."""
        parts = [F.expr(c) for c in (self.where, self.condition) if c]
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else parts[0] & parts[1]

    @property
    def is_distinct(self) -> bool:
        return self.kind.startswith("count_distinct")

    def column(self) -> Column:
        """The aggregate over the unfiltered table."""
        rows, kind = self.rows, self.kind.removesuffix("_if")
        if kind == "count" and self.value is None:
            result = F.count(F.lit(1)) if rows is None else F.count_if(rows)
        else:
            value = F.expr(self.value)
            result = getattr(F, kind)(value if rows is None else F.when(rows, value))
        if self.default is not None:
            result = F.coalesce(result, F.lit(self.default))
        return result.alias(self.name)


def measure(df: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """One row with one column per measure.

    All measures but distinct counts share one aggregate over one scan, whatever their filters.
    Distinct counts of the same value share one two-step aggregate: rows collapse to one per value
    before the shuffle, with a flag per filter, and the flags are counted. That needs no copy of
    the rows per distinct count.
    """
    plain = [m for m in measures if not m.is_distinct]
    values: dict[str, list[Measure]] = {}
    for m in measures:
        if m.is_distinct:
            values.setdefault(m.value, []).append(m)
    parts = []
    if plain:
        parts.append(df.agg(*[m.column() for m in plain]))
    for value, wanted in values.items():
        parts.append(_distinct_counts(df, value, wanted))
    if len(parts) == 1:
        return parts[0].select(*[m.name for m in measures])
    from .relational import combine_one_row
    return combine_one_row(df.sparkSession, parts).select(*[m.name for m in measures])


def _distinct_counts(df: DataFrame, value: str, wanted: Sequence[Measure]) -> DataFrame:
    flags = [F.max(F.lit(True) if m.rows is None else F.coalesce(m.rows, F.lit(False))).alias(f"f{i}")
             for i, m in enumerate(wanted)]
    per_value = df.groupBy(F.expr(value).alias("v")).agg(*flags).where("v IS NOT NULL")
    return per_value.agg(*[F.count_if(F.col(f"f{i}")).alias(m.name) for i, m in enumerate(wanted)])


def group_having(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column],
                 condition: str | Column) -> DataFrame:
    """Groups kept by a condition on their aggregates."""
    return df.groupBy(*keys).agg(*aggregates).where(condition)
