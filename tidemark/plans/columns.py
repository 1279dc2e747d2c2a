"""Which result column of a metric's SQL feeds which value of its row."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import MetricError
from ..schemas import METRIC_DECIMAL

# Value name -> default result column, and the kind of each value.
DEFAULT_COLUMNS = {
    "metric_output": "metric_output",
    "numerator_value": "numerator_value",
    "denominator_value": "denominator_value",
    "business_data_date": "business_data_date",
}
NUMERIC, DATE = "numeric", "date"
KINDS = {"metric_output": NUMERIC, "numerator_value": NUMERIC, "denominator_value": NUMERIC,
         "business_data_date": DATE}


@dataclass(frozen=True)
class ColumnMap:
    """Internal name -> result column. Kinds belong to internal names, so a renamed number stays one."""

    names: Mapping[str, str] = field(default_factory=lambda: dict(DEFAULT_COLUMNS))
    kinds: Mapping[str, str] = field(default_factory=lambda: dict(KINDS))
    required: Sequence[str] = ("business_data_date",)

    def update(self, names: Mapping[str, str]) -> "ColumnMap":
        """A map with several names changed or added."""
        return ColumnMap({**self.names, **names}, self.kinds, self.required)

    def add(self, internal: str, column: str, kind: str | None = None) -> "ColumnMap":
        """A map with one more value; it is text unless ``kind`` says numeric or date."""
        kinds = {**self.kinds, internal: kind} if kind else self.kinds
        return ColumnMap({**self.names, internal: column}, kinds, self.required)

    def column(self, internal: str) -> str:
        """Result column of a value."""
        return self.names.get(internal, internal)

    def internal(self, column: str) -> str:
        """Value a result column feeds."""
        return {c: name for name, c in self.names.items()}.get(column, column)

    def type_of(self, internal: str) -> T.DataType:
        return METRIC_DECIMAL if self.kinds.get(internal) == NUMERIC else T.StringType()

    def schema(self) -> T.StructType:
        """Row layout of the mapped values."""
        return T.StructType([
            T.StructField(name, self.type_of(name), self.kinds.get(name) != DATE) for name in self.names
        ])

    def missing(self, df: DataFrame) -> tuple[list[str], list[str]]:
        """Result columns the SQL does not return: the required ones and the others (no job runs)."""
        absent = [name for name, column in self.names.items() if column not in df.columns]
        return ([self.column(n) for n in absent if n in self.required],
                [self.column(n) for n in absent if n not in self.required])

    def check(self, df: DataFrame) -> None:
        """Raise when a required result column is not returned."""
        required, _ = self.missing(df)
        if required:
            raise MetricError(f"{', '.join(required)} is required but was not returned by the SQL query")

    def value(self, df: DataFrame, internal: str) -> Column:
        """The raw value, NULL when the SQL does not return it."""
        name = self.column(internal)
        return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")
