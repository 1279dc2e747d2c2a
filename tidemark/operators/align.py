"""Make rows fit a target table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align(df: DataFrame, target: T.StructType, missing: str = "skip",
          default_decimal: T.DecimalType = T.DecimalType(38, 9)) -> DataFrame:
    """Columns of ``target`` in its order, cast to its types, in one projection.

    Extra columns are dropped. A target column the source lacks stays out (``skip``) or becomes
    NULL (``null``). Only date, timestamp, decimal and float targets are cast; other columns keep
    their type. Decimals take the precision of the target.
    """
    if missing not in ("skip", "null"):
        raise ValueError(f"missing must be 'skip' or 'null', not {missing!r}")
    have = {f.name: f.dataType for f in df.schema}

    def column(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(f"`{field.name}`")
        if have[field.name] == field.dataType:
            return value
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType,
                                       T.DecimalType, T.DoubleType, T.FloatType)):
            value = value.cast(field.dataType)
        return value.alias(field.name)

    return df.select([column(f) for f in target if f.name in have or missing == "null"])


def align_decimals(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast the decimal columns to the target's precision and scale; leave all others."""
    wanted = {f.name: f.dataType for f in target if isinstance(f.dataType, T.DecimalType)}
    return df.select([
        F.col(f"`{c}`").cast(wanted[c]).alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns
    ])
