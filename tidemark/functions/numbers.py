"""Numbers of a metric row: exact decimals, safe division and denominator checks."""

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY_DENOMINATOR = 1e-7


def to_metric_decimal(value: Column) -> Column:
    """``value`` as DECIMAL(38,9); text that is no number, NaN, infinity and overflow give NULL."""
    return value.try_cast("decimal(38,9)")


def numeric_warning(name: str, raw: Column) -> Column:
    """Warning code for a value that was given but has no decimal form, else NULL."""
    lost = raw.isNotNull() & to_metric_decimal(raw).isNull()
    return F.when(lost, F.lit(f"{name}: not a DECIMAL(38,9)"))


def denominator_status(raw: Column) -> Column:
    """SKIP (no number), ZERO, NEGATIVE, TINY (a warning) or OK.

    The sign is read from the raw value: at scale 9 a small positive number would round to zero.
    """
    number = raw.try_cast("double")
    return (
        F.when(number.isNull() | F.isnan(number), "SKIP")
        .when(number == 0, "ZERO")
        .when(number < 0, "NEGATIVE")
        .when(number < TINY_DENOMINATOR, "TINY")
        .otherwise("OK")
    )


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """The quotient, NULL where the divisor is zero."""
    return F.try_divide(numerator, denominator)


def ratio_percent(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """Numerator as a percentage of the denominator, NULL where the denominator is zero."""
    return F.round(safe_divide(numerator * F.lit(100.0), denominator), places)
