"""Dates as the metric rows need them."""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the only accepted text form of a date.
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def strict_date(text: Column) -> Column:
    """``text`` as a DATE when it is a real calendar day written YYYY-MM-DD, else NULL."""
    return F.when(text.rlike(ISO_DATE), text.try_cast("date"))


def strict_date_text(text: str) -> dt.date:
    """The same check for one argument of a run, before any job starts."""
    if not isinstance(text, str) or len(text) != 10:
        raise ValueError(f"not a YYYY-MM-DD date: {text!r}")
    return dt.date.fromisoformat(text)


def business_date(value: Column, data_type: T.DataType) -> Column:
    """ISO text of a business date; NULL when it is absent, malformed or of another type."""
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(data_type, T.StringType):
        return F.when(strict_date(value).isNotNull(), value)
    return F.lit(None).cast("string")


def reference_date(day: Column) -> Column:
    """The business date a positional run reports: the day before its reference date."""
    return F.date_sub(day, 1)


def partition_calendar(spark: SparkSession, n: int, mode: str, as_of: dt.date) -> DataFrame:
    """``n`` partition dates before ``as_of``: daily, weekly (7-day gap) or weekdays (Mon-Fri)."""
    if n < 1:
        raise ValueError("n must be at least 1")
    if mode == "weekly":
        span, step = 7 * n, 7
    elif mode == "daily":
        span, step = n, 1
    elif mode == "weekdays":
        # any 7 days hold 5 weekdays, so this span always holds n of them
        span, step = 7 * (n // 5 + 1) + 7, 1
    else:
        raise ValueError(f"unknown calendar mode {mode!r}")
    days = spark.range(1).select(F.explode(F.sequence(
        F.date_sub(F.lit(as_of), span), F.date_sub(F.lit(as_of), 1), F.expr(f"interval {step} day"),
    )).alias("partition_dt"))
    if mode == "weekdays":
        weekday = F.dayofweek("partition_dt").between(2, 6)
        days = days.where(weekday).orderBy(F.desc("partition_dt")).limit(n)
    return days
