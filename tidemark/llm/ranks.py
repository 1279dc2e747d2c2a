"""Gapless positions of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise


def positions(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``, the place of a row from 0 on, and ``part``, the number of its range of the order.

    Rows are range-partitioned and sorted inside their ranges; the ranges' row counts then give every range its
    first place. Rows equal under ``order`` are told apart by where they were read, so that many of them can be
    split over ranges. The ranges are written to the shared folder: a task run again cannot place rows anew.
    ``df`` is computed twice (its order is sampled first), so hand over a written table.
    """
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    keys = [*order, F.col("__tie").asc()]
    placed = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie").withColumn("__at", F.monotonically_increasing_id())
    placed = materialise(placed.withColumn("part", F.shiftright("__at", 33)), "ranks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range, whatever the input
    counts = placed.groupBy("part").count()
    first = counts.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__first"))
    found = placed.join(F.broadcast(first), "part")
    return found.withColumn(name, F.col("__first") + F.col("__at").bitwiseAND((1 << 33) - 1)).drop("__at", "__first")
