"""Row numbers and running totals over a whole table, without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dvspark.llm.common import stored

#: Numbers in one piece of :func:`explode_range`.
PIECE = 4096


def in_order(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """The rows sorted over range partitions and stored, with the partition (``_part``) and the row's place in it (``_nth``).

    Stored, so both stay as they are however often the table is read.
    """
    at = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at)
    return stored(placed.withColumn("_part", F.shiftright("_at", 33)).withColumn("_nth", F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at"), name)


def with_total_before(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Rows of :func:`in_order` with the sum of ``value`` over all rows before.

    Only one row a partition is summed up in a single task.
    """
    rows = rows.withColumn("_value", value)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_part").agg(F.sum("_value").alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part").orderBy("_nth").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(parts, "_part").withColumn(name, F.col("_before") + F.coalesce(F.sum("_value").over(within), F.lit(0))).drop("_value", "_before")


def explode_range(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """A row for every number from ``first`` to ``last`` (none if ``last`` is smaller).

    Long ranges are cut in pieces that are dealt out before they are listed,
    so one row with a long range is not listed by one task.
    """
    spans = df.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    spans = spans.withColumn("_span", F.explode(F.sequence(F.floor(F.col("_first") / PIECE), F.floor(F.col("_last") / PIECE))))
    lo, hi = F.greatest("_first", F.col("_span") * PIECE), F.least("_last", F.col("_span") * PIECE + (PIECE - 1))
    return spans.hint("rebalance").withColumn(name, F.explode(F.sequence(lo, hi))).drop("_first", "_last", "_span")
