"""Places of rows in a sorted order, without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.runtime import cut

_RANGE_BITS = 33  # monotonically increasing ids hold the number of the partition above these bits


def numbered(df: DataFrame, *order: str | Column, name: str = "Position") -> DataFrame:
    """``df`` with the place of each row in ``order``, from 1.

    Spark deals the rows out in sorted ranges, which are written with each row's place in its range. A range's places
    start after the rows of the ranges before it: sums over one count for each range, not over rows. Name columns that identify a row last in the
    order, or equal rows may change places with each run.
    """
    placed = cut(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _RANGE_BITS)
    sizes = placed.groupBy(part.alias("_range")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = cut(sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before")))
    own = F.col("_at").bitwiseAND(F.lit((1 << _RANGE_BITS) - 1))
    joined = placed.withColumn("_range", part).join(F.broadcast(starts), "_range")  # a row for each range
    return joined.withColumn(name, F.col("_before") + own + 1).drop("_range", "_before", "_at")
