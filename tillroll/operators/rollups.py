"""Line and invoice grains behind one set of measures.

Every revenue, country and customer report sums ``Lines``, ``Units`` and ``Revenue`` and so runs on single lines
or on the much smaller invoice roll-up, with equal results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.schema import CALENDAR, MONEY

INVOICE_KEY = ("InvoiceNo", "CustomerID", "Country", *CALENDAR)


def measured(frame: DataFrame) -> DataFrame:
    """Give single lines the measure columns; roll-ups have them already."""
    if "Lines" in frame.columns:
        return frame
    moment = F.col("InvoiceDate")
    return frame.withColumns(
        {
            "Lines": F.lit(1).cast("bigint"),
            "Units": F.col("Quantity").cast("bigint"),
            "Revenue": F.col("TotalAmount").cast(MONEY),
            "FirstPurchase": moment,
            "LastPurchase": moment,
        }
    )


def invoice_rollup(lines: DataFrame) -> DataFrame:
    """One row per invoice and its customer, country, year, month, weekday and hour, with exact sums."""
    return (
        measured(lines)
        .groupBy(*INVOICE_KEY)
        .agg(
            F.sum("Lines").alias("Lines"),
            F.sum("Units").alias("Units"),
            F.sum("Revenue").cast(MONEY).alias("Revenue"),
            F.min("FirstPurchase").alias("FirstPurchase"),
            F.max("LastPurchase").alias("LastPurchase"),
        )
    )


def invoice_transactions(frame: DataFrame) -> DataFrame:
    """The invoice table."""
    rolled = frame if "Lines" in frame.columns else invoice_rollup(frame)
    return rolled.select(
        *INVOICE_KEY,
        C.as_double(F.col("Revenue")).alias("TotalAmount"),
        F.col("Lines").alias("TotalItems"),
        F.col("Units").alias("TotalQuantity"),
    )


SKETCH_BITS = 14
SURE = 6  # standard errors that no count of a report exceeds: one in 500 million does


def sketch_error(bits: int = SKETCH_BITS, errors: float = 3) -> float:
    """Standard errors of a distinct count from sketches of 2**bits registers, as a share of the count: three are 2.4 % for 14 bits.

    One count in 370 lies outside of three, so a report with many counts is to be held against ``SURE`` of them, 4.9 % for 14 bits.
    """
    return errors * 1.04 / 2 ** (bits / 2)


def sketch_rollup(
    frame: DataFrame,
    keys: Sequence[str] = ("Year", "Month", "Country"),
    distinct: Sequence[str] = ("InvoiceNo", "CustomerID"),
    bits: int = SKETCH_BITS,
) -> DataFrame:
    """Sums by ``keys`` with a mergeable sketch of each ``distinct`` column (A4, approximate).

    The reports by month, quarter, country or over all take this in place of lines or invoices: their distinct counts then come from merged
    sketches, within ``sketch_error``, and no row is repeated for a distinct column. At most 16 kilobytes a sketch, whatever it sums.
    """
    return (
        measured(frame)
        .groupBy(*keys)
        .agg(
            F.sum("Lines").alias("Lines"),
            F.sum("Units").alias("Units"),
            F.sum("Revenue").cast(MONEY).alias("Revenue"),
            F.min("FirstPurchase").alias("FirstPurchase"),
            F.max("LastPurchase").alias("LastPurchase"),
            *[F.hll_sketch_agg(c, bits).alias(f"{c}Sketch") for c in distinct],
        )
    )


def distinct_count(frame: DataFrame, column: str) -> Column:
    """Distinct values of a column: exact, or from the sketches of a ``sketch_rollup``."""
    if f"{column}Sketch" in frame.columns:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{column}Sketch")), F.lit(0).cast("long"))
    return F.count_distinct(column)


# Which of Year, Month, DayOfWeek, Hour and Country a row of ``report_grains`` is summed over, as bits.
GRAINS = {"month": 0b00111, "weekday": 0b11011, "hour": 0b11101, "country": 0b11110}


def report_grains(frame: DataFrame) -> DataFrame:
    """Sums by month, by weekday, by hour and by country in one pass (R1, R3, R5, R11, R13), with ``Grain`` to tell them apart.

    Each grain's rows are a frame for the reports of that grain.
    """
    sets = [["Year", "Month"], ["DayOfWeek"], ["Hour"], ["Country"]]
    rows = measured(frame).groupingSets(sets, *CALENDAR, "Country")
    return rows.agg(
        F.grouping_id().cast("int").alias("Grain"),
        F.sum("Lines").alias("Lines"),
        F.sum("Units").alias("Units"),
        F.sum("Revenue").cast(MONEY).alias("Revenue"),
    )


def of_grain(grains: DataFrame, grain: str) -> DataFrame:
    return grains.filter(F.col("Grain") == GRAINS[grain])
