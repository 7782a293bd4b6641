"""Revenue over time (R1-R6, R13, R14, X1) and the dataset overview.

Reports with several distinct counts are best given an invoice roll-up: Spark rewrites them by repeating each
input row once per distinct column, and the roll-up has far fewer rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.operators.rollups import distinct_count, measured

_MONTH = ("Year", "Month")


def _revenue() -> Column:
    return C.as_double(F.sum("Revenue")).alias("TotalRevenue")


def _lines(name: str) -> Column:
    return F.sum("Lines").alias(name)


def _invoices(frame: DataFrame) -> Column:
    return distinct_count(frame, "InvoiceNo").alias("TotalOrders")


def _per_line() -> Column:
    return C.ratio(F.sum("Revenue"), F.sum("Lines")).alias("AvgOrderValue")


def monthly_by_lines(frame: DataFrame) -> DataFrame:
    """Revenue by month; orders are counted as lines."""
    return measured(frame).groupBy(*_MONTH).agg(_lines("TotalOrders"), _revenue(), _per_line()).orderBy(*_MONTH)


def monthly_by_invoices(frame: DataFrame) -> DataFrame:
    """Revenue by month with distinct orders and customers, and quantity (R2)."""
    return (
        measured(frame)
        .groupBy(*_MONTH)
        .agg(
            _invoices(frame),
            distinct_count(frame, "CustomerID").alias("TotalCustomers"),
            F.sum("Units").alias("TotalQuantity"),
            _revenue(),
            _per_line(),
        )
        .orderBy(*_MONTH)
    )


def weekday_by_lines(frame: DataFrame, locale: str = "vi") -> DataFrame:
    """Revenue by weekday; orders are counted as lines."""
    report = measured(frame).groupBy("DayOfWeek").agg(_lines("TotalOrders"), _revenue())
    return report.withColumn("DayName", C.weekday_name(F.col("DayOfWeek"), locale)).orderBy("DayOfWeek")


def weekday_by_invoices(frame: DataFrame, locale: str = "en") -> DataFrame:
    """Revenue by weekday with distinct orders."""
    report = measured(frame).groupBy("DayOfWeek").agg(_invoices(frame), _revenue())
    return report.withColumn("DayName", C.weekday_name(F.col("DayOfWeek"), locale)).orderBy("DayOfWeek")


def hourly_by_lines(frame: DataFrame) -> DataFrame:
    """Revenue by hour; orders are counted as lines."""
    return measured(frame).groupBy("Hour").agg(_lines("TotalOrders"), _revenue()).orderBy("Hour")


def hourly_by_invoices(frame: DataFrame) -> DataFrame:
    """Revenue by hour with distinct orders."""
    return measured(frame).groupBy("Hour").agg(_invoices(frame), _revenue()).orderBy("Hour")


def monthly_totals(frame: DataFrame) -> DataFrame:
    """Lines, revenue and quantity by month."""
    report = measured(frame).groupBy(*_MONTH)
    return report.agg(
        _lines("TotalTransactions"), _revenue(), F.sum("Units").alias("TotalQuantity")
    ).orderBy(*_MONTH)


def monthly_trend(frame: DataFrame) -> DataFrame:
    """Month by month with revenue per order and the previous month's revenue.

    The unpartitioned window sees one row per month.
    """
    months = (
        measured(frame)
        .groupBy(*_MONTH)
        .agg(
            distinct_count(frame, "CustomerID").alias("UniqueCustomers"),
            _invoices(frame),
            _revenue(),
            C.ratio(F.sum("Revenue"), distinct_count(frame, "InvoiceNo")).alias("AvgOrderValue"),
        )
    )
    before = F.lag("TotalRevenue").over(Window.orderBy(*_MONTH))
    return months.withColumn("PrevMonthRevenue", before).orderBy(*_MONTH)


def quarterly(frame: DataFrame) -> DataFrame:
    """Revenue by quarter."""
    quarter = F.ceil(F.col("Month") / 3).cast("int")
    return (
        measured(frame)
        .groupBy("Year", quarter.alias("Quarter"))
        .agg(_invoices(frame), _revenue())
        .orderBy("Year", "Quarter")
    )


def overview(frame: DataFrame) -> DataFrame:
    """Size, distinct customers, orders and products, revenue and date range (R16), of lines or of a ``sketch_rollup`` with these three."""
    rows = measured(frame)
    return rows.agg(
        F.coalesce(F.sum("Lines"), F.lit(0)).alias("TotalRecords"),
        distinct_count(frame, "CustomerID").alias("UniqueCustomers"),
        distinct_count(frame, "InvoiceNo").alias("UniqueOrders"),
        distinct_count(frame, "StockCode").alias("UniqueProducts"),
        C.as_double(F.sum("Revenue")).alias("TotalRevenue"),
        F.min("FirstPurchase").alias("FirstDate"),
        F.max("LastPurchase").alias("LastDate"),
    )
