"""Countries and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.operators.rollups import distinct_count, measured


def countries_by_lines(frame: DataFrame) -> DataFrame:
    """Lines, revenue and quantity by country."""
    return (
        measured(frame)
        .groupBy("Country")
        .agg(
            F.sum("Lines").alias("TotalTransactions"),
            C.as_double(F.sum("Revenue")).alias("TotalRevenue"),
            C.ratio(F.sum("Revenue"), F.sum("Lines")).alias("AvgOrderValue"),
            F.sum("Units").alias("TotalQuantity"),
        )
        .orderBy(F.desc("TotalRevenue"), "Country")
    )


def countries_by_invoices(frame: DataFrame, except_home: str | None = None) -> DataFrame:
    """Distinct customers and orders by country, with revenue per customer.

    ``except_home`` leaves the home market out (X9).
    """
    rows = measured(frame)
    if except_home is not None:
        rows = rows.filter(F.col("Country") != except_home)
    return (
        rows.groupBy("Country")
        .agg(
            distinct_count(frame, "CustomerID").alias("TotalCustomers"),
            distinct_count(frame, "InvoiceNo").alias("TotalOrders"),
            F.sum("Units").alias("TotalQuantity"),
            C.as_double(F.sum("Revenue")).alias("TotalRevenue"),
            C.ratio(F.sum("Revenue"), F.sum("Lines")).alias("AvgOrderValue"),
            C.ratio(F.sum("Revenue"), distinct_count(frame, "CustomerID")).alias("RevenuePerCustomer"),
        )
        .orderBy(F.desc("TotalRevenue"), "Country")
    )


def customers_per_region(frame: DataFrame, regions: DataFrame) -> DataFrame:
    """Distinct customers by region (X9). ``regions`` maps each Country to a Region.

    Customers are made distinct per country first, so the join sees customers instead of lines.
    """
    buyers = frame.select("Country", "CustomerID").distinct()
    return (
        buyers.join(regions, "Country", "left")
        .groupBy("Region")
        .agg(F.count_distinct("CustomerID").alias("TotalCustomers"))
        .orderBy("Region")
    )
