"""Product rankings (R7-R10, R18, X2) and the product dimension (B2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.runtime import cut
from tillroll.schema import PRICE

_PRODUCT = ("StockCode", "Description")


def _revenue() -> Column:
    return C.as_double(F.sum("TotalAmount")).alias("TotalRevenue")


def _average_price() -> Column:
    return C.ratio(F.sum(F.col("UnitPrice").cast(PRICE)).cast("decimal(28,10)"), F.count("UnitPrice")).alias("AvgPrice")


def descriptions(lines: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """One description per stock code: the smallest that is not null.

    Equal pairs are removed first, which Spark does by hashing; a minimum over text would sort every line.
    ``codes`` (a bounded list of stock codes) limits the work to those products.
    """
    known = lines.filter(F.col("Description").isNotNull()).select(*_PRODUCT)
    if codes is not None:
        known = known.join(codes.select("StockCode"), "StockCode", "left_semi")
    return known.distinct().groupBy("StockCode").agg(F.min("Description").alias("Description"))


def _described(top: DataFrame, lines: DataFrame) -> DataFrame:
    """Add descriptions to a ranking that has been written out; its size decides whether it is broadcast."""
    return top.join(descriptions(lines, top), "StockCode", "left")


def _of_codes(lines: DataFrame, top: DataFrame) -> DataFrame:
    """Lines of the ranked codes only, for the distinct counts, which repeat their rows."""
    return lines.join(top.select("StockCode"), "StockCode", "left_semi")


def per_product(lines: DataFrame) -> DataFrame:
    """Sums per code and description, the shared input of both rankings below."""
    return lines.groupBy(*_PRODUCT).agg(
        _revenue(),
        F.sum("Quantity").alias("TotalQuantity"),
        F.count("InvoiceNo").alias("TotalOrders"),
        _average_price(),
    )


def top_by_quantity(products: DataFrame, top_n: int = 20) -> DataFrame:
    """Best sellers by quantity per code and description (R7), from ``per_product``."""
    return products.drop("AvgPrice").orderBy(F.desc("TotalQuantity"), *_PRODUCT).limit(top_n)


def top_by_revenue(products: DataFrame, top_n: int = 20) -> DataFrame:
    """Best sellers by revenue per code and description, with the average price (R8), from ``per_product``."""
    return products.orderBy(F.desc("TotalRevenue"), *_PRODUCT).limit(top_n)


def top_codes_by_quantity(lines: DataFrame, top_n: int = 50) -> DataFrame:
    """Best sellers by quantity per code, with distinct orders and customers."""
    sums = lines.groupBy("StockCode").agg(F.sum("Quantity").alias("TotalQuantity"), _revenue())
    top = cut(sums.orderBy(F.desc("TotalQuantity"), "StockCode").limit(top_n))
    counts = _of_codes(lines, top).groupBy("StockCode").agg(
        F.count_distinct("InvoiceNo").alias("TotalOrders"), F.count_distinct("CustomerID").alias("TotalCustomers")
    )
    ranked = _described(top, lines).join(counts, "StockCode")
    columns = ("StockCode", "TotalQuantity", "TotalOrders", "TotalCustomers", "TotalRevenue", "Description")
    return ranked.select(*columns).orderBy(F.desc("TotalQuantity"), "StockCode")


def top_codes_by_revenue(lines: DataFrame, top_n: int = 50) -> DataFrame:
    """Best sellers by revenue per code."""
    sums = lines.groupBy("StockCode").agg(_revenue(), F.sum("Quantity").alias("TotalQuantity"), _average_price())
    top = cut(sums.orderBy(F.desc("TotalRevenue"), "StockCode").limit(top_n))
    counts = _of_codes(lines, top).groupBy("StockCode").agg(F.count_distinct("InvoiceNo").alias("TotalOrders"))
    ranked = _described(top, lines).join(counts, "StockCode")
    columns = ("StockCode", "TotalRevenue", "TotalQuantity", "TotalOrders", "AvgPrice", "Description")
    return ranked.select(*columns).orderBy(F.desc("TotalRevenue"), "StockCode")


def repeat_purchases(lines: DataFrame, min_customers: int = 100, top_n: int = 20) -> DataFrame:
    """Products bought most often per customer, among those with enough customers."""
    top = (
        lines.groupBy("StockCode")
        .agg(F.count("*").alias("lines"), F.count_distinct("CustomerID").alias("UniqueCustomers"))
        .filter(F.col("UniqueCustomers") >= min_customers)
        .withColumn("AvgPurchasePerCustomer", F.col("lines") / F.col("UniqueCustomers"))
        .drop("lines")
        .orderBy(F.desc("AvgPurchasePerCustomer"), "StockCode")
        .limit(top_n)
    )
    return _described(cut(top), lines).orderBy(F.desc("AvgPurchasePerCustomer"), "StockCode")


def top_by_orders(lines: DataFrame, top_n: int = 20) -> DataFrame:
    """Products that occur in the most orders."""
    return (
        lines.groupBy("StockCode")
        .agg(F.count_distinct("InvoiceNo").alias("TotalOrders"), _revenue())
        .orderBy(F.desc("TotalOrders"), "StockCode")
        .limit(top_n)
    )
