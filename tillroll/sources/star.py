
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schema import RAW_COLUMNS

_PART_COLUMNS = {"Description": "p_name", "Brand": "p_brand", "PType": "p_type"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def star_lines(spark: SparkSession, folder: str, columns: tuple[str, ...] = RAW_COLUMNS) -> DataFrame:
    """Raw invoice lines with the wanted columns; Brand and PType are coarser product codes.

    Dimensions are joined only when a wanted column needs them. Their keys are unique and the joins are left
    joins, so leaving one out never changes the rows. Orders get their country before they meet the line items, so
    the line items are shuffled once. Returned lines become cancelled invoices with negative
    quantity, every twentieth customer number is missing, and the time of day comes from the order number.
    """
    wanted = set(columns)
    lines = table(spark, folder, "lineitem")
    if wanted & {"InvoiceDate", "CustomerID", "Country"}:
        headers = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if "Country" in wanted:
            customers, nations = table(spark, folder, "customer"), table(spark, folder, "nation")
            homes = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            headers = headers.join(
                homes.select("c_custkey", "n_name"), F.col("o_custkey") == F.col("c_custkey"), "left"
            )
        lines = lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if wanted & set(_PART_COLUMNS):
        parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")

    returned = F.col("l_returnflag") == "R"
    minutes = F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    expressions = {
        "InvoiceNo": F.concat(F.when(returned, "C").otherwise(""), F.col("l_orderkey").cast("string")),
        "StockCode": F.col("l_partkey").cast("string"),
        "Quantity": F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int"),
        "InvoiceDate": F.col("o_orderdate").cast("timestamp") + minutes,
        "UnitPrice": F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100,
        "CustomerID": F.when(F.col("o_custkey") % 20 != 0, F.col("o_custkey").cast("double")),
        "Country": F.col("n_name"),
        **{name: F.col(source) for name, source in _PART_COLUMNS.items()},
    }
    return lines.select(*[expressions[c].alias(c) for c in columns])


def star_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Country to region, one row per country."""
    return (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(F.col("n_name").alias("Country"), F.col("r_name").alias("Region"))
    )
