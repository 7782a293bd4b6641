"""Read queries over the result tables (V1-V13). Inputs are results of the batch runs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.schema import MONEY

PER_PAGE = 20


def _ranked(rows: DataFrame, *order: str | Column, name: str = "Rank", start: int = 0) -> DataFrame:
    """Number the rows of a short result (W7). Only for results that a limit or a small group-by has bounded."""
    return rows.withColumn(name, F.row_number().over(Window.orderBy(*order)) + start)


def first_rows(table: DataFrame, rows: int, *order: str | Column) -> DataFrame:
    """The first rows in a stated order."""
    return table.orderBy(*order).limit(rows)


def last_rows(table: DataFrame, rows: int, by: str) -> DataFrame:
    """The last rows by a column, in ascending order."""
    return table.orderBy(F.desc(by)).limit(rows).orderBy(by)


def page(table: DataFrame, number: int, *order: str | Column, per_page: int = PER_PAGE) -> DataFrame:
    """One page of a sorted table (L3, L4)."""
    return table.orderBy(*order).offset((number - 1) * per_page).limit(per_page)


def placed_page(table: DataFrame, number: int, per_page: int = PER_PAGE, position: str = "Position") -> DataFrame:
    """One page of a table that holds the place of each row and is laid out by it (L3, V9).

    Files and row groups of other places are skipped by their statistics, so a page costs the same however deep it lies.
    """
    first = (number - 1) * per_page
    return table.filter((F.col(position) > first) & (F.col(position) <= first + per_page)).orderBy(position)


def next_page(table: DataFrame, keys: Mapping[str, bool], after: Mapping[str, object], per_page: int = PER_PAGE) -> DataFrame:
    """The page after a row of a table sorted by ``keys`` (column to whether it falls), by the values of that row.

    Unlike ``page`` it keeps one page per task however deep it lies. ``keys`` identify a row and hold no nulls.
    """
    past = F.lit(False)
    for column, falls in reversed(keys.items()):
        value = F.lit(after[column])
        beyond = F.col(column) < value if falls else F.col(column) > value
        past = beyond | ((F.col(column) == value) & past)
    order = [F.desc(c) if falls else F.asc(c) for c, falls in keys.items()]
    return table.filter(past).orderBy(*order).limit(per_page)


def page_count(table: DataFrame, per_page: int = PER_PAGE) -> DataFrame:
    """Number of rows and of pages."""
    counted = table.agg(F.count("*").alias("Total"))
    return counted.withColumn("TotalPages", F.ceil(F.col("Total") / per_page))


def distinct_values(table: DataFrame, column: str) -> DataFrame:
    """Values of a column."""
    return table.select(column).distinct().orderBy(column)


def overview(customers: DataFrame, transactions: DataFrame, top_products: DataFrame) -> DataFrame:
    """Sizes shown on the front page (V1). Products are those of the top list."""
    sizes = {"TotalCustomers": customers, "TotalTransactions": transactions, "TotalProducts": top_products}
    one = customers.sparkSession.range(1)
    return one.select(*[t.agg(F.count("*")).scalar().alias(name) for name, t in sizes.items()])


def front_products(top_products: DataFrame, rows: int = 5) -> DataFrame:
    """Best products with shortened names (V1)."""
    order = (F.desc("TotalRevenue"), "StockCode", "Description")
    top = _ranked(first_rows(top_products, rows, *order), *order)
    return top.select("Rank", "StockCode", C.shorten(F.col("Description"), 40).alias("ShortName"), "TotalRevenue")


def _in_segment(customers: DataFrame, segment: str | None) -> DataFrame:
    """Customers of one segment, or all when none is named."""
    return customers.filter(F.col("Segment") == segment) if segment else customers


def customers_page(customers: DataFrame, number: int = 1, segment: str | None = None) -> DataFrame:
    """One page of customers, by id (V2)."""
    return page(_in_segment(customers, segment), number, "CustomerID").withColumn("Badge", C.slug(F.col("Segment")))


def customers_after(customers: DataFrame, customer_id: str, segment: str | None = None) -> DataFrame:
    """The page of customers after an id (V2)."""
    rows = next_page(_in_segment(customers, segment), {"CustomerID": False}, {"CustomerID": customer_id})
    return rows.withColumn("Badge", C.slug(F.col("Segment")))


def customers_page_count(customers: DataFrame, segment: str | None = None) -> DataFrame:
    """Rows and pages behind ``customers_page`` (V2)."""
    return page_count(_in_segment(customers, segment))


def find_customer(table: DataFrame, customer_id: str) -> DataFrame:
    """At most one row of a customer; the smallest country when there are several (P10). Ids are compared without a decimal part."""
    plain = F.regexp_replace("CustomerID", r"\.0$", "")
    return table.filter(plain == customer_id.removesuffix(".0")).orderBy("Country").limit(1)


def customer_details(customers: DataFrame, rfm: DataFrame) -> DataFrame:
    """Segment row of each customer next to their row of the other scoring (V3).

    The second table can hold one row per country, of which the smallest country is taken, as ``find_customer``
    does. Ids are compared without a decimal part.
    """
    other = rfm.groupBy("CustomerID").agg(
        F.min(F.struct("Country", "R_Score", "F_Score", "M_Score", "CustomerSegment")).alias("rfm")
    )
    left = customers.withColumn("CustomerID", F.regexp_replace("CustomerID", r"\.0$", ""))
    return left.join(other, "CustomerID", "left").select(
        *customers.columns,
        F.col("rfm.R_Score").alias("OtherR"),
        F.col("rfm.F_Score").alias("OtherF"),
        F.col("rfm.M_Score").alias("OtherM"),
        F.col("rfm.CustomerSegment").alias("OtherSegment"),
    )


def products_view(top: DataFrame, by: str, rows: int = 50) -> DataFrame:
    """Ranked products by ``TotalRevenue`` or ``TotalQuantity`` with shortened names (V4)."""
    order = (F.desc(by), "StockCode", "Description")
    ranked = _ranked(first_rows(top, rows, *order), *order)
    return ranked.select("Rank", "StockCode", C.shorten(F.col("Description"), 35).alias("ShortName"), by)


def monthly_view(monthly: DataFrame) -> DataFrame:
    """Months with label, revenue per order and direction against the month before."""
    by_month = Window.orderBy("Year", "Month")
    before, now = F.lag("TotalRevenue").over(by_month), F.col("TotalRevenue")
    direction = F.when(now > before, "up").when(now < before, "down").otherwise("flat")
    orders = F.when(F.col("TotalOrders") > 0, F.col("TotalOrders")).otherwise(1)
    return monthly.select(
        C.month_label(F.col("Year"), F.col("Month")).alias("Label"),
        "TotalRevenue",
        "TotalOrders",
        C.ratio(now.cast(MONEY), orders).alias("RevenuePerOrder"),
        direction.alias("Trend"),
    ).orderBy("Label")


def weekday_view(daily: DataFrame) -> DataFrame:
    """Weekdays with their label, or a short one when it is missing (V5)."""
    short = C.weekday_name(F.col("DayOfWeek"), "vi-short")
    return last_rows(daily, 30, "DayOfWeek").select(
        "DayOfWeek", F.coalesce("DayName", short).alias("Label"), "TotalRevenue", "TotalOrders"
    )


def hourly_view(hourly: DataFrame) -> DataFrame:
    """Hours with label and a flag for the busy window from 10 to 14."""
    return hourly.select(
        "Hour",
        C.hour_label(F.col("Hour")).alias("Label"),
        "TotalRevenue",
        F.coalesce("Hour", F.lit(0)).between(10, 14).alias("Busy"),
    ).orderBy("Hour")


def countries_view(countries: DataFrame) -> DataFrame:
    """Countries by revenue with rank and share of the total."""
    order = (F.desc("TotalRevenue"), "Country")
    total = F.sum(F.col("TotalRevenue").cast(MONEY)).over(Window.partitionBy())
    shared = countries.withColumn("SharePercent", C.percent(F.col("TotalRevenue"), total))
    return _ranked(shared, *order).orderBy("Rank")


def country_totals(countries: DataFrame) -> DataFrame:
    """Number of countries, revenue and transactions (V6)."""
    return countries.agg(
        F.count("*").alias("Countries"),
        C.as_double(F.sum(F.col("TotalRevenue").cast(MONEY))).alias("TotalRevenue"),
        F.sum("TotalTransactions").alias("TotalTransactions"),
    )


def segment_counts(customers: DataFrame) -> DataFrame:
    """Customers per segment with their share, largest first."""
    counted = customers.groupBy("Segment").agg(F.count("*").alias("CustomerCount"))
    share = C.percent(F.col("CustomerCount"), F.sum("CustomerCount").over(Window.partitionBy()))
    return counted.withColumn("SharePercent", share).orderBy(F.desc("CustomerCount"), "Segment")


def segment_view(statistics: DataFrame) -> DataFrame:
    """Segment statistics with badge and share of revenue (V7)."""
    total = F.sum(F.col("TotalRevenue").cast(MONEY)).over(Window.partitionBy())
    return statistics.withColumns(
        {
            "Badge": C.slug(F.col("Segment")),
            "RevenuePercent": C.percent(F.col("TotalRevenue"), total),
        }
    ).orderBy(F.desc("TotalRevenue"), "Segment")


def pairs_view(pairs: DataFrame, rows: int = 100) -> DataFrame:
    """Pairs with support in percent (V8)."""
    order = (F.desc("CoOccurrence"), "StockCode1", "StockCode2")
    support = C.as_double(F.col("Support").cast("decimal(18,4)") * 100)
    return first_rows(pairs, rows, *order).withColumn("SupportPercent", support)


def rules_view(rules: DataFrame, rows: int = 100) -> DataFrame:
    """Rules with confidence in whole percent (V8)."""
    order = (F.desc("Confidence"), F.desc("Lift"), "SourceProduct", "RecommendedProduct")
    confidence = F.round(F.col("Confidence").cast("decimal(18,4)") * 100, 0).cast("int")
    return first_rows(rules, rows, *order).withColumn("ConfidencePercent", confidence)


def transactions_page(transactions: DataFrame, number: int = 1, descending: bool = True) -> DataFrame:
    """One page of invoices by amount with their running position (V9)."""
    amount = F.desc("TotalAmount") if descending else F.asc("TotalAmount")
    order = (amount, "InvoiceNo", "CustomerID", "Country")
    if "Position" in transactions.columns:
        if descending:
            return placed_page(transactions, number)
        transactions = transactions.drop("Position")
    return _ranked(page(transactions, number, *order), *order, name="Position", start=(number - 1) * PER_PAGE)


def transactions_after(transactions: DataFrame, last: Mapping[str, object], descending: bool = True) -> DataFrame:
    """The page of invoices after the last one seen, given by its amount, number, customer and country (V9)."""
    keys = {"TotalAmount": descending, "InvoiceNo": False, "CustomerID": False, "Country": False}
    return next_page(transactions, keys, last)


def _largest(transactions: DataFrame, rows: int) -> DataFrame:
    return first_rows(transactions, rows, F.desc("TotalAmount"), "InvoiceNo", "CustomerID", "Country")


def largest_by_hour(transactions: DataFrame, rows: int = 1000) -> DataFrame:
    """How the largest invoices spread over the hours."""
    top = _largest(transactions, rows)
    return top.groupBy(F.coalesce("Hour", F.lit(0)).alias("Hour")).agg(F.count("*").alias("Invoices")).orderBy("Hour")


def largest_summary(transactions: DataFrame, rows: int = 1000) -> DataFrame:
    """Peak hour, sum and average of the largest invoices; the earlier hour wins a tie."""
    money = F.col("TotalAmount").cast(MONEY)
    hours = _largest(transactions, rows).groupBy(F.coalesce("Hour", F.lit(0)).alias("Hour")).agg(
        F.count("*").alias("invoices"), F.sum(money).alias("amount")
    )
    peak = F.max_by("Hour", F.struct("invoices", -F.col("Hour")))
    return hours.agg(
        F.coalesce(peak, F.lit(0)).alias("PeakHour"),
        F.coalesce(C.as_double(F.sum("amount")), F.lit(0.0)).alias("TopTotal"),
        F.coalesce(C.ratio(F.sum("amount").cast(MONEY), F.sum("invoices")), F.lit(0.0)).alias("TopAverage"),
    )


def hour_histogram(by_hour: DataFrame) -> DataFrame:
    """All 24 hours with zero where nothing was sold, and a mark on the highest."""
    slots = by_hour.sparkSession.range(24).select(F.col("id").cast("int").alias("Hour"))
    filled = slots.join(by_hour, "Hour", "left").withColumn("Invoices", F.coalesce("Invoices", F.lit(0)))
    highest = F.max("Invoices").over(Window.partitionBy())
    return filled.select(
        "Hour", C.hour_label(F.col("Hour")).alias("Label"), "Invoices", (F.col("Invoices") == highest).alias("Peak")
    ).orderBy("Hour")
