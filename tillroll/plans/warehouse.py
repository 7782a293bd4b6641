"""The member run: a database with the clean fact and ten report tables, each created unless it exists."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame

from tillroll.functions.columns import ISO_LAYOUT
from tillroll.operators import baskets, clean, customers, geography, products, revenue, rollups
from tillroll.runtime import cut, scratch
from tillroll.sources.store import create_if_absent, use_database


def build_warehouse(
    raw: DataFrame, database: str, layout: clean.Layout = ISO_LAYOUT, partition_by: tuple[str, ...] = (), buckets: int = 0
) -> list[str]:
    """Create the tables in ``database`` and return their names. Nothing is computed for a table that exists.

    With ``buckets`` the fact is bucketed and sorted by invoice: the roll-up, baskets, pairs and merging start without moving lines.
    The roll-up is written once, for the first table that needs it: a report then reads its own columns, in tasks by size. Held in memory it
    had a task for every shuffle partition in each report, and its blocks compete with the work of the reports.
    """
    spark = raw.sparkSession
    use_database(spark, database)
    fact = create_if_absent(
        spark, "transactions", lambda: clean.member_lines(raw, layout), partition_by, buckets, ("InvoiceNo",), clean.LINE_KEY
    )

    @cache
    def invoices() -> DataFrame:
        return cut(rollups.invoice_rollup(fact))

    with scratch(spark):
        reports = {
            "monthly_revenue": lambda: revenue.monthly_by_invoices(invoices()),
            "daily_revenue": lambda: revenue.weekday_by_invoices(invoices()),
            "hourly_revenue": lambda: revenue.hourly_by_invoices(invoices()),
            "top_products_by_quantity": lambda: products.top_codes_by_quantity(fact),
            "top_products_by_revenue": lambda: products.top_codes_by_revenue(fact),
            "country_performance": lambda: geography.countries_by_invoices(invoices()),
            "monthly_trend": lambda: revenue.monthly_trend(invoices()),
        }
        for name, report in reports.items():
            create_if_absent(spark, name, report)
        rfm = create_if_absent(spark, "customer_rfm", lambda: customers.rfm_by_invoices(invoices()))
        create_if_absent(spark, "customer_segments", lambda: customers.segment_statistics_by_value(rfm))
        create_if_absent(spark, "basket_analysis", lambda: baskets.top_line_pairs(fact))
    return ["transactions", *reports, "customer_rfm", "customer_segments", "basket_analysis"]
