"""The ledger run: clean fact, nine reports, the invoice table and a summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillroll.functions.columns import ISO_LAYOUT
from tillroll.operators import clean, customers, geography, products, quality, revenue, rollups
from tillroll.operators.positions import numbered
from tillroll.runtime import cut, scratch
from tillroll.sources.store import ResultStore

FACT = "processed_data"
INVOICES = "invoice_rollup"
ROWS_PER_FILE = 200_000  # of results that are read by page


def write_fact(raw: DataFrame, store: ResultStore, layout: clean.Layout = ISO_LAYOUT) -> tuple[DataFrame, DataFrame]:
    """Write the fact by year and month; return it read back, and the one-row summary of the run.

    The raw lines are read once: the summary is observed in the last stage of the write, on the rows of an aggregate that
    also counts the lines left out, so a lost executor changes none of it.
    """
    seen = Observation("ledger")

    def finish(rows: DataFrame) -> DataFrame:
        return rows.observe(seen, *quality.summary_metrics()).filter(F.col("Kind") == clean.MERGED).drop("Kind", "Lines")

    fact = store.write(clean.ledger_lines_counted(raw, layout), FACT, ("Year", "Month"), finish)
    return fact, quality.observed_summary(raw.sparkSession, seen.get)


def run_ledger(raw: DataFrame, store: ResultStore, layout: clean.Layout = ISO_LAYOUT) -> DataFrame:
    """Write the fact and every report; return the one-row summary.

    The source is read and cleaned once. The invoice table holds the place of each invoice by amount and is laid out by it. All reports but the product ones start from an invoice roll-up written next to the fact, and
    the five reports by time or country from sums that one pass over it makes. Intermediates are removed at the end.
    """
    with scratch(raw.sparkSession):
        fact, summary = write_fact(raw, store, layout)
        invoices = store.write(rollups.invoice_rollup(fact), INVOICES)
        grains = cut(rollups.report_grains(invoices))
        by_month = rollups.of_grain(grains, "month")
        store.write(revenue.monthly_by_lines(by_month), "monthly_revenue")
        store.write(revenue.weekday_by_lines(rollups.of_grain(grains, "weekday")), "daily_revenue")
        store.write(revenue.hourly_by_lines(rollups.of_grain(grains, "hour")), "hourly_revenue")
        store.write(geography.countries_by_lines(rollups.of_grain(grains, "country")), "country_performance")
        store.write(revenue.monthly_totals(by_month), "monthly_trend")
        sums = cut(products.per_product(fact))
        store.write(products.top_by_quantity(sums), "top_products_quantity")
        store.write(products.top_by_revenue(sums), "top_products_revenue")
        rfm = store.write(customers.rfm_by_lines(invoices), "customer_rfm")
        store.write(customers.segment_statistics(rfm), "customer_segments")
        placed = numbered(rollups.invoice_transactions(invoices), F.desc("TotalAmount"), "InvoiceNo", "CustomerID", "Country")
        store.write(placed, "transactions", sort_by=("Position",), rows_per_file=ROWS_PER_FILE)
    return summary
