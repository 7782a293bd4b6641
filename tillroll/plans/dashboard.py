"""Dashboard reads over a result store."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators import customers, views
from tillroll.sources.store import ResultStore


@dataclass(frozen=True)
class Dashboard:
    """Each method returns the frames of one part of a page, all from the results that were current when it was called."""

    store: ResultStore

    def collections(self) -> list[str]:
        return self.store.names()

    def overview(self) -> tuple[DataFrame, DataFrame | None]:
        """Sizes, absent results counting 0, and customers per segment if there are any results of them."""
        now = self.store.snapshot()
        wanted = ("customer_clusters", "transactions", "top_products_quantity")
        tables = [now.read(name) if name in now.entries else self.store.spark.range(0) for name in wanted]
        split = views.segment_counts(tables[0]) if "customer_clusters" in now.entries else None
        return views.overview(*tables), split

    def first_customers(self, rows: int = 100) -> DataFrame:
        return views.first_rows(self.store.read("customer_clusters"), rows, "CustomerID")

    def first_countries(self, rows: int = 10) -> DataFrame:
        return views.first_rows(self.store.read("country_performance"), rows, F.desc("TotalRevenue"), "Country")

    def customers_after(self, customer_id: str, segment: str | None = None) -> DataFrame:
        return views.customers_after(self.store.read("customer_clusters"), customer_id, segment)

    def transactions_after(self, last: Mapping[str, object], descending: bool = True) -> DataFrame:
        return views.transactions_after(self.store.read("transactions"), last, descending)

    def front_products(self) -> DataFrame:
        return views.front_products(self.store.read("top_products_revenue"))

    def customers(self, page: int = 1, segment: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        table = self.store.read("customer_clusters")
        return (
            views.customers_page(table, page, segment),
            views.customers_page_count(table, segment),
            views.distinct_values(table, "Segment"),
        )

    def customer(self, customer_id: str) -> tuple[DataFrame, DataFrame]:
        now = self.store.snapshot()
        found = views.find_customer(now.read("customer_clusters"), customer_id)
        return customers.with_segment_note(found), views.find_customer(now.read("customer_rfm"), customer_id)

    def products(self, rows: int = 50) -> tuple[DataFrame, DataFrame]:
        now = self.store.snapshot()
        return (
            views.products_view(now.read("top_products_revenue"), "TotalRevenue", rows),
            views.products_view(now.read("top_products_quantity"), "TotalQuantity", rows),
        )

    def revenue(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        now = self.store.snapshot()
        return (
            views.monthly_view(now.read("monthly_revenue")),
            views.weekday_view(now.read("daily_revenue")),
            views.hourly_view(now.read("hourly_revenue")),
            now.read("monthly_trend").orderBy("Year", "Month"),
        )

    def countries(self) -> tuple[DataFrame, DataFrame]:
        table = self.store.read("country_performance")
        return views.countries_view(table), views.country_totals(table)

    def segments(self) -> tuple[DataFrame, DataFrame]:
        now = self.store.snapshot()
        counts = views.segment_counts(now.read("customer_clusters"))
        return counts, views.segment_view(now.read("cluster_statistics"))

    def recommendations(self) -> tuple[DataFrame, DataFrame]:
        now = self.store.snapshot()
        pairs = views.pairs_view(now.read("product_associations"))
        return pairs, views.rules_view(now.read("product_recommendations"))

    def transactions(self, page: int = 1, descending: bool = True) -> tuple[DataFrame, DataFrame]:
        table = self.store.read("transactions")
        return views.transactions_page(table, page, descending), views.page_count(table)

    def largest_transactions(self) -> tuple[DataFrame, DataFrame]:
        table = self.store.read("transactions")
        return views.hour_histogram(views.largest_by_hour(table)), views.largest_summary(table)
