"""The shopper run: segmented customers and segment statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.functions.columns import ANY_LAYOUT
from tillroll.operators import clean, customers
from tillroll.plans.ledger import ROWS_PER_FILE
from tillroll.runtime import scratch
from tillroll.sources.store import ResultStore


def segment_shoppers(raw: DataFrame, layout: clean.Layout = ANY_LAYOUT, ids_as_read: bool = False) -> DataFrame:
    """Customers with scores, segment and cluster number."""
    base = customers.shopper_base(clean.shopper_lines(raw, layout, ids_as_read))
    return customers.shopper_segments(customers.shopper_scores(base))


def run_segmentation(
    raw: DataFrame, store: ResultStore, layout: clean.Layout = ANY_LAYOUT, ids_as_read: bool = False
) -> DataFrame:
    """Write both results; return the statistics. They are computed from the customers as written."""
    with scratch(raw.sparkSession):
        customers_by_id = segment_shoppers(raw, layout, ids_as_read)
        segmented = store.write(customers_by_id, "customer_clusters", sort_by=("CustomerID",), rows_per_file=ROWS_PER_FILE)
        return store.write(customers.cluster_statistics(segmented), "cluster_statistics")
