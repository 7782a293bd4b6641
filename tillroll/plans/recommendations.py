"""The basket run: product associations and recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.operators import baskets, clean
from tillroll.runtime import scratch
from tillroll.sources.store import ResultStore


def run_recommendations(
    raw: DataFrame, store: ResultStore, min_support: float = 0.01, min_confidence: float = 0.2, top_n: int = 100
) -> tuple[DataFrame, DataFrame]:
    """Write the top pairs and the top rules and return both.

    The needed columns are written out once, because mining and the descriptions both read them.
    """
    with scratch(raw.sparkSession):
        lines = store.write(clean.basket_lines(raw).select("InvoiceNo", "StockCode", "Description"), "basket_lines")
        mined = baskets.mine(lines, min_support, min_confidence)
        itemsets = store.write(mined.itemsets, "frequent_itemsets")
        pairs = store.write(baskets.item_pairs(itemsets, lines, top_n), "product_associations")
        rules = store.write(baskets.product_rules(mined.rules, lines, top_n), "product_recommendations")
        return pairs, rules
