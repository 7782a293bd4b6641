"""Recency, frequency and monetary value of customers, scores and segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.operators.rollups import measured
from tillroll.operators.tiles import add_tiles
from tillroll.runtime import cut
from tillroll.schema import MONEY

_SCORES = {"R_Score": ("Recency", True), "F_Score": ("Frequency", False), "M_Score": ("Monetary", False)}
_BUYER = ("CustomerID", "Country")

# Cluster number of each segment of the eight-label ladder, and of any other label.
CLUSTER_IDS = {
    "Champions": 0,
    "Loyal Customers": 1,
    "Big Spenders": 2,
    "New Customers": 3,
    "Regular": 4,
    "At Risk": 5,
    "Hibernating": 6,
    "Lost Customers": 7,
}
OTHER_CLUSTER = 8

CLUSTER_COLUMNS = (
    "CustomerID",
    "Country",
    "Recency",
    "Frequency",
    "Monetary",
    "AvgOrderValue",
    "UniqueProducts",
    "R_Score",
    "F_Score",
    "M_Score",
    "RFM_Score",
    "Segment",
    "Cluster",
)


def _scores() -> tuple[Column, Column, Column]:
    return F.col("R_Score"), F.col("F_Score"), F.col("M_Score")


def _first_match(rungs: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """Label of the first condition that holds."""
    label = F.lit(otherwise)
    for condition, name in reversed(rungs):
        label = F.when(condition, name).otherwise(label)
    return label


def six_label_segment() -> Column:
    """Ladder of the ledger and member variants."""
    r, f, m = _scores()
    return _first_match(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers"),
            ((r >= 4) & (f <= 2), "New Customers"),
            ((r <= 2) & (f >= 3), "At Risk"),
            ((r <= 2) & (f <= 2) & (m <= 2), "Lost"),
        ],
        "Regular",
    )


def eight_label_segment() -> Column:
    """Ladder of the shopper variant."""
    r, f, m = _scores()
    return _first_match(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((r >= 4) & (f >= 3), "Loyal Customers"),
            ((r >= 4) & (f <= 2), "New Customers"),
            ((r <= 2) & (f >= 4) & (m >= 4), "At Risk"),
            ((r <= 2) & (f <= 2), "Lost Customers"),
            ((r >= 3) & (m >= 4), "Big Spenders"),
            ((r <= 2) & (f >= 3), "Hibernating"),
        ],
        "Regular",
    )


def documented_segment() -> Column:
    """The documented ladder with Potential Loyalist and Recent Customers (X6). High is 4 or 5, low is 1 or 2."""
    r, f, m = _scores()
    return _first_match(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((r >= 4) & (f <= 2) & (m >= 4), "Potential Loyalist"),
            ((f >= 4) & (m >= 4), "Loyal Customers"),
            (r >= 4, "Recent Customers"),
            ((r <= 2) & (f >= 4), "At Risk"),
            ((r <= 2) & (f <= 2) & (m <= 2), "Lost"),
        ],
        "Regular",
    )


def _per_buyer(frame: DataFrame, frequency: Column) -> DataFrame:
    """One row per customer and country, written out once because scoring reads it several times."""
    return cut(
        measured(frame)
        .groupBy(*_BUYER)
        .agg(
            frequency.alias("Frequency"),
            F.sum("Revenue").cast(MONEY).alias("Monetary"),
            F.max("LastPurchase").alias("LastPurchase"),
        )
    )


def _newest(buyers: DataFrame) -> Column:
    """Latest purchase of all, as a scalar subquery over the customer rows."""
    return buyers.agg(F.max("LastPurchase")).scalar()


def rfm_by_lines(frame: DataFrame) -> DataFrame:
    """Ledger variant: frequency counts lines, recency is elapsed whole days."""
    buyers = _per_buyer(frame, F.sum("Lines"))
    days = C.whole_days_between(F.col("LastPurchase"), _newest(buyers))
    scored = add_tiles(buyers.withColumn("Recency", F.coalesce(days, F.lit(0))), _SCORES, _BUYER)
    clamped = scored.withColumns({name: C.within_scale(F.col(name)) for name in _SCORES})
    return clamped.withColumns(
        {"CustomerSegment": six_label_segment(), "Monetary": F.col("Monetary").cast("double")}
    )


def rfm_by_invoices(frame: DataFrame) -> DataFrame:
    """Member variant: frequency counts distinct invoices, recency is calendar days."""
    buyers = _per_buyer(frame, F.count_distinct("InvoiceNo"))
    days = F.datediff(_newest(buyers), F.col("LastPurchase"))
    scored = add_tiles(buyers.withColumn("Recency", days).drop("LastPurchase"), _SCORES, _BUYER)
    return scored.withColumns(
        {
            "RFM_Score": sum(_scores(), F.lit(0)),
            "RFM_Segment": C.score_digits(*_scores()),
            "CustomerSegment": six_label_segment(),
            "Monetary": F.col("Monetary").cast("double"),
        }
    )


def _averages(digits: int) -> list[Column]:
    return [
        C.ratio(F.sum(F.col("Monetary").cast(MONEY)), F.count("Monetary")).alias("AvgMonetary"),
        C.count_ratio(F.sum("Frequency"), F.count("Frequency"), digits).alias("AvgFrequency"),
        C.count_ratio(F.sum("Recency"), F.count("Recency"), digits).alias("AvgRecency"),
    ]


def segment_statistics(rfm: DataFrame) -> DataFrame:
    """Size and averages of each segment, largest first."""
    stats = rfm.groupBy("CustomerSegment").agg(F.count("*").alias("CustomerCount"), *_averages(2))
    return stats.orderBy(F.desc("CustomerCount"), "CustomerSegment")


def segment_statistics_by_value(rfm: DataFrame) -> DataFrame:
    """Size, averages and total of each segment, most valuable first (C4)."""
    total = C.as_double(F.sum(F.col("Monetary").cast(MONEY))).alias("TotalMonetary")
    stats = rfm.groupBy("CustomerSegment").agg(F.count("*").alias("CustomerCount"), *_averages(2), total)
    return stats.orderBy(F.desc("TotalMonetary"), "CustomerSegment")


def shopper_base(lines: DataFrame, min_invoices: int = 2) -> DataFrame:
    """Shopper variant: one row per customer with at least two invoices.

    Lines are summed per invoice first, so the text maximum and the distinct count run on invoices; distinct
    products come from their own narrow aggregate. Both end partitioned by customer, so joining them adds no
    shuffle. Recency is measured from the latest date of all customers, including those dropped afterwards.
    """
    invoices = lines.groupBy("CustomerID", "InvoiceNo", "Country").agg(
        F.sum("TotalAmount").alias("amount"),
        F.count("TotalAmount").alias("lines"),
        F.max("InvoiceDate").alias("last"),
    )
    shoppers = invoices.groupBy("CustomerID").agg(
        F.max("Country").alias("Country"),
        F.max("last").alias("LastPurchase"),
        F.count_distinct("InvoiceNo").alias("Frequency"),
        F.sum("amount").cast("decimal(28,10)").alias("amount"),
        F.sum("lines").alias("lines"),
    )
    products = (
        lines.select("CustomerID", "StockCode").distinct().groupBy("CustomerID").agg(F.count("StockCode").alias("UniqueProducts"))
    )
    joined = cut(shoppers.join(products, "CustomerID"))
    return joined.filter(F.col("Frequency") >= min_invoices).select(
        "CustomerID",
        "Country",
        F.datediff(_newest(joined), F.col("LastPurchase")).alias("Recency"),
        "Frequency",
        C.as_double(F.col("amount")).alias("Monetary"),
        C.ratio(F.col("amount"), F.col("lines")).alias("AvgOrderValue"),
        "UniqueProducts",
    )


def shopper_scores(base: DataFrame) -> DataFrame:
    """Scores 1-5 per metric and their sum."""
    return add_tiles(base, _SCORES, ("CustomerID",)).withColumn("RFM_Score", sum(_scores(), F.lit(0)))


def shopper_segments(scored: DataFrame) -> DataFrame:
    """Segment and cluster number of each customer."""
    pairs = [F.lit(v) for item in CLUSTER_IDS.items() for v in item]
    cluster = F.coalesce(F.element_at(F.create_map(*pairs), F.col("Segment")), F.lit(OTHER_CLUSTER))
    labelled = scored.withColumn("Segment", eight_label_segment()).withColumn("Cluster", cluster)
    return labelled.select(*CLUSTER_COLUMNS)


def cluster_statistics(segmented: DataFrame) -> DataFrame:
    """Size, averages and revenue of each segment, most revenue first."""
    total = C.as_double(F.sum(F.col("Monetary").cast(MONEY))).alias("TotalRevenue")
    stats = segmented.groupBy("Segment", "Cluster").agg(F.count("*").alias("CustomerCount"), *_averages(1), total)
    return stats.orderBy(F.desc("TotalRevenue"), "Segment")


def top_spenders(lines: DataFrame, top_n: int = 10) -> DataFrame:
    """Customers by spend, with distinct orders and products."""
    spent = lines.groupBy(*_BUYER).agg(C.as_double(F.sum("TotalAmount")).alias("TotalSpent"))
    top = cut(spent.orderBy(F.desc("TotalSpent"), *_BUYER).limit(top_n)).withColumnsRenamed(
        {"CustomerID": "id", "Country": "home"}
    )
    # Distinct counts repeat their rows, so they run on the lines of the ranked customers only.
    same = F.col("CustomerID").eqNullSafe(F.col("id")) & F.col("Country").eqNullSafe(F.col("home"))
    counted = lines.join(top, same).groupBy(*_BUYER, "TotalSpent").agg(
        F.count_distinct("InvoiceNo").alias("TotalOrders"), F.count_distinct("StockCode").alias("UniqueProducts")
    )
    columns = (*_BUYER, "TotalOrders", "TotalSpent", "UniqueProducts")
    return counted.select(*columns).orderBy(F.desc("TotalSpent"), *_BUYER)


# What a segment means for the shop; callers may pass their own texts.
SEGMENT_NOTES = {
    "Champions": "Recent, frequent and high spend. Reward and keep.",
    "Loyal Customers": "Recent with good frequency. Offer more of what they buy.",
    "Big Spenders": "High spend, average frequency. Give reasons to return.",
    "At Risk": "Once frequent with high spend, now quiet. Contact soon.",
    "Lost Customers": "Quiet, rare and low. Contact only if it costs little.",
}
OTHER_NOTE = "No particular pattern. Watch for a change of group."


def segment_notes(spark: SparkSession, notes: Mapping[str, str] = SEGMENT_NOTES) -> DataFrame:
    """The notes as a small table."""
    return spark.createDataFrame(list(notes.items()), "Segment string, Note string")


def with_segment_note(
    customers: DataFrame, notes: Mapping[str, str] = SEGMENT_NOTES, other: str = OTHER_NOTE
) -> DataFrame:
    """Customers with the note of their segment (V14). The note table has a row per entry of ``notes``."""
    table = F.broadcast(segment_notes(customers.sparkSession, notes))
    noted = customers.join(table, "Segment", "left")
    return noted.withColumn("Note", F.coalesce("Note", F.lit(other)))
