"""Data-quality profiles (Q1-Q5) and the run summary (S13), each in one pass over the lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.operators.clean import MERGED, REJECTED
from tillroll.schema import RAW_COLUMNS


def _long_form(counts: DataFrame, name: str, value: str) -> DataFrame:
    """One row of counts to one row per count."""
    return counts.unpivot([], counts.columns, name, value)


def null_counts(raw: DataFrame) -> DataFrame:
    """Missing values per column (Q1)."""
    counts = raw.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in raw.columns])
    return _long_form(counts, "ColumnName", "NullCount")


def lines_without_customer(raw: DataFrame, rows: int = 5) -> DataFrame:
    """Some lines whose customer is missing, in a stated order (Q2)."""
    order = [c for c in RAW_COLUMNS if c != "CustomerID"]
    return raw.filter(F.col("CustomerID").isNull()).orderBy(*order).limit(rows)


def suspicious_counts(raw: DataFrame) -> DataFrame:
    """Negative quantities, negative prices and cancelled invoices (Q3)."""
    return raw.agg(
        F.count_if(F.col("Quantity") < 0).alias("NegativeQuantity"),
        F.count_if(F.col("UnitPrice") < 0).alias("NegativePrice"),
        F.count_if(C.is_cancelled(F.col("InvoiceNo"))).alias("CancelledLines"),
    )


def removal_report(raw: DataFrame) -> DataFrame:
    """Rows each cleaning rule removes when the rules run in order, and what stays (Q4)."""
    rules = [
        ("cancelled invoice", C.is_cancelled(F.col("InvoiceNo"))),
        ("missing customer", F.col("CustomerID").isNull()),
        ("quantity not positive", ~(F.col("Quantity") > 0)),
        ("price not positive", ~(F.col("UnitPrice") > 0)),
        ("not a product code", ~F.col("StockCode").rlike("^[0-9]")),
    ]
    # A rule that cannot be decided for a row removes it, as a filter on the opposite would.
    hit = F.lit("kept")
    for name, rule in reversed(rules):
        hit = F.when(F.coalesce(rule, F.lit(True)), F.lit(name)).otherwise(hit)
    counts = raw.select(hit.alias("hit")).agg(
        F.count("*").alias("rows read"),
        *[F.count_if(F.col("hit") == name).alias(name) for name, _ in rules],
        F.count_if(F.col("hit") == "kept").alias("rows kept"),
    )
    listed = counts.withColumn("all", F.col("rows read")).unpivot(["all"], counts.columns, "Step", "LineCount")
    return listed.select("Step", "LineCount", C.percent(F.col("LineCount"), F.col("all"), 2).alias("PercentOfRead"))


def _broken_rules(layout: str | Sequence[str]) -> dict[str, Column]:
    required = ("InvoiceNo", "StockCode", "Quantity", "UnitPrice", "CustomerID")
    numbers = {"Quantity": "int", "UnitPrice": "double", "CustomerID": "int"}
    missing = {f"{c} is missing": F.col(c).isNull() for c in required}
    odd = {
        f"{c} is not {kind}": F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").try_cast(kind).isNull()
        for c, kind in numbers.items()
    }
    when = F.col("InvoiceDate")
    read = F.coalesce(when.try_cast("timestamp"), C.parse_time(when.cast("string"), layout))
    return {**missing, **odd, "InvoiceDate is not timestamp": when.isNotNull() & read.isNull()}


def rule_violations(raw: DataFrame, layout: str | Sequence[str] = C.ANY_LAYOUT) -> DataFrame:
    """Rows that break each required-field or type rule (Q5). Dates are those that a cast or one of the layouts reads."""
    counts = raw.agg(*[F.count_if(rule).alias(name) for name, rule in _broken_rules(layout).items()])
    return _long_form(counts, "Rule", "Violations")


def run_summary(raw: DataFrame, merged: DataFrame) -> DataFrame:
    """Lines read, lines kept by the ledger rules, lines after merging, and revenue (S13), by reading both frames."""
    kept = (F.col("Quantity") > 0) & (F.col("UnitPrice") > 0) & ~C.is_cancelled(F.col("InvoiceNo"))
    counts = raw.agg(F.count("*").alias("RawLines"), F.count_if(kept).alias("CleanLines"))
    totals = merged.agg(F.struct(F.count("*").alias("lines"), F.sum("TotalAmount").alias("amount"))).scalar()
    return counts.select(
        "RawLines",
        "CleanLines",
        totals["lines"].alias("MergedLines"),
        C.as_double(totals["amount"]).alias("TotalRevenue"),
    )


def summary_metrics() -> list[Column]:
    """The run summary as metrics over ``clean.ledger_lines_counted``, to be observed while the fact is written."""
    merged = F.col("Kind") == MERGED
    return [
        F.coalesce(F.sum("Lines"), F.lit(0)).alias("RawLines"),
        F.coalesce(F.sum(F.when(F.col("Kind") != REJECTED, F.col("Lines"))), F.lit(0)).alias("CleanLines"),
        F.count_if(merged).alias("MergedLines"),
        F.sum(F.when(merged, F.col("TotalAmount"))).alias("TotalRevenue"),
    ]


def observed_summary(spark: SparkSession, metrics: Mapping[str, object]) -> DataFrame:
    """The one-row summary of observed ``summary_metrics``."""
    schema = "RawLines long, CleanLines long, MergedLines long, TotalRevenue decimal(38,2)"
    row = spark.createDataFrame([tuple(metrics[c] for c in ("RawLines", "CleanLines", "MergedLines", "TotalRevenue"))], schema)
    return row.withColumn("TotalRevenue", C.as_double(F.col("TotalRevenue")))
