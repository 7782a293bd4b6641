"""Cleaning rules.

Four rule sets exist side by side because they give different rows:

=========  ==================  =========  ==========  ===============
rule set   missing customers   cancelled  price > 0   repeated lines
=========  ==================  =========  ==========  ===============
ledger     kept as "unknown"   dropped    yes         merged
member     dropped             dropped    yes         kept
shopper    kept as "unknown"   kept       yes         kept
basket     kept                dropped    no          kept
=========  ==================  =========  ==========  ===============
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.runtime import cut
from tillroll.schema import MONEY
from tillroll.sources.lines import with_times

Layout = str | Sequence[str]

LINE_KEY = ("InvoiceNo", "StockCode")
# What identifies the first of several lines with one key, most significant first. The description comes last, so that leaving it out
# changes nothing else.
_FIRST_BY = ("InvoiceDate", "UnitPrice", "CustomerID", "Country", "Description")


def _sold(raw: DataFrame) -> DataFrame:
    return raw.filter((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0))


def _priced(lines: DataFrame) -> DataFrame:
    """Rounded line amount and calendar columns; the price stays as read."""
    amount = F.round(C.line_amount(F.col("Quantity"), F.col("UnitPrice")), 2).cast(MONEY)
    return lines.withColumns(
        {
            "TotalAmount": amount,
            **C.calendar_of(F.col("InvoiceDate")),
        }
    )


def ledger_lines_unmerged(raw: DataFrame, layout: Layout = C.ISO_LAYOUT) -> DataFrame:
    """The ledger rules before repeated lines are merged."""
    return _ledger_columns(_sold(raw).filter(~C.is_cancelled(F.col("InvoiceNo"))), layout)


def _ledger_columns(kept: DataFrame, layout: Layout) -> DataFrame:
    named = with_times(kept, layout).withColumn("CustomerID", C.customer_or_unknown(F.col("CustomerID")))
    if "Description" in kept.columns:
        named = named.withColumn("Description", C.tidy_text(F.col("Description")))
    return _priced(named)


def _first_by(lines: DataFrame) -> list[str]:
    return [c for c in _FIRST_BY if c in lines.columns]


def first_line_per_key(lines: DataFrame) -> DataFrame:
    """One row per (InvoiceNo, StockCode): the earliest line, ties by price and text.

    An aggregate over a struct needs one shuffle and combines before it, so one key holding most of the rows
    does not gather them in one task the way a row_number window would.
    """
    first = F.min(F.struct(*_first_by(lines))).alias("first")
    return lines.filter(F.col("StockCode").isNotNull()).groupBy(*LINE_KEY).agg(first).select(*LINE_KEY, "first.*")


def key_totals(lines: DataFrame) -> DataFrame:
    """Quantity and amount per (InvoiceNo, StockCode)."""
    return lines.groupBy(*LINE_KEY).agg(
        F.sum("Quantity").alias("TotalQuantity"), F.sum("TotalAmount").cast(MONEY).alias("TotalAmountSum")
    )


def with_key_totals(lines: DataFrame) -> DataFrame:
    """Every line next to the totals of its key.

    The totals are written first: of a table's sizes adaptive execution knows enough to split a key with very many lines.
    """
    return lines.join(cut(key_totals(lines)), list(LINE_KEY), "inner")


def merge_repeats(lines: DataFrame) -> DataFrame:
    """Merge lines with one (InvoiceNo, StockCode): sums of quantity and amount, the rest from the first line.

    First line and totals come from the same aggregate, so there is one shuffle and no join. Lines without a
    stock code have no key and are dropped.
    """
    return _merged(lines.filter(F.col("StockCode").isNotNull()), LINE_KEY)


def _merged(lines: DataFrame, keys: Sequence[str], **more: Column) -> DataFrame:
    merged = (
        lines.groupBy(*keys)
        .agg(
            F.min(F.struct(*_first_by(lines))).alias("first"),
            F.sum("Quantity").alias("Quantity"),
            F.sum("TotalAmount").cast(MONEY).alias("TotalAmount"),
            *[measure.alias(name) for name, measure in more.items()],
        )
        .select(*keys, "first.*", "Quantity", "TotalAmount", *more)
    )
    return merged.withColumns(C.calendar_of(F.col("InvoiceDate")))


REJECTED, UNCODED, MERGED = 0, 1, 2


def ledger_lines_counted(raw: DataFrame, layout: Layout = C.ISO_LAYOUT) -> DataFrame:
    """The rows of ``ledger_lines``, with ``Kind`` MERGED, and two more that stand for the lines left out, REJECTED by a rule or UNCODED.

    ``Lines`` is the raw lines behind a row. Lines left out lose their values and are counted before the shuffle, so they cost
    a row for each task. The counts are those of the aggregate's result: a task that runs twice does not count twice.
    """
    kept = (F.col("Quantity") > 0) & (F.col("UnitPrice") > 0) & ~C.is_cancelled(F.col("InvoiceNo"))
    kind = F.when(~F.coalesce(kept, F.lit(False)), REJECTED).when(F.col("StockCode").isNull(), UNCODED).otherwise(MERGED)
    marked = raw.withColumn("Kind", kind)
    blank = marked.select("Kind", *[F.when(F.col("Kind") == MERGED, F.col(c)).alias(c) for c in raw.columns])
    # The kind comes last: lines are sorted by key, and of almost equal kinds the first column would decide no comparison.
    return _merged(_ledger_columns(blank, layout), (*LINE_KEY, "Kind"), Lines=F.count("*"))


def ledger_lines(raw: DataFrame, layout: Layout = C.ISO_LAYOUT) -> DataFrame:
    """Clean fact with unknown customers kept and repeated lines merged (D2). Lines read without a description give a fact without."""
    return merge_repeats(ledger_lines_unmerged(raw, layout))


def member_lines(raw: DataFrame, layout: Layout = C.ISO_LAYOUT) -> DataFrame:
    """Clean fact of known customers only, one row per raw line (D3)."""
    named = _sold(raw).withColumn("CustomerID", C.customer_text(F.col("CustomerID")))
    kept = named.filter(F.col("CustomerID").isNotNull() & ~C.is_cancelled(F.col("InvoiceNo")))
    return _priced(with_times(kept, layout))


def shopper_lines(raw: DataFrame, layout: Layout = C.ANY_LAYOUT, ids_as_read: bool = False) -> DataFrame:
    """Lines for customer segmentation: only quantity and price decide (D4). Amounts are not rounded.

    ``ids_as_read`` keeps the customer number as its column prints it ("17850.0" for a double).
    """
    customer = F.col("CustomerID")
    label = F.coalesce(customer.cast("string"), F.lit(C.UNKNOWN)) if ids_as_read else C.customer_or_unknown(customer)
    return with_times(_sold(raw), layout).withColumns(
        {
            "TotalAmount": C.line_amount(F.col("Quantity"), F.col("UnitPrice")),
            "CustomerID": label,
        }
    )


def basket_lines(raw: DataFrame) -> DataFrame:
    """Lines for basket mining: invoice and stock code known, quantity positive, not cancelled."""
    return raw.filter(
        F.col("InvoiceNo").isNotNull()
        & F.col("StockCode").isNotNull()
        & (F.col("Quantity") > 0)
        & ~C.is_cancelled(F.col("InvoiceNo"))
    )


def product_codes_only(lines: DataFrame) -> DataFrame:
    """Drop service codes such as POST; product codes start with a digit."""
    return lines.filter(F.col("StockCode").rlike("^[0-9]"))


def without_exact_copies(lines: DataFrame) -> DataFrame:
    """Drop rows equal in every column."""
    return lines.dropDuplicates()
