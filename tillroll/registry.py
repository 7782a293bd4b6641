"""Every operator as a query over the star tables, by inventory id."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillroll.functions.columns import ANY_LAYOUT, ISO_LAYOUT, US_LAYOUT
from tillroll.operators import (
    baskets,
    clean,
    clusters,
    customers,
    geography,
    products,
    quality,
    revenue,
    rollups,
    views,
)
from tillroll.operators.positions import numbered
from tillroll.plans.dashboard import Dashboard
from tillroll.plans.intake import stage_lines
from tillroll.plans.ledger import run_ledger, write_fact
from tillroll.plans.recommendations import run_recommendations
from tillroll.plans.segmentation import run_segmentation
from tillroll.plans.warehouse import build_warehouse
from tillroll.runtime import cut, fresh_path
from tillroll.schema import RAW_COLUMNS
from tillroll.sources.lines import declare_external, read_lines, read_lines_inferred, with_times
from tillroll.sources.star import star_lines, star_regions
from tillroll.sources.store import ResultStore, as_view, bucket_count, create_if_absent, preview, table_names

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Everything but the description, whose table only some reports need; and without the country, which needs two more tables.
_BILLED = tuple(c for c in RAW_COLUMNS if c != "Description")
_SOLD = tuple(c for c in _BILLED if c != "Country")
_SEGMENT = "Champions"
_CUSTOMER = "7"
_HOME = "NATION_0"
PART_SUPPORT = 0.0002  # single parts are bought together rarely


def _plain(df: DataFrame) -> DataFrame:
    """Exact decimals leave as doubles, the type other engines compare without a scale."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in decimals})


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, folder: _plain(function(spark, folder))
        return function

    return register


# -- inputs ---------------------------------------------------------------------------------------------------------


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return star_lines(spark, folder)


def _described_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return clean.ledger_lines(_raw(spark, folder))


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    return clean.ledger_lines(star_lines(spark, folder, _BILLED))


def _member(spark: SparkSession, folder: str, columns: tuple[str, ...] = _BILLED) -> DataFrame:
    return clean.member_lines(star_lines(spark, folder, columns))


def _described_member(spark: SparkSession, folder: str) -> DataFrame:
    return clean.member_lines(_raw(spark, folder))


def _member_invoices(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.invoice_rollup(_member(spark, folder))


def _shopper(spark: SparkSession, folder: str) -> DataFrame:
    return clean.shopper_lines(star_lines(spark, folder, _BILLED))


def _coded(spark: SparkSession, folder: str, code: str, *more: str) -> DataFrame:
    """Member lines whose stock code is a coarser product code."""
    raw = star_lines(spark, folder, (*_SOLD, *more, code))
    return clean.member_lines(raw.withColumn("StockCode", F.col(code)).drop(code))


def _coded_raw(spark: SparkSession, folder: str, code: str) -> DataFrame:
    raw = star_lines(spark, folder, ("InvoiceNo", "StockCode", "Quantity", "Description", code))
    return raw.withColumn("StockCode", F.col(code)).drop(code)


def _basket(spark: SparkSession, folder: str, code: str = "PType") -> DataFrame:
    return clean.basket_lines(_coded_raw(spark, folder, code))


def _part_basket(spark: SparkSession, folder: str) -> DataFrame:
    return clean.basket_lines(star_lines(spark, folder, ("InvoiceNo", "StockCode", "Quantity", "Description")))


def _texts(spark: SparkSession, folder: str, pattern: str) -> str:
    """The raw lines as compressed CSV files with a header and dates as text; returns their folder.

    A compressed file is one task's work when it is read. It holds what one task wrote, which adaptive execution keeps to its partition size.
    """
    path = fresh_path(spark)
    lines = _raw(spark, folder).withColumn("InvoiceDate", F.date_format("InvoiceDate", pattern))
    lines.write.option("header", True).option("compression", "gzip").csv(path)
    return path


def _results(spark: SparkSession) -> ResultStore:
    return ResultStore(spark, fresh_path(spark))


def _segmented(spark: SparkSession, folder: str) -> DataFrame:
    base = customers.shopper_base(_shopper(spark, folder))
    return customers.shopper_segments(customers.shopper_scores(base))


def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.invoice_transactions(_ledger(spark, folder))


# -- cleaning -------------------------------------------------------------------------------------------------------

query("d1_merge_repeats")(lambda s, d: clean.merge_repeats(clean.ledger_lines_unmerged(_raw(s, d))))
query("d2_ledger_lines")(_described_ledger)
query("d3_member_lines")(_described_member)
query("d4_shopper_lines")(_shopper)
query("d5_basket_lines")(lambda s, d: clean.basket_lines(_raw(s, d)))
query("w1_first_line_per_key")(lambda s, d: clean.first_line_per_key(clean.ledger_lines_unmerged(_raw(s, d))))
query("j1_with_key_totals")(
    lambda s, d: clean.with_key_totals(clean.ledger_lines_unmerged(_raw(s, d))).select(
        "InvoiceNo", "StockCode", "Quantity", "TotalAmount", "TotalQuantity", "TotalAmountSum"
    )
)
query("x7_product_codes_only")(lambda s, d: clean.product_codes_only(_raw(s, d)))


@query("x8_without_exact_copies")
def _without_copies(spark: SparkSession, folder: str) -> DataFrame:
    """All lines, and the larger ones a second time."""
    lines = _raw(spark, folder)
    times = F.when(F.col("Quantity") >= 25, 2).otherwise(1)
    return clean.without_exact_copies(lines.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy"))


# -- text files -----------------------------------------------------------------------------------------------------


@query("s1_f1_csv_lines")
def _csv_lines(spark: SparkSession, folder: str) -> DataFrame:
    return with_times(read_lines(spark, _texts(spark, folder, ISO_LAYOUT)), ISO_LAYOUT)


@query("f2_us_dates")
def _us_dates(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_lines(spark, _texts(spark, folder, US_LAYOUT))
    return clean.shopper_lines(lines.drop("Description"), ANY_LAYOUT)


@query("s3_external_lines")
def _external(spark: SparkSession, folder: str) -> DataFrame:
    path = _texts(spark, folder, ISO_LAYOUT)
    return declare_external(spark, f"lines_{path.rsplit('/', 1)[1]}", path)


@query("s2_inferred_lines")
def _inferred(spark: SparkSession, folder: str) -> DataFrame:
    """Types as Spark infers them, but that the codes, which look like numbers here, leave as text."""
    lines = read_lines_inferred(spark, _texts(spark, folder, ISO_LAYOUT))
    return lines.withColumns({c: F.col(c).cast("string") for c in ("InvoiceNo", "StockCode")})


@query("r19_text_ledger_run")
def _text_run(spark: SparkSession, folder: str) -> DataFrame:
    """From text files to results: staged once, then the whole ledger run."""
    store = _results(spark)
    run_ledger(stage_lines(read_lines(spark, _texts(spark, folder, ISO_LAYOUT)), store), store)
    return store.read("country_performance")


# -- quality --------------------------------------------------------------------------------------------------------

query("q1_null_counts")(lambda s, d: quality.null_counts(_raw(s, d)))
query("q2_lines_without_customer")(lambda s, d: quality.lines_without_customer(_raw(s, d)))
query("q3_suspicious_counts")(lambda s, d: quality.suspicious_counts(_raw(s, d)))
query("q4_removal_report")(lambda s, d: quality.removal_report(_raw(s, d)))
query("q5_rule_violations")(lambda s, d: quality.rule_violations(_raw(s, d)))
query("s13_run_summary")(lambda s, d: quality.run_summary(_raw(s, d), _ledger(s, d)))
query("s13_written_summary")(lambda s, d: write_fact(star_lines(s, d, _BILLED), _results(s))[1])

# -- reports --------------------------------------------------------------------------------------------------------

query("r1_monthly_by_lines")(lambda s, d: revenue.monthly_by_lines(_ledger(s, d)))
query("r2_monthly_by_invoices")(lambda s, d: revenue.monthly_by_invoices(_member_invoices(s, d)))
query("r3_weekday_by_lines")(lambda s, d: revenue.weekday_by_lines(_ledger(s, d)))
query("r4_weekday_by_invoices")(lambda s, d: revenue.weekday_by_invoices(_member(s, d, _SOLD)))
query("r5_hourly_by_lines")(lambda s, d: revenue.hourly_by_lines(_ledger(s, d)))
query("r6_hourly_by_invoices")(lambda s, d: revenue.hourly_by_invoices(_member(s, d, _SOLD)))
query("r7_top_by_quantity")(lambda s, d: products.top_by_quantity(_per_product(s, d)))
query("r8_top_by_revenue")(lambda s, d: products.top_by_revenue(_per_product(s, d)))
query("r9_top_codes_by_quantity")(lambda s, d: products.top_codes_by_quantity(_described_member(s, d)))
query("r10_top_codes_by_revenue")(lambda s, d: products.top_codes_by_revenue(_described_member(s, d)))
query("r11_countries_by_lines")(lambda s, d: geography.countries_by_lines(_ledger(s, d)))
query("r12_countries_by_invoices")(lambda s, d: geography.countries_by_invoices(_member_invoices(s, d)))
query("r13_monthly_totals")(lambda s, d: revenue.monthly_totals(_ledger(s, d)))
query("r14_monthly_trend")(lambda s, d: revenue.monthly_trend(_member_invoices(s, d)))
query("r15_invoice_transactions")(_transactions)
query("r16_overview")(lambda s, d: revenue.overview(_member(s, d, _SOLD)))
query("r17_top_spenders")(lambda s, d: customers.top_spenders(_member(s, d)))
query("r18_repeat_purchases")(lambda s, d: products.repeat_purchases(_coded(s, d, "Brand", "Description")))
query("x1_quarterly")(lambda s, d: revenue.quarterly(_member(s, d, _SOLD)))
query("x2_top_by_orders")(lambda s, d: products.top_by_orders(_member(s, d, _SOLD)))
query("x9_customers_per_region")(lambda s, d: geography.customers_per_region(_member(s, d), star_regions(s, d)))
query("x9_markets_abroad")(lambda s, d: geography.countries_by_invoices(_member_invoices(s, d), except_home=_HOME))

# -- customers ------------------------------------------------------------------------------------------------------

query("c1_rfm_by_lines")(lambda s, d: customers.rfm_by_lines(_ledger(s, d)))
query("c2_segment_statistics")(lambda s, d: customers.segment_statistics(customers.rfm_by_lines(_ledger(s, d))))
query("c3_rfm_by_invoices")(lambda s, d: customers.rfm_by_invoices(_member(s, d)))
query("c4_segment_statistics_by_value")(
    lambda s, d: customers.segment_statistics_by_value(customers.rfm_by_invoices(_member(s, d)))
)
query("c5_shopper_base")(lambda s, d: customers.shopper_base(_shopper(s, d)))
query("c6_shopper_scores")(lambda s, d: customers.shopper_scores(customers.shopper_base(_shopper(s, d))))
query("c7_shopper_segments")(_segmented)
query("c8_cluster_statistics")(lambda s, d: customers.cluster_statistics(_segmented(s, d)))


@query("x6_documented_segments")
def _documented(spark: SparkSession, folder: str) -> DataFrame:
    rfm = customers.rfm_by_invoices(_member(spark, folder))
    return rfm.select("CustomerID", "Country", customers.documented_segment().alias("DocumentedSegment"))


@query("x3_standardised")
def _standardised(spark: SparkSession, folder: str) -> DataFrame:
    scaled = clusters.standardised(customers.shopper_base(_shopper(spark, folder)))
    return scaled.select("CustomerID", *[F.round(f"{m}Scaled", 6).alias(f"{m}Scaled") for m in clusters.METRICS])


query("x4_elbow")(
    lambda s, d: clusters.elbow(customers.shopper_base(_shopper(s, d))).withColumn("Cost", F.round("Cost", 6))
)
query("x4_elbow_k")(lambda s, d: clusters.elbow_k(clusters.elbow(customers.shopper_base(_shopper(s, d)))))
query("x5_cluster_profile")(
    lambda s, d: clusters.cluster_profile(clusters.clustered(customers.shopper_base(_shopper(s, d))))
)

# -- baskets --------------------------------------------------------------------------------------------------------


def _joined(items: str) -> Column:
    return F.array_join(F.array_sort(items), "|")


query("b1_baskets")(lambda s, d: baskets.baskets(_basket(s, d)).select("InvoiceNo", _joined("items").alias("Items")))
query("b1_wide_baskets")(
    lambda s, d: baskets.whole_baskets(baskets.basket_segments(_basket(s, d), most=4)).select("InvoiceNo", _joined("items").alias("Items"))
)
query("b2_product_dimension")(lambda s, d: products.descriptions(clean.basket_lines(_raw(s, d))))


@query("b3_frequent_itemsets")
def _itemsets(spark: SparkSession, folder: str) -> DataFrame:
    itemsets = baskets.mine(_basket(spark, folder), 0.01, 0.2).itemsets
    return itemsets.select(_joined("items").alias("Items"), F.col("freq").alias("Freq"))


@query("b4_association_rules")
def _rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = baskets.mine(_basket(spark, folder), 0.01, 0.2).rules
    return rules.select(
        _joined("antecedent").alias("Antecedent"),
        _joined("consequent").alias("Consequent"),
        *[F.round(name.lower(), 4).alias(name) for name in ("Confidence", "Lift", "Support")],
    )


@query("b5_item_pairs")
def _item_pairs(spark: SparkSession, folder: str) -> DataFrame:
    lines = _basket(spark, folder, "Brand")
    return baskets.item_pairs(baskets.mine(lines, 0.01, 0.2).itemsets, lines)


@query("b6_product_rules")
def _product_rules(spark: SparkSession, folder: str) -> DataFrame:
    lines = _basket(spark, folder)
    return baskets.product_rules(baskets.mine(lines, 0.01, 0.2).rules, lines)


query("b7_brand_line_pairs")(lambda s, d: baskets.top_line_pairs(_coded(s, d, "Brand")))
query("b7_part_line_pairs")(lambda s, d: baskets.top_line_pairs(_member(s, d, _SOLD), more_than=1))


@query("b3_part_itemsets")
def _part_itemsets(spark: SparkSession, folder: str) -> DataFrame:
    itemsets = baskets.mine(_part_basket(spark, folder), PART_SUPPORT, 0.2).itemsets
    return itemsets.select(_joined("items").alias("Items"), F.col("freq").alias("Freq"))


@query("b5_part_pairs")
def _part_pairs(spark: SparkSession, folder: str) -> DataFrame:
    lines = _part_basket(spark, folder)
    return baskets.item_pairs(baskets.mine(lines, PART_SUPPORT, 0.2).itemsets, lines)


# -- whole runs: written, then read back ----------------------------------------------------------------------------


@query("r19_ledger_run")
def _ledger_run(spark: SparkSession, folder: str) -> DataFrame:
    store = _results(spark)
    run_ledger(_raw(spark, folder), store)
    return store.read("monthly_revenue")


@query("c9_segmentation_run")
def _segmentation_run(spark: SparkSession, folder: str) -> DataFrame:
    store = _results(spark)
    run_segmentation(_raw(spark, folder), store)
    return store.read("cluster_statistics")


@query("b8_recommendation_run")
def _recommendation_run(spark: SparkSession, folder: str) -> DataFrame:
    store = _results(spark)
    run_recommendations(_coded_raw(spark, folder, "PType"), store)
    return store.read("product_recommendations")


query("l1_countries_in_order")(
    lambda s, d: numbered(geography.countries_by_lines(_ledger(s, d)), F.desc("TotalRevenue"), "Country", name="Place")
)
query("w7_invoice_positions")(
    lambda s, d: numbered(_transactions(s, d), F.desc("TotalAmount"), "InvoiceNo", "CustomerID", "Country").select(
        "InvoiceNo", "TotalAmount", "Position"
    )
)


@query("s7_replaced_result")
def _replaced(spark: SparkSession, folder: str) -> DataFrame:
    """A result that was replaced twice, the second time in vain: the write fails half-way."""
    store = _results(spark)
    months = store.write(revenue.monthly_by_lines(_ledger(spark, folder)), "months")
    store.write(revenue.monthly_totals(_ledger(spark, folder)), "months")
    try:
        store.write(months.withColumn("TotalOrders", F.raise_error(F.lit("lost")).cast("long")), "months")
    except PySparkException:
        return store.read("months")
    raise AssertionError("the write should have failed")


def _database(spark: SparkSession, folder: str, buckets: int = 0) -> str:
    """The member warehouse in a database of its own; returns its name. The session's database stays the current one."""
    before, name = spark.catalog.currentDatabase(), f"member_{fresh_path(spark).rsplit('/', 1)[1]}"
    build_warehouse(_raw(spark, folder), name, buckets=buckets)
    spark.catalog.setCurrentDatabase(before)
    return name


@query("s4_s5_warehouse_countries")
def _warehouse_countries(spark: SparkSession, folder: str) -> DataFrame:
    return spark.table(f"{_database(spark, folder)}.country_performance")


@query("s9_warehouse_view")
def _warehouse_view(spark: SparkSession, folder: str) -> DataFrame:
    """SQL text over a view of a table."""
    name = _database(spark, folder)
    as_view(spark.table(f"{name}.customer_rfm"), f"rfm_{name}")
    return spark.sql(f"SELECT CustomerSegment, count(*) AS Customers, max(Frequency) AS MostOrders FROM rfm_{name} GROUP BY CustomerSegment")


@query("s10_warehouse_tables")
def _warehouse_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table that the catalog lists for the warehouse."""
    before, name = spark.catalog.currentDatabase(), _database(spark, folder)
    spark.catalog.setCurrentDatabase(name)
    listed = [t for t in table_names(spark) if not t.startswith("rfm_")]
    spark.catalog.setCurrentDatabase(before)
    counts = [spark.table(f"{name}.{t}").agg(F.lit(t).alias("TableName"), F.count("*").alias("LineCount")) for t in listed]
    return reduce(DataFrame.unionByName, counts)


@query("s5_bucketed_invoices")
def _bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The invoice table from a fact that is bucketed by invoice."""
    name = f"fact_{fresh_path(spark).rsplit('/', 1)[1]}"
    rows = star_lines(spark, folder, ("InvoiceNo",)).count()  # read from the files' footers
    fact = create_if_absent(
        spark, name, lambda: _ledger(spark, folder), buckets=bucket_count(rows), bucket_by=("InvoiceNo",), sort_by=clean.LINE_KEY
    )
    return rollups.invoice_transactions(fact)


query("s12_preview")(lambda s, d: preview(revenue.monthly_by_lines(_ledger(s, d)), 5))

# -- distinct counts from sketches ----------------------------------------------------------------------------------


def _within(exact: DataFrame, near: DataFrame, keys: tuple[str, ...], counts: tuple[str, ...]) -> DataFrame:
    """Exact counts, and whether those of the sketches are within the error that no count exceeds."""
    sketched = near.select(*keys, *[F.col(c).alias(f"{c}Sketched") for c in counts])
    bound = rollups.sketch_error(errors=rollups.SURE)
    close = {f"{c}Close": F.abs(F.col(f"{c}Sketched") - F.col(c)) <= F.col(c) * bound for c in counts}
    return exact.join(sketched, list(keys)).withColumns(close).drop(*sketched.columns[len(keys) :])


@query("a4_sketched_months")
def _sketched_months(spark: SparkSession, folder: str) -> DataFrame:
    invoices = cut(_member_invoices(spark, folder))
    sketches = rollups.sketch_rollup(invoices)
    counts = ("TotalOrders", "TotalCustomers")
    return _within(revenue.monthly_by_invoices(invoices), revenue.monthly_by_invoices(sketches), ("Year", "Month"), counts)


@query("a4_sketched_countries")
def _sketched_countries(spark: SparkSession, folder: str) -> DataFrame:
    invoices = cut(_member_invoices(spark, folder))
    sketches = rollups.sketch_rollup(invoices)
    exact, near = geography.countries_by_invoices(invoices), geography.countries_by_invoices(sketches)
    return _within(exact, near, ("Country",), ("TotalCustomers", "TotalOrders"))


# -- pages of written results ---------------------------------------------------------------------------------------

_boards: dict[tuple[str, str, str], ResultStore] = {}


def _board(spark: SparkSession, folder: str, *runs: str) -> Dashboard:
    """A dashboard over results that each run writes once in an application. Lines are joined and staged once for all runs."""
    work = {"ledger": run_ledger, "segmentation": run_segmentation}
    key = (spark.sparkContext.applicationId, folder, "+".join(runs))
    if key not in _boards:
        store = _results(spark)
        staged = stage_lines(_raw(spark, folder), store)
        for run in runs:
            work[run](staged, store)
        _boards[key] = store
    return Dashboard(_boards[key])


query("v1_written_overview")(lambda s, d: _board(s, d, "ledger", "segmentation").overview()[0])
query("v1_written_split")(lambda s, d: _board(s, d, "ledger", "segmentation").overview()[1])
query("v2_written_page")(lambda s, d: _board(s, d, "ledger", "segmentation").customers(2)[0])
query("v4_written_products")(lambda s, d: _board(s, d, "ledger", "segmentation").products(50)[0])
query("v5_written_months")(lambda s, d: _board(s, d, "ledger", "segmentation").revenue()[0])
query("v6_written_countries")(lambda s, d: _board(s, d, "ledger", "segmentation").countries()[0])
query("v7_written_segments")(lambda s, d: _board(s, d, "ledger", "segmentation").segments()[1])
query("v9_written_page")(lambda s, d: _board(s, d, "ledger", "segmentation").transactions(3)[0])

# -- dashboard reads ------------------------------------------------------------------------------------------------


def _per_product(spark: SparkSession, folder: str) -> DataFrame:
    return products.per_product(_described_ledger(spark, folder))


def _by_quantity(spark: SparkSession, folder: str) -> DataFrame:
    return products.top_by_quantity(_per_product(spark, folder))


def _by_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return products.top_by_revenue(_per_product(spark, folder))


query("v1_overview")(lambda s, d: views.overview(_segmented(s, d), _transactions(s, d), _by_quantity(s, d)))
query("v1_front_products")(lambda s, d: views.front_products(_by_revenue(s, d)))
query("v2_customers_page")(lambda s, d: views.customers_page(_segmented(s, d), 2))
query("v2_segment_page")(lambda s, d: views.customers_page(_segmented(s, d), 1, _SEGMENT))
query("v2_page_count")(lambda s, d: views.customers_page_count(_segmented(s, d)))
query("v2_segments")(lambda s, d: views.distinct_values(_segmented(s, d), "Segment"))
query("v3_customer_details")(
    lambda s, d: views.customer_details(_segmented(s, d), customers.rfm_by_lines(_ledger(s, d)))
)
query("p10_find_customer")(lambda s, d: views.find_customer(_segmented(s, d), _CUSTOMER))
query("v4_products_by_revenue")(lambda s, d: views.products_view(_by_revenue(s, d), "TotalRevenue"))
query("v4_products_by_quantity")(lambda s, d: views.products_view(_by_quantity(s, d), "TotalQuantity"))
query("v5_monthly")(lambda s, d: views.monthly_view(revenue.monthly_by_lines(_ledger(s, d))))
query("v5_weekdays")(lambda s, d: views.weekday_view(revenue.weekday_by_lines(_ledger(s, d))))
query("v5_hours_v12_busy")(lambda s, d: views.hourly_view(revenue.hourly_by_lines(_ledger(s, d))))
query("v6_countries")(lambda s, d: views.countries_view(geography.countries_by_lines(_ledger(s, d))))
query("v6_country_totals")(lambda s, d: views.country_totals(geography.countries_by_lines(_ledger(s, d))))
query("v7_segment_counts")(lambda s, d: views.segment_counts(_segmented(s, d)))
query("v7_segment_statistics")(lambda s, d: views.segment_view(customers.cluster_statistics(_segmented(s, d))))
query("v8_pairs")(lambda s, d: views.pairs_view(_item_pairs(s, d)))
query("v8_rules")(lambda s, d: views.rules_view(_product_rules(s, d)))
query("v9_transactions_largest")(lambda s, d: views.transactions_page(_transactions(s, d), 3))
query("v9_transactions_smallest")(lambda s, d: views.transactions_page(_transactions(s, d), 1, descending=False))
query("v9_page_count")(lambda s, d: views.page_count(_transactions(s, d)))
query("v10_largest_by_hour")(lambda s, d: views.largest_by_hour(_transactions(s, d)))
query("v10_largest_summary")(lambda s, d: views.largest_summary(_transactions(s, d)))
query("v11_hour_histogram")(lambda s, d: views.hour_histogram(views.largest_by_hour(_transactions(s, d))))
query("v13_customers")(lambda s, d: views.first_rows(_segmented(s, d), 100, "CustomerID"))
query("v13_top_countries")(
    lambda s, d: views.first_rows(geography.countries_by_lines(_ledger(s, d)), 10, F.desc("TotalRevenue"), "Country")
)
query("v14_segment_notes")(
    lambda s, d: customers.with_segment_note(_segmented(s, d)).select("CustomerID", "Segment", "Note")
)
