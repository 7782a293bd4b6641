import pytest
from pyspark.sql import functions as F

from tillroll.operators import clean
from tillroll.plans.dashboard import Dashboard
from tillroll.plans.intake import stage_lines
from tillroll.plans.ledger import run_ledger
from tillroll.plans.recommendations import run_recommendations
from tillroll.plans.segmentation import run_segmentation
from tillroll.plans.warehouse import build_warehouse
from tillroll.sources.star import star_lines
from tillroll.sources.store import ResultStore, as_view, table_names

DATA = "/root/testdata/sf0.001"
REPORTS = [
    "monthly_revenue", "daily_revenue", "hourly_revenue", "top_products_quantity", "top_products_revenue",
    "customer_rfm", "customer_segments", "country_performance", "monthly_trend", "transactions",
]


@pytest.fixture(scope="module")
def lines(spark):
    return star_lines(spark, DATA)


@pytest.fixture(scope="module")
def filled(spark, lines, tmp_path_factory):
    store = ResultStore(spark, str(tmp_path_factory.mktemp("results")))
    summary = run_ledger(lines, store).first()
    run_segmentation(lines, store)
    brands = star_lines(spark, DATA, ("InvoiceNo", "StockCode", "Quantity", "Description", "PType"))
    run_recommendations(brands.withColumn("StockCode", F.col("PType")), store)
    return store, summary


def test_ledger_run_writes_every_result(filled, lines):
    store, summary = filled
    assert set(REPORTS) <= set(store.names())
    fact = store.read("processed_data")
    assert summary.RawLines == lines.count() and summary.MergedLines == fact.count()
    assert summary.CleanLines == clean.ledger_lines_unmerged(lines).count()


def test_fact_is_read_by_partition(filled):
    month = filled[0].read("processed_data").filter("Year = 1996 AND Month = 3")
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan and not month.isEmpty()


def test_revenue_is_the_same_in_every_report(filled):
    store, summary = filled
    for name in ("monthly_revenue", "daily_revenue", "hourly_revenue", "country_performance", "monthly_trend"):
        assert round(store.read(name).agg(F.sum("TotalRevenue")).first()[0], 2) == summary.TotalRevenue
    assert round(store.read("transactions").agg(F.sum("TotalAmount")).first()[0], 2) == summary.TotalRevenue
    assert round(store.read("customer_rfm").agg(F.sum("Monetary")).first()[0], 2) == summary.TotalRevenue


def test_one_row_per_invoice(filled):
    table = filled[0].read("transactions")
    assert table.count() == table.select("InvoiceNo").distinct().count()


def test_reports_from_lines_equal_reports_from_the_rollup(filled):
    from tillroll.operators import customers, geography, revenue, rollups

    fact = filled[0].read("processed_data")
    invoices = rollups.invoice_rollup(fact)
    for report in (
        revenue.monthly_by_lines, revenue.monthly_by_invoices, revenue.weekday_by_invoices, revenue.hourly_by_invoices,
        revenue.monthly_trend, geography.countries_by_lines, geography.countries_by_invoices, customers.rfm_by_invoices,
    ):
        a, b = report(fact), report(invoices)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), report.__name__


def test_segments_cover_all_customers(filled):
    store, _ = filled
    customers = store.read("customer_clusters")
    counted = store.read("cluster_statistics").agg(F.sum("CustomerCount")).first()[0]
    assert counted == customers.count() == customers.select("CustomerID").distinct().count()


def test_recommendations_are_sane(filled):
    pairs = filled[0].read("product_associations")
    assert pairs.filter("StockCode1 >= StockCode2 OR Support > 1 OR Description1 IS NULL").isEmpty()
    rules = filled[0].read("product_recommendations")
    assert not rules.isEmpty() and rules.filter("Confidence < 0.2 OR Confidence > 1 OR Support > Confidence").isEmpty()


def test_dashboard_reads(filled):
    board = Dashboard(filled[0])
    assert "transactions" in board.collections()
    assert board.overview()[0].first().TotalProducts == 20
    assert [r.Rank for r in board.front_products().collect()] == [1, 2, 3, 4, 5]
    listed, pages, segments = board.customers(page=1)
    assert listed.count() == 20 and pages.first().Total > 20 and segments.count() > 1
    one = listed.first().CustomerID
    note, rfm = board.customer(one)
    assert note.first().Note and rfm.count() == 1
    assert [p.count() for p in board.products(10)] == [10, 10]
    monthly, weekdays, hours, trend = board.revenue()
    assert monthly.count() == trend.count() and weekdays.count() == 7 and hours.filter("Busy").count() == 5
    countries, totals = board.countries()
    assert countries.count() == totals.first().Countries
    for shares, column in zip(board.segments(), ("SharePercent", "RevenuePercent"), strict=True):
        assert abs(shares.agg(F.sum(column)).first()[0] - 100) < 0.5
    assert all(not part.isEmpty() for part in board.recommendations())
    largest, pages = board.transactions(2)
    assert largest.count() == 20 and pages.first().TotalPages > 1
    assert board.largest_transactions()[0].count() == 24


def test_warehouse_tables_are_created_once(spark, lines):
    names = build_warehouse(lines, "retail_db")
    assert len(names) == 11 and set(n.lower() for n in names) <= set(table_names(spark))
    before = spark.table("monthly_revenue").collect()
    build_warehouse(lines.limit(0), "retail_db")
    assert spark.table("monthly_revenue").collect() == before
    as_view(spark.table("transactions"), "trans")
    assert spark.sql("SELECT COUNT(*) AS n FROM trans").first().n == spark.table("transactions").count()
    spark.catalog.setCurrentDatabase("default")


def test_runs_from_staged_text(spark, raw, tmp_path):
    store = ResultStore(spark, str(tmp_path / "results"))
    staged = stage_lines(raw, store)
    assert staged.schema == raw.schema and staged.count() == raw.count()
    run_segmentation(staged, store)
    recency = {r.CustomerID: r.Recency for r in store.read("customer_clusters").collect()}
    assert recency == {"17850": 0, "14527": 1}


def test_missing_store_folder_has_no_results(spark, tmp_path):
    assert ResultStore(spark, str(tmp_path / "none")).names() == []


def test_overview_counts_absent_results_as_zero(spark, tmp_path):
    sizes, split = Dashboard(ResultStore(spark, str(tmp_path / "none"))).overview()
    assert tuple(sizes.first()) == (0, 0, 0) and split is None


def test_dashboard_pages_after_and_limits(filled):
    board = Dashboard(filled[0])
    first = board.customers(1)[0].collect()
    assert board.customers_after(first[-1].CustomerID).collect()[0].CustomerID > first[-1].CustomerID
    assert board.first_customers(7).count() == 7 and board.first_countries(3).count() == 3
    assert board.overview()[1].count() == board.customers()[2].count()


def test_existing_tables_cost_nothing(spark):
    from tillroll.sources.store import create_if_absent

    spark.range(3).selectExpr("id", "id % 2 AS part").createOrReplaceTempView("three")
    made = create_if_absent(spark, "parted", lambda: spark.table("three"), ("part",))
    assert made.count() == 3
    assert create_if_absent(spark, "parted", lambda: pytest.fail("was computed")).count() == 3
