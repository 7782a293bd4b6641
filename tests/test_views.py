import pytest
from pyspark.sql import functions as F

from tillroll.operators import views
from tillroll.sources.store import preview


def invoices(spark, rows):
    """``rows`` invoices with many equal amounts; hours 9 and 10 tie for the peak when their number is even."""
    n = F.col("id")
    return spark.range(rows).select(
        F.lpad(n.cast("string"), 5, "0").alias("InvoiceNo"),
        F.when(n % 5 == 0, "unknown").otherwise(n.cast("string")).alias("CustomerID"),
        F.lit("France").alias("Country"),
        (9 + n % 2).cast("int").alias("Hour"),
        (n % 7).cast("double").alias("TotalAmount"),
    )


@pytest.mark.parametrize(("rows", "pages"), [(0, 0), (1, 1), (20, 1), (21, 2), (40, 2)])
def test_pages_put_together_are_the_whole_table(spark, rows, pages):
    table = invoices(spark, rows)
    assert tuple(views.page_count(table).first()) == (rows, pages)
    listed = [r.InvoiceNo for p in range(1, pages + 1) for r in views.transactions_page(table, p).collect()]
    amounts = {r.InvoiceNo: r.TotalAmount for r in table.collect()}
    assert listed == sorted(amounts, key=lambda i: (-amounts[i], i))
    assert views.transactions_page(table, pages + 1).isEmpty()


def test_positions_run_on_over_pages(spark):
    assert [r.Position for r in views.transactions_page(invoices(spark, 25), 2).collect()] == [21, 22, 23, 24, 25]


def test_largest_invoices_and_tied_peak(spark):
    table = invoices(spark, 1400)
    by_hour = views.largest_by_hour(table)
    assert sum(r.Invoices for r in by_hour.collect()) == 1000
    summary = views.largest_summary(table, 1400).first()
    assert summary.PeakHour == 9 and summary.TopTotal == 4200.0 and summary.TopAverage == 3.0
    slots = views.hour_histogram(views.largest_by_hour(table, 1400)).collect()
    assert [r.Hour for r in slots] == list(range(24)) and [r.Hour for r in slots if r.Peak] == [9, 10]
    assert sum(r.Invoices for r in slots) == 1400 and slots[0].Label == "0:00"


def test_empty_transactions(spark):
    assert tuple(views.largest_summary(invoices(spark, 0)).first()) == (0, 0.0, 0.0)


def test_months_show_their_direction(spark):
    rows = [(2010, 12, 5.0, 2), (2011, 1, 7.0, 0), (2011, 2, 7.0, 3), (2011, 3, 1.0, 1)]
    monthly = spark.createDataFrame(rows, "Year int, Month int, TotalRevenue double, TotalOrders bigint")
    seen = views.monthly_view(monthly).collect()
    assert [(r.Label, r.Trend) for r in seen] == [
        ("2010-12", "flat"), ("2011-01", "up"), ("2011-02", "flat"), ("2011-03", "down")
    ]
    assert [r.RevenuePerOrder for r in seen] == [2.5, 7.0, 2.33, 1.0]


def test_customer_pages_and_lookup(spark):
    rows = [(f"{i:03d}", "France", "At Risk" if i % 2 else "Champions") for i in range(45)]
    customers = spark.createDataFrame(rows, "CustomerID string, Country string, Segment string")
    assert [r.CustomerID for r in views.customers_page(customers, 3).collect()] == [f"{i:03d}" for i in range(40, 45)]
    risky = views.customers_page(customers, 1, "At Risk").collect()
    assert {r.Badge for r in risky} == {"at-risk"} and len(risky) == 20
    assert tuple(views.customers_page_count(customers, "At Risk").first()) == (22, 2)
    assert [r.Segment for r in views.distinct_values(customers, "Segment").collect()] == ["At Risk", "Champions"]
    assert views.find_customer(customers.unionByName(customers.withColumn("Country", F.lit("Austria"))), "007").first()[1] == "Austria"
    shares = views.segment_counts(customers).collect()
    assert [(r.Segment, r.CustomerCount, r.SharePercent) for r in shares] == [("Champions", 23, 51.1), ("At Risk", 22, 48.9)]


def test_shares_of_revenue(spark):
    rows = [("A", 60.0, 3), ("B", 30.0, 2), ("C", 10.0, 1)]
    countries = spark.createDataFrame(rows, "Country string, TotalRevenue double, TotalTransactions bigint")
    seen = views.countries_view(countries).collect()
    assert [(r.Rank, r.Country, r.SharePercent) for r in seen] == [(1, "A", 60.0), (2, "B", 30.0), (3, "C", 10.0)]
    assert tuple(views.country_totals(countries).first()) == (3, 100.0, 6)
    assert sum(r.SharePercent for r in seen) == 100


def test_details_join_ids_written_with_a_decimal_part(spark):
    customers = spark.createDataFrame([("17850.0", "At Risk"), ("3", "Regular")], "CustomerID string, Segment string")
    rfm = spark.createDataFrame(
        [("17850", "Spain", 1, 2, 3, "Lost"), ("17850", "Italy", 4, 4, 4, "Champions")],
        "CustomerID string, Country string, R_Score int, F_Score int, M_Score int, CustomerSegment string",
    )
    seen = {r.CustomerID: (r.OtherR, r.OtherSegment) for r in views.customer_details(customers, rfm).collect()}
    assert seen == {"17850": (4, "Champions"), "3": (None, None)}


def test_last_rows_are_returned_in_ascending_order(spark):
    assert [r.id for r in views.last_rows(spark.range(50), 3, "id").collect()] == [47, 48, 49]
    assert preview(spark.range(50), 4).count() == 4


@pytest.mark.parametrize("descending", [True, False])
def test_pages_after_a_row_follow_the_numbered_pages(spark, descending):
    rows = [(float(i % 7), f"i{i:03d}", "c", "x", 1) for i in range(65)]
    table = spark.createDataFrame(rows, "TotalAmount double, InvoiceNo string, CustomerID string, Country string, Hour int")
    seen = [r.InvoiceNo for n in (1, 2, 3, 4) for r in views.transactions_page(table, n, descending).orderBy("Position").collect()]
    walked = views.transactions_page(table, 1, descending).orderBy("Position").collect()
    listed = [r.InvoiceNo for r in walked]
    while walked:
        walked = views.transactions_after(table, walked[-1].asDict(), descending).collect()
        listed += [r.InvoiceNo for r in walked]
    assert listed == seen and len(seen) == 65
