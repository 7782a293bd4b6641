"""Physical plans keep the shape that lets them scale."""

import pytest

from tillroll.registry import QUERIES

DATA = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["r7_top_by_quantity", "r8_top_by_revenue", "v2_customers_page", "v9_transactions_largest"]
)
def test_rankings_keep_only_their_top_rows(spark, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, DATA))


@pytest.mark.parametrize("name", ["c1_rfm_by_lines", "c3_rfm_by_invoices", "c6_shopper_scores", "c7_shopper_segments"])
def test_scores_need_no_window(spark, name):
    assert "Window" not in plan_of(QUERIES[name](spark, DATA))


def test_scan_reads_only_needed_columns_and_filters_early(spark):
    plan = plan_of(QUERIES["x2_top_by_orders"](spark, DATA))
    scan = next(line for line in plan.splitlines() if "l_orderkey" in line and "FileScan" in line)
    assert "l_shipdate" not in scan and "l_tax" not in scan and "IsNotNull" in scan


def test_merging_repeats_shuffles_the_lines_once(spark, raw):
    from tillroll.operators.clean import ledger_lines

    assert plan_of(ledger_lines(raw)).count("Exchange") == 1


def test_time_reports_read_no_products(spark):
    for name in ("r1_monthly_by_lines", "r5_hourly_by_lines", "r15_invoice_transactions", "v6_countries"):
        assert "part.parquet" not in plan_of(QUERIES[name](spark, DATA))


def test_reports_without_country_read_no_customers(spark):
    for name in ("r4_weekday_by_invoices", "r6_hourly_by_invoices", "x1_quarterly"):
        assert "customer.parquet" not in plan_of(QUERIES[name](spark, DATA))
