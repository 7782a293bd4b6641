import re

import pytest
from pyspark.sql import functions as F

from tillroll.operators import clean, quality
from tillroll.sources.lines import declare_external, read_lines, read_lines_inferred
from tillroll.sources.store import use_database


def keys(df):
    return sorted((r.InvoiceNo, r.StockCode) for r in df.select("InvoiceNo", "StockCode").collect())


def test_quoted_commas_stay_in_the_description(raw):
    assert raw.filter(F.col("InvoiceNo") == "536366").first().Description == "lantern, red"


def test_malformed_fields_become_null_and_are_reported(spark, tmp_path):
    (tmp_path / "bad.csv").write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        "1,A,x,many,2010-12-01 08:26:00,1.5,1.0,France\n"
    )
    row = read_lines(spark, str(tmp_path / "bad.csv"), keep_bad=True).first()
    assert row.Quantity is None and row.UnitPrice == 1.5 and row._bad_record.startswith("1,A,x,many")


def test_inferred_types(spark, csv_path):
    types = dict(read_lines_inferred(spark, csv_path).dtypes)
    assert types["Quantity"] == "int" and types["CustomerID"] == "double" and types["InvoiceDate"] == "timestamp"


def test_external_table_skips_the_header(spark, csv_path):
    use_database(spark, "external_lines")
    table = declare_external(spark, "transactions_raw", csv_path)
    assert table.count() == 8 and dict(table.dtypes)["InvoiceDate"] == "timestamp"
    assert declare_external(spark, "transactions_raw", csv_path).count() == 8
    spark.catalog.setCurrentDatabase("default")


def test_ledger_merges_repeats_and_keeps_unknown_customers(raw):
    rows = {r.InvoiceNo: r for r in clean.ledger_lines(raw).collect()}
    assert sorted(rows) == ["536365", "536366", "536383"]
    merged = rows["536365"]
    assert (merged.Quantity, float(merged.TotalAmount), merged.Description) == (8, 20.40, "WHITE HEART")
    assert rows["536366"].CustomerID == "unknown" and merged.CustomerID == "17850"
    assert (merged.Year, merged.Month, merged.DayOfWeek, merged.Hour) == (2010, 12, 4, 8)


def test_merging_twice_changes_nothing(raw):
    once = clean.ledger_lines(raw)
    again = clean.merge_repeats(once).select(once.columns)
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()


def test_member_drops_unknown_customers_and_keeps_repeats(raw):
    assert keys(clean.member_lines(raw).fillna("-")) == [
        ("536365", "85123A"), ("536365", "85123A"), ("536382", "-"), ("536383", "22633")
    ]


def test_shopper_keeps_a_cancelled_invoice_with_positive_quantity(raw):
    lines = clean.shopper_lines(raw, layout="yyyy-MM-dd HH:mm:ss")
    assert "C536380" in {r.InvoiceNo for r in lines.collect()}
    assert lines.filter("CustomerID = 'unknown'").count() == 1
    as_read = clean.shopper_lines(raw, ids_as_read=True)
    assert "17850.0" in {r.CustomerID for r in as_read.collect()}


def test_basket_rules_ignore_price_and_customer(raw):
    assert keys(clean.basket_lines(raw)) == [
        ("536365", "85123A"), ("536365", "85123A"), ("536366", "71053"), ("536381", "71053"), ("536383", "22633")
    ]


def test_unparsable_dates_stay_as_null(spark, raw):
    bad = raw.withColumn("InvoiceDate", F.lit("12/1/2010 8:26"))
    assert clean.ledger_lines(bad).filter("InvoiceDate IS NULL AND Year IS NULL").count() == 3
    assert clean.ledger_lines(bad, layout="M/d/yyyy H:mm").filter("Year = 2010").count() == 3


def test_service_codes_and_copies(spark, raw):
    assert "D" not in {r.StockCode for r in clean.product_codes_only(raw).collect()}
    assert clean.without_exact_copies(raw.unionByName(raw)).count() == raw.count()


def test_first_line_is_the_earliest_then_the_cheapest(spark):
    rows = [("1", "A", "b", 1, "2010-12-02 00:00:00", 1.0), ("1", "A", "a", 1, "2010-12-01 00:00:00", 9.0),
            ("1", "A", "c", 1, "2010-12-01 00:00:00", 3.0)]
    lines = spark.createDataFrame(
        rows, "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate string, UnitPrice double"
    ).withColumns({"CustomerID": F.lit(1.0), "Country": F.lit("France")})
    first = clean.first_line_per_key(clean.ledger_lines_unmerged(lines)).collect()
    assert [r.Description for r in first] == ["C"]


def test_quality_profiles(raw):
    nulls = {r.ColumnName: r.NullCount for r in quality.null_counts(raw).collect()}
    assert (nulls["CustomerID"], nulls["StockCode"], nulls["Country"]) == (1, 1, 0)
    assert quality.lines_without_customer(raw).count() == 1
    assert tuple(quality.suspicious_counts(raw).first()) == (1, 0, 2)
    steps = {r.Step: r.LineCount for r in quality.removal_report(raw).collect()}
    assert steps == {
        "rows read": 8, "cancelled invoice": 2, "missing customer": 1, "quantity not positive": 0,
        "price not positive": 1, "not a product code": 1, "rows kept": 3,
    }
    broken = {r.Rule: r.Violations for r in quality.rule_violations(raw).collect()}
    assert broken["StockCode is missing"] == 1 and broken["CustomerID is not int"] == 0


def test_run_summary(raw):
    summary = quality.run_summary(raw, clean.ledger_lines(raw)).first()
    assert tuple(summary) == (8, 5, 3, 48.14)


def _lines(spark, rows):
    from tillroll.schema import raw_schema

    return spark.createDataFrame(rows, raw_schema())


def test_prices_keep_every_digit(spark):
    day = "2010-12-01 08:26:00"
    raw = _lines(spark, [("1", "A", "x", 100_000, day, 0.00004, 1.0, "F"), ("2", "A", "x", 3, day, 1.23456789, 1.0, "F")])
    for rules in (clean.ledger_lines, clean.member_lines):
        found = {r.InvoiceNo: (r.UnitPrice, float(r.TotalAmount)) for r in rules(raw).collect()}
        assert found == {"1": (0.00004, 4.0), "2": (1.23456789, 3.7)}
    exact = {r.InvoiceNo: float(r.TotalAmount) for r in clean.shopper_lines(raw).collect()}
    assert exact == {"1": 4.0, "2": 3.70370367}


def test_text_ids_stay_apart(spark):
    day = "2010-12-01 08:26:00"
    raw = _lines(spark, [("1", "A", "x", 1, day, 1.0, None, "F")] * 4).drop("CustomerID")
    ids = spark.createDataFrame([("AB12",), (" CD34 ",), ("17850.0",), ("",)], "CustomerID string")
    raw = raw.limit(1).crossJoin(ids)
    assert sorted(r.CustomerID for r in clean.member_lines(raw).collect()) == ["17850", "AB12", "CD34"]
    assert sorted(r.CustomerID for r in clean.ledger_lines_unmerged(raw).collect()) == ["17850", "AB12", "CD34", "unknown"]


def test_a_file_with_other_columns_is_not_misread(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text("StockCode,InvoiceNo,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\nA,1,x,1,2010-12-01 08:26:00,1,1,F\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_lines(spark, str(path)).collect()


def test_us_dates_are_no_violation(spark):
    raw = _lines(spark, [("1", "A", "x", 1, d, 1.0, 1.0, "F") for d in ("12/1/2010 8:26", "2010-12-01 08:26:00", "soon")])
    found = {r.Rule: r.Violations for r in quality.rule_violations(raw).collect()}
    assert found["InvoiceDate is not timestamp"] == 1


def test_a_key_with_a_third_of_the_lines_is_split_in_the_join(spark):
    """The totals are a written table, so adaptive execution may split the lines of a hot key."""
    lines = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("i"), F.col("id"))).alias("InvoiceNo"),
        F.lit("A").alias("StockCode"), F.lit(1).alias("Quantity"), F.lit(1).cast("decimal(18,2)").alias("TotalAmount"),
        F.sha2(F.col("id").cast("string"), 256).alias("Description"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = clean.with_key_totals(lines)
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lines_to_merge_are_sorted_by_invoice_before_kind(raw):
    """A sort compares the first column first, and nearly all lines are of one kind."""
    plan = clean.ledger_lines_counted(raw)._jdf.queryExecution().executedPlan().toString()
    sorts = re.findall(r"Sort \[(\w+)#", plan)
    assert sorts and set(sorts) == {"InvoiceNo"}
