"""Versioned results: atomic replacement, formats, layout; intermediates that end with their run; metrics of the write."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillroll.operators import clean, customers, geography, products, quality, revenue, rollups
from tillroll.operators.positions import numbered
from tillroll.plans.ledger import run_ledger, write_fact
from tillroll.plans.recommendations import run_recommendations
from tillroll.plans.segmentation import run_segmentation
from tillroll.registry import QUERIES
from tillroll.runtime import cut, cut_folder, file_names, scratch
from tillroll.sources.star import star_lines
from tillroll.sources.store import ResultStore, bucket_count, create_if_absent

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lines(spark):
    return star_lines(spark, DATA)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_read(df):
    """Rows that the Parquet scans of an executed frame returned, after skipping row groups."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = (plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan).collectLeaves()
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        leaf = leaf.plan() if "QueryStage" in leaf.getClass().getName() else leaf
        for j in range(leaf.collectLeaves().size()):
            metrics = leaf.collectLeaves().apply(j).metrics()
            total += metrics.apply("numOutputRows").value() if metrics.contains("numOutputRows") else 0
    return total


@pytest.fixture
def store(spark, tmp_path):
    return ResultStore(spark, str(tmp_path / "results"))


def test_a_write_that_fails_half_way_leaves_the_last_result(spark, store):
    first = spark.range(1000).selectExpr("id", "id % 3 AS part")
    store.write(first, "kept", ("part",))
    before = file_names(spark, store.path("kept"))
    failing = spark.range(0, 1000, 1, 8).select("id", F.when(F.col("id") == 990, F.raise_error(F.lit("lost"))).otherwise("x").alias("part"))
    with pytest.raises(PySparkException):
        store.write(failing, "kept")
    assert store.read("kept").count() == 1000 and store.read("kept").columns == ["id", "part"]
    assert file_names(spark, store.path("kept")) == before and store.names() == ["kept"]
    with pytest.raises(PySparkException):
        store.write(failing, "never")
    assert store.names() == ["kept"]


def test_a_result_is_current_only_when_it_is_named(spark, store, monkeypatch):
    """A driver that dies between the data and the name."""
    store.write(spark.range(5), "a")
    with monkeypatch.context() as patch:
        patch.setattr(ResultStore, "_publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            store.write(spark.range(9), "a")
    assert store.read("a").count() == 5


def test_readers_keep_their_version_and_old_ones_go(spark, store):
    store.write(spark.range(1), "a")
    held, then = store.read("a"), store.snapshot()
    store.write(spark.range(2), "a")
    assert held.count() == 1 and then.read("a").count() == 1 and store.read("a").count() == 2
    for n in range(3, 7):
        store.write(spark.range(n), "a")
    assert store.read("a").count() == 6
    assert len(file_names(spark, store.path("a"))) == 2 and len([f for f in file_names(spark, store.path("result_names")) if f[0] != "."]) == 2


def test_of_two_writers_one_fails(spark, store, monkeypatch):
    store.write(spark.range(1), "a")
    seen = store._numbers()
    store.write(spark.range(2), "a")
    monkeypatch.setattr(ResultStore, "_numbers", lambda self: seen)
    with pytest.raises(FileExistsError):
        store.write(spark.range(3), "a")
    monkeypatch.undo()
    assert store.read("a").count() == 2


@pytest.mark.parametrize(("format", "options"), [("orc", {}), ("json", {}), ("csv", {"header": "true"})])
def test_other_formats_keep_types_names_and_partitions(spark, tmp_path, format, options):
    store = ResultStore(spark, str(tmp_path / format), format, options)
    rows = [("1", 2, 1.5, datetime(2011, 5, 1, 8), 2011), ("007", None, -0.5, None, 2012)]
    made = store.write(spark.createDataFrame(rows, "code string, n int, x double, at timestamp, Year int"), "name with/odd.chars", ("Year",))
    again = ResultStore(spark, store.root, format, options)
    assert again.names() == ["name with/odd.chars"] and again.read(again.names()[0]).schema == made.schema
    assert sorted(map(tuple, again.read(again.names()[0]).collect()), key=str) == sorted(rows, key=str)
    assert again.read(again.names()[0]).filter("Year = 2012").first().code == "007"


def test_an_absent_result_is_named(store):
    with pytest.raises(KeyError, match="no result 'x'"):
        store.read("x")


# -- intermediates --------------------------------------------------------------------------------------------------


def test_a_scratch_removes_what_was_cut_inside(spark):
    outside = cut(spark.range(3))
    with scratch(spark) as folder:
        assert cut(spark.range(4)).count() == 4
        with scratch(spark) as inner:
            cut(spark.range(5))
            assert inner.startswith(folder)
        assert len(file_names(spark, folder)) == 1
    assert not file_names(spark, folder) and outside.count() == 3
    with pytest.raises(ZeroDivisionError), scratch(spark) as folder:
        cut(spark.range(4))
        1 / 0
    assert not file_names(spark, folder)


def test_runs_leave_no_intermediates(spark, lines, store):
    before = set(file_names(spark, cut_folder(spark)))
    run_ledger(lines, store)
    run_segmentation(lines, store)
    coded = star_lines(spark, DATA, ("InvoiceNo", "StockCode", "Quantity", "Description", "PType"))
    pairs, rules = run_recommendations(coded.withColumn("StockCode", F.col("PType")), store)
    assert set(file_names(spark, cut_folder(spark))) == before
    assert not pairs.isEmpty() and not rules.isEmpty()


# -- the summary of the write ---------------------------------------------------------------------------------------


def test_observed_summary_is_that_of_the_frames(spark, raw, lines, store):
    odd = raw.unionByName(raw.withColumn("InvoiceNo", F.lit(None).cast("string")))
    for frame in (raw, odd, lines, raw.limit(0)):
        fact, summary = write_fact(frame, store)
        assert summary.collect() == quality.run_summary(frame, fact).collect()
        expected = clean.ledger_lines(frame)
        assert fact.columns[:2] == expected.columns[:2] and set(fact.columns) == set(expected.columns)
        ordered = fact.select(*expected.columns)
        assert ordered.exceptAll(expected).isEmpty() and expected.exceptAll(ordered).isEmpty()


def test_the_summary_reads_the_lines_once(spark, raw, store):
    read = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counted = raw.mapInArrow(passing, raw.schema)
    _, summary = write_fact(counted, store)
    assert summary.first().RawLines == 8 and read.value == 8
    assert plan_of(clean.ledger_lines_counted(raw)).count("Exchange") == 1


# -- grains, sketches, buckets --------------------------------------------------------------------------------------


def test_reports_from_one_pass_equal_reports_from_invoices(lines):
    invoices = cut(rollups.invoice_rollup(clean.ledger_lines(lines.withColumn("Country", F.nullif("Country", F.lit("NATION_3"))))))
    grains = rollups.report_grains(invoices)
    for grain, report in (
        ("month", revenue.monthly_by_lines), ("weekday", revenue.weekday_by_lines), ("hour", revenue.hourly_by_lines),
        ("country", geography.countries_by_lines), ("month", revenue.monthly_totals),
    ):
        a, b = report(rollups.of_grain(grains, grain)), report(invoices)
        assert a.collect() == b.collect(), report.__name__
    assert plan_of(grains).count("Exchange") == 1


def test_no_count_of_many_is_outside_the_error_of_its_sketch(spark):
    """1 200 counts of 20 000 values: three standard errors of 4 096 registers do not hold all of them, the stated bound does."""
    number = F.col("id")
    rows = spark.range(0, 12_000_000, 1, 4).select(
        F.lit(2000).alias("Year"), (number % 600).cast("int").alias("Month"), F.lit("x").alias("Country"), F.lit(1).alias("Lines"), F.lit(1).alias("Units"),
        F.lit(1).alias("Revenue"), F.lit(0).alias("FirstPurchase"), F.lit(0).alias("LastPurchase"),
        number.cast("string").alias("InvoiceNo"), F.concat(F.lit("c"), number).alias("CustomerID"),
    )
    outside = {}
    for bits in (12, rollups.SKETCH_BITS):
        months = revenue.monthly_by_invoices(rollups.sketch_rollup(rows, bits=bits)).collect()
        outside[bits] = sum(abs(r[c] - 20_000) > 3 * 1.04 / 64 * 20_000 for r in months for c in ("TotalOrders", "TotalCustomers"))
    assert outside[12] > 0 and outside[rollups.SKETCH_BITS] == 0
    assert rollups.sketch_error(errors=rollups.SURE) <= 3 * 1.04 / 64


def test_sketches_merge_to_any_level_within_their_error(spark):
    rows = spark.range(400_000).select(
        F.concat(F.lit("i"), F.col("id") % 90_000).alias("InvoiceNo"), F.concat(F.lit("c"), F.col("id") % 30_000).alias("CustomerID"),
        F.concat(F.lit("s"), F.col("id") % 700).alias("StockCode"), (2010 + F.col("id") % 2).cast("int").alias("Year"),
        (1 + F.col("id") % 12).cast("int").alias("Month"), F.concat(F.lit("n"), F.col("id") % 5).alias("Country"),
        F.lit(2).alias("Quantity"), F.lit(3.5).cast("decimal(18,2)").alias("TotalAmount"), F.lit(datetime(2011, 1, 1)).alias("InvoiceDate"),
    )
    sketches = rollups.sketch_rollup(rows, distinct=("InvoiceNo", "CustomerID", "StockCode"))
    sketches = cut(sketches)
    assert sketches.count() == 60 and rollups.sketch_error() < 0.05 and rollups.sketch_error(14) < 0.025
    exact_reports = [(revenue.monthly_by_invoices, ["Year", "Month"]), (revenue.monthly_trend, ["Year", "Month"]), (geography.countries_by_invoices, ["Country"])]
    for report, keys in exact_reports:
        near = {tuple(r[k] for k in keys): r for r in report(sketches).collect()}
        for row in report(rows).collect():
            other = near[tuple(row[k] for k in keys)]
            for column in set(row.asDict()) & {"TotalOrders", "TotalCustomers", "UniqueCustomers"}:
                assert abs(other[column] - row[column]) <= rollups.sketch_error() * row[column]
            assert other.TotalRevenue == row.TotalRevenue
    whole, near = revenue.overview(rows).first(), revenue.overview(sketches).first()
    for column, count in (("UniqueCustomers", 30_000), ("UniqueOrders", 90_000), ("UniqueProducts", 700)):
        assert whole[column] == count and abs(near[column] - count) <= rollups.sketch_error() * count
    assert (near.TotalRecords, near.TotalRevenue, near.FirstDate) == (400_000, whole.TotalRevenue, whole.FirstDate)
    assert plan_of(revenue.monthly_by_invoices(sketches)).count("Expand") == 0


def test_a_bucketed_fact_is_grouped_without_moving(spark, lines):
    fact = create_if_absent(spark, "bucketed_fact", lambda: clean.ledger_lines(lines), buckets=4, bucket_by=("InvoiceNo",), sort_by=clean.LINE_KEY)
    plain = clean.ledger_lines(lines)
    for work in (rollups.invoice_rollup, rollups.invoice_transactions, clean.merge_repeats, lambda f: f.select("InvoiceNo", "StockCode").distinct()):
        assert "Exchange" not in plan_of(work(fact))
        assert work(fact).count() == work(plain).count()
    in_baskets = fact.select("InvoiceNo", "StockCode").distinct().groupBy("InvoiceNo").agg(F.collect_list("StockCode"))
    assert "Exchange" not in plan_of(in_baskets)


# -- places and layout ----------------------------------------------------------------------------------------------


def test_places_of_rows(spark):
    rows = spark.range(5000).select("id", (F.col("id") * 7919 % 100).alias("x")).repartition(7)
    found = numbered(rows, F.desc("x"), "id").collect()
    expected = sorted(found, key=lambda r: (-r.x, r.id))
    assert [r.id for r in sorted(found, key=lambda r: r.Position)] == [r.id for r in expected]
    assert sorted(r.Position for r in found) == list(range(1, 5001))
    assert numbered(rows.limit(0), "id").count() == 0


def test_a_deep_page_reads_its_row_groups_only(spark, store):
    rows = spark.range(20_000).select("id", F.rand(1).alias("TotalAmount"))
    table = store.write(numbered(rows, F.desc("TotalAmount"), "id"), "paged", sort_by=("Position",), rows_per_file=1000)
    page = table.filter("Position > 15000 AND Position <= 15020")
    assert page.count() == 20 and rows_read(page) <= 1000 < rows_read(table)
    assert len([f for f in file_names(spark, store.path("paged", store._entry("paged", 1)[0])) if f.endswith(".parquet")]) >= 20


def test_pages_of_written_invoices_and_customers(spark, lines, store):
    from tillroll.plans.dashboard import Dashboard

    run_ledger(lines, store)
    run_segmentation(lines, store)
    board = Dashboard(store)
    table = store.read("transactions")
    by_amount = table.orderBy(F.desc("TotalAmount"), "InvoiceNo", "CustomerID", "Country").limit(60).collect()
    assert board.transactions(3)[0].collect() == by_amount[40:60]
    last = by_amount[39].asDict()
    assert board.transactions_after(last).collect() == by_amount[40:60]
    rising = board.transactions(1, descending=False)[0].collect()
    assert [r.Position for r in rising] == list(range(1, 21)) and rising[0].TotalAmount <= by_amount[-1].TotalAmount
    ids = [r.CustomerID for r in store.read("customer_clusters").collect()]
    assert ids == sorted(ids)


def test_products_and_segments_are_unchanged_by_the_layout(lines, store):
    run_ledger(lines, store)
    fact = clean.ledger_lines(lines)
    assert store.read("top_products_revenue").collect() == products.top_by_revenue(products.per_product(fact)).collect()
    expected = customers.segment_statistics(customers.rfm_by_lines(rollups.invoice_rollup(fact)))
    assert sorted(store.read("customer_segments").collect()) == sorted(expected.collect())


def test_lines_are_joined_once_for_their_copies(spark):
    """The copies come from rows that are there, not from a second run of the joins; they are still there to be dropped."""
    plan = QUERIES["x8_without_exact_copies"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem") <= 1 and plan.count("l_orderkey#") and plan.count("Join ") == 4 and "Generate explode" in plan


def test_buckets_grow_with_the_table_and_not_in_size(spark, monkeypatch):
    monkeypatch.setattr("tillroll.sources.store.ROWS_PER_BUCKET", 500)
    frame = QUERIES["s5_bucketed_invoices"](spark, "/root/testdata/sf0.001")  # 6 000 lines
    assert "SelectedBucketsCount: 12 out of 12" in plan_of(frame) and plan_of(frame).count("Exchange") == 0
    assert [bucket_count(rows) for rows in (0, 4_000, 4_001)] == [8, 8, 9]
