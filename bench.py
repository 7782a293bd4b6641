"""Time the headline runs and queries and print one JSON line.

BENCH_SF_DIR  folder with the star tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per entry after one warm-up; the median is reported (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.plans.dashboard import Dashboard
from tillroll.plans.ledger import run_ledger
from tillroll.plans.recommendations import run_recommendations
from tillroll.plans.segmentation import run_segmentation
from tillroll.registry import QUERIES
from tillroll.sources.star import star_lines
from tillroll.sources.store import ResultStore

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "r2_monthly_by_invoices",
    "r8_top_by_revenue",
    "r9_top_codes_by_quantity",
    "r12_countries_by_invoices",
    "c1_rfm_by_lines",
    "c3_rfm_by_invoices",
    "c7_shopper_segments",
    "b5_item_pairs",
    "b7_brand_line_pairs",
    "v9_transactions_largest",
)


def session(work: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tillroll-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"{work}/checkpoints")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def computed(frame: DataFrame) -> None:
    """Run a query to the end without bringing rows to the driver."""
    frame.write.format("noop").mode("overwrite").save()


def runs(spark: SparkSession, work: str) -> dict[str, Callable[[], None]]:
    store = ResultStore(spark, f"{work}/results")

    def ledger() -> None:
        computed(run_ledger(star_lines(spark, FOLDER), store))

    def segmentation() -> None:
        run_segmentation(star_lines(spark, FOLDER), store)

    def recommendations() -> None:
        lines = star_lines(spark, FOLDER, ("InvoiceNo", "StockCode", "Quantity", "Description", "PType"))
        run_recommendations(lines.withColumn("StockCode", F.col("PType")), store)

    def pages() -> dict[str, Callable[[], None]]:
        """Dashboard reads over the results that the runs have written."""
        board = Dashboard(store)
        last = {"TotalAmount": 1000.0, "InvoiceNo": "0", "CustomerID": "", "Country": ""}
        return {
            "page_overview": lambda: computed(board.overview()[0]),
            "page_customers": lambda: computed(board.customers(2)[0]),
            "page_customers_after": lambda: computed(board.customers_after("500")),
            "page_transactions": lambda: computed(board.transactions(3)[0]),
            "page_transactions_after": lambda: computed(board.transactions_after(last)),
            "page_revenue": lambda: computed(board.revenue()[0]),
            "page_countries": lambda: computed(board.countries()[0]),
        }

    queries = {name: lambda name=name: computed(QUERIES[name](spark, FOLDER)) for name in HEADLINE}
    return {"ledger_run": ledger, "segmentation_run": segmentation, "recommendation_run": recommendations, **pages(), **queries}


def median_seconds(work: Callable[[], None]) -> float:
    seconds = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        work()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="tillroll-bench-") as work:
        spark = session(work)
        seconds = {name: median_seconds(run) for name, run in runs(spark, work).items()}
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "retail runs and queries, median of warm runs, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
