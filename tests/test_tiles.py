import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import tiles
from tillroll.operators.tiles import add_tiles


def compare(spark, values, n=5):
    rows = [(f"c{i:05d}", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id string, v int").repartition(4).cache()
    made = add_tiles(df, {"up": ("v", False), "down": ("v", True)}, ("id",), n)
    both = made.withColumns(
        {
            "up_sql": F.ntile(n).over(Window.orderBy("v", "id")),
            "down_sql": F.ntile(n).over(Window.orderBy(F.desc("v"), "id")),
        }
    )
    wrong = both.filter("up <> up_sql OR down <> down_sql").count()
    df.unpersist()
    assert wrong == 0
    return made


@pytest.mark.parametrize("kind", ["unique", "ties", "one value", "a third equal", "nulls"])
def test_same_tiles_as_the_window_function(spark, kind):
    dice = random.Random(3)
    values = {
        "unique": dice.sample(range(10_000), 503),
        "ties": [dice.randrange(6) for _ in range(503)],
        "one value": [4] * 503,
        "a third equal": [7 if i % 3 == 0 else dice.randrange(1000) for i in range(503)],
        "nulls": [None if i % 10 == 0 else dice.randrange(50) for i in range(503)],
    }[kind]
    compare(spark, values)


@pytest.mark.parametrize("rows", [1, 3, 4, 5, 6, 7, 8, 9, 10])
def test_small_inputs_of_every_remainder(spark, rows):
    compare(spark, list(range(rows)))


def test_empty_input(spark):
    df = spark.createDataFrame([], "id string, v int")
    assert add_tiles(df, {"tile": ("v", False)}, ("id",)).count() == 0


def test_large_inputs_are_not_gathered_in_one_task(spark, monkeypatch):
    plans = []
    written = tiles.cut
    monkeypatch.setattr(tiles, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or written(df))
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 97).cast("int").alias("v"))
    made = add_tiles(df, {"tile": ("v", False)}, ("id",))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert len(plans) == 1 and "rangepartitioning" in plans[0] and "SinglePartition" not in plans[0]
    sizes = sorted(r["count"] for r in made.groupBy("tile").count().collect())
    assert sizes == [1000] * 5
