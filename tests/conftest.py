import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tillroll-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "checkpoints"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


CSV = """InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country
536365,85123A, white heart ,6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom
536365,85123A,white heart b,2,2010-12-01 08:26:00,2.55,17850.0,United Kingdom
536366,71053,"lantern, red",6,2010-12-02 09:26:00,3.39,,France
C536379,D,Discount,-1,2010-12-03 09:41:00,27.50,14527.0,United Kingdom
C536380,71053,"lantern, red",1,2010-12-03 09:42:00,3.39,14527.0,United Kingdom
536381,71053,free sample,1,2010-12-03 10:00:00,0,14527.0,France
536382,,no code,1,2010-12-03 23:50:00,1.00,14527.0,France
536383,22633,warmer,4,2010-12-04 00:10:00,1.85,17850.0,France
"""


@pytest.fixture(scope="session")
def csv_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("csv") / "lines.csv"
    path.write_text(CSV)
    return str(path)


@pytest.fixture(scope="session")
def raw(spark, csv_path):
    from tillroll.sources.lines import read_lines

    return read_lines(spark, csv_path)
