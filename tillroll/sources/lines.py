"""Invoice-line files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import parse_time
from tillroll.schema import raw_schema

BAD_RECORD = "_bad_record"


def read_lines(spark: SparkSession, path: str, keep_bad: bool = False) -> DataFrame:
    """CSV with a header and a fixed schema (S1). Malformed fields become null.

    With ``keep_bad`` the original text of malformed rows is returned in ``_bad_record``.
    """
    schema = raw_schema()
    # Header names are checked against the schema: a file with another order of columns fails instead of being misread.
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", keep_bad)
    if keep_bad:
        schema = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", BAD_RECORD)
    return reader.schema(schema).csv(path)


def read_lines_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with inferred types (S2). Inference reads the file a second time; prefer ``read_lines``."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def declare_external(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Catalog table over CSV files that stay where they are; the header line is skipped (S3)."""
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(
            table, path=path, source="csv", schema=raw_schema(T.TimestampType()), header="true"
        )
    return spark.table(table)


def with_times(raw: DataFrame, layout: str | Sequence[str]) -> DataFrame:
    """Parse a text InvoiceDate column; frames that already hold timestamps pass unchanged."""
    if not isinstance(raw.schema["InvoiceDate"].dataType, T.StringType):
        return raw
    return raw.withColumn("InvoiceDate", parse_time(F.col("InvoiceDate"), layout))
