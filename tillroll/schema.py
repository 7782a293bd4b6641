"""Column types shared by every module."""

from pyspark.sql import types as T

# Prices are multiplied and added with ten places, and stay as read in their own column; amounts are whole cents.
PRICE = T.DecimalType(27, 10)
MONEY = T.DecimalType(18, 2)

RAW_COLUMNS = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
)

CALENDAR = ("Year", "Month", "DayOfWeek", "Hour")

_RAW_TYPES = {
    "Quantity": T.IntegerType(),
    "UnitPrice": T.DoubleType(),
    "CustomerID": T.DoubleType(),
}


def raw_schema(date_type: T.DataType | None = None) -> T.StructType:
    """Schema of one raw invoice line; the date is text unless a type is given."""
    types = {**_RAW_TYPES, "InvoiceDate": date_type or T.StringType()}
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in RAW_COLUMNS])
