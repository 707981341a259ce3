"""The invoice-line schema every source is read with."""

from pyspark.sql.types import StructType

# Column names, types and timestamp layout of the invoice-line table.
RETAIL_SCHEMA = (
    StructType()
    .add("InvoiceNo", "string")
    .add("StockCode", "string")
    .add("Description", "string")
    .add("Quantity", "integer")
    .add("InvoiceDate", "timestamp")
    .add("UnitPrice", "double")
    .add("CustomerID", "double")
    .add("Country", "string")
)
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
