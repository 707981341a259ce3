"""Where invoice lines come from and where results go."""

from tillroll.sources.readers import (
    invoice_lines,
    load_checked_sales,
    load_sales_data,
    query_sales,
    read_lines_parquet,
    register_sales,
    reject_counts,
    rejected_cells,
)
from tillroll.sources.schema import RETAIL_SCHEMA, TIMESTAMP_FORMAT
from tillroll.sources.sinks import write_csv, write_json_document, write_parquet

__all__ = [
    "RETAIL_SCHEMA",
    "TIMESTAMP_FORMAT",
    "invoice_lines",
    "load_checked_sales",
    "load_sales_data",
    "query_sales",
    "read_lines_parquet",
    "register_sales",
    "reject_counts",
    "rejected_cells",
    "write_csv",
    "write_json_document",
    "write_parquet",
]
