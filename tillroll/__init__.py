"""Retail analytics over invoice lines, as Spark relations.

Every function takes DataFrames and parameters and returns a DataFrame. The caller
owns the session. Functions that run jobs before they return (quantiles, model
fitting, checkpoints) say so.
"""

from tillroll.operators.cleaning import (
    add_revenue,
    cap_outliers_iqr,
    clean_data,
    clean_full,
    remove_invalid_sales,
)
from tillroll.operators.calendar import create_temporal_features
from tillroll.operators.customers import churn_table, create_customer_features
from tillroll.operators.metrics import (
    aggregate_sales,
    daily_sales,
    sales_by_country,
    top_products,
)
from tillroll.sources import RETAIL_SCHEMA, load_sales_data

__version__ = "0.1.0"

__all__ = [
    "RETAIL_SCHEMA",
    "add_revenue",
    "aggregate_sales",
    "cap_outliers_iqr",
    "churn_table",
    "clean_data",
    "clean_full",
    "create_customer_features",
    "create_temporal_features",
    "daily_sales",
    "load_sales_data",
    "remove_invalid_sales",
    "sales_by_country",
    "top_products",
]
