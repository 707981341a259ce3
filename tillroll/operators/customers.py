"""Customer behaviour features and the labelled table for churn models."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import exact, is_number, mean_amount
from tillroll.operators.layout import checkpointed, staged

# The features a churn model sees, the scaled ones, and the label rule.
CHURN_FEATURES = (
    "total_purchases",
    "total_revenue",
    "average_transaction_value",
    "unique_products",
    "total_quantity",
)
SCALED_FEATURES = (
    "total_purchases",
    "total_quantity",
    "total_revenue",
    "unique_products",
    "days_since_last_purchase",
    "average_transaction_value",
)
# What a customer table reads of the lines.
_LINE_COLUMNS = (
    "CustomerID",
    "InvoiceNo",
    "Country",
    "StockCode",
    "InvoiceDate",
    "Quantity",
    "Revenue",
)
CHURN_DAYS = 90
HOME_COUNTRY = "United Kingdom"
ABROAD = "International"


def snapshot_date(df: DataFrame) -> DataFrame:
    """Time of the last line, as a one-row relation."""
    return df.agg(F.max("InvoiceDate").alias("snapshot"))


def _customers(df: DataFrame) -> DataFrame:
    """One row per customer, folded from lines by way of invoices.

    Lines fold on the map side to (customer, invoice, country) with plain sums and times; what
    is left is small, and distinct invoices are rows of it. Distinct products are counted
    beside it on (customer, product). No line is fanned out for a distinct count, and a
    customer with a third of all lines is spread over invoices and products.
    """
    per_country = df.groupBy("CustomerID", "InvoiceNo", "Country").agg(
        F.sum("Quantity").alias("units"),
        F.sum("Revenue").alias("revenue"),
        F.sum(exact()).alias("exact_revenue"),
        F.count_if(~is_number()).alias("odd"),
        F.count("Revenue").alias("priced"),
        F.min("InvoiceDate").alias("since"),
        F.max("InvoiceDate").alias("until"),
    )
    start = F.struct(F.col("since").isNull(), "since", "Country")
    per_invoice = per_country.groupBy("CustomerID", "InvoiceNo").agg(
        *[F.sum(c).alias(c) for c in ("units", "revenue", "exact_revenue", "odd", "priced")],
        F.max("until").alias("until"),
        F.min(F.when(F.col("Country").isNotNull(), start)).alias("start"),
    )
    basket = mean_amount(
        F.sum("exact_revenue"), F.sum("revenue"), F.sum("odd"), F.count_if(F.col("priced") > 0)
    )
    customers = per_invoice.groupBy("CustomerID").agg(
        F.count("InvoiceNo").alias("total_purchases"),
        F.sum("units").alias("total_quantity"),
        F.round(F.sum("revenue"), 2).alias("total_revenue"),
        F.max("until").alias("last_purchase"),
        basket.alias("basket"),
        F.min("start")["Country"].alias("country"),
    )
    products = (
        df.select(F.col("CustomerID").alias("_buyer"), "StockCode")
        .distinct()
        .groupBy("_buyer")
        .agg(F.count("StockCode").alias("unique_products"))
    )
    recency = F.date_diff(snapshot_date(df).scalar(), F.col("last_purchase"))
    return customers.join(products, F.col("CustomerID").eqNullSafe(F.col("_buyer"))).select(
        "CustomerID",
        "total_purchases",
        "total_quantity",
        "total_revenue",
        "unique_products",
        recency.alias("days_since_last_purchase"),
        F.when(F.col("CustomerID").isNotNull(), F.col("basket")).alias(
            "average_transaction_value"
        ),
        "country",
    )


def create_customer_features(df: DataFrame) -> DataFrame:
    """One row per customer: frequency, units, revenue, range, recency, basket value.

    Recency is measured from the last line of the table, a scalar subquery that reads one column
    of it. Lines without a customer form one group, which has no mean basket.
    """
    return _customers(df).drop("country")


def customer_country(df: DataFrame) -> DataFrame:
    """Country of each customer's earliest line; alphabetical among lines of one time.

    Folding to customer and country first keeps the fold over lines a hash
    aggregation (its only measure is a timestamp); text is compared only among the
    few countries of a customer.
    """
    seen = (
        df.where(F.col("Country").isNotNull())
        .groupBy("CustomerID", "Country")
        .agg(F.min("InvoiceDate").alias("since"))
    )
    earliest = F.min_by("Country", F.struct(F.col("since").isNull(), "since", "Country"))
    return seen.groupBy("CustomerID").agg(earliest.alias("country"))


def churn_label(days: str = "days_since_last_purchase", threshold: int = CHURN_DAYS) -> Column:
    """1 after more than ``threshold`` days without a purchase."""
    return F.when(F.col(days) > threshold, 1).otherwise(0)


def segment(country: str = "country", home: str = HOME_COUNTRY) -> Column:
    """The home country by name, everything else (and no country) as one segment."""
    return F.when(F.col(country) == home, home).otherwise(ABROAD)


def churn_table(
    df: DataFrame, home_country: str = HOME_COUNTRY, churn_days: int = CHURN_DAYS
) -> DataFrame:
    """Customer features with country, churn label and segment, from the same fold of lines.

    Guests form one row with a country of its own.
    """
    return _customers(df).withColumns(
        {"label": churn_label(threshold=churn_days), "segment": segment(home=home_country)}
    )


def from_one_reading(
    table: Callable[..., DataFrame], lines: DataFrame, **options: Any
) -> DataFrame:
    """A customer table of lines that are dear to read, such as the result of joins.

    ``table`` is :func:`create_customer_features` or :func:`churn_table`, which read their lines three
    times. Here the columns they need are staged as Parquet in the shared folder by one reading; the
    table is checkpointed and the stage removed. Runs jobs.
    """
    with staged(lines.select(*_LINE_COLUMNS)) as kept:
        return checkpointed(table(kept, **options))
