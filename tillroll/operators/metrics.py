"""Business metrics over invoice lines that carry a ``Revenue`` column.

Every grouped metric combines on the map side before it shuffles, and a distinct
count shuffles on the group together with the counted value, so one day, product,
country or customer with a large share of all lines never lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import exact, is_number, mean_amount, rounded_sum
from tillroll.sources.readers import query_sales


def _units(name: str) -> Column:
    return F.sum("Quantity").alias(name)


def _invoices(name: str) -> Column:
    return F.count_distinct("InvoiceNo").alias(name)


# --- whole-table metrics -------------------------------------------------------


def total_sales(df: DataFrame) -> DataFrame:
    return df.agg(rounded_sum().alias("total_sales"))


def avg_transaction_value(df: DataFrame) -> DataFrame:
    """Mean revenue per invoice, to the cent."""
    per_invoice = df.groupBy("InvoiceNo").agg(
        F.sum(exact()).alias("exact_total"),
        F.sum("Revenue").alias("total"),
        F.count_if(~is_number()).alias("odd"),
    )
    mean = mean_amount(
        F.sum("exact_total"), F.sum("total"), F.sum("odd"), F.count("total")
    )
    return per_invoice.agg(mean.alias("avg_transaction_value"))


def distinct_counts(df: DataFrame) -> DataFrame:
    """Distinct invoices, products and known customers."""
    return df.agg(
        _invoices("num_transactions"),
        F.count_distinct("StockCode").alias("unique_products"),
        F.count_distinct("CustomerID").alias("unique_customers"),
    )


def aggregate_sales(df: DataFrame) -> DataFrame:
    """Headline row: revenue, units and distinct invoices."""
    return df.agg(
        rounded_sum().alias("total_sales"),
        _units("total_quantity"),
        _invoices("num_transactions"),
    )


def basic_stats(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.avg(column).alias("avg_value"),
        F.max(column).alias("max_value"),
        F.min(column).alias("min_value"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def number_stats(df: DataFrame, column: str) -> DataFrame:
    """Sum of squares, count of even values and sum of doubled values of whole numbers."""
    number = F.col(column).cast("bigint")
    return df.agg(
        F.sum(number * number).alias("sum_of_squares"),
        F.count_if(number % 2 == 0).alias("n_even"),
        F.sum(number * 2).alias("sum_doubled"),
    )


# --- per product, country, day and customer ------------------------------------


def top_products(df: DataFrame, n: int = 5) -> DataFrame:
    """Best sellers by units. A code with two names counts as two products."""
    product = ("StockCode", "Description")
    sold = df.groupBy(*product).agg(
        _units("total_quantity"), rounded_sum().alias("total_revenue")
    )
    return sold.orderBy(F.desc("total_quantity"), *product).limit(n)


def top_stockcodes(df: DataFrame, n: int = 5) -> DataFrame:
    """Best sellers by units, by code alone."""
    sold = df.groupBy("StockCode").agg(_units("q"))
    return sold.orderBy(F.desc("q"), "StockCode").limit(n)


def sales_by_country(df: DataFrame) -> DataFrame:
    """Revenue per country, largest first."""
    by_country = df.groupBy("Country").agg(rounded_sum().alias("total_revenue"))
    return by_country.orderBy(F.desc("total_revenue"), "Country")


def country_revenue(df: DataFrame) -> DataFrame:
    return df.groupBy("Country").agg(F.sum("Revenue").alias("rev"))


def distinct_countries(df: DataFrame) -> DataFrame:
    return df.select("Country").distinct()


def daily_sales(df: DataFrame) -> DataFrame:
    """Revenue, invoices and units per day, in date order."""
    by_day = df.groupBy(F.to_date("InvoiceDate").alias("sale_date")).agg(
        rounded_sum().alias("daily_revenue"), _invoices("transactions"), _units("units_sold")
    )
    return by_day.orderBy("sale_date")


def daily_sales_sql(df: DataFrame) -> DataFrame:
    """:func:`daily_sales` asked in SQL."""
    return query_sales(
        df,
        """
        SELECT CAST(InvoiceDate AS DATE) AS sale_date,
               round(sum(Revenue), 2) AS daily_revenue,
               count(DISTINCT InvoiceNo) AS transactions,
               sum(Quantity) AS units_sold
        FROM {sales}
        GROUP BY ALL
        ORDER BY sale_date
        """,
    )


def daily_rollup(df: DataFrame) -> DataFrame:
    """Unrounded revenue and units per day."""
    return df.groupBy(F.to_date("InvoiceDate").alias("d")).agg(
        F.sum("Revenue").alias("rev"), _units("q")
    )


def daily_rollup_stats(daily: DataFrame) -> DataFrame:
    """Total and mean of a daily rollup."""
    return daily.agg(F.sum("rev").alias("total_rev"), F.avg("rev").alias("avg_rev"))


def best_day(daily: DataFrame) -> DataFrame:
    """The day with most revenue; the earlier one of a tie."""
    return daily.orderBy(F.desc("rev"), "d").limit(1)


def customer_orders_revenue(df: DataFrame) -> DataFrame:
    """Distinct invoices and revenue per customer; guests form one group."""
    return df.groupBy("CustomerID").agg(_invoices("orders"), F.sum("Revenue").alias("rev"))


def customer_avg_transaction(df: DataFrame) -> DataFrame:
    """Mean invoice revenue per customer, to the cent.

    The mean over invoices is the revenue over the number of invoices that have
    any, so lines fold to customers in one aggregation.
    """
    return df.groupBy("CustomerID").agg(
        average_transaction_value().alias("average_transaction_value")
    )


def average_transaction_value() -> Column:
    """Revenue of a group of lines per invoice; lines without a number are one invoice."""
    priced = F.col("Revenue").isNotNull()
    invoices = F.count_distinct(F.when(priced, F.struct("InvoiceNo")))
    odd = F.count_if(~is_number())
    return mean_amount(F.sum(exact()), F.sum("Revenue"), odd, invoices)
