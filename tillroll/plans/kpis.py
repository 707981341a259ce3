"""The key figures report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import lines
from tillroll.operators.cleaning import add_revenue, remove_invalid_sales
from tillroll.operators.metrics import top_products


def _distinct_values(df: DataFrame, counted: dict[str, str]) -> DataFrame:
    """One row: the number of distinct values, without nulls, of each column by its name here."""

    def value(column: str) -> Column:
        # Numbers that compare equal have one text: adding zero turns -0.0 into 0.0.
        number = df.schema[column].dataType.typeName() in ("double", "float")
        return (F.col(column) + F.lit(0.0) if number else F.col(column)).cast("string")

    pairs = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), value(column).alias("value"))
            for kind, column in enumerate(counted.values())
        ]
    )
    distinct = df.select(F.inline(pairs)).where("value IS NOT NULL").distinct()
    return distinct.agg(
        *[F.count_if(F.col("kind") == kind).alias(name) for kind, name in enumerate(counted)]
    )


def headline_figures(raw: DataFrame) -> DataFrame:
    """One row of key figures of the valid sales, and the number of raw lines.

    Two readings of the lines. One has the plain sums and counts all lines. The other makes
    (kind, value) pairs of the columns whose values are counted; pairs are made distinct on the map side
    first, then by a shuffle on both, so a hot product or customer leaves a task as one row.
    A valid sale has an invoice, a quantity and a price, hence the mean over invoices is
    the total over the number of invoices.
    """
    sums = raw.agg(
        F.sum(F.when(lines.is_sale(), lines.revenue(digits=None))).alias("revenue"),
        F.sum(F.when(lines.is_sale(), F.col("Quantity"))).alias("units"),
        F.count(F.lit(1)).alias("lines"),
    )
    counts = _distinct_values(
        raw.where(lines.is_sale()),
        {"invoices": "InvoiceNo", "products": "StockCode", "customers": "CustomerID"},
    )
    # One subquery for all counts, so that the lines are read for them once.
    figures = sums.withColumn("counts", counts.select(F.struct("*")).scalar()).select("*", "counts.*")
    per_invoice = F.col("revenue") / F.nullif(F.col("invoices"), F.lit(0))
    # Names of the report.
    return figures.select(
        F.round("revenue", 2).alias("total_sales"),
        F.round(per_invoice, 2).alias("average_transaction_value"),
        F.col("invoices").alias("number_of_transactions"),
        F.col("units").alias("total_quantity_sold"),
        F.col("products").alias("unique_products"),
        F.col("customers").alias("unique_customers"),
        F.col("lines").alias("total_line_items"),
    )


def kpi_summary(raw: DataFrame, n: int = 5) -> DataFrame:
    """Key figures and best sellers as (section, name, value) rows."""
    figures = headline_figures(raw)
    as_double = figures.select([F.col(c).cast("double") for c in figures.columns])
    summary = as_double.unpivot([], as_double.columns, "name", "value").select(
        F.lit("summary").alias("section"), "name", "value"
    )
    best = top_products(add_revenue(remove_invalid_sales(raw), digits=None), n)
    label = F.format_string("%s (%s)", "Description", "StockCode")
    products = best.select(
        F.lit("top_product_by_quantity").alias("section"),
        label.alias("name"),
        F.col("total_quantity").cast("double").alias("value"),
    )
    return summary.unionByName(products)
