"""One key with most of the lines: whole results, and no task that gets the whole key."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import customers, metrics
from verification.queries import clean_lines

_HOT_DAY = "TIMESTAMP_NTZ'2011-05-01 10:00:00'"
_OTHER_DAYS = "TIMESTAMP_NTZ'2011-06-01 10:00:00' + make_dt_interval(CAST(id % 9 AS INT))"


@pytest.fixture(scope="module")
def skewed(spark):
    """6,000 lines, two thirds of them of one customer, day, country and product."""
    hot = F.col("id") % 3 < 2
    lines = spark.range(6000).select(
        F.concat(F.lit("i"), F.col("id") % 1500).alias("InvoiceNo"),
        F.when(hot, "hot").otherwise((F.col("id") % 50).cast("string")).alias("StockCode"),
        F.lit("thing").alias("Description"),
        (F.col("id") % 7 + 1).cast("int").alias("Quantity"),
        F.when(hot, F.expr(_HOT_DAY)).otherwise(F.expr(_OTHER_DAYS)).alias("InvoiceDate"),
        ((F.col("id") % 11 + 1) / 4).alias("UnitPrice"),
        F.when(hot, 1.0).otherwise((F.col("id") % 40).cast("double") + 2).alias("CustomerID"),
        F.when(hot, "home").otherwise("abroad").alias("Country"),
    )
    kept = lines.withColumn("Revenue", F.round(F.col("Quantity") * F.col("UnitPrice"), 2)).cache()
    yield kept
    kept.unpersist()


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_results_are_whole(skewed):
    rows = skewed.toPandas()
    found = metrics.daily_sales(skewed).toPandas().set_index("sale_date")
    by_day = rows.groupby(rows["InvoiceDate"].dt.date)
    assert found["units_sold"].to_dict() == by_day["Quantity"].sum().to_dict()
    assert found["transactions"].to_dict() == by_day["InvoiceNo"].nunique().to_dict()
    features = customers.create_customer_features(skewed).toPandas().set_index("CustomerID")
    by_customer = rows.groupby("CustomerID")
    assert features["total_purchases"].to_dict() == by_customer["InvoiceNo"].nunique().to_dict()
    assert features["unique_products"].to_dict() == by_customer["StockCode"].nunique().to_dict()
    invoices = rows.groupby(["CustomerID", "InvoiceNo"])["Revenue"].sum()
    baskets = invoices.groupby("CustomerID").mean()
    assert features["average_transaction_value"].to_dict() == pytest.approx(
        baskets.to_dict(), abs=0.00501
    )


@pytest.mark.parametrize(
    "metric, counted",
    [
        (metrics.daily_sales, "InvoiceNo"),
        (metrics.customer_orders_revenue, "InvoiceNo"),
        (customers.create_customer_features, "StockCode"),
        (customers.customer_country, "Country"),
    ],
)
def test_the_shuffle_of_lines_spreads_a_hot_group(skewed, metric, counted):
    """The first exchange hashes on the group and what is counted in it."""
    nearest_to_the_scan = exchanges(metric(skewed))[-1]
    assert counted in nearest_to_the_scan


@pytest.mark.parametrize(
    "metric", [metrics.top_products, metrics.sales_by_country, metrics.daily_rollup]
)
def test_plain_sums_combine_before_the_shuffle(skewed, metric):
    plan = metric(skewed)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan.split("Exchange hashpartitioning")[-1]


def test_customer_tables_do_not_fan_lines_out(spark, folder):
    for table in (
        customers.create_customer_features(clean_lines(spark, folder)),
        customers.churn_table(clean_lines(spark, folder)),
    ):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan


def test_customer_tables_from_one_reading(spark, skewed):
    """The same rows as the lazy tables, and no line read more than once."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(_):
        read.add(1)
        return True

    watched = skewed.where(seen.asNondeterministic()("InvoiceNo"))
    for table in (customers.create_customer_features, customers.churn_table):
        before = read.value
        got = customers.from_one_reading(table, watched)
        assert sorted(got.collect()) == sorted(table(skewed).collect())
        assert read.value - before == skewed.count() and got.dtypes == table(skewed).dtypes
