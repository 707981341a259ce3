import pytest
from pyspark.sql import functions as F

from tillroll.operators import cleaning, metrics, profiling
from tillroll.plans.kpis import headline_figures, kpi_summary
from tillroll.plans.workload import shared_workload, workload, workload_base
from tillroll.sources import RETAIL_SCHEMA, invoice_lines
from verification.queries import clean_lines, raw, raw_sales


@pytest.fixture(scope="module")
def sales(spark, folder):
    return raw_sales(spark, folder)


def test_headline_row(transactions):
    row = metrics.aggregate_sales(cleaning.add_revenue(cleaning.clean_data(transactions))).first()
    assert row.asDict() == {"total_sales": 26.3, "total_quantity": 11, "num_transactions": 2}


def test_top_product(transactions):
    clean = cleaning.add_revenue(cleaning.clean_data(transactions))
    (best,) = metrics.top_products(clean, n=1).collect()
    assert (best["StockCode"], best["total_quantity"]) == ("K-22", 8)


def test_schema_has_the_eight_columns():
    assert RETAIL_SCHEMA.fieldNames() == [
        "InvoiceNo",
        "StockCode",
        "Description",
        "Quantity",
        "InvoiceDate",
        "UnitPrice",
        "CustomerID",
        "Country",
    ]


def test_ties_are_broken_by_key(make_lines):
    lines = cleaning.add_revenue(
        make_lines(*[{"StockCode": c, "Quantity": 5} for c in "DBCA"], {"StockCode": "E"})
    )
    assert [r["StockCode"] for r in metrics.top_products(lines, 3).collect()] == ["A", "B", "C"]
    assert [r["StockCode"] for r in metrics.top_stockcodes(lines, 3).collect()] == ["A", "B", "C"]


def test_a_code_with_two_names(make_lines):
    lines = cleaning.add_revenue(make_lines({"Description": "x"}, {"Description": "y"}))
    assert metrics.top_products(lines).count() == 2
    assert metrics.top_stockcodes(lines).first()["q"] == 2


def test_totals_agree_across_metrics(sales):
    total = metrics.total_sales(sales).first()["total_sales"]
    by_day = metrics.daily_sales(sales).agg(F.round(F.sum("daily_revenue"), 2)).first()[0]
    by_country = metrics.sales_by_country(sales).agg(F.round(F.sum("total_revenue"), 2)).first()[0]
    assert by_day == pytest.approx(total, abs=0.005)
    assert by_country == pytest.approx(total, abs=0.005)


def test_daily_invoices_sum_to_all_invoices(sales):
    by_day = metrics.daily_sales(sales).agg(F.sum("transactions"), F.sum("units_sold")).first()
    whole = sales.agg(F.count_distinct("InvoiceNo"), F.sum("Quantity")).first()
    assert tuple(by_day) == tuple(whole)


def test_sql_and_dataframe_forms_agree(sales):
    assert metrics.daily_sales(sales).collect() == metrics.daily_sales_sql(sales).collect()


def test_guests_form_one_group(make_lines):
    lines = cleaning.add_revenue(
        make_lines({"CustomerID": None, "InvoiceNo": "1"}, {"CustomerID": None, "InvoiceNo": "2"})
    )
    (row,) = metrics.customer_orders_revenue(lines).collect()
    assert row.asDict() == {"CustomerID": None, "orders": 2, "rev": 2.0}


def test_mean_basket_rounds_half_a_cent_up(make_lines):
    # 0.01 and 0.02 average 0.015, which no double represents.
    lines = cleaning.add_revenue(
        make_lines({"InvoiceNo": "1", "UnitPrice": 0.01}, {"InvoiceNo": "2", "UnitPrice": 0.02})
    )
    assert metrics.customer_avg_transaction(lines).first()["average_transaction_value"] == 0.02


def test_mean_basket_edges(make_lines):
    def mean(*rows):
        lines = make_lines(*rows).withColumn("Revenue", F.col("UnitPrice"))
        return metrics.customer_avg_transaction(lines).first()["average_transaction_value"]

    # Lines without an invoice are one invoice; an invoice without revenue is none.
    assert mean({"InvoiceNo": None, "UnitPrice": 3.0}, {"InvoiceNo": "1", "UnitPrice": 1.0}) == 2.0
    assert mean({"InvoiceNo": "1", "UnitPrice": 3.0}, {"InvoiceNo": "2", "UnitPrice": None}) == 3.0
    assert mean({"UnitPrice": None}) is None
    assert mean({"UnitPrice": -0.05}, {"InvoiceNo": "2", "UnitPrice": 0.0}) == -0.03
    assert str(mean({"UnitPrice": float("nan")})) == "nan"
    assert mean({"UnitPrice": 1e17}) == 1e17


def test_empty_table_has_null_sums_and_zero_counts(make_lines):
    empty = cleaning.add_revenue(make_lines({}).where("false"))
    assert metrics.aggregate_sales(empty).first().asDict() == {
        "total_sales": None,
        "total_quantity": None,
        "num_transactions": 0,
    }
    figures = headline_figures(empty).first()
    assert figures["average_transaction_value"] is None and figures["total_line_items"] == 0


def test_summary_counts_raw_lines(transactions):
    summary = {r["name"]: r["value"] for r in kpi_summary(transactions).collect()}
    assert summary["total_line_items"] == 5.0
    assert summary["number_of_transactions"] == 3.0
    assert summary["JAM JAR (K-57)"] == 9.0


def test_summary_matches_the_single_metrics(spark, folder, sales):
    figures = headline_figures(raw(spark, folder)).first()
    counts = metrics.distinct_counts(sales).first()
    assert figures["total_sales"] == metrics.total_sales(sales).first()[0]
    assert figures["average_transaction_value"] == metrics.avg_transaction_value(sales).first()[0]
    assert figures["number_of_transactions"] == counts["num_transactions"]
    assert figures["unique_products"] == counts["unique_products"]
    assert figures["unique_customers"] == counts["unique_customers"]


def test_employee_table_examples(spark):
    salaries = [45000, 55000, 65000, 50000, 70000]
    df = invoice_lines(spark, [(i, s) for i, s in enumerate(salaries)], "id int, salary int")
    assert df.where(F.col("salary") > 50000).count() == 3
    assert metrics.basic_stats(df, "salary").first().asDict() == {
        "avg_value": 57000.0,
        "max_value": 70000,
        "min_value": 45000,
        "n_rows": 5,
    }


def test_number_examples(spark):
    fifty = metrics.number_stats(spark.range(1, 51), "id").first()
    assert (fifty["sum_of_squares"], fifty["n_even"]) == (42925, 25)
    assert metrics.number_stats(spark.range(1, 101), "id").first()["sum_doubled"] == 10100


def test_preview_is_the_same_for_any_layout(spark, folder):
    lines = raw(spark, folder)
    assert profiling.preview(lines).collect() == profiling.preview(lines.repartition(7)).collect()


@pytest.mark.parametrize("partitions", [1, 7])
def test_answers_do_not_depend_on_layout(spark, folder, partitions):
    lines = clean_lines(spark, folder)
    moved = lines.repartition(partitions)
    for metric in (
        metrics.aggregate_sales,
        metrics.top_products,
        metrics.daily_sales,
        metrics.sales_by_country,
    ):
        assert metric(lines).collect() == metric(moved).collect()
    assert set(metrics.customer_avg_transaction(lines).collect()) == set(
        metrics.customer_avg_transaction(moved).collect()
    )


def rounded(answers):
    def plain(row):
        return tuple(round(v, 2) if isinstance(v, float) else v for v in row)

    return {name: sorted(map(plain, df.collect()), key=str) for name, df in answers.items()}


def test_workload_is_the_same_cached_or_not(spark, folder):
    lines = raw(spark, folder)
    with shared_workload(lines, cache=True) as answers:
        cached = rounded(answers)
    with shared_workload(lines, cache=False) as answers:
        assert cached == rounded(answers)
    assert sum(map(len, cached.values())) == workload(lines).count()


def test_workload_lets_its_cache_go(spark, folder):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with shared_workload(raw(spark, folder)) as answers:
        answers["best_day"].collect()
        assert spark.sparkContext._jsc.getPersistentRDDs().size() > before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_workload_reads_only_what_it_needs(spark, folder):
    assert "Description" not in workload_base(raw(spark, folder)).columns


def test_mean_basket_of_fractions_of_a_cent(make_lines):
    """Three lines of 0.004 in one invoice make 0.012, not three times nothing."""
    lines = cleaning.add_revenue(make_lines(*[{"UnitPrice": 0.004}] * 3), digits=None)
    (row,) = metrics.customer_avg_transaction(lines).collect()
    assert row["average_transaction_value"] == 0.01
    assert metrics.avg_transaction_value(lines).first()[0] == 0.01


def test_mean_basket_of_very_large_amounts(make_lines, spark):
    one = cleaning.add_revenue(make_lines({"UnitPrice": 9e13}), digits=None)
    lines = one.crossJoin(spark.range(2000)).drop("id")
    (row,) = metrics.customer_avg_transaction(lines).collect()
    assert row["average_transaction_value"] == 2000 * 9e13
