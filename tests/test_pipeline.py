"""The stages write every result a full run is expected to leave behind."""

import pytest
from pyspark.sql import functions as F

from tillroll.plans import pipeline
from verification.queries import HOLIDAYS, HOME, raw


@pytest.fixture(scope="module")
def out(spark, folder, tmp_path_factory):
    target = tmp_path_factory.mktemp("out")
    pipeline.run_all(
        raw(spark, folder),
        str(target),
        holidays=HOLIDAYS,
        home_country=HOME,
        grid={"maxDepth": [2], "numTrees": [3]},
        forest={"numTrees": 5, "maxDepth": 3},
    )
    return target


def read(spark, out, name):
    return spark.read.csv(str(out / name), header=True, inferSchema=True)


def test_reports_are_single_files(out):
    for name in (
        "metrics.csv",
        "top_products.csv",
        "daily_sales.csv",
        "sales_by_country.csv",
        "fairness_report.csv",
    ):
        assert len(list((out / name).glob("part-*.csv"))) == 1, name


def test_totals_agree_across_files(spark, out):
    figures = {r["name"]: r["value"] for r in read(spark, out, "metrics.csv").collect()}
    days = read(spark, out, "daily_sales.csv").agg(
        F.sum("daily_revenue"), F.sum("transactions"), F.sum("units_sold")
    )
    revenue, invoices, units = days.first()
    countries = read(spark, out, "sales_by_country.csv").agg(F.sum("total_revenue")).first()[0]
    assert revenue == pytest.approx(figures["total_sales"], abs=0.01)
    assert countries == pytest.approx(figures["total_sales"], abs=0.01)
    assert invoices == figures["number_of_transactions"]
    assert units == figures["total_quantity_sold"]


def test_countries_are_listed_by_revenue(spark, out):
    (file,) = (out / "sales_by_country.csv").glob("part-*.csv")
    revenue = [float(line.split(",")[1]) for line in file.read_text().splitlines()[1:]]
    assert revenue == sorted(revenue, reverse=True)


def test_scaled_features_have_no_mean(spark, out):
    scaled = read(spark, out, "customer_features_scaled.csv")
    assert scaled.count() == read(spark, out, "customer_features.csv").count()
    assert scaled.agg(F.avg("total_revenue")).first()[0] == pytest.approx(0.0, abs=1e-9)


def test_predictions_of_both_models(spark, out):
    models = spark.read.parquet(str(out / "predictions.parquet")).select("model").distinct()
    assert {r["model"] for r in models.collect()} == {"linear_regression", "random_forest"}


def test_flat_report_and_document(spark, out):
    flat = read(spark, out, "fairness_report.csv")
    assert flat.columns == ["segment", "n", "auc_roc", "precision", "recall", "f1"]
    document = spark.read.json(str(out / "evaluation_results.json"), multiLine=True).first()
    assert document["overall_metrics"]["n"] == flat.agg(F.sum("n")).first()[0]
