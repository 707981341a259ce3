"""Every operator as a query over the star tables of a folder.

Doubles that are sums or means in no fixed order are rounded here, so that they can
be compared by value; the operators return them as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import (
    attribution,
    calendar,
    cleaning,
    customers,
    evaluation,
    forests,
    layout,
    metrics,
    models,
    profiling,
    sampling,
    scaling,
)
from tillroll.plans import churn, kpis, training, workload
from tillroll.sources import RETAIL_SCHEMA, load_checked_sales, write_csv
from tillroll.sources.star import retail_view, star_table

# Parameters the SQL side repeats.
HOME = "NATION_0"
HOLIDAYS = [f"{year}-{day}" for year in range(1995, 2002) for day in ("01-01", "12-25", "12-26")]
PRICE_THRESHOLD = 1000.0
SCORE_THRESHOLD = 0.12
BACKGROUND = 50
CAP_FACTOR = 0.25
LAYOUT_PARTITIONS = 24

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return retail_view(spark, sf)


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Valid sales with raw revenue."""
    return cleaning.add_revenue(cleaning.remove_invalid_sales(raw(spark, sf)), digits=None)


def clean_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Clean lines of known customers, with revenue to the cent."""
    return cleaning.add_revenue(cleaning.clean_data(raw(spark, sf)))


def customer_features(lines: DataFrame) -> DataFrame:
    return customers.from_one_reading(customers.create_customer_features, lines)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return customers.from_one_reading(
        customers.churn_table, clean_lines(spark, sf), home_country=HOME
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Churn labels with a score by a fixed rule, so that the metrics are checkable.

    The table is checkpointed, as predictions of a model would be: metrics read them twice.
    """
    score = F.lit(1.0) / (1 + F.col("total_purchases"))
    return labelled(spark, sf).select(
        "CustomerID",
        "segment",
        "label",
        score.alias("score"),
        (score > SCORE_THRESHOLD).cast("double").alias("prediction"),
    )


def _csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """All lines, written as CSV to the shared folder and read back."""
    path = f"{layout.checkpoint_folder(spark)}/lines-{uuid.uuid4().hex}"
    write_csv(raw(spark, sf), path)
    back = load_checked_sales(spark, path)
    # The source's times have no zone.
    back = back.withColumn("InvoiceDate", F.col("InvoiceDate").cast("timestamp_ntz"))
    return back.select(*RETAIL_SCHEMA.fieldNames(), F.size("rejects").alias("n_rejects"))


def _written_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The audit that the write of the cleaned lines carries."""
    path = f"{layout.checkpoint_folder(spark)}/cleaned-{uuid.uuid4().hex}"
    return cleaning.write_cleaned(raw(spark, sf), path, relative_error=0)


def _cleaning_audit(spark: SparkSession, sf: str) -> DataFrame:
    lines = raw(spark, sf)
    identified = cleaning.drop_blank_description(cleaning.drop_missing_customer(lines))
    return cleaning.cleaning_audit(lines, cleaning.median_price(identified, relative_error=0))


def _impute(spark: SparkSession, sf: str) -> DataFrame:
    identified = cleaning.drop_blank_description(cleaning.drop_missing_customer(raw(spark, sf)))
    return cleaning.impute_median_price(identified, relative_error=0)


def _regression(spark: SparkSession, sf: str) -> DataFrame:
    """Units per line against a fixed calendar rule."""
    lines = calendar.create_temporal_features(clean_lines(spark, sf), HOLIDAYS)
    rule = 20.0 + 2 * F.col("day_of_week") - 0.5 * F.col("month")
    predictions = lines.select(
        F.col("Quantity").cast("double").alias("actual"), rule.alias("predicted")
    )
    return _round(evaluation.regression_metrics(predictions), 6, "rmse", "r2")


def _repartition_profile(spark: SparkSession, sf: str) -> DataFrame:
    keys = raw_sales(spark, sf).select("Country", "InvoiceNo", "StockCode")
    spread = layout.repartition_by(keys, ["Country"], salt_on=["InvoiceNo", "StockCode"], salts=8)
    return layout.repartition_profile(spread, ["Country"])


def _hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per country, and whether the layout spreads it over several partitions."""
    keys = raw_sales(spark, sf).select("Country", "InvoiceNo", "StockCode")
    placed = layout.hot_key_placement(
        keys, ["Country"], LAYOUT_PARTITIONS, ["InvoiceNo", "StockCode"]
    )
    return placed.groupBy("Country").agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.min("partition") < F.max("partition")).alias("spread"),
    )


def _explained(spark: SparkSession, sf: str) -> DataFrame:
    """Contributions to a rule with an interaction, for every customer."""
    rows = labelled(spark, sf)
    rule = (
        3 * F.col("total_purchases")
        - 2 * F.col("unique_products")
        + 0.5 * F.col("total_purchases") * F.col("unique_products")
        + 0.01 * F.col("average_transaction_value")
    )
    background = attribution.background_rows(
        rows, customers.CHURN_FEATURES, ["CustomerID"], size=BACKGROUND
    )
    reads = ("total_purchases", "unique_products", "average_transaction_value")
    return attribution.shapley_values(
        rows, background, customers.CHURN_FEATURES, rule, ["CustomerID"], reads
    )


def _shapley(spark: SparkSession, sf: str) -> DataFrame:
    long = attribution.contributions(
        _explained(spark, sf), customers.CHURN_FEATURES, ["CustomerID", "score", "base_value"]
    )
    # Adding zero turns a rounded -0.0 into 0.0.
    return long.select(
        "CustomerID",
        "feature",
        *[
            (F.round(c, 6) + F.lit(0.0)).alias(c)
            for c in ("score", "base_value", "feature_value", "contribution")
        ],
    )


def _top_driver(spark: SparkSession, sf: str) -> DataFrame:
    best = attribution.top_driver(
        _explained(spark, sf), customers.CHURN_FEATURES, ["CustomerID"]
    )
    return _round(best, 6, "contribution")


def _forecast(spark: SparkSession, sf: str) -> DataFrame:
    daily = calendar.daily_model_frame(clean_lines(spark, sf), HOLIDAYS)
    return models.actual_vs_predicted(
        models.fit_sales_forecast(daily).predictions, "linear_regression", "daily_revenue"
    )


_FITS: dict[tuple[str, str, str], models.Fitted] = {}


def _fit_once(name: str, spark: SparkSession, sf: str, fit: Callable[[], models.Fitted]) -> models.Fitted:
    """A model fitted once per session and folder; its training rows are checkpointed."""
    key = (spark.sparkContext.applicationId, name, sf)
    if key not in _FITS:
        _FITS[key] = fit()
    return _FITS[key]


def _demand_fit(spark: SparkSession, sf: str) -> models.Fitted:
    lines = calendar.create_temporal_features(clean_lines(spark, sf), HOLIDAYS)
    return _fit_once("demand", spark, sf, lambda: models.fit_demand_model(lines))


def _model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return training.model_predictions(
        clean_lines(spark, sf), HOLIDAYS, demand=_demand_fit(spark, sf)
    )


def _demand_walk(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out lines, and on how many the walk through the node table gives the model's units."""
    fitted = _demand_fit(spark, sf)
    nodes = forests.forest_nodes(fitted.model, spark)
    walked = forests.walk_forest(fitted.predictions, nodes, models.DEMAND_FEATURES)
    near = F.abs(F.col("score") - F.col("prediction")) <= 1e-9 * F.greatest(F.lit(1.0), F.abs("prediction"))
    return walked.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(near).alias("n_agree"))


def _churn_walk(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out customers, and whether the walk through the node table gives the model's score."""
    fitted = _churn_fit(spark, sf)
    nodes = forests.forest_nodes(fitted.model, spark)
    walked = forests.walk_forest(
        fitted.predictions, nodes, customers.CHURN_FEATURES, name="walked"
    )
    near = F.abs(F.col("walked") - F.col("score")) <= 1e-9
    return walked.select("CustomerID", "label", near.alias("agrees"))


def _attribution_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out customers, and whether contributions add up to the model's own score."""
    fitted = _churn_fit(spark, sf)
    explained = churn.explain_churn(fitted, fitted.predictions)
    total = sum((F.col(f"phi_{f}") for f in customers.CHURN_FEATURES), F.col("base_value"))
    own = fitted.predictions.select("CustomerID", F.col("score").alias("own"))
    return explained.join(own, "CustomerID").select(
        "CustomerID", "label", (F.abs(total - F.col("own")) <= 1e-9).alias("adds_up")
    )


def _demand_held_out(spark: SparkSession, sf: str) -> DataFrame:
    """Lines and units of a sampled tenth of the training lines, and of all held-out lines."""
    lines = calendar.create_temporal_features(clean_lines(spark, sf), HOLIDAYS)
    train, test = (
        part.agg(F.count(F.lit(1)).alias("n_lines"), F.sum("Quantity").alias("units"))
        for part in models.demand_parts(lines, fraction=0.1)
    )
    return train.withColumn("part", F.lit("sampled_train")).unionByName(
        test.withColumn("part", F.lit("held_out"))
    )


def _normal_equations(spark: SparkSession, sf: str) -> DataFrame:
    """Residuals of the forecast times each input: least squares makes the sums zero."""
    daily = calendar.daily_model_frame(clean_lines(spark, sf), HOLIDAYS)
    fitted = models.fit_sales_forecast(daily)
    rest = F.col("daily_revenue") - F.col("prediction")
    scored = fitted.model.transform(fitted.train)
    sums = scored.agg(
        F.count(F.lit(1)).alias("n_train"),
        *[
            (F.sum(rest * F.col(f)) / F.sum(F.abs(F.col("daily_revenue") * F.col(f)))).alias(f)
            for f in calendar.DAY_FEATURES
        ],
    )
    long = sums.unpivot(["n_train"], list(calendar.DAY_FEATURES), "feature", "moment")
    return long.withColumn("moment", F.round("moment", 6) + F.lit(0.0))


def full_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the full cleaning chain: imputed prices, capped amounts."""
    return cleaning.clean_full(raw(spark, sf), relative_error=0)


def _churn_fit(spark: SparkSession, sf: str) -> models.Fitted:
    return _fit_once("churn", spark, sf, lambda: models.fit_churn_model(labelled(spark, sf)))


def _importances(spark: SparkSession, sf: str) -> DataFrame:
    return models.feature_importances(
        _churn_fit(spark, sf).model, customers.CHURN_FEATURES, spark
    )


def _churn_explanations(spark: SparkSession, sf: str) -> DataFrame:
    fitted = _churn_fit(spark, sf)
    explained = churn.explain_churn(fitted, fitted.predictions)
    return attribution.contributions(
        explained, customers.CHURN_FEATURES, ["CustomerID", "label", "score", "base_value"]
    )


def _holidays_by_table(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar taken from the orders: the 25th and 26th of December and New Year."""
    days = star_table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("day")
    )
    listed = F.date_format("day", "MM-dd").isin("01-01", "12-25", "12-26")
    return calendar.holiday_flag_calendar(raw(spark, sf), days.where(listed))


def _scaled(spark: SparkSession, sf: str) -> DataFrame:
    features = customer_features(clean_lines(spark, sf))
    scaled = scaling.scale_features(features)
    return scaled.select(
        "CustomerID",
        *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in customers.SCALED_FEATURES],
    )


QUERIES: dict[str, Query] = {
    # exploration
    "dataset_shape": lambda s, d: profiling.dataset_shape(raw(s, d)),
    "preview": lambda s, d: profiling.preview(raw(s, d)),
    "schema_listing": lambda s, d: profiling.schema_listing(raw(s, d)),
    "null_profile": lambda s, d: profiling.null_profile(raw(s, d)),
    "cleaning_audit": _cleaning_audit,
    "written_audit": _written_audit,
    "csv_roundtrip": _csv_roundtrip,
    # projections, filters, cleaning
    "add_revenue": lambda s, d: cleaning.add_revenue(raw(s, d)),
    "remove_invalid_sales": lambda s, d: cleaning.remove_invalid_sales(raw(s, d)),
    "drop_missing_customer": lambda s, d: cleaning.drop_missing_customer(raw(s, d)),
    "drop_blank_description": lambda s, d: cleaning.drop_blank_description(raw(s, d)),
    "impute_median_price": _impute,
    "iqr_bounds": lambda s, d: _round(
        cleaning.iqr_bounds(cleaning.clean_data(raw(s, d)), relative_error=0), 6, "lower", "upper"
    ),
    "iqr_outliers": lambda s, d: cleaning.iqr_outliers(
        cleaning.clean_data(raw(s, d)), relative_error=0
    ),
    "iqr_outlier_counts": lambda s, d: cleaning.iqr_outlier_counts(
        cleaning.clean_data(raw(s, d)), k=CAP_FACTOR, relative_error=0
    ),
    "cap_outliers_iqr": lambda s, d: cleaning.cap_outliers_iqr(
        cleaning.clean_data(raw(s, d)), cleaning.CAPPED_COLUMNS, k=CAP_FACTOR, relative_error=0
    ),
    "clean_data": lambda s, d: cleaning.clean_data(raw(s, d)),
    "clean_data_keep_guests": lambda s, d: cleaning.clean_data(
        raw(s, d), drop_missing_customer=False
    ),
    "clean_full": lambda s, d: cleaning.clean_full(raw(s, d), relative_error=0),
    "threshold_filter": lambda s, d: raw(s, d).where(
        (F.col("UnitPrice") > PRICE_THRESHOLD) & (F.col("Quantity") % 2 == 0)
    ),
    # metrics
    "total_sales": lambda s, d: metrics.total_sales(raw_sales(s, d)),
    "avg_transaction_value": lambda s, d: metrics.avg_transaction_value(raw_sales(s, d)),
    "distinct_counts": lambda s, d: metrics.distinct_counts(raw_sales(s, d)),
    "aggregate_sales": lambda s, d: metrics.aggregate_sales(clean_lines(s, d)),
    "kpi_summary": lambda s, d: kpis.kpi_summary(raw(s, d)),
    "top_products": lambda s, d: metrics.top_products(raw_sales(s, d)),
    "daily_sales": lambda s, d: metrics.daily_sales(raw_sales(s, d)),
    "daily_sales_sql": lambda s, d: metrics.daily_sales_sql(raw_sales(s, d)),
    "sales_by_country": lambda s, d: metrics.sales_by_country(raw_sales(s, d)),
    "distinct_countries": lambda s, d: metrics.distinct_countries(raw(s, d)),
    "basic_stats": lambda s, d: _round(
        metrics.basic_stats(raw_sales(s, d), "Revenue"), 2, "avg_value", "max_value", "min_value"
    ),
    "range_stats": lambda s, d: metrics.number_stats(raw(s, d), "Quantity"),
    # workload
    "country_revenue": lambda s, d: _round(metrics.country_revenue(raw_sales(s, d)), 2, "rev"),
    "top_stockcodes": lambda s, d: metrics.top_stockcodes(raw_sales(s, d)),
    "customer_orders_revenue": lambda s, d: _round(
        metrics.customer_orders_revenue(raw_sales(s, d)), 2, "rev"
    ),
    "daily_rollup": lambda s, d: _round(metrics.daily_rollup(raw_sales(s, d)), 2, "rev"),
    "daily_rollup_stats": lambda s, d: _round(
        metrics.daily_rollup_stats(metrics.daily_rollup(raw_sales(s, d))),
        2,
        "total_rev",
        "avg_rev",
    ),
    "best_day": lambda s, d: _round(
        metrics.best_day(metrics.daily_rollup(raw_sales(s, d))), 2, "rev"
    ),
    "workload": lambda s, d: _round(workload.workload(raw(s, d)), 2, "rev"),
    "workload_once": lambda s, d: _round(workload.workload_once(raw(s, d)), 2, "rev"),
    "repartition_profile": _repartition_profile,
    "hot_key_placement": _hot_keys,
    # calendar and customer features
    "temporal_features": lambda s, d: calendar.create_temporal_features(raw(s, d), HOLIDAYS),
    "holiday_flag": lambda s, d: calendar.holiday_flag(raw(s, d), HOLIDAYS),
    "holiday_flag_udf": lambda s, d: calendar.holiday_flag_udf(raw(s, d), HOLIDAYS),
    "holiday_flag_calendar": _holidays_by_table,
    "daily_model_frame": lambda s, d: _round(
        calendar.daily_model_frame(clean_lines(s, d), HOLIDAYS), 2, "daily_revenue"
    ),
    "customer_avg_transaction": lambda s, d: metrics.customer_avg_transaction(clean_lines(s, d)),
    "customer_avg_transaction_raw": lambda s, d: metrics.customer_avg_transaction(raw_sales(s, d)),
    "customer_features_full": lambda s, d: customer_features(full_lines(s, d)),
    "churn_table_full": lambda s, d: customers.from_one_reading(
        customers.churn_table, full_lines(s, d), home_country=HOME
    ),
    "daily_model_frame_full": lambda s, d: _round(
        calendar.daily_model_frame(full_lines(s, d), HOLIDAYS), 2, "daily_revenue"
    ),
    "customer_features": lambda s, d: customer_features(clean_lines(s, d)),
    "scaled_customer_features": _scaled,
    "churn_table": labelled,
    # sampling
    "sample_lines": lambda s, d: sampling.sample_rows(raw(s, d)),
    "train_test_split": lambda s, d: sampling.label_split(labelled(s, d), keys=["CustomerID"]),
    # evaluation
    "regression_metrics": _regression,
    "auc_roc": lambda s, d: _round(evaluation.auc_roc(scored(s, d)), 10, "auc_roc"),
    "classification_metrics": lambda s, d: evaluation.classification_metrics(scored(s, d)),
    "segment_metrics": lambda s, d: evaluation.segment_metrics(scored(s, d)),
    "fairness_report": lambda s, d: evaluation.fairness_report(
        evaluation.segment_metrics(scored(s, d))
    ),
    "shapley_attribution": _shapley,
    "top_driver": _top_driver,
    # models
    "sales_forecast": _forecast,
    "forecast_held_out": lambda s, d: _round(
        models.fit_sales_forecast(
            calendar.daily_model_frame(clean_lines(s, d), HOLIDAYS)
        ).predictions.select("sale_date", F.col("daily_revenue").alias("actual")),
        2,
        "actual",
    ),
    "forecast_normal_equations": _normal_equations,
    "demand_model": lambda s, d: models.actual_vs_predicted(
        _demand_fit(s, d).predictions, "random_forest", "Quantity"
    ),
    "demand_held_out": _demand_held_out,
    "demand_importances": lambda s, d: models.feature_importances(
        _demand_fit(s, d).model, models.DEMAND_FEATURES, s
    ),
    "tuning_results": lambda s, d: models.tuning_results(_demand_fit(s, d), s),
    "model_metrics": lambda s, d: evaluation.regression_metrics(
        _model_predictions(s, d), ["model"]
    ),
    "churn_held_out": lambda s, d: _churn_fit(s, d).predictions.select("CustomerID", "label"),
    "model_predictions": _model_predictions,
    "demand_walk": _demand_walk,
    "churn_walk": _churn_walk,
    "attribution_sums": _attribution_sums,
    "churn_predictions": lambda s, d: _churn_fit(s, d).predictions,
    "feature_importances": _importances,
    "churn_explanations": _churn_explanations,
    "churn_document": lambda s, d: churn.evaluate_churn(labelled(s, d))[0],
}
