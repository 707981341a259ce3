"""The stages from raw lines to reports, each writing its results to a folder.

Cleaned lines are written as parquet and later stages read them from there: the
cleaning runs once, and no stage depends on what an earlier one still has in memory.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import DEFAULT_HOLIDAYS
from tillroll.operators import cleaning, metrics
from tillroll.operators.cleaning import add_revenue, remove_invalid_sales
from tillroll.operators.customers import HOME_COUNTRY, churn_table, create_customer_features
from tillroll.operators.layout import checkpointed
from tillroll.operators.models import CHURN_FOREST, DEMAND_GRID
from tillroll.operators.scaling import apply_scaler, fit_scaler
from tillroll.plans.churn import evaluate_churn, flat_fairness
from tillroll.plans.kpis import kpi_summary
from tillroll.plans.training import model_predictions
from tillroll.sources import read_lines_parquet, write_csv, write_json_document, write_parquet


def write_metrics(raw: DataFrame, out: str) -> None:
    """Key figures, best sellers, daily sales and sales by country of the raw lines."""
    sales = add_revenue(remove_invalid_sales(raw), digits=None)
    write_csv(kpi_summary(raw), f"{out}/metrics.csv", files=1)
    best_first = [F.desc("total_quantity"), "StockCode", "Description"]
    write_csv(metrics.top_products(sales), f"{out}/top_products.csv", best_first, files=1)
    write_csv(metrics.daily_sales(sales), f"{out}/daily_sales.csv", ["sale_date"], files=1)
    largest_first = [F.desc("total_revenue"), "Country"]
    by_country = metrics.sales_by_country(sales)
    write_csv(by_country, f"{out}/sales_by_country.csv", largest_first, files=1)


def write_cleaned(raw: DataFrame, out: str, relative_error: float = 0.01) -> DataFrame:
    """Clean the lines, write them, and return them as read back."""
    audit = cleaning.write_cleaned(raw, f"{out}/cleaned", relative_error=relative_error)
    write_csv(audit, f"{out}/cleaning_audit.csv", ["step"], files=1)
    return read_lines_parquet(raw.sparkSession, f"{out}/cleaned")


def write_customer_features(cleaned: DataFrame, out: str) -> None:
    """Customer features, the fitted scaler, and the scaled features."""
    features = checkpointed(create_customer_features(cleaned))
    write_csv(features, f"{out}/customer_features.csv")
    write_parquet(fit_scaler(features), f"{out}/customer_feature_scaler")
    scaler = features.sparkSession.read.parquet(f"{out}/customer_feature_scaler")
    write_csv(apply_scaler(features, scaler), f"{out}/customer_features_scaled.csv")


def write_predictions(
    cleaned: DataFrame,
    out: str,
    holidays: Iterable[str | dt.date] = DEFAULT_HOLIDAYS,
    grid: Mapping[str, Sequence[Any]] = DEMAND_GRID,
) -> None:
    """Held-out predictions of the forecast and the demand model."""
    write_parquet(model_predictions(cleaned, holidays, grid), f"{out}/predictions.parquet")


def write_churn_report(
    cleaned: DataFrame,
    out: str,
    home_country: str = HOME_COUNTRY,
    forest: Mapping[str, Any] = CHURN_FOREST,
    n_quoted: int = 5,
) -> None:
    """The churn evaluation document and the flat table of its segments."""
    customers = churn_table(cleaned, home_country)
    document, per_segment = evaluate_churn(customers, n_quoted, forest=forest)
    write_json_document(document, f"{out}/evaluation_results.json")
    write_csv(flat_fairness(per_segment), f"{out}/fairness_report.csv", ["segment"], files=1)


def run_all(
    raw: DataFrame,
    out: str,
    holidays: Iterable[str | dt.date] = DEFAULT_HOLIDAYS,
    home_country: str = HOME_COUNTRY,
    grid: Mapping[str, Sequence[Any]] = DEMAND_GRID,
    forest: Mapping[str, Any] = CHURN_FOREST,
) -> None:
    """Every stage in order."""
    write_metrics(raw, out)
    cleaned = write_cleaned(raw, out)
    write_customer_features(cleaned, out)
    write_predictions(cleaned, out, holidays, grid)
    write_churn_report(cleaned, out, home_country, forest)
