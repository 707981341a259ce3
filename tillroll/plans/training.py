"""The two regression models over cleaned lines, and their joint predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from tillroll.functions.calendar import DEFAULT_HOLIDAYS
from tillroll.operators.calendar import create_temporal_features, daily_model_frame
from tillroll.operators.models import (
    DEMAND_GRID,
    SEED,
    Fitted,
    actual_vs_predicted,
    fit_demand_model,
    fit_sales_forecast,
)


def model_predictions(
    lines: DataFrame,
    holidays=DEFAULT_HOLIDAYS,
    grid: Mapping[str, Sequence[Any]] = DEMAND_GRID,
    fraction: float = 1.0,
    seed: int = SEED,
    demand: Fitted | None = None,
) -> DataFrame:
    """Held-out (model, actual, predicted) rows of the forecast and the demand model.

    ``demand`` is a demand model fitted on the same lines already.
    """
    forecast = fit_sales_forecast(daily_model_frame(lines, holidays), seed)
    demand = demand or fit_demand_model(create_temporal_features(lines, holidays), fraction, grid, seed)
    return actual_vs_predicted(
        forecast.predictions, "linear_regression", "daily_revenue"
    ).unionByName(actual_vs_predicted(demand.predictions, "random_forest", "Quantity"))
