"""Every query with a SQL counterpart gives the same rows in both engines."""

import pytest

from verification.compare import differences
from verification.oracle import ORACLE
from verification.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, name):
    assert differences(spark, folder, name) is None


def test_every_counterpart_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_only_fitted_models_lack_sql():
    assert set(QUERIES) - set(ORACLE) == {
        "sales_forecast",
        "demand_model",
        "demand_importances",
        "tuning_results",
        "model_metrics",
        "model_predictions",
        "churn_predictions",
        "feature_importances",
        "churn_explanations",
        "churn_document",
    }


def test_entry_is_lazy_and_has_rows(spark):
    import __spark_entry__ as contract

    result = contract.entry(spark)
    assert result.columns == ["sale_date", "daily_revenue", "transactions", "units_sold"]
    assert result.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
