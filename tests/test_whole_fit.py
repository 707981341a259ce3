"""The demand model is fitted on every training line."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll.operators import calendar, cleaning, forests, models
from tillroll.plans import training
from verification import queries

GRID = {"maxDepth": [2], "numTrees": [3]}


@pytest.fixture
def lines(make_lines):
    """Lines of 40 days, a few at a time alike in all that tells lines apart."""
    rows = [
        {
            "InvoiceNo": str(i // 4),
            "StockCode": "AB"[i % 2],
            "Quantity": 1 + i % 7,
            "UnitPrice": 0.5 + i % 11,
            "InvoiceDate": dt.datetime(2011, 1, 1, 8 + i % 9) + dt.timedelta(days=i % 40),
        }
        for i in range(320)
    ]
    return cleaning.add_revenue(make_lines(*rows, *rows[:30]))


def test_every_line_is_fitted_or_held_out(lines):
    marked = calendar.create_temporal_features(lines, queries.HOLIDAYS)
    train, held_out = models.demand_parts(marked)
    found = models.fit_demand_model(marked, grid=GRID)
    assert found.train.count() == train.count() and found.predictions.count() == held_out.count()
    assert found.train.count() + found.predictions.count() == lines.count() == 350
    units = found.train.agg(F.sum("Quantity")).first()[0] + found.predictions.agg(F.sum("Quantity")).first()[0]
    assert units == lines.agg(F.sum("Quantity")).first()[0]


def test_a_share_can_still_be_asked_for(lines):
    marked = calendar.create_temporal_features(lines, queries.HOLIDAYS)
    some, held_out = models.demand_parts(marked, fraction=0.3)
    every, same = models.demand_parts(marked)
    assert 0 < some.count() < every.count() and some.exceptAll(every).isEmpty()
    assert sorted(held_out.collect()) == sorted(same.collect())


def test_importances_are_of_a_forest_of_all_training_lines(spark, lines, monkeypatch):
    monkeypatch.setattr(queries, "clean_lines", lambda *_: lines)
    fit = models.fit_demand_model
    monkeypatch.setattr(models, "fit_demand_model", lambda given: fit(given, grid=GRID))
    monkeypatch.setattr(queries, "_FITS", {})
    found = queries.QUERIES["demand_importances"](spark, "own lines").collect()
    assert {r["feature"] for r in found} == set(models.DEMAND_FEATURES)
    [fitted] = queries._FITS.values()
    assert fitted.train.count() + fitted.predictions.count() == lines.count()
    # A tree draws about as many rows as there are.
    roots = forests.forest_nodes(fitted.model, spark).where("node = 0").collect()
    assert all(r["weight"] == pytest.approx(fitted.train.count(), rel=0.25) for r in roots)


def test_joint_predictions_come_from_a_whole_fit(lines, monkeypatch):
    fits = []
    fit = models.fit_demand_model
    monkeypatch.setattr(training, "fit_demand_model", lambda *given: fits.append(fit(*given)) or fits[-1])
    joint = training.model_predictions(lines, queries.HOLIDAYS, grid=GRID)
    [fitted] = fits
    scored = joint.where("model = 'random_forest'").count()
    assert scored == fitted.predictions.count() > 0
    assert fitted.train.count() + scored == lines.count()
