"""Forests as a relation: importances, walks and attribution against the library and plain sums."""

import itertools
import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tillroll.operators import attribution, calendar, forests, models
from verification.queries import HOLIDAYS, clean_lines

FEATURES = ["a", "b", "c", "d", "e"]


def made(spark, n, features=FEATURES, seed=3):
    rng = random.Random(seed)
    rows = [(i, *[rng.choice([0.0, 1.0, rng.uniform(-2, 2)]) for _ in features]) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(["id int", *[f"{f} double" for f in features]]))
    noisy = F.col(features[0]) * F.col(features[1]) + F.col(features[2]) + F.col("id") % 3 / 4
    return df.withColumn("y", noisy).withColumn("label", (noisy > 0.4).cast("double"))


@pytest.fixture(scope="module")
def table(spark):
    return made(spark, 400).cache()


@pytest.fixture(scope="module", params=["class", "number"])
def forest(request, table):
    data = models.assemble(table, FEATURES)
    if request.param == "class":
        return RandomForestClassifier(numTrees=7, maxDepth=5, seed=1).fit(data)
    return RandomForestRegressor(numTrees=7, maxDepth=5, seed=1, labelCol="y").fit(data)


def scored(model, rows):
    found = model.transform(models.assemble(rows, FEATURES))
    if "probability" in found.columns:
        found = found.withColumn("prediction", models.vector_to_array("probability")[1])
    return {r["id"]: r["prediction"] for r in found.collect()}


def test_importances_are_the_library_s(spark, forest):
    nodes = forests.forest_nodes(forest, spark)
    expected = models.feature_importances(forest, FEATURES, spark).collect()
    got = forests.node_importances(nodes, FEATURES).collect()
    assert [r["feature"] for r in got] == [r["feature"] for r in expected]
    assert [r["importance"] for r in got] == pytest.approx([r["importance"] for r in expected], abs=1e-12)


def test_walks_end_where_the_library_s_do(spark, forest, table):
    nodes = forests.forest_nodes(forest, spark)
    assert nodes.where("left IS NULL").count() == nodes.where("right IS NULL AND threshold IS NULL AND gain IS NULL").count()
    got = {r["id"]: r["score"] for r in forests.walk_forest(table, nodes, FEATURES).collect()}
    assert got == pytest.approx(scored(forest, table), abs=1e-12)
    odd = table.limit(3).withColumn("c", F.lit(None).cast("double"))
    assert {r["score"] for r in forests.walk_forest(odd, nodes, FEATURES).collect()} == {None}
    assert forests.walk_forest(table.limit(0), nodes, FEATURES).count() == 0


def test_attribution_equals_that_by_coalitions(spark, forest, table):
    rows, nodes = table.where("id < 60"), forests.forest_nodes(forest, spark)
    background = attribution.background_rows(table, FEATURES, ["id"], 25)

    def score(variants):
        found = forest.transform(models.assemble(variants, FEATURES))
        if "probability" in found.columns:
            return found.withColumn("score", models.vector_to_array("probability")[1])
        return found.withColumn("score", F.col("prediction"))

    expected = attribution.shapley_values(rows, background, FEATURES, score, ["id"])
    got = forests.forest_shapley(rows, background, FEATURES, nodes, ["id"])
    assert got.columns == expected.columns and got.dtypes == expected.dtypes
    for g, e in zip(sorted(got.collect()), sorted(expected.collect()), strict=True):
        assert tuple(g) == pytest.approx(tuple(e), abs=1e-9)


def test_thirty_features_against_orders(spark):
    features = [f"f{i}" for i in range(30)]
    data = made(spark, 300, features, seed=8)
    model = RandomForestRegressor(numTrees=3, maxDepth=4, seed=2, labelCol="y").fit(models.assemble(data, features))
    nodes = forests.forest_nodes(model, spark)
    background = attribution.background_rows(data, features, ["id"], 6)
    plan = forests.forest_shapley(data, background, features, nodes, ["id"])
    text = plan._jdf.queryExecution().toString()
    assert "Generate" not in text
    trees = forests.forest_trees(nodes)
    used = sorted({int(f) for t in trees for f in t.feature if f >= 0})
    others = [[r[f] for f in features] for r in background.collect()]
    weights = [r["weight"] for r in background.collect()]
    value = lambda point: sum(float(t.walk(forests.np.array([point]))[0]) for t in trees) / 3
    rng = random.Random(1)
    for r in plan.where("id < 4").collect():
        phi = [r[f"phi_{f}"] for f in features]
        assert sum(phi) == pytest.approx(r["score"] - r["base_value"], abs=1e-9)
        assert all(phi[f] == 0 for f in range(30) if f not in used)
        own = [r[f] for f in features]
        # Efficiency for one background row at a time, whatever the order in which features join.
        for other, order in itertools.product(others[:2], [rng.sample(range(30), 30)]):
            point = list(other)
            for f in order:
                point[f] = own[f]
            assert value(point) == pytest.approx(r["score"], abs=1e-12)
    mean = sum(w * value(o) for w, o in zip(weights, others, strict=True)) / sum(weights)
    assert plan.first()["base_value"] == pytest.approx(mean, abs=1e-12)
    with pytest.raises(ValueError):
        forests.forest_shapley(data, background, ["f0"] * 63, nodes, ["id"])


def test_a_forest_without_splits(spark, table):
    flat = models.assemble(table.withColumn("y", F.lit(2.5)), FEATURES)
    nodes = forests.forest_nodes(RandomForestRegressor(numTrees=2, labelCol="y").fit(flat), spark)
    assert {r["importance"] for r in forests.node_importances(nodes, FEATURES).collect()} == {0.0}
    background = attribution.background_rows(table, FEATURES, ["id"], 3)
    [row] = forests.forest_shapley(table.where("id = 1"), background, FEATURES, nodes, ["id"]).collect()
    assert row["score"] == row["base_value"] == 2.5 and row["phi_a"] == 0.0


def test_tuning_follows_values_not_places(spark, folder):
    lines = calendar.create_temporal_features(clean_lines(spark, folder), HOLIDAYS).cache()
    grid = {"maxDepth": [2, 4], "numTrees": [5]}
    found = [models.fit_demand_model(lines.repartition(n), fraction=0.6, grid=grid) for n in (2, 17)]
    assert found[0].tuning == found[1].tuning and len(found[0].tuning) == 2
    scores = [sorted(r["prediction"] for r in f.predictions.collect()) for f in found]
    assert scores[0] == scores[1]
    lines.unpersist()
