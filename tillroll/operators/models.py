"""Models: daily revenue, units per line, customer churn. Fitting runs jobs.

Training data is checkpointed before it is fitted: fitting reads it many times, and
after a lost executor it is read back from the checkpoint folder rather than
computed again from the lines. Splits follow row values, so train and test stay
disjoint through any recomputation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any, NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.hashing import below
from tillroll.operators.calendar import DAY_FEATURES
from tillroll.operators.customers import CHURN_FEATURES
from tillroll.operators.forests import forest_nodes, walk_forest
from tillroll.operators.layout import checkpointed, kept_by_column
from tillroll.operators.sampling import label_split, split_rows

SEED = 42
# Inputs, grid and sizes of the two forests.
DEMAND_FEATURES = (
    "UnitPrice",
    "day_of_week",
    "month",
    "quarter",
    "is_weekend",
    "is_holiday",
    "hour",
)
# What tells one line from another.
LINE_KEYS = ("InvoiceNo", "StockCode", "Quantity", "UnitPrice")
DEMAND_GRID: Mapping[str, Sequence[Any]] = {"maxDepth": (5, 10), "numTrees": (20, 50)}
# Position from which on a training line validates.
VALIDATION_FROM = 0.8
# Rows of a partition to fit on, and the least number of partitions: the same on every cluster.
_FIT_ROWS, _FIT_PARTITIONS = 1 << 18, 8
# Customers remember their node of every tree while a forest grows, instead of walking to it at each level.
_NODE_IDS: Mapping[str, Any] = {"cacheNodeIds": True, "checkpointInterval": -1}
CHURN_FOREST: Mapping[str, Any] = {"numTrees": 60, "maxDepth": 8}


class Fitted(NamedTuple):
    """A model, the rows it was trained on, and its predictions for the other rows.

    ``tuning`` has the grid points tried and their validation errors.
    """

    model: Model
    train: DataFrame
    predictions: DataFrame
    tuning: tuple[tuple[dict[str, Any], float], ...] = ()


def assemble(
    df: DataFrame, features: Sequence[str], handle_invalid: str = "error"
) -> DataFrame:
    """Add the ``features`` vector. ``handle_invalid="skip"`` drops rows with a null."""
    stage = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid=handle_invalid
    )
    return stage.transform(df)


def fit_sales_forecast(daily: DataFrame, seed: int = SEED) -> Fitted:
    """Least squares of daily revenue on calendar features, over a daily model frame."""
    data = checkpointed(assemble(daily, DAY_FEATURES))
    train, test = split_rows(data, (0.8, 0.2), seed, keys=["sale_date"])
    model = LinearRegression(featuresCol="features", labelCol="daily_revenue").fit(train)
    return Fitted(model, train, model.transform(test))


def demand_parts(
    lines: DataFrame, fraction: float = 1.0, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """All training lines, or a ``fraction`` of them, and all held-out lines, as inputs of the demand model.

    Training lines are marked by their values: a fifth of them ``validates`` the points of a grid.
    """
    marked = _marked_lines(lines, fraction, seed)
    return _sampled(marked), _held_out(marked)


def _marked_lines(lines: DataFrame, fraction: float, seed: int) -> DataFrame:
    """The inputs of both parts; ``validates`` is null for held-out lines."""
    marked = label_split(lines, 0.8, seed, keys=LINE_KEYS)
    held_out = F.col("part") == "test"
    kept = marked.where(held_out | below(marked, LINE_KEYS, seed, "sample", fraction))
    validates = ~below(kept, LINE_KEYS, seed, "validation", VALIDATION_FROM)
    return kept.select(
        *DEMAND_FEATURES,
        F.col("Quantity").cast("double"),
        F.when(~held_out, validates).alias("validates"),
    )


def _sampled(marked: DataFrame) -> DataFrame:
    return marked.where("validates IS NOT NULL")


def _held_out(marked: DataFrame) -> DataFrame:
    return marked.where("validates IS NULL").drop("validates")


def fit_demand_model(
    lines: DataFrame,
    fraction: float = 1.0,
    grid: Mapping[str, Sequence[Any]] = DEMAND_GRID,
    seed: int = SEED,
) -> Fitted:
    """Random forest for units per line, tuned on a validation split of the training lines.

    ``lines`` carry the calendar features. Every line is in the training or in the held-out part.
    Every training line is fitted, unless a ``fraction`` below 1 asks for a share of them; predictions
    are for all held-out lines. Of a feature with more values than bins MLlib tries up to 31 thresholds,
    which it takes from about 10,000 of the rows; every row is counted on either side of them.
    The source is read once: the inputs of both parts are kept by column in the checkpoint folder.
    Each grid point is fitted on the training lines that do not validate and judged by root mean
    square error on those that do, which their values decide; the best is refitted on all. The fit
    depends on rows and seed alone, not on partitions. Lines without one of the features are left
    out of either part.
    """
    marked = kept_by_column(_marked_lines(lines, fraction, seed))
    train, test = (
        assemble(part, DEMAND_FEATURES, handle_invalid="skip")
        for part in (checkpointed(_fixed_order(_sampled(marked))), _held_out(marked))
    )
    # No node ids: beside all lines they would take more memory than the lines themselves.
    forest = RandomForestRegressor(featuresCol="features", labelCol="Quantity", seed=seed)
    points = ParamGridBuilder()
    for name, values in grid.items():
        points = points.addGrid(forest.getParam(name), list(values))
    combinations = points.build()
    fitting, validation = train.where(~F.col("validates")), train.where("validates")
    errors = _validation_errors(forest, combinations, fitting, validation)
    chosen = combinations[errors.index(min(errors))]
    model = forest.fit(train, chosen)
    tuning = [
        ({p.name: v for p, v in point.items()}, error)
        for point, error in zip(combinations, errors, strict=True)
    ]
    return Fitted(model, train, model.transform(test), tuple(tuning))


def _validation_errors(
    forest: RandomForestRegressor, points: Sequence[dict], fitting: DataFrame, validation: DataFrame
) -> list[float]:
    """Root mean square error of every grid point on the validating lines, points side by side.

    A forest grows level by level, and what it draws does not depend on how deep it may become. So
    of the points that differ in depth alone only the deepest is fitted: the others are that
    forest, cut at their depth.
    """
    judge = RegressionEvaluator(labelCol="Quantity", metricName="rmse")
    alike: dict[tuple, list[int]] = {}
    for i, point in enumerate(points):
        alike.setdefault(tuple((p.name, v) for p, v in point.items() if p != forest.maxDepth), []).append(i)

    def errors_of(own: list[int]) -> dict[int, float]:
        depth = lambda i: points[i].get(forest.maxDepth, forest.getMaxDepth())
        deepest = max(own, key=depth)
        model = forest.fit(fitting, points[deepest])
        errors = {deepest: judge.evaluate(model.transform(validation))}
        if len(own) > 1:
            nodes = forest_nodes(model, fitting.sparkSession)
            for i in own:
                if i != deepest:
                    cut = walk_forest(validation, nodes, DEMAND_FEATURES, "prediction", depth(i))
                    errors[i] = judge.evaluate(cut)
        return errors

    with ThreadPoolExecutor(len(alike)) as pool:
        run = inheritable_thread_target(fitting.sparkSession)(errors_of)
        found = {i: float(e) for part in pool.map(run, alike.values()) for i, e in part.items()}
    return [found[i] for i in range(len(points))]


def _fixed_order(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows in partitions and an order that only their values and their number decide.

    A forest draws its samples by place. Equal rows are interchangeable, so on the same rows it
    is the same forest, whatever the partitions they come in. ``keys``, all columns unless given,
    tell rows apart. The rows are read twice, for their number and for themselves.
    """
    partitions = max(1, -(-rows.count() // _FIT_ROWS))
    order = [F.col(c) for c in keys or rows.columns]
    return rows.repartition(max(partitions, _FIT_PARTITIONS), F.xxhash64(*order)).sortWithinPartitions(*order)


def tuning_results(fitted: Fitted, spark: SparkSession) -> DataFrame:
    """Validation error of every grid point, and which was chosen: the first of the smallest."""
    names = sorted({name for point, _ in fitted.tuning for name in point})
    errors = [error for _, error in fitted.tuning]
    rows = [
        (*[int(point[n]) for n in names], error, i == errors.index(min(errors)))
        for i, (point, error) in enumerate(fitted.tuning)
    ]
    columns = "".join(f"{n} int, " for n in names)
    return spark.createDataFrame(rows, f"{columns}rmse double, chosen boolean")


def fit_churn_model(
    customers: DataFrame,
    features: Sequence[str] = CHURN_FEATURES,
    seed: int = SEED,
    forest: Mapping[str, Any] = CHURN_FOREST,
) -> Fitted:
    """Random forest for the churn label over a labelled customer table.

    The group of lines without a customer is no customer: it is neither trained on nor
    scored. Predictions keep the customer columns and gain ``prediction`` and ``score``, the
    votes for churn. Customers are checkpointed as they come, for their number, and once more in
    the order of the fit: the forest depends on customers and seed alone, and there are as
    many partial sums of its nodes as its rows need.
    """
    known = checkpointed(customers.where(F.col("CustomerID").isNotNull()))
    data = checkpointed(_fixed_order(known, "CustomerID"))
    train, test = split_rows(data, (0.8, 0.2), seed, keys=["CustomerID"])
    classifier = RandomForestClassifier(
        featuresCol="features", labelCol="label", seed=seed, **{**_NODE_IDS, **forest}
    )
    model = classifier.fit(assemble(train, features))
    return Fitted(model, train, score_churn(model, test, features))


def score_churn(
    model: Model, rows: DataFrame, features: Sequence[str] = CHURN_FEATURES
) -> DataFrame:
    """Class and churn probability of each row."""
    scored = model.transform(assemble(rows, features))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability"
    )


def feature_importances(
    model: Model, features: Sequence[str], spark: SparkSession
) -> DataFrame:
    """Importance per feature of a fitted forest, largest first."""
    found = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(found, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def actual_vs_predicted(predictions: DataFrame, name: str, target: str) -> DataFrame:
    """Predictions of a regression in the shape all models share."""
    return predictions.select(
        F.lit(name).alias("model"),
        F.col(target).cast("double").alias("actual"),
        F.col("prediction").alias("predicted"),
    )
