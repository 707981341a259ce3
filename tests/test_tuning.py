"""The demand model: one reading of its source, and grid points that share a fit."""

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tillroll.functions.hashing import below, unit_hash
from tillroll.operators import calendar, models
from verification.queries import HOLIDAYS, clean_lines, labelled

GRID = {"maxDepth": [2, 5], "numTrees": [3, 6]}


def counted(spark, lines):
    """The lines, and how many of them were read."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(_):
        read.add(1)
        return True

    return lines.where(seen.asNondeterministic()("InvoiceNo")), read


def test_the_source_is_read_once(spark, folder):
    lines = clean_lines(spark, folder).coalesce(2).localCheckpoint()
    watched, read = counted(spark, lines)
    found = models.fit_demand_model(
        calendar.create_temporal_features(watched, HOLIDAYS), fraction=0.5, grid={"maxDepth": [2]}
    )
    assert found.predictions.count() + found.train.count() < lines.count() == read.value


def test_shared_fits_have_the_errors_of_their_own(spark, folder, monkeypatch):
    fits = []
    fit = RandomForestRegressor._fit
    monkeypatch.setattr(RandomForestRegressor, "_fit", lambda self, data: fits.append(self) or fit(self, data))
    lines = calendar.create_temporal_features(clean_lines(spark, folder), HOLIDAYS)
    found = models.fit_demand_model(lines, fraction=0.9, grid=GRID)
    assert len(fits) == 3 and len(found.tuning) == 4
    fitting, validation = found.train.where(~F.col("validates")), found.train.where("validates")
    judge = RegressionEvaluator(labelCol="Quantity", metricName="rmse")
    for point, error in found.tuning:
        own = RandomForestRegressor(labelCol="Quantity", seed=models.SEED, **point).fit(fitting)
        assert judge.evaluate(own.transform(validation)) == error


def test_digits_are_compared_like_numbers(spark):
    rows = spark.range(500).withColumn("name", F.col("id").cast("string"))
    place = unit_hash(rows, ["name"], 7, "split")
    some = [r[0] for r in rows.select(place).limit(20).collect()]
    for edge in (-1.0, 0.0, 0.1, 0.8, 1.0, 2.0, *some):
        same = below(rows, ["name"], 7, "split", edge).eqNullSafe(place < edge)
        assert rows.where(~same).isEmpty()


def test_the_churn_forest_depends_on_customers_alone(spark, folder):
    table = labelled(spark, folder)
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    for partitions in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        fitted = models.fit_churn_model(table.repartition(5), forest={"numTrees": 5, "maxDepth": 4})
        found.append(sorted((r["CustomerID"], r["score"]) for r in fitted.predictions.collect()))
        # Partial sums of the nodes are made once per partition.
        assert fitted.train.rdd.getNumPartitions() == 8
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]
