import math
import random

import pytest

from tillroll.operators import quantiles as q

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def smallest_reaching(values, p):
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    return ordered[max(1, math.ceil(p * len(ordered))) - 1]


def random_values(kind, n=3000):
    source = random.Random(kind)
    if kind == "spread":
        return [source.uniform(-1e3, 1e6) for _ in range(n)]
    if kind == "one value has most rows":
        return [7.5 if source.random() < 0.7 else source.gauss(0, 1) for _ in range(n)]
    if kind == "many magnitudes":
        return [source.choice([-1, 1]) * 10.0 ** source.uniform(-300, 300) for _ in range(n)]
    if kind == "infinities and gaps":
        extra = [math.inf, -math.inf, math.nan, None]
        return [
            source.choice(extra) if source.random() < 0.3 else source.random() for _ in range(n)
        ]
    if kind == "neighbours":
        return [source.choice([1.0, math.nextafter(1.0, 2), 1e300, 5e-324]) for _ in range(n)]
    raise ValueError(kind)


@pytest.mark.parametrize("direct", [4096, 8])
@pytest.mark.parametrize(
    "kind",
    [
        "spread",
        "one value has most rows",
        "many magnitudes",
        "infinities and gaps",
        "neighbours",
    ],
)
def test_exact_quantiles_equal_sorting(spark, monkeypatch, kind, direct):
    monkeypatch.setattr(q, "_COUNT_DIRECTLY", direct)
    values = random_values(kind, 300 if kind == "many magnitudes" else 1500)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    found = q.quantiles(df, ["x"], PROBABILITIES, relative_error=0)["x"]
    assert found == [smallest_reaching(values, p) for p in PROBABILITIES]


def test_few_buckets_need_more_steps_but_agree(spark, monkeypatch):
    monkeypatch.setattr(q, "_COUNT_DIRECTLY", 2)
    monkeypatch.setattr(q, "_BUCKETS", 3)
    values = random_values("spread", 400)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = q.quantiles(df, ["x"], [0.25, 0.5, 0.75], relative_error=0)["x"]
    assert found == [smallest_reaching(values, p) for p in (0.25, 0.5, 0.75)]


def test_several_columns_and_types(spark):
    rows = [(i, float(i * i), None) for i in range(1, 102)]
    df = spark.createDataFrame(rows, "a int, b double, c double")
    found = q.quantiles(df, ["a", "b", "c"], [0.5], relative_error=0)
    assert found == {"a": [51.0], "b": [51.0 * 51.0], "c": None}


def test_sketch_is_within_its_error(spark):
    values = random_values("spread", 3000)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    (found,) = q.quantiles(df, ["x"], [0.5], relative_error=0.01)["x"]
    rank = sorted(values).index(found)
    assert abs(rank - 1500) <= 0.01 * 3000 + 1


def test_exact_agrees_with_the_lossless_sketch(spark, folder):
    prices = spark.read.parquet(f"{folder}/lineitem.parquet")
    columns = ["l_quantity", "l_extendedprice"]
    exact = q.quantiles(prices, columns, [0.25, 0.5, 0.75], relative_error=0)
    sketch = prices.approxQuantile(columns, [0.25, 0.5, 0.75], 0.0)
    assert [exact[c] for c in columns] == sketch
