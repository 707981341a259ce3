"""Layout by measured hot keys, staged relations, and plans that read their source as stated."""

import os
import re
from collections import Counter, defaultdict
from statistics import median

import pytest
from pyspark.sql import functions as F

from tillroll.operators import layout
from tillroll.plans.kpis import headline_figures
from tillroll.plans.workload import workload, workload_once
from verification.queries import raw


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans_of(df):
    """Scans in the plan, each once; a reused subquery is not listed again."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return len(re.findall(r"^\(\d+\) Scan parquet", text, re.MULTILINE))


@pytest.fixture(scope="module")
def skewed(spark):
    """90 % of the rows in one country; the rest in 40 others."""
    home = F.when(F.col("id") % 10 > 0, F.lit("home"))
    other = F.concat(F.lit("c"), (F.col("id") / 10).cast("int") % 40)
    return spark.range(40_000).select("id", home.otherwise(other).alias("country"))


@pytest.mark.parametrize("partitions", [8, 20])
def test_hot_key_is_spread_and_cold_ones_are_not(skewed, partitions):
    placed = layout.hot_key_placement(skewed, ["country"], partitions, ["id"])
    sizes, of = Counter(), defaultdict(set)
    for r in placed.groupBy("country", "partition").count().collect():
        sizes[r["partition"]] += r["count"]
        of[r["country"]].add(r["partition"])
    assert set(sizes) <= set(range(partitions)) and sum(sizes.values()) == 40_000
    assert max(sizes.values()) <= 1.5 * median(sizes.values())
    assert {c: len(p) for c, p in of.items() if c != "home"} == {f"c{i}": 1 for i in range(40)}
    assert len(of["home"]) in (int(0.9 * partitions), int(0.9 * partitions) + 1)


def test_layout_puts_rows_where_it_says(spark, skewed):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = layout.spread_hot_keys(skewed, ["country"], 8, ["id"])
        assert laid.columns == skewed.columns and laid.rdd.getNumPartitions() == 8
        sizes = laid.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) <= 1.5 * median(r["count"] for r in sizes)
        assert sorted(laid.collect()) == sorted(skewed.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_many_cold_keys_fill_the_room_that_is_left(spark):
    key = F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(60_000).select("id", key.alias("k"))
    sizes = [r["count"] for r in layout.hot_key_placement(df, ["k"], 6, ["id"]).groupBy("partition").count().collect()]
    assert len(sizes) == 6 and max(sizes) <= 1.25 * median(sizes)


def test_placement_of_odd_tables(spark):
    schema = "k string, id int, __key int, __UNIT int, `a.b` int"
    rows = [(None, i, 1, 2, 3) for i in range(50)] + [("x", 1, 1, 2, 3)] * 3 + [("", 7, 1, 2, 3)]
    df = spark.createDataFrame(rows, schema)
    placed = layout.hot_key_placement(df, ["k"], 4, ["id"])
    assert placed.columns == [*df.columns, "partition"]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((r[:-1] for r in placed.collect()), key=key) == sorted(map(tuple, df.collect()), key=key)
    assert placed.where("k = 'x'").select("partition").distinct().count() == 1
    assert layout.hot_key_placement(df.limit(0), ["k"], 4, ["id"]).count() == 0
    alike = spark.createDataFrame([("x", 1)] * 9, "k string, id int")
    assert layout.hot_key_placement(alike, ["k"], 4, ["id"]).select("partition").distinct().count() == 1


def test_staged_relation_is_removed(spark):
    with layout.staged(spark.range(10).where("id > 3")) as kept:
        assert kept.count() == 6
        path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(path)
    assert not os.path.exists(path)
    with pytest.raises(ZeroDivisionError), layout.staged(spark.range(3)) as kept:
        path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        raise ZeroDivisionError
    assert not os.path.exists(path)


def test_workload_once_outlives_its_base(spark, folder):
    lines = raw(spark, folder)
    plain = lambda df: sorted(
        (tuple(round(v, 2) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str
    )
    answers = workload_once(lines)
    assert plain(answers) == plain(workload(lines))
    assert "FileScan" not in plan(answers)


def test_key_figures_do_not_fan_out(spark, folder, tmp_path):
    raw(spark, folder).write.parquet(str(tmp_path / "lines"))
    figures = headline_figures(spark.read.parquet(str(tmp_path / "lines")))
    assert figures.first() == headline_figures(raw(spark, folder)).first()
    figures.collect()
    assert "Expand" not in plan(figures)
    assert scans_of(figures) == 2


def test_key_figures_of_odd_lines(spark, make_lines):
    lines = make_lines(
        {"CustomerID": 0.0},
        {"CustomerID": -0.0, "InvoiceNo": "2"},
        {"CustomerID": None, "StockCode": "B"},
        {"CustomerID": float("nan"), "StockCode": None},
        {"Quantity": -1, "StockCode": "C", "InvoiceNo": "9"},
        {"InvoiceNo": "C3", "CustomerID": 8.0},
    )
    row = headline_figures(lines).first()
    assert (row["number_of_transactions"], row["unique_products"], row["unique_customers"]) == (2, 2, 2)
    assert (row["total_quantity_sold"], row["total_line_items"], row["total_sales"]) == (4, 6, 4.0)
    none = headline_figures(lines.limit(0)).first()
    assert none["total_sales"] is None and none["total_line_items"] == 0
    assert none["unique_products"] == 0 and none["average_transaction_value"] is None


def test_holiday_hook_equals_the_expression(spark, make_lines):
    import datetime as dt

    from tillroll.operators import calendar

    lines = make_lines(
        *[{"InvoiceDate": d} for d in (dt.datetime(2011, 1, 1, 23, 59), dt.datetime(2011, 1, 2), None)]
    )
    for listed in (["2011-01-01"], []):
        found = [calendar.holiday_flag_udf(lines, listed), calendar.holiday_flag(lines, listed)]
        assert found[0].schema["is_holiday"].dataType == found[1].schema["is_holiday"].dataType
        assert [r["is_holiday"] for r in found[0].collect()] == [r["is_holiday"] for r in found[1].collect()]
