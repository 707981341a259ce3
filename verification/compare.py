"""Run a query in Spark and its SQL in DuckDB and compare the results row by row."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path
from typing import Any

import duckdb
from pyspark.sql import DataFrame, SparkSession

from verification.oracle import ORACLE
from verification.queries import QUERIES


def _cell(value: Any) -> Any:
    """One form for a value of either engine. Numbers keep all their digits."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def _type(name: str) -> str:
    """Type family of a Spark or DuckDB type name."""
    name = name.lower()
    families = {
        "varchar": "string",
        "integer": "int",
        "timestamp_ntz": "timestamp",
    }
    return families.get(name, name)


def _spark_result(df: DataFrame) -> tuple[list[tuple[str, str]], Counter]:
    columns = sorted(df.columns)
    types = dict(df.dtypes)
    rows = Counter(tuple(_cell(row[c]) for c in columns) for row in df.toLocalIterator())
    return [(c, _type(types[c])) for c in columns], rows


def _duck_result(folder: str, sql: str) -> tuple[list[tuple[str, str]], Counter]:
    with duckdb.connect() as connection:
        for file in sorted(Path(folder).glob("*.parquet")):
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        result = connection.execute(sql)
        names = [(d[0], str(d[1])) for d in result.description]
        order = sorted(range(len(names)), key=lambda i: names[i][0])
        rows = Counter(tuple(_cell(row[i]) for i in order) for row in result.fetchall())
    return [(names[i][0], _type(names[i][1])) for i in order], rows


def differences(spark: SparkSession, folder: str, name: str) -> str | None:
    """What differs between the two engines, or ``None``."""
    spark_schema, spark_rows = _spark_result(QUERIES[name](spark, folder))
    duck_schema, duck_rows = _duck_result(folder, ORACLE[name])
    if spark_schema != duck_schema:
        return f"schema: {spark_schema} against {duck_schema}"
    if spark_rows != duck_rows:
        only_spark, only_duck = spark_rows - duck_rows, duck_rows - spark_rows
        return (
            f"{spark_rows.total()} rows against {duck_rows.total()}, "
            f"{only_spark.total()} and {only_duck.total()} of them unmatched: "
            f"{list(only_spark)[:3]} against {list(only_duck)[:3]}"
        )
    return None


def main() -> None:
    """``python -m verification.compare FOLDER [NAME ...]``"""
    folder, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or QUERIES:
        start = time.perf_counter()
        try:
            if name in ORACLE:
                verdict = differences(spark, folder, name) or "equal"
            else:
                verdict = f"{QUERIES[name](spark, folder).count()} rows, no SQL counterpart"
        except Exception as error:
            verdict = f"failed: {str(error)[:600]}"
        print(f"{name:28s} {time.perf_counter() - start:6.2f} s  {verdict}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
