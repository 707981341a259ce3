"""Readers for invoice lines, and the named relation for SQL queries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.sources.schema import RETAIL_SCHEMA, TIMESTAMP_FORMAT


def load_sales_data(
    spark: SparkSession, path: str | list[str], infer_schema: bool = False
) -> DataFrame:
    """CSV with a header row. The fixed schema costs no extra pass; inference costs one.

    Cells that do not parse, and empty cells, become null; the row stays.
    """
    options: dict[str, Any] = {
        "header": True,
        "timestampFormat": TIMESTAMP_FORMAT,
        "mode": "PERMISSIVE",
    }
    if infer_schema:
        return spark.read.csv(path, inferSchema=True, **options)
    return spark.read.csv(path, schema=RETAIL_SCHEMA, **options)


# What a cell of each type looks like; other text is rejected.
_SHAPES = {
    "integer": (r"^[+-]?[0-9]+$", "not an integer"),
    "double": (r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(NaN|Inf|Infinity)$", "not a number"),
    "timestamp": (r"^", "not a time"),
}
_BROKEN = "_broken"


def load_checked_sales(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header row in the fixed schema, and what did not parse beside each row.

    ``rejects`` is an array of (column, value, reason). A cell whose text is no value of its
    column's type is null and rejected; an empty cell is null only. A row of another number
    of fields is rejected as a whole line besides, under the column name ``null``: what it lacks is
    null and what it has too many is dropped. No row is lost. One pass, without a job.
    """
    text = StructType()
    for field in RETAIL_SCHEMA:
        text = text.add(field.name, "string")
    # Fields are counted only where all of them are read.
    raw = spark.read.option("columnPruning", False).csv(
        path,
        schema=text.add(_BROKEN, "string"),
        header=True,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=_BROKEN,
    )
    typed, rejects = [], []
    for field in RETAIL_SCHEMA:
        value, kind = F.col(field.name), field.dataType.typeName()
        if kind == "string":
            typed.append(value)
            continue
        shape, reason = _SHAPES[kind]
        parsed = (
            F.try_to_timestamp(value, F.lit(TIMESTAMP_FORMAT))
            if kind == "timestamp"
            else value.try_cast(field.dataType)
        )
        parsed = F.when(value.rlike(shape), parsed)
        typed.append(parsed.alias(field.name))
        rejects.append(F.when(value.isNotNull() & parsed.isNull(), _reject(F.lit(field.name), value, reason)))
    broken = F.col(_BROKEN)
    whole = F.when(
        broken.isNotNull(), _reject(F.lit(None).cast("string"), broken, "wrong number of fields")
    )
    return raw.select(*typed, F.array_compact(F.array(*rejects, whole)).alias("rejects"))


def _reject(column: Column, value: Column, reason: str) -> Column:
    return F.struct(column.alias("column"), value.alias("value"), F.lit(reason).alias("reason"))


def rejected_cells(checked: DataFrame) -> DataFrame:
    """(column, value, reason) of every rejected cell and line of :func:`load_checked_sales`."""
    return checked.select(F.inline("rejects"))


def reject_counts(checked: DataFrame) -> DataFrame:
    """(column, reason, n_cells) over all rejected cells and lines."""
    return rejected_cells(checked).groupBy("column", "reason").agg(F.count(F.lit(1)).alias("n_cells"))


def read_lines_parquet(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """Lines kept as parquet: columnar, so pruning and pushdown reach the files.

    With a schema given, no file is opened before the query runs.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def invoice_lines(
    spark: SparkSession,
    rows: Iterable[Sequence[Any]],
    schema: StructType | Sequence[str] = RETAIL_SCHEMA,
) -> DataFrame:
    """Rows held by the caller, as a relation."""
    return spark.createDataFrame(list(rows), schema)


def register_sales(df: DataFrame, name: str = "sales") -> DataFrame:
    """Give a relation the name SQL queries know it by; returns the relation."""
    df.createOrReplaceTempView(name)
    return df


def query_sales(df: DataFrame, sql: str) -> DataFrame:
    """Run SQL text that names its input ``{sales}``; leaves no view behind."""
    return df.sparkSession.sql(sql, sales=df)
