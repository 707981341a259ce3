"""First looks at a table: shape, preview, schema, missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")
    )


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows in the order of all columns, so the answer is stable.

    Each task keeps its own first ``n``; nothing is sorted as a whole.
    """
    return df.orderBy(*df.columns).limit(n)


def schema_listing(df: DataFrame) -> DataFrame:
    """Columns in order with their type and how many rows have a value."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(fields)])
    entries = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"n{i}").alias("n_present"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*entries)))


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, in one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    return counts.unpivot("n_rows", df.columns, "column_name", "n_null").select(
        "column_name", "n_null", "n_rows"
    )
