"""Standard scaling with statistics that are kept as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.customers import SCALED_FEATURES


def fit_scaler(df: DataFrame, columns: Sequence[str] = SCALED_FEATURES) -> DataFrame:
    """Mean and population deviation per column: one row, one pass.

    The row is the fitted scaler. Save it as parquet to scale later data alike.
    """
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
    )


def apply_scaler(
    df: DataFrame, scaler: DataFrame, columns: Sequence[str] = SCALED_FEATURES
) -> DataFrame:
    """Replace the columns by their z-scores; a column without spread becomes 0.

    Null stays null. The fitted row is read as one scalar subquery, so it is computed
    once and no join is needed.
    """
    fitted = scaler.select(F.struct("*").alias("fitted")).scalar()

    def score(column: str) -> Column:
        distance = F.col(column) - F.col(f"_fitted.{column}_mean")
        spread = F.nullif(F.col(f"_fitted.{column}_std"), F.lit(0.0))
        return F.when(F.col(column).isNotNull(), F.coalesce(distance / spread, F.lit(0.0)))

    with_fitted = df.withColumn("_fitted", fitted)
    return with_fitted.withColumns({c: score(c) for c in columns}).drop("_fitted")


def scale_features(df: DataFrame, columns: Sequence[str] = SCALED_FEATURES) -> DataFrame:
    """Scale a table by its own statistics. Reads the table twice."""
    return apply_scaler(df, fit_scaler(df, columns), columns)
