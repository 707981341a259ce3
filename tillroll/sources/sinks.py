"""Writers. Spark tasks write the files; no result passes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.sources.schema import TIMESTAMP_FORMAT


def write_csv(
    df: DataFrame,
    path: str,
    order_by: Sequence[str | Column] = (),
    files: int | None = None,
    mode: str = "overwrite",
) -> None:
    """CSV with a header, in ``files`` files; without a number, one file per task.

    The number is the caller's to choose, 1 for a report. Files are ordered by ``order_by`` and,
    if there are several, follow each other in that order.
    """
    if files and order_by:
        placed = df.repartitionByRange(files, *order_by).sortWithinPartitions(*order_by)
    elif files:
        placed = df.repartition(files)
    else:
        placed = df.orderBy(*order_by) if order_by else df
    # Text keeps its blanks, times are as the readers take them.
    placed.write.mode(mode).option("timestampNTZFormat", TIMESTAMP_FORMAT).csv(
        path,
        header=True,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        timestampFormat=TIMESTAMP_FORMAT,
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet, one file per task."""
    df.write.mode(mode).parquet(path)


def write_json_document(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One indented JSON document per row (a result document is a single row)."""
    document = F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"})
    df.select(document.alias("value")).write.mode(mode).text(path)
