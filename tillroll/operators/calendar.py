"""Calendar features of invoice lines, and the daily frame built on them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import (
    DEFAULT_HOLIDAYS,
    calendar_columns,
    holiday_udf,
    is_holiday,
    is_weekend,
)

# Calendar features that the date alone decides.
DAY_FEATURES = ("day_of_week", "month", "quarter", "is_weekend", "is_holiday")


def create_temporal_features(
    df: DataFrame, holidays: Iterable[str | dt.date] = DEFAULT_HOLIDAYS
) -> DataFrame:
    """Add weekday, month, quarter, year, hour, weekend and holiday columns."""
    features = calendar_columns()
    features["is_holiday"] = is_holiday("InvoiceDate", holidays)
    return df.withColumns(features)


def holiday_flag(
    df: DataFrame, holidays: Iterable[str | dt.date] = DEFAULT_HOLIDAYS
) -> DataFrame:
    return df.withColumn("is_holiday", is_holiday("InvoiceDate", holidays))


def holiday_flag_udf(
    df: DataFrame, holidays: Iterable[str | dt.date] = DEFAULT_HOLIDAYS
) -> DataFrame:
    """The flag through a vectorised UDF. Same answer; use where the rule is Python."""
    return df.withColumn("is_holiday", holiday_udf(holidays)(F.to_date("InvoiceDate")))


def holiday_flag_calendar(df: DataFrame, calendar: DataFrame, day: str = "day") -> DataFrame:
    """The flag from a table of dates, for calendars too long for a list.

    Dates are made unique first, so no line can match twice. Whether the calendar
    is broadcast is for the optimizer, which knows its size.
    """
    listed = calendar.select(F.to_date(day).alias("_day")).distinct().withColumn("_hit", F.lit(1))
    return (
        df.join(listed, F.to_date("InvoiceDate") == F.col("_day"), "left")
        .withColumn("is_holiday", F.coalesce("_hit", F.lit(0)))
        .drop("_day", "_hit")
    )


def daily_model_frame(
    df: DataFrame, holidays: Iterable[str | dt.date] = DEFAULT_HOLIDAYS
) -> DataFrame:
    """One row per day with its calendar features and revenue.

    The features follow from the date, so lines are grouped by date alone and the
    features computed once per day instead of once per line.
    """
    daily = df.groupBy(F.to_date("InvoiceDate").alias("sale_date")).agg(
        F.sum("Revenue").alias("daily_revenue")
    )
    features = calendar_columns("sale_date")
    features["is_weekend"] = is_weekend("sale_date")
    features["is_holiday"] = is_holiday("sale_date", holidays)
    return daily.select(
        "sale_date", *[features[name].alias(name) for name in DAY_FEATURES], "daily_revenue"
    )
