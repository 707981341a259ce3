"""Calendar expressions over a timestamp, with or without time zone."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Public holidays (United Kingdom) from December 2010 to December 2011.
DEFAULT_HOLIDAYS = (
    "2010-12-25",
    "2010-12-26",
    "2010-12-27",
    "2010-12-28",
    "2011-01-01",
    "2011-01-03",
    "2011-04-22",
    "2011-04-25",
    "2011-04-29",
    "2011-05-02",
    "2011-05-30",
    "2011-08-29",
    "2011-12-25",
    "2011-12-26",
    "2011-12-27",
)

# Sunday is day 1 of the week, Saturday day 7.
WEEKEND_DAYS = (1, 7)


def _dates(days: Iterable[str | dt.date]) -> list[dt.date]:
    return [d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in days]


def is_weekend(timestamp: str) -> Column:
    return F.when(F.dayofweek(timestamp).isin(*WEEKEND_DAYS), 1).otherwise(0)


def is_holiday(timestamp: str, holidays: Iterable[str | dt.date] = DEFAULT_HOLIDAYS) -> Column:
    """1 on a listed date, else 0; a missing date is no holiday."""
    listed = F.to_date(timestamp).isin(_dates(holidays))
    return F.coalesce(listed.cast("int"), F.lit(0))


def holiday_udf(holidays: Iterable[str | dt.date] = DEFAULT_HOLIDAYS):
    """The holiday flag as a vectorised UDF: the hook for calendars that are code.

    Batches cross to Python as Arrow arrays and stay such; no date becomes a Python
    object. :func:`is_holiday` gives the same answer without leaving the JVM and is
    what the operators use.
    """
    listed = _dates(holidays)

    @F.arrow_udf("int")
    def flag(days: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = pa.array(listed, pa.date32())
        for batch in days:
            yield pc.is_in(batch, value_set=known).cast(pa.int32())

    return flag


def calendar_columns(timestamp: str = "InvoiceDate") -> dict[str, Column]:
    """Name and expression of every calendar feature but the holiday flag."""
    return {
        "day_of_week": F.dayofweek(timestamp),
        "day_name": F.date_format(timestamp, "EEEE"),
        "month": F.month(timestamp),
        "quarter": F.quarter(timestamp),
        "year": F.year(timestamp),
        "hour": F.hour(timestamp),
        "is_weekend": is_weekend(timestamp),
    }
