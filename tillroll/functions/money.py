"""Money aggregates.

Averages of amounts fall on exact half cents often enough that the order in which a
cluster adds doubles decides the last digit. They are therefore taken over decimals of ten
places, where addition is exact and the order of tasks cannot matter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_sum(column: str = "Revenue", digits: int = 2) -> Column:
    return F.round(F.sum(column), digits)


def exact(column: str = "Revenue") -> Column:
    """The amount as a decimal of ten places; null for null, NaN and infinities."""
    return F.col(column).try_cast("decimal(38,10)")


def is_number(column: str = "Revenue") -> Column:
    """Whether an amount is a finite number. Null for null."""
    return F.abs(F.col(column)) < float("inf")


def mean_amount(exact_total: Column, total: Column, odd: Column, n: Column) -> Column:
    """Mean of ``n`` amounts to the cent, a half cent rounded away from zero.

    Taken over the decimals (``exact_total``). Amounts that are no numbers (``odd`` of
    them) make it what they make the sum of doubles. Null for no amounts.
    """
    whole = F.nullif(n, F.lit(0))
    mean = F.round(exact_total / whole, 2).cast("double")
    return F.when(odd > 0, total / whole).otherwise(mean)
