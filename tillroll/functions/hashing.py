"""Row hashes that depend on values only, never on where a row happens to sit."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hexadecimal digits of a hash that make a position: 2^52 steps, all of which a double holds.
_DIGITS = 13


def _text(df: DataFrame, column: str) -> Column:
    """One fixed text per value: numbers with a fraction in millionths, times to the second."""
    kind, value = df.schema[column].dataType.typeName(), F.col(column)
    if kind in ("double", "float") or kind.startswith("decimal"):
        value = F.floor(value * 1_000_000)
    elif kind.startswith("timestamp"):
        value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(value.cast("string"), F.lit("~"))


def position_hash(df: DataFrame, columns: Sequence[str], seed: int, purpose: str) -> Column:
    """Hexadecimal digits fixed by the values of ``columns``, the seed and the purpose.

    They are the first of the MD5 of ``purpose|seed|value|...``, so any engine can
    repeat them. The purpose keeps a split independent of the sample it is made from.
    """
    parts = [F.lit(purpose), F.lit(str(seed)), *[_text(df, c) for c in columns]]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, _DIGITS)


def unit_hash(df: DataFrame, columns: Sequence[str], seed: int, purpose: str) -> Column:
    """The position as a number in [0, 1)."""
    digits = F.conv(position_hash(df, columns, seed, purpose), 16, 10)
    return digits.cast("double") / F.lit(float(16**_DIGITS))


def below(df: DataFrame, columns: Sequence[str], seed: int, purpose: str, edge: float) -> Column:
    """Whether ``unit_hash`` is below ``edge``, told from the digits: no number is made of them."""
    if edge >= 1:
        return F.lit(True)
    first = ceil(max(edge, 0.0) * 16**_DIGITS)
    return position_hash(df, columns, seed, purpose) < F.lit(f"{first:0{_DIGITS}x}")


def bucket_hash(columns: Sequence[str], buckets: int) -> Column:
    """Bucket 0 … buckets-1 fixed by the values of ``columns``."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(buckets)).cast("int")
