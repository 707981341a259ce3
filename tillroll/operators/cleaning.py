"""Row filters, imputation and outlier capping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import lines
from tillroll.operators.layout import reused
from tillroll.operators.quantiles import quantiles

CAPPED_COLUMNS = ("Quantity", "UnitPrice")


class Bounds(NamedTuple):
    """Quartiles of a column and the whiskers around them."""

    q1: float
    q3: float
    lower: float
    upper: float


def add_revenue(df: DataFrame, digits: int | None = 2) -> DataFrame:
    """Line revenue, to the cent unless ``digits`` says otherwise (``None``: raw)."""
    return df.withColumn("Revenue", lines.revenue(digits))


def remove_invalid_sales(df: DataFrame) -> DataFrame:
    """Completed sales only. A null invoice, quantity or price drops the line."""
    return df.where(lines.is_sale())


def drop_missing_customer(df: DataFrame) -> DataFrame:
    return df.where(lines.has_customer())


def drop_blank_description(df: DataFrame) -> DataFrame:
    return df.where(lines.has_description())


def clean_data(df: DataFrame, drop_missing_customer: bool = True) -> DataFrame:
    """Named products, known customers (unless guests are wanted) and valid sales."""
    wanted = lines.has_description() & lines.is_sale()
    return df.where(wanted & lines.has_customer() if drop_missing_customer else wanted)


def median_price(df: DataFrame, relative_error: float = 0.01) -> float | None:
    """Median unit price, or ``None`` where no line has a price. Runs jobs."""
    found = quantiles(df, ["UnitPrice"], [0.5], relative_error)["UnitPrice"]
    return None if found is None else found[0]


def missing_price_fill(df: DataFrame, relative_error: float = 0.01) -> float | None:
    """The price to fill in: the median if any line lacks a price, else ``None``. Runs jobs."""
    if df.where(F.col("UnitPrice").isNull()).isEmpty():
        return None
    return median_price(df, relative_error)


def fill_price(df: DataFrame, price: float | None) -> DataFrame:
    """Fill missing prices, NaN included; ``None`` fills nothing."""
    return df if price is None else df.fillna({"UnitPrice": price})


def impute_median_price(df: DataFrame, relative_error: float = 0.01) -> DataFrame:
    """Fill missing unit prices with the median, if any is missing.

    The fill also replaces NaN, but NaN alone does not set it off.
    """
    return fill_price(df, missing_price_fill(df, relative_error))


def impute_median_price_lazily(df: DataFrame, relative_error: float = 0.0001) -> DataFrame:
    """:func:`impute_median_price` as one plan: no job runs before an action.

    The median is a mergeable sketch in a relation of one row, which the plan reads as a scalar;
    ``relative_error`` must be above 0. The source is read twice by the action.
    """
    if relative_error <= 0:
        raise ValueError("a sketch has a relative error above 0")
    price = F.col("UnitPrice")
    present = F.when(~F.isnan(price), price)
    found = df.agg(
        F.percentile_approx(present, 0.5, int(1 / relative_error)).alias("median"),
        (F.count_if(price.isNull()) > 0).alias("missing"),
    ).select(F.when(F.col("missing"), F.col("median"))).scalar()
    return df.withColumn("UnitPrice", F.coalesce(F.when(~F.isnan(price), price), found, price))


def iqr_limits(
    df: DataFrame, columns: Sequence[str], k: float = 1.5, relative_error: float = 0.01
) -> dict[str, Bounds | None]:
    """Quartiles and whiskers per column, ``None`` without values. Runs jobs."""
    found = quantiles(df, columns, [0.25, 0.75], relative_error)
    limits: dict[str, Bounds | None] = {}
    for column, quartiles in found.items():
        if quartiles is None:
            limits[column] = None
            continue
        q1, q3 = quartiles
        reach = k * (q3 - q1)
        limits[column] = Bounds(q1, q3, q1 - reach, q3 + reach)
    return limits


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str] = CAPPED_COLUMNS,
    k: float = 1.5,
    relative_error: float = 0.01,
) -> DataFrame:
    """The limits as a relation, one row per column that has values."""
    limits = iqr_limits(df, columns, k, relative_error)
    return df.sparkSession.createDataFrame(
        [(c, *b) for c, b in limits.items() if b is not None],
        "column_name string, q1 double, q3 double, lower double, upper double",
    )


def iqr_outliers(
    df: DataFrame,
    columns: Sequence[str] = CAPPED_COLUMNS,
    k: float = 1.5,
    relative_error: float = 0.01,
) -> DataFrame:
    """Rows outside the limits of any of the columns, with one flag per column."""
    flags = {}
    for column, bounds in iqr_limits(df, columns, k, relative_error).items():
        outside = F.lit(False)
        if bounds is not None:
            value = F.col(column)
            outside = F.coalesce((value < bounds.lower) | (value > bounds.upper), outside)
        flags[f"{column}_outlier"] = outside
    return df.withColumns(flags).where(F.greatest(*flags) if len(flags) > 1 else F.col(*flags))


def iqr_outlier_counts(
    df: DataFrame,
    columns: Sequence[str] = CAPPED_COLUMNS,
    k: float = 1.5,
    relative_error: float = 0.01,
) -> DataFrame:
    """Rows below and above the limits per column, in one pass."""
    measures = []
    for column, bounds in iqr_limits(df, columns, k, relative_error).items():
        value = F.col(column)
        below = value < bounds.lower if bounds else F.lit(False)
        above = value > bounds.upper if bounds else F.lit(False)
        measures.append(
            F.struct(
                F.lit(column).alias("column_name"),
                F.count_if(below).alias("n_below"),
                F.count_if(above).alias("n_above"),
            )
        )
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def cap_at(df: DataFrame, limits: Mapping[str, Bounds | None]) -> DataFrame:
    """Move values outside the limits to the nearest limit; rows stay.

    Capped columns become double. Null stays null, NaN counts as above the limit,
    and a column without limits keeps its values.
    """
    capped = {}
    for column, bounds in limits.items():
        value = F.col(column).cast("double")
        if bounds is not None:
            # NaN sorts above every number, so `least` replaces it by the limit.
            inside = F.least(F.greatest(value, F.lit(bounds.lower)), F.lit(bounds.upper))
            value = F.when(value.isNotNull(), inside)
        capped[column] = value
    return df.withColumns(capped)


def cap_outliers_iqr(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    relative_error: float = 0.01,
) -> DataFrame:
    """:func:`cap_at` the limits the table itself gives. Runs jobs for the limits."""
    return cap_at(df, iqr_limits(df, columns, k, relative_error))


def clean_full(df: DataFrame, k: float = 1.5, relative_error: float = 0.01) -> DataFrame:
    """The whole cleaning chain.

    Known customers, named products, median price for missing ones, valid sales,
    capped quantity and price, and revenue of the capped values.

    The median and the limits run jobs. They need three narrow columns, which are
    kept for them, so the source is read once for all statistics and once more by
    the result.
    """
    price, limits, _ = _full_statistics(df, k, relative_error)
    return _full_chain(df, price, limits)


def _full_statistics(
    df: DataFrame, k: float, relative_error: float, counted: bool = False
) -> tuple[float | None, dict[str, Bounds | None], list[int]]:
    """The price missing ones take, the limits of the capped columns, and lines per stage if ``counted``.

    Runs jobs, all over the few columns they need, which are kept meanwhile.
    """
    customer = lines.has_customer()
    narrow = df.select(
        lines.invoice_kind().alias("InvoiceNo"),
        *CAPPED_COLUMNS,
        customer.alias("_customer"),
        (customer & lines.has_description()).alias("_named"),
    )
    with reused(narrow) as kept:
        values = kept.where("_named").drop("_customer", "_named")
        price = missing_price_fill(values, relative_error)
        sold = remove_invalid_sales(fill_price(values, price))
        limits = iqr_limits(sold, CAPPED_COLUMNS, k, relative_error)
        seen = []
        if counted:
            counts = _stage_counts(price, F.col("_customer"), F.col("_named"))
            seen = [int(n) for n in kept.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts)]).first()]
    return price, limits, seen


def _full_chain(
    df: DataFrame, price: float | None, limits: dict[str, Bounds | None]
) -> DataFrame:
    identified = df.where(lines.has_customer() & lines.has_description())
    return add_revenue(cap_at(remove_invalid_sales(fill_price(identified, price)), limits))


def write_cleaned(
    df: DataFrame, path: str, k: float = 1.5, relative_error: float = 0.01, mode: str = "overwrite"
) -> DataFrame:
    """Write the whole cleaning chain as parquet; returns the audit of its stages.

    The source is read once for all statistics and the audit together, and once for the result. The
    audit's three rows are those of :func:`cleaning_audit`, as a local relation.

    It is not observed during the write: a session that has an observation cannot carry MLlib's
    functions to its tasks any more.
    """
    price, limits, seen = _full_statistics(df, k, relative_error, counted=True)
    _full_chain(df, price, limits).write.mode(mode).parquet(path)
    rows = [
        (i + 1, name, before, after, before - after)
        for i, (name, before, after) in enumerate(zip(_STAGES, seen[:-1], seen[1:], strict=True))
    ]
    return df.sparkSession.createDataFrame(
        rows, "step int, stage string, rows_before bigint, rows_after bigint, rows_removed bigint"
    )


# Stages of the full chain that remove lines.
_STAGES = ("missing_customer", "blank_description", "invalid_sale")


def _stage_counts(price: float | None, customer: Column, named: Column) -> list[Column]:
    """All lines, and the lines left after each stage; ``named`` are those left after the second."""
    value = F.col("UnitPrice")
    if price is not None:
        value = F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(price))
    left = (customer, named, named & lines.is_sale(value))
    return [F.count(F.lit(1)), *[F.count_if(kept) for kept in left]]


def cleaning_audit(df: DataFrame, fill_price: float | None = None) -> DataFrame:
    """Rows before, after and removed for every stage of the full chain, in one pass.

    ``fill_price`` is the price missing ones are filled with before the validity
    check; without it they count as invalid.
    """
    customer = lines.has_customer()
    counts = _stage_counts(fill_price, customer, customer & lines.has_description())
    audit = df.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts)])
    stages = [
        F.struct(
            F.lit(i + 1).alias("step"),
            F.lit(name).alias("stage"),
            F.col(f"n{i}").alias("rows_before"),
            F.col(f"n{i + 1}").alias("rows_after"),
            (F.col(f"n{i}") - F.col(f"n{i + 1}")).alias("rows_removed"),
        )
        for i, name in enumerate(_STAGES)
    ]
    return audit.select(F.inline(F.array(*stages)))
