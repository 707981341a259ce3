"""Several questions asked of the same sales."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators import metrics
from tillroll.operators.cleaning import add_revenue, remove_invalid_sales
from tillroll.operators.layout import checkpointed, reused, staged

# Columns of the combined answer; a question leaves those it does not use empty.
_ANSWER = {
    "query": "string",
    "Country": "string",
    "StockCode": "string",
    "CustomerID": "double",
    "d": "date",
    "orders": "bigint",
    "rev": "double",
    "q": "bigint",
}


def workload_base(raw: DataFrame) -> DataFrame:
    """Valid sales with raw revenue, and only the columns the questions read."""
    return add_revenue(remove_invalid_sales(raw), digits=None).select(
        "InvoiceNo", "StockCode", "CustomerID", "Country", "InvoiceDate", "Quantity", "Revenue"
    )


def _questions(base: DataFrame, daily: DataFrame) -> dict[str, DataFrame]:
    stats = metrics.daily_rollup_stats(daily)
    return {
        "country_revenue": metrics.country_revenue(base),
        "top_stockcodes": metrics.top_stockcodes(base),
        "customer_orders_revenue": metrics.customer_orders_revenue(base),
        "daily_total": stats.select(F.col("total_rev").alias("rev")),
        "daily_mean": stats.select(F.col("avg_rev").alias("rev")),
        "best_day": metrics.best_day(daily),
    }


@contextmanager
def shared_workload(raw: DataFrame, cache: bool = True) -> Iterator[dict[str, DataFrame]]:
    """The questions by name, over a base and a daily table kept while in use.

    The base keeps the layout of its source. Laying it out by country first, as one
    might for the country question, would put most rows into one partition and
    helps no other question; partial aggregation makes it needless.
    """
    with ExitStack() as kept:
        base = workload_base(raw)
        if cache:
            base = kept.enter_context(reused(base))
        daily = metrics.daily_rollup(base)
        if cache:
            daily = kept.enter_context(reused(daily))
        yield _questions(base, daily)


def _daily_answers(daily: DataFrame) -> DataFrame:
    """Total, mean and best day from one aggregation over the daily table."""
    day = F.struct("d", "rev", "q")
    earlier_first = F.struct(F.col("rev"), -F.unix_date("d"))
    stats = daily.agg(
        F.sum("rev").alias("total"),
        F.avg("rev").alias("mean"),
        F.max_by(day, earlier_first).alias("best"),
    )

    def answer(query: str, d: Column, rev: Column, q: Column) -> Column:
        return F.struct(
            F.lit(query).alias("query"), d.alias("d"), rev.alias("rev"), q.alias("q")
        )

    no_day, no_units = F.lit(None).cast("date"), F.lit(None).cast("bigint")
    best = F.col("best")
    rows = F.array(
        answer("daily_total", no_day, F.col("total"), no_units),
        answer("daily_mean", no_day, F.col("mean"), no_units),
        answer("best_day", best["d"], best["rev"], best["q"]),
    )
    return stats.select(F.inline(rows))


def workload(raw: DataFrame) -> DataFrame:
    """All answers as one relation, from one pass over the base per grouping key."""
    return _combined(workload_base(raw))


def workload_once(raw: DataFrame) -> DataFrame:
    """:func:`workload` with one scan of the source.

    The base is staged as Parquet in the shared folder while the answers are worked out; each
    question reads only its columns of it. The answers are checkpointed before it is removed,
    so this runs jobs before it returns.
    """
    with staged(workload_base(raw)) as base:
        return checkpointed(_combined(base))


def _combined(base: DataFrame) -> DataFrame:
    answers = [
        metrics.country_revenue(base).withColumn("query", F.lit("country_revenue")),
        metrics.top_stockcodes(base).withColumn("query", F.lit("top_stockcodes")),
        metrics.customer_orders_revenue(base).withColumn(
            "query", F.lit("customer_orders_revenue")
        ),
        _daily_answers(metrics.daily_rollup(base)),
    ]
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), answers)
    return combined.select(*[F.col(c).cast(t).alias(c) for c, t in _ANSWER.items()])
