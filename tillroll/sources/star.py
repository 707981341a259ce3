"""Invoice lines derived from a star schema of orders.

The test tables are an order/line star rather than a transactions file. This
adapter derives the transactions shape from them, with the defects a real file
has: cancellations, guests, blank or missing names, missing and zero prices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns read, with their types: stating them saves a job per table that would
# open files only to learn the schema.
_TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string",
}

_HEADER = (
    "o_orderkey",
    "o_orderdate + make_dt_interval(0, 8 + CAST(o_orderkey % 12 AS INT)) AS InvoiceDate",
    "CASE WHEN o_custkey % 4 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS CustomerID",
    "n_name AS Country",
)

_LINE = (
    "concat(CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END, l_orderkey) AS InvoiceNo",
    "CAST(l_partkey AS STRING) AS StockCode",
    "CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN '  ' ELSE p_name END"
    " AS Description",
    "CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INT) AS Quantity",
    "InvoiceDate",
    "CASE WHEN l_suppkey % 37 = 0 AND l_linenumber = 1 THEN NULL"
    " WHEN l_suppkey % 41 = 0 AND l_linenumber = 2 THEN 0.0D"
    " ELSE l_extendedprice / l_quantity END AS UnitPrice",
    "CustomerID",
    "Country",
)


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{folder}/{name}.parquet")


def retail_view(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions shape of the star tables in ``folder``.

    The order header (order, customer, country) is joined up first: it has one row
    per order, so the line table, many times larger, is shuffled once for it
    instead of once per dimension. Which sides are broadcast is left to the
    optimizer, which knows their sizes.
    """
    lineitem, orders, customer, nation, part = (star_table(spark, folder, t) for t in _TABLES)
    places = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    headers = orders.join(places, orders["o_custkey"] == places["c_custkey"]).selectExpr(*_HEADER)
    return (
        lineitem.join(headers, lineitem["l_orderkey"] == headers["o_orderkey"])
        .join(part, lineitem["l_partkey"] == part["p_partkey"])
        .selectExpr(*_LINE)
    )
