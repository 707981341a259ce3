"""The same questions as :mod:`verification.queries`, in SQL for DuckDB.

Written from the definitions, not from the Spark plans: medians and quartiles are
plain discrete quantiles, metrics plain aggregates, contributions a closed form.
"""

from __future__ import annotations

import math

from verification.queries import (
    BACKGROUND,
    CAP_FACTOR,
    HOLIDAYS,
    HOME,
    PRICE_THRESHOLD,
    SCORE_THRESHOLD,
)



def _position(purpose: str, *parts: str) -> str:
    """The hash that samples and splits go by, as hexadecimal digits."""
    values = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '~')" for p in parts)
    return f"substr(md5(concat_ws('|', '{purpose}', '42', {values})), 1, 13)"


def _share(part: float) -> str:
    """The digits below which that share of all positions lies."""
    return f"'{math.ceil(part * 16**13):013x}'"


def _millionths(column: str) -> str:
    return f"CAST(floor({column} * 1000000) AS BIGINT)"


_CUSTOMER = _millionths("CustomerID")
_LINE_KEY = ("InvoiceNo", "StockCode", "Quantity", _millionths("UnitPrice"))
_WHOLE_LINE = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S')",
    _millionths("UnitPrice"),
    _CUSTOMER,
    "Country",
)
_DATES = ", ".join(f"DATE '{day}'" for day in HOLIDAYS)

# Named relations; a query lists the ones it needs, in this order.
_RELATIONS = {
    "retail": """
        SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR)
                   AS InvoiceNo,
               CAST(l_partkey AS VARCHAR) AS StockCode,
               CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN '  '
                    ELSE p_name END AS Description,
               CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INT)
                   AS Quantity,
               o_orderdate + to_hours(8 + CAST(o_orderkey % 12 AS INT)) AS InvoiceDate,
               CASE WHEN l_suppkey % 37 = 0 AND l_linenumber = 1 THEN NULL
                    WHEN l_suppkey % 41 = 0 AND l_linenumber = 2 THEN 0.0
                    ELSE l_extendedprice / l_quantity END AS UnitPrice,
               CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END
                   AS CustomerID,
               n_name AS Country
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                      JOIN customer ON o_custkey = c_custkey
                      JOIN nation ON c_nationkey = n_nationkey
                      JOIN part ON l_partkey = p_partkey""",
    "sales": """
        SELECT *, Quantity * UnitPrice AS Revenue FROM retail
        WHERE InvoiceNo NOT LIKE 'C%' AND Quantity > 0 AND UnitPrice > 0""",
    "clean": """
        SELECT *, round(Quantity * UnitPrice, 2) AS Revenue FROM retail
        WHERE trim(Description) <> '' AND CustomerID IS NOT NULL
          AND InvoiceNo NOT LIKE 'C%' AND Quantity > 0 AND UnitPrice > 0""",
    "identified": """
        SELECT * FROM retail WHERE CustomerID IS NOT NULL AND trim(Description) <> ''""",
    "mid": "SELECT quantile_disc(UnitPrice, 0.5) AS price FROM identified",
    "quart": """
        SELECT quantile_disc(Quantity, 0.25) AS q1, quantile_disc(Quantity, 0.75) AS q3,
               quantile_disc(UnitPrice, 0.25) AS p1, quantile_disc(UnitPrice, 0.75) AS p3
        FROM clean""",
    "invoices": """
        SELECT CustomerID, InvoiceNo, sum(CAST(round(Revenue * 100) AS BIGINT)) AS cents
        FROM clean GROUP BY ALL""",
    "baskets": """
        SELECT CustomerID,
               CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS BIGINT) / 100
                   AS average_transaction_value
        FROM invoices GROUP BY CustomerID""",
    "behaviour": """
        SELECT CustomerID,
               count(DISTINCT InvoiceNo) AS total_purchases,
               CAST(sum(Quantity) AS BIGINT) AS total_quantity,
               round(sum(Revenue), 2) AS total_revenue,
               count(DISTINCT StockCode) AS unique_products,
               CAST(date_diff('day', max(InvoiceDate),
                              (SELECT max(InvoiceDate) FROM clean)) AS INT)
                   AS days_since_last_purchase
        FROM clean GROUP BY CustomerID""",
    "features": """
        SELECT behaviour.*, average_transaction_value
        FROM behaviour LEFT JOIN baskets USING (CustomerID)""",
    "homes": """
        SELECT CustomerID, arg_min(Country, (InvoiceDate, Country)) AS country
        FROM clean GROUP BY CustomerID""",
    "churn": f"""
        SELECT features.*, country,
               CASE WHEN days_since_last_purchase > 90 THEN 1 ELSE 0 END AS label,
               CASE WHEN country = '{HOME}' THEN '{HOME}' ELSE 'International' END AS segment
        FROM features LEFT JOIN homes USING (CustomerID)""",
    "scored": f"""
        SELECT segment, label, CAST(1.0 AS DOUBLE) / (1 + total_purchases) AS score,
               CAST(1.0 AS DOUBLE) / (1 + total_purchases) > {SCORE_THRESHOLD} AS predicted
        FROM churn""",
    "populations": """
        SELECT 'everyone' AS segment, label, score, predicted FROM scored""",
    "days": """
        SELECT CAST(InvoiceDate AS DATE) AS d, sum(Revenue) AS rev,
               CAST(sum(Quantity) AS BIGINT) AS q
        FROM sales GROUP BY ALL""",
    "background": f"""
        SELECT * FROM churn ORDER BY {_position("background", _CUSTOMER)}, CustomerID
        LIMIT {BACKGROUND}""",
    "daily": f"""
        SELECT CAST(InvoiceDate AS DATE) AS sale_date,
               CAST(dayofweek(sale_date) + 1 AS INT) AS day_of_week,
               CAST(month(sale_date) AS INT) AS month,
               CAST(quarter(sale_date) AS INT) AS quarter,
               CASE WHEN dayofweek(sale_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
               CAST(coalesce(CAST(InvoiceDate AS DATE) IN ({_DATES}), false) AS INT) AS is_holiday,
               round(sum(Revenue), 2) AS daily_revenue
        FROM clean GROUP BY ALL""",
    "means": """
        SELECT avg(total_purchases) AS ep, avg(unique_products) AS eu,
               avg(total_purchases * unique_products) AS epu,
               avg(average_transaction_value) AS ea
        FROM background""",
    # Contributions to 3p - 2u + p*u/2 + a/100 in closed form.
    "explained": """
        SELECT CustomerID,
               3 * total_purchases - 2 * unique_products
                   + 0.5 * total_purchases * unique_products
                   + 0.01 * average_transaction_value AS score,
               3 * ep - 2 * eu + 0.5 * epu + 0.01 * ea AS base_value,
               total_purchases, total_revenue, average_transaction_value, unique_products,
               total_quantity,
               3 * (total_purchases - ep) + 0.25 * (total_purchases * eu - epu
                   + total_purchases * unique_products - unique_products * ep) AS phi_p,
               -2 * (unique_products - eu) + 0.25 * (unique_products * ep - epu
                   + total_purchases * unique_products - total_purchases * eu) AS phi_u,
               0.01 * (average_transaction_value - ea) AS phi_a
        FROM churn, means""",
    "contributions": """
        SELECT CustomerID, score, base_value, 1 AS position, 'total_purchases' AS feature,
               CAST(total_purchases AS DOUBLE) AS feature_value, phi_p AS contribution
        FROM explained
        UNION ALL SELECT CustomerID, score, base_value, 2, 'total_revenue', total_revenue, 0.0
        FROM explained
        UNION ALL SELECT CustomerID, score, base_value, 3, 'average_transaction_value',
               average_transaction_value, phi_a FROM explained
        UNION ALL SELECT CustomerID, score, base_value, 4, 'unique_products', unique_products,
               phi_u FROM explained
        UNION ALL SELECT CustomerID, score, base_value, 5, 'total_quantity', total_quantity, 0.0
        FROM explained""",
}


def _metric_relations(source: str) -> dict[str, str]:
    """Classification metrics per ``segment`` of a relation of scored customers."""
    return {
        "scores": f"""
            SELECT segment, score, sum(label) AS ps, sum(1 - label) AS ns
            FROM {source} GROUP BY ALL""",
        "ranked": """
            SELECT *, sum(ns) OVER (PARTITION BY segment ORDER BY score) - ns AS below
            FROM scores""",
        "areas": """
            SELECT segment,
                   sum(ps * (below + ns / 2)) / nullif(CAST(sum(ps) AS DOUBLE) * sum(ns), 0)
                       AS auc
            FROM ranked GROUP BY segment""",
        "cells": f"""
            SELECT segment, CAST(count(*) AS DOUBLE) AS n,
                   CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg,
                   CAST(count(*) FILTER (label = 1 AND predicted) AS DOUBLE) AS tp,
                   CAST(count(*) FILTER (label = 0 AND predicted) AS DOUBLE) AS fp,
                   CAST(count(*) FILTER (label = 0 AND NOT predicted) AS DOUBLE) AS tn,
                   CAST(count(*) FILTER (label = 1 AND NOT predicted) AS DOUBLE) AS fn
            FROM {source} GROUP BY segment""",
        "rates": """
            SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p1,
                   coalesce(tn / nullif(tn + fn, 0), 0) AS p0,
                   coalesce(tp / nullif(pos, 0), 0) AS r1, coalesce(tn / nullif(neg, 0), 0) AS r0
            FROM cells""",
        "quality": """
            SELECT segment, CAST(n AS BIGINT) AS n, CAST(pos AS BIGINT) AS n_churned,
                   CAST(neg AS BIGINT) AS n_active, round(auc, 4) AS auc_roc,
                   round((pos * p1 + neg * p0) / n, 4) AS "precision",
                   round((pos * r1 + neg * r0) / n, 4) AS recall,
                   round((pos * coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0)
                          + neg * coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0)) / n, 4) AS f1
            FROM rates JOIN areas USING (segment)""",
    }


_RETAIL = ["retail"]
_SALES = ["retail", "sales"]
_CLEAN = ["retail", "clean"]
_IDENTIFIED = ["retail", "identified", "mid"]
_QUARTILES = ["retail", "clean", "quart"]
_FEATURES = ["retail", "clean", "invoices", "baskets", "behaviour", "features"]
_CHURN = [*_FEATURES, "homes", "churn"]
_SCORED = [*_CHURN, "scored"]
_DAYS = [*_SALES, "days"]
_EXPLAINED = [*_CHURN, "background", "means", "explained", "contributions"]


def _with(names: list[str], body: str, metrics_of: str | None = None) -> str:
    relations = {name: _RELATIONS[name] for name in names}
    if metrics_of:
        relations |= _metric_relations(metrics_of)
    ctes = ", ".join(f"{name} AS ({sql})" for name, sql in relations.items())
    return f"WITH {ctes} {body}"


_LINE = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"
_HOLIDAY = f"CAST(coalesce(CAST(InvoiceDate AS DATE) IN ({_DATES}), false) AS INT) AS is_holiday"
_COUNTED = {
    "InvoiceNo": "string",
    "StockCode": "string",
    "Description": "string",
    "Quantity": "int",
    "InvoiceDate": "timestamp_ntz",
    "UnitPrice": "double",
    "CustomerID": "double",
    "Country": "string",
}
_SCHEMA = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type,"
    f" count({c}) AS n_present FROM retail"
    for i, (c, t) in enumerate(_COUNTED.items(), 1)
)
_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(*) AS n_rows FROM retail"
    for c in _COUNTED
)
_DAILY = """
    SELECT CAST(InvoiceDate AS DATE) AS sale_date, round(sum(Revenue), 2) AS daily_revenue,
           count(DISTINCT InvoiceNo) AS transactions, CAST(sum(Quantity) AS BIGINT) AS units_sold
    FROM sales GROUP BY ALL"""
_BEST = """
    SELECT StockCode, Description, CAST(sum(Quantity) AS BIGINT) AS total_quantity,
           round(sum(Revenue), 2) AS total_revenue
    FROM sales GROUP BY ALL ORDER BY total_quantity DESC, StockCode, Description LIMIT 5"""


def _full(names: list[str], body: str) -> str:
    """A question about clean lines, asked about the full cleaning chain, where units are doubles."""
    chain = ORACLE_FULL.removeprefix("WITH ")
    relations = {n: _RELATIONS[n] for n in names if n not in ("retail", "clean")}
    ctes = ", ".join(f"{name} AS ({sql})" for name, sql in relations.items())
    ctes = ctes.replace("CAST(sum(Quantity) AS BIGINT)", "sum(Quantity)")
    return f"WITH clean AS (WITH {chain}), {ctes} {body}"


def _clamp(column: str, low: str, high: str, k: float) -> str:
    return (
        f"least(greatest(CAST({column} AS DOUBLE), {low} - {k} * ({high} - {low})),"
        f" {high} + {k} * ({high} - {low}))"
    )


def _outside(column: str, low: str, high: str, k: float) -> tuple[str, str]:
    return (
        f"{column} < {low} - {k} * ({high} - {low})",
        f"{column} > {high} + {k} * ({high} - {low})",
    )


_Q_OUT = " OR ".join(_outside("Quantity", "q1", "q3", 1.5))
_P_OUT = " OR ".join(_outside("UnitPrice", "p1", "p3", 1.5))

# The full cleaning chain, which other questions build on.
ORACLE_FULL = _with(
    _IDENTIFIED,
    f""", filled AS (
            SELECT * EXCLUDE (price) REPLACE (coalesce(UnitPrice, price) AS UnitPrice)
            FROM identified, mid),
        valid AS (
            SELECT * FROM filled
            WHERE InvoiceNo NOT LIKE 'C%' AND Quantity > 0 AND UnitPrice > 0),
        quart AS (
            SELECT quantile_disc(Quantity, 0.25) AS q1, quantile_disc(Quantity, 0.75) AS q3,
                   quantile_disc(UnitPrice, 0.25) AS p1, quantile_disc(UnitPrice, 0.75) AS p3
            FROM valid),
        capped AS (
            SELECT InvoiceNo, StockCode, Description,
                   {_clamp("Quantity", "q1", "q3", 1.5)} AS Quantity, InvoiceDate,
                   {_clamp("UnitPrice", "p1", "p3", 1.5)} AS UnitPrice, CustomerID, Country
            FROM valid, quart)
        SELECT *, round(Quantity * UnitPrice, 2) AS Revenue FROM capped""",
)

_WORKLOAD = """, best AS (SELECT * FROM days ORDER BY rev DESC, d LIMIT 1),
      codes AS (SELECT StockCode, CAST(sum(Quantity) AS BIGINT) AS q FROM sales GROUP BY ALL
                ORDER BY q DESC, StockCode LIMIT 5)
    SELECT 'country_revenue' AS query, Country, CAST(NULL AS VARCHAR) AS StockCode,
           CAST(NULL AS DOUBLE) AS CustomerID, CAST(NULL AS DATE) AS d,
           CAST(NULL AS BIGINT) AS orders, round(sum(Revenue), 2) AS rev,
           CAST(NULL AS BIGINT) AS q
    FROM sales GROUP BY Country
    UNION ALL SELECT 'top_stockcodes', NULL, StockCode, NULL, NULL, NULL, NULL, q FROM codes
    UNION ALL SELECT 'customer_orders_revenue', NULL, NULL, CustomerID, NULL,
           count(DISTINCT InvoiceNo), round(sum(Revenue), 2), NULL
    FROM sales GROUP BY CustomerID
    UNION ALL SELECT 'daily_total', NULL, NULL, NULL, NULL, NULL, round(sum(rev), 2), NULL
    FROM days
    UNION ALL SELECT 'daily_mean', NULL, NULL, NULL, NULL, NULL, round(avg(rev), 2), NULL
    FROM days
    UNION ALL SELECT 'best_day', NULL, NULL, NULL, d, NULL, round(rev, 2), q FROM best"""

ORACLE: dict[str, str] = {
    "dataset_shape": _with(_RETAIL, "SELECT count(*) AS n_rows, 8 AS n_columns FROM retail"),
    "preview": _with(
        _RETAIL,
        "SELECT * FROM retail ORDER BY "
        + ", ".join(f"{c} NULLS FIRST" for c in _LINE.split(", "))
        + " LIMIT 10",
    ),
    "schema_listing": _with(_RETAIL, _SCHEMA),
    "null_profile": _with(_RETAIL, _NULLS),
    "cleaning_audit": _with(
        _IDENTIFIED,
        """, n AS (
            SELECT count(*) AS n0, count(*) FILTER (CustomerID IS NOT NULL) AS n1,
                   count(*) FILTER (CustomerID IS NOT NULL AND trim(Description) <> '') AS n2,
                   count(*) FILTER (CustomerID IS NOT NULL AND trim(Description) <> ''
                       AND InvoiceNo NOT LIKE 'C%' AND Quantity > 0
                       AND coalesce(UnitPrice, price) > 0) AS n3
            FROM retail, mid)
        SELECT 1 AS step, 'missing_customer' AS stage, n0 AS rows_before, n1 AS rows_after,
               n0 - n1 AS rows_removed FROM n
        UNION ALL SELECT 2, 'blank_description', n1, n2, n1 - n2 FROM n
        UNION ALL SELECT 3, 'invalid_sale', n2, n3, n2 - n3 FROM n""",
    ),
    "written_audit": _with(
        _IDENTIFIED,
        """, n AS (
            SELECT count(*) AS n0, count(*) FILTER (CustomerID IS NOT NULL) AS n1,
                   count(*) FILTER (CustomerID IS NOT NULL AND trim(Description) <> '') AS n2,
                   count(*) FILTER (CustomerID IS NOT NULL AND trim(Description) <> ''
                       AND InvoiceNo NOT LIKE 'C%' AND Quantity > 0
                       AND coalesce(UnitPrice, price) > 0) AS n3
            FROM retail, mid)
        SELECT 1 AS step, 'missing_customer' AS stage, n0 AS rows_before, n1 AS rows_after,
               n0 - n1 AS rows_removed FROM n
        UNION ALL SELECT 2, 'blank_description', n1, n2, n1 - n2 FROM n
        UNION ALL SELECT 3, 'invalid_sale', n2, n3, n2 - n3 FROM n""",
    ),
    "csv_roundtrip": _with(_RETAIL, f"SELECT {_LINE}, 0 AS n_rejects FROM retail"),
    "add_revenue": _with(
        _RETAIL, "SELECT *, round(Quantity * UnitPrice, 2) + 0.0 AS Revenue FROM retail"
    ),
    "remove_invalid_sales": _with(_SALES, f"SELECT {_LINE} FROM sales"),
    "drop_missing_customer": _with(
        _RETAIL, "SELECT * FROM retail WHERE CustomerID IS NOT NULL"
    ),
    "drop_blank_description": _with(
        _RETAIL, "SELECT * FROM retail WHERE trim(Description) <> ''"
    ),
    "impute_median_price": _with(
        _IDENTIFIED,
        "SELECT * EXCLUDE (price) REPLACE (coalesce(UnitPrice, price) AS UnitPrice)"
        " FROM identified, mid",
    ),
    "iqr_bounds": _with(
        _QUARTILES,
        """SELECT 'Quantity' AS column_name, CAST(q1 AS DOUBLE) AS q1, CAST(q3 AS DOUBLE) AS q3,
                  round(CAST(q1 - 1.5 * (q3 - q1) AS DOUBLE), 6) AS lower,
                  round(CAST(q3 + 1.5 * (q3 - q1) AS DOUBLE), 6) AS upper FROM quart
           UNION ALL
           SELECT 'UnitPrice', p1, p3, round(p1 - 1.5 * (p3 - p1), 6),
                  round(p3 + 1.5 * (p3 - p1), 6) FROM quart""",
    ),
    "iqr_outliers": _with(
        _QUARTILES,
        f"""SELECT {_LINE}, ({_Q_OUT}) AS Quantity_outlier, ({_P_OUT}) AS UnitPrice_outlier
            FROM clean, quart WHERE {_Q_OUT} OR {_P_OUT}""",
    ),
    "iqr_outlier_counts": _with(
        _QUARTILES,
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({below}) AS n_below,"
            f" count(*) FILTER ({above}) AS n_above FROM clean, quart"
            for c, (below, above) in {
                "Quantity": _outside("Quantity", "q1", "q3", CAP_FACTOR),
                "UnitPrice": _outside("UnitPrice", "p1", "p3", CAP_FACTOR),
            }.items()
        ),
    ),
    "cap_outliers_iqr": _with(
        _QUARTILES,
        f"""SELECT InvoiceNo, StockCode, Description,
                   {_clamp("Quantity", "q1", "q3", CAP_FACTOR)} AS Quantity, InvoiceDate,
                   {_clamp("UnitPrice", "p1", "p3", CAP_FACTOR)} AS UnitPrice, CustomerID, Country
            FROM clean, quart""",
    ),
    "clean_data": _with(_CLEAN, f"SELECT {_LINE} FROM clean"),
    "clean_data_keep_guests": _with(
        _SALES, f"SELECT {_LINE} FROM sales WHERE trim(Description) <> ''"
    ),
    "clean_full": ORACLE_FULL,
    "threshold_filter": _with(
        _RETAIL,
        f"SELECT * FROM retail WHERE UnitPrice > {PRICE_THRESHOLD} AND Quantity % 2 = 0",
    ),
    "total_sales": _with(_SALES, "SELECT round(sum(Revenue), 2) AS total_sales FROM sales"),
    "avg_transaction_value": _with(
        _SALES,
        """SELECT round(avg(total), 2) AS avg_transaction_value
           FROM (SELECT sum(Revenue) AS total FROM sales GROUP BY InvoiceNo)""",
    ),
    "distinct_counts": _with(
        _SALES,
        """SELECT count(DISTINCT InvoiceNo) AS num_transactions,
                  count(DISTINCT StockCode) AS unique_products,
                  count(DISTINCT CustomerID) AS unique_customers FROM sales""",
    ),
    "aggregate_sales": _with(
        _CLEAN,
        """SELECT round(sum(Revenue), 2) AS total_sales,
                  CAST(sum(Quantity) AS BIGINT) AS total_quantity,
                  count(DISTINCT InvoiceNo) AS num_transactions FROM clean""",
    ),
    "kpi_summary": _with(
        _SALES,
        f""", k AS (
            SELECT round(sum(Revenue), 2) AS total_sales, sum(Quantity) AS units,
                   count(DISTINCT InvoiceNo) AS invoices, count(DISTINCT StockCode) AS products,
                   count(DISTINCT CustomerID) AS customers FROM sales),
          best AS ({_BEST})
        SELECT 'summary' AS section, 'total_sales' AS name, CAST(total_sales AS DOUBLE) AS value
        FROM k
        UNION ALL SELECT 'summary', 'average_transaction_value',
               (SELECT round(avg(total), 2)
                FROM (SELECT sum(Revenue) AS total FROM sales GROUP BY InvoiceNo))
        UNION ALL SELECT 'summary', 'number_of_transactions', invoices FROM k
        UNION ALL SELECT 'summary', 'total_quantity_sold', units FROM k
        UNION ALL SELECT 'summary', 'unique_products', products FROM k
        UNION ALL SELECT 'summary', 'unique_customers', customers FROM k
        UNION ALL SELECT 'summary', 'total_line_items', count(*) FROM retail
        UNION ALL SELECT 'top_product_by_quantity', Description || ' (' || StockCode || ')',
               total_quantity FROM best""",
    ),
    "top_products": _with(_SALES, _BEST),
    "daily_sales": _with(_SALES, _DAILY),
    "daily_sales_sql": _with(_SALES, _DAILY),
    "sales_by_country": _with(
        _SALES, "SELECT Country, round(sum(Revenue), 2) AS total_revenue FROM sales GROUP BY ALL"
    ),
    "distinct_countries": _with(_RETAIL, "SELECT DISTINCT Country FROM retail"),
    "basic_stats": _with(
        _SALES,
        """SELECT round(avg(Revenue), 2) AS avg_value, round(max(Revenue), 2) AS max_value,
                  round(min(Revenue), 2) AS min_value, count(*) AS n_rows FROM sales""",
    ),
    "range_stats": _with(
        _RETAIL,
        """SELECT CAST(sum(CAST(Quantity AS BIGINT) * Quantity) AS BIGINT) AS sum_of_squares,
                  count(*) FILTER (Quantity % 2 = 0) AS n_even,
                  CAST(sum(Quantity * 2) AS BIGINT) AS sum_doubled FROM retail""",
    ),
    "country_revenue": _with(
        _SALES, "SELECT Country, round(sum(Revenue), 2) AS rev FROM sales GROUP BY ALL"
    ),
    "top_stockcodes": _with(
        _SALES,
        """SELECT StockCode, CAST(sum(Quantity) AS BIGINT) AS q FROM sales GROUP BY ALL
           ORDER BY q DESC, StockCode LIMIT 5""",
    ),
    "customer_orders_revenue": _with(
        _SALES,
        """SELECT CustomerID, count(DISTINCT InvoiceNo) AS orders, round(sum(Revenue), 2) AS rev
           FROM sales GROUP BY ALL""",
    ),
    "daily_rollup": _with(_DAYS, "SELECT d, round(rev, 2) AS rev, q FROM days"),
    "daily_rollup_stats": _with(
        _DAYS,
        "SELECT round(sum(rev), 2) AS total_rev, round(avg(rev), 2) AS avg_rev FROM days",
    ),
    "best_day": _with(
        _DAYS, "SELECT d, round(rev, 2) AS rev, q FROM days ORDER BY days.rev DESC, d LIMIT 1"
    ),
    "workload": _with(_DAYS, _WORKLOAD),
    "workload_once": _with(_DAYS, _WORKLOAD),
    "hot_key_placement": _with(
        _SALES,
        """SELECT Country, count(*) AS n_rows,
                  count(*) * 24 > (SELECT count(*) FROM sales) AS spread
           FROM sales GROUP BY ALL""",
    ),
    "repartition_profile": _with(
        _SALES, "SELECT Country, count(*) AS n_rows FROM sales GROUP BY ALL"
    ),
    "temporal_features": _with(
        _RETAIL,
        f"""SELECT *, CAST(dayofweek(InvoiceDate) + 1 AS INT) AS day_of_week,
                   dayname(InvoiceDate) AS day_name, CAST(month(InvoiceDate) AS INT) AS month,
                   CAST(quarter(InvoiceDate) AS INT) AS quarter,
                   CAST(year(InvoiceDate) AS INT) AS year, CAST(hour(InvoiceDate) AS INT) AS hour,
                   CASE WHEN dayofweek(InvoiceDate) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
                   {_HOLIDAY} FROM retail""",
    ),
    "holiday_flag": _with(_RETAIL, f"SELECT *, {_HOLIDAY} FROM retail"),
    "holiday_flag_udf": _with(_RETAIL, f"SELECT *, {_HOLIDAY} FROM retail"),
    "holiday_flag_calendar": _with(
        _RETAIL,
        """SELECT *, CAST(coalesce(strftime(InvoiceDate, '%m-%d') IN ('01-01', '12-25', '12-26'),
                                   false) AS INT) AS is_holiday FROM retail""",
    ),
    "daily_model_frame": _with(
        _CLEAN,
        f"""SELECT CAST(InvoiceDate AS DATE) AS sale_date,
                   CAST(dayofweek(sale_date) + 1 AS INT) AS day_of_week,
                   CAST(month(sale_date) AS INT) AS month,
                   CAST(quarter(sale_date) AS INT) AS quarter,
                   CASE WHEN dayofweek(sale_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
                   {_HOLIDAY}, round(sum(Revenue), 2) AS daily_revenue
            FROM clean GROUP BY ALL""",
    ),
    "customer_avg_transaction_raw": _with(
        _SALES,
        """SELECT CustomerID,
                  CAST((2 * total + n * 100000000) // (2 * n * 100000000) AS BIGINT) / 100
                      AS average_transaction_value
           FROM (SELECT CustomerID, count(DISTINCT InvoiceNo) AS n,
                        sum(CAST(round(Revenue * 10000000000) AS HUGEINT)) AS total
                 FROM sales GROUP BY CustomerID)""",
    ),
    "customer_features_full": _full(_FEATURES, "SELECT * FROM features"),
    "churn_table_full": _full(_CHURN, "SELECT * FROM churn"),
    "daily_model_frame_full": _full([*_CLEAN, "daily"], "SELECT * FROM daily"),
    "sample_lines": _with(
        _RETAIL, f"SELECT * FROM retail WHERE {_position('sample', *_WHOLE_LINE)} < {_share(0.1)}"
    ),
    "train_test_split": _with(
        _CHURN,
        f"""SELECT *, CASE WHEN {_position("split", _CUSTOMER)} < {_share(0.8)} THEN 'train'
                           ELSE 'test' END AS part FROM churn""",
    ),
    "forecast_held_out": _with(
        [*_CLEAN, "daily"],
        f"""SELECT sale_date, daily_revenue AS actual FROM daily
            WHERE {_position("split", "sale_date")} >= {_share(0.8)}""",
    ),
    "forecast_normal_equations": _with(
        [*_CLEAN, "daily"],
        f"""SELECT n_train, unnest(['day_of_week', 'month', 'quarter', 'is_weekend', 'is_holiday'])
                   AS feature, CAST(0 AS DOUBLE) AS moment
            FROM (SELECT count(*) AS n_train FROM daily
                  WHERE {_position("split", "sale_date")} < {_share(0.8)})""",
    ),
    "demand_held_out": _with(
        _CLEAN,
        f"""SELECT 'held_out' AS part, count(*) AS n_lines, CAST(sum(Quantity) AS DOUBLE) AS units
            FROM clean WHERE {_position("split", *_LINE_KEY)} >= {_share(0.8)}
            UNION ALL
            SELECT 'sampled_train', count(*), CAST(sum(Quantity) AS DOUBLE)
            FROM clean WHERE {_position("split", *_LINE_KEY)} < {_share(0.8)}
              AND {_position("sample", *_LINE_KEY)} < {_share(0.1)}""",
    ),
    "demand_walk": _with(
        _CLEAN,
        f"""SELECT count(*) AS n_lines, count(*) AS n_agree
            FROM clean WHERE {_position("split", *_LINE_KEY)} >= {_share(0.8)}""",
    ),
    "churn_walk": _with(
        _CHURN,
        f"""SELECT CustomerID, label, true AS agrees FROM churn
            WHERE CustomerID IS NOT NULL AND {_position("split", _CUSTOMER)} >= {_share(0.8)}""",
    ),
    "attribution_sums": _with(
        _CHURN,
        f"""SELECT CustomerID, label, true AS adds_up FROM churn
            WHERE CustomerID IS NOT NULL AND {_position("split", _CUSTOMER)} >= {_share(0.8)}""",
    ),
    "churn_held_out": _with(
        _CHURN,
        f"""SELECT CustomerID, label FROM churn
            WHERE {_position("split", _CUSTOMER)} >= {_share(0.8)}""",
    ),
    "customer_avg_transaction": _with(
        _FEATURES, "SELECT CustomerID, average_transaction_value FROM baskets"
    ),
    "customer_features": _with(_FEATURES, "SELECT * FROM features"),
    "scaled_customer_features": _with(
        _FEATURES,
        "SELECT CustomerID, "
        + ", ".join(
            f"round(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0), 6)"
            f" + 0.0 AS {c}"
            for c in (
                "total_purchases",
                "total_quantity",
                "total_revenue",
                "unique_products",
                "days_since_last_purchase",
                "average_transaction_value",
            )
        )
        + " FROM features",
    ),
    "churn_table": _with(_CHURN, "SELECT * FROM churn"),
    "regression_metrics": _with(
        _CLEAN,
        """, p AS (
            SELECT CAST(Quantity AS DOUBLE) AS y,
                   CAST(20 + 2 * (dayofweek(InvoiceDate) + 1) - 0.5 * month(InvoiceDate) AS DOUBLE)
                       AS f FROM clean)
        SELECT count(*) AS n, round(sqrt(avg((y - f) * (y - f))), 6) AS rmse,
               round(1 - sum((y - f) * (y - f))
                     / sum((y - (SELECT avg(y) FROM p)) * (y - (SELECT avg(y) FROM p))), 6) AS r2
        FROM p""",
    ),
    "auc_roc": _with(
        [*_SCORED, "populations"], "SELECT round(auc, 10) AS auc_roc FROM areas", "populations"
    ),
    "classification_metrics": _with(
        [*_SCORED, "populations"], "SELECT * EXCLUDE (segment) FROM quality", "populations"
    ),
    "segment_metrics": _with(_SCORED, "SELECT * FROM quality", "scored"),
    "fairness_report": _with(
        _SCORED,
        """, v AS (
            SELECT segment, 'auc_roc' AS metric, auc_roc AS value FROM quality
            UNION ALL SELECT segment, 'precision', "precision" FROM quality
            UNION ALL SELECT segment, 'recall', recall FROM quality
            UNION ALL SELECT segment, 'f1', f1 FROM quality),
          g AS (
            SELECT a.metric, a.segment AS segment_a, a.value AS value_a, b.segment AS segment_b,
                   b.value AS value_b, round(abs(a.value - b.value), 4) AS difference
            FROM v a JOIN v b ON a.metric = b.metric AND a.segment < b.segment
            WHERE a.value IS NOT NULL AND b.value IS NOT NULL
              AND (SELECT count(*) FROM quality) = 2)
        SELECT *, max(difference) OVER () AS max_disparity,
               max(difference) OVER () > 0.10 AS fairness_concern FROM g""",
        "scored",
    ),
    "shapley_attribution": _with(
        _EXPLAINED,
        """SELECT CustomerID, feature, round(score, 6) + 0.0 AS score,
                  round(base_value, 6) + 0.0 AS base_value,
                  round(feature_value, 6) + 0.0 AS feature_value,
                  round(contribution, 6) + 0.0 AS contribution
           FROM contributions""",
    ),
    "top_driver": _with(
        _EXPLAINED,
        """SELECT CustomerID, feature AS top_driver, round(contribution, 6) AS contribution
           FROM contributions
           QUALIFY row_number() OVER (PARTITION BY CustomerID
                                      ORDER BY abs(contribution) DESC, position) = 1""",
    ),
}
