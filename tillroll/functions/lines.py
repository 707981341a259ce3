"""Expressions over one invoice line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: invoice numbers of cancellations start with this letter (upper case only).
CANCELLATION_PREFIX = "C"


def revenue(digits: int | None = 2) -> Column:
    """Line revenue, rounded half up to ``digits`` places; ``None`` leaves it raw."""
    amount = F.col("Quantity") * F.col("UnitPrice")
    return amount if digits is None else F.round(amount, digits)


def invoice_kind() -> Column:
    """As much of the invoice number as tells a cancellation from a sale."""
    return F.substring("InvoiceNo", 1, len(CANCELLATION_PREFIX))


def is_sale(price: Column | None = None) -> Column:
    """A completed sale: not cancelled, something sold, at a price.

    Null (not false) when any of the three inputs is null, so a filter drops it.
    """
    price = F.col("UnitPrice") if price is None else price
    kept = ~F.col("InvoiceNo").startswith(CANCELLATION_PREFIX)
    return kept & (F.col("Quantity") > 0) & (price > 0)


def has_customer() -> Column:
    return F.col("CustomerID").isNotNull()


def has_description() -> Column:
    """Present and not just spaces. Null for a missing name, so a filter drops it."""
    return F.trim("Description") != ""
