"""Derived measures and synthetic order ids."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import month_bucket, safe_ratio, strip

GROSS_SALES = "quantity * price"
DISCOUNT_AMOUNT = "quantity * price * discount"
REVENUE = "quantity * price * (1 - discount)"
MARGIN = safe_ratio("profit", REVENUE)


def with_measures(rows: DataFrame) -> DataFrame:
    """Add gross_sales, discount_amount, revenue, margin and period."""
    return rows.selectExpr(
        "*",
        f"{GROSS_SALES} AS gross_sales",
        f"{DISCOUNT_AMOUNT} AS discount_amount",
        f"{REVENUE} AS revenue",
        f"{MARGIN} AS margin",
        f"{month_bucket('date')} AS period",
    )


def ensure_order_id(order_id: str, file: str, row_id: str) -> str:
    """The trimmed id, or one made of the file's path and the row where it is blank."""
    text = strip(order_id)
    blank = f"coalesce({text} IN ('', 'nan', 'none'), true)"
    return f"CASE WHEN {blank} THEN concat({file}, '-row', {row_id}) ELSE {text} END"
