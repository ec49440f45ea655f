"""Totals over the whole table, without a month split."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import round_half_even, safe_ratio
from ..schema import WEAK_REGION_SHARE
from .derive import REVENUE


def revenue_by(rows: DataFrame, by: str) -> DataFrame:
    return rows.sparkSession.sql(
        f"SELECT {by}, sum({REVENUE}) AS revenue FROM {{rows}} WHERE {by} IS NOT NULL GROUP BY {by}", rows=rows
    )


def discount_impact_by_product(rows: DataFrame) -> DataFrame:
    """Summed revenue, discount rates and profit per product, with the margin in percent."""
    margin = round_half_even(f"{safe_ratio('profit', 'revenue')} * 100", 2)
    return rows.sparkSession.sql(
        f"""
        SELECT *, {margin} AS profit_margin
        FROM (
            SELECT product, sum({REVENUE}) AS revenue, coalesce(sum(discount), 0D) AS discount,
                   coalesce(sum(profit), 0D) AS profit
            FROM {{rows}} WHERE product IS NOT NULL GROUP BY product
        )
        """,
        rows=rows,
    )


def weak_regions(rows: DataFrame) -> DataFrame:
    """Regions that earn less than a fifth of the average region."""
    return rows.sparkSession.sql(
        f"""
        SELECT * FROM {{by_region}}
        WHERE revenue < (SELECT avg(revenue) FROM {{by_region}}) * {WEAK_REGION_SHARE}D
        """,
        by_region=revenue_by(rows, "region"),
    )


def analyze_items(rows: DataFrame) -> dict[str, DataFrame]:
    return {
        "by_region": revenue_by(rows, "region"),
        "by_category": revenue_by(rows, "category"),
        "by_product": revenue_by(rows, "product"),
        "discount_impact": discount_impact_by_product(rows),
        "weak_regions": weak_regions(rows),
    }
