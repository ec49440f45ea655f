"""Cleaning and extended tables of a line-total export (Title Case columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import discount_percent, loss_flag, month_start, parse_us_date
from ..schema import UNDERPERFORMER_QUANTILE
from ..session import stored
from .duplicates import distinct_rows

CLEAN_REQUIRED = ["Order Date", "Ship Date", "Discount", "Profit"]


def clean_export(raw: DataFrame, scanned: bool = False) -> DataFrame:
    """Drop exact copies, parse the dates, add ``Discount %`` and ``Loss_Flag``.

    ``scanned`` rows are read again, as that is cheaper than to shuffle them whole.
    """
    missing = [c for c in CLEAN_REQUIRED if c not in raw.columns]
    if missing:
        raise ValueError(f"missing required column(s): {', '.join(missing)}")
    text = {c for c, kind in raw.dtypes if c in ("Order Date", "Ship Date") and kind == "string"}
    return (distinct_rows(raw) if scanned else raw.dropDuplicates()).selectExpr(
        *[f"{parse_us_date(f'`{c}`')} AS `{c}`" if c in text else f"`{c}`" for c in raw.columns],
        f"{discount_percent('Discount')} AS `Discount %`",
        f"{loss_flag('Profit')} AS Loss_Flag",
    )


def _total(column: str) -> str:
    return f"coalesce(sum({column}), 0D)"


def _sql(rows: DataFrame, text: str) -> DataFrame:
    return rows.sparkSession.sql(text, rows=rows)


def region_category_totals(rows: DataFrame) -> DataFrame:
    return _sql(rows, f"""
        SELECT Region, Category, {_total("Sales")} AS Sales
        FROM {{rows}} WHERE Region IS NOT NULL AND Category IS NOT NULL
        GROUP BY Region, Category
    """)


def product_performance(rows: DataFrame) -> DataFrame:
    """Totals and profit by product, region, segment and month; undated rows form a month."""
    return _sql(rows, f"""
        SELECT `Product Name`, Region, Segment, coalesce(date_format(month, 'yyyy-MM'), 'NaT') AS Month,
               Total_Sales, Total_Profit
        FROM (
            SELECT `Product Name`, Region, Segment, {month_start("`Order Date`")} AS month,
                   {_total("Sales")} AS Total_Sales, {_total("Profit")} AS Total_Profit
            FROM {{rows}}
            WHERE `Product Name` IS NOT NULL AND Region IS NOT NULL AND Segment IS NOT NULL
            GROUP BY 1, 2, 3, 4
        )
    """)


def monthly_trend(rows: DataFrame) -> DataFrame:
    return _sql(rows, f"""
        SELECT coalesce(date_format(month, 'yyyy-MM'), 'NaT') AS Month, Sales, Profit
        FROM (
            SELECT {month_start("`Order Date`")} AS month, {_total("Sales")} AS Sales, {_total("Profit")} AS Profit
            FROM {{rows}} GROUP BY 1
        )
        ORDER BY Month
    """)


def underperformers(rows: DataFrame) -> DataFrame:
    """(Category, Region) pairs strictly below the 10th percentile of profit.

    The percentile runs over one number per pair, after the aggregation.
    """
    pairs = _sql(rows, f"""
        SELECT Category, Region, {_total("Profit")} AS Profit
        FROM {{rows}} WHERE Category IS NOT NULL AND Region IS NOT NULL
        GROUP BY Category, Region
    """)
    return _sql(pairs, f"""
        SELECT * FROM {{rows}}
        WHERE Profit < (SELECT percentile(Profit, {UNDERPERFORMER_QUANTILE}) FROM {{rows}})
    """)


def discount_impact(rows: DataFrame) -> DataFrame:
    """Mean profit and number of lines per discount step."""
    return _sql(rows, """
        SELECT `Discount %`, avg(Profit) AS Avg_Profit, count(`Order ID`) AS Orders
        FROM {rows} WHERE `Discount %` IS NOT NULL GROUP BY `Discount %`
    """)


def region_category_pivot(rows: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Regions down, categories across, summed totals, 0 where nothing was sold.

    The columns of a table must be known when it is planned.  Pass them if they
    are; otherwise the sums are stored, so that listing the categories present does not
    read the rows a second time.
    """
    sums = region_category_totals(rows)
    if categories is None:
        sums = stored(sums)
        found = sums.select("Category").distinct().orderBy("Category").collect()
        categories = [r["Category"] for r in found]
    return sums.groupBy("Region").pivot("Category", categories).sum("Sales").na.fill(0.0)


def top_products(rows: DataFrame, n: int = 10) -> DataFrame:
    return _sql(rows, f"""
        SELECT `Product Name`, {_total("Sales")} AS Sales
        FROM {{rows}} WHERE `Product Name` IS NOT NULL
        GROUP BY 1 ORDER BY Sales DESC, `Product Name` LIMIT {n}
    """)

