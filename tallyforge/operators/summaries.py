"""Aggregate tables of the monthly review.

Every table takes the whole line-item table and the two months to compare, and
reads both months in one pass: conditional sums replace a join of two
aggregates.  Sums are partial before the shuffle, so a group that holds most
of the rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import (
    band_label,
    band_order,
    bar_length,
    margin_risk,
    month_start,
    pct_change,
    safe_ratio,
)
from .derive import DISCOUNT_AMOUNT, GROSS_SALES, REVENUE
from .labels import note, note_counts
from .periods import in_period, in_periods, is_period

DIMENSIONS = ("category", "region", "product")


def _notes(rows: DataFrame, condition: str) -> tuple[list[str], str]:
    """Note aggregates and note text; no labels in the input, no note."""
    if "dq" not in rows.columns:
        return [], "CAST(NULL AS STRING)"
    return note_counts(condition), note()


def _compared(current: str | None, prior: str | None) -> list[str]:
    cur, pri = is_period(current), is_period(prior)
    return [
        f"count_if({cur}) AS n_current",
        f"sum(CASE WHEN {cur} THEN {REVENUE} END) AS revenue",
        f"sum(CASE WHEN {cur} THEN profit END) AS profit",
        f"sum(CASE WHEN {cur} THEN quantity END) AS quantity",
        f"avg(CASE WHEN {cur} THEN discount END) AS avg_discount",
        f"sum(CASE WHEN {pri} THEN {REVENUE} END) AS prior_revenue",
    ]


_SUMMARY = f"""
    revenue, profit, quantity, avg_discount, prior_revenue,
    {safe_ratio("profit", "revenue")} AS margin,
    {pct_change("revenue", "prior_revenue")} AS pct_change
"""


def grouped_summary(rows: DataFrame, by: str, current: str | None, prior: str | None) -> DataFrame:
    """Totals per group of the current month, with the change against the prior one."""
    counts, dq_note = _notes(rows, is_period(current))
    return rows.sparkSession.sql(
        f"""
        SELECT {by}, {_SUMMARY}, {dq_note} AS dq_note
        FROM (
            SELECT {by}, {", ".join(_compared(current, prior) + counts)}
            FROM {{rows}}
            WHERE {by} IS NOT NULL
            GROUP BY {by}
        )
        WHERE n_current > 0
        ORDER BY revenue DESC, {by}
        """,
        rows=in_periods(rows, current, prior),
    )


def category_summary(rows: DataFrame, current: str | None, prior: str | None) -> DataFrame:
    return grouped_summary(rows, "category", current, prior)


def region_summary(rows: DataFrame, current: str | None, prior: str | None) -> DataFrame:
    return grouped_summary(rows, "region", current, prior)


def product_summary(rows: DataFrame, current: str | None, prior: str | None) -> DataFrame:
    return grouped_summary(rows, "product", current, prior)


def dimension_summaries(
    rows: DataFrame, current: str | None, prior: str | None, dimensions: tuple[str, ...] = DIMENSIONS
) -> DataFrame:
    """The summaries of several dimensions and the grand total from one scan.

    Long form ``(dimension, name, ...)``; the total is dimension ``all``.
    """
    counts, dq_note = _notes(rows, is_period(current))
    which = " ".join(f"WHEN grouping({d}) = 0 THEN '{d}'" for d in dimensions)
    sets = ", ".join(f"({d})" for d in dimensions)
    return rows.sparkSession.sql(
        f"""
        SELECT dimension, name, {_SUMMARY}, {dq_note} AS dq_note
        FROM (
            SELECT CASE {which} ELSE 'all' END AS dimension, coalesce({", ".join(dimensions)}) AS name,
                   {", ".join(_compared(current, prior) + counts)}
            FROM {{rows}}
            GROUP BY GROUPING SETS ({sets}, ())
        )
        WHERE dimension = 'all' OR (n_current > 0 AND name IS NOT NULL)
        """,
        rows=in_periods(rows, current, prior),
    )


def overall_margin(profit: str, revenue: str) -> str:
    """Percent; 0 where nothing was sold, NULL where no profit is known."""
    return f"CASE WHEN {profit} IS NOT NULL THEN coalesce({safe_ratio(profit, revenue)} * 100, 0D) END"


def headline_totals(rows: DataFrame, current: str | None) -> DataFrame:
    """Revenue, profit and margin of a month; the last two NULL where no profit is known."""
    return rows.sparkSession.sql(
        f"""
        SELECT *, {overall_margin("profit", "revenue")} AS margin
        FROM (SELECT coalesce(sum({REVENUE}), 0D) AS revenue, sum(profit) AS profit FROM {{rows}})
        """,
        rows=in_period(rows, current),
    )


def revenue_change(rows: DataFrame, current: str | None, prior: str | None) -> DataFrame:
    """Headline revenue of both months and the change in percent."""
    return rows.sparkSession.sql(
        f"""
        SELECT *, {pct_change("revenue", "prior_revenue")} AS revenue_change
        FROM (
            SELECT coalesce(sum(CASE WHEN {is_period(current)} THEN {REVENUE} END), 0D) AS revenue,
                   sum(CASE WHEN {is_period(prior)} THEN {REVENUE} END) AS prior_revenue
            FROM {{rows}}
        )
        """,
        rows=in_periods(rows, current, prior),
    )


def group_of(summaries: DataFrame, by: str) -> DataFrame:
    """One dimension of long-form summaries, as ``grouped_summary`` gives it."""
    return summaries.sparkSession.sql(
        f"""
        SELECT name AS {by}, revenue, profit, quantity, avg_discount, prior_revenue, margin, pct_change, dq_note
        FROM {{summaries}} WHERE dimension = '{by}' ORDER BY revenue DESC, {by}
        """,
        summaries=summaries,
    )


def _of_all(column: str) -> str:
    return f"max({column}) FILTER (WHERE dimension = 'all')"


def headline_of(summaries: DataFrame) -> DataFrame:
    """``headline_totals`` from long-form summaries."""
    return summaries.sparkSession.sql(
        f"""
        SELECT *, {overall_margin("profit", "revenue")} AS margin
        FROM (SELECT coalesce({_of_all("revenue")}, 0D) AS revenue, {_of_all("profit")} AS profit FROM {{summaries}})
        """,
        summaries=summaries,
    )


def change_of(summaries: DataFrame) -> DataFrame:
    """``revenue_change`` from long-form summaries."""
    return summaries.sparkSession.sql(
        f"""
        SELECT *, {pct_change("revenue", "prior_revenue")} AS revenue_change
        FROM (SELECT coalesce({_of_all("revenue")}, 0D) AS revenue, {_of_all("prior_revenue")} AS prior_revenue FROM {{summaries}})
        """,
        summaries=summaries,
    )


_RISK = f"""
    avg_discount, revenue, profit, {safe_ratio("profit", "revenue")} AS margin,
    {margin_risk("avg_discount", safe_ratio("profit", "revenue"))} AS margin_risk
"""


def discount_analysis(
    rows: DataFrame, by: str, current: str | None, top_n: int | None = None
) -> DataFrame:
    """Average discount, margin and risk per group, biggest discount first."""
    counts, dq_note = _notes(rows, "true")
    sums = ["avg(discount) AS avg_discount", f"sum({REVENUE}) AS revenue", "sum(profit) AS profit", *counts]
    return rows.sparkSession.sql(
        f"""
        SELECT {by}, {_RISK}, {dq_note} AS dq_note
        FROM (SELECT {by}, {", ".join(sums)} FROM {{rows}} WHERE {by} IS NOT NULL GROUP BY {by})
        ORDER BY avg_discount DESC, {by}
        {"" if top_n is None else f"LIMIT {top_n}"}
        """,
        rows=in_period(rows, current),
    )


def discount_bands(rows: DataFrame, current: str | None) -> DataFrame:
    """Totals per discount band, in band order.

    An order with lines in several bands counts in each of them.
    """
    orders = "count(DISTINCT order_id)" if "order_id" in rows.columns else "count(*)"
    return rows.sparkSession.sql(
        f"""
        SELECT {band_label("band_ord")} AS band, orders, gross_sales, discount_amount, revenue, profit,
               {safe_ratio("profit", "revenue")} AS margin,
               {safe_ratio("revenue", "double(orders)")} AS avg_order_value
        FROM (
            SELECT {band_order("discount")} AS band_ord, {orders} AS orders,
                   sum({GROSS_SALES}) AS gross_sales, sum({DISCOUNT_AMOUNT}) AS discount_amount,
                   sum({REVENUE}) AS revenue, sum(profit) AS profit
            FROM {{rows}}
            GROUP BY 1
        )
        ORDER BY band_ord
        """,
        rows=in_period(rows, current),
    )


def discount_bands_by_product(rows: DataFrame, current: str | None) -> DataFrame:
    """Every product in every band it was sold in, never capped."""
    return rows.sparkSession.sql(
        f"""
        SELECT {band_label("band_ord")} AS band, product, {_RISK}
        FROM (
            SELECT {band_order("discount")} AS band_ord, product, avg(discount) AS avg_discount,
                   sum({REVENUE}) AS revenue, sum(profit) AS profit
            FROM {{rows}}
            WHERE product IS NOT NULL
            GROUP BY 1, product
        )
        ORDER BY band_ord, avg_discount DESC, product
        """,
        rows=in_period(rows, current),
    )


def monthly_summary(rows: DataFrame) -> DataFrame:
    """Revenue, profit and margin of every month, oldest first."""
    return rows.sparkSession.sql(
        f"""
        SELECT date_format(month, 'yyyy-MM') AS period, revenue, profit,
               {safe_ratio("profit", "revenue")} AS margin
        FROM (
            SELECT {month_start("date")} AS month, sum({REVENUE}) AS revenue, sum(profit) AS profit
            FROM {{rows}}
            WHERE date IS NOT NULL
            GROUP BY 1
        )
        ORDER BY month
        """,
        rows=rows,
    )


def with_bar_share(table: DataFrame) -> DataFrame:
    """Bar length of each group against the largest revenue of the table."""
    bar = bar_length("revenue", "(SELECT max(revenue) FROM {table})")
    return table.sparkSession.sql(f"SELECT *, {bar} AS bar FROM {{table}}", table=table)


def with_top_marker(table: DataFrame, by: str, n: int = 10) -> DataFrame:
    """Mark the first ``n`` rows of a discount table as shown at a glance."""
    top = table.orderBy(F.desc("avg_discount"), by).limit(n).select(by, F.lit(True).alias("in_top"))
    marked = table.join(F.broadcast(top), by, "left")
    return marked.withColumn("in_top", F.expr("coalesce(in_top, false)"))


def with_name_note(table: DataFrame, by: str) -> DataFrame:
    """The name as shown: marked only if the group's own rows were tagged."""
    return table.selectExpr(
        "*",
        "dq_note IS NOT NULL AS is_marked",
        f"coalesce(concat({by}, '  ⚠ ', dq_note), {by}) AS shown_name",
    )
