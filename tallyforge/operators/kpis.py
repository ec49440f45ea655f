"""Order, customer and target figures of a month, and the table that shows them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import fmt_money, fmt_num, fmt_pct, literal, pct_change, safe_ratio
from ..schema import KPI_NAMES
from .derive import DISCOUNT_AMOUNT, GROSS_SALES, REVENUE
from .periods import in_periods, is_period
from .summaries import overall_margin

_SUMS = ["n", "gross", "disc", "net", "units", "profit", "target", "prior_net", "prior_profit"]

_FIGURES = {
    "gross_sales": "gross",
    "discount_amount": "disc",
    "net_sales": "net",
    "total_profit": "profit",
    "overall_margin": overall_margin("profit", "net"),
    "num_orders": "orders",
    "units_sold": "units",
    "avg_order_value": safe_ratio("net", "double(orders)"),
    "avg_selling_price": safe_ratio("net", "units"),
    "discount_rate": f"{safe_ratio('disc', 'gross')} * 100",
    "profit_per_order": safe_ratio("profit", "double(orders)"),
    "distinct_customers": "customers",
    "sales_target": "nullif(target, 0D)",
    "target_achievement": f"{safe_ratio('net', 'target')} * 100",
    "sales_growth": pct_change("net", "prior_net"),
    "profit_growth": pct_change("profit", "prior_profit"),
    "negative_profit_orders": "CASE WHEN profit IS NOT NULL THEN loss_orders END",
    "discounted_orders": "cut_orders",
}


def kpis(rows: DataFrame, current: str | None, prior: str | None) -> DataFrame:
    """One row with the 18 figures; NULL where one cannot be told.

    Lines are first summed per (order, customer).  That much smaller table is
    then rolled up by order and by customer at once, and both roll-ups end in
    one row - one scan, no count-distinct over the lines, no join.
    """
    cur, pri = is_period(current), is_period(prior)
    has_orders = "order_id" in rows.columns
    keys = [k for k in ("order_id", "customer") if k in rows.columns]
    sums = ", ".join(f"sum({c}) AS {c}" for c in _SUMS)
    if len(keys) == 2:
        rolled = f"""
            SELECT order_id, customer, grouping(customer) = 1 AS per_order, {sums}
            FROM lines GROUP BY GROUPING SETS ((order_id), (customer))
        """
    else:
        rolled = "SELECT *, true AS per_order FROM lines"
    order = "per_order AND n > 0 AND order_id IS NOT NULL"
    customer = f"{'NOT per_order AND' if has_orders else ''} n > 0 AND customer IS NOT NULL"
    none = "CAST(NULL AS BIGINT)"
    totals = [
        *[f"sum(CASE WHEN per_order THEN {c} END) AS {c}" for c in _SUMS],
        (f"count_if({order})" if has_orders else "sum(n)") + " AS orders",
        (f"count_if({customer})" if "customer" in keys else none) + " AS customers",
        (f"count_if({order} AND profit < 0)" if has_orders else none) + " AS loss_orders",
        (f"count_if({order} AND disc > 0)" if has_orders else none) + " AS cut_orders",
    ]
    figures = ", ".join(f"CASE WHEN n > 0 THEN {_FIGURES[k]} END AS {k}" for k in KPI_NAMES)
    return rows.sparkSession.sql(
        f"""
        WITH lines AS (
            SELECT {"".join(k + ", " for k in keys)}
                   count_if({cur}) AS n,
                   sum(CASE WHEN {cur} THEN {GROSS_SALES} END) AS gross,
                   sum(CASE WHEN {cur} THEN {DISCOUNT_AMOUNT} END) AS disc,
                   sum(CASE WHEN {cur} THEN {REVENUE} END) AS net,
                   sum(CASE WHEN {cur} THEN quantity END) AS units,
                   sum(CASE WHEN {cur} THEN profit END) AS profit,
                   sum(CASE WHEN {cur} THEN sales_target END) AS target,
                   sum(CASE WHEN {pri} THEN {REVENUE} END) AS prior_net,
                   sum(CASE WHEN {pri} THEN profit END) AS prior_profit
            FROM {{rows}}
            {"GROUP BY " + ", ".join(keys) if keys else ""}
        ),
        rolled AS ({rolled})
        SELECT {figures} FROM (SELECT {", ".join(totals)} FROM rolled)
        """,
        rows=in_periods(rows, current, prior),
    )


# Label, formatter and definition of each shown figure.
_SHOWN = [
    ("gross_sales", "Gross Sales", "money", "Quantity x Price, summed"),
    ("discount_amount", "Discount Amount", "money", "Gross Sales x Discount %, summed"),
    ("net_sales", "Net Sales", "money", "Gross Sales - Discount Amount"),
    ("total_profit", "Total Profit", "money", "Net Sales - Total Cost (from the profit column)"),
    ("overall_margin", "Profit Margin %", "pct", "Total Profit / Net Sales x 100"),
    ("num_orders", "Distinct Orders", "num", "Distinct count of Order ID"),
    ("units_sold", "Units Sold", "num", "Sum of Quantity"),
    ("avg_order_value", "Average Order Value", "money", "Net Sales / distinct Orders"),
    ("avg_selling_price", "Average Selling Price", "money", "Net Sales / Units Sold"),
    ("discount_rate", "Discount Rate %", "pct", "Discount Amount / Gross Sales x 100"),
    ("profit_per_order", "Profit per Order", "money", "Total Profit / distinct Orders"),
    ("distinct_customers", "Distinct Customers", "num", "Distinct count of Customer"),
    ("sales_target", "Sales Target", "money",
     "Sum of the sales_target column (not in this source file unless provided)"),
    ("target_achievement", "Target Achievement %", "pct", "Net Sales / Sales Target x 100"),
    ("sales_growth", "Sales Growth vs Prior Period", "signed",
     "(Current Net Sales - Prior Net Sales) / Prior Net Sales x 100"),
    ("profit_growth", "Profit Growth vs Prior Period", "signed",
     "(Current Total Profit - Prior Total Profit) / Prior Total Profit x 100"),
    ("negative_profit_orders", "Negative-Profit Orders", "num",
     "Distinct orders whose summed profit is below 0"),
    ("discounted_orders", "Discounted Orders", "num", "Distinct orders with a non-zero discount amount"),
]
_NO_SOURCE = "Not available from source data"
_FORMATS = {
    "money": fmt_money,
    "num": fmt_num,
    "pct": lambda c: fmt_pct(c, signed=False),
    "signed": fmt_pct,
}


def kpi_rows(figures: DataFrame) -> DataFrame:
    """The figures as rows ``(ord, metric, value, definition)``."""
    entries = []
    for ord_, (name, label, kind, definition) in enumerate(_SHOWN, start=1):
        text = _FORMATS[kind](name)
        if name in ("sales_target", "target_achievement"):
            text = f"CASE WHEN {name} IS NULL THEN {literal(_NO_SOURCE)} ELSE {text} END"
        entries.append(f"{ord_}, {literal(label)}, {text}, {literal(definition)}")
    return figures.selectExpr(
        f"stack({len(entries)}, {', '.join(entries)}) AS (ord, metric, value, definition)"
    )
