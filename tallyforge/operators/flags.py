"""Underperformance flags and the plain-language summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ..functions import literal, pct_change
from ..functions.formats import dollars, one_decimal, signed_decimal
from ..schema import DECLINE_CRITICAL, DECLINE_WARNING, LOW_MARGIN
from .summaries import DIMENSIONS, dimension_summaries, overall_margin

DECLINE_REASON = (
    f"CASE WHEN pct_change <= {DECLINE_WARNING}D "
    f"THEN concat('revenue down ', {one_decimal('pct_change')}, '% vs prior period') END"
)
MARGIN_REASON = (
    f"CASE WHEN margin < {LOW_MARGIN}D THEN concat('margin only ', {one_decimal('margin * 100')}, '%') END"
)
LOSS_REASON = f"CASE WHEN profit < 0 THEN concat('negative total profit (', {dollars('profit')}, ')') END"

# All reasons of a group, NULL if there is none.
REASON = f"nullif(concat_ws('; ', {DECLINE_REASON}, {MARGIN_REASON}, {LOSS_REASON}), '')"
SEVERITY = (
    f"CASE WHEN pct_change <= {DECLINE_CRITICAL}D OR profit < 0 THEN 'critical' "
    f"WHEN pct_change <= {DECLINE_WARNING}D OR margin < {LOW_MARGIN}D THEN 'warning' END"
)


def flag_rows(summaries: DataFrame) -> DataFrame:
    """Flags of long-form summaries, critical first, then by dimension and revenue."""
    order = ", ".join(literal(d) for d in DIMENSIONS)
    return summaries.sparkSession.sql(
        f"""
        SELECT dimension, name, {REASON} AS reason, {SEVERITY} AS severity
        FROM {{summaries}}
        WHERE dimension <> 'all' AND {SEVERITY} IS NOT NULL
        ORDER BY severity, array_position(array({order}), dimension), revenue DESC, name
        """,
        summaries=summaries,
    )


def flags(rows: DataFrame, current: str | None, prior: str | None) -> DataFrame:
    return flag_rows(dimension_summaries(rows, current, prior))


def generate_flags(category: DataFrame, region: DataFrame, product: DataFrame) -> DataFrame:
    """Flags of three finished summary tables."""
    long = [
        table.selectExpr(f"'{d}' AS dimension", f"{d} AS name", "revenue", "profit", "margin", "pct_change")
        for d, table in zip(DIMENSIONS, (category, region, product))
    ]
    return flag_rows(reduce(DataFrame.unionByName, long))


def flag_counts(flag_table: DataFrame) -> DataFrame:
    return flag_table.sparkSession.sql(
        "SELECT count_if(severity = 'critical') AS critical, count_if(severity = 'warning') AS warning FROM {t}",
        t=flag_table,
    )


def flag_lines(flag_table: DataFrame) -> DataFrame:
    """One sentence per flag."""
    line = "concat(initcap(dimension), ': ', name, ' — ', replace(reason, '; ', ' and '), '.')"
    return flag_table.selectExpr("dimension", "name", "severity", f"{line} AS line")


def summary_facts(summaries: DataFrame) -> DataFrame:
    """One row with everything the summary says, from long-form summaries."""
    best_first = "CASE WHEN dimension = 'category' THEN struct(-revenue, name) END"
    by_change = "CASE WHEN dimension = 'region' AND pct_change IS NOT NULL THEN struct(pct_change, name) END"
    return summaries.sparkSession.sql(
        f"""
        SELECT coalesce(max(revenue) FILTER (WHERE dimension = 'all'), 0D) AS revenue,
               max(profit) FILTER (WHERE dimension = 'all') AS profit,
               max(prior_revenue) FILTER (WHERE dimension = 'all') AS prior_revenue,
               min_by(name, {best_first}) AS top_category,
               min_by(revenue, {best_first}) AS top_category_revenue,
               count_if(dimension = 'region') AS regions,
               min_by(name, {by_change}) AS worst_region, min_by(pct_change, {by_change}) AS worst_change,
               max_by(name, {by_change}) AS best_region, max_by(pct_change, {by_change}) AS best_change,
               count_if(dimension <> 'all' AND {SEVERITY} = 'critical') AS critical,
               count_if(dimension <> 'all' AND {SEVERITY} = 'warning') AS warning
        FROM {{summaries}}
        """,
        summaries=summaries,
    )


def summary_bullets(facts: DataFrame, current: str | None, prior: str | None) -> DataFrame:
    """The summary as ``(ord, bullet)``."""
    margin = overall_margin("profit", "revenue")
    change = pct_change("revenue", "prior_revenue")
    start = f"concat('In {current or 'this period'}, total sales revenue was ', {dollars('revenue')}"
    without_profit = literal(". No profit data was provided, so profit and margin aren't shown.")
    no_prior = literal(
        "No prior period was found in the data yet, so period-over-period comparisons aren't available."
    )
    headline = f"""CASE WHEN profit IS NOT NULL
        THEN {start}, ' with ', {dollars("profit")}, ' in profit (a ', {one_decimal(margin)}, '% overall margin).')
        ELSE {start}, {without_profit}) END"""
    versus = f"""concat(CASE WHEN {change} >= 0 THEN 'Up ' WHEN {change} < 0 THEN 'Down ' END,
        {one_decimal(f"abs({change})")}, '% versus {prior} (', {dollars("prior_revenue")}, ').')"""
    top = f"concat(top_category, ' was the top category by revenue (', {dollars('top_category_revenue')}, ').')"
    regions = f"""CASE WHEN regions > 1 AND worst_change < 0 THEN concat(
        worst_region, ' was the weakest region (', {one_decimal("worst_change")}, '%), while ',
        best_region, ' led growth (', {signed_decimal("best_change")}, '%).') END"""
    raised = """CASE WHEN critical + warning > 0 THEN concat(
        critical, ' critical and ', warning, ' warning flag(s) were raised below — see Flags for detail.')
        ELSE 'No critical issues were flagged this period.' END"""
    bullets = ", ".join([headline, no_prior if prior is None else versus, top, regions, raised])
    return facts.selectExpr(f"posexplode(array_compact(array({bullets}))) AS (at, bullet)").selectExpr(
        "at + 1 AS ord", "bullet"
    )
