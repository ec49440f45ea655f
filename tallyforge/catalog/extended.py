"""Queries of the line-total export: cleaning and extended tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extended as X
from ..sources.star import star_line_totals
from .base import money, query, rate, rounded

_T = """
t AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS "Order ID", o_orderdate AS "Order Date", l_shipdate AS "Ship Date",
         c_mktsegment AS "Segment", r_name AS "Region", p_type AS "Category", p_name AS "Product Name",
         CAST(floor(l_extendedprice) AS DOUBLE) AS "Sales", l_quantity AS "Quantity", l_discount AS "Discount",
         CASE WHEN l_linenumber <> 7
              THEN CAST(floor(l_extendedprice) AS DOUBLE) * ((l_partkey % 10) - 2) / CAST(20 AS DOUBLE) END AS "Profit"
  FROM lineitem
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN supplier ON s_suppkey = l_suppkey
  LEFT JOIN nation ON n_nationkey = s_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
  LEFT JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
)
"""


def _sql(statement: str) -> str:
    return f"WITH {_T} {statement}"


query("region_category_sales", _sql(
    'SELECT "Region", "Category", round(sum("Sales"), 2) AS "Sales" FROM t GROUP BY 1, 2'
))(
    lambda spark, d: rounded(
        X.region_category_totals(star_line_totals(spark, d, "Region", "Category", "Sales")), **money("Sales")
    )
)


@query("product_performance", _sql("""
    SELECT "Product Name", "Region", "Segment", strftime("Order Date", '%Y-%m') AS "Month",
           round(sum("Sales"), 2) AS "Total_Sales", round(coalesce(sum("Profit"), 0), 2) AS "Total_Profit"
    FROM t GROUP BY 1, 2, 3, 4
"""))
def product_performance(spark, d):
    rows = star_line_totals(spark, d, "Product Name", "Region", "Segment", "Order Date", "Sales", "Profit")
    return rounded(X.product_performance(rows), **money("Total_Sales", "Total_Profit"))


@query("monthly_trend", _sql("""
    SELECT strftime("Ship Date", '%Y-%m') AS "Month", round(sum("Sales"), 2) AS "Sales", round(sum("Profit"), 2) AS "Profit"
    FROM t GROUP BY 1
"""))
def monthly_trend(spark, d):
    rows = star_line_totals(spark, d, "Ship Date", "Sales", "Profit").withColumnRenamed("Ship Date", "Order Date")
    return rounded(X.monthly_trend(rows), **money("Sales", "Profit"))


_UNDER = """
    SELECT "Category", "Region", round("Profit", 2) AS "Profit" FROM (
      SELECT *, quantile_cont("Profit", 0.1) OVER () AS cut
      FROM (SELECT "Category", "Region", coalesce(sum("Profit"), 0) AS "Profit" FROM t GROUP BY 1, 2)
    ) WHERE "Profit" < cut
"""


def _underperformers(spark, d):
    rows = star_line_totals(spark, d, "Category", "Region", "Profit")
    return rounded(X.underperformers(rows), **money("Profit"))


query("underperformers", _sql(_UNDER))(_underperformers)


@query("discount_impact", _sql("""
    SELECT round_even("Discount" * 100 * 10, 0) / 10 AS "Discount %", round(avg("Profit"), 6) AS "Avg_Profit",
           count("Order ID") AS "Orders" FROM t GROUP BY 1
"""))
def discount_impact(spark, d):
    rows = star_line_totals(spark, d, "Order ID", "Discount", "Profit")
    rows = rows.withColumn("Discount %", F.expr(X.discount_percent("Discount")))
    return rounded(X.discount_impact(rows), **rate("Avg_Profit"))


_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

query("region_category_pivot", _sql('SELECT "Region", ' + ", ".join(
    f"coalesce(sum(\"Sales\") FILTER (WHERE \"Category\" = '{c}'), 0) AS \"{c}\"" for c in _TYPES
) + ' FROM t WHERE "Region" IS NOT NULL GROUP BY "Region"'))(
    lambda spark, d: X.region_category_pivot(star_line_totals(spark, d, "Region", "Category", "Sales"))
)


query("top_products", _sql("""
    SELECT "Product Name", round(sum("Sales"), 2) AS "Sales" FROM t GROUP BY 1
    ORDER BY sum("Sales") DESC, "Product Name" LIMIT 10
"""))(
    lambda spark, d: rounded(
        X.top_products(star_line_totals(spark, d, "Product Name", "Sales")), **money("Sales")
    )
)


@query("drop_exact_duplicates", _sql("""
    SELECT "Category", count(*) AS row_count, round(sum("Sales"), 2) AS "Sales" FROM (SELECT DISTINCT * FROM t) GROUP BY 1
"""))
def drop_exact_duplicates(spark, d):
    """Whole rows, some of them there twice."""
    rows = star_line_totals(spark, d)
    twice = rows.unionByName(rows.where("Quantity < 20"))
    sums = X.clean_export(twice).groupBy("Category").agg(F.count(F.lit(1)).alias("row_count"), F.sum("Sales").alias("Sales"))
    return rounded(sums, **money("Sales"))


@query("clean_export", _sql("""
    SELECT "Discount %", "Loss_Flag", count(*) AS row_count, count("Order Date") AS dated, round(sum("Sales"), 2) AS "Sales"
    FROM (
      SELECT DISTINCT "Order Date", "Ship Date", "Category", "Sales", "Discount", "Profit",
             round_even("Discount" * 100 * 10, 0) / 10 AS "Discount %", coalesce("Profit" < 0, false) AS "Loss_Flag"
      FROM t)
    GROUP BY 1, 2
"""))
def clean_export(spark, d):
    rows = star_line_totals(spark, d, "Order Date", "Ship Date", "Category", "Sales", "Discount", "Profit")
    as_text = {c: F.date_format(F.col(f"`{c}`"), "MM/dd/yyyy") for c in ("Order Date", "Ship Date")}
    cleaned = X.clean_export(rows.withColumns(as_text))
    table_ = cleaned.groupBy("Discount %", "Loss_Flag").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("Order Date").alias("dated"), F.sum("Sales").alias("Sales")
    )
    return rounded(table_, **money("Sales"))
