"""Registry of the queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.periods import latest_two
from ..sources.star import star_items

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the statement that must give the same rows."""

    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def periods(spark: SparkSession, sf_dir: str) -> tuple[str | None, str | None]:
    """The two months to compare; reads one column of the line items."""
    return latest_two(star_items(spark, sf_dir, "date", labels=False))


def rounded(table: DataFrame, **digits: int) -> DataFrame:
    """Round for the comparison: sums of doubles depend on their order."""
    return table.selectExpr(
        *[f"round(`{c}`, {digits[c]}) AS `{c}`" if c in digits else f"`{c}`" for c in table.columns]
    )


def counted(rows: DataFrame, by: str, *sums: str, **digits: int) -> DataFrame:
    """``SELECT by, count(*) AS n, sums ... GROUP BY by``, rounded."""
    items = ", ".join([by, "count(*) AS n", *sums])
    table = rows.sparkSession.sql(f"SELECT {items} FROM {{rows}} GROUP BY 1", rows=rows)
    return rounded(table, **digits) if digits else table


def money(*names: str) -> dict[str, int]:
    return dict.fromkeys(names, 2)


def rate(*names: str) -> dict[str, int]:
    return dict.fromkeys(names, 6)


# ------------------------------------------------------------ SQL building blocks

ITEMS_SQL = """
items AS (
  SELECT l_shipdate AS date, CAST(l_orderkey AS VARCHAR) AS order_id, c_name AS customer, p_name AS product,
         p_type AS category, r_name AS region, l_quantity AS quantity,
         CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) AS price, l_discount * 3 AS discount,
         CASE WHEN l_linenumber <> 7
              THEN CAST(floor(l_extendedprice) AS DOUBLE) * ((l_partkey % 10) - 2) / CAST(20 AS DOUBLE) END AS profit,
         CASE WHEN l_linenumber = 1
              THEN l_quantity * CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) END AS sales_target
  FROM lineitem
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN supplier ON s_suppkey = l_suppkey
  LEFT JOIN nation ON n_nationkey = s_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
  LEFT JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
),
cur AS (SELECT max(date_trunc('month', date)) AS c FROM items),
pri AS (SELECT max(date_trunc('month', date)) AS p FROM items, cur WHERE date_trunc('month', date) < c),
x AS (
  SELECT items.*, date_trunc('month', date) = c AS is_cur, date_trunc('month', date) = p AS is_pri,
         quantity * price AS gross, quantity * price * discount AS disc,
         quantity * price * (1 - discount) AS rev,
         CASE WHEN discount <= 0 THEN 0 WHEN discount <= CAST(0.05 AS DOUBLE) THEN 1
              WHEN discount <= CAST(0.10 AS DOUBLE) THEN 2 WHEN discount <= CAST(0.20 AS DOUBLE) THEN 3
              ELSE 4 END AS band_ord,
         CASE WHEN discount <= 0 THEN 'No discount'
              WHEN discount <= CAST(0.05 AS DOUBLE) THEN 'Above 0% through 5%'
              WHEN discount <= CAST(0.10 AS DOUBLE) THEN 'Above 5% through 10%'
              WHEN discount <= CAST(0.20 AS DOUBLE) THEN 'Above 10% through 20%'
              ELSE 'Above 20%' END AS band
  FROM items, cur, pri
)
"""

# The unchecked exports of sources.star.star_exports, and the rules applied to them.
EXPORTS_SQL = """
exports AS (
  SELECT CASE WHEN l_linenumber = 7
                   AND ((l_returnflag = 'R' AND l_linestatus = 'O') OR l_quantity >= 49)
              THEN NULL ELSE CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) END AS date,
         CASE WHEN l_linenumber = 3 AND l_tax = 0.02 THEN '' ELSE 'Walk-in' END AS customer,
         p_name AS product,
         CASE WHEN l_linenumber = 3 AND l_tax = 0.01 THEN '' ELSE p_type END AS category,
         CASE WHEN l_linenumber = 3 AND l_tax = 0.0 THEN '  ' ELSE r_name END AS region,
         CAST(CASE WHEN l_linenumber = 1 AND l_tax = 0.08 THEN 0 WHEN l_linenumber > 4 THEN 2 ELSE 1 END AS DOUBLE) AS quantity,
         CASE WHEN l_linenumber = 2 AND l_tax = 0.08 THEN -1 ELSE 1 END
           * (CAST(floor(p_size / 10) AS DOUBLE) + 1) * 10 AS price,
         CAST(CASE WHEN l_linenumber = 4 AND l_tax = 0.0 THEN 1.4 WHEN l_linenumber = 4 AND l_tax = 0.01 THEN -0.2
              WHEN l_discount >= 0.05 THEN 0.15 ELSE 0 END AS DOUBLE) AS discount,
         CAST(CASE WHEN l_discount = 0.10 THEN -5 WHEN l_linenumber <> 5 THEN 2 END AS DOUBLE) AS profit,
         CAST(NULL AS DOUBLE) AS sales_target,
         CAST(l_orderkey AS VARCHAR) AS order_id,
         'export_' || l_returnflag || l_linestatus || '.csv' AS source_file
  FROM lineitem
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN supplier ON s_suppkey = l_suppkey
  LEFT JOIN nation ON n_nationkey = s_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
),
shares AS (
  SELECT source_file, count(*) AS n_rows, count(*) FILTER (WHERE date IS NULL) AS n_bad FROM exports GROUP BY 1
),
accepted AS (SELECT source_file FROM shares WHERE CAST(n_bad AS DOUBLE) / n_rows <= CAST(0.05 AS DOUBLE)),
dated AS (SELECT exports.* FROM exports JOIN accepted USING (source_file) WHERE date IS NOT NULL),
kept AS (
  SELECT * REPLACE (least(greatest(discount, 0), 1) AS discount),
         discount AS given_discount
  FROM dated WHERE NOT (quantity <= 0 OR price < 0)
),
tagged AS (
  SELECT *,
         count(*) OVER (PARTITION BY date, customer, product, category, region, quantity, price, discount, profit,
                        sales_target) AS copies,
         count(*) OVER (PARTITION BY source_file, date, customer, product, category, region, quantity, price,
                        discount, profit, sales_target) AS file_copies
  FROM kept
),
labelled AS (
  SELECT *, nullif(concat_ws(';',
           CASE WHEN trim(region) = '' THEN 'flagged:invalid_region' END,
           CASE WHEN trim(category) = '' THEN 'flagged:invalid_category' END,
           CASE WHEN trim(customer) = '' THEN 'flagged:invalid_customer' END,
           CASE WHEN given_discount < 0 OR given_discount > 1 THEN 'clamped:discount' END,
           CASE WHEN profit < 0 THEN 'flagged:negative_profit' END), '') AS row_flag
  FROM tagged
)
"""


def items_sql(statement: str) -> str:
    return f"WITH {ITEMS_SQL} {statement}"


def exports_sql(statement: str) -> str:
    return f"WITH {EXPORTS_SQL} {statement}"
