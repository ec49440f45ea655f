"""Line items from a star schema of Parquet tables.

Line items carry their own date, quantity and price; product and category come
from ``part``, the region from the supplier's nation and the customer from the
order.  Only the dimensions behind the columns asked for are joined, so a table
by category never touches ``orders``.  The joins carry no broadcast hint: Spark
broadcasts a side whose measured size allows it, and otherwise splits a hot key
of a sort-merge join at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.quality import flagged, usable
from ..schema import BUSINESS_COLUMNS


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the star schema; its schema is read from the files once per session."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _lookup(rows: DataFrame, dimension: DataFrame, key: str, *columns: str) -> DataFrame:
    """Add columns of a dimension; its key is the first of them."""
    dimension = dimension.select(*columns)
    return rows.join(dimension, F.expr(f"{key} = {columns[0]}"), "left")


def _facts(spark: SparkSession, sf_dir: str, wanted: set[str], early: list[str]) -> DataFrame:
    """Line items with the dimension columns behind ``wanted``, and expressions over their own columns."""

    def read(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    rows = read("lineitem")
    if wanted & {"p_name", "p_type", "p_size"}:
        rows = _lookup(rows, read("part"), "l_partkey", "p_partkey", "p_name", "p_type", "p_size")
    rows = rows.selectExpr("*", *early)
    if "r_name" in wanted:
        # One lookup at a time, so that Spark sees each table's own size.
        rows = _lookup(rows, read("supplier"), "l_suppkey", "s_suppkey", "s_nationkey")
        rows = _lookup(rows, read("nation"), "s_nationkey", "n_nationkey", "n_regionkey")
        rows = _lookup(rows, read("region"), "n_regionkey", "r_regionkey", "r_name")
    if wanted & {"c_name", "c_mktsegment"}:
        # Buyers meet the orders first: line items are shuffled once, by order.
        buyers = _lookup(read("orders"), read("customer"), "o_custkey", "c_custkey", "c_name", "c_mktsegment")
        rows = _lookup(rows, buyers, "l_orderkey", "o_orderkey", "o_orderdate", "c_name", "c_mktsegment")
    elif "o_orderdate" in wanted:
        rows = _lookup(rows, read("orders"), "l_orderkey", "o_orderkey", "o_orderdate")
    return rows


_PRICE = "double(floor(l_extendedprice / l_quantity))"
_PROFIT = "CASE WHEN l_linenumber <> 7 THEN double(floor(l_extendedprice)) * ((l_partkey % 10) - 2) / 20D END"

# Column -> (expression, dimension column it needs)
ITEM_SOURCES = {
    "date": ("l_shipdate", None),
    "order_id": ("string(l_orderkey)", None),
    "customer": ("c_name", "c_name"),
    "product": ("p_name", "p_name"),
    "category": ("p_type", "p_type"),
    "region": ("r_name", "r_name"),
    "quantity": ("l_quantity", None),
    "price": (_PRICE, None),
    "discount": ("l_discount * 3", None),
    "profit": (_PROFIT, None),
    "return_flag": ("l_returnflag", None),
    "sales_target": (f"CASE WHEN l_linenumber = 1 THEN l_quantity * {_PRICE} END", None),
}


def _view(spark: SparkSession, sf_dir: str, columns: dict[str, tuple], names: list[str], early: tuple[str, ...] = ()) -> DataFrame:
    """The named columns; those in ``early`` are made before orders are joined, so that they are shuffled for it and not what they are made of."""
    wanted = {columns[n][1] for n in names if columns[n][1]}
    made = [n for n in names if n in early]
    rows = _facts(spark, sf_dir, wanted, [f"{columns[n][0]} AS `{n}`" for n in made])
    return rows.selectExpr(*[f"`{n}`" if n in made else f"{columns[n][0]} AS `{n}`" for n in names])


def star_items(spark: SparkSession, sf_dir: str, *columns: str, labels: bool = True) -> DataFrame:
    """Checked line items with the named columns (all of them by default).

    With ``labels`` the row rules add ``dq``; the rules of columns that were not
    asked for have nothing to look at and are left out.
    """
    rows = _view(spark, sf_dir, ITEM_SOURCES, list(columns or ["order_id", *BUSINESS_COLUMNS]))
    return flagged(usable(rows)) if labels else rows


# ------------------------------------------------- unchecked exports with dirt

EXPORT_FILES = [f"export_{flag}{status}.csv" for flag in "ANR" for status in "FO"]
HALTING = "RO"


_EXPORTS = {
    "date": (
        f"""CASE WHEN l_linenumber = 7 AND (concat(l_returnflag, l_linestatus) = '{HALTING}' OR l_quantity >= 49)
        THEN NULL ELSE CAST(date_trunc('month', l_shipdate) AS TIMESTAMP_NTZ) END""", None),
    "customer": ("CASE WHEN l_linenumber = 3 AND l_tax = 0.02D THEN '' ELSE 'Walk-in' END", None),
    "product": ("p_name", "p_name"),
    "category": ("CASE WHEN l_linenumber = 3 AND l_tax = 0.01D THEN '' ELSE p_type END", "p_type"),
    "region": ("CASE WHEN l_linenumber = 3 AND l_tax = 0D THEN '  ' ELSE r_name END", "r_name"),
    "quantity": (
        "CASE WHEN l_linenumber = 1 AND l_tax = 0.08D THEN 0D WHEN l_linenumber > 4 THEN 2D ELSE 1D END", None),
    "price": (
        """CASE WHEN l_linenumber = 2 AND l_tax = 0.08D THEN -1 ELSE 1 END
        * (double(floor(p_size / 10)) + 1) * 10""", "p_size"),
    "discount": (
        """CASE WHEN l_linenumber = 4 AND l_tax = 0D THEN 1.4D WHEN l_linenumber = 4 AND l_tax = 0.01D THEN -0.2D
        WHEN l_discount >= 0.05D THEN 0.15D ELSE 0D END""", None),
    "profit": ("CASE WHEN l_discount = 0.10D THEN -5D WHEN l_linenumber <> 5 THEN 2D END", None),
    "sales_target": ("CAST(NULL AS DOUBLE)", None),
    "order_id": ("string(l_orderkey)", None),
    "source_file": ("concat('export_', l_returnflag, l_linestatus, '.csv')", None),
    "missing_optional": ("CAST(array() AS ARRAY<STRING>)", None),
    "row_id": ("monotonically_increasing_id()", None),
}


def star_exports(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Every line item as a row of one of six export files, typed but unchecked.

    One file has too many undated rows; all have some rows for each rule, and
    dates, prices and profits coarse enough for real copies to occur.
    """
    return _view(spark, sf_dir, _EXPORTS, list(columns or _EXPORTS))


# --------------------------------------------------- line-total (Title Case)

_LINE_TOTAL = {
    "Order ID": ("string(l_orderkey)", None),
    "Order Date": ("o_orderdate", "o_orderdate"),
    "Ship Date": ("l_shipdate", None),
    "Customer Name": ("c_name", "c_name"),
    "Segment": ("c_mktsegment", "c_mktsegment"),
    "Region": ("r_name", "r_name"),
    "Category": ("p_type", "p_type"),
    "Product Name": ("p_name", "p_name"),
    "Sales": ("double(floor(l_extendedprice))", None),
    "Quantity": ("l_quantity", None),
    "Discount": ("l_discount", None),
    "Profit": (_PROFIT, None),
}


def star_line_totals(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return _view(spark, sf_dir, _LINE_TOTAL, list(columns or _LINE_TOTAL), ("Sales", "Profit"))
