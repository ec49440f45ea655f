"""Queries that read back what was written: every section and table with its values, months, places and file order."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators import summaries as S
from ..operators.derive import with_measures
from ..operators.periods import stored_periods
from ..plans.calculations import clean_to_csv, write_extended_tables
from ..plans.report import curated_rows, report_sections
from ..session import shared_dir
from ..sinks.tables import dates_fall, read_section, write_curated, write_quality_report, write_section, write_sections
from ..sources.exports import scan_exports
from ..sources.files import discover_files
from ..sources.star import star_items, table
from ..streaming.incremental import ingest_new_files, stored_issues
from .base import SQL, items_sql, money, periods, query, rate, rounded
from .exports import write_csv
from .extended import _T
from .files import _raw_line_totals, _report_rows
from .quality import checked
from .summaries import _MEASURES, _SUMMARY_ROUNDS, _placed

_SHARES = money("revenue", "profit") | rate("avg_discount", "margin")
_MARKS = ("bar", "is_marked", "shown_name")

# Section -> the query whose SQL its rows must equal, columns that query has not, and digits.
_SECTIONS = {
    "by_category": ("category_summary", _MARKS, _SUMMARY_ROUNDS),
    "by_region": ("region_summary", _MARKS, _SUMMARY_ROUNDS),
    "discounts_by_product": ("top10_marker", ("dq_note",), _SHARES),
    "discounts_by_category": ("discounts_by_category", ("dq_note", "in_top"), _SHARES),
    "discount_bands": ("discount_bands", (), money("gross_sales", "discount_amount", "revenue", "profit") | rate("margin", "avg_order_value")),
    "discount_bands_by_product": ("discount_bands_by_product", (), _SHARES),
    "kpis": ("kpi_rows", (), {}),
    "by_month": ("monthly_summary", (), money("revenue", "profit") | rate("margin")),
    "flags": ("flags", (), {}),
    "flag_lines": ("flag_lines", (), {}),
    "summary": ("summary_bullets", (), {}),
    "headline": ("headline_totals", (), money("revenue", "profit") | rate("margin")),
    "change": ("revenue_change", (), money("revenue", "prior_revenue") | rate("revenue_change")),
}


def _section(name: str, base: str, without: tuple[str, ...], digits: dict[str, int]) -> None:
    @query(f"section_{name}", SQL[base])
    def run(spark, d):
        """The section, written and read back."""
        out = shared_dir(spark)
        current, prior = periods(spark, d)
        write_section(report_sections(_report_rows(spark, d), current, prior)[name], out, name, current)
        return rounded(read_section(spark, out, name, current).drop(*without, "report_period"), **digits)


for _name, _of in _SECTIONS.items():
    _section(_name, *_of)


@query("quality_section_issues", SQL["dq_issue_rollup"])
def quality_issues(spark, d):
    """The issues of the quality report, read back."""
    out, found = shared_dir(spark), checked(spark, d)
    write_quality_report(found.issues, found.halts, out, "2001-11")
    return read_section(spark, out, "issues").select("source_file", "check", "level", "count", "message")


@query("quality_section_halts", SQL["halt_report"])
def quality_halts(spark, d):
    """The halted files of the quality report, read back."""
    out, found = shared_dir(spark), checked(spark, d)
    write_quality_report(found.issues, found.halts, out, "2001-11")
    return read_section(spark, out, "halts").select("source_file", "reason", "message")


@query("failed_run", items_sql("""
    SELECT strftime((SELECT p FROM pri), '%Y-%m') AS report_period, round(sum(rev), 2) AS revenue, true AS failed FROM x WHERE is_pri
"""))
def failed_run(spark, d):
    """A run that stops half-way leaves both sections as the run before wrote them."""
    out = shared_dir(spark)
    current, prior = periods(spark, d)
    rows = star_items(spark, d, *_MEASURES, labels=False)
    write_sections({"headline": S.headline_totals(rows, prior), "again": S.headline_totals(rows, prior)}, out, prior)
    failed = False
    try:
        broken = S.headline_totals(rows, current).withColumn("x", F.raise_error(F.lit("stopped")))
        write_sections({"headline": S.headline_totals(rows, current), "again": broken}, out, current)
    except Exception as stop:
        failed = "stopped" in str(stop)
    found = read_section(spark, out, "headline").join(read_section(spark, out, "again"), ["report_period", "revenue"])
    return rounded(found.select("report_period", "revenue").withColumn("failed", F.lit(failed)), **money("revenue"))


# ---------------------------------------------------------- extended tables

_U = f"""WITH {_T},
    u AS (SELECT DISTINCT "Order Date", "Ship Date", "Region", "Category", "Product Name", "Segment", "Sales", "Discount", "Profit", "Order ID",
                 round_even("Discount" * 100 * 10, 0) / 10 AS "Discount %" FROM t)"""

# Table -> its values as SQL over the cleaned rows, and digits.
_EXTENDED = {
    "Region_Category": ('SELECT "Region", "Category", round(sum("Sales"), 2) AS "Sales" FROM u GROUP BY 1, 2', money("Sales")),
    "Product_Performance": ("""
        SELECT "Product Name", "Region", "Segment", strftime("Order Date", '%Y-%m') AS "Month", round(sum("Sales"), 2) AS "Total_Sales",
               round(coalesce(sum("Profit"), 0), 2) AS "Total_Profit" FROM u GROUP BY 1, 2, 3, 4""", money("Total_Sales", "Total_Profit")),
    "Monthly_Trend": ("""
        SELECT strftime("Order Date", '%Y-%m') AS "Month", round(sum("Sales"), 2) AS "Sales", round(coalesce(sum("Profit"), 0), 2) AS "Profit"
        FROM u GROUP BY 1""", money("Sales", "Profit")),
    "Underperformers": ("""
        SELECT "Category", "Region", round("Profit", 2) AS "Profit" FROM (
          SELECT *, quantile_cont("Profit", 0.1) OVER () AS cut FROM (SELECT "Category", "Region", coalesce(sum("Profit"), 0) AS "Profit" FROM u GROUP BY 1, 2)
        ) WHERE "Profit" < cut""", money("Profit")),
    "Discount_Impact": (
        'SELECT "Discount %", round(avg("Profit"), 6) AS "Avg_Profit", count("Order ID") AS "Orders" FROM u GROUP BY 1', rate("Avg_Profit")),
    "Region_by_Category": ("""
        SELECT "Region", """ + ", ".join(
            f"coalesce(round(sum(\"Sales\") FILTER (WHERE \"Category\" = '{c}'), 2), 0) AS \"{c}\"" for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
        ) + ' FROM u WHERE "Region" IS NOT NULL GROUP BY 1', money("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")),
    "Top_Products": ("""
        SELECT "Product Name", round(sum("Sales"), 2) AS "Sales" FROM u GROUP BY 1 ORDER BY sum("Sales") DESC, "Product Name" LIMIT 10""", money("Sales")),
}


def _extended(name: str, sql: str, digits: dict[str, int]) -> None:
    @query(f"extended_{name.lower()}", f"{_U} {sql}")
    def run(spark, d):
        """The table, written from the cleaned export and read back."""
        base = shared_dir(spark)
        clean_to_csv(spark, _raw_line_totals(spark, d), f"{base}/cleaned")
        write_extended_tables(spark, f"{base}/cleaned", f"{base}/tables", [name])
        return rounded(spark.read.parquet(f"{base}/tables/{name}"), **digits)


for _name, _of in _EXTENDED.items():
    _extended(_name, *_of)


# ------------------------------------------------------- months and places

@query("stored_months", items_sql("""
    SELECT strftime(m, '%Y-%m') AS period, row_number() OVER (ORDER BY m DESC) AS place FROM (SELECT DISTINCT date_trunc('month', date) AS m FROM items)
"""))
def stored_months(spark, d):
    """The months of the curated table from its directories, newest first."""
    store = write_curated(with_measures(star_items(spark, d, *_MEASURES)), shared_dir(spark))
    found = stored_periods(curated_rows(spark, store))
    return spark.createDataFrame([(p, i) for i, p in enumerate(found, 1)], "period string, place long")


@query("curated_file_order", items_sql("SELECT strftime(date, '%Y-%m') AS period, CAST(0 AS BIGINT) AS falls FROM items GROUP BY 1"))
def curated_file_order(spark, d):
    """No row of a curated file is dated before the one above it."""
    store = write_curated(with_measures(star_items(spark, d, *_MEASURES)), shared_dir(spark))
    return dates_fall(spark, store).groupBy("period").agg(F.sum("falls").alias("falls"))


@query("order_by_band_and_product", items_sql("""
    SELECT band, product, row_number() OVER (ORDER BY min(band_ord), avg(discount) DESC, product) AS place FROM x WHERE is_cur GROUP BY band, product
"""))
def order_by_band_and_product(spark, d):
    rows = star_items(spark, d, *_MEASURES, "product")
    return _placed(S.discount_bands_by_product(rows, periods(spark, d)[0]), "band", "product")


@query("listing_order", "SELECT c_mktsegment AS segment, row_number() OVER (ORDER BY c_mktsegment) AS place FROM customer GROUP BY 1")
def listing_order(spark, d):
    """Files are listed in order of their paths: one folder for each market segment."""
    out = shared_dir(spark)
    customers = table(spark, d, "customer")
    customers.repartition("c_mktsegment").write.option("header", True).partitionBy("c_mktsegment").csv(out)
    found = _placed(discover_files(spark, f"{out}/*"), "path")
    segment = F.regexp_extract("path", "c_mktsegment=([^/]*)/", 1).alias("segment")
    return found.groupBy(segment).agg(F.min("place").alias("first")).select("segment", F.row_number().over(Window.orderBy("first")).cast("long").alias("place"))


# ------------------------------------------------- columns of written files

@query("missing_price_files", """
    SELECT l_returnflag AS flag, l_returnflag = 'R' AS halted, CASE WHEN l_returnflag = 'R' THEN 'missing_columns' END AS reason,
           l_returnflag = 'R' AS named, count(*) AS lines FROM lineitem GROUP BY 1
""")
def missing_price_files(spark, d):
    """Exports with and without the price: the latter are halted with a message that names it."""
    rows = star_items(spark, d, "date", "product", "price", "return_flag", labels=False)
    out = shared_dir(spark)
    for flag in ("A", "N", "R"):
        columns = ["date", "product"] + ["price"] * (flag != "R")
        rows.where(f"return_flag = '{flag}'").select("return_flag", *columns).withColumnRenamed("return_flag", "flag").write.mode("append").option("header", True).csv(out)
    halts = scan_exports(spark, out).halts
    lines = spark.read.text(out).selectExpr("_metadata.file_name AS source_file", "split(value, ',')[0] AS flag").where("flag <> 'flag'")
    found = lines.groupBy("source_file", "flag").agg(F.count("*").alias("lines")).join(halts, "source_file", "left")
    return found.groupBy("flag").agg(
        F.every(F.col("reason").isNotNull()).alias("halted"), F.max("reason").alias("reason"),
        F.every(F.coalesce(F.col("message").contains("header named exactly 'price'"), F.lit(False))).alias("named"), F.sum("lines").alias("lines"),
    )


@query("unknown_columns", items_sql("SELECT region, count(*) AS n, round(sum(price), 2) AS price, CAST(0 AS BIGINT) AS seen FROM items GROUP BY region"))
def unknown_columns(spark, d):
    """Columns that mean nothing here are nowhere in the rows that are read."""
    rows = star_items(spark, d, "date", "region", "price", "order_id", labels=False)
    noted = rows.selectExpr("date", "concat('note ', order_id) AS Comment", "region AS `Region `", "'note' AS `Sold by`", "price AS PRICE")
    read = scan_exports(spark, write_csv(noted, shared_dir(spark))).rows
    anywhere = F.concat_ws("|", *[F.col(c).cast("string") for c in read.columns if c not in ("file_path", "source_file", "order_id")])
    found = read.groupBy("region").agg(F.count("*").alias("n"), F.sum("price").alias("price"), F.count_if(anywhere.contains("note")).alias("seen"))
    return rounded(found, price=2)


@query("duplicates_by_batch", """
    SELECT "check", CAST(sum(count) AS BIGINT) AS count FROM (
      SELECT 'cross_file_duplicate' AS "check", count(*) AS count FROM lineitem)
    GROUP BY 1
""")
def duplicates_by_batch(spark, d):
    """The same exports under other names arrive later: every row has one copy beyond the first, counted batch by batch."""
    rows = star_items(spark, d, "date", "order_id", "product", "price", labels=False)
    # The customer makes rows differ, so that all copies are between the files.
    lines = rows.selectExpr("date", "product", "price", "concat_ws('-', order_id, monotonically_increasing_id()) AS customer")
    base, folder = shared_dir(spark), shared_dir(spark)
    write_csv(lines, f"{folder}/first")
    kept = spark.read.option("header", True).csv(f"{folder}/first")
    incoming = f"{base}/in"
    for _ in range(2):
        kept.write.mode("append").option("header", True).csv(incoming)
        ingest_new_files(spark, incoming, f"{base}/table", f"{base}/state")
    found = stored_issues(spark, f"{base}/table").where("check IN ('duplicate', 'cross_file_duplicate')")
    return found.groupBy("check").agg(F.sum("count").alias("count"))

