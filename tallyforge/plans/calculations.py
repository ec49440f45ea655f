"""The extended tables of a cleaned line-total export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.extended import (
    clean_export,
    discount_impact,
    monthly_trend,
    product_performance,
    region_category_pivot,
    region_category_totals,
    top_products,
    underperformers,
)
from ..operators.quality import missing_profile
from ..sinks.tables import write_cleaned_csv
from ..session import configured, shuffles_dropped, stored
from ..sources.line_totals import read_line_totals, scan_cleaned


EXTENDED_TABLES = {
    "Region_Category": region_category_totals,
    "Product_Performance": product_performance,
    "Monthly_Trend": monthly_trend,
    "Underperformers": underperformers,
    "Discount_Impact": discount_impact,
    "Region_by_Category": region_category_pivot,
    "Top_Products": top_products,
}
#: What the tables are made of; no other column is parsed for them.
TABLE_COLUMNS = ["Order ID", "Order Date", "Segment", "Region", "Category", "Product Name", "Sales", "Profit", "Discount %"]


def extended_tables(rows: DataFrame) -> dict[str, DataFrame]:
    return {name: build(rows) for name, build in EXTENDED_TABLES.items()}


def clean_to_csv(spark: SparkSession, source: str, out: str) -> DataFrame:
    """Clean an export, write it, and return its missing values per column."""
    with shuffles_dropped(spark):
        write_cleaned_csv(clean_export(read_line_totals(spark, source), scanned=True), out)
    return missing_profile(scan_cleaned(spark, out))


def write_extended_tables(spark: SparkSession, cleaned: str, out: str, names: list[str] | None = None) -> None:
    """One Parquet table per extended table, or only those named, replaced on every run.

    For several tables the text of their columns is parsed once; each of them then reads its own.
    """
    wanted = [n for n in EXTENDED_TABLES if names is None or n in names]
    with shuffles_dropped(spark):
        rows = scan_cleaned(spark, cleaned)
        if len(wanted) > 1:
            with configured(spark, "spark.sql.parquet.compression.codec", "zstd"):
                rows = stored(rows.select(*[f"`{c}`" for c in rows.columns if c in TABLE_COLUMNS]))
        for name in wanted:
            EXTENDED_TABLES[name](rows).write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")
