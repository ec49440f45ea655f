"""The monthly review: every table of it from one table of line items."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.derive import with_measures
from ..operators.flags import flag_lines, flag_rows, summary_bullets, summary_facts
from ..operators.kpis import kpi_rows, kpis
from ..operators.periods import latest_two_stored
from ..operators.quality import Checked, banner
from ..operators.summaries import (
    change_of,
    dimension_summaries,
    discount_analysis,
    discount_bands,
    discount_bands_by_product,
    group_of,
    headline_of,
    monthly_summary,
    with_bar_share,
    with_name_note,
    with_top_marker,
)
from ..session import stored
from ..sinks.tables import quality_sections, write_curated, write_sections
from ..sources.exports import read_exports


def report_sections(rows: DataFrame, current: str | None, prior: str | None, staged: bool = False) -> dict[str, DataFrame]:
    """Section name -> table.  Nothing runs until a section is read or written.

    Seven sections come from the summaries of all dimensions, one row per group.
    With ``staged`` these are computed at once and stored, so that writing the
    sections aggregates them once.
    """
    long = dimension_summaries(rows, current, prior)
    if staged:
        long = stored(long)
    flagged = flag_rows(long)
    return {
        "by_category": with_name_note(with_bar_share(group_of(long, "category")), "category"),
        "by_region": with_name_note(with_bar_share(group_of(long, "region")), "region"),
        "discounts_by_product": with_top_marker(discount_analysis(rows, "product", current), "product"),
        "discounts_by_category": with_top_marker(discount_analysis(rows, "category", current), "category"),
        "discount_bands": discount_bands(rows, current),
        "discount_bands_by_product": discount_bands_by_product(rows, current),
        "kpis": kpi_rows(kpis(rows, current, prior)),
        "by_month": monthly_summary(rows),
        "flags": flagged,
        "flag_lines": flag_lines(flagged),
        "summary": summary_bullets(summary_facts(long), current, prior),
        "headline": headline_of(long),
        "change": change_of(long),
    }


def report_stamp(current: str | None) -> str:
    return current or date.today().isoformat()


def curated_rows(spark: SparkSession, curated: str) -> DataFrame:
    """The curated table; its month stays a directory filter."""
    rows = spark.read.parquet(curated)
    return rows.withColumn("period", F.col("period").cast("string"))


def write_report(spark: SparkSession, source: str | list[str], curated: str, out: str) -> str:
    """Exports -> curated line items by month -> report tables; returns the stamp.

    The report reads the curated table, so it touches two months of it, and the
    monthly table the few columns it needs.
    """
    checked = read_exports(spark, source)
    write_curated(with_measures(checked.rows), curated)
    return write_report_tables(curated_rows(spark, curated), checked, out)


def write_report_tables(rows: DataFrame, checked: Checked, out: str) -> str:
    """All tables of the report over the curated table ``rows``, made current together."""
    current, prior = latest_two_stored(rows)
    stamp = report_stamp(current)
    sections = report_sections(rows, current, prior, staged=True)
    sections |= quality_sections(checked.issues, checked.halts, checked.reused_ids)
    write_sections(sections | {"banner": banner(checked.issues, checked.halts)}, out, stamp)
    return stamp
