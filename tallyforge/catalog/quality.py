"""Queries of the row and file rules, over six derived exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.duplicates import copy_groups, tag_duplicates, with_copies
from ..operators.labels import append_label, dq_flag
from ..schema import (
    BAD_DATE,
    BAD_QTY_PRICE,
    BUSINESS_COLUMNS,
    DISCOUNT_CLAMPED,
    DUPLICATE,
    LOSS_ROW,
    NO_CATEGORY,
    NO_CUSTOMER,
    NO_REGION,
)
from ..session import shared_dir, stored
from ..sinks.tables import read_section, write_quality_report
from ..sources.star import star_exports, star_items, table
from .base import counted, exports_sql, money, query, rounded, items_sql

def staged_exports(spark, d):
    """The exports as one written table, as a file scan leaves them: they are read several times."""
    return stored(star_exports(spark, d))


def checked(spark, d) -> Q.Checked:
    return Q.validate(staged_exports(spark, d))


def kept_rows(spark, d, staged: bool = False):
    rows = staged_exports(spark, d) if staged else star_exports(spark, d)
    return Q.validate(rows, duplicates=False).rows


def _halts(spark, d):
    return Q.date_halts(Q.file_counts(star_exports(spark, d, "source_file", "date")))


def _accepted(spark, d, *columns):
    return Q.without_halted(star_exports(spark, d, *columns), _halts(spark, d))


@query("dq_bad_date_halt", exports_sql("""
    SELECT source_file, CAST(n_bad AS BIGINT) AS bad_date, CAST(n_rows AS BIGINT) AS n_rows FROM shares
    WHERE source_file NOT IN (SELECT source_file FROM accepted)
"""))
def bad_date_halt(spark, d):
    counts = Q.file_counts(star_exports(spark, d, "source_file", "date"))
    return Q.date_halts(counts).join(counts, "source_file").select("source_file", "bad_date", "n_rows")


def _row_rule(name: str, label: str, condition: str, relation: str):
    """Rows carrying one label, per file."""

    @query(name, exports_sql(
        f"SELECT source_file, count(*) AS row_count FROM {relation} WHERE {condition} GROUP BY source_file"
    ))
    def run(spark, d):
        rows = _accepted(spark, d)
        labelled = rows.withColumn("labels", F.expr(Q.all_labels(rows.columns)))
        return (
            labelled.where(F.array_contains("labels", label))
            .groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"))
        )


_ALL = "(SELECT exports.* FROM exports JOIN accepted USING (source_file))"
_row_rule("dq_bad_date_skip", BAD_DATE, "date IS NULL", _ALL)
_row_rule("dq_invalid_qty_price", BAD_QTY_PRICE, "quantity <= 0 OR price < 0", "dated")
_row_rule("dq_invalid_region", NO_REGION, "trim(region) = ''", "kept")
_row_rule("dq_invalid_category", NO_CATEGORY, "trim(category) = ''", "kept")
_row_rule("dq_invalid_customer", NO_CUSTOMER, "trim(customer) = ''", "kept")
_row_rule("dq_negative_profit", LOSS_ROW, "profit < 0", "kept")


@query("dq_clamp_discount", exports_sql("""
    SELECT source_file, discount, count(*) AS row_count,
           count(*) FILTER (WHERE given_discount < 0 OR given_discount > 1) AS clamped
    FROM kept GROUP BY source_file, discount
"""))
def clamp_discount(spark, d):
    return kept_rows(spark, d).groupBy("source_file", "discount").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.array_contains("dq", DISCOUNT_CLAMPED)).alias("clamped"),
    )


_COPIES = """
    SELECT source_file, {copies} AS copies, count(*) AS row_count FROM tagged WHERE {copies} > 1 GROUP BY 1, 2
"""


def _copies_per_file(rows, keys):
    return (
        with_copies(rows, keys)
        .where(F.col("copies") > 1)
        .groupBy("source_file", "copies").agg(F.count(F.lit(1)).alias("row_count"))
    )


query("dup_copies_in_file", exports_sql(_COPIES.format(copies="file_copies")))(
    lambda spark, d: _copies_per_file(kept_rows(spark, d, staged=True), ["source_file", *BUSINESS_COLUMNS])
)
query("dup_copies_cross_file", exports_sql(_COPIES.format(copies="copies")))(
    lambda spark, d: _copies_per_file(kept_rows(spark, d, staged=True), BUSINESS_COLUMNS)
)


def _tagged(name: str, keys: list[str], condition: str):
    @query(name, exports_sql(
        "SELECT order_id, source_file, product, strftime(date, '%Y-%m') AS period, count(*) AS row_count "
        f"FROM tagged WHERE {condition} GROUP BY 1, 2, 3, 4"
    ))
    def run(spark, d):
        rows = tag_duplicates(kept_rows(spark, d, staged=True), keys).where(F.array_contains("dq", DUPLICATE))
        period = F.date_format(F.to_date("date"), "yyyy-MM").alias("period")
        return rows.groupBy("order_id", "source_file", "product", period).agg(
            F.count(F.lit(1)).alias("row_count")
        )


_tagged("dq_duplicate_in_file", ["source_file", *BUSINESS_COLUMNS], "file_copies > 1")
_tagged("dq_duplicate_cross_file", BUSINESS_COLUMNS, "copies > 1")


@query("dq_order_id_reuse", """
    SELECT source_file, count(*) AS reused, sum(uses) AS line_items, min(order_id) AS first_id, max(order_id) AS last_id
    FROM (SELECT 'export_' || l_returnflag || l_linestatus || '.csv' AS source_file, CAST(l_orderkey AS VARCHAR) AS order_id,
                 count(*) AS uses FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
    GROUP BY source_file
""")
def order_id_reuse(spark, d):
    return Q.order_id_reuse(star_exports(spark, d, "source_file", "order_id")).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("reused"), F.sum("uses").alias("line_items"),
        F.min("order_id").alias("first_id"), F.max("order_id").alias("last_id"),
    )


@query("order_id_issues", """
    SELECT source_file, 'order_id_reuse' AS "check", 'warn' AS level, count(*) AS count,
      count(*) || ' Order_ID(s) reused across different orders in ' || source_file
        || ' -- likely a typo (e.g. a repeated ID that should be the next number in sequence). Rows were kept since '
        || 'their order details differ, but the ID(s) need fixing at the source.' AS message
    FROM (SELECT 'export_' || l_returnflag || l_linestatus || '.csv' AS source_file,
                 CAST(l_orderkey AS VARCHAR) AS order_id FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
    GROUP BY source_file
""")
def order_id_issues(spark, d):
    return Q.order_id_issues(Q.order_id_reuse(star_exports(spark, d, "source_file", "order_id")))


@query("reused_order_ids", """
    SELECT 'export_' || l_returnflag || l_linestatus || '.csv' AS source_file, CAST(l_orderkey AS VARCHAR) AS order_id, count(*) AS uses
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def reused_order_ids(spark, d):
    """Every reused id, as the quality report stores it."""
    out = shared_dir(spark)
    rows = star_exports(spark, d, "source_file", "date", "order_id")
    reused = Q.order_id_reuse(rows)
    write_quality_report(Q.order_id_issues(reused), Q.date_halts(Q.file_counts(rows)), out, "2001-11", reused)
    return read_section(spark, out, "reused_order_ids").select("source_file", "order_id", "uses")


@query("dq_flag_append", exports_sql("""
    SELECT dq_flag, count(*) AS row_count FROM (
      SELECT CASE WHEN copies > 1 THEN concat_ws(';', row_flag, 'flagged:duplicate') ELSE row_flag END AS dq_flag FROM labelled
    ) GROUP BY dq_flag
"""))
def flag_append(spark, d):
    rows = checked(spark, d).rows
    again = append_label("dq", f"array_contains(dq, '{DUPLICATE}')", DUPLICATE)
    return counted(rows, f"{dq_flag(again)} AS dq_flag").withColumnRenamed("n", "row_count")


_ISSUES = """
    found AS (
      SELECT source_file, 'bad_date' AS "check", count(*) FILTER (WHERE date IS NULL) AS count FROM {all} GROUP BY 1
      UNION ALL SELECT source_file, 'invalid_qty_price', count(*) FILTER (WHERE quantity <= 0 OR price < 0) FROM dated GROUP BY 1
      UNION ALL SELECT source_file, 'invalid_region', count(*) FILTER (WHERE trim(region) = '') FROM kept GROUP BY 1
      UNION ALL SELECT source_file, 'invalid_category', count(*) FILTER (WHERE trim(category) = '') FROM kept GROUP BY 1
      UNION ALL SELECT source_file, 'invalid_customer', count(*) FILTER (WHERE trim(customer) = '') FROM kept GROUP BY 1
      UNION ALL SELECT source_file, 'discount', count(*) FILTER (WHERE given_discount < 0 OR given_discount > 1) FROM kept GROUP BY 1
      UNION ALL SELECT source_file, 'negative_profit', count(*) FILTER (WHERE profit < 0) FROM kept GROUP BY 1
      UNION ALL SELECT source_file, 'duplicate', count(*) - count(DISTINCT (date, customer, product, category, region, quantity,
        price, discount, profit, sales_target)) FROM kept GROUP BY 1
      UNION ALL SELECT NULL, 'cross_file_duplicate', count(*) - count(DISTINCT (date, customer, product, category, region, quantity,
        price, discount, profit, sales_target)) FROM kept
    ),
    issues AS (
      SELECT source_file, "check", CASE WHEN "check" IN ('bad_date', 'invalid_qty_price') THEN 'skip' ELSE 'warn' END AS level, count,
        CASE "check"
          WHEN 'bad_date' THEN format('Skipped {{}} row(s) in {{}} — the ''date'' column was blank or unreadable for those rows.', count, source_file)
          WHEN 'invalid_qty_price' THEN format('Skipped {{}} row(s) in {{}} — quantity was zero/negative or price was negative.', count, source_file)
          WHEN 'invalid_region' THEN format('{{}} row(s) have a blank/missing region in {{}}.', count, source_file)
          WHEN 'invalid_category' THEN format('{{}} row(s) have a blank/missing category in {{}}.', count, source_file)
          WHEN 'invalid_customer' THEN format('{{}} row(s) have a blank/missing customer in {{}}.', count, source_file)
          WHEN 'discount' THEN format('Corrected {{}} discount value(s) in {{}} that were outside the valid 0-100% range.', count, source_file)
          WHEN 'negative_profit' THEN format('{{}} row(s) have negative profit in {{}}.', count, source_file)
          WHEN 'duplicate' THEN format('Found {{}} duplicate row(s) within {{}} — not removed.', count, source_file)
          ELSE format('Found {{}} row(s) duplicated across multiple files — check for the same export saved under more than one filename.', count)
        END AS message
      FROM found WHERE count > 0
    )
""".replace("{all}", _ALL).replace("{{", "{").replace("}}", "}")


def issues_sql(statement: str) -> str:
    return f"{exports_sql('')}, {_ISSUES} {statement}"


query("dq_issue_rollup", issues_sql('SELECT source_file, "check", level, count, message FROM issues'))(
    lambda spark, d: checked(spark, d).issues
)

query("union_issues", issues_sql(
    "SELECT level, count(*) AS issues, CAST(sum(count) AS BIGINT) AS row_count FROM issues GROUP BY level"
))(
    lambda spark, d: checked(spark, d).issues.groupBy("level").agg(
        F.count(F.lit(1)).alias("issues"), F.sum("count").alias("row_count")
    )
)

query("dq_banner_totals", issues_sql("""
    SELECT (SELECT count(*) FROM shares) - (SELECT count(*) FROM accepted) AS halts,
           count(*) FILTER (WHERE level = 'warn') AS warnings,
           CAST(coalesce(sum(count) FILTER (WHERE level = 'skip'), 0) AS BIGINT) AS skipped_rows FROM issues
"""))(lambda spark, d: _banner(spark, d))


def _banner(spark, d):
    found = checked(spark, d)
    return Q.banner(found.issues, found.halts)


query("halt_report", exports_sql("""
    SELECT source_file, 'bad_dates' AS reason,
      format('''{}'' can''t be used — {:.0f}% of its rows don''t have a valid date, so this file was skipped entirely. Fix: open the file and check the ''date'' column — make sure it''s named exactly ''date'' and every row has a real date (e.g. 2026-07-15), then run the report again.',
             source_file, CAST(n_bad AS DOUBLE) / n_rows * 100) AS message
    FROM shares WHERE source_file NOT IN (SELECT source_file FROM accepted)
"""))(_halts)

query("halted_file_exclusion", exports_sql(
    f"SELECT source_file, count(*) AS row_count FROM {_ALL} GROUP BY 1"
))(lambda spark, d: _accepted(spark, d, "source_file").groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count")))

query("strict_cross_file", exports_sql("""
    SELECT CAST(coalesce(sum(files - 1), 0) AS BIGINT) AS strict_cross_file FROM (
      SELECT count(DISTINCT source_file) AS files FROM kept
      GROUP BY date, customer, product, category, region, quantity, price, discount, profit, sales_target
      HAVING count(DISTINCT source_file) > 1)
"""))(lambda spark, d: Q.strict_cross_file_copies(Q.file_copies(kept_rows(spark, d, staged=True))))


# ----------------------------------------------------- whole-table profiles

_PROFILED = ["order_id", "profit", "sales_target", "category"]

query("missing_profile", items_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM items" for c in _PROFILED
)))(lambda spark, d: Q.missing_profile(star_items(spark, d, *_PROFILED, labels=False)))

@query("repeated_rows", """
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def repeated_rows(spark, d):
    groups = copy_groups(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])
    return groups.where(F.col("copies") > 1)
