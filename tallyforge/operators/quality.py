"""Row and file quality rules.

Each rule looks at the rows the earlier rules kept, so the rules are written as
nested conditions and every count of a file comes from one pass over its rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..functions import literal, strip
from ..schema import (
    BAD_DATE,
    BAD_QTY_PRICE,
    BUSINESS_COLUMNS,
    DATE_HALT_FRACTION,
    DISCOUNT_CLAMPED,
    ISSUE_MESSAGES,
    LOSS_ROW,
    NO_CATEGORY,
    NO_CUSTOMER,
    NO_REGION,
    TOO_MANY_BAD_DATES,
)
from ..session import stored
from .duplicates import copy_groups, repeated_rows, tag_duplicates
from .labels import NO_LABELS


class Checked(NamedTuple):
    """Kept rows, and what was found on the way; ``reused_ids`` are the order ids that a file uses again."""

    rows: DataFrame
    issues: DataFrame
    halts: DataFrame
    reused_ids: DataFrame | None = None


def file_key(table: DataFrame) -> list[str]:
    """What tells files apart: the path.  Rows that did not come from files may have a name only."""
    return [c for c in ("file_path", "source_file") if c in table.columns]


# ---------------------------------------------------- conditions, as SQL text

BAD_DATE_ROW = "date IS NULL"
BAD_QTY_PRICE_ROW = "(coalesce(quantity <= 0, false) OR coalesce(price < 0, false))"
KEPT_ROW = "(date IS NOT NULL AND (quantity > 0 OR quantity IS NULL) AND (price >= 0 OR price IS NULL))"
CLAMPED_DISCOUNT = "CASE WHEN discount < 0 THEN 0D WHEN discount > 1 THEN 1D ELSE discount END"


def blank(column: str) -> str:
    return strip(f"coalesce({column}, '')") + " = ''"


# check -> (column it looks at, condition, label), in rule order
_ROW_RULES = {
    "invalid_region": ("region", blank("region"), NO_REGION),
    "invalid_category": ("category", blank("category"), NO_CATEGORY),
    "invalid_customer": ("customer", blank("customer"), NO_CUSTOMER),
    "discount": ("discount", "coalesce(discount < 0 OR discount > 1, false)", DISCOUNT_CLAMPED),
    "negative_profit": ("profit", "coalesce(profit < 0, false)", LOSS_ROW),
}


def row_rules(columns: list[str]) -> list[tuple[str, str, str]]:
    """(check, condition, label) for the columns the rows have.

    A column that the row's file did not carry (``missing_optional``) holds a
    default: its rule is off.
    """

    def active(column: str, condition: str) -> str:
        if "missing_optional" not in columns or column == "discount":
            return f"({condition})"
        return f"({condition} AND NOT array_contains(missing_optional, '{column}'))"

    return [
        (check, active(column, condition), label)
        for check, (column, condition, label) in _ROW_RULES.items()
        if column in columns
    ]


def row_labels(columns: list[str]) -> str:
    """The labels of one kept row, in rule order, as an array.

    Concatenated arrays stay in generated code; dropping NULLs from one array
    would not.
    """
    parts = [
        f"CASE WHEN {condition} THEN array({literal(label)}) ELSE {NO_LABELS} END"
        for _, condition, label in row_rules(columns)
    ]
    return f"concat({', '.join([NO_LABELS, *parts])})"


def all_labels(columns: list[str]) -> str:
    """Labels of a row not filtered yet: a dropped row has the one that dropped it."""
    return (
        f"CASE WHEN {BAD_DATE_ROW} THEN array({literal(BAD_DATE)}) "
        f"WHEN {BAD_QTY_PRICE_ROW} THEN array({literal(BAD_QTY_PRICE)}) ELSE {row_labels(columns)} END"
    )


# --------------------------------------------------------------- file rules

def file_counts(rows: DataFrame) -> DataFrame:
    """One row per file: every count the rules need, from a single pass.

    Only the rules of columns the rows have are counted; dates are enough to
    tell the rejected files.
    """
    key = ", ".join(file_key(rows))
    counts = [f"count_if({BAD_DATE_ROW}) AS bad_date"]
    if {"quantity", "price"} <= set(rows.columns):
        counts.append(f"count_if(date IS NOT NULL AND {BAD_QTY_PRICE_ROW}) AS invalid_qty_price")
        counts += [f"count_if({KEPT_ROW} AND {cond}) AS {check}" for check, cond, _ in row_rules(rows.columns)]
    return rows.sparkSession.sql(
        f"SELECT {key}, count(*) AS n_rows, {', '.join(counts)} FROM {{rows}} GROUP BY {key}",
        rows=rows,
    )


_TOO_MANY_BAD_DATES = f"bad_date / n_rows > {DATE_HALT_FRACTION}D"


def date_halts(counts: DataFrame) -> DataFrame:
    """Files with too many unreadable dates, with the message for each."""
    share = "int(rint(bad_date / n_rows * 100))"
    return counts.where(_TOO_MANY_BAD_DATES).selectExpr(
        "source_file",
        "'bad_dates' AS reason",
        f"format_string({literal(TOO_MANY_BAD_DATES)}, {share}, source_file) AS message",
        *file_key(counts)[:-1],
    )


def without_halted(rows: DataFrame, halts: DataFrame) -> DataFrame:
    """Rows of the files that were not rejected."""
    key = file_key(rows)[0]
    return rows.join(halts.select(key), key, "left_anti")


def usable(rows: DataFrame) -> DataFrame:
    """Drop undated rows and rows with impossible quantity or price."""
    rules = {
        "date": "date IS NOT NULL",
        "quantity": "(quantity > 0 OR quantity IS NULL)",
        "price": "(price >= 0 OR price IS NULL)",
    }
    return rows.where(" AND ".join(rule for c, rule in rules.items() if c in rows.columns) or "true")


def flagged(rows: DataFrame) -> DataFrame:
    """Label the kept rows in ``dq`` and clamp their discount."""
    columns = [
        f"{CLAMPED_DISCOUNT} AS discount" if c == "discount" else f"`{c}`" for c in rows.columns
    ]
    return rows.selectExpr(*columns, f"{row_labels(rows.columns)} AS dq")


# ------------------------------------------------------------------- issues

def issue_rows(counts: DataFrame, checks: list[str]) -> DataFrame:
    """One row per file and check that found something."""
    entries = ", ".join(
        f"{literal(c)}, {literal(ISSUE_MESSAGES[c][0])}, {c}, "
        f"format_string({literal(ISSUE_MESSAGES[c][1])}, {c}, source_file)"
        for c in checks
    )
    return counts.selectExpr(
        "source_file", f"stack({len(checks)}, {entries}) AS (check, level, count, message)", *file_key(counts)[:-1]
    ).where("count > 0")


def duplicate_issues(file_copies: DataFrame) -> DataFrame:
    """Copies beyond the first: per file, and over all files (source_file NULL).

    ``file_copies`` counts the repeated rows per file and key.
    """
    key = file_key(file_copies)
    per_file = file_copies.groupBy(*key).agg(F.sum(F.expr("copies - 1")).alias("duplicate"))
    overall = copies_over_files(file_copies).agg(F.sum(F.expr("copies - 1")).alias("cross_file_duplicate"))
    return issue_rows(per_file, ["duplicate"]).unionByName(
        issue_rows(overall.selectExpr(*[f"CAST(NULL AS STRING) AS {c}" for c in key], "*"), ["cross_file_duplicate"])
    )


def file_copies(kept: DataFrame) -> DataFrame:
    """Repeated rows with their number of copies in each file."""
    return repeated_rows(kept, split=file_key(kept))


def copies_over_files(per_file: DataFrame) -> DataFrame:
    return _totals(per_file).where("copies > 1")


def _totals(per_file: DataFrame) -> DataFrame:
    return per_file.groupBy(*BUSINESS_COLUMNS).agg(F.sum("copies").alias("copies"))


def strict_cross_file_copies(per_file: DataFrame) -> DataFrame:
    """Rows whose copy sits in another file, counted without in-file copies."""
    return (
        copy_groups(per_file, BUSINESS_COLUMNS)
        .where("copies > 1")
        .agg(F.expr("coalesce(sum(copies - 1), 0L)").alias("strict_cross_file"))
    )


def order_id_reuse(rows: DataFrame) -> DataFrame:
    """Ids used more than once within a file, before any row is dropped."""
    key = ", ".join(file_key(rows))
    return rows.sparkSession.sql(
        f"""
        SELECT {key}, order_id, count(*) AS uses FROM {{rows}} WHERE order_id IS NOT NULL
        GROUP BY {key}, order_id HAVING count(*) > 1
        """,
        rows=rows,
    )


def order_id_issues(reused: DataFrame) -> DataFrame:
    """One issue per file with reused ids, from ``order_id_reuse``, whose rows name every id."""
    counts = reused.groupBy(*file_key(reused)).agg(F.count("*").alias("order_id_reuse"))
    return issue_rows(counts, ["order_id_reuse"])


def banner(issues: DataFrame, halts: DataFrame) -> DataFrame:
    """Totals of the quality banner, one row."""
    return issues.sparkSession.sql(
        """
        SELECT count_if(level = 'halt') AS halts, count_if(level = 'warn') AS warnings,
               coalesce(sum(CASE WHEN level = 'skip' THEN count END), 0L) AS skipped_rows
        FROM (SELECT level, count FROM {issues} UNION ALL SELECT 'halt', 1L FROM {halts})
        """,
        issues=issues,
        halts=halts,
    )


def missing_profile(rows: DataFrame) -> DataFrame:
    """Missing values per column, in one pass."""
    counts = rows.selectExpr(*[f"count_if(`{c}` IS NULL) AS `{c}`" for c in rows.columns])
    pairs = ", ".join(f"{literal(c)}, `{c}`" for c in rows.columns)
    return counts.selectExpr(f"stack({len(rows.columns)}, {pairs}) AS (column, missing)")


# -------------------------------------------------------------------- whole

def validate(rows: DataFrame, duplicates: bool = True) -> Checked:
    """All rules over typed line items of any number of files.

    The counts per file and, with ``duplicates``, the repeated rows are stored at
    once, as every result needs them; the rest runs when a result is used.
    """
    counts = stored(file_counts(rows))
    halts = date_halts(counts)
    accepted = counts.where(f"NOT ({_TOO_MANY_BAD_DATES})")
    checks = ["bad_date", "invalid_qty_price", *[check for check, _, _ in row_rules(rows.columns)]]
    issues = issue_rows(accepted, checks)
    kept = flagged(usable(without_halted(rows, halts)))
    if duplicates:
        per_file = file_copies(kept)
        issues = issues.unionByName(duplicate_issues(per_file))
        kept = tag_duplicates(kept, groups=_totals(per_file))
    return Checked(kept, issues, halts)
