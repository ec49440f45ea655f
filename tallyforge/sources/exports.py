"""Export files of any layout to one checked table of line items."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema
from ..functions import guess_format, to_date
from ..operators import layout
from ..operators.layout import (
    CLEAN,
    UNDERSCORE,
    absent_columns,
    cells_to_line_items,
    map_header,
    missing_message,
    missing_required,
    positions,
)
from ..operators.quality import Checked, order_id_issues, order_id_reuse, validate
from ..schema import LINE_ITEM
from ..session import stored
from .delimited import BROKEN, read_delimited
from .files import CATALOGUE, catalogue, column_names, file_name, list_files
from .workbook import read_workbooks

# Headers are looked at in the workers, which need not have the package.
for _module in (schema, layout, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

ISSUE_SCHEMA = "source_file string, check string, level string, count long, message string, file_path string"
REUSED_SCHEMA = "file_path string, source_file string, order_id string, uses long"


#: What a header says of a file: how its cells are read, or why not, and what is worth a note.
MAPPED = (
    "layout string, at array<int>, absent array<string>, used int, "
    "reason string, message string, repeated int, note string"
)


class Scan(NamedTuple):
    """Typed rows whose dates are still text, and what the files and headers told."""

    rows: DataFrame | None
    halts: DataFrame
    issues: DataFrame


def scan_exports(spark: SparkSession, path: str | list[str]) -> Scan:
    """Read every export under ``path``; unusable files are reported, not raised.

    Headers become a table, one row per file, that the rows are joined with: the plan
    does not grow with the number of different headers.  ``rows`` is None if no file can
    be used.
    """
    paths = list_files(spark, path)
    books = [p for p in paths if p.lower().endswith(".xlsx")]
    texts = [p for p in paths if not p.lower().endswith(".xlsx")]
    found = []
    if texts:
        found.append(catalogue(spark, texts, _header_facts, MAPPED))
    if books:
        # Unzipping is the expensive step and the rows are needed twice: keep them as a table.
        sheets = stored(read_workbooks(spark, books).withColumn("path", F.regexp_replace("path", "^file:/+", "file:/")))
        found.append(_book_headers(spark, sheets, books).mapInPandas(_mapped, f"{CATALOGUE}, {MAPPED}"))
    files = stored(reduce(DataFrame.unionByName, found))
    usable = files.where("reason IS NULL")
    facts = usable.select("file_path", "path", "layout", "at", "absent")
    broken = spark.createDataFrame([], BROKEN)
    items, book_layouts = [], []
    # Each scan is typed in the stage that reads it; there are a few kinds of scan in each layout, whatever the number of files.
    groups = usable.groupBy("layout", F.col("delimiter").isNull().alias("book")).agg(F.min("at").alias("least"), F.max("at").alias("most"))
    for group in groups.orderBy("book", "layout").collect():
        if group["book"]:
            book_layouts.append(group["layout"])
            continue
        parts, unread = read_delimited(spark, usable.where((F.col("layout") == group["layout"]) & F.col("delimiter").isNotNull()))
        broken = broken.unionByName(unread)
        at = group["least"] if group["least"] == group["most"] else None
        items += [cells_to_line_items(p, facts, [group["layout"]], at) for p in parts]
    if book_layouts:
        rows = sheets.where("row_id > 0 AND error IS NULL").selectExpr("path AS file_path", "0L AS block_start", "row_id", "cells")
        items.append(cells_to_line_items(rows, facts, book_layouts))
    late = broken.join(files.select("file_path", "path"), "file_path")
    halts = files.where("reason IS NOT NULL").select("path", "reason", "message").unionByName(
        late.selectExpr("path", "'unreadable' AS reason", f"{_unreadable('error')} AS message")
    )
    issues = usable.where("repeated > 0").join(broken, "file_path", "left_anti")
    name = "element_at(split(path, '/'), -1) AS source_file"
    return Scan(
        None if not items else reduce(DataFrame.unionByName, items),
        halts.selectExpr(name, "reason", "message", "path AS file_path"),
        issues.selectExpr(name, "'repeated_header' AS `check`", "'warn' AS level", "CAST(repeated AS LONG) AS count", "note AS message", "path AS file_path"),
    )


def _unreadable(error: str) -> str:
    return f"concat('\\'', element_at(split(path, '/'), -1), '\\' couldn\\'t be read: ', {error})"


def _book_headers(spark: SparkSession, sheets: DataFrame, books: list[str]) -> DataFrame:
    """The catalogue's columns for workbooks; row 0 is the header, -1 says what failed."""
    heads = sheets.where("row_id <= 0").groupBy("path").agg(F.max("error").alias("error"), F.max_by("cells", "row_id").alias("cells"))
    listed = spark.createDataFrame([(p,) for p in books], "path string")
    whole = listed.join(heads, "path", "left")
    return whole.selectExpr(
        "path", "path AS file_path",
        "CASE WHEN cells IS NULL THEN 'no columns to parse from file' ELSE error END AS error",
        "CAST(NULL AS STRING) AS delimiter", "CAST(NULL AS STRING) AS charset", "false AS multiline",
        "transform(cells, (c, i) -> trim(coalesce(c, concat('unnamed: ', i)))) AS header",
    )


def _mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = column_names(f"{CATALOGUE}, {MAPPED}")
    for batch in batches:
        yield pd.DataFrame([(*row, *_header_facts(*row)) for row in batch.itertuples(index=False, name=None)], columns=names)


def _header_facts(path, file_path, error, delimiter, charset, multiline, header) -> tuple:
    name = file_name(path)
    if error:
        return None, None, None, None, "unreadable", f"'{name}' couldn't be read: {error}", 0, None
    mapping = map_header(list(header))
    missing = missing_required(mapping.columns) if mapping.layout == CLEAN else []
    if missing:
        return None, None, None, None, "missing_columns", missing_message(name, missing), 0, None
    at = positions(mapping)
    twice = ", ".join(sorted(set(mapping.repeated)))
    note = f"{name} has more than one column for: {twice} — the first one was used." if twice else None
    return mapping.layout, at, absent_columns(mapping), max(at) + 1, None, None, len(mapping.repeated), note


def with_dates(rows: DataFrame) -> DataFrame:
    """Read each file's dates with the format of its first date.

    The formats are stored, so Spark knows that they are one small row per file.  The
    plan has only those that occur, of the few dozen known.
    """
    # The set keeps this a hash aggregation; with text buffers alone Spark would sort the rows first.
    first = rows.sparkSession.sql(
        f"""
        SELECT file_path, {guess_format("sample")} AS date_format
        FROM (
            SELECT file_path, min_by(date_text, CASE WHEN date_text IS NOT NULL THEN struct(block_start, row_id) END) AS sample,
                   collect_set(date_text IS NULL) AS undated
            FROM {{rows}} GROUP BY file_path
        )
        WHERE array_contains(undated, false)
        """,
        rows=rows.select("file_path", "date_text", "block_start", "row_id"),
    )
    first = stored(first)
    formats = [r["date_format"] for r in first.select("date_format").distinct().collect()]
    return (
        rows.join(first, "file_path", "left")
        .withColumn("date", F.expr(to_date("date_text", "date_format", formats)))
        .drop("date_text", "date_format", "block_start")
    )


def read_exports(
    spark: SparkSession, path: str | list[str], stage: bool = True, duplicates: bool = True
) -> Checked:
    """Line items, issues, halts and reused order ids of the exports under ``path``.

    The rules need whole-file facts before any row can be kept, so the rows are
    read several times.  With ``stage`` the typed rows are written once as
    Parquet to the shared folder and read from there.
    """
    scan = scan_exports(spark, path)
    if scan.rows is None:
        empty = spark.createDataFrame([], LINE_ITEM).withColumn("dq", F.array().cast("array<string>"))
        return Checked(
            empty.withColumn("row_id", F.lit(0).cast("long")),
            scan.issues,
            scan.halts,
            spark.createDataFrame([], REUSED_SCHEMA),
        )
    dated = with_dates(scan.rows)
    if stage:
        dated = stored(dated)
    checked = validate(dated, duplicates)
    raw_ids = dated.where(F.col("layout") == UNDERSCORE).select(
        "file_path", "source_file", F.col("given_order_id").alias("order_id")
    )
    reused = order_id_reuse(raw_ids).join(checked.halts.select("file_path"), "file_path", "left_anti")
    return Checked(
        checked.rows.drop("given_order_id", "layout", "missing_optional"),
        checked.issues.unionByName(order_id_issues(reused)).unionByName(scan.issues),
        checked.halts.unionByName(scan.halts),
        reused,
    )
