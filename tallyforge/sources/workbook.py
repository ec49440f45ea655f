"""Workbook scan: first sheet of each .xlsx file, first row is the header.

Spark has no workbook reader.  A workbook is a zip of XML that can only be read
from its start, so a file is the unit of work: Spark spreads the files over
tasks and each is streamed row by row (a sheet ends at 1,048,576 rows).
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from .files import literal_paths

# Send these functions to the workers themselves, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_SCHEMA = "path string, error string, row_id long, cells array<string>"
_BATCH = 5_000

# Built-in number formats that show a date.
_DATE_FORMAT_IDS = {14, 15, 16, 17, 22, 27, 30, 36, 45, 46, 47, 50, 57}


def read_workbooks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of all workbooks as text cells; row 0 is the header.

    A file that cannot be read gives one row with ``error`` set.
    """
    return workbook_rows(spark.read.format("binaryFile").load(literal_paths(paths)).select("path", "content"))


def workbook_rows(files: DataFrame) -> DataFrame:
    """Rows of workbooks given as ``(path, content)``."""
    return files.mapInPandas(_rows_of_files, ROWS_SCHEMA)


def _rows_of_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows = _guarded(content)
            while chunk := [row for _, row in zip(range(_BATCH), rows)]:
                error, row_id, cells = zip(*chunk)
                yield pd.DataFrame({"path": path, "error": error, "row_id": row_id, "cells": cells})


def _guarded(content: bytes) -> Iterator[tuple]:
    try:
        for i, cells in enumerate(sheet_rows(content)):
            yield None, i, cells
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, ValueError, IndexError) as e:
        yield f"{type(e).__name__}: {e}", -1, []


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Cells of the first sheet, row by row; rows without any value are skipped."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = _shared_strings(book)
        dates = _date_styles(book)
        epoch = _epoch(book)
        moments: dict[str, str] = {}
        with book.open(_first_sheet(book)) as sheet:
            for _, element in ElementTree.iterparse(sheet):
                if _local(element) != "row":
                    continue
                cells: list[str | None] = []
                for c in element:
                    at = _column(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (at - len(cells)) + [_value(c, strings, dates, epoch, moments)]
                element.clear()
                if any(v is not None for v in cells):
                    yield cells


def _local(element) -> str:
    return element.tag.rpartition("}")[2]


def _column(reference: str) -> int:
    """``AB12`` -> 27."""
    at = 0
    for letter in re.match("[A-Z]+", reference).group():
        at = at * 26 + ord(letter) - 64
    return at - 1


def _text(element) -> str:
    return "".join(t.text or "" for t in element.iter() if _local(t) == "t")


def _parsed(book: zipfile.ZipFile, name: str):
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _shared_strings(book) -> list[str]:
    root = _parsed(book, "xl/sharedStrings.xml")
    return [] if root is None else [_text(item) for item in root]


def _epoch(book) -> datetime:
    root = _parsed(book, "xl/workbook.xml")
    old_mac = any(_local(e) == "workbookPr" and e.get("date1904") in ("1", "true") for e in root.iter())
    return datetime(1904, 1, 1) if old_mac else datetime(1899, 12, 30)


def _first_sheet(book) -> str:
    sheet = next(e for e in _parsed(book, "xl/workbook.xml").iter() if _local(e) == "sheet")
    link = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
    for relation in _parsed(book, "xl/_rels/workbook.xml.rels"):
        if relation.get("Id") == link:
            target = relation.get("Target").lstrip("/")
            return target if target.startswith("xl/") else f"xl/{target}"
    raise KeyError("first sheet")


def _date_styles(book) -> set[int]:
    """Cell styles whose number format shows a date."""
    root = _parsed(book, "xl/styles.xml")
    if root is None:
        return set()
    custom = {
        int(e.get("numFmtId")): e.get("formatCode", "") for e in root.iter() if _local(e) == "numFmt"
    }
    shows_date = {
        i for i, code in custom.items()
        if re.search("[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code.lower()))
    }
    formats = next((e for e in root if _local(e) == "cellXfs"), [])
    wanted = shows_date | (_DATE_FORMAT_IDS - custom.keys())
    return {i for i, xf in enumerate(formats) if int(xf.get("numFmtId", 0)) in wanted}


def _value(c, strings, dates, epoch, moments: dict[str, str]) -> str | None:
    kind = c.get("t", "n")
    if kind == "inlineStr":
        return _text(c)
    raw = next((e.text for e in c if _local(e) == "v"), None)
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(raw)]
    if kind == "n" and int(c.get("s", 0)) in dates:
        if raw not in moments:
            moments[raw] = (epoch + timedelta(seconds=round(float(raw) * 86400))).strftime("%Y-%m-%d %H:%M:%S")
        return moments[raw]
    if kind == "n":
        number = float(raw)
        return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)
    return raw
