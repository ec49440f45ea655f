"""Finding export files and reading what must be known before they are parsed.

Delimiter, charset and header differ from file to file, and Spark's CSV reader takes
one delimiter and charset per scan.  ``catalogue`` finds them in two distributed passes
over the text lines, headers first and then lines by their file's delimiter, and keeps
them as a table with one row per file; headers are split in the executors.  The driver sees the paths and which of the few kinds of scan each
needs, as it hands the paths to the readers anyway.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from . import quotes
from ..session import stored
from .quotes import DELIMITERS, by_delimiter, cells_in, opens

# Send these functions to the workers themselves, so that the package need not be installed there.
for _module in (quotes, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

FILE_PATTERN = "*.{csv,tsv,xlsx}"
CATALOGUE = (
    "path string, file_path string, error string, delimiter string, charset string, multiline boolean, header array<string>"
)

# Bytes that have no character in windows-1252.
_UNDEFINED_BYTES = "81|8D|8F|90|9D"
_UNKNOWN_CHARSET = "NOT is_utf8 AND has_undefined_bytes"


def discover_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Export files of a folder: path, name and length, without lock files.

    The content column is never selected, so no file is opened.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", FILE_PATTERN).load(path)
    return (
        files.selectExpr("path", "element_at(split(path, '/'), -1) AS file_name", "length")
        .where("NOT startswith(file_name, '~$')")
        .orderBy("path")
    )


def list_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Paths of the export files, empty ones included; taken from the listing, without a job."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", FILE_PATTERN).load(path).inputFiles()
    found = sorted(p for p in map(plain_path, listed) if not file_name(p).startswith("~$"))
    if not found:
        raise FileNotFoundError(f"No exports ({FILE_PATTERN}) found in {path}.")
    return found


def plain_path(path: str) -> str:
    """A path from a listing or from file metadata, unescaped and in one spelling."""
    return re.sub("^file:/+", "file:/", unquote(path))


def plain(column: str) -> str:
    """The same as SQL text; a plus sign is no escape in a path."""
    return f"regexp_replace(url_decode(replace({column}, '+', '%2B')), '^file:/+', 'file:/')"


def literal_paths(paths: list[str]) -> list[str]:
    """Paths for a reader: characters of a glob pattern stand for themselves."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def file_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Text lines with their file and place in it; the bytes as they are."""
    return spark.read.text(literal_paths(paths)).selectExpr(
        "value AS line",
        "_metadata.file_path AS file_path",
        "_metadata.file_block_start AS block_start",
        "monotonically_increasing_id() AS row_id",
    )


def first_lines(lines: DataFrame) -> DataFrame:
    """One row per file: header line and charset.

    The set of validity flags makes this a hash aggregation: next to the text buffer of
    ``min_by`` alone, Spark would sort all lines first.
    """
    undefined = f"(NOT valid OR length(line) <> octet_length(line)) AND hex(CAST(line AS BINARY)) RLIKE '^(?:..)*?(?:{_UNDEFINED_BYTES})'"
    return lines.sparkSession.sql(
        f"""
        SELECT file_path,
               min_by(CAST(line AS BINARY), struct(block_start, row_id)) AS header,
               NOT array_contains(collect_set(valid), false) AS is_utf8,
               bool_or({undefined}) AS has_undefined_bytes
        FROM (SELECT *, is_valid_utf8(line) AS valid FROM {{lines}} WHERE length(trim(line)) > 0)
        GROUP BY file_path
        """,
        lines=lines,
    )


def widest_lines(lines: DataFrame, delimiters: DataFrame) -> DataFrame:
    """One row per file: the cells of its widest line, and whether a quoted cell runs over a line's end.

    ``delimiters`` has each file's own, so that its lines are not looked through for the others.
    """
    return lines.sparkSession.sql(
        f"""
        SELECT /*+ BROADCAST(d) */ file_path, max({by_delimiter(lambda d: cells_in('line', d))}) AS widest,
               bool_or({by_delimiter(lambda d: opens('line', d))}) AS opened
        FROM {{lines}} JOIN {{delimiters}} d USING (file_path)
        WHERE length(trim(line)) > 0
        GROUP BY file_path
        """,
        lines=lines, delimiters=delimiters,
    )


def catalogue(spark: SparkSession, paths: list[str], facts: Callable[..., tuple] | None = None, schema: str = "") -> DataFrame:
    """One row for each delimited file: how to read it, or why it cannot be read.

    ``path`` is the plain one, ``file_path`` the same as file metadata has it.  ``facts``
    makes further columns, named by ``schema``, of a row's own.
    """
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    lines = read_lines(spark, paths)
    heads = stored(first_lines(lines))

    def sniffed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"file_path": batch["file_path"], "delimiter": [*map(_delimiter, batch["header"], batch["is_utf8"])]})

    delimiters = heads.where(f"NOT ({_UNKNOWN_CHARSET})").mapInPandas(sniffed, "file_path string, delimiter string")
    profile = heads.join(widest_lines(lines, delimiters), "file_path", "left")
    found = spark.sql(
        f"SELECT * FROM {{listed}} LEFT JOIN (SELECT {plain('file_path')} AS path, * FROM {{profile}}) USING (path)",
        listed=listed, profile=profile,
    )
    whole = f"{CATALOGUE}, {schema}" if schema else CATALOGUE

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_file_facts(*row) for row in batch.itertuples(index=False, name=None)]
            yield pd.DataFrame([(*r, *facts(*r)) for r in rows] if facts else rows, columns=column_names(whole))

    return found.mapInPandas(described, whole)


def column_names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _file_facts(path, file_path, header, is_utf8, has_undefined_bytes, widest, opened) -> tuple:
    if file_path is None:
        return path, None, "no columns to parse from file", None, None, None, None
    if not is_utf8 and has_undefined_bytes:
        return path, file_path, "it is neither UTF-8 nor windows-1252 text", None, None, None, None
    line, delimiter = _header_line(header, is_utf8), _delimiter(header, is_utf8)
    names = [h.strip() for h in next(csv.reader([line], delimiter=delimiter))]
    error = None
    if line.count('"') % 2:
        error = "its header has an unclosed quote"
    elif widest > len(names) and not opened:
        error = too_wide(len(names), int(widest))
    return path, file_path, error, delimiter, "UTF-8" if is_utf8 else "windows-1252", bool(opened), names


def _header_line(header: bytes, is_utf8: bool) -> str:
    return bytes(header).decode("utf-8" if is_utf8 else "cp1252").lstrip("\ufeff")


def _delimiter(header: bytes, is_utf8: bool) -> str:
    return sniff_delimiter(_header_line(header, is_utf8))


def too_wide(expected: int | str, seen: int | str) -> str:
    return f"expected {expected} fields in every line, saw {seen}"


def sniff_delimiter(header: str) -> str:
    """The candidate that splits the header into most fields."""
    fields = {d: len(next(csv.reader([header], delimiter=d))) for d in DELIMITERS}
    return max(DELIMITERS, key=lambda d: fields[d])
