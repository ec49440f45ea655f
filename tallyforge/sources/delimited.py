"""Scans of delimited exports, all cells as text.

There is one scan for each delimiter and charset that occurs, whatever the headers:
a row's cells are an array, and which of them means what is data of the file.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import literal
from ..session import stored
from .files import literal_paths, too_wide
from .quotes import by_delimiter, cells_in
from .records import quoted_records

_C1 = bytes(range(0x80, 0xA0))
_C1_DEFINED = [b for b in _C1 if bytes([b]).decode("cp1252", errors="ignore")]
_C1_READ = "".join(map(chr, _C1_DEFINED))
_C1_MEANT = bytes(_C1_DEFINED).decode("cp1252")

BROKEN = "file_path string, error string"


def cell(i: int) -> str:
    return f"c{i}"


def read_delimited(spark: SparkSession, files: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """``file_path, block_start, row_id, cells`` of all files, a table for each kind of scan, and ``file_path, error`` of files found unreadable meanwhile.

    ``files`` is a stored catalogue without unreadable files, with ``used``, how many
    cells of its rows are wanted.  Cells that a row does not have are null or missing at
    the array's end.  windows-1252 is read as ISO-8859-1, which Spark supports as it is,
    and the 27 characters the two do not share are translated.  Files without line
    breaks in quoted cells are split by the reader; the others by ``quoted_records``.
    """
    kinds: dict[tuple, list[str]] = defaultdict(list)
    used: dict[tuple, int] = defaultdict(int)
    for f in files.select("path", "delimiter", "charset", "multiline", "used").toLocalIterator():
        kind = (f["multiline"],) if f["multiline"] else (False, f["delimiter"], f["charset"])
        kinds[kind].append(f["path"])
        used[kind] = max(used[kind], f["used"])
    parts, broken = [], spark.createDataFrame([], BROKEN)
    for kind, paths in sorted(kinds.items()):
        if kind[0]:
            rows, broken = _read_quoted(spark, files, paths, used[kind])
        else:
            rows = _read_split(spark, kind[1], kind[2], paths, used[kind])
        parts.append(rows)
    return parts, broken


def _read_split(spark: SparkSession, delimiter: str, charset: str, paths: list[str], used: int) -> DataFrame:
    names = [cell(i) for i in range(used)]
    reader = (
        spark.read.schema(_schema(used))
        .option("header", True)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8" if charset == "UTF-8" else "ISO-8859-1")
    )
    return reader.csv(literal_paths(paths)).selectExpr(
        "_metadata.file_path AS file_path",
        "_metadata.file_block_start AS block_start",
        "monotonically_increasing_id() AS row_id",
        f"array({', '.join(_decoded(n) if charset != 'UTF-8' else n for n in names)}) AS cells",
    )


def _read_quoted(spark: SparkSession, files: DataFrame, paths: list[str], used: int) -> tuple[DataFrame, DataFrame]:
    found, unclosed = quoted_records(spark, files, paths)
    facts = files.select("file_path", "delimiter", "charset", F.size("header").alias("width"))
    records = found.where("number > 1").join(facts, "file_path")
    wide = (
        records.selectExpr("file_path", "width", f"{by_delimiter(lambda d: cells_in('record', d))} AS seen")
        .where("seen > width")
        .groupBy("file_path", "width")
        .agg(F.max("seen").alias("seen"))
    )
    message = too_wide("%s", "%s")
    broken = stored(
        unclosed.selectExpr("file_path", "'a quoted cell is not closed at the end of the file' AS error").unionByName(
            wide.selectExpr("file_path", f"format_string({literal(message)}, width, seen) AS error")
        )
    )
    text = f"CASE charset WHEN 'UTF-8' THEN record ELSE {_decoded("decode(CAST(record AS BINARY), 'ISO-8859-1')")} END"

    def parsed(delimiter: str) -> str:
        return f"from_csv(text, {literal(_schema(used))}, map('sep', {literal(delimiter)}, 'quote', '\"', 'escape', '\"'))"

    rows = (
        records.join(broken, "file_path", "left_anti")
        .selectExpr("file_path", "0L AS block_start", "number AS row_id", "delimiter", f"{text} AS text")
        .selectExpr("file_path", "block_start", "row_id", f"{by_delimiter(parsed)} AS csv")
        .selectExpr("file_path", "block_start", "row_id", f"array({', '.join(f'csv.{cell(i)}' for i in range(used))}) AS cells")
    )
    return rows, broken


def _schema(used: int) -> str:
    return ", ".join(f"{cell(i)} STRING" for i in range(used))


def _decoded(text: str) -> str:
    return f"translate({text}, {literal(_C1_READ)}, {literal(_C1_MEANT)})"
