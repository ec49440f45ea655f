"""Scans of a line-total export for the extended tables (Title Case columns)."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import literal, null_tokens, to_number
from ..session import stored
from .delimited import read_delimited
from .files import CATALOGUE, FILE_PATTERN, catalogue, list_files

NUMBERS = ["Sales", "Quantity", "Discount", "Profit"]


def read_line_totals(spark: SparkSession, path: str | list[str], files: DataFrame | None = None) -> DataFrame:
    """The raw export with its own headers; numbers typed, dates as text.

    Files may have different headers: each cell goes to the column of its name, and
    columns that a file does not have are null.  If all have one header, a column's place
    is known to the plan, and the scan parses only the cells that are used.  ``files`` is
    the stored catalogue, if it is there already.
    """
    if files is None:
        files = stored(_described(spark, list_files(spark, path)))
    unreadable = {r["path"]: r["error"] for r in files.where("error IS NOT NULL").collect()}
    if unreadable:
        raise ValueError(f"unreadable: {unreadable}")
    parts, broken = read_delimited(spark, files)
    if found := broken.collect():
        raise ValueError(f"unreadable: {dict(map(tuple, found))}")
    # The names are the result's columns, so the driver has them anyway; in order of their place in a header.
    named = files.selectExpr("posexplode(header) AS (at, name)").groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name")
    names = [r["name"] for r in named.collect()]
    least, most = files.agg(F.min("header"), F.max("header")).first()
    same = least == most

    def place(name: str) -> str:
        return str(least.index(name)) if same else f"array_position(header, {literal(name)}) - 1"

    def typed(name: str) -> str:
        return f"{to_number(f'`{name}`') if name in NUMBERS else f'`{name}`'} AS `{name}`"

    headers = files.select("file_path", "header")
    picked = [f"get(cells, {place(n)}) AS `{n}`" for n in names]
    given = [f"{null_tokens(f'`{n}`')} AS `{n}`" for n in names]
    cells = [(p if same else p.join(headers, "file_path")).selectExpr(*picked) for p in parts]
    return reduce(DataFrame.unionByName, [p.selectExpr(*given).selectExpr(*map(typed, names)) for p in cells])


def _described(spark: SparkSession, paths: list[str]) -> DataFrame:
    return catalogue(spark, paths).withColumn("used", F.size("header"))


_FACTS = "error string, delimiter string, charset string, multiline boolean, header array<string>, used int"
_FILES = f"{CATALOGUE}, used int, length long, changed timestamp"


def store_catalogue(spark: SparkSession, path: str, whole_lines: bool = False) -> None:
    """Keeps the catalogue of a folder beside its files, so that they are looked through once and not by every reader.

    ``whole_lines``: one write made all files, with one header, and no cell holds a line
    break.  Then they are all read like the first, and only that one is looked through.
    """
    facts = _written_alike(spark, path) if whole_lines else None
    versions = _versions(spark, path)
    if facts is None:
        files = _described(spark, list_files(spark, path)).join(versions.drop("file_path"), "path")
    else:
        files = versions.crossJoin(F.broadcast(facts))
    files.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/_catalogue")


def _written_alike(spark: SparkSession, path: str) -> DataFrame | None:
    """What the catalogue says of the first file, for all of them; none if a look at one is not enough."""
    facts = _described(spark, list_files(spark, path)[:1]).drop("path", "file_path").first()
    alike = facts["error"] is None and facts["delimiter"] == "," and facts["charset"] == "UTF-8" and not facts["multiline"]
    return spark.createDataFrame([facts], _FACTS) if alike else None


def _versions(spark: SparkSession, path: str) -> DataFrame:
    listed = spark.read.format("binaryFile").option("pathGlobFilter", FILE_PATTERN).load(path)
    return listed.selectExpr(
        "regexp_replace(path, '^file:/+', 'file:/') AS path", "_metadata.file_path AS file_path", "length", "modificationTime AS changed"
    )


def _stored_catalogue(spark: SparkSession, path: str) -> DataFrame | None:
    """The catalogue beside the files, if it is of exactly these files as they are now."""
    try:
        files = spark.read.schema(_FILES).parquet(f"{path.rstrip('/')}/_catalogue")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    key = ["path", "length", "changed"]
    now = _versions(spark, path).withColumn("here", F.lit(True))
    both = files.select(*key).withColumn("known", F.lit(True)).join(now, key, "full")
    return files if both.where("known IS NULL OR here IS NULL").isEmpty() else None


def scan_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``write_cleaned_csv``, typed and with parsed dates."""
    rows = read_line_totals(spark, path, _stored_catalogue(spark, path))
    typed = {
        "Order Date": "CAST(try_to_timestamp(`Order Date`) AS TIMESTAMP_NTZ)",
        "Ship Date": "CAST(try_to_timestamp(`Ship Date`) AS TIMESTAMP_NTZ)",
        "Discount %": to_number("`Discount %`"),
        "Loss_Flag": "try_cast(Loss_Flag AS BOOLEAN)",
    }
    return rows.selectExpr(*[f"{typed.get(c, f'`{c}`')} AS `{c}`" for c in rows.columns])
