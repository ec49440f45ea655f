"""Writing results: report sections, quality tables, cleaned exports, curated rows."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window, functions as F

from ..sources.line_totals import store_catalogue

# Sections are written at the same time, as most are small and none waits for another.
_AT_ONCE = 4
# Types whose cells hold no line break as text.
_NO_TEXT = ("double", "float", "int", "bigint", "smallint", "tinyint", "boolean", "date", "timestamp", "timestamp_ntz")
COMMIT = "number long, run string, stamp string, sections array<string>"


def _commits(out: str) -> str:
    return f"{out.rstrip('/')}/_commits"


def _directory(out: str, section: str, stamp: str, run: str) -> str:
    return f"{out.rstrip('/')}/{section}/{stamp}/{run}"


def commits(spark: SparkSession, out: str) -> list[Row]:
    """What was written completely, oldest first: a row for each run."""
    try:
        found = spark.read.schema(COMMIT).parquet(_commits(out))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return found.orderBy("number", "run").collect()


def write_sections(sections: dict[str, DataFrame], out: str, stamp: str) -> dict[str, str]:
    """Sections as Parquet tables, each written once to a directory of this run, and then made current together.

    A commit record that names the run is written last.  Until then, and for good if the
    run fails, readers see what the runs before it wrote; afterwards all sections of
    this run.  A table without rows keeps its columns.  Runs of one report follow each
    other; of two at the same time, the one with the larger run id counts as the later.
    """
    if not sections:
        return {}
    spark = next(iter(sections.values())).sparkSession
    run = uuid.uuid4().hex
    paths = {name: _directory(out, name, stamp, run) for name in sections}
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        written = [pool.submit(inheritable_thread_target(spark)(_write_one), table, paths[name], stamp) for name, table in sections.items()]
        for job in written:
            job.result()
    number = max((c["number"] for c in commits(spark, out)), default=0) + 1
    record = spark.createDataFrame([(number, run, stamp, sorted(sections))], COMMIT)
    record.coalesce(1).write.mode("append").parquet(_commits(out))
    return paths


def _write_one(table: DataFrame, path: str, stamp: str) -> None:
    table.withColumn("report_period", F.lit(stamp)).write.parquet(path)


def write_section(table: DataFrame, out: str, section: str, stamp: str) -> str:
    return write_sections({section: table}, out, stamp)[section]


def read_section(spark: SparkSession, out: str, section: str, period: str | None = None) -> DataFrame:
    """The section of the last run that wrote it, or of the last one for a month."""
    return spark.read.parquet(section_paths(spark, out, period)[section])


def section_paths(spark: SparkSession, out: str, period: str | None = None) -> dict[str, str]:
    """Where the current copy of each section is, or that of a month."""
    found = {}
    for c in commits(spark, out):
        if period is None or c["stamp"] == period:
            found |= {name: _directory(out, name, c["stamp"], c["run"]) for name in c["sections"]}
    return found


def drop_superseded(spark: SparkSession, out: str) -> int:
    """Removes the directories of runs that a later run for the same month replaced, and of failed ones; says how many.

    Not while others read or write the report.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(out)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stamps = {c["stamp"] for c in commits(spark, out)}
    current = {tuple(p.rsplit("/", 3)[1:]) for stamp in stamps for p in section_paths(spark, out, stamp).values()}
    dropped = 0
    for section in _folders(files, root):
        for stamp in _folders(files, section):
            for run in _folders(files, stamp):
                if (section.getName(), stamp.getName(), run.getName()) not in current:
                    files.delete(run, True)
                    dropped += 1
    return dropped


def _folders(files, path) -> list:
    return [f.getPath() for f in files.listStatus(path) if f.isDirectory() and not f.getPath().getName().startswith("_")]


def write_cleaned_csv(cleaned: DataFrame, out: str) -> str:
    """The table as CSV files with their catalogue beside them, for which line breaks in cells are looked for on the way."""
    texts = [f"`{c}`" for c, kind in cleaned.dtypes if kind not in _NO_TEXT]
    breaks = " OR ".join(rf"contains({c}, '\n') OR contains({c}, '\r')" for c in texts) or "false"
    seen = Observation()
    watched = cleaned.observe(seen, F.expr(f"bool_or({breaks})").alias("breaks"))
    watched.write.mode("overwrite").option("header", True).option("escape", '"').csv(out)
    store_catalogue(cleaned.sparkSession, out, whole_lines=not seen.get["breaks"])
    return out


def write_curated(rows: DataFrame, out: str) -> str:
    """Line items by month, each file in date order; replaces the whole table.

    A month that is not in ``rows`` is gone afterwards.  Appending by month is what
    the stream of new files is for.  Rebalancing lets Spark split a big month over as many tasks as its size
    needs, and give a small one a single file.
    """
    (
        rows.hint("rebalance", "period")
        .sortWithinPartitions("period", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("period")
        .parquet(out)
    )
    return out


def dates_fall(spark: SparkSession, curated: str) -> DataFrame:
    """``period, file_path, falls``: how often a row of a curated file is dated before the one above it.

    Rows are compared in the order of their place in the file; 0 everywhere is what
    ``write_curated`` promises.
    """
    rows = spark.read.parquet(curated).select("period", "date", "_metadata.file_path", "_metadata.row_index")
    above = F.lag("date").over(Window.partitionBy("file_path").orderBy("row_index"))
    falls = rows.withColumn("falls", F.col("date") < above).groupBy(F.col("period").cast("string").alias("period"), "file_path")
    return falls.agg(F.count_if("falls").alias("falls"))


def quality_sections(issues: DataFrame, halts: DataFrame, reused_ids: DataFrame | None = None) -> dict[str, DataFrame]:
    """Issues, halted files and, one row each, the order ids that a file uses again."""
    sections = {"issues": issues, "halts": halts}
    return sections if reused_ids is None else sections | {"reused_order_ids": reused_ids}


def write_quality_report(
    issues: DataFrame, halts: DataFrame, out: str, stamp: str, reused_ids: DataFrame | None = None
) -> dict[str, str]:
    return write_sections(quality_sections(issues, halts, reused_ids), out, stamp)
