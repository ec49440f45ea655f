"""Records of files whose quoted cells hold line breaks, read in splits.

Whether a line begins inside a quoted cell depends on all lines before it.  But a line
can only do four things: leave it as it is, turn it round, or end outside or inside
whatever came before.  So each block of a file is reduced to what it does, and to how
many records begin in it in either case; these few rows, in order, say how every block
begins, and with that each line knows its record.  Lines are shuffled once, by block;
only the pieces of records over several lines are gathered again, and what they make
is stored, as records are looked through before they are parsed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import stored
from .files import read_lines
from .quotes import by_delimiter, opens, stays_open


def _state(begun: str, known: str, value: str) -> str:
    """Inside (1) or outside (0) after lines that were begun in a state."""
    return f"CASE WHEN {known} THEN {value} ELSE {begun} ^ {value} END"


def _after(table: DataFrame, order: str, group: list[str], closed: str, opened: str) -> DataFrame:
    """Adds ``known, value``: what all rows of the group up to this one do together.

    ``closed`` and ``opened`` are the state after the row alone when begun outside or
    inside.  Known means the same in both cases; else value says if the state turns.
    """
    up_to = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        table.withColumn("turns", F.sum(F.expr(f"CASE WHEN {closed} = 1 AND {opened} = 0 THEN 1 ELSE 0 END")).over(up_to))
        .withColumn("set", F.last(F.expr(f"CASE WHEN {closed} = {opened} THEN struct({closed} AS value, turns) END"), True).over(up_to))
        .withColumn("known", F.expr("set IS NOT NULL"))
        .withColumn("value", F.expr("CAST((coalesce(set.value, 0) + turns - coalesce(set.turns, 0)) % 2 AS INT)"))
        .drop("turns", "set")
    )


def _marked_lines(spark: SparkSession, files: DataFrame, paths: list[str]) -> DataFrame:
    """Lines with what they and their block's lines before them do, and the records begun so far in the block, stored.

    ``starts_0`` and ``starts_1`` count records for a block that begins outside or inside.
    """
    block = ["file_path", "block_start"]
    lines = read_lines(spark, paths).join(files.select("file_path", "delimiter"), "file_path")
    alone = lines.selectExpr(
        *block, "row_id", "line", "length(trim(line)) = 0 AS blank",
        f"CAST({by_delimiter(lambda d: opens('line', d))} AS INT) AS closed",
        f"CASE WHEN contains(line, '\"') THEN CAST({by_delimiter(lambda d: stays_open('line', d))} AS INT) ELSE 1 END AS opened",
    )
    whole = _after(alone, "row_id", block, "closed", "opened").drop("closed", "opened")
    order = Window.partitionBy(*block).orderBy("row_id")
    up_to = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = whole.withColumn("before", F.lag(F.struct("known", "value")).over(order))
    for begun in (0, 1):
        starts = f"NOT blank AND ({_inside(str(begun))}) = 0"
        whole = whole.withColumn(f"starts_{begun}", F.sum(F.expr(f"CASE WHEN {starts} THEN 1L ELSE 0L END")).over(up_to))
    return stored(whole)


def _inside(begun: str) -> str:
    """The state at the beginning of a line; a block's first line is begun as the block is."""
    return f"CASE WHEN before IS NULL THEN {begun} ELSE {_state(begun, 'before.known', 'before.value')} END"


def _blocks(marked: DataFrame) -> DataFrame:
    """``file_path, block_start, begun, earlier, ends_open`` of every block, stored: its state and the records begun before it."""
    last = F.max_by(F.struct("known", "value", "starts_0", "starts_1"), "row_id").alias("last")
    blocks = marked.groupBy("file_path", "block_start").agg(last).selectExpr("file_path", "block_start", "last.*")
    alone = blocks.selectExpr(
        "file_path", "block_start", "starts_0", "starts_1",
        f"{_state('0', 'known', 'value')} AS closed", f"{_state('1', 'known', 'value')} AS opened",
    )
    order = Window.partitionBy("file_path").orderBy("block_start")
    after = _after(alone, "block_start", ["file_path"], "closed", "opened")
    # A file begins outside, so a state that only turned is the value itself.
    found = after.withColumn("begun", F.coalesce(F.lag("value").over(order), F.lit(0))).withColumn(
        "starts", F.expr("CASE begun WHEN 0 THEN starts_0 ELSE starts_1 END")
    )
    earlier = F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ends = F.last("value").over(Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return stored(found.select("file_path", "block_start", "begun", F.coalesce(earlier, F.lit(0)).alias("earlier"), (ends == 1).alias("ends_open")))


def quoted_records(spark: SparkSession, files: DataFrame, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """``file_path, number, record`` of the files at ``paths``, and the ``file_path`` of those that end inside a quoted cell.

    Record 1 is the header.  Lines without text are left out unless a cell holds them;
    a line break inside a cell is read as a line feed.  Bytes are as in the file.  Files
    that end inside a cell have no records.
    """
    marked = _marked_lines(spark, files, paths)
    blocks = _blocks(marked)
    placed = marked.join(blocks.where("NOT ends_open"), ["file_path", "block_start"]).selectExpr(
        "file_path", "block_start", "row_id", "line", "blank",
        "earlier + CASE begun WHEN 0 THEN starts_0 ELSE starts_1 END AS number",
        f"{_inside('begun')} AS inside",
        f"{_state('begun', 'known', 'value')} AS ends_inside",
    )
    whole = placed.where("inside = 0 AND ends_inside = 0 AND NOT blank").select("file_path", "number", F.col("line").alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("block_start", "row_id", "line")))
    gathered = placed.where("inside = 1 OR ends_inside = 1").groupBy("file_path", "number").agg(pieces.alias("pieces")).selectExpr(
        "file_path", "number", r"array_join(transform(pieces, p -> p.line), '\n') AS record"
    )
    joined = stored(gathered)
    return whole.unionByName(joined), blocks.where("ends_open").select("file_path").distinct()

