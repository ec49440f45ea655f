"""Exact duplicates by deterministic block naming.

A text is cut into blocks of fixed size.  The distinct blocks of all texts are put in
order and numbered, so a text is a sequence of integer names.  Adjacent names are
paired and the distinct pairs numbered in turn, until one name is left of each text.
Two texts are equal exactly if they end in the same round with the same name: a name
stands for one string, as blocks are told apart by their bytes and pairs by both names.

Blocks travel once.  Their order is that of a 128-bit print, under which the bytes of
all blocks of the same print are compared while they are made distinct; if two differ,
all blocks are named anew under another print.  From there on rows hold numbers only.

Every naming makes equal keys one before they are shuffled, and names return to the
rows by ``spread_join``, so a block, pair or text that a third of the rows share is not
the work of one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import fresh, lowered, numbered, spread_join, texts

#: Stands for the missing right one of the last pair; names are 0 or more.
NONE = -1


def print_of(column: str, attempt: int) -> tuple[str, str]:
    """SQL of the two halves of a block's print; other attempts give other prints."""
    return f"xxhash64({2 * attempt}L, {column})", f"xxhash64({2 * attempt + 1}L, {column})"


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """``row, pos, n, doc_id, text_sha256, block`` of rows ``(row, doc_id, text)``; id and digest with the first block only."""
    return (
        rows.selectExpr("row", "doc_id", f"CAST({lowered("coalesce(text, '')")} AS BINARY) AS bytes")
        .selectExpr("*", f"CAST(greatest(ceil(octet_length(bytes) / {block}), 1) AS INT) AS n")
        .selectExpr("*", "explode(sequence(0, n - 1)) AS pos")
        .selectExpr(
            "row", "pos", "n",
            "CASE WHEN pos = 0 THEN doc_id END AS doc_id",
            "CASE WHEN pos = 0 THEN sha2(bytes, 256) END AS text_sha256",
            f"substring(bytes, pos * {block} + 1, {block}) AS block",
        )
    )


def _sequences(rows: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """``row, pos, n, name`` of every block, and ``row, doc_id, text_sha256`` of every row."""
    cut = _blocks(rows, block)
    attempt = 0
    while True:
        one, two = print_of("block", attempt)
        printed = cut.selectExpr("*", f"{one} AS one", f"{two} AS two")
        # The blocks themselves are compared here, as part of the key, and are not needed any more.
        distinct = printed.groupBy("one", "two", "block").agg(F.count("*").alias("uses")).drop("block")
        prints = stored(distinct.groupBy("one", "two").agg(F.sum("uses").alias("uses"), F.count("*").alias("blocks")))
        if prints.where("blocks > 1").isEmpty():
            break
        attempt += 1
    names = numbered(prints.drop("blocks"), ["one", "two"])
    placed = stored(printed.drop("block"))
    heads = placed.where("pos = 0").select("row", "doc_id", "text_sha256")
    return stored(spread_join(placed.select("row", "pos", "n", "one", "two"), names, ["one", "two"], "uses").drop("one", "two")), heads


def identities(rows: DataFrame, block: int = 1024) -> DataFrame:
    """``row, doc_id, text_sha256, round, name`` of rows ``(row, doc_id, text)``; (round, name) is equal exactly for equal texts.

    ``row`` differs between rows; it is read in one job only.
    """
    state, heads = _sequences(rows, block)
    longest = state.agg(F.max("n")).first()[0] or 1
    done = state.where("n = 1").selectExpr("row", "0 AS round", "name")
    for round_ in range(1, (longest - 1).bit_length() + 1):
        pairs = stored(
            state.where("n > 1")
            .groupBy("row", F.expr("shiftright(pos, 1)").alias("pos"))
            .agg(
                F.expr("CAST((max(n) + 1) DIV 2 AS INT)").alias("n"),
                F.expr("max(name) FILTER (WHERE pos % 2 = 0)").alias("a"),
                F.expr(f"coalesce(max(name) FILTER (WHERE pos % 2 = 1), {NONE}L)").alias("b"),
            )
        )
        names = numbered(pairs.groupBy("a", "b").agg(F.count("*").alias("uses")), ["a", "b"])
        state = stored(spread_join(pairs, names, ["a", "b"], "uses").drop("a", "b"))
        done = done.unionByName(state.where("n = 1").selectExpr("row", f"{round_} AS round", "name"))
    return heads.join(done, "row")


def _marked(rows: DataFrame, block: int) -> DataFrame:
    named = stored(identities(rows, block))
    groups = stored(
        named.groupBy("round", "name").agg(F.count("*").alias("uses"), F.max(F.struct("doc_id", "row")).alias("top"))
    ).selectExpr("*", "uses AS group_size")
    found = spread_join(named, groups, ["round", "name"], "uses")
    return found.selectExpr("row", "doc_id", "top.doc_id AS keep_id", "group_size", "row = top.row AS kept", "text_sha256")


def exact_duplicates(docs: DataFrame, block: int = 1024) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    Texts are equal if they are after lower-casing A-Z alone; a null text is empty, and
    all empty texts are equal.  Of equal texts the row with the largest doc_id stays, a
    null id being the smallest; of several rows with that id one stays, any of them, as
    they are equal in both.  keep_id is null only if no row of the group has an id.  The
    digest is that of the lower-cased text.  ``block`` is in bytes of UTF-8.  Texts of
    any length are read whole; other columns of the table are not read.  An empty table
    gives no rows.
    """
    return _marked(texts(docs).withColumn("row", F.monotonically_increasing_id()), block).drop("row")


def one_of_each(docs: DataFrame, block: int = 1024) -> DataFrame:
    """The rows that stay, with their own columns; which ones, ``exact_duplicates`` says."""
    row = fresh("row", docs.columns)
    # Written, as the numbers are needed twice and must be the same ones.
    given = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    rows = given.select(F.col(row).alias("row"), given["doc_id"].cast("long").alias("doc_id"), given["text"].cast("string").alias("text"))
    gone = _marked(rows, block).where("NOT kept").select(F.col("row").alias(row))
    return given.join(gone, row, "left_anti").drop(row)

