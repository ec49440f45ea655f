"""Shared pieces of the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored

#: A-Z to a-z on UTF-8 bytes; other letters stay as they are.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


UPPER_LETTERS, LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(column: str) -> str:
    """SQL text: A-Z to a-z; other letters stay as they are."""
    return f"translate({column}, '{UPPER_LETTERS}', '{LOWER_LETTERS}')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of a table, whatever other columns it has."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text: runs without space, tab, line feed, VT, FF or CR."""
    return text.split() if text else []


def byte_rows(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, as Python objects of a whole batch of texts take much memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def cores(spark: SparkSession) -> int:
    """Partitions for work whose cost is not in its bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that no given column has, whatever its case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


#: A key is hot from this part of all rows on; so fewer than PARTS keys are hot.
PARTS = 1000


def spread_join(rows: DataFrame, facts: DataFrame, keys: list[str], count: str) -> DataFrame:
    """``rows`` with the columns of ``facts``, one row for each key; keys are not null.

    ``count`` says how many rows have the key and is left out of the result.  Hot keys
    are looked up in a broadcast of fewer than PARTS rows, so that none of them is the
    work of one task; all others meet in a join that Spark chooses.
    """
    hot = facts.where(F.col(count) > (facts.agg(F.sum(count) / PARTS).first()[0] or 0)).drop(count)
    lean = facts.join(F.broadcast(hot.select(*keys)), keys, "left_anti").drop(count)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(lean, keys))


#: Parts that the rows of a hot key are dealt to.
SALTS = 64


def salted_join(rows: DataFrame, facts: DataFrame, keys: list[str], count: str) -> DataFrame:
    """The same as ``spread_join`` for keys of any size: of keys, only the hashes of hot ones are broadcast.

    The rows of a hot key are dealt to SALTS parts by a hash of the whole row, and each
    part gets a copy of its one row of facts.  Both sides tell a hot key by its hash, so
    a key that shares it is only dealt out, too.
    """
    least = facts.agg(F.sum(count) / PARTS).first()[0] or 0
    hashed = F.xxhash64(*keys)
    hot = F.broadcast(facts.where(F.col(count) > least).select(hashed.alias("hot_key")).distinct())

    def dealt(table: DataFrame, salt: str) -> DataFrame:
        return table.join(hot, hashed == F.col("hot_key"), "left").withColumn("salt", F.expr(salt)).drop("hot_key")

    row = ", ".join(f"`{c}`" for c in rows.columns)
    many = dealt(rows, f"CASE WHEN hot_key IS NULL THEN -1 ELSE CAST(pmod(xxhash64('salt', {row}), {SALTS}) AS INT) END")
    one = dealt(facts.drop(count), f"explode(CASE WHEN hot_key IS NULL THEN array(-1) ELSE sequence(0, {SALTS - 1}) END)")
    return many.join(one, [*keys, "salt"]).drop("salt")


def numbered(keys: DataFrame, order: list[str], name: str = "name") -> DataFrame:
    """A stored table with a number for each row, ascending by ``order``, with gaps; sorted in ranges."""
    return stored(keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()))


def running(table: DataFrame, group: list[str], order: list[str], count: str) -> DataFrame:
    """The table with ``before``, the sum of ``count`` over the smaller rows of the group, and ``total``, that of the group.

    ``group`` and ``order`` are not null and together differ between rows.  The rows are
    dealt out by ranges of both, so that a large group is the work of many tasks; only
    one sum for each range and group is added up in order.
    """
    spread = stored(table.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()))
    sums = spread.groupBy(*group, "part").agg(F.sum(count).alias("sum"))
    all_of, up_to = Window.partitionBy(*group), Window.partitionBy(*group).orderBy("part")
    sums = stored(sums.select(*group, "part", (F.sum("sum").over(up_to) - F.col("sum")).alias("earlier"), F.sum("sum").over(all_of).alias("total")))
    own = F.sum(count).over(Window.partitionBy(*group, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return (
        spread.withColumn("own", F.coalesce(own, F.lit(0)))
        .join(sums, [*group, "part"])
        .withColumn("before", F.col("earlier") + F.col("own"))
        .drop("part", "own", "earlier")
    )
