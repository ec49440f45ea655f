"""Copies of a row: counting and marking them without gathering a group.

A window over the business columns would put all copies of a row in one task,
and send every row through a shuffle on ten columns.  Here

1. rows are counted by a 64-bit hash of the columns: eight bytes of each row
   are shuffled, and copies collapse before it;
2. only rows whose hash occurs more than once are grouped by the columns
   themselves, which makes the count exact; Spark knows the size of the stored
   hashes and chooses the join, and if they are many, a bitmap of them keeps most
   other rows out of its shuffle;
3. a hash that belongs to one key only, as nearly all do, stands for the key: rows
   look their count up by those eight bytes in a stored table, and the columns are
   not sent along.  Rows of a hash that several keys share are looked up by the
   columns.  Spark broadcasts the table of hashes if its size allows.  Otherwise a
   hash holding more than 1/10,000 of the copies is looked up in a broadcast of its
   own - there are fewer than 10,000 such hashes by counting alone - and its rows
   are spread over the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schema import BUSINESS_COLUMNS, DUPLICATE
from ..session import stored
from .labels import append_label

# A hot group has more than one part in HOT_GROUPS of all copies.
HOT_GROUPS = 10_000
SPREAD = 4096
# Of more suspects than this, a bitmap keeps other rows out of the shuffle: BITS bits, 32 MB however many rows there are.
FILTER_FROM = 500_000
BITS = 1 << 28


def copy_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per distinct key with its number of rows; NULLs are equal."""
    return rows.groupBy(*keys).agg(F.count("*").alias("copies"))


def repeated_rows(rows: DataFrame, keys: list[str] | None = None, split: list[str] | None = None) -> DataFrame:
    """The keys held by more than one row, with ``copies``, as a stored table.

    ``split`` columns are further group columns: a key is kept if its rows are
    more than one over all of them together.
    """
    keys = keys or BUSINESS_COLUMNS
    groups = _suspect_groups(rows, keys, split or [])
    if not split:
        groups = groups.where("copies > 1")
    return stored(groups.drop("key_hash"))


def _suspect_groups(rows: DataFrame, keys: list[str], split: list[str]) -> DataFrame:
    """``copies`` by hash and key of all rows whose hash is not alone; a key of one row is there if another shares its hash."""
    hashed = rows.select(*keys, *split, _hash(keys).alias("key_hash"))
    suspects = stored(copy_groups(hashed, ["key_hash"]).where("copies > 1").select("key_hash"))
    same = ["key_hash"]
    if suspects.count() > FILTER_FROM:
        # The bucket, found by the bitmap, is a key too: or else Spark would put the semi-join before the bitmap.
        same = ["key_hash", "bucket"]
        suspects = suspects.withColumn("bucket", F.expr(f"bitmap_bucket_number({_BIT})"))
        hashed = _with_bit(hashed, suspects)
    return copy_groups(hashed.join(suspects, same, "left_semi"), [*same, *keys, *split]).select("key_hash", *keys, *split, "copies")


_BIT = f"pmod(key_hash, {BITS}L)"
_PLACE = f"bitmap_bit_position({_BIT})"
_IS_SET = f"shiftright(CAST(conv(hex(substr(bits, CAST({_PLACE} DIV 8 AS INT) + 1, 1)), 16, 10) AS INT), CAST({_PLACE} % 8 AS INT)) & 1 = 1"


def _with_bit(hashed: DataFrame, suspects: DataFrame) -> DataFrame:
    """The rows whose hash has its bit set, with its ``bucket``: all suspects and a few others, which the exact join drops."""
    found = hashed.join(F.broadcast(_bits(suspects)), F.expr(f"bitmap_bucket_number({_BIT}) = bucket"))
    return found.where(_IS_SET).select(*hashed.columns, "bucket")


def _bits(suspects: DataFrame) -> DataFrame:
    """``bucket, bits``: the bitmap of the suspects' hashes."""
    placed = suspects.selectExpr("bucket", f"{_PLACE} AS place")
    return placed.repartition("bucket").groupBy("bucket").agg(F.expr("bitmap_construct_agg(place)").alias("bits"))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """``rows.dropDuplicates()`` for rows that are cheap to read again, as those of a file scan are.

    They are read to count them by a hash of all columns, and to give them out: a row
    whose hash is alone has no copy and is not shuffled.  Only if there are hashes that
    several rows share, they are read once more for the rows of those, which are
    compared by all columns.  The hashes are looked up in a broadcast; of more than
    FILTER_FROM, in a bitmap of fixed size, which takes a few other rows for suspects.
    """
    columns = [f"`{c}`" for c in rows.columns]
    hashed = rows.select(*columns, _hash(columns).alias("key_hash"))
    suspects = stored(copy_groups(hashed.select("key_hash"), ["key_hash"]).where("copies > 1").select("key_hash"))
    found = suspects.count()
    if not found:
        return rows
    if found > FILTER_FROM:
        bits = _bits(suspects.withColumn("bucket", F.expr(f"bitmap_bucket_number({_BIT})")))
        marked = hashed.join(F.broadcast(bits), F.expr(f"bitmap_bucket_number({_BIT}) = bucket"), "left")
        alone, several = marked.where(f"bits IS NULL OR NOT ({_IS_SET})"), marked.where(_IS_SET)
    else:
        alone, several = (hashed.join(F.broadcast(suspects), "key_hash", how) for how in ("left_anti", "left_semi"))
    return alone.select(*columns).unionByName(several.select(*columns).dropDuplicates())


def _hash(keys: list[str]):
    return F.xxhash64(*keys)


def with_copies(
    rows: DataFrame, keys: list[str] | None = None, row_id: str = "row_id", groups: DataFrame | None = None
) -> DataFrame:
    """Add ``copies``: how many rows share this row's key (1 = it is alone).

    ``row_id`` is any value that differs between copies; it only spreads them.
    ``groups`` counts the rows of the repeated keys and of all keys that share a hash
    with another, if that is there already.
    """
    keys = keys or BUSINESS_COLUMNS
    groups = _suspect_groups(rows, keys, []) if groups is None else groups.withColumn("key_hash", _hash(keys))
    hashes = stored(groups.groupBy("key_hash").agg(F.count("*").alias("n_keys"), F.sum("copies").alias("copies")))
    shared = hashes.where("n_keys > 1")
    found = rows.withColumn("key_hash", _hash(keys))
    own = "CAST(NULL AS BIGINT)"
    if not shared.isEmpty():
        several = _renamed(groups.join(F.broadcast(shared), "key_hash", "left_semi"), ["key_hash", *keys], "s")
        found = found.join(F.broadcast(several), _same(["key_hash", *keys], "s"), "left")
        own = "s_copies"
    alone = hashes.where("n_keys = 1")
    threshold = hashes.agg(F.sum("copies") / F.lit(HOT_GROUPS)).scalar()
    hot = _renamed(alone.where(F.col("copies") > threshold), ["key_hash"], "h")
    cold = _renamed(alone.where(F.col("copies") <= threshold), ["key_hash"], "c")
    # The other side of ``spread`` is 0 for every row, but must not be a constant: Spark would
    # take it out of the join keys.
    zero = F.expr("pmod(c_copies, 1L)")
    spread = f"CASE WHEN h_copies IS NULL THEN 0L ELSE pmod(xxhash64({row_id}), {SPREAD - 1}L) + 1 END"
    return (
        found.join(F.broadcast(hot), F.expr("key_hash = h_key_hash"), "left")
        .withColumn("spread", F.expr(spread))
        .join(cold.withColumn("c_spread", zero), F.expr("key_hash = c_key_hash AND spread = c_spread"), "left")
        .selectExpr(*[f"`{c}`" for c in rows.columns], f"coalesce({own}, h_copies, c_copies, 1L) AS copies")
    )


def tag_duplicates(
    rows: DataFrame, keys: list[str] | None = None, row_id: str = "row_id", groups: DataFrame | None = None
) -> DataFrame:
    """Append the duplicate label to ``dq`` on every copy of a repeated row."""
    label = append_label("dq", "copies > 1", DUPLICATE)
    return with_copies(rows, keys, row_id, groups).withColumn("dq", F.expr(label)).drop("copies")


def _renamed(groups: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return groups.selectExpr(*[f"{c} AS {prefix}_{c}" for c in [*keys, "copies"]])


def _same(keys: list[str], prefix: str):
    return F.expr(" AND ".join(f"{k} <=> {prefix}_{k}" for k in keys))
