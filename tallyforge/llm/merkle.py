"""Merkle manifest of a data set: a tree of leaves for each group, and a tree of the groups' roots.

Where a leaf stands among those of its group follows from bitmaps, not from sorting
the leaves.  The ids of a group are a bitmap kept as its 64-bit words that are not
zero; words are merged by ``bit_or`` in each task before they are shuffled.  A
directory of popcounts says how many ids lie before a word, and the rank of an id is
that count plus the popcount of the lower bits of its word.  Only the words are put in
ranges, and only one sum for each range is added up in order.

Nodes then meet by (group, place div 8) in arrays of eight slots, whose hashes are
the nodes of the next level.  The tree is walked down again with the arrays: a run
hands each of its nodes the steps above it, so the proofs of eight leaves share one
shuffled path.

Ids that occur more than once in a group count in the directory like others; only
their rows are ranked by id and hashes instead of bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import running, spread_join

FAN = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left:string,right:string>>"
#: The word of rows without an id, below those of all longs.
NO_ID = -(1 << 58)


def field(value: str) -> str:
    """SQL of a value as it goes into a leaf: its length in bytes, a colon and itself, or ``-`` for null."""
    text = f"CAST({value} AS STRING)"
    return f"coalesce(concat(CAST(octet_length({text}) AS STRING), ':', {text}), '-')"


def digest(values: Sequence[str]) -> str:
    """SQL of a leaf's hash over the values in order."""
    return f"sha2(concat({', '.join(map(field, values))}), 256)"


def fold(leaf: str, steps: str = "steps") -> str:
    """SQL of the root that a leaf's hash and its steps give."""
    return f"aggregate({steps}, {leaf}, (below, step) -> sha2(concat(step.left, below, step.right), 256))"


def _words(leaves: DataFrame) -> DataFrame:
    """``grp, word, bits, rows, before, total``: the bitmaps and their directory, stored."""
    words = leaves.groupBy("grp", "word").agg(F.expr("coalesce(bit_or(bit), 0L)").alias("bits"), F.count("*").alias("rows"))
    return stored(running(words, ["grp"], ["word"], "rows"))


def placed(leaves: DataFrame) -> DataFrame:
    """Adds ``place``, from 0 by ascending id within ``grp``, and ``total``, the group's rows.

    ``leaves`` is stored and has ``grp`` (not null), ``id``, ``leaf`` and ``found``; null ids come first, rows
    with equal ids are in order of their hashes.
    """
    marked = leaves.selectExpr("*", f"coalesce(shiftright(id, 6), {NO_ID}L) AS word", "shiftleft(1L, CAST(id & 63 AS INT)) AS bit")
    words = _words(marked)
    ranked = spread_join(marked, words.withColumn("uses", F.col("rows")), ["grp", "word"], "uses").drop("bit")
    alone = ranked.where("rows = bit_count(bits)").selectExpr(
        *leaves.columns, "before + bit_count(bits & ~shiftleft(-1L, CAST(id & 63 AS INT))) AS place", "total"
    )
    if words.where("rows <> bit_count(bits)").isEmpty():
        return alone
    # The number spreads equal rows over ranges.
    repeated = stored(ranked.where("rows <> bit_count(bits)").selectExpr(
        *leaves.columns, "word", "before AS lower", "total AS whole", "coalesce(id, 0L) AS known",
        "monotonically_increasing_id() AS number", "1L AS one",
    ))
    ordered = running(repeated, ["grp", "word"], ["known", "leaf", "found", "number"], "one")
    return alone.unionByName(ordered.selectExpr(*leaves.columns, "lower + before AS place", "whole AS total"))


def _raised(nodes: DataFrame) -> list[DataFrame]:
    """The levels of trees as stored tables ``grp, run, nodes, hashes, given``; the last one's runs are the trees' tops.

    ``nodes``: ``grp, place, total, hash, given``.  ``nodes`` counts the level's nodes in
    the tree.  A tree of one node has one run of it, whose hash is not taken again.
    """
    levels = []
    while True:
        slots = F.array_sort(F.collect_list(F.struct("place", "hash", "given")))
        level = stored(
            nodes.groupBy("grp", F.expr(f"place DIV {FAN}").alias("run"))
            .agg(slots.alias("slots"), F.max("total").alias("nodes"))
            .selectExpr("grp", "run", "nodes", "transform(slots, s -> s.hash) AS hashes", "transform(slots, s -> s.given) AS given")
        )
        levels.append(level)
        if (level.agg(F.max("nodes")).first()[0] or 0) <= FAN:
            return levels
        nodes = level.where(f"nodes > {FAN}").selectExpr(
            "grp", "run AS place", f"(nodes + {FAN - 1}) DIV {FAN} AS total", f"{_hash_of_run()} AS hash", "CAST(NULL AS INT) AS given"
        )


def _hash_of_run() -> str:
    return "CASE WHEN nodes = 1 THEN hashes[0] ELSE sha2(array_join(hashes, ''), 256) END"


def _tops(levels: list[DataFrame]) -> DataFrame:
    """``grp, top`` of every tree."""
    found = [level.where(f"nodes <= {FAN}").selectExpr("grp", f"{_hash_of_run()} AS top") for level in levels]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def _descended(levels: list[DataFrame], starts: DataFrame) -> DataFrame:
    """``given, hash, steps`` and the columns of ``starts`` for every leaf; steps are from the leaf up.

    ``starts``: ``grp``, ``above`` (the steps above the tree's top) and columns to hand down.
    """
    handed = [c for c in starts.columns if c not in ("grp", "above")]
    paths = None
    for i in reversed(range(len(levels))):
        level = levels[i]
        here = level.where(f"nodes <= {FAN}").join(starts, "grp")
        if paths is not None:
            here = here.unionByName(level.where(f"nodes > {FAN}").join(paths, ["grp", "run"]))
        # "given" is an array of the same length; only the leaves' is read.
        nodes = here.selectExpr("grp", "run", "nodes", "hashes", "given", "above", *handed, "posexplode(hashes) AS (slot, hash)").selectExpr(
            "grp", f"run * {FAN} + slot AS run", "hash", "given[slot] AS given", *handed,
            f"""CASE WHEN nodes = 1 THEN above ELSE concat(array(struct(
                    array_join(slice(hashes, 1, slot), '') AS left, array_join(slice(hashes, slot + 2, {FAN}), '') AS right)), above) END AS steps""",
        )
        if i == 0:
            return nodes.drop("grp", "run")
        paths = stored(nodes.selectExpr("grp", "run", "steps AS above", *handed))
    raise AssertionError("trees have a level")


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", found: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, steps, found_leaf`` of every row.

    A row's leaf is the SHA-256 (lowercase hex) of its ``columns`` in order, each its
    length in UTF-8 bytes, a colon and its text, or ``-`` if null.  In each ``group``
    the leaves ascend by doc_id; every eight consecutive nodes become their hash until
    one is left, the group's subroot.  Subroots, in order of the group's name (null
    first, by UTF-8 bytes), give the root alike.  ``steps`` has the other nodes of each
    run on the way from leaf to root, those left of it and those right of it.

    ``found`` maps columns to SQL for the values they were found to have later;
    ``found_leaf`` is the hash of these.  ``fold("found_leaf")`` is the root they give.

    A null doc_id comes before all others; rows with equal doc_ids are in order of leaf,
    then found_leaf, and all are leaves, equal rows too.  Texts of any length are read
    whole.  Further columns are not read.  An empty table gives no rows.
    """
    now = [(found or {}).get(c, f"`{c}`") for c in columns]
    leaves = stored(docs.selectExpr(
        f"coalesce(concat('=', CAST(`{group}` AS STRING)), '') AS grp", "CAST(doc_id AS LONG) AS id",
        f"{digest([f'`{c}`' for c in columns])} AS leaf", f"{digest(now)} AS found",
    ))
    levels = _raised(placed(leaves).selectExpr("grp", "place", "total", "leaf AS hash", "struct(id, found) AS given"))
    subroots = running(_tops(levels).selectExpr("'' AS tree", "grp", "top", "1L AS one"), ["tree"], ["grp"], "one")
    above = _raised(subroots.selectExpr("tree AS grp", "before AS place", "total", "top AS hash", "grp AS given"))
    roots = _tops(above).selectExpr("grp", f"CAST(array() AS {STEPS}) AS above", "top AS root")
    starts = stored(_descended(above, roots).selectExpr("given AS grp", "steps AS above", "hash AS subroot", "root"))
    return _descended(levels, starts).selectExpr("given.id AS doc_id", "hash AS leaf", "subroot", "root", "steps", "given.found AS found_leaf")
