"""SimHash near-duplicates: fingerprints, and links by a grid over segment bit counts.

Two fingerprints that differ in d bits have segment bit counts whose Manhattan
distance is at most d.  The fingerprint is cut into groups of segments; with
``max_bits // 3 + 1`` groups, a pair within ``max_bits`` is within distance 2 in
at least one group.  Every fingerprint is put into its own grid cell of a group
and into the cells one step away, so any two points within distance 2 meet in a
cell; a pair is taken from one such cell only.  Pairs that meet are verified on
the bits themselves.

Copies cost nothing: fingerprints are made distinct before they are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .common import LOWER, byte_rows, fresh, small, spread_join, texts
from .components import components


def fingerprint(text: bytes | None, words: int) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 if it has no word."""
    parts = text.translate(LOWER).split() if text else []
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a block at a time: 64 bytes a shingle
        block = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id, fp`` for every row; fp is the fingerprint as a signed long.

    Words are runs without ASCII white space, A-Z lower-cased.  Null and blank
    texts have fingerprint 0.  Rows with a null or repeated id are kept as rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            values = [fingerprint(t, words) for t in byte_rows(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


#: The low bit of each two-bit segment.
LOW = 0x5555555555555555


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _cells(prints: DataFrame, groups: int) -> DataFrame:
    """``fp, part, cell, step``: own cell (step 0) and those one step away, in each group.

    A segment is two bits and its count (0 to 2) takes their place, so the counts
    of a group are one number.
    """
    size = -(-32 // groups)
    counts = f"((fp ^ shiftrightunsigned(fp, 1)) & {LOW}L) | shiftleft(fp & shiftrightunsigned(fp, 1) & {LOW}L, 1)"
    steps = []
    for part in range(groups):
        segments = range(part * size, min(32, (part + 1) * size))
        own = f"(counts & {_signed(sum(3 << (2 * j) for j in segments))}L)"
        steps.append(f"struct({part} AS part, {own} AS cell, 0 AS step)")
        for j in segments:
            count = f"(shiftrightunsigned(counts, {2 * j}) & 3)"
            one, three = _signed(1 << (2 * j)), _signed(3 << (2 * j))  # 0 <-> 1 flips one bit, 1 <-> 2 flips both
            for step, full, half in ((j + 1, 2, 0), (-j - 1, 0, 2)):
                cell = f"{own} ^ CASE WHEN {count} = {half} THEN {one if step > 0 else three}L ELSE {three if step > 0 else one}L END"
                steps.append(f"CASE WHEN {count} <> {full} THEN struct({part} AS part, {cell} AS cell, {step} AS step) END")
    return (
        prints.selectExpr("fp", f"{counts} AS counts")
        .selectExpr("fp", f"explode(array({', '.join(steps)})) AS at")
        .where("at IS NOT NULL")
        .selectExpr("fp", "at.part", "at.cell", "at.step")
    )


def links(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """``a, b`` for distinct fingerprints (column ``fp``) that differ in at most ``max_bits`` bits, a < b.

    Spark takes the cells for no larger than the fingerprints they were exploded from,
    some fifty to one, so it is told to shuffle them: broadcast, they fill the driver.
    """
    if not 0 <= max_bits <= 20:
        raise ValueError("max_bits is 0 to 20")
    cells = _cells(prints, max_bits // 3 + 1)
    return prints.sparkSession.sql(
        f"""SELECT /*+ MERGE(x, y) */ DISTINCT x.fp AS a, y.fp AS b
            FROM {{cells}} x JOIN {{cells}} y
              ON x.part = y.part AND x.cell = y.cell AND x.fp < y.fp
             AND (x.step = 0 OR (y.step <> 0 AND x.step <> y.step AND abs(x.step) <= abs(y.step)))
             AND bit_count(x.fp ^ y.fp) <= {int(max_bits)}""",
        cells=cells,
    )


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """``doc_id, fp, component_id, root`` for every row.

    component_id is the smallest doc_id that can be reached over links of at most
    ``max_bits`` differing bits; null only if no row of the component has an id.  root
    is the component's smallest fingerprint (as a signed number).
    Texts without words share fingerprint 0 and are linked like any others.  An
    empty table gives no rows.  Links are between distinct fingerprints, which
    loses none between rows: copies reach each other through their fingerprint.
    """
    rows = stored(fingerprints(docs, words))
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("uses")))
    roots = stored(components(links(prints, max_bits)))
    named = rows.sparkSession.sql(
        """WITH low AS (SELECT root, min(first_id) AS low_id FROM {roots} JOIN {prints} ON fp = node GROUP BY root),
                linked AS (SELECT node, root, low_id FROM {roots} JOIN low USING (root)),
                linked_prints AS (SELECT * FROM {prints} LEFT JOIN linked ON fp = node)
           SELECT fp, uses, CASE WHEN node IS NULL THEN first_id ELSE low_id END AS component_id, coalesce(root, fp) AS root FROM linked_prints""",
        roots=roots,
        prints=prints,
    )
    return spread_join(rows, stored(named), ["fp"], "uses").select("doc_id", "fp", "component_id", "root")


def one_of_each(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """The documents without near duplicates: of each component one row, one with its smallest doc_id.

    Columns stay.  Of several rows with that id, one with the smallest fingerprint
    stays; of rows equal in both, any one.
    """
    found = stored(near_duplicates(docs, words, max_bits))
    stay = stored(found.where("doc_id <=> component_id").groupBy("root").agg(F.min("fp").alias("stay_fp"), F.first("component_id").alias("stay_id")).drop("root"))
    single = found.where("doc_id <=> component_id").groupBy("root", "fp").count().where("count > 1").isEmpty()
    columns, name = docs.columns, fresh("fp", docs.columns)
    at = columns.index("text")
    rows = docs.withColumn("text", F.col("text").cast("string"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            values = [fingerprint(t, words) for t in byte_rows(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], [*columns, name])

    marked = rows.mapInArrow(mark, T.StructType([*(T.StructField(f.name, f.dataType) for f in rows.schema), T.StructField(name, T.LongType())]))
    kept = marked.join(stay, (marked[name] == stay["stay_fp"]) & marked["doc_id"].cast("long").eqNullSafe(stay["stay_id"]), "left_semi")
    return (kept if single else kept.dropDuplicates(["doc_id", name])).select(*columns)


def hex_of(column: str) -> str:
    """SQL for a long's sixteen hex digits."""
    return f"lpad(lower(hex({column})), 16, '0')"
