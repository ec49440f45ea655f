"""Language identification by the nearest of several centroids per language.

A text is the TF-IDF vector of its letter n-grams (1 to 3, in lower case, anything
else a gap), hashed to a fixed number of dimensions and scaled to length one.  Each
language's sample is clustered on the sphere; a text gets the language of the
centroid with the highest cosine.  It is rejected if it has no letter, or if that
cosine is below the limit of the language for texts of its length: a low quantile of
what texts and pieces of texts of that length in that language reach.  Short texts
reach less, so their limits are looser.

Document frequencies and limits count all training rows.  The clusters are fitted on at
most ``sample`` rows of each language, those with the smallest hash of their id.  What
is sent to every task has a fixed size for each language.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .common import fresh, small

#: Hashed n-gram dimensions.
DIMENSIONS = 1 << 13
UNKNOWN = "und"
#: Classes of length: n-gram occurrences from one power of two up to the next.
LENGTHS = 32
#: Cells of a histogram of cosines from 0 to 1.
CELLS = 1024
#: Characters that are looked at in one go.
BLOCK = 1 << 20


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str | None) -> np.ndarray | None:
    """How often each hashed n-gram occurs; None for a text without letters."""
    counts = None
    for at in range(0, len(text or ""), BLOCK):
        points = np.frombuffer(text[at : at + BLOCK].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[points]
        if not letter.any():
            continue
        points = np.where(letter, points, np.uint32(32))
        points = np.concatenate([[np.uint32(32)], points[letter | np.append(False, letter[:-1])], [np.uint32(32)]]).astype(np.uint32)
        two = points[:-1] * np.uint32(0x01000193) + points[1:]
        three = two[:-1] * np.uint32(0x01000193) + points[2:]
        shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
        spread = np.uint32(0x9E3779B1)
        found = np.concatenate([(x * spread + np.uint32(n)) * np.uint32(0x85EBCA6B) >> shift for n, x in enumerate((points, two, three))])
        some = np.bincount(found.astype(np.int64), minlength=DIMENSIONS)
        counts = some if counts is None else counts + some
    return counts


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dimensions and values of a TF-IDF vector of length one."""
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    return at, values / np.sqrt(values @ values)


def length_class(counts: np.ndarray) -> int:
    return min(int(counts.sum()).bit_length(), LENGTHS) - 1


def pieces(text: str) -> Iterator[str]:
    """The text, and a shorter piece for each class of length, at a place its hash chooses and from the start of a word if one is near."""
    yield text
    rnd = random.Random(crc32(text.encode("utf-8", "surrogatepass")))
    for k in range(1, LENGTHS):
        size = int(2**k * (1 + rnd.random()) / 3)  # a letter is in three n-grams
        if 2 * size > len(text):
            return
        if size:
            at = rnd.randrange(len(text) - size + 1)
            gap = text.find(" ", at, at + 64)
            at = gap + 1 if 0 <= gap < len(text) - size else at
            yield text[at : at + size]


def low_limits(seen: np.ndarray, share: float, slack: float, least: int = 100) -> np.ndarray:
    """Limits by language and class of length, from histograms of cosines (language, class, cell).

    A limit is ``slack`` times the cosine that all but ``share`` of the values and one
    more reach, so no single row sets it.  With fewer than ``least`` values the class of all
    languages counts, and with fewer in that, the limit of the class below.
    """

    def low(cells: np.ndarray) -> float:
        n = int(cells.sum())
        return slack * int(np.searchsorted(np.cumsum(cells), min(n, 2 + int(share * n)))) / CELLS if n else 0.0

    pooled = seen.sum(axis=0)
    limits = np.zeros(seen.shape[:2])
    for i in range(len(seen)):
        last = low(pooled.sum(axis=0))
        for k in range(LENGTHS):
            cells = seen[i, k] if seen[i, k].sum() >= least else pooled[k]
            last = limits[i, k] = low(cells) if cells.sum() >= least else last
    return limits


def centroids(rows: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means of unit rows: seeds are the row nearest the mean, then the farthest from all seeds."""
    seeds = [int((rows @ rows.mean(axis=0)).argmax())]
    best = rows @ rows[seeds[0]]
    while len(seeds) < min(clusters, len(rows)) and best.min() < 1 - 1e-6:
        seeds.append(int(best.argmin()))
        best = np.maximum(best, rows @ rows[seeds[-1]])
    centres = rows[seeds]
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        sums = np.stack([rows[own == i].sum(axis=0) if (own == i).any() else centres[i] for i in range(len(centres))])
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centres


class Model:
    def __init__(self, idf: np.ndarray, languages: list[str], centres: np.ndarray, limits: np.ndarray):
        self.idf, self.languages, self.centres, self.limits = idf, languages, centres, limits

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine (0 to 1), whether it is rejected."""
        counts = grams(text)
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, True
        at, values = vector(counts, self.idf)
        cosines = self.centres[:, at] @ values
        i = int(cosines.argmax())
        return self.languages[i], float(min(1.0, max(0.0, cosines[i]))), bool(cosines[i] < self.limits[i, length_class(counts)])


def fit(docs: DataFrame, folds: int = 4, fold: int = 2, clusters: int = 4, sample: int = 1000, share: float = 0.001, slack: float = 0.8) -> Model:
    """A model from ``text`` and ``lang`` of rows whose crc32(doc_id as text) modulo ``folds`` is not ``fold``.

    Rows without a language or a letter are not learned from, nor rows without an id
    sampled.  The rejection limits of a language come from the cosines of all its
    training rows, whole and in pieces, with its nearest centroid (see ``low_limits``).
    Without training rows the model knows none.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"))
    rows = rows.where(f"lang IS NOT NULL AND crc32(CAST(coalesce(CAST(doc_id AS string), '') AS binary)) % {folds} <> {fold}")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in small(batches):
            for text in batch.column(0).to_pylist():
                counts = grams(text)
                if counts is not None:
                    total += counts > 0
                    n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at], pa.int32()), pa.array([n, *total[at]], pa.int64())], ["at", "n"])

    found = dict(rows.select("text").mapInArrow(frequencies, "at int, n long").groupBy("at").agg(F.sum("n")).collect())
    seen = np.array([found.get(i, 0) for i in range(DIMENSIONS)], dtype=float)
    idf = np.log((1 + found.get(-1, 0)) / (1 + seen)) + 1

    # Rows equal in id, language and text count once, so a sample has at most ``sample`` rows, however often one repeats.
    key, order = ["doc_id", "lang", "of"], Window.partitionBy("lang").orderBy("at", "doc_id", "of")
    hashed = rows.where("doc_id IS NOT NULL").withColumn("of", F.xxhash64("text"))
    few = stored(
        hashed.select(*key).distinct()
        .withColumn("at", F.xxhash64("doc_id"))
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= sample)
        .select(*key)
    )

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        own = []
        for text in group.sort_values(["doc_id", "of"])["text"]:
            counts = grams(text)
            if counts is not None:
                at, values = vector(counts, idf)
                full = np.zeros(DIMENSIONS, np.float32)
                full[at] = values
                own.append(full)
        if not own:
            return pd.DataFrame(columns=["lang", "centre"], dtype=object)
        points = np.stack(own)
        centres = centroids(points, clusters)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centre": [c.astype("<f4").tobytes() for c in centres]})

    learned = hashed.join(few, key, "left_semi").dropDuplicates(key).groupBy("lang").applyInPandas(cluster, "lang string, centre binary").collect()
    learned.sort(key=lambda r: (r["lang"], r["centre"]))
    centres = np.stack([np.frombuffer(r["centre"], "<f4") for r in learned]).astype(float) if learned else np.zeros((0, DIMENSIONS))
    languages = [r["lang"] for r in learned]
    names = sorted(set(languages))
    sent = docs.sparkSession.sparkContext.broadcast({n: centres[[i for i, m in enumerate(languages) if m == n]] for n in names})

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = sent.value, {}
        for batch in small(batches):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for piece in pieces(text) if text and lang in own else ():
                    counts = grams(piece)
                    if counts is not None:
                        at, values = vector(counts, idf)
                        cell = min(CELLS - 1, max(0, int(CELLS * (own[lang][:, at] @ values).max())))
                        key = lang, length_class(counts) * CELLS + cell
                        seen[key] = seen.get(key, 0) + 1
        made = [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(made, ["lang", "at", "n"])

    seen = np.zeros((len(names), LENGTHS * CELLS), np.int64)
    for lang, at, n in rows.select("text", "lang").mapInArrow(reached, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n")).collect() if names else ():
        seen[names.index(lang), at] = n
    limits = low_limits(seen.reshape(-1, LENGTHS, CELLS), share, slack)
    return Model(idf, languages, centres, limits[[names.index(n) for n in languages]])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``lang_pred``, ``score`` and ``rejected``; only ``text`` is looked at.

    Null texts and texts without a letter are ``und`` with score 0 and rejected.  Of
    centroids that are equally near the first one counts, in order of language.  A text
    has the same answer in every row, so rows may repeat; texts are read whole.  All
    rows and columns stay; given columns of the added names are replaced.  An empty
    table gives no rows.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns, hidden = docs.columns, fresh("letters_of", docs.columns)
    rows = docs.withColumn(hidden, F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in small(batches):
            answers = [known.predict(text) for text in batch.column(len(columns)).to_pylist()]
            made = [pa.array([a[i] for a in answers], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *made], [*columns, "lang_pred", "score", "rejected"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return rows.mapInArrow(run, T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema), *added]))
