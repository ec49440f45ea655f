"""Benchmark passages in documents, by edit distance over words.

The CGK embedding walks over a word sequence and writes one word a step; a random bit
of the step and word decides whether the walk goes on to the next word.  Two
sequences with few edits, walked with the same bits, write the same word at most
steps: edit distance becomes Hamming distance.  Equality at sampled steps is then a
locality-sensitive key.  Items are embedded from each of their words on, documents from
every fourth word on where an item can be at all: a match has most of its words from the
benchmark, so other stretches are passed over without losing any.

Walks are repeated until a target recall is reached: for each length of an item and its
number of allowed edits, ``walks_for`` walks made-up items and copies with all of these
edits, half of them evenly spaced substitutions, which leave the shortest runs, and half
edits of all kinds at random places, and counts how many share a key after each walk.
Items too short to reach the target in ``MOST`` walks are found without walks, by their
rarest words, and none of them is missed.  Every candidate is verified by the exact
distance of the item to the best part of the document around it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .chunks import mix
from .common import fresh, small

#: Steps of a walk, steps between samples of a key, samples of a key.
STEPS, GAP, SAMPLES = 24, 3, 5
#: Walks at most, and items made up to count what they find.
MOST, TRIALS = 3, 400
#: Words of documents that are looked at together.
TOGETHER = 1 << 20

words = re.compile(r"[^\W_]+").findall


def words_in(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case."""
    return words((text or "").lower())


def keys(numbers: np.ndarray, starts: np.ndarray, ends: np.ndarray, walk: int) -> np.ndarray:
    """Keys of the walks from ``starts``, a column for each group of sampled steps; 0 where a sampled word is unknown (0).

    A walk that reaches its end writes the unknown word from there on.
    """
    seed = np.uint64((walk + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    at = starts.copy()
    written = []
    for step in range(STEPS):
        word = np.where(at < ends, numbers[np.minimum(at, len(numbers) - 1)], 0).astype(np.uint64)
        written.append(word)
        at += ((mix(word + seed) >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
    out = []
    for first in range(0, STEPS - GAP * (SAMPLES - 1), GAP * SAMPLES // 2):
        key, known = np.full(len(starts), (walk * STEPS + first) * 2 + 1, np.uint64), np.ones(len(starts), bool)
        for i in range(SAMPLES):
            word = written[first + i * GAP]
            key = mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + word)
            known &= word > 0
        out.append(np.where(known, key, np.uint64(0)))
    return np.stack(out, axis=1)


def edits(item: np.ndarray, part: np.ndarray, most: int) -> tuple[int, int] | None:
    """The fewest edits that turn the item into some stretch of ``part`` and that stretch's end; None if over ``most``.

    Words of ``part`` that the benchmark does not have are 0 and equal no word.
    """
    at = np.arange(len(part) + 1)
    row = np.zeros(len(part) + 1, np.int64)
    for i, word in enumerate(item.tolist(), 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (part != word))
        row = np.minimum.accumulate(new - at) + at
        if row.min() > most:
            return None
    end = int(row.argmin())
    return int(row[end]), end


def _made(rnd: np.random.Generator, length: int, most: int, trial: int) -> tuple[np.ndarray, np.ndarray]:
    """An item of random words, and a copy with ``most`` edits in a document of other words."""
    item = rnd.integers(1, 1 << 30, length)
    if trial % 2:
        copy = item.copy()
        copy[(2 * np.arange(most) + 1) * length // (2 * max(1, most))] = 0
    else:
        copy, kinds = list(item), rnd.integers(0, 3, most)
        for at, kind in zip(sorted(rnd.choice(length, most, replace=False))[::-1], kinds, strict=True):
            copy[at : at + 1] = ([0], [], [copy[at], 0])[kind]
    return item, np.concatenate([np.zeros(rnd.integers(0, 8), np.int64), copy, np.zeros(8, np.int64)])


@cache
def walks_for(length: int, most: int, recall: float, every: int) -> int | None:
    """The walks after which at least ``recall`` of the made-up copies share a key with their item; None if ``MOST`` do not suffice."""
    rnd = np.random.default_rng(length * 1009 + most)
    pairs = [_made(rnd, length, most, n) for n in range(TRIALS)]
    sides = []
    for side, step in ((0, 1), (1, every)):
        sizes = np.array([len(p[side]) for p in pairs])
        ends = np.cumsum(sizes)
        within = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        starts = np.flatnonzero(within % step == 0)
        trial = np.repeat(np.arange(TRIALS), sizes)[starts]
        sides.append((np.concatenate([p[side] for p in pairs]), starts, np.repeat(ends, sizes)[starts], trial))
    met = np.zeros(TRIALS, bool)
    for walk in range(MOST):
        found = []
        for numbers, starts, ends, trial in sides:
            own = keys(numbers, starts, ends, walk)
            marked = mix(own ^ (trial[:, None].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            found.append((marked[own > 0], np.broadcast_to(trial[:, None], own.shape)[own > 0]))
        met[found[1][1][np.isin(found[1][0], found[0][0])]] = True
        if met.mean() >= recall:
            return walk + 1
    return None


class Index:
    """Items as word numbers and the sorted keys of as many walks as the target recall needs of each."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, recall: float, every: int):
        self.similarity, self.every = similarity, every
        self.vocabulary: dict[str, int] = {}
        self.ids, self.items = [], []
        for item_id, text in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_in(text)]
            if numbers:
                self.ids.append(item_id)
                self.items.append(np.array(numbers, dtype=np.int32))
        self.most = [floor((1 - similarity) * len(x) + 1e-9) for x in self.items]
        # A length stands for those up to the next multiple of five, which have more places for a key.
        needed = [walks_for(min(120, len(x) // 5 * 5), min(m, min(120, len(x) // 5 * 5)) if len(x) < 120 else int((1 - similarity) * 120 + 1e-9), recall, every) for x, m in zip(self.items, self.most, strict=True)]
        self.walks = max((n for n in needed if n), default=0)
        found, item, offset = [], [], []
        for i, x in enumerate(self.items):
            starts = np.arange(len(x))
            for walk in range(needed[i] or 0):
                own = keys(x, starts, np.full(len(starts), len(x)), walk)
                found.append(own.ravel())
                item.append(np.full(own.size, i))
                offset.append(np.repeat(starts, own.shape[1]))
        all_keys = np.concatenate(found) if found else np.zeros(0, np.uint64)
        order = np.argsort(all_keys, kind="stable")
        order = order[all_keys[order] > 0]
        self.keys = all_keys[order]
        self.item, self.offset = (np.concatenate(x)[order] if x else np.zeros(0, np.int64) for x in (item, offset))
        self._densities()
        self._short([i for i, n in enumerate(needed) if not n])

    def _short(self, items: list[int]) -> None:
        """Items too short for walks: of any ``most + 1`` of their words a match has one unedited, so the rarest are looked for."""
        self.rarest: dict[int, list[tuple[int, int]]] = {}
        names = {number: word for word, number in self.vocabulary.items()}
        for i in items:
            x = self.items[i]
            if len(x):
                order = sorted(range(len(x)), key=lambda n: (self.spread[x[n]], -len(names[int(x[n])]), n))
                for n in order[: self.most[i] + 1]:
                    self.rarest.setdefault(int(x[n]), []).append((i, n))
        self.wanted = np.zeros(len(self.vocabulary) + 1, bool)
        self.wanted[list(self.rarest)] = True

    def _densities(self) -> None:
        """What a stretch must have to hold an item of a size class: known words, and known words that few items have."""
        spread = np.zeros(len(self.vocabulary) + 1, np.int64)
        for x in self.items:
            spread[np.unique(x)] += 1
        self.spread = spread
        self.rare = spread <= max(1, len(self.items) // 50)
        self.rare[0] = False
        self.sizes = []
        lengths = sorted(len(x) for x in self.items)
        while lengths:
            least = lengths[0]
            top = max(n for n in lengths if n <= least * 1.25)
            own = [i for i, x in enumerate(self.items) if least <= len(x) <= top]
            need = min(len(self.items[i]) - self.most[i] for i in own)
            need_rare = min(int(self.rare[self.items[i]].sum()) - self.most[i] for i in own)
            self.sizes.append((top + max(self.most[i] for i in own), need, need_rare))
            lengths = [n for n in lengths if n > top]

    def places(self, numbers: np.ndarray, ends_of: np.ndarray) -> np.ndarray:
        """Which words lie in a stretch with enough known words for some item."""
        sums, rare = np.append(0, np.cumsum(numbers > 0)), np.append(0, np.cumsum(self.rare[numbers]))
        n = len(numbers)
        marks = np.zeros(n + 1, np.int32)
        starts = np.arange(n)
        for reach, need, need_rare in self.sizes:
            stop = np.minimum(starts + reach, ends_of)
            dense = np.flatnonzero((sums[stop] - sums[:-1] >= need) & (rare[stop] - rare[:-1] >= need_rare))
            marks += np.bincount(dense, minlength=n + 1).astype(np.int32)
            marks -= np.bincount(stop[dense], minlength=n + 1).astype(np.int32)
        return np.cumsum(marks)[:n] > 0

    def search(self, numbers: np.ndarray, lengths: list[int]) -> list[list[tuple[int, int, int, int]]]:
        """For each document ``(item, edits, first word, words)``: the best place of each item it holds."""
        ends = np.cumsum(lengths)
        ends_of = np.repeat(ends, lengths)
        dense = self.places(numbers, ends_of) if len(numbers) and self.items else np.zeros(0, bool)
        where = np.flatnonzero(dense & (np.arange(len(dense)) % self.every == 0))
        pairs = []
        for walk in range(self.walks if len(where) else 0):
            for column in keys(numbers, where, ends_of[where], walk).T:
                low, high = np.searchsorted(self.keys, column), np.searchsorted(self.keys, column, side="right")
                hit = np.flatnonzero((high > low) & (column > 0))
                for n, a, b in zip(where[hit].tolist(), low[hit].tolist(), high[hit].tolist(), strict=True):
                    pairs += [(int(self.item[j]), n - int(self.offset[j])) for j in range(a, b)]
        for n in np.flatnonzero(dense & self.wanted[numbers[: len(dense)]]).tolist():
            pairs += [(i, n - offset) for i, offset in self.rarest[int(numbers[n])]]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        starts = ends - np.array(lengths, dtype=np.int64)
        for i, at in sorted(set(pairs)):
            item, most = self.items[i], self.most[i]
            document = int(np.searchsorted(ends, max(at, 0), side="right"))
            document = min(document, len(lengths) - 1)
            if at < starts[document] and at + len(item) + most <= starts[document]:
                continue
            a, b = max(int(starts[document]), at - 2 * most), min(int(ends[document]), at + len(item) + 2 * most)
            if (document, i) in done and b <= done[document, i]:
                continue  # the same stretch was verified
            part = numbers[a:b]
            got = edits(item, part, most)
            done[document, i] = b - most
            if got and ((document, i) not in best or got[0] < best[document, i][0]):
                best[document, i] = (got[0], a - int(starts[document]), got[1])
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in lengths]
        for (document, i), (n, a, end) in sorted(best.items()):
            out[document].append((i, n, a, end))
        return out


def find(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.99, every: int = 4, block_words: int = 1 << 20) -> DataFrame:
    """The documents with ``hits``: an array of (item_id, edits, item_words) of the benchmark items that they hold.

    A document holds an item if some stretch of its words is at most
    ``floor((1 - similarity) * item_words)`` edits away from the item's words.  Words are
    runs of letters and digits in lower case.  Items without a word, and null or empty
    texts, match nothing; item ids may be null or repeat.  Every stretch of a document
    is looked at; exact passages and items too short for walks are always found, edited
    passages of longer items with at least the target ``recall`` at the limit of edits,
    as ``walks_for`` counts it, and more below it.  Every item that is held is
    named, so there are no ties between items; rows of one text have the same hits, and
    rows may repeat.  The benchmark is sent to the tasks in blocks of about ``block_words``
    words, one pass over the documents for each.  All rows and columns stay; a given
    column named hits is replaced.  Without documents there are no rows, without items
    no hits.
    """
    docs, spark = docs.drop("hits"), docs.sparkSession
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text"))
    items = stored(items.where("text IS NOT NULL").withColumn("size", F.expr("octet_length(text) div 4 + 1")))
    total = items.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    columns, hidden = docs.columns, fresh("text_of", docs.columns)
    hit = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("edits", T.LongType()), T.StructField("item_words", T.LongType())]))
    plain = [T.StructField(f.name, f.dataType) for f in docs.schema]
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int64()), ("item_words", pa.int64())]))

    def pass_over(rows: DataFrame, block: int) -> DataFrame:
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).select("item_id", "text").collect()
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in sorted(some, key=lambda r: (r[0] is None, r[0] or 0, r[1]))], similarity, recall, every))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = index.value
            get = known.vocabulary.get
            for batch in small(batches):
                texts = batch.column(len(columns) + 1).to_pylist()
                hits, at = batch.column(len(columns)).to_pylist(), 0
                while at < len(texts):
                    numbers, lengths = [], []
                    while at < len(texts) and len(numbers) < TOGETHER:
                        found = words_in(texts[at])
                        numbers += [get(w, 0) for w in found]
                        lengths.append(len(found))
                        at += 1
                    for n, got in enumerate(known.search(np.array(numbers, dtype=np.int32), lengths), at - len(lengths)):
                        if got:
                            hits[n] = [*(hits[n] or ()), *({"item_id": known.ids[i], "edits": e, "item_words": len(known.items[i])} for i, e, _, _ in got)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(hits, kind)], [*columns, "hits"])

        return rows.withColumn(hidden, F.col("text").cast("string")).mapInArrow(run, T.StructType([*plain, T.StructField("hits", hit)]))

    rows = docs.withColumn("hits", F.lit(None).cast(hit))
    for block in range(blocks):
        rows = pass_over(rows, block)
    return rows.withColumn("hits", F.coalesce("hits", F.array().cast(hit)))
