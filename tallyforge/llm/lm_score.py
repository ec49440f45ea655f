"""Language-model scores by deleted interpolation of word bigrams.

P(v | u) = l2(b) c(u, v) / c(u) + l1(b) c(v) / N + l0(b) / (V + 1), where b is the
bucket (power of two) of the context's count c(u).  The weights of each bucket are
learned by expectation-maximisation on a deleted block: one part of the training
documents, seen with the counts of all the other parts.  Scoring uses the counts of
all training documents.

Counts are gathered from all training documents and every document's counts come
back in chunks (see ``chunks``); nothing that grows with the corpus reaches the
driver.  The driver sees totals, and the deleted block as a histogram over buckets
and rounded probability ratios, whose number of cells is bounded.

A text is followed by one end token, which is also the context of its first word.
Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

from ..session import stored
from .chunks import Chunk, answered, asked, cut, from_planes, mix, pack_sorted, planes, ranges_of, segments, stored_chunks, unpack_sorted
from .common import LOWER

#: No word holds a line feed, so the end token is no word.
END = xxhash.xxh3_64_intdigest(b"\n")
TRAINING, DELETED, HELD_OUT = 0, 1, 2
#: Cells of the histogram for each factor of two.
STEPS = 4
#: The least weight of the uniform part, so that every probability is positive.
FLOOR = 1e-6
NONE = -(1 << 20)


def lower_words(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def remainder(doc_id: int | None, of: int) -> int:
    """crc32 of the id as text modulo ``of``; a missing id is the empty text."""
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % of


def bucket(counts: np.ndarray) -> np.ndarray:
    """0 for none, then one bucket for each power of two."""
    return np.where(counts > 0, np.frexp(np.maximum(counts, 1).astype(np.float64))[1], 0)


class Grams:
    """The tokens of a chunk: distinct word and bigram hashes (sorted) and where they are."""

    def __init__(self, chunk: Chunk):
        n = chunk.lengths + 1
        self.ends = np.cumsum(n)
        self.starts = self.ends - n
        hashes = np.append(chunk.word_hashes(), np.uint64(END))
        words = np.full(int(n.sum()), len(chunk.vocabulary), np.int64)
        inner = np.ones(len(words), bool)
        inner[self.ends - 1] = False
        words[inner] = chunk.words
        order = np.argsort(hashes)
        place = np.empty(len(hashes), np.int64)
        place[order] = np.arange(len(hashes))
        self.one, self.at_one = hashes[order], place[words]
        before = np.empty(len(words), np.int64)
        before[1:] = self.at_one[:-1]
        before[self.starts] = place[-1]
        self.context = before
        pairs = mix(self.one[before] * np.uint64(0x9E3779B97F4A7C15) + self.one[self.at_one])
        self.two, self.at_two = np.unique(pairs, return_inverse=True)


def _counts(chunks: DataFrame, ranges: int) -> DataFrame:
    """``chunk, kind, range, total, rest, seen``: counts for each chunk's hashes, and sums with chunk -1."""

    def ask(chunk: Chunk):
        grams = Grams(chunk)
        for kind, hashes, at in ((1, grams.one, grams.at_one), (2, grams.two, grams.at_two)):
            counts = np.bincount(at, minlength=len(hashes)) if chunk.part != HELD_OUT else None
            for name, a, b in cut(hashes, ranges):
                yield chunk.number, chunk.part, kind, name, pack_sorted(hashes[a:b]), None if counts is None else planes(counts[a:b])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        arrays = [unpack_sorted(h) for h in rows["hashes"]]
        counts = [np.zeros(len(a), np.int64) if c is None else from_planes(c).astype(np.int64) for a, c in zip(arrays, rows["counts"], strict=True)]
        parts = rows["part"].tolist()
        values, which = np.unique(np.concatenate(arrays), return_inverse=True)
        total = np.bincount(which, weights=np.concatenate(counts), minlength=len(values))
        deleted = np.concatenate([c if p == DELETED else np.zeros_like(c) for c, p in zip(counts, parts, strict=True)])
        rest = total - np.bincount(which, weights=deleted, minlength=len(values))
        kind, name = int(rows["kind"].iloc[0]), int(rows["range"].iloc[0])
        out = [
            (chunk, kind, name, planes(total[which[s]].astype(np.int64)), planes(rest[which[s]].astype(np.int64)) if part == DELETED else None, None, None)
            for chunk, part, s in zip(rows["chunk"].tolist(), parts, segments(arrays), strict=True)
        ]
        out.append((-1, kind, name, None, None, int((total > 0).sum()), int((rest > 0).sum())))
        return pd.DataFrame(out, columns=["chunk", "kind", "range", "total", "rest", "seen", "seen_rest"]).astype({"seen": "Int64", "seen_rest": "Int64"})

    sent = asked(chunks, ask, "chunk long, part int, kind int, range int, hashes binary, counts binary")
    return sent.groupBy("kind", "range").applyInPandas(add, "chunk long, kind int, range int, total binary, rest binary, seen long, seen_rest long")


def _replied(grams: Grams, got: pd.DataFrame, column: str, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The counts of a chunk's words and bigrams."""
    found = {(k, r): d for k, r, d in zip(got["kind"], got["range"], got[column], strict=True)}
    out = []
    for kind, hashes in ((1, grams.one), (2, grams.two)):
        counts = np.zeros(len(hashes), np.int64)
        for name, a, b in cut(hashes, ranges):
            counts[a:b] = from_planes(found[kind, name]).astype(np.int64)
        out.append(counts)
    return out[0], out[1]


def _ratio(values: np.ndarray, scale: float) -> np.ndarray:
    """Rounded logarithm of ``values * scale``; NONE for zero."""
    out = np.full(len(values), NONE, np.int64)
    some = values > 0
    out[some] = np.rint(STEPS * np.log2(values[some] * scale)).astype(np.int64)
    return out


def learn_weights(cells: list[tuple[int, int, int, int]], rounds: int = 200) -> dict[int, tuple[float, float, float]]:
    """Weights (bigram, word, uniform) of each bucket by EM.

    A cell is a bucket, the rounded logarithms of the bigram and word estimate over
    the uniform one, and how many held-out tokens it has.
    """
    table = np.array(cells, dtype=np.int64).reshape(-1, 4)
    weights = {}
    for b in np.unique(table[:, 0]):
        own = table[table[:, 0] == b]
        p = np.stack([np.where(c == NONE, 0.0, np.exp2(c / STEPS)) for c in (own[:, 1], own[:, 2])] + [np.ones(len(own))], axis=1)
        n, w = own[:, 3].astype(float), np.full(3, 1 / 3)
        for _ in range(rounds):
            share = p * w
            new = (n[:, None] * share / share.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
            done = np.abs(new - w).max() < 1e-7
            w = new
            if done:
                break
        w = np.maximum(w, [0.0, 0.0, FLOOR])
        weights[int(b)] = tuple((w / w.sum()).tolist())
    return weights


def _weight_table(weights: dict[int, tuple[float, float, float]]) -> np.ndarray:
    """Rows for buckets 0 to 64; a bucket without held-out tokens takes those of the nearest one below, else above.

    Bucket 0 has no bigram estimate: its bigram weight goes to the other two.
    """
    table = np.zeros((65, 3))
    known = sorted(weights)
    for b in range(65):
        below = [k for k in known if k <= b]
        table[b] = weights[below[-1]] if below else weights[known[0]] if known else (0.0, 1 - FLOOR, FLOOR)
    table[0, 0] = 0.0
    table[0] = table[0] / table[0].sum() if table[0].sum() else (0.0, 1 - FLOOR, FLOOR)
    return table


def score(docs: DataFrame, folds: int = 7, held_out: int = 2, deleted: int = 3) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    Learns from documents whose crc32(doc_id as text) modulo ``folds`` is not
    ``held_out``; those where it is ``deleted`` are the deleted block of EM.  ``score``
    is the model's log10 probability of the text with its end token, ``base_score`` the
    add-one unigram one.  A null or blank text is the end token alone.  Rows without an
    id count as id '' (remainder 0).  Every row counts, also when rows repeat.
    Without training documents all counts are 0 and every token has probability one.
    An empty table gives no rows.
    """

    def part_of(doc_id: int | None) -> int:
        return {held_out: HELD_OUT, deleted: DELETED}.get(remainder(doc_id, folds), TRAINING)

    chunks = stored_chunks(docs, lower_words, part_of)
    ranges = ranges_of(chunks)
    replies = stored(_counts(chunks, ranges))
    sizes = {r["kind"]: r for r in replies.where("chunk = -1").groupBy("kind").agg({"seen": "sum", "seen_rest": "sum"}).collect()}
    distinct, distinct_rest = (sizes[1][f"sum({c})"] if 1 in sizes else 0 for c in ("seen", "seen_rest"))
    replies = replies.where("chunk >= 0").select("chunk", "kind", "range", "total", "rest")

    def tokens(parts: str) -> int:
        row = chunks.where(f"part IN ({parts})").selectExpr("sum(n_words + octet_length(lengths) div 8)").first()
        return row[0] or 0

    train, rest = tokens(f"{TRAINING}, {DELETED}"), tokens(str(TRAINING))

    def cells(chunk: Chunk, got: pd.DataFrame) -> pd.DataFrame:
        grams = Grams(chunk)
        one, two = _replied(grams, got, "rest", ranges)
        around = one[grams.context]
        uniform = distinct_rest + 1
        pair = two[grams.at_two] / np.maximum(around, 1)
        two_at, one_at = _ratio(pair, uniform) - NONE, _ratio(one[grams.at_one] / max(rest, 1), uniform) - NONE
        cell, n = np.unique((bucket(around).astype(np.int64) << 42) | (two_at << 21) | one_at, return_counts=True)
        return pd.DataFrame({"b": cell >> 42, "two": (cell >> 21 & 0x1FFFFF) + NONE, "one": (cell & 0x1FFFFF) + NONE, "n": n})

    held = chunks.where(f"part = {DELETED}")
    histogram = answered(held, replies.where("rest IS NOT NULL"), cells, "b int, two long, one long, n long").groupBy("b", "two", "one").agg({"n": "sum"})
    weights = _weight_table(learn_weights([tuple(r) for r in histogram.collect()]))

    def finish(chunk: Chunk, got: pd.DataFrame) -> pd.DataFrame:
        grams = Grams(chunk)
        one, two = _replied(grams, got, "total", ranges)
        own, around = one[grams.at_one], one[grams.context]
        w = weights[bucket(around)]
        p = w[:, 0] * (two[grams.at_two] / np.maximum(around, 1)) + w[:, 1] * (own / max(train, 1)) + w[:, 2] / (distinct + 1)
        if not train:
            p = np.ones(len(own))
        base = np.log10((own + 1) / (train + distinct + 1))
        return pd.DataFrame(
            {
                "doc_id": pd.array(chunk.ids, dtype="Int64"),
                "held_out": chunk.part == HELD_OUT,
                "n_tokens": grams.ends - grams.starts,
                "n_known": np.add.reduceat((own > 0).astype(np.int64), grams.starts),
                "train_tokens": train,
                "base_score": np.add.reduceat(base, grams.starts),
                "score": np.add.reduceat(np.log10(p), grams.starts),
            }
        )

    return answered(chunks, replies, finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
