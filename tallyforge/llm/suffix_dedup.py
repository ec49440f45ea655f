"""Repeated byte strings, by sorting suffixes at sampled places.

A suffix array of every byte would shuffle ``size`` bytes for each byte of the input.
Here only some suffixes are sorted, chosen by content so that none is missed:

1. Every window of ``size`` bytes has an anchor: of the half-window strings in it, the
   leftmost one with the smallest hash.  Equal windows have their anchor at the same
   place.  A window can only repeat if its anchor's string does, which is found first.
2. The windows of an anchor are taken in cells of up to 32 neighbouring starts.  The
   bytes that all windows of a cell share are its core, all of them together its span.
   The suffixes at cores are partitioned into ranges of their leading bytes, with
   splitters sampled from the suffixes, and sorted within a range.  A core that nobody
   else has rules the cell out; a span that somebody else has settles all its windows.
   Equal leading bytes never straddle a splitter, so nothing is compared across.
3. What is left are cells at the ends of repeats.  They send the bytes left and right of
   their core, which are sorted word by word (a multikey sort) for each start in the cell.

Anchors, cores and spans are compared by 64-bit hashes (cores also by their first eight
bytes), the bytes around a core as they are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .chunks import Rolling, Texts, answered, asked, cut, mix, pack_sorted, ranges_of, segments, stored_texts, unpack_sorted

BASE = 0x9E3779B97F4A7C15
CELL = 32
#: Suffixes of a chunk that the splitters are chosen from.
SAMPLED = 256
#: Bytes of input that share a range.
RANGE_BYTES = 16_000_000

UNIQUE, WHOLE, OPEN, WHOLE_FIRST = range(4)
SIGN = np.uint64(1 << 63)


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each run of ``width`` keys."""
    n = len(keys) - width + 1
    if n <= 0:
        return np.zeros(0, keys.dtype)
    pad = -len(keys) % width
    blocks = np.append(keys, np.full(pad, np.iinfo(keys.dtype).max, keys.dtype)).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class Anchors:
    """Anchors of a chunk's windows: place, and the first and last window of each."""

    def __init__(self, chunk: Texts, size: int, packed: bytes | None = None):
        self.gram = size // 2
        table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
        self.rolling = Rolling(table[chunk.data], BASE)
        if packed is None:
            self._choose(chunk, size)
        else:
            self.place, self.first, self.last = np.frombuffer(packed, np.int32).reshape(3, -1).astype(np.int64)
        hashes = self.rolling.at(self.place, self.gram)
        self.hashes, self.which, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        self.several = counts > 1

    def _choose(self, chunk: Texts, size: int) -> None:
        hashes = self.rolling.all(self.gram)
        keys = (hashes & ~np.uint64(0xFFFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
        windows = np.flatnonzero(chunk.inside(size))
        places = (sliding_least(keys, size - self.gram + 1)[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.diff(places, prepend=-1))
        self.place, self.first = places[new], windows[new]
        self.last = windows[np.append(new[1:], len(windows)) - 1] if len(new) else self.first

    def packed(self) -> bytes:
        return np.stack([self.place, self.first, self.last]).astype(np.int32).tobytes()

    def leads(self, chunk: Texts) -> bytes:
        """The first bytes at some of the anchors, evenly chosen, as signed numbers in their order."""
        at = self.place[np.linspace(0, len(self.place) - 1, min(SAMPLED, len(self.place))).astype(np.int64)] if len(self.place) else self.place
        return (first_bytes(chunk.data, at) ^ SIGN).tobytes()


def first_bytes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number that orders like them."""
    lead = np.zeros(len(at), np.uint64)
    for i in range(8):
        lead = (lead << np.uint64(8)) | data[at + i]
    return lead


class Cells:
    """Cells of the chosen anchors, and their distinct (lead, core, span), sorted."""

    def __init__(self, chunk: Texts, anchors: Anchors, chosen: np.ndarray, size: int):
        place, low = anchors.place[chosen], anchors.place[chosen] - anchors.last[chosen]
        high = anchors.place[chosen] - anchors.first[chosen]
        n = high // CELL - low // CELL + 1
        run = np.repeat(np.arange(len(place)), n)
        cell = low[run] // CELL + np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        self.core = place[run] - CELL * cell
        self.low = np.maximum(low[run] - CELL * cell, 0)
        self.high = np.minimum(high[run] - CELL * cell, CELL - 1)
        document = np.searchsorted(chunk.ends, self.core, side="right") if len(run) else run
        self.start, self.end = chunk.starts[document], chunk.ends[document]
        rolling, self.short = anchors.rolling, size - CELL + 1
        hashes = mix(rolling.at(self.core, self.short) + cell.astype(np.uint64))
        whole = (self.core - CELL + 1 >= self.start) & (self.core + size <= self.end)
        spans = np.zeros(len(run), np.uint64)
        spans[whole] = rolling.at(self.core[whole] - CELL + 1, size + CELL - 1) | np.uint64(1)
        lead = first_bytes(chunk.data, self.core)
        order = np.lexsort((spans, hashes, lead))
        keys = [x[order] for x in (lead, hashes, spans)]
        new = changes(*keys)
        self.which = np.empty(len(run), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.lead, self.hashes, self.spans = (x[new] for x in keys)
        self.several = np.bincount(self.which, minlength=len(self.lead)) > 1


def changes(*keys: np.ndarray) -> np.ndarray:
    """Where rows of sorted keys differ from the row before."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def split(lead: np.ndarray, splitters: np.ndarray) -> list[tuple[int, int, int]]:
    """``range, start, stop`` of sorted leads."""
    at = np.searchsorted(splitters, lead, side="right")
    names, starts = np.unique(at, return_index=True)
    return list(zip(names.tolist(), starts.tolist(), np.append(starts, len(lead))[1:].tolist(), strict=True))


def words_around(sides: np.ndarray, low: int) -> list[np.ndarray]:
    """The 31 bytes from ``low`` on of each row of 62, as four words."""
    part = np.zeros((len(sides), 32), np.uint8)
    part[:, 1:] = sides[:, low : low + CELL - 1]
    return [part.view(">u8")[:, i].astype(np.uint64) for i in range(4)]


def settle(rows: pd.DataFrame) -> pd.DataFrame:
    """States of the cores of one range, from the arrays of all chunks."""
    leads = [unpack_sorted(x) for x in rows["lead"]]
    keys = [np.concatenate(leads), *(np.concatenate([np.frombuffer(x, np.uint64) for x in rows[c]]) for c in ("core", "span"))]
    weight = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["several"]]).astype(np.int64) + 1
    order = np.lexsort(keys[::-1])
    lead, core, span = (k[order] for k in keys)
    new_span = changes(lead, core, span)
    of_span, of_core = np.cumsum(new_span) - 1, np.cumsum(changes(lead, core)) - 1
    spans, cores = np.bincount(of_span, weights=weight[order]), np.bincount(of_core, weights=weight[order])
    state = np.where(cores[of_core] < 2, UNIQUE, np.where((span != 0) & (spans[of_span] > 1), WHOLE, OPEN))
    waits = np.bincount(of_core, weights=state == OPEN) > 0
    state[(state == WHOLE) & new_span & waits[of_core]] = WHOLE_FIRST
    out = np.empty(len(state), np.uint8)
    out[order] = state
    made = [out[s].tobytes() if out[s].any() else None for s in segments(leads)]
    found = pd.DataFrame({"chunk": rows["chunk"], "range": rows["range"], "states": made})
    return found[found["states"].notna()]


def compare(rows: pd.DataFrame) -> pd.DataFrame:
    """For each open cell of a range, a bit for each of its windows that repeats."""
    parts = [np.frombuffer(x, np.uint64) for x in rows["core"]]
    lead, core = (np.concatenate([np.frombuffer(x, np.uint64) for x in rows[c]]) for c in ("lead", "core"))
    sides = np.concatenate([np.frombuffer(x, np.uint8).reshape(-1, 2 * CELL - 2) for x in rows["sides"]])
    low, high, weight = (np.concatenate([np.frombuffer(x, np.uint8) for x in rows[c]]).astype(np.int64) for c in ("low", "high", "weight"))
    group = np.unique(np.stack([lead, core], axis=1), axis=0, return_inverse=True)[1].ravel()
    bits = np.zeros(len(core), np.uint64)
    for t in range(CELL):
        own = np.flatnonzero((low <= t) & (t <= high))
        keys = [group[own], *words_around(sides[own], CELL - 1 - t)]
        order = np.lexsort(keys[::-1])
        of = np.cumsum(changes(*(k[order] for k in keys))) - 1
        again = np.bincount(of, weights=weight[own][order])[of] > 1 if len(own) else np.zeros(0, bool)
        bits[own[order][again]] |= np.uint64(1 << t)
    made = [bits[s].tobytes() if bits[s].any() else None for s in segments(parts)]
    found = pd.DataFrame({"chunk": rows["chunk"], "range": rows["range"], "bits": made})
    return found[found["bits"].notna()]


class Open:
    """The open cells of a chunk, distinct, sorted by lead; ``which`` and ``at`` lead back to cells."""

    def __init__(self, chunk: Texts, cells: Cells, states: np.ndarray):
        state = states[cells.which] if len(cells.which) else np.zeros(0, np.uint8)
        first = np.zeros(len(state), bool)
        first[np.unique(cells.which, return_index=True)[1]] = True
        self.at = np.flatnonzero((state == OPEN) | ((state == WHOLE_FIRST) & first))
        core, start, end = cells.core[self.at], cells.start[self.at], cells.end[self.at]
        # 31 bytes before the core and 31 after it; outside of the document zero, where no window of the cell is.
        reach = np.concatenate([np.arange(-CELL + 1, 0), cells.short + np.arange(CELL - 1)])
        places = core[:, None] + reach
        inside = (places >= start[:, None]) & (places < end[:, None])
        sides = np.where(inside, chunk.data[np.clip(places, 0, max(0, len(chunk.data) - 1))], 0).astype(np.uint8) if len(core) else np.zeros((0, 2 * CELL - 2), np.uint8)
        low, high = cells.low[self.at], cells.high[self.at]
        heavy = state[self.at] == WHOLE_FIRST
        padded = np.zeros((len(sides), 64), np.uint8)
        padded[:, : 2 * CELL - 2] = sides
        words = [padded.view("<u8")[:, i] for i in range(8)]
        keys = [cells.lead[cells.which[self.at]], cells.hashes[cells.which[self.at]], low, high, *words]
        order = np.lexsort(keys[::-1])
        new = changes(*(k[order] for k in keys))
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        pick = order[new]
        self.lead, self.core, self.sides = keys[0][pick], keys[1][pick], sides[pick]
        self.low, self.high = low[pick].astype(np.uint8), high[pick].astype(np.uint8)
        n = np.bincount(self.which, weights=1 + heavy.astype(int), minlength=len(pick)) if len(pick) else np.zeros(0)
        self.weight = np.minimum(n, 2).astype(np.uint8)


def remove_repeats(docs: DataFrame, size: int = 400) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: UTF-8 bytes left after repeated strings are removed.

    A byte goes if a string of ``size`` bytes of its document covers it that also
    starts anywhere else, in the same or another document; overlaps count, strings are
    judged on the input.  n_spans counts the maximal removed runs.  ``kept`` is binary,
    as cuts can split a character.  Null and empty texts have no bytes.  Ids only name
    rows: repeated rows are each other's repeats, ids may be null.  An empty table
    gives no rows.  A document is one task's work.
    """
    if size < 4 * CELL:
        raise ValueError(f"strings have {4 * CELL} bytes at least")
    chunks = stored_texts(docs)
    ranges = ranges_of(chunks, "n_bytes", RANGE_BYTES)

    def anchor_rows(chunk: Texts):
        anchors = Anchors(chunk, size)
        yield chunk.number, -1, None, None, anchors.packed(), np.frombuffer(anchors.leads(chunk), np.int64).tolist()
        for name, a, b in cut(anchors.hashes, ranges):
            yield chunk.number, name, pack_sorted(anchors.hashes[a:b]), np.packbits(anchors.several[a:b]).tobytes(), None, None

    def repeated(rows: pd.DataFrame) -> pd.DataFrame:
        arrays = [unpack_sorted(x) for x in rows["hashes"]]
        several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(a)) for a, x in zip(arrays, rows["several"], strict=True)])
        values, which, counts = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
        hit = ((counts > 1) | (np.bincount(which, weights=several, minlength=len(values)) > 0))[which]
        made = [np.packbits(hit[s]).tobytes() if hit[s].any() else None for s in segments(arrays)]
        found = pd.DataFrame({"chunk": rows["chunk"], "range": rows["range"], "hits": made})
        return found[found["hits"].notna()]

    sent = stored(asked(chunks, anchor_rows, "chunk long, range int, hashes binary, several binary, anchors binary, leads array<long>", Texts))
    hits = stored(
        sent.where("range >= 0").select("chunk", "range", "hashes", "several").groupBy("range").applyInPandas(repeated, "chunk long, range int, hits binary")
    )
    shares = [i / ranges for i in range(1, ranges)]
    leads = sent.where("range < 0").select(F.explode("leads").alias("lead"))
    picked = leads.agg(F.percentile_approx("lead", shares, 100 * ranges).alias("at")).first()["at"] if shares else None
    splitters = np.unique(np.array(picked or [], dtype=np.int64)).view(np.uint64) ^ SIGN

    columns = ("anchors", "hits", "states", "bits")

    def reply(table: DataFrame, column: str) -> DataFrame:
        return table.selectExpr("chunk", "range", *(c if c == column else f"CAST(NULL AS binary) AS {c}" for c in columns))

    known = reply(sent.where("range < 0"), "anchors").unionByName(reply(hits, "hits"))

    def cells_of(chunk: Texts, got: pd.DataFrame) -> Cells:
        anchors = Anchors(chunk, size, next(x for x in got["anchors"] if x is not None))
        hit = np.zeros(len(anchors.hashes), bool)
        bits = {r: x for r, x in zip(got["range"], got["hits"], strict=True) if x is not None}
        for name, a, b in cut(anchors.hashes, ranges):
            if name in bits:
                hit[a:b] = np.unpackbits(np.frombuffer(bits[name], np.uint8), count=b - a)
        return Cells(chunk, anchors, np.flatnonzero(hit[anchors.which]) if len(anchors.which) else anchors.which, size)

    def core_rows(chunk: Texts, got: pd.DataFrame) -> pd.DataFrame:
        cells = cells_of(chunk, got)
        rows = [
            (chunk.number, name, pack_sorted(cells.lead[a:b]), cells.hashes[a:b].tobytes(), cells.spans[a:b].tobytes(), cells.several[a:b].astype(np.uint8).tobytes())
            for name, a, b in split(cells.lead, splitters)
        ]
        return pd.DataFrame(rows, columns=["chunk", "range", "lead", "core", "span", "several"])

    states = stored(
        answered(chunks, known, core_rows, "chunk long, range int, lead binary, core binary, span binary, several binary", Texts)
        .groupBy("range")
        .applyInPandas(settle, "chunk long, range int, states binary")
    )

    def states_of(cells: Cells, got: pd.DataFrame) -> np.ndarray:
        out = np.zeros(len(cells.lead), np.uint8)
        found = {r: x for r, x in zip(got["range"], got["states"], strict=True) if x is not None}
        for name, a, b in split(cells.lead, splitters):
            if name in found:
                out[a:b] = np.frombuffer(found[name], np.uint8)
        return out

    settled = known.unionByName(reply(states, "states"))

    def open_rows(chunk: Texts, got: pd.DataFrame) -> pd.DataFrame:
        cells = cells_of(chunk, got)
        rest = Open(chunk, cells, states_of(cells, got))
        rows = [
            (chunk.number, name, *(x[a:b].tobytes() for x in (rest.lead, rest.core, rest.sides, rest.low, rest.high, rest.weight)))
            for name, a, b in split(rest.lead, splitters)
        ]
        return pd.DataFrame(rows, columns=["chunk", "range", "lead", "core", "sides", "low", "high", "weight"])

    compared = stored(
        answered(chunks, settled, open_rows, "chunk long, range int, lead binary, core binary, sides binary, low binary, high binary, weight binary", Texts)
        .groupBy("range")
        .applyInPandas(compare, "chunk long, range int, bits binary")
    )

    def remove(chunk: Texts, got: pd.DataFrame) -> pd.DataFrame:
        cells = cells_of(chunk, got)
        states = states_of(cells, got)
        rest = Open(chunk, cells, states)
        bits = np.zeros(len(rest.lead), np.uint64)
        found = {r: x for r, x in zip(got["range"], got["bits"], strict=True) if x is not None}
        for name, a, b in split(rest.lead, splitters):
            if name in found:
                bits[a:b] = np.frombuffer(found[name], np.uint64)
        marks = np.zeros(len(chunk.data) + 1, np.int64)
        whole = np.flatnonzero(np.isin(states, (WHOLE, WHOLE_FIRST))[cells.which]) if len(cells.which) else cells.which
        # Window t of a cell starts t bytes before the core; a settled cell covers from its first window to its last one's end.
        np.add.at(marks, cells.core[whole] - cells.high[whole], 1)
        np.subtract.at(marks, cells.core[whole] - cells.low[whole] + size, 1)
        own = bits[rest.which] if len(rest.which) else bits
        for t in range(CELL):
            at = cells.core[rest.at[(own >> np.uint64(t)) & np.uint64(1) == 1]] - t
            np.add.at(marks, at, 1)
            np.subtract.at(marks, at + size, 1)
        gone = np.cumsum(marks)[: len(chunk.data)] > 0
        kept, removed, spans = [], [], []
        for start, end in zip(chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
            mine = gone[start:end]
            kept.append(chunk.data[start:end][~mine].tobytes())
            removed.append(int(mine.sum()))
            spans.append(int((np.diff(mine.astype(np.int8), prepend=0) == 1).sum()))
        return pd.DataFrame({"doc_id": pd.array(chunk.ids, dtype="Int64"), "n_bytes": chunk.lengths, "n_removed": removed, "n_spans": spans, "kept": kept})

    replies = settled.unionByName(reply(compared, "bits"))
    return answered(chunks, replies, remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary", Texts)
