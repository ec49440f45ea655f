"""Personal data: rules, and more spans from scored candidates.

The rules give the base spans.  Generators with high recall then propose further,
overlapping spans: numbers in any grouping, dotted quads, mail addresses in free or
written-out form.  Boosted trees score a candidate by its format and by what stands
around it; they are trained to tell candidates that a rule confirms from the rest, on
features that do not hold what the rule tests: a check digit, a number's length, the
size of an octet, a "+" or an "@".  A number cut short at a confirmed one, or run on into
digits put beside it, is a negative; a phone number's national part is neither.  Confirmed
candidates are only some of the true ones, so scores are not probabilities of being
personal data; as in positive-unlabelled learning, the threshold of a kind is
calibrated on what the confirmed candidates of all documents score when held out.  Of overlapping
candidates the best stays; base spans always stay.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .boosting import Boosted
from .common import fresh, small

KINDS = ("email", "ip", "card", "phone")
#: Candidates that are scored in one go.
ROWS = 20_000

Span = tuple[int, int, int]  # kind, start, end

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @: the run of local characters before it and the domain after it, so long texts stay linear."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _QUAD.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m.group())) <= 15:
            yield m.span()


RULES = (emails, ips, cards, phones)


def base_spans(text: str) -> list[Span]:
    """The rules' spans by start, then kind."""
    found = [(kind, a, b) for kind, rule in enumerate(RULES) for a, b in rule(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


# ------------------------------------------------------------------ candidates

_NUMBER = re.compile(r"[+(]?[0-9](?:[ ().\-/]{0,3}[0-9])++")
_SPACED_AT = re.compile(r"[(\[{] ?(?:at|AT) ?[)\]}]")
_NAME_BEFORE = re.compile(r"[\w.%+-]{1,64} ?\Z")
_HOST_AFTER = re.compile(r" ?[\w-]{1,63}(?: ?(?:[(\[{] ?(?:dot|DOT) ?[)\]}]|\.) ?[\w-]{1,63}){1,4}")
_MAIL_BEFORE = re.compile(r"[^\s@<>()\[\]\"',;:|]{1,64}\Z")
_MAIL_AFTER = re.compile(r"[\w-]{1,63}(?:\.[\w-]{1,63}){1,8}")
_GROUP = re.compile(r"[0-9]+")
#: Digits of the longest number of any kind.
MOST = 19


def _windows(text: str, a: int, b: int) -> Iterator[Span]:
    """Every window of consecutive digit groups of a run, for each kind its digits fit: at most ``MOST`` windows from a group."""
    groups = [m.span() for m in _GROUP.finditer(text, a, b)]
    for i, (start, _) in enumerate(groups):
        lead = text[start - 1] if start > a else ""
        n = 0
        for j in range(i, len(groups)):
            end = groups[j][1]
            n += end - groups[j][0]
            if n > MOST:
                break
            if j - i == 3 and end - start == n + 3 and text.count(".", start, end) == 3:
                yield 1, start, end
                continue
            closed = text.find(")", start, end) >= 0
            if 9 <= n <= 15:
                yield 3, start - (lead == "+" or (lead == "(" and closed)), end
            if 12 <= n and not closed and text.find("(", start, end) < 0:
                yield 2, start, end


def candidates(text: str) -> list[Span]:
    """Proposed spans, which may overlap: windows of digit groups, and mail addresses."""
    found = set()
    for m in _NUMBER.finditer(text):
        found.update(_windows(text, *m.span()))
    at = text.find("@")
    while at >= 0:
        before, after = _MAIL_BEFORE.search(text[max(0, at - 64) : at]), _MAIL_AFTER.match(text, at + 1)
        if before and after:
            found.add((0, at - len(before.group()), after.end()))
        at = text.find("@", at + 1)
    for m in _SPACED_AT.finditer(text):
        before, after = _NAME_BEFORE.search(text[max(0, m.start() - 65) : m.start()]), _HOST_AFTER.match(text, m.end())
        if before and after:
            found.add((0, m.start() - len(before.group()), after.end()))
    return sorted(found, key=lambda s: (s[1], s[0], s[2]))


def covered(text: str, spans: list[Span]) -> bytearray:
    """A byte for each character: 1 where a span is."""
    marks = bytearray(len(text))
    for _, a, b in spans:
        marks[a:b] = b"\1" * (b - a)
    return marks


def _class(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


_WRITTEN = re.compile(r" ?(?:[(\[{] ?(?:at|AT|dot|DOT) ?[)\]}]|[@.]) ?")
_WORD_BEFORE = re.compile(r"[^\W\d_]+(?=[\W\d_]*\Z)")
#: Cells that the word before a candidate is hashed to.
WORDS = 16


def _plain(kind: int, part: str) -> str:
    """A candidate without what only a rule's own form has.

    That is the "+" and the country code after it of a phone number, and what stands
    between the names of a mail address, written out or not.
    """
    if kind == 0:
        return _WRITTEN.sub(".", part)
    if kind == 3:
        part = re.sub(r"\A\+[0-9]{1,3}[ .\-/]*(?=[ (.\-/])(?=[^0-9]*[0-9]+[^0-9]+[0-9])[ .\-/]*", "", part)
        return part.lstrip("+")
    return part


def features(text: str, span: Span) -> list[float]:
    """Format of the span, and the characters and words around it; nothing that the rule of its kind tests, but for the length of groups."""
    kind, a, b = span
    part = _plain(kind, text[a:b])
    groups = _GROUP.findall(part)
    lengths = [len(g) for g in groups] or [0]
    before, after = text[max(0, a - 24) : a], text[b : b + 24]
    word = _WORD_BEFORE.search(before)
    words = [False] * WORDS
    if word:
        words[crc32(word.group().lower().encode("utf-8", "surrogatepass")) % WORDS] = True
    return [
        kind == 0, kind == 1, kind == 2, kind == 3,
        len(groups), max(lengths), min(lengths), lengths[0], lengths[-1],
        sum(c.isalpha() for c in part), part.count("."), part.count("-"), part.count(" "), part.count("/"),
        "(" in part, part.count("(") == part.count(")"),
        _class(text[a - 1 : a]), _class(text[b : b + 1]),
        sum(c.isalpha() for c in before), sum(c.isalpha() for c in after),
        before.rstrip()[-1:] in ("=", ":", '"', "#"), *words,
    ]


def wrong(span: Span, base: list[Span]) -> bool:
    """Whether an overlapping candidate is a number cut short or run on, so not another form of the confirmed one."""
    return span[0] > 0 and not any(k == 0 and a < span[2] and span[1] < b or k == span[0] and span[2] == b for k, a, b in base)


def run_on(text: str, span: Span) -> Iterator[tuple[str, Span, bool]]:
    """A confirmed card or phone number with a further group of digits after or before it: with that group it is wrong, without it right."""
    kind, a, b = span
    head, part, tail = text[max(0, a - 64) : a], text[a:b], text[b : b + 64]
    more = random.Random(crc32(part.encode()))
    group = "".join(more.choice("0123456789") for _ in range(more.randint(1, 4)))
    made = [(f"{head}{part} {group}{tail}", len(head), len(head))]
    if kind == 2:
        made.append((f"{head}{group} {part}{tail}", len(head) + len(group) + 1, len(head)))
    for other, right, long in made:
        yield other, (kind, right, right + len(part)), True
        yield other, (kind, long, long + len(part) + 1 + len(group)), False


class Model:
    """Trees, and for each kind the score from which a candidate is selected."""

    def __init__(self, trees: Boosted | None, limits: list[float]):
        self.trees, self.limits = trees, limits

    def more(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """The spans to add to each text's base spans."""
        out: list[list[Span]] = [[] for _ in texts]
        where, marks = [], {}
        for i, text in enumerate(texts):
            proposed = candidates(text) if self.trees else []
            if proposed:
                marks[i] = covered(text, base[i])
            where += [(i, s) for s in proposed if self.limits[s[0]] < 1 and 1 not in marks[i][s[1] : s[2]]]
            if len(where) >= ROWS:
                self._select(texts, where, marks, out)
                where, marks = [], {}
        if where:
            self._select(texts, where, marks, out)
        return out

    def _select(self, texts: list[str], where: list[tuple[int, Span]], marks: dict[int, bytearray], out: list[list[Span]]) -> None:
        scores = self.score(texts, where) / np.array([self.limits[s[0]] for _, s in where])
        for k in np.lexsort(([s[1] - s[2] for _, s in where], -scores)).tolist():
            i, span = where[k]
            if scores[k] < 1:
                break
            if 1 not in marks[i][span[1] : span[2]]:
                marks[i][span[1] : span[2]] = b"\1" * (span[2] - span[1])
                out[i].append(span)

    def score(self, texts: list[str], where: list[tuple[int, Span]]) -> np.ndarray:
        """Scores of spans, given with the place of their text, some at a time."""
        parts = [where[at : at + ROWS] for at in range(0, len(where), ROWS)]
        return np.concatenate([self.trees.predict(np.array([features(texts[i], s) for i, s in part], dtype=float)) for part in parts])


#: Cells of a histogram of scores, by log odds from -16 to 16.
CELLS = 1024


def low_limits(seen: np.ndarray, share: float, slack: float, least: int) -> list[float]:
    """For each kind, ``slack`` times the score that ``share`` of its values reach, from histograms (kind, cell); of all kinds' values if it has fewer than ``least``."""
    limits = []
    for cells in seen:
        cells = cells if cells.sum() >= least else seen.sum(axis=0)
        at = np.searchsorted(np.cumsum(cells), (1 - share) * cells.sum(), side="right")
        limits.append(slack / (1 + np.exp(16 - 32 * at / CELLS)))
    return limits


def fit(docs: DataFrame, sample: int = 8000, each: int = 50, least: int = 10, share: float = 0.95, slack: float = 0.5) -> Model:
    """A model from all documents; its trees from at most ``sample`` and, for each kind, an eighth as many that a rule finds it in.

    Sampled are those with the smallest hash of the id, and ``each`` candidates of one.
    The limit of a kind is ``slack`` times the score that ``share`` of its confirmed
    candidates in all documents reach, where trees of the other half of the ids score
    them.  A kind with fewer than ``least`` confirmed candidates has the limit of all kinds together;
    a table without any adds nothing.  Rows without an id or text are not sampled.
    """
    hashed = F.coalesce(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)), F.lit(0)).cast("int").alias("side")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).select("doc_id", "text", hashed)
    width = len(features("", (0, 0, 0)))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            made = [(i, k) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for k in {s[0] for s in base_spans(t or "")}]
            yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.int32())], ["doc_id", "kind"])

    named = rows.where("doc_id IS NOT NULL")
    at = F.xxhash64("doc_id").alias("at")
    first = named.select("doc_id", at).distinct().orderBy("at", "doc_id").limit(sample).select("doc_id")
    order = Window.partitionBy("kind").orderBy("at", "doc_id")
    marked = named.select("doc_id", "text").mapInArrow(held, "doc_id long, kind int").distinct()
    rare = marked.select("doc_id", "kind", at).withColumn("n", F.row_number().over(order)).where(F.col("n") <= -(-sample // 8)).select("doc_id")
    ids = stored(first.union(rare).distinct())

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            made, kinds, confirmed, sides = [], [], [], []
            for text, side in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                base = base_spans(text)
                known, marks, some = set(base), covered(text, base), candidates(text)
                if len(some) > each:
                    some = random.Random(len(text)).sample(some, each)
                for span in some:
                    hit = span in known
                    if not hit and 1 in marks[span[1] : span[2]] and not wrong(span, base):
                        continue  # overlaps a confirmed one: neither class
                    for row in [(text, span, hit), *(run_on(text, span) if hit and span[0] > 1 else ())]:
                        made.append(np.array(features(*row[:2]), "<f4").tobytes())
                        kinds.append(span[0])
                        confirmed.append(row[2])
                        sides.append(side)
            yield pa.RecordBatch.from_arrays(
                [pa.array(made, pa.binary()), pa.array(kinds, pa.int32()), pa.array(confirmed, pa.bool_()), pa.array(sides, pa.int32())], ["x", "kind", "hit", "side"]
            )

    got = rows.join(ids, "doc_id", "left_semi").select("text", "side").mapInArrow(learn, "x binary, kind int, hit boolean, side int").collect()
    got.sort(key=lambda r: (r["kind"], bytes(r["x"]), r["hit"], r["side"]))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), "<f4").astype(float).reshape(len(got), width)
    y, sides = np.array([r["hit"] for r in got], dtype=float), np.array([r["side"] for r in got])
    none = Model(None, [np.inf] * len(KINDS))
    if not y.any():
        return none
    trees = _trees().fit(x, y)
    others = []
    for side in (0, 1):
        other = y[sides != side]
        whole = len(other) and other.any() and (not other.all() or y.all())
        others.append(Model(_trees().fit(x[sides != side], other) if whole else trees, []))
    sent = docs.sparkSession.sparkContext.broadcast(others)

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(KINDS) * CELLS, np.int64)
        for batch in small(batches):
            texts, sides = [t or "" for t in batch.column(0).to_pylist()], batch.column(1).to_pylist()
            where = ([], [])
            for i, text in enumerate(texts):
                base = base_spans(text)
                if base:
                    known = set(base)
                    where[sides[i]].extend((i, s) for s in candidates(text) if s in known)
            for model, own in zip(sent.value, where, strict=True):
                if own:
                    score = np.clip(model.score(texts, own), 1e-9, 1 - 1e-9)
                    cell = np.clip((np.log(score / (1 - score)) + 16) * CELLS / 32, 0, CELLS - 1).astype(np.int64)
                    seen += np.bincount(np.array([s[0] for _, s in own]) * CELLS + cell, minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], ["at", "n"])

    seen = np.zeros(len(KINDS) * CELLS, np.int64)
    for at, n in rows.select("text", "side").mapInArrow(reached, "at int, n long").groupBy("at").agg(F.sum("n")).collect():
        seen[at] = n
    return Model(trees, low_limits(seen.reshape(-1, CELLS), share, slack, least)) if seen.any() else none


def _trees() -> Boosted:
    return Boosted(trees=40, depth=3, rate=0.2, least=3.0)


def find(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``base`` and ``spans``: arrays of (kind, start, end), code points, end exclusive.

    ``base`` are the rules' spans; ``spans`` also has those the model adds, ordered by
    start, then kind.  Of overlapping candidates of equal score the first one counts, as
    the model orders them, so a text has the same spans in every row and rows may
    repeat.  Null and empty texts have none; texts are read whole, but a local part of
    more than 64 characters is no candidate for a written-out address.  All rows and
    columns stay; given columns of the added names are replaced.  An empty table gives
    no rows.
    """
    docs = docs.drop("base", "spans")
    columns, hidden = docs.columns, fresh("text_of", docs.columns)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def named(spans: list[Span]) -> list[dict]:
        return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in small(batches):
            texts = [t or "" for t in batch.column(len(columns)).to_pylist()]
            base = [base_spans(t) for t in texts]
            every = [sorted(b + m, key=lambda s: (s[1], s[0])) for b, m in zip(base, known.more(texts, base), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array([named(b) for b in base], kind), pa.array([named(e) for e in every], kind)],
                [*columns, "base", "spans"],
            )

    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    rows = docs.withColumn(hidden, F.col("text").cast("string"))
    return rows.mapInArrow(run, T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema), T.StructField("base", span), T.StructField("spans", span)]))


def redact(found: DataFrame) -> DataFrame:
    """The documents of ``find`` with each run of overlapping spans replaced by ``[kind]`` of its first span.

    A null text stays null, null ``spans`` count as none, and an empty table gives no
    rows.  Spans that begin at the same place are in the order of ``spans``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            at = batch.schema.get_field_index("text")
            texts = []
            for text, spans in zip(batch.column(at).to_pylist(), batch.column(batch.schema.get_field_index("spans")).to_pylist(), strict=True):
                parts, last = [], 0
                for s in spans or ():
                    if s["start"] >= last:
                        parts += [text[last : s["start"]], f"[{s['kind']}]"]
                    last = max(last, s["end"])
                texts.append(None if text is None else "".join([*parts, text[last:]]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(texts, pa.string()), *batch.columns[at + 1 :]], batch.schema.names)

    return found.withColumn("text", F.col("text").cast("string")).mapInArrow(run, found.withColumn("text", F.col("text").cast("string")).schema)
