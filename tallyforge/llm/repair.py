"""Conversation repair by generalised LR parsing with edits.

The roles of a sound conversation are words of a small grammar: nothing, or an
optional system turn and pairs of user and assistant turns.  A row can be kept,
deleted, or given another role, and turns can be inserted, each at a cost.  The parser
follows all of these at once.  Its stacks share their lower parts, and stacks with
equal tops and equal lower parts are one entry with the least (cost, audit); the audit
is the initials of the edits so far.  Insertions are tried right before a row that
stays and at the end only: an insertion followed by a deletion costs as much the other
way round, and that audit is smaller.

Memory does not grow with a conversation's texts.  Entries that cost much more than
the best one cannot win and are dropped, so the rest soon agree on all but the last
rows; rows all agree on are written to the digest and forgotten.  Rows that must be
deleted are only counted.

A conversation is read in order by one task, as its digest is one hash over all of it:
its rows come sorted (Spark spills while sorting) and are streamed.  Rows that occurred
before are found by the sort, too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small

#: Rules of the role grammar, the first one's left side is the start; roles by their initials.
GRAMMAR = (("C", ""), ("C", "Q"), ("Q", "Hua"), ("Q", "Qua"), ("H", ""), ("H", "s"))
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
END = "$"
#: Two insertions at most complete an entry's last pair, one starts that of another, and one deletion
#: stands for a system turn that the other could keep: an entry dearer by more cannot win.
SLACK = 3 * INSERT + DELETE

_FOUND = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


@cache
def tables(grammar: tuple[tuple[str, str], ...] = GRAMMAR) -> tuple[list[dict[str, int]], list[dict[str, list[int]]]]:
    """SLR tables: by state, the next state for each symbol, and the rules to reduce for each look-ahead."""
    heads = {head for head, _ in grammar}
    rules = [("^", grammar[0][0]), *grammar]
    empty = {h for h, body in rules if not body}
    while more := {h for h, body in rules if h not in empty and all(x in empty for x in body)}:
        empty |= more
    first: dict[str, set[str]] = {h: set() for h in heads}
    follow: dict[str, set[str]] = {h: {END} if h == grammar[0][0] else set() for h in heads}
    changed = True
    while changed:
        before = sum(map(len, [*first.values(), *follow.values()]))
        for head, body in grammar:
            after = set(follow[head])
            for x in reversed(body):
                if x in heads:
                    follow[x] |= after
                    after = first[x] | (after if x in empty else set())
                else:
                    after = {x}
            for x in body:
                first[head] |= first.get(x, {x})
                if x not in empty:
                    break
        changed = sum(map(len, [*first.values(), *follow.values()])) > before

    def closed(items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            for i, (head, _) in enumerate(rules):
                if rules[rule][1][dot : dot + 1] == head and (i, 0) not in items:
                    items.add((i, 0))
                    todo.append((i, 0))
        return frozenset(items)

    states, shifts, reductions = [closed({(0, 0)})], [], []
    for state in states:  # grows meanwhile
        moves: dict[str, set[tuple[int, int]]] = {}
        done: dict[str, list[int]] = {}
        for rule, dot in sorted(state):
            head, body = rules[rule]
            if dot < len(body):
                moves.setdefault(body[dot], set()).add((rule, dot + 1))
            else:
                for t in sorted(follow.get(head, END)):
                    done.setdefault(t, []).append(rule)
        to = {}
        for x, items in moves.items():
            if (new := closed(items)) not in states:
                states.append(new)
            to[x] = states.index(new)
        shifts.append(to)
        reductions.append(done)
    return shifts, reductions


#: A stack is its top state and the stack below; frontiers have the least (cost, audit) of each.
Stack = tuple[int, "Stack | None"]
Frontier = dict[Stack, tuple[int, str]]


def _put(frontier: Frontier, stack: Stack, weight: tuple[int, str]) -> bool:
    if stack in frontier and frontier[stack] <= weight:
        return False
    frontier[stack] = weight
    return True


def _reduced(frontier: Frontier, ahead: str) -> Frontier:
    """The stacks with all reductions that the look-ahead allows."""
    shifts, reductions = tables()
    out = dict(frontier)
    todo = list(frontier)
    while todo:
        stack = todo.pop()
        for rule in reductions[stack[0]].get(ahead, []):
            if rule == 0:
                continue
            head, body = GRAMMAR[rule - 1]
            below = stack
            for _ in body:
                below = below[1]
            new = (shifts[below[0]][head], below)
            if _put(out, new, out[stack]):
                todo.append(new)
    return out


def _shifted(frontier: Frontier, role: str, cost: int, edit: str) -> Frontier:
    shifts, out = tables()[0], {}
    for stack, (spent, audit) in _reduced(frontier, role).items():
        if role in shifts[stack[0]]:
            _put(out, (shifts[stack[0]][role], stack), (spent + cost, audit + edit))
    return out


def _merged(*frontiers: Frontier) -> Frontier:
    out: Frontier = {}
    for frontier in frontiers:
        for stack, weight in frontier.items():
            _put(out, stack, weight)
    return out


def _pruned(frontier: Frontier) -> Frontier:
    most = min(cost for cost, _ in frontier.values()) + SLACK
    return {stack: weight for stack, weight in frontier.items() if weight[0] <= most}


def _inserted(frontier: Frontier) -> Frontier:
    """The frontier with every useful run of insertions after it."""
    whole = new = frontier
    while new:
        grown = _merged(*(_shifted(new, role, INSERT, "I") for role in ROLES))
        better = _pruned(_merged(whole, grown))
        new = {s: w for s, w in better.items() if whole.get(s) != w}
        whole = better
    return whole


class Repair:
    """One conversation: rows go in by order, cost, audit and digest come out."""

    def __init__(self) -> None:
        self.frontier: Frontier = {(0, None): (0, "")}
        self.forced = 0  # deletions that every entry still has to take
        self.rows: list[tuple[str, str]] = []  # those whose edit is open, without forced deletions
        self.marks: list[bool] = []  # the open rows in order: is it one of ``rows``?
        self.audit: list[str] = []
        self.settle_at = 256
        self.next_role = "u"
        self.digest, self.any = hashlib.sha256(), False

    def delete(self) -> None:
        """A row that must go."""
        self.forced += 1

    def row(self, role: str, text: str, truncated: bool) -> None:
        self._take_forced()
        extra, initial = TRUNCATED if truncated else 0, role[:1]
        ready = _inserted(self.frontier)
        ways = [{s: (cost + DELETE, audit + "D") for s, (cost, audit) in self.frontier.items()}]
        if initial in "sua" and initial:
            ways.append(_shifted(ready, initial, KEEP + extra, "K"))
        ways += [_shifted(ready, to, REROLE + extra, "R") for to in ROLES]
        self.frontier = _pruned(_merged(*ways))
        self.rows.append((role, text))
        self.marks.append(True)
        if len(self.marks) >= self.settle_at:
            self._settle(commonprefix([audit for _, audit in self.frontier.values()]))
            self.settle_at = max(256, 2 * len(self.marks))

    def finish(self) -> tuple[int, str, str]:
        self._take_forced()
        shifts, reductions = tables()
        ends = _reduced(_inserted(self.frontier), END)
        cost, audit = min(w for stack, w in ends.items() if 0 in reductions[stack[0]].get(END, []))
        self.frontier = {(0, None): (cost, audit)}
        self._settle(audit)
        return cost, "".join(self.audit), self.digest.hexdigest()

    def _take_forced(self) -> None:
        if n := self.forced:
            self.frontier = {s: (cost + n * DELETE, audit + "D" * n) for s, (cost, audit) in self.frontier.items()}
            self.marks += [False] * n
            self.forced = 0

    def _settle(self, agreed: str) -> None:
        """Writes the edits that all entries share."""
        self.audit.append(agreed)
        self.frontier = {s: (cost, audit[len(agreed) :]) for s, (cost, audit) in self.frontier.items()}
        marks, rows = iter(self.marks), iter(self.rows)
        used = taken = 0
        for edit in agreed:
            role, text = "", ""
            if edit != "I":
                used += 1
                if next(marks):
                    taken += 1
                    role, text = next(rows)
            if edit == "D":
                continue
            if edit != "K":
                role = ROLES[self.next_role]
            if role[:1] in ROLES:
                self.next_role = "a" if role[:1] == "u" else "u"
            self.digest.update(("\n" if self.any else "").encode() + f"{role}:{text}".encode())
            self.any = True
        del self.marks[:used], self.rows[:taken]


class _Conversation:
    """The facts of a conversation while its rows go by."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.repair = conv_id, Repair()
        self.first = self.last = self.role = None
        self.turns = self.illegal = self.cost = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def add(self, turn: int | None, role: str, text: str | None, fault: str | None) -> None:
        if turn is not None and (self.last is None or turn != self.last):
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if self.role is not None and self.role[:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = role
        if fault:
            self.faults[fault] += 1
        if fault in ("blank", "duplicate"):
            self.repair.delete()
        else:
            self.repair.row(role, text, fault == "truncated")

    def found(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, *self.repair.finish())


def judged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, fault`` of rows ``(conv_id, turn, role, text)``, sorted within partitions that hold whole conversations.

    Order is by turn, nulls first, then role and text (by their bytes).  A row's first
    fault of blank, duplicate and truncated counts.  The text of blank and duplicate
    rows is left out.  A row without a role only names its conversation.
    """
    within = Window.partitionBy("conv_id", "role", "text").orderBy("turn")
    last = r"right(trim(TRAILING ' \t\n\u000B\u000C\r' FROM text), 1)"
    fault = f"CASE WHEN role IS NULL THEN NULL WHEN {last} = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN {last} NOT IN ('.', '!', '?') THEN 'truncated' END"
    return (
        rows.repartition("conv_id")
        .withColumn("seen", F.row_number().over(within))
        .withColumn("fault", F.expr(fault))
        .sortWithinPartitions("conv_id", F.expr("role IS NOT NULL"), "turn", "role", "text", "seen")
        .selectExpr("conv_id", "turn", "role", "CASE WHEN fault IN ('blank', 'duplicate') THEN NULL ELSE text END AS text", "fault")
    )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _FOUND.split(", ")])
    now, done = None, []
    for batch in small(batches):
        for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if now is None or row[0] != now.conv_id:
                if now:
                    done.append(now.found())
                now = _Conversation(row[0])
            if row[2] is not None:
                now.add(*row[1:])
        if len(done) >= 512:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema)
            done = []
    if now:
        done.append(now.found())
    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema)


def _plain(table: DataFrame) -> DataFrame:
    """The four columns, nulls of role and text as one space."""
    return table.selectExpr(
        "CAST(conv_id AS LONG) AS conv_id", "CAST(turn AS LONG) AS turn",
        "coalesce(CAST(role AS STRING), ' ') AS role", "coalesce(CAST(text AS STRING), ' ') AS text",
    )


def repaired(conversations: DataFrame) -> DataFrame:
    """One row for each conversation: its gaps and faults, the cheapest repair's cost, audit and digest.

    gaps is the number of missing turns between the smallest and the largest; blank,
    duplicate and truncated count rows by their first fault; illegal counts neighbours
    whose roles' initials are not su, ua or au.  The repair keeps (K, 0), re-roles to
    user or assistant (R, 1), deletes (D, 2; blank and duplicate rows always) and
    inserts empty turns (I, 5), a truncated row that stays costs 5 more, so that the
    roles' initials are nothing or pairs of u and a, with one s before them or none.  Of
    the cheapest repairs that with the least audit is taken.  repaired_sha256 is over
    ``role:text`` of what is left, joined by newlines.

    A null role or text is one space, so such a text is blank and such a role can only
    be changed or deleted.  Null turns come first and do not count for gaps; rows of one
    turn are in order of role and text, equal rows are duplicates.  Rows without a
    conv_id are one conversation.  Texts of any length are read whole; further columns
    are not read.  An empty table gives no rows.
    """
    return _repaired(_plain(conversations))


def _repaired(rows: DataFrame) -> DataFrame:
    return judged(rows).mapInArrow(_streamed, _FOUND)


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with damage that the CRC-32 of ``conv_id:turn`` chooses, modulo 20.

    0 drops the row (its conversation stays with a row whose turn, role and text are
    null), 1 empties the text, 2 removes its full stops, question and exclamation
    marks, 3 repeats the row, 4 makes it a user's.  Any null counts as one space.
    """
    chosen = "crc32(CAST(concat(coalesce(CAST(conv_id AS STRING), ' '), ':', coalesce(CAST(turn AS STRING), ' ')) AS BINARY)) % 20"
    return (
        _plain(conversations)
        .selectExpr("*", f"{chosen} AS way")
        .selectExpr("*", "explode(CASE WHEN way = 3 THEN array(1, 2) ELSE array(1) END) AS copy")
        .selectExpr(
            "conv_id", "CASE WHEN way <> 0 THEN turn END AS turn",
            "CASE way WHEN 0 THEN NULL WHEN 4 THEN 'user' ELSE role END AS role",
            "CASE way WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text",
        )
    )


def repaired_after_damage(conversations: DataFrame) -> DataFrame:
    """``repaired`` of the damaged conversations; one without any row left has zeros, an empty audit and the digest of nothing."""
    return _repaired(damaged(conversations))
