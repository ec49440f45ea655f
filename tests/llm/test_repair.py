import hashlib
import random
import zlib
from collections import Counter

import pytest

from tallyforge.llm import repair

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"
#: (state, role) -> state of `(s?(ua)+)?`; 0 and 3 may end.
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if way == 1:
            text = ""
        if way == 2:
            text = "".join(c for c in text if c not in ".!?")
        if way == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    return out


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        body = text.strip(SPACE)
        found.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def edits(rows, found, at):
    """(edit, cost, role that is put out or None) for row ``at``."""
    ways = [("D", 2, None)]
    if found[at] not in ("blank", "duplicate"):
        extra = 5 if found[at] else 0
        ways += [("K", extra, rows[at][2][:1]), ("R", 1 + extra, "u"), ("R", 1 + extra, "a")]
    return ways


def exhaustive(rows, found):
    """The least (cost, audit) of all sequences of edits."""
    best = (2 * len(rows), "D" * len(rows))

    def go(at, state, cost, audit):
        nonlocal best
        if cost > best[0]:
            return
        if at == len(rows) and state in (0, 3):
            best = min(best, (cost, audit))
        for role in "ua":
            if (state, role) in MOVES:
                go(at, MOVES[state, role], cost + 5, audit + "I")
        if at < len(rows):
            for edit, price, role in edits(rows, found, at):
                if role is None:
                    go(at + 1, state, cost + price, audit + edit)
                elif (state, role) in MOVES:
                    go(at + 1, MOVES[state, role], cost + price, audit + edit)

    go(0, 0, 0, "")
    return best


def by_states(rows, found):
    """The same row by row, keeping the best of each state."""

    def inserted(ways):
        for _ in range(2):
            for state, (cost, audit) in list(ways.items()):
                for role in "ua":
                    if (state, role) in MOVES:
                        to = MOVES[state, role]
                        ways[to] = min(ways.get(to, (10**9, "")), (cost + 5, audit + "I"))
        return ways

    ways = inserted({0: (0, "")})
    for at in range(len(rows)):
        new = {}
        for state, (cost, audit) in ways.items():
            for edit, price, role in edits(rows, found, at):
                to = state if role is None else MOVES.get((state, role))
                if to is not None:
                    new[to] = min(new.get(to, (10**9, "")), (cost + price, audit + edit))
        ways = inserted(new)
    return min(ways[s] for s in (0, 3) if s in ways)


def applied(rows, audit):
    left, out, expected = iter(rows), [], "user"
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)[2:]
        if edit == "D":
            continue
        if edit != "K":
            role = expected
        if role[:1] in "ua":
            expected = "assistant" if role[:1] == "u" else "user"
        out.append(f"{role}:{text}")
    return "\n".join(out)


def by_hand(given, damaged=True, search=exhaustive):
    out = Counter()
    left = damage(given) if damaged else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in given]
    for conv in {r[0] for r in given}:
        rows = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        found = faults(rows)
        turns = {r[1] for r in rows if r[1] is not None}
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit = search(rows, found)
        kinds = Counter(found)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256(applied(rows, audit).encode()).hexdigest()
        out[conv, gaps, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, audit, digest] += 1
    return out


def conversations(seed, n, longest):
    rnd = random.Random(seed)
    texts = ["Yes.", "no", "What?", " ", "", None, "Go on!\n", "é", "Fine. \t"]
    rows = []
    for conv in range(n):
        turn = 0
        for at in range(rnd.randint(1, longest)):
            turn += rnd.choice([1, 1, 1, 2])
            role = rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]) if rnd.random() < 0.5 else ("user", "assistant")[at % 2]
            text = rnd.choice(texts) if rnd.random() < 0.5 else f"Number {rnd.random()}."
            rows.append((conv if conv else None, turn if rnd.random() < 0.9 else rnd.choice([None, 2]), role, text))
    return rows


def collected(table):
    return Counter(tuple(r) for r in table.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_sequence_of_edits(spark, seed):
    rows = conversations(seed, 150, 5)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert collected(repair.repaired_after_damage(table)) == by_hand(rows)
    assert collected(repair.repaired(table)) == by_hand(rows, damaged=False)
    assert by_hand(rows, search=by_states) == by_hand(rows)


def test_long_conversations(spark):
    rows = conversations(3, 3, 1500)
    rows += [(7, i, "user", "" if i % 3 else f"Text {i}.") for i in range(3000)]
    rows += [(8, i, "system", "the same") for i in range(2000)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert collected(repair.repaired_after_damage(table)) == by_hand(rows, search=by_states)


def test_open_rows_stay_few():
    one = repair.Repair()
    for i in range(20_000):
        one.row(("user", "assistant")[i % 2] if i % 11 else "system", f"Text {i}.", i % 13 == 0)
        assert len(one.marks) <= 600
    assert len(one.finish()[1]) >= 20_000


def test_every_row_dropped_and_empty(spark):
    turn = next(t for t in range(999) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    found = repair.repaired_after_damage(spark.createDataFrame([(5, turn, "user", "Hi.")], SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair.repaired_after_damage(spark.createDataFrame([], SCHEMA)).collect() == []


def test_further_columns(spark):
    rows = conversations(4, 20, 4)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS fault", "2 AS seen", "3 AS way", "4 AS copy", "5 AS gaps", "6 AS cost")
    assert collected(repair.repaired_after_damage(table)) == by_hand(rows)


def test_grammar_tables():
    shifts, reductions = repair.tables()
    assert len(shifts) == 9 and all(len(rules) == 1 for state in reductions for rules in state.values())


def test_conversations_longer_than_an_arrow_batch(spark):
    rows = [(c, i, ("user", "assistant")[i % 2], f"Turn {c} {i}.") for c in range(3) for i in range(12_000)]
    assert collected(repair.repaired(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows, damaged=False, search=lambda r, f: (0, "K" * len(r)))


def test_ties_take_the_least_audit(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "assistant", "C.")]
    assert exhaustive([(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "assistant", "C.")], [None] * 3) == (2, "DKK")
    assert [(r["cost"], r["audit"]) for r in repair.repaired(spark.createDataFrame(rows, SCHEMA)).collect()] == [(2, "DKK")]


