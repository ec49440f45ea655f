from collections import Counter, defaultdict

import pytest

from tallyforge.llm import line_dedup

from . import cases

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def by_hand(rows, least, most):
    holders = defaultdict(list)
    for i, t, *_ in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= least:
                holders[k].append(i)
    keeper = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= most}
    out = Counter()
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out[i, len(lines), len(lines) - len(stay), "\n".join(stay)] += 1
    return out


@pytest.mark.parametrize(("least", "most", "bits"), [(20, 3, 1 << 20), (3, 2, 1 << 20), (1, 2, 1 << 15), (20, 3, 1 << 15)])
def test_against_brute_force(spark, least, most, bits):
    docs = cases.clashing(cases.documents(spark))
    found = line_dedup.drop_lines(docs, least, most, bits)
    assert set(docs.columns) <= set(found.columns)
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in found.collect()) == by_hand(cases.rows(), least, most)


def test_lines_without_a_document_id(spark):
    line = "a line without any owner at all"
    rows = [(None, line, None, None, None)] * 3 + [(1, "other", None, None, None)]
    found = line_dedup.drop_lines(cases.documents(spark, rows))
    assert sum(r["n_dropped"] for r in found.collect()) == 0


def test_rows_of_one_id_or_without_any_are_no_group(spark):
    shared = ["a line that very many rows hold", "another line of many rows, too"]
    rows = [(None if i % 3 else 4, f"{shared[i % 2]}\nown line number {i} of this row\n{shared[1]}", None, None, None) for i in range(300)]
    rows += [(i, shared[i % 2], None, None, None) for i in range(50)]
    found = line_dedup.drop_lines(cases.documents(spark, rows))
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in found.collect()) == by_hand(rows, 20, 3)


def test_a_line_counts_code_points(spark):
    rows = [(i, "é" * 19, None, None, None) for i in range(3)] + [(i, "é" * 20, None, None, None) for i in range(3, 6)]
    found = line_dedup.drop_lines(cases.documents(spark, rows))
    assert sorted((r["doc_id"], r["n_dropped"]) for r in found.collect()) == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 0)]


def test_empty(spark):
    assert line_dedup.drop_lines(cases.documents(spark, [])).collect() == []
