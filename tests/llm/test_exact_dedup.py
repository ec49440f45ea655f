import hashlib
from collections import Counter, defaultdict

import pytest

from tallyforge.llm import exact_dedup

from . import cases


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def by_hand(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[lower(t)].append(i)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known, default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for at, i in enumerate(sorted(ids, key=lambda i: i != keep)):
            out[i, keep, len(ids), at == 0, digest] += 1
    return out


def marks(found):
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in found.collect())


def copies():
    made = cases.rows()
    made += [(900 + i, "A text that many Hold, and it is longer than a block.".swapcase() if i % 2 else "a TEXT that many hOLD, AND IT IS LONGER THAN A BLOCK.", None, None, None) for i in range(60)]
    return [*made, (900, made[-2][1], "en", None, None), (None, made[-1][1], None, None, None), (5000, "É", None, None, None), (5001, "é", None, None, None)]


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_against_brute_force(spark, block):
    docs = cases.clashing(cases.documents(spark, copies())).selectExpr("*", "1 AS row", "2 AS pos", "3 AS name", "4 AS kept")
    assert marks(exact_dedup.exact_duplicates(docs, block)) == by_hand(copies())


def test_another_print_if_two_blocks_share_one(spark, monkeypatch):
    tried, real = [], exact_dedup.print_of

    def weak(column, attempt):
        tried.append(attempt)
        return ("0L", f"octet_length({column}) * 1L") if attempt < 2 else real(column, attempt)

    monkeypatch.setattr(exact_dedup, "print_of", weak)
    assert marks(exact_dedup.exact_duplicates(cases.documents(spark), 16)) == by_hand(cases.rows())
    assert tried == [0, 1, 2]


def test_texts_that_differ_in_one_block_or_in_length_only(spark):
    texts = ["x" * 64, "x" * 63, "x" * 65, "x" * 128, "x" * 32 + "y" + "x" * 31, "y" + "x" * 63, "x" * 63 + "y", "x" * 64, ""]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    assert marks(exact_dedup.exact_duplicates(cases.documents(spark, rows), 8)) == by_hand(rows)


def test_one_of_each_keeps_columns_and_one_row_a_group(spark):
    docs = cases.documents(spark, copies()).selectExpr("*", "source AS row", "n_chars AS name")
    kept = exact_dedup.one_of_each(docs, 16)
    assert kept.columns == docs.columns
    want = Counter((r[0], r[4]) for r in by_hand(copies()).elements() if r[3])
    assert Counter((r["doc_id"], hashlib.sha256(lower(r["text"]).encode()).hexdigest()) for r in kept.collect()) == want


def test_empty(spark):
    assert exact_dedup.exact_duplicates(cases.documents(spark, [])).collect() == []
    assert exact_dedup.one_of_each(cases.documents(spark, [])).collect() == []
