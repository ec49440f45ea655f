import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyforge.llm import packing
from tallyforge.llm.catalog import word_tokenizer

from . import cases

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def as_bytes(numbers):
    return np.array(numbers, dtype="<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("abcdeTHINGéüßÀ.,'|<>123 \n\t\x1c\x85", max_size=80)))
def test_same_ids_as_the_tokenizer(text):
    assert packing.word_tokenizer(PATH).encode(text) == as_bytes(ids(text))


@pytest.mark.parametrize("text", ["a<|endoftext|>b <|startoftext|>", "don't I'll WE'RE 's", "ẞ ﬁ ̈a é", "x" * 5000, "﻿a​b", "<| |>", "日本語 test ١٢"])
def test_odd_words(text):
    assert packing.word_tokenizer(PATH).encode(text) == as_bytes(ids(text))


def test_other_tokenizers():
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.word_tokenizer(path).merge is None


def test_pieces(spark):
    docs = cases.clashing(cases.documents(spark))
    found = defaultdict(list)
    for r in packing.token_pieces(docs, PATH, size=64).collect():
        found[r["doc_id"]].append(r)
    expected = Counter()
    for i, t, *_ in cases.rows():
        whole = [*ids(t), 0]
        for n, at in enumerate(range(0, len(whole), 64)):
            expected[i, n, at, len(whole[at : at + 64]), as_bytes(whole[at : at + 64])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for rs in found.values() for r in rs) == expected


def sums_of_squares(lengths, size):
    """The rule, by trying every open bin."""
    bins = []
    for n in lengths:
        best = None
        for b, used in enumerate(bins):
            if used + n <= size:
                after = Counter(u + n * (i == b) for i, u in enumerate(bins))
                cost = sum(c * c for u, c in after.items() if u < size)
                if best is None or (cost, -used) < best[:2]:
                    best = (cost, -used, b)
        if best is None:
            bins.append(n)
        else:
            bins[best[2]] += n
    return bins


@pytest.mark.parametrize("seed", range(4))
def test_placing_follows_the_rule(seed):
    rnd = random.Random(seed)
    lengths = [rnd.randint(1, 20) for _ in range(120)]
    bins, offsets = packing.place(np.array(lengths), 20)
    full = Counter()
    for b, o, n in zip(bins.tolist(), offsets.tolist(), lengths, strict=True):
        assert full[b] == o
        full[b] += n
    assert sorted(full.values()) == sorted(sums_of_squares(lengths, 20))


def test_packs_tightly_and_leaves_none_out(spark):
    docs = cases.documents(spark)
    rows = packing.packed_digest(docs, word_tokenizer, size=128).collect()
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    total = sum(r["length"] for r in rows)
    assert total == sum(len(ids(t)) + 1 for _, t, *_ in cases.rows())
    assert len(by_sequence) <= total / 128 * 1.05 + 1


def test_shards_do_not_share_sequences(spark):
    pieces = spark.range(500).selectExpr("id AS doc_id", "id % 90 + 1 AS length")
    packed = packing.pack(pieces, 100, shard_rows=60)
    sums = packed.groupBy("sequence_id").agg({"length": "sum", "offset": "max"}).collect()
    assert packed.count() == 500 and max(r["sum(length)"] for r in sums) <= 100


def test_sequences_hold_the_ids(spark):
    packed = packing.pack(packing.token_pieces(cases.documents(spark), PATH, size=128), 128)
    found = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        part = found[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        assert zlib.crc32(part) == zlib.crc32(bytes(r["ids"]))


def test_bad_lengths_and_empty(spark):
    with pytest.raises(Exception, match="1 to 10 ids"):
        packing.pack(spark.createDataFrame([(1, 11)], "doc_id long, length long"), 10).collect()
    assert packing.packed_digest(cases.documents(spark, []), PATH).collect() == []


def test_clashing_names_and_equal_rows(spark):
    pieces = spark.range(3000).selectExpr("7 AS doc_id", "5 AS length", "1 AS _order", "2 AS _shard", "3 AS order_of", "4 AS shard_of", "5 AS Shard_Of_", "6 AS sequence_id")
    packed = packing.pack(pieces, 100, shard_rows=100)
    assert packed.columns == ["doc_id", "length", "_order", "_shard", "order_of", "shard_of", "Shard_Of_", "sequence_id", "offset"]
    rows = packed.collect()
    sums = Counter()
    for r in rows:
        sums[r["sequence_id"]] += r["length"]
    assert len(rows) == 3000 and max(sums.values()) <= 100 and len({r["shard_of"] for r in rows}) == 1
    # 30 shards: none has much more than its part of the equal rows.
    assert max(Counter(s % 30 for s in (r["sequence_id"] for r in rows)).values()) < 200
