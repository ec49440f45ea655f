import os
from collections import Counter

import pytest

import corpus_pipeline
from tallyforge.llm import decontaminate, langid

from . import cases
from .test_decontaminate import distance
from .test_line_dedup import by_hand as lines_by_hand
from .test_simhash import expected_components

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "simhash_dedup", "benchmark_decontamination", "best_fit_packing"]

    def step(name, given):
        made = corpus_pipeline.stored(stages[name](spark, given, SF))
        assert name == "best_fit_packing" or made.columns == columns
        return made

    kept = step("language_id", docs)
    model = langid.fit(docs)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in docs.collect() if not model.predict(r["text"])[2])

    before = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    kept = step("line_dedup", kept)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter((i, t) for (i, _, _, t), n in lines_by_hand(before, 20, 3).items() for _ in range(n))

    before = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    kept = step("simhash_dedup", kept)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({c for _, _, c in expected_components(before)})

    items = [decontaminate.words_in(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    known = {w for item in items for w in item}
    clean = set()
    for r in kept.collect():
        words = decontaminate.words_in(r["text"])
        if sum(w in known for w in words) < 10 or not any(distance(i, words) <= int(0.2 * len(i) + 1e-9) for i in items if likely(i, words)):
            clean.add(r["doc_id"])
    kept = step("benchmark_decontamination", kept)
    assert {r["doc_id"] for r in kept.collect()} == clean

    packed = step("best_fit_packing", kept).collect()
    assert {r["doc_id"] for r in packed} == clean
    assert max(sum(r["length"] for r in packed if r["sequence_id"] == s) for s in {r["sequence_id"] for r in packed}) <= 2048


def likely(item, words):
    """A match has four fifths of the item's words."""
    return sum((Counter(item) & Counter(words)).values()) >= 0.8 * len(item) - 1e-9


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = cases.clashing(cases.documents(spark))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)))
        assert docs.columns == columns
    assert 0 < docs.count() < len(cases.rows())
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []
