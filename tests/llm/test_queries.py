"""Registered corpus queries against their SQL, and what they promise of their columns."""

import os

import duckdb
import pytest

from tallyforge.llm import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

COLUMNS = {
    1: ["doc_id", "fingerprint", "component_id"],
    2: ["query_id", "rank", "vec_id", "score"],
    3: ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    4: ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    5: ["doc_id", "held_out", "lang_pred", "score", "rejected"],
    6: ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    7: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    8: ["doc_id", "item_id", "edits", "item_words"],
    9: ["doc_id", "n_words", "n_removed", "kept_sha256"],
    10: ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    11: ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    12: ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    13: ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
}


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    found = catalog.QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(COLUMNS[int(name[2:].split("_")[0])])
    rows = found.collect()
    assert rows
    if name in catalog.SQL:
        con = duckdb.connect()
        for t in ("documents", "embeddings", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        cursor = con.execute(catalog.SQL[name])
        order = [found.columns.index(c[0]) for c in cursor.description]
        assert sorted(tuple(r[i] for i in order) for r in rows) == sorted(cursor.fetchall())
