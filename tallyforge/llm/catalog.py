"""Registered queries of the corpus operators and the SQL they are checked against.

A query applies its operator to a whole table and derives the digest columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, langid, line_dedup, lm_score, merkle, packing, pii, repair, simhash, substring_dedup, suffix_dedup, topk
from .common import LOWER_LETTERS, UPPER_LETTERS, lowered, table, texts

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(run: Run) -> Run:
    QUERIES[run.__name__] = run
    return run


@query
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.selectExpr("doc_id", f"{simhash.hex_of('fp')} AS fingerprint", "component_id")


@query
def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    found = topk.top_k(vectors, vectors.where("id % 100 = 0"), k=10)
    return found.selectExpr("query_id", "CAST(rank AS int) AS rank", "vec_id", "score")


SQL["op2_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.vec, v.vec) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_lines(texts(table(spark, sf_dir, "documents")), least=20, min_docs=3)
    return kept.selectExpr("doc_id", "n_lines", "n_dropped", "sha2(text, 256) AS kept_sha256")


SQL["op3_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
gone AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (SELECT keyed.*, keeper IS NOT NULL AND doc_id <> keeper AS drops FROM keyed LEFT JOIN gone USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drops) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT drops), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), folds=7, held_out=2)


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs, folds=4, fold=2))
    return found.selectExpr(
        "doc_id", "crc32(CAST(coalesce(CAST(doc_id AS string), '') AS binary)) % 4 = 2 AS held_out", "lang_pred", "score", "rejected"
    )


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digest(table(spark, sf_dir, "documents"), word_tokenizer, size=2048)


@query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), similarity=0.8)
    return found.selectExpr("doc_id", "explode(hits) AS hit").selectExpr("doc_id", "hit.item_id", "hit.edits", "hit.item_words")


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), size=50)
    return kept.selectExpr("doc_id", "n_words", "n_removed", "sha2(text, 256) AS kept_sha256")


SQL["op9_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
),
spots AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS pos FROM w WHERE len(words) >= 50),
windows AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 49], ' ') AS seq FROM spots),
first AS (SELECT seq, min(doc_id) AS low FROM windows GROUP BY seq),
gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos
  FROM (SELECT windows.doc_id, pos FROM windows JOIN first USING (seq) WHERE low < windows.doc_id), range(50) AS r(k)
),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w),
marked AS (SELECT placed.*, gone.pos IS NOT NULL AS drops FROM placed LEFT JOIN gone ON gone.doc_id = placed.doc_id AND gone.pos = placed.pos)
SELECT w.doc_id, len(words) AS n_words, coalesce(removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN (
  SELECT doc_id, count(*) FILTER (WHERE drops) AS removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT drops) AS kept
  FROM marked GROUP BY doc_id
) AS m ON m.doc_id = w.doc_id
"""


def _written(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs)).drop("text")
    counts = [f"CAST(size(filter(base, s -> s.kind = '{k}')) AS long) AS n_{k}" for k in pii.KINDS]
    return found.selectExpr("doc_id", *counts, f"sha2({_written('base')}, 256) AS base_sha256", f"{_written('spans')} AS spans")


@query
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), size=400)
    return kept.selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) AS kept_sha256")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_after_damage(table(spark, sf_dir, "conversations"))


@query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


SQL["op12_exact_dedup"] = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER_LETTERS}', '{LOWER_LETTERS}') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)
"""


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = f"CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 0 THEN {lowered('text')} ELSE text END"
    found = merkle.manifest(table(spark, sf_dir, "documents"), found={"text": tampered})
    proof = "sha2(array_join(transform(steps, s -> concat(s.left, s.right)), ''), 256)"
    folded = found.selectExpr("doc_id", "leaf", "subroot", "root", f"{proof} AS proof_sha256", f"{merkle.fold('found_leaf')} AS folded_root")
    return folded.selectExpr("*", "folded_root = root AS verified")


def _crc32(text: str) -> str:
    """DuckDB SQL of the CRC-32 of a text of ASCII digits, bit by bit."""
    bits = f"""list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, n: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END))"""
    return f"xor({bits}, 4294967295::UBIGINT)"


def _merkle_sql(height: int = 7) -> str:
    """The manifest in SQL, for groups of up to 8 ** height leaves and 8 ** 2 groups; a level is a step of the query."""

    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)]
        return f"sha256({' || '.join(parts)})"

    tampered = f"CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN translate(text, '{UPPER_LETTERS}', '{LOWER_LETTERS}') ELSE text END"
    steps = [f"""n0 AS MATERIALIZED (SELECT coalesce('=' || lang, '') AS g, doc_id, {leaf('text')} AS leaf, {leaf(tampered)} AS fold, '' AS proof,
                        row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n, '' AS tree FROM documents),
                 v0 AS (SELECT g, i, n, leaf AS h FROM n0)"""]

    def levels(nodes: str, rows: str, group: str, last: int) -> None:
        """Reduces ``nodes`` (group, i, n, h) and moves ``rows`` (its fold and proof) up with them."""
        for k in range(last):
            left, right = (f"coalesce((SELECT string_agg(h, '' ORDER BY x.i) FROM {nodes}{k} AS x WHERE x.g = r.{group} AND x.i // 8 = r.i // 8 AND x.i {o} r.i), '')" for o in "<>")
            steps.append(f"""{rows}{k}s AS MATERIALIZED (SELECT r.*, {left} AS l, {right} AS rt FROM {rows}{k} AS r),
                {rows}{k + 1} AS MATERIALIZED (SELECT * EXCLUDE (l, rt) REPLACE (
                    CASE WHEN n = 1 THEN fold ELSE sha256(l || fold || rt) END AS fold, CASE WHEN n = 1 THEN proof ELSE proof || l || rt END AS proof,
                    i // 8 AS i, (n + 7) // 8 AS n) FROM {rows}{k}s),
                {nodes}{k + 1} AS MATERIALIZED (SELECT g, i // 8 AS i, (max(n) + 7) // 8 AS n,
                    CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {nodes}{k} GROUP BY g, i // 8)""")

    levels("v", "n", "g", height)
    steps.append(f"""tops AS MATERIALIZED (SELECT g AS lang_key, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM v{height}),
        u0 AS (SELECT '' AS g, i, n, h FROM tops),
        m0 AS (SELECT d.* REPLACE (t.i AS i, t.n AS n), t.h AS subroot FROM n{height} AS d JOIN tops AS t ON t.lang_key = d.g)""")
    levels("u", "m", "tree", 2)
    return f"""WITH {', '.join(steps)}
        SELECT doc_id, leaf, subroot, (SELECT h FROM u2) AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = (SELECT h FROM u2) AS verified FROM m2"""


SQL["op13_merkle_manifest"] = _merkle_sql()
