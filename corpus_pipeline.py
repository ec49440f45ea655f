"""The corpus pipeline: its stages in order, and a run over the documents.

Every stage takes what its predecessor kept and returns the columns of documents; the
last one returns where each piece of each document was packed.  Columns besides
``doc_id`` and ``text`` may have any names and nulls.  An empty table gives no rows in
every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import decontaminate, langid, line_dedup, packing, simhash
from tallyforge.llm.catalog import word_tokenizer
from tallyforge.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _through(docs: DataFrame, used: set[str], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What an operator keeps, with the given columns: those it does not use are renamed meanwhile, so none can clash."""
    names = [c if c.lower() in used else f"given_{i}" for i, c in enumerate(docs.columns)]
    kept = operator(docs.toDF(*names))
    return kept.select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model does not reject.

    A null text, or one without a letter, is rejected.  Rows of one text share their
    answer, so rows may repeat; of equally near centroids the first one counts.
    """
    return _through(docs, {"doc_id", "text", "lang"}, lambda rows: langid.predict(rows, langid.fit(rows)).where("NOT rejected"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that larger ids repeat; n_chars follows a changed text.

    A null text comes back empty.  Of a repeated line the largest doc_id keeps its lines,
    rows that repeat this id alike; a row without an id keeps none that some id keeps.
    """

    def dropped(rows: DataFrame) -> DataFrame:
        kept = line_dedup.drop_lines(rows)
        if "n_chars" not in rows.columns:
            return kept
        now = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
        return kept.withColumn("n_chars", now.cast(rows.schema["n_chars"].dataType))

    return _through(docs, {"doc_id", "text", "n_chars"}, dropped)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Texts without words are one group.  Of several rows with the smallest id, one with
    the smallest fingerprint stays; of rows equal in both, any one.
    """
    return _through(docs, {"doc_id", "text"}, lambda rows: simhash.one_of_each(rows, words=4, max_bits=4))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none, and items without a word are in no document.  Rows of
    one text share their answer, so rows may repeat.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _through(docs, {"doc_id", "text"}, lambda rows: decontaminate.find(rows, benchmark).where("size(hits) = 0"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    A null or empty text is a piece of one id.  Repeated rows are documents of their own,
    and pieces of equal length are placed in the order of a hash.
    """
    return packing.packed_digest(docs, word_tokenizer, size=2048)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("simhash_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Language models, fingerprints, edit distances and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
