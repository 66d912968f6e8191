"""Corpus preparation: stages over documents, each stored before the next reads it.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but
the last return the columns of ``docs``. No stage has an exact SQL form from end
to end (language scores, shingle components and curve order), so ORACLE_SQL is
None and tests compare each stage with a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.llm import exact_dedup, langid, ngram_join, packing, pii
from assayloom.llm.registry import table, tokenizer
from assayloom.llm.text import fold
from assayloom.session import fits_broadcast, materialise


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _unused(docs: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter or text go.

    The model learns from the rows of ``docs`` with a language, but for every fifth id.
    """
    model = langid.fit(docs.where(fold("doc_id", 5) != 0))
    mark = _unused(docs, "mark")
    marked = docs.withColumn(mark, F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    # The answer hangs on the text alone, so digests meet the rows and no text moves where the rejected are few.
    told = langid.identify(marked, model, keep=(mark,), results=("found", "share"))
    gone = materialise(told.where("found = 'und'").select(mark).distinct(), "rejected")
    kept = marked.join(F.broadcast(gone) if fits_broadcast(gone) else gone, mark, "left_anti")
    return kept.select(_columns(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the longest original, then the smallest id; rows that repeat it as a whole become one."""
    mark = _unused(docs, "mark")
    index = exact_dedup.DigestIndex(spark, f"stage_digests_{uuid.uuid4().hex}")
    try:
        kept = index.admit(docs).where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")).distinct()
    finally:
        index.drop()
    marked = docs.withColumn(mark, exact_dedup.digest(F.col("text")))
    return (marked.join(kept, (F.col(mark) == F.col("sha")) & marked["doc_id"].eqNullSafe(F.col("id")), "left_semi")
            .dropDuplicates(["doc_id", mark]).select(_columns(docs)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a similarity of 0.8 or more, the one of the smallest id."""
    found = ngram_join.near_duplicates(docs, k=5, percent=80)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(_columns(docs))


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced and n_chars, if there is one, counted anew."""
    clean = pii.redact(docs, pii.train(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, neighbours on the curve together."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", remove_personal_data),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
