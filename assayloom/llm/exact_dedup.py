"""Exact dedup: a persistent index of digests, bucketed and sorted by digest."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.session import materialise

#: White space that does not count, fixed: the bytes 0x20 and 0x09 to 0x0D.
_BLANKS = " \t\n\x0b\x0c\r"


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text without its ASCII white space, null as empty."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), _BLANKS, "").cast("binary"), 256)


def _digests(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_sha256, size (code points) of every row, stored: they are read more than once."""
    return materialise(docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        digest(F.col(f"`{text}`")).alias("text_sha256"),
        F.char_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long").alias("size"),
    ), "digests")


def _groups(slim: DataFrame) -> DataFrame:
    """text_sha256, size, group_size, keep_id of every digest: the longest text, then the smallest id."""
    best = slim.groupBy("text_sha256").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("group_size"))
    first = slim.groupBy("text_sha256", "size").agg(F.min("doc_id").alias("keep_id"))
    return best.join(first, ["text_sha256", "size"])


def keepers(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, without an index.

    Equal texts are those equal without ASCII white space; the one with the most
    code points stays, then the smallest id. A null text counts as empty. Rows
    that repeat an id with its text count each in group_size and share the answer.
    Digests are grouped with a partial row per task; only digests and ids move,
    never texts, and a digest of very many rows is split by the skew join.
    """
    slim = _digests(docs, doc_id, text)
    return slim.drop("size").join(_groups(slim).drop("size"), "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


class DigestIndex:
    """The digests of all texts taken so far, as a table bucketed and sorted by digest.

    A row holds text_sha256, the id and size of the text that stays, and the batch
    that brought it. The table lives in the session's catalog, so it outlasts the
    job. ``buckets`` is its width; a join on the digest reads it without a shuffle.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int = 64):
        self.spark, self.table, self.buckets = spark, table, buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def new_digests(self, found: DataFrame) -> DataFrame:
        """Rows of ``found`` whose text_sha256 the index lacks: a sort-merge anti-join."""
        known = self.spark.table(self.table).select("text_sha256")
        return found.join(known.hint("merge"), "text_sha256", "left_anti")

    def append(self, found: DataFrame) -> None:
        """Add text_sha256, doc_id, size and batch of ``found``; each bucket is written by one task."""
        (found.select("text_sha256", "doc_id", "size", "batch").repartition(self.buckets, "text_sha256")
         .write.bucketBy(self.buckets, "text_sha256").sortBy("text_sha256")
         .format("parquet").mode("append").saveAsTable(self.table))

    def admit(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """One row per document of a new batch: doc_id, keep_id, group_size, kept, text_sha256, is_new.

        The digests of the batch, one row each, go against the index first: the anti-join finds
        the new ones, which are appended with the id and size of the text that stays
        (as in ``keepers``). Then every document meets its digest in the index, which says what
        stays: keep_id may be of an earlier batch, and is_new is false for texts that the index had before, of
        which none is kept. group_size counts the rows of this batch. Nulls and repeated rows
        are as in ``keepers``; no rows give no rows. The answer is stored, so it does
        not change when the index grows.
        """
        slim, batch = _digests(docs, doc_id, text), uuid.uuid4().hex
        groups = materialise(_groups(slim), "digest-groups")
        if not self.exists():
            self.append(groups.limit(0).select("text_sha256", F.col("keep_id").alias("doc_id"), "size", F.lit("").alias("batch")))
        self.append(self.new_digests(groups).withColumnRenamed("keep_id", "doc_id").withColumn("batch", F.lit(batch)))
        stays = self.spark.table(self.table).select(
            "text_sha256", F.col("doc_id").alias("keep_id"), (F.col("batch") == batch).alias("is_new"))
        told = groups.select("text_sha256", "group_size").join(stays.hint("merge"), "text_sha256")
        kept = F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
        return materialise(slim.drop("size").join(told, "text_sha256").select(
            "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "is_new"), "admitted")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
