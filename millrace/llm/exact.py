"""Exact duplicates by a persistent digest index, bucketed and sorted by the digest (built-in functions only)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.workspace import Workspace


class DigestIndex:
    """A table (digest, keep_id) in hash buckets sorted by digest.

    New data comes as one row per digest, dealt to the same buckets: the anti-join that finds unseen digests then merges two sorted
    sides and moves no row of the index. The table lives at ``folder``; opening it again in another session finds what is there.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str, buckets: int | None = None):
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.spark, self.name, self.buckets = spark, name, buckets
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` (one per digest) whose digest is not in the index."""
        return groups.repartition(self.buckets, "digest").join(self.rows().hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        (groups.select("digest", "keep_id").repartition(self.buckets, "digest").write.mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").format("parquet").saveAsTable(self.name))

    def forget(self) -> None:
        """Take the table out of the session's catalogue; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"),
                       F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"))


def decide(docs: DataFrame, index: DigestIndex, work: Workspace, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept. Unseen digests are appended to the index.

    Null text counts as empty; texts are equal when their bytes are. Of equal texts of this batch the largest id stays; none stays
    when the index has the text already, whose row is then keep_id. Rows that repeat an id and a text share one decision; a null id
    loses against any other and stays only where all ids of its text are null. An empty table gives no rows. Other columns are not read.
    A group of copies is counted before the shuffle, and the join that labels rows is one whose large keys Spark splits.
    """
    rows = digests(docs, text, doc_id)
    groups = work.cut(rows.groupBy("digest").agg(F.max("doc_id").alias("top_id"), F.count("*").alias("group_size")), "groups")
    known = index.rows().select("digest", F.col("keep_id").alias("old_id"))
    fresh = work.cut(index.unseen(groups).select("digest", F.col("top_id").alias("keep_id")), "fresh")
    labels = (groups.join(known, "digest", "left").join(fresh.select("digest", F.lit(True).alias("fresh")), "digest", "left")
              .select("digest", "group_size", F.coalesce("fresh", F.lit(False)).alias("fresh"),
                      F.when(F.coalesce("fresh", F.lit(False)), F.col("top_id")).otherwise(F.col("old_id")).alias("keep_id")))
    labels = work.cut(labels, "labels")
    index.append(fresh)
    work.drop(groups, fresh)
    return rows.join(labels, "digest").select(
        "doc_id", "digest", "keep_id", "group_size", (F.col("fresh") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"))


def fresh_index(spark: SparkSession, work: Workspace) -> DigestIndex:
    return DigestIndex(spark, f"digest_index_{os.urandom(6).hex()}", work.path("index"))


def deduplicate(docs: DataFrame, index: DigestIndex, work: Workspace, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that `decide` keeps, with all their columns. The texts are moved once and never sorted."""
    kept = work.cut(decide(docs, index, work, text, doc_id).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct(), "kept")
    return docs.join(kept.hint("shuffle_hash"), docs[doc_id].cast("bigint").eqNullSafe(kept.kept_id), "left_semi")
