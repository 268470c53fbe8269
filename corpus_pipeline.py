"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact, latent, neardup, packing, toxicity
from millrace.llm.tables import table
from millrace.llm.workspace import Workspace


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold of their language."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"), Workspace(spark, "toxicity"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    work = Workspace(spark, "exact")
    return exact.deduplicate(docs, exact.fresh_index(spark, work), work)


#: Similarity from which the pipeline takes two texts for near-duplicates; op8's contract has its own.
NEAR_PERCENT = 80


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (similarity 0.8 or more) the one with the smallest id."""
    return neardup.one_of_each(docs, Workspace(spark, "neardup"), percent=NEAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return latent.decontaminate(docs, table(spark, sf_dir, "benchmark"), Workspace(spark, "latent"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: doc_id, piece, first_word, n_words, bin_id, bin_start."""
    return packing.best_fit(docs, Workspace(spark, "packing"))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("near dedup", drop_near_copies),
          ("decontamination", drop_leaks), ("packing", pack)]

#: The classifier and the latent space are trained models, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, work = table(spark, sf_dir, "documents"), Workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = work.cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
