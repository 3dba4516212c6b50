"""Corpus pipeline: toxicity, line dedup, near-duplicate documents, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet
and read again as the next one's docs; all but the last keep the columns of documents.
Texts that a stage shortens get their n_chars anew.  A document whose text a dedup
stage removes altogether goes, as do documents that the toxicity chain rejects and all
but one of each group of near-duplicates; every other document goes on.  Rows equal in
doc_id and text are one document, and stay or go together.  NULL and empty texts go on
to packing, where their one piece is the end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import Scratch, documents, restored, row_hash
from fleetlens.llm.line_dedup import dedup_lines
from fleetlens.llm.ngram_join import BROADCAST_ROWS, similar_documents
from fleetlens.llm.packing import pack
from fleetlens.llm.substring_dedup import remove_repeats
from fleetlens.llm.toxicity_chain import chain_labels, fit_toxicity, score_toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, fitted on the labels table, does not call toxic."""
    model = fit_toxicity(docs, chain_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return restored(docs, score_toxicity(docs, model).where(~F.col("toxic")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; a text of repeated lines alone goes."""
    cleaned = dedup_lines(docs)
    return restored(docs, cleaned.where((F.col("n_removed") == 0) | (F.trim(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) != "")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id."""
    scratch = Scratch(spark, "near-duplicates")
    gone = scratch.save(similar_documents(docs).where("component_id < doc_id").select(F.col("row").alias("_gone")).distinct(), "gone")
    small = F.broadcast if gone.count() <= BROADCAST_ROWS else (lambda x: x)
    return docs.join(small(gone), row_hash() == F.col("_gone"), "left_anti")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; a text of those alone goes."""
    cut = remove_repeats(docs)
    return restored(docs, cut.where((F.size("removed") == 0) | (F.trim(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) != "")))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their token ids."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack_documents),
]

#: Learnt scores, edit distances and token ids are beyond SQL; tests/llm holds the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
