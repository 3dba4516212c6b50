"""Bounded samples of labelled documents for the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 3
#: The remainder of crc32(doc_id) that is never trained on.
HELD_OUT = 1


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept for measuring: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, columns: list[str], max_rows: int) -> DataFrame:
    """doc_id, text and the label columns of at most ``max_rows`` labelled documents, none
    of them held out.  Labels are taken in the order of a hash of their id, so the sample
    is the same for the same tables and of any size an even draw; as it is bounded, it is
    broadcast to find its texts.  Labels that are NULL or not 0 or 1 are left out, and of
    labels or rows that share an id one is taken."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *columns).where("doc_id is not null").where(~held_out())
    for c in columns:
        usable = usable.where(F.col(c).isin(0, 1))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", *columns).limit(max_rows).dropDuplicates(["doc_id"])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
