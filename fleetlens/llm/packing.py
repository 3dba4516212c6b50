"""Packing by power-of-two decomposition.

A document of n ids is cut into pieces whose lengths are the powers of two of n's
binary form, the longest first, with 2,048-id pieces as often as they fit.  Each
piece is a sequence of its own, so no sequence crosses documents and none needs
padding; equal lengths form a bucket, and sequence ids run bucket by bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import Scratch, documents, trim
from fleetlens.llm.tokens import ids_crc32, tokenizer

MAX_TOKENS = 2048
WORD_END_ID = 1

_PIECES = "doc_id long, start long, length int, doc_tokens long, ids array<int>, part int, place long"


def piece_lengths(n: int, max_tokens: int = MAX_TOKENS) -> list[int]:
    """Lengths of the pieces of n ids, e.g. 5000 -> 2048, 2048, 512, 256, 128, 8."""
    rest = n % max_tokens
    return [max_tokens] * (n // max_tokens) + [1 << b for b in range(max_tokens.bit_length() - 1, -1, -1) if rest >> b & 1]


def _cut(path: str, end_id: int, max_tokens: int):
    # A batch returned to Spark holds about this many ids.
    full = 1 << 20

    def run(batches):
        part, placed = TaskContext.get().partitionId(), {}
        tok = tokenizer(path)
        cols: list[list] = [[] for _ in range(6)]
        held = 0

        def flush():
            doc, start, length, total, ids, place = cols
            flat = pa.array(np.concatenate(ids).astype(np.int32))
            at = pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(total, pa.int64()), pa.ListArray.from_arrays(at, flat), pa.array([part] * len(doc), pa.int32()), pa.array(place, pa.int64())],
                names=["doc_id", "start", "length", "doc_tokens", "ids", "part", "place"],
            )

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for doc, ids in zip(doc_ids, tok.encode_column(batch.column(1))):
                ids = np.append(ids, np.uint32(end_id))
                at = 0
                for n in piece_lengths(len(ids), max_tokens):
                    place = placed.get(n, 0)
                    placed[n] = place + 1
                    for c, v in zip(cols, (doc, at, n, len(ids), ids[at : at + n], place)):
                        c.append(v)
                    at += n
                held += len(ids)
                if held >= full:
                    yield flush()
                    cols, held = [[] for _ in range(6)], 0
        if cols[0]:
            yield flush()
        trim()

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = WORD_END_ID, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Pieces of all documents with their ids.

    Returns doc_id, start, length, doc_tokens, ids (array), sequence_id, offset.
    ``sequence_id`` is dense from 0, longest bucket first; ``offset`` is 0, as a piece
    fills its sequence.  A NULL or empty text has one piece, the end id; a NULL
    doc_id is kept; repeated rows are packed each on its own; an empty table gives
    no rows; further columns are not read.  ``max_tokens`` is a power of two."""
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    scratch = Scratch(docs.sparkSession, "packing")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = scratch.save(rows.mapInArrow(_cut(tokenizer_path, end_id, max_tokens), _PIECES), "pieces")
    # One row for each task and length: at most log2(max_tokens) + 1 a task, so this
    # window is tiny beside the data and its result is broadcast (a million tasks give
    # 12 million rows of 24 bytes).  Places within a task were counted at the cut.
    counts = pieces.groupBy("length", "part").agg((F.max("place") + 1).alias("n"))
    order = Window.orderBy(F.desc("length"), "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return pieces.join(F.broadcast(bases), ["length", "part"]).select("doc_id", "start", F.col("length").cast("long").alias("length"), "doc_tokens", "ids", (F.col("base") + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def _digest(batches):
    for batch in batches:
        ids = batch.column(2)
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(batch.column(1).to_numpy())
        crc = [ids_crc32(flat[e - n : e]) for e, n in zip(ends.tolist(), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 3, 1)), pa.array(crc, pa.int64()), *(batch.column(i) for i in (4, 5, 6))], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def packed_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The contract's columns, from the ids of each piece."""
    p = pack(docs, tokenizer_path).select("doc_id", "length", "ids", "start", "doc_tokens", "sequence_id", "offset")
    return p.mapInArrow(_digest, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def q_packing(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return packed_digest(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
