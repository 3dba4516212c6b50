"""Document fingerprints by SimHash, and all pairs within a Hamming radius.

Terms are word pairs (a lone word counts as one term) weighted by 1 + ln(count).
Each term's hash votes its weight up or down on every bit; a bit is set where the
votes are above zero.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import Scratch, Words, documents, mix

BITS = 128
HEX = BITS // 4
_SALTS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344], dtype=np.uint64)


def _bits(terms: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        halves = np.stack([mix(terms ^ s) for s in _SALTS], axis=1)
    return np.unpackbits(halves.astype(">u8").view(np.uint8), axis=1)


def simhash(texts: list[str]) -> np.ndarray:
    """Fingerprints as rows of BITS / 8 bytes.  A text without words has all bits 0."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    words = Words(np.frombuffer(b"".join(raw), dtype=np.uint8), offs)
    counts = words.counts()
    ends = np.cumsum(counts)
    out = np.zeros((len(texts), BITS // 8), dtype=np.uint8)
    for d in np.flatnonzero(counts):
        h = words.hash[ends[d] - counts[d] : ends[d]]
        with np.errstate(over="ignore"):
            terms = mix(h[:-1] * np.uint64(3) + h[1:]) if len(h) > 1 else h
        terms, tf = np.unique(terms, return_counts=True)
        votes = np.zeros(BITS)
        for i in range(0, len(terms), 1 << 14):
            part = _bits(terms[i : i + (1 << 14)])
            n = tf[i : i + (1 << 14)]
            votes += 2.0 * part.sum(axis=0, dtype=np.int32) - len(part)
            again = np.flatnonzero(n > 1)
            if len(again):
                votes += np.log(n[again]) @ (2.0 * part[again] - 1.0)
        out[d] = np.packbits(votes > 0)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits, row by row."""
    return 1.0 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def _fingerprint_rows(batches):
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        prints = []
        for i in range(0, len(texts), 256):
            prints += [p.tobytes().hex() for p in simhash(texts[i : i + 256])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (hex) of every row; a NULL text counts as empty, a NULL
    doc_id is kept, repeated rows are answered each, further columns are not read."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprint_rows, "doc_id long, fingerprint string")


def near_fingerprints(prints: DataFrame, radius: int = 3, n_blocks: int | None = None) -> DataFrame:
    """All pairs of different fingerprints at most ``radius`` bits apart, by permuted
    block tables: the bits are cut into blocks; two prints within the radius agree on
    at least ``n_blocks - radius`` of them, so a table for every such choice of blocks,
    keyed by their bits, holds the pair.  Equal prints are one row of the tables, so a
    large group of copies costs one row; its documents are found by the print.

    Returns fingerprint_a < fingerprint_b and distance."""
    from itertools import combinations

    n_blocks = n_blocks or radius + 2
    keep = n_blocks - radius
    cuts = [HEX * i // n_blocks for i in range(n_blocks + 1)]
    distinct = Scratch(prints.sparkSession, "simhash").save(prints.where("fingerprint is not null").select("fingerprint").distinct(), "prints")
    keys = []
    for k, chosen in enumerate(combinations(range(n_blocks), keep)):
        parts = [F.substring("fingerprint", cuts[b] + 1, cuts[b + 1] - cuts[b]) for b in chosen]
        keys.append(F.concat_ws("-", F.lit(str(k)), *parts))
    table = distinct.select("fingerprint", F.explode(F.array(*keys)).alias("key"))
    a, b = table.alias("a"), table.alias("b")
    words = range(0, HEX, 8)  # 32 bits at a time
    word = lambda c, i: F.conv(F.substring(c, i + 1, 8), 16, 10).cast("long")
    distance = sum(F.bit_count(word("a.fingerprint", i).bitwiseXOR(word("b.fingerprint", i))) for i in words)
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.fingerprint") < F.col("b.fingerprint")))
    near = pairs.select(F.col("a.fingerprint").alias("fingerprint_a"), F.col("b.fingerprint").alias("fingerprint_b"), distance.cast("int").alias("distance"))
    return near.where(F.col("distance") <= radius).distinct()


_EDITS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, part int, edge int, text string"


def _rows(docs: list, texts: list[str], nexts: list[str]) -> dict:
    edited = []
    for t, n in zip(texts, nexts):
        half = len(t) // 2
        edited.append(t[: len(t) - half] + n[:half])
    own, of_edit, of_next = simhash(texts), simhash(edited), simhash([nexts[-1]])
    after = np.concatenate([own[1:], of_next])
    hexes = lambda x: [p.tobytes().hex() for p in x]
    return {
        "doc_id": docs, "n_chars": [len(t) for t in texts], "edited_sha256": [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
        "fingerprint": hexes(own), "edited_fingerprint": hexes(of_edit), "near_edited": likeness(own, of_edit), "near_next": likeness(own, after),
    }


def _edit_partition(batches):
    """Rows come sorted; each is answered when its successor is known.  The first and
    the last row of the partition are passed on (edge 1 and 2) for the seam."""
    part = TaskContext.get().partitionId()
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()), ("edge", pa.int32()), ("text", pa.string())])

    def edge(kind, doc, text):
        return pa.RecordBatch.from_pylist([{"doc_id": doc, "part": part, "edge": kind, "text": text}], schema=schema)

    last = None
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        if not ids:
            continue
        if last is None:
            yield edge(1, ids[0], texts[0])
        else:
            ids, texts = [last[0], *ids], [last[1], *texts]
        i = 0
        while i < len(ids) - 1:
            j, size = i, 0
            while j < len(ids) - 1 and (j == i or size < 1 << 19):
                size += len(texts[j])
                j += 1
            rows = _rows(ids[i:j], texts[i:j], texts[i + 1 : j + 1])
            yield pa.RecordBatch.from_pydict(rows | {"part": [part] * (j - i), "edge": [0] * (j - i), "text": [None] * (j - i)}, schema=schema)
            i = j
        last = (ids[-1], texts[-1])
    if last is not None:
        yield edge(2, *last)


def _seams(batches):
    for batch in batches:
        for r in batch.to_pylist():
            yield pa.RecordBatch.from_pydict(_rows([r["doc_id"]], [r["text"] or ""], [r["follower"] or ""]))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness and that
    of the next document's.

    Rows are ordered by (doc_id, text), NULL doc_ids first, and the last row is
    followed by the first.  One range shuffle brings neighbours together; only the
    first and last text of each range travel again.  A NULL or empty text has zero
    bits; a table of one row follows itself; an empty table gives no rows."""
    scratch = Scratch(docs.sparkSession, "fingerprints")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    done = scratch.save(ranged.mapInArrow(_edit_partition, _EDITS), "rows")
    edges = done.where("edge > 0").select("part", "edge", "doc_id", "text")
    # One row for each range: the range after it, the last one's being the first.
    parts = edges.where("edge = 1").select("part")
    first = parts.agg(F.min("part").alias("p")).select("p")
    nexts = parts.select("part", F.lead("part").over(Window.orderBy("part")).alias("after")).crossJoin(F.broadcast(first)).select("part", F.coalesce("after", "p").alias("after"))
    heads = edges.where("edge = 1").select(F.col("part").alias("after"), F.col("text").alias("follower"))
    seams = edges.where("edge = 2").select("part", "doc_id", "text").join(nexts, "part").join(heads, "after")
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = ", ".join(x for x in _EDITS.split(", ") if x.split()[0] in columns)
    answered = seams.select("doc_id", "text", "follower").mapInArrow(_seams, schema)
    return done.where("edge = 0").select(*columns).unionByName(answered)


def q_fingerprints(spark, sf_dir) -> DataFrame:
    return fingerprint_report(documents(spark, sf_dir))
