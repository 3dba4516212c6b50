"""Token ids in binary shard files: patched frame-of-reference blocks.

A shard holds whole documents in ascending doc_id order.  Its ids are cut into
blocks of 256.  A block stores its minimum, a width taken from a percentile of the
differences to the minimum, the low bits of every difference packed at that width,
and for the differences that need more bits an exception list of places and high
parts.  An index gives the byte at which each block starts.

    "PFOR0001", n_docs, n_ids, n_blocks  (little-endian uint64 each)
    doc_ids int64[n_docs], null flags uint8[n_docs], doc lengths uint64[n_docs]
    block starts uint64[n_blocks + 1], counted from the first block's byte
    blocks: minimum uint32, width uint8, exceptions uint16,
            packed differences (32 * width bytes),
            places uint8[exceptions], high parts uint32[exceptions]
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import Scratch, documents, trim
from fleetlens.llm.tokens import ids_crc32, tokenizer

MAGIC = b"PFOR0001"
BLOCK = 256
#: The packed width covers this share of a block's differences.
PERCENTILE = 90
#: A shard is closed once it holds this many ids.
SHARD_IDS = 1 << 23
END_ID = 0
_HEAD = struct.Struct("<8sQQQ")
_BLOCK_HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("exceptions", "<u2")])


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows of 256 values below 2^width as rows of 4 * width 64-bit words."""
    words = np.zeros((4 * width, len(rows)), dtype=np.uint64)
    columns = np.ascontiguousarray(rows.T).astype(np.uint64)
    for j in range(BLOCK):
        at, shift = divmod(j * width, 64)
        words[at] |= columns[j] << np.uint64(shift)
        if shift + width > 64:
            words[at + 1] |= columns[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = np.ascontiguousarray(words.T)
    out = np.empty((BLOCK, words.shape[0]), dtype=np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(BLOCK):
        at, shift = divmod(j * width, 64)
        value = lanes[at] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (lanes[at + 1] << np.uint64(64 - shift))
        out[j] = value & mask
    return np.ascontiguousarray(out.T)


def encode_ids(ids: np.ndarray, at_once: int = 1 << 20) -> tuple[np.ndarray, bytes]:
    """(block starts, blocks) of the ids, ``at_once`` (whole blocks) at a time."""
    starts, bodies, size = [np.zeros(1, "<u8")], [], 0
    for i in range(0, len(ids), at_once):
        ends, body = _encode_part(np.asarray(ids[i : i + at_once], dtype=np.uint32))
        starts.append(ends + np.uint64(size))
        bodies.append(body)
        size += len(body)
    return np.concatenate(starts).astype("<u8"), b"".join(bodies)


def _encode_part(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(block ends, blocks); the last block is filled with its last id."""
    n = -(-len(ids) // BLOCK)
    grid = np.concatenate([ids, np.full(n * BLOCK - len(ids), ids[-1], np.uint32)]).reshape(n, BLOCK)
    low = grid.min(axis=1)
    diff = grid - low[:, None]
    kth = BLOCK * PERCENTILE // 100 - 1
    width = np.frexp(np.partition(diff, kth, axis=1)[:, kth].astype(np.float64))[1].astype(np.uint8)
    over = (diff.astype(np.uint64) >> width.astype(np.uint64)[:, None]) > 0
    exceptions = over.sum(axis=1)
    heads = np.empty(n, dtype=_BLOCK_HEAD)
    heads["low"], heads["width"], heads["exceptions"] = low, width, exceptions
    size = _BLOCK_HEAD.itemsize + 32 * width.astype(np.int64) + 5 * exceptions
    packed: list = [b""] * n
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        for b, row in zip(at, _pack(diff[at] & np.uint32((1 << int(w)) - 1), int(w))):
            packed[b] = row.tobytes()
    block, place = np.nonzero(over)
    high = (diff[block, place].astype(np.uint64) >> width[block].astype(np.uint64)).astype("<u4")
    place = place.astype(np.uint8)
    ends = np.cumsum(exceptions)
    out = bytearray()
    for b in range(n):
        e = slice(ends[b] - exceptions[b], ends[b])
        out += heads[b].tobytes()
        out += packed[b]
        out += place[e].tobytes()
        out += high[e].tobytes()
    return np.cumsum(size).astype(np.uint64), bytes(out)


def decode_ids(starts: np.ndarray, body: bytes, n_ids: int) -> np.ndarray:
    n = len(starts) - 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(body, dtype=np.uint8)
    at = starts[:-1].astype(np.int64)
    heads = raw[at[:, None] + np.arange(_BLOCK_HEAD.itemsize)].copy().view(_BLOCK_HEAD).reshape(n)
    grid = np.zeros((n, BLOCK), dtype=np.uint32)
    data = at + _BLOCK_HEAD.itemsize
    for w in np.unique(heads["width"]):
        if w:
            rows = np.flatnonzero(heads["width"] == w)
            words = raw[data[rows][:, None] + np.arange(32 * int(w))].copy().view("<u8")
            grid[rows] = _unpack(words, int(w))
    many = heads["exceptions"].astype(np.int64)
    lists = data + 32 * heads["width"].astype(np.int64)
    block = np.repeat(np.arange(n), many)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    place = raw[np.repeat(lists, many) + nth]
    high_at = np.repeat(lists + many, many) + 4 * nth
    high = raw[high_at[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    grid[block, place] |= high << heads["width"][block].astype(np.uint32)
    return (grid + heads["low"][:, None]).reshape(-1)[:n_ids]


def shard_bytes(doc_ids: list, ids: list[np.ndarray]) -> bytes:
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    starts, body = encode_ids(flat)
    return b"".join([
        _HEAD.pack(MAGIC, len(doc_ids), len(flat), len(starts) - 1),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array([len(i) for i in ids], "<u8").tobytes(), starts.tobytes(), body,
    ])


def read_shard(content: bytes) -> tuple[list, list[np.ndarray]]:
    """(doc_ids, the ids of each document) of one file."""
    magic, n_docs, n_ids, n_blocks = _HEAD.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a shard of token ids")
    at = _HEAD.size

    def take(kind, n):
        nonlocal at
        out = np.frombuffer(content, dtype=kind, count=n, offset=at)
        at += out.nbytes
        return out

    doc, null, length, starts = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs), take("<u8", n_blocks + 1)
    ids = decode_ids(starts, content[at:], n_ids)
    return [None if x else d for d, x in zip(doc.tolist(), null)], np.split(ids, np.cumsum(length.astype(np.int64))[:-1]) if n_docs else []


def read_block(content: bytes, block: int) -> np.ndarray:
    """The ids of one block, by the index alone."""
    _, n_docs, n_ids, n_blocks = _HEAD.unpack_from(content)
    at = _HEAD.size + 17 * n_docs
    starts = np.frombuffer(content, "<u8", n_blocks + 1, at)
    at += starts.nbytes
    body = content[at + int(starts[block]) : at + int(starts[block + 1])]
    return decode_ids(np.array([0, len(body)], "<u8"), body, min(BLOCK, n_ids - BLOCK * block))


def _write_shards(folder: str, path: str, end_id: int, shard_ids: int):
    def run(batches):
        from pyarrow import fs

        context = TaskContext.get()
        part = context.partitionId()
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        tok = tokenizer(path)
        docs, held, size, shard = [], [], 0, 0

        def close():
            # Written under the attempt's own name, then renamed: a lost or repeated
            # attempt leaves the same bytes under the same name.
            name = f"part-{part:06d}-{shard:05d}.pfor"
            draft = f"{root}/.{name}.{context.taskAttemptId()}"
            with files.open_output_stream(draft) as out:
                out.write(shard_bytes(docs, held))
            files.move(draft, f"{root}/{name}")
            return pa.RecordBatch.from_pydict({"file": [name], "n_docs": [len(docs)], "n_ids": [size]})

        for batch in batches:
            names = batch.column(0).to_pylist()
            for doc, ids in zip(names, tok.encode_column(batch.column(1))):
                docs.append(doc)
                held.append(np.append(ids, np.uint32(end_id)))
                size += len(ids) + 1
                if size >= shard_ids:
                    yield close()
                    docs, held, size, shard = [], [], 0, shard + 1
        if docs:
            yield close()
        del docs, held
        trim()

    return run


def write_token_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Tokenize and write all documents as shard files in ascending doc_id order.

    ``folder`` is a URI that all executors share.  Returns the manifest: file, n_docs,
    n_ids and start (ids in all files before it).  Names sort in doc_id order.  NULL
    doc_ids come first, ties of doc_id by text; a NULL text is empty and holds the end
    id alone; an empty table writes no file."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    written = ranged.mapInArrow(_write_shards(folder, tokenizer_path, end_id, shard_ids), "file string, n_docs long, n_ids long")
    manifest = Scratch(docs.sparkSession, "tokens").save(written, "manifest")
    # One row a file of millions of ids: small whatever the corpus.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read_documents(batches):
    for batch in batches:
        for content, start in zip(batch.column(0), batch.column(1).to_pylist()):
            names, ids = read_shard(content.as_py())
            n = np.array([len(i) for i in ids], dtype=np.int64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(names, pa.int64()), "start": pa.array(start + np.cumsum(n) - n, pa.int64()),
                "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array([ids_crc32(i) for i in ids], pa.int64()),
            })


def read_token_shards(spark, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of the manifest's files."""
    spark_files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.pfor").load(folder)
    named = spark_files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return named.join(F.broadcast(manifest.select("file", "start")), "file").select("content", "start").mapInArrow(_read_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the ids of all documents and read the files back."""
    scratch = Scratch(docs.sparkSession, "tokens")
    folder = scratch.path("shards")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    manifest = write_token_shards(docs, folder, tokenizer_path)
    if manifest.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_shards(docs.sparkSession, folder, manifest)


def q_token_binary(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return token_digest(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
