"""Helpers shared by the text operators: whole-batch word hashing over Arrow
buffers and tables written to the shared folder of the session."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.session import ensure_checkpoint_dir

# Texts are hashed in blocks of about this many bytes, so the numpy temporaries
# (some ten machine words a byte) stay near 100 MB whatever the batch holds.
BLOCK_BYTES = 1 << 20

SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])


def byte_class(members) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: Bytes of a word: all but space and 09-0D.
NON_SPACE = ~byte_class(SPACE_BYTES)
#: Letters, digits and every byte of a non-ASCII character.
ALNUM = byte_class([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 256, 2 * len(_powers))
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE, np.uint64)]), dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8_parts(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1, offset=8 * column.offset) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offs


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES):
    """Row ranges of at most ``limit`` bytes of text (one longer text stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def run_hashes(text: np.ndarray, starts: np.ndarray, length: np.ndarray, prefixes=()):
    """64-bit hashes of runs of bytes that follow one another; with ``prefixes`` also
    those of each run's first k bytes, as (hashes, {k: hashes})."""
    place = np.arange(len(text)) - np.repeat(starts, length)
    with np.errstate(over="ignore"):
        values = (text.astype(np.uint64) + np.uint64(1)) * _power_table(int(length.max()))[place]
        whole = mix(np.add.reduceat(values, starts) + length.astype(np.uint64) * _BASE)
        if not prefixes:
            return whole
        return whole, {k: mix(np.add.reduceat(np.where(place < k, values, np.uint64(0)), starts) + np.uint64(k)) for k in prefixes}


class Words:
    """Words of a block of texts: ``doc`` (row of each word), ``hash`` and, where
    asked, the hashes of the words' first k bytes.  Words are runs of ``members``
    bytes with A-Z lower-cased; they never cross a text's end."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, members: np.ndarray = NON_SPACE, prefixes=()):
        text = data[offs[0] : offs[-1]]
        offs = offs - offs[0]
        inside = members[text]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edges = offs[:-1][offs[:-1] < len(text)]
        first[edges] = inside[edges]
        at = np.flatnonzero(first)
        self.n_docs = len(offs) - 1
        self.doc = np.searchsorted(offs, at, side="right") - 1
        self.prefix: dict[int, np.ndarray] = {}
        if not len(at):
            self.hash, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            self.prefix = {k: np.zeros(0, np.uint64) for k in prefixes}
            return
        begin = np.cumsum(inside)[at] - 1
        letters = LOWER[text[inside]]
        self.length = np.diff(np.append(begin, len(letters)))
        self.hash, self.prefix = run_hashes(letters, begin, self.length, prefixes) if prefixes else (run_hashes(letters, begin, self.length), {})

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package's code to the executors, once an application (the driver
    serves the archive, so they need no copy of the repository)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "fleetlens_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def trim() -> None:
    """Give memory that numpy has freed back to the system at the end of a task: a
    Python worker lives on beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


class Scratch:
    """Tables of one operator call, under the shared folder ``spark.checkpoint.dir``.
    A written table cuts the lineage: a lost executor costs a re-read."""

    def __init__(self, spark: SparkSession, label: str):
        ship_package(spark)
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def carried(docs: DataFrame, drop: tuple[str, ...] = ("doc_id", "text")):
    """The other columns of a table as one struct column, so their names clash with none."""
    names = [c for c in docs.columns if c not in drop]
    return (F.struct(*[docs[c] for c in names]) if names else F.struct(F.lit(None).cast("int").alias("_none"))).alias("carried")


def restored(docs: DataFrame, answers: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, from doc_id, text and carried; n_chars is counted anew."""
    other = {f.name: f.dataType for f in docs.schema.fields}
    out = []
    for c in docs.columns:
        if c == "n_chars":
            out.append(F.length("text").cast(other[c]).alias(c))
        elif c in ("doc_id", "text"):
            out.append(F.col(c).cast(other[c]).alias(c))
        else:
            out.append(F.col("carried").getField(c).alias(c))
    return answers.select(*out)


def row_hash():
    """Rows equal in doc_id and text are one document; this names it."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
