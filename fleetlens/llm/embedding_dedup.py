"""Embedding near-dedup by sorted projection passes.

In each pass a vector's key is the signs of 63 random projections; vectors are ordered
by key, so near vectors tend to stand near each other.  All vectors that share a key's
leading bits (a run, see ``bits_for``) are compared: runs of up to ``window`` vectors in
a window over the order, longer ones block by block, so a dense topic is searched as
whole as a sparse one.  Pairs of a cosine of ``threshold`` or more are verified in
double precision; the pairs of all passes are united to components.  The number of
passes follows the number of vectors (see ``passes_for``).

Inside a component all vectors are compared with one another in blocks, so links that
no pass brought together are counted too.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Scratch
from fleetlens.llm.components import components, forest

THRESHOLD = 0.95
WINDOW = 32
BITS = 63
#: Chance with which the passes together bring a pair at the threshold into one run.
TARGET = 0.99
#: Vectors in a block of the comparison inside components and long runs.
BLOCK = 1024
#: Long runs (24 bytes each) up to which their table is broadcast.
BROADCAST_ROWS = 1_000_000
SEED = 20_240_601


def bits_for(n: int, window: int = WINDOW) -> int:
    """Leading bits that leave about a window of evenly spread vectors."""
    return min(BITS, max(0, math.ceil(math.log2(max(n, 1) / window))))


def passes_for(n: int, threshold: float = THRESHOLD, window: int = WINDOW, target: float = TARGET) -> int:
    """Passes so that a pair at the threshold shares, in one of them, the leading bits of
    a run: each bit agrees with chance 1 - angle / pi, however dense the vectors stand."""
    once = (1 - math.acos(threshold) / math.pi) ** bits_for(n, window)
    return max(2, math.ceil(math.log(1 - target) / math.log(max(1e-9, 1 - min(once, 1 - 1e-9)))))


def _vectors(column) -> list:
    """Vectors in double precision; None where there is no direction."""
    out = []
    for v in column:
        x = None
        if v.is_valid:
            values = v.values
            if len(values) and not values.null_count:
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all() or not x.any():
                    x = None
        out.append(x)
    return out


def _clean(batches):
    """vec_id and the vector as bytes of doubles; invalid vectors have none."""
    for batch in batches:
        blobs = [None if x is None else x.astype("<f8").tobytes() for x in _vectors(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], names=["vec_id", "vector"])


def _unit(blobs: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(blobs), dtype="<f8").reshape(len(blobs), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keys(passes: int):
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            ids, blobs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(blobs):
                by_size.setdefault(len(v) // 8, []).append(i)
            for dim, rows in by_size.items():
                if dim not in planes:
                    planes[dim] = np.random.default_rng(SEED + dim).standard_normal((dim, passes * BITS))
                units = _unit([blobs[i] for i in rows])
                for p in range(passes):
                    signs = units @ planes[dim][:, p * BITS : (p + 1) * BITS] > 0
                    key = signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p << 32 | dim] * len(rows), pa.int64()), pa.array(key, pa.int64()), pa.array([ids[i] for i in rows], pa.int64()), pa.array([blobs[i] for i in rows], pa.binary())],
                        names=["list", "key", "node", "vector"],
                    )

    return run


def _neighbours(threshold: float, window: int):
    """Rows come sorted by list and key; a batch is compared with the ``window`` rows
    before it, too.  A partition holds whole runs, so its edges cut none."""

    def run(batches):
        lists, nodes, blobs = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        for batch in batches:
            fresh = len(nodes)
            lists = np.concatenate([lists, batch.column(0).to_numpy()])
            nodes = np.concatenate([nodes, batch.column(2).to_numpy()])
            blobs += batch.column(3).to_pylist()
            a, b = [], []
            for kind in np.unique(lists):
                at = np.flatnonzero(lists == kind)
                units = _unit([blobs[i] for i in at])
                for step in range(1, min(window, len(at) - 1) + 1):
                    near = np.flatnonzero(np.einsum("ij,ij->i", units[:-step], units[step:]) >= threshold)
                    near = near[at[near + step] >= fresh]
                    a.append(nodes[at[near]])
                    b.append(nodes[at[near + step]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
            lists, nodes, blobs = lists[-window:], nodes[-window:], blobs[-window:]

    return run


def _run_links(threshold: float):
    """A forest of the near pairs of one block of a long run with another, or itself."""

    def run(key, table):
        rows = table.filter(table["side"].to_numpy() == 0)
        columns = table.filter(table["side"].to_numpy() == 1)
        columns = columns if key[2].as_py() != key[3].as_py() else rows
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if rows.num_rows and columns.num_rows:
            x, y = (_unit(t["vector"].to_pylist()) for t in (rows, columns))
            left, right = np.nonzero(x @ y.T >= threshold)
            a, b = rows["node"].to_numpy()[left], columns["node"].to_numpy()[right]
            a, b = a[a != b], b[a != b]
            if len(a):
                a, b = forest(a, b)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _block_links(threshold: float):
    """Links of each vector of a block of rows with a block of columns."""

    def run(key, table):
        rows = table.filter(table["side"].to_numpy() == 0)
        columns = table.filter(table["side"].to_numpy() == 1)
        if not rows.num_rows or not columns.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        x, y = (_unit(t["vector"].to_pylist()) for t in (rows, columns))
        near = x @ y.T >= threshold
        near &= rows["node"].to_numpy()[:, None] != columns["node"].to_numpy()[None, :]
        return pa.table({"node": rows["node"], "links": pa.array(near @ columns["copies"].to_numpy().astype(np.int64), pa.int64())})

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    Equal vectors are compared once and counted as often as they stand.  Vectors that
    are NULL, empty, zero, or hold NULL or non-finite components link with nothing, nor
    do vectors of different lengths.  Rows with a NULL vec_id link with nothing and
    have a NULL component_id and kept true.  Rows that share a vec_id are vectors of
    their own under that id.  An empty table gives no rows; further columns are not read."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    clean = scratch.save(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(_clean, "vec_id long, vector binary"), "clean")
    usable = clean.where("vec_id is not null and vector is not null")
    # One row for equal vectors, under the least id (and a hash, should ids repeat)
    distinct = usable.groupBy("vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    distinct = scratch.save(distinct.withColumn("node", F.xxhash64("vector", "least")), "distinct")
    n = distinct.count()
    passes, bits = passes_for(n, threshold, window), bits_for(n, window)

    keyed = distinct.select("node", "vector").mapInArrow(_keys(passes), "list long, key long, node long, vector binary")
    keyed = keyed.withColumn("run", F.shiftright("key", BITS - bits) if bits else F.lit(0).cast("long"))
    long_runs = scratch.save(keyed.groupBy("list", "run").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > window), "long-runs")
    small = F.broadcast if long_runs.count() <= BROADCAST_ROWS else (lambda x: x)
    # Runs within the window: a run lies in one range partition, its vectors in one window
    short = keyed.join(small(long_runs.select("list", "run")), ["list", "run"], "left_anti")
    ordered = short.repartitionByRange("list", "run").sortWithinPartitions("list", "key", "node")
    found = ordered.select("list", "key", "node", "vector").mapInArrow(_neighbours(threshold, window), "a long, b long")
    # Longer runs: each pair of blocks of a run once, so a task holds two blocks
    parts = keyed.join(small(long_runs), ["list", "run"]).withColumn("n_blocks", F.ceil(F.col("size") / block).cast("int")).withColumn("own", F.pmod(F.hash("node"), F.col("n_blocks")))
    parts = parts.select("list", "run", "node", "vector", "own", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other"))
    parts = parts.select("list", "run", F.least("own", "other").alias("row_block"), F.greatest("own", "other").alias("column_block"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "vector")
    dense = parts.groupBy("list", "run", "row_block", "column_block").applyInArrow(_run_links(threshold), "a long, b long")
    joined = scratch.save(components(found.unionByName(dense), scratch, "found"), "components")

    # Inside components: blocks of rows by blocks of columns, both of about ``block``
    # vectors of the component, so a task holds two blocks whatever the component's size.
    inner = distinct.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = scratch.save(inner.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.min("least").alias("component_id")), "sizes")
    placed = scratch.save(inner.join(sizes, "component").select("node", "vector", "copies", "component", "component_id", "size"), "placed")
    several = placed.where("size > 1").withColumn("n_blocks", F.ceil(F.col("size") / block).cast("int")).withColumn("own", F.pmod(F.hash("node"), F.col("n_blocks")))
    others = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
    facts = ["component", "node", "vector", "copies"]
    as_rows = several.select(*facts, F.col("own").alias("row_block"), others).select(*facts, "row_block", F.col("other").alias("column_block"), F.lit(0).alias("side"))
    as_columns = several.select(*facts, F.col("own").alias("column_block"), others).select(*facts, F.col("other").alias("row_block"), "column_block", F.lit(1).alias("side"))
    blocks = as_rows.unionByName(as_columns).groupBy("component", "row_block", "column_block")
    links = blocks.applyInArrow(_block_links(threshold), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))

    answers = placed.join(links, "node", "left").select("vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    answers = scratch.save(answers, "answers")
    # Equal vectors may be many: both sides are plain tables, so their rows can be split.
    linked = usable.join(answers, "vector").select("vec_id", "n_links", "component_id")
    alone = clean.where("vec_id is null or vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def q_embedding_dedup(spark, sf_dir) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
