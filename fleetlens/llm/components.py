"""Connected components of a table of links, by alternating star contraction.

Each task first shrinks its own links to a spanning forest.  Then rounds of two steps:
every node's larger neighbours are linked to the least node around it, then its
smaller neighbours are.  The tables of a round are written to the shared folder, so
the lineage stays short and joins read plain tables, whose hot keys (the centre of a
large star) can be split between tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Scratch

MAX_ROUNDS = 60
#: Links that a task holds at once while it shrinks them.
FOREST_LINKS = 1 << 17


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its tree) for the links a - b; trees' roots are left out."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while True:  # follow labels down to roots
            deeper = new[new]
            if np.array_equal(deeper, new):
                break
            new = deeper
        if np.array_equal(new, label):
            break
        label = new
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]


def _shrink(batches):
    held_a, held_b, size = [], [], 0

    def out():
        hi, lo = forest(np.concatenate(held_a), np.concatenate(held_b))
        return pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo)], names=["u", "v"])

    for batch in batches:
        held_a.append(batch.column(0).to_numpy())
        held_b.append(batch.column(1).to_numpy())
        size += batch.num_rows
        if size >= FOREST_LINKS:
            yield out()
            held_a, held_b, size = [], [], 0
    if size:
        yield out()


def _sign(edges: DataFrame) -> tuple:
    """Count and order-free hash of a table of links, to see whether a round changed it."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hash")).first()
    return row.n, row.hash


def components(links: DataFrame, scratch: Scratch, label: str = "links") -> DataFrame:
    """(node, component) for every node of ``links`` (two long columns, no NULLs) that is
    not the least of its component; ``component`` is that least node."""
    a, b = links.columns[:2]
    pairs = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u != v")
    pairs = scratch.save(pairs, f"{label}-pairs")
    tasks = 1 + pairs.count() // FOREST_LINKS  # tasks follow the links, each of a full forest
    edges = scratch.save(pairs.coalesce(tasks).mapInArrow(_shrink, "u long, v long"), f"{label}-0")
    scratch.drop(f"{label}-pairs")
    sign = _sign(edges)
    for k in range(1, MAX_ROUNDS + 1):
        # Large star: u > v in every row
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{label}-{k}-m")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.save(large, f"{label}-{k}-large")
        # Small star: every u here is above its v
        down = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")), f"{label}-{k}-n")
        small = large.join(down, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges_next = scratch.save(small.unionByName(down.select("u", F.col("m").alias("v"))).distinct(), f"{label}-{k}")
        scratch.drop(f"{label}-{k - 1}", f"{label}-{k}-m", f"{label}-{k}-large", f"{label}-{k}-n")
        edges, last, sign = edges_next, sign, _sign(edges_next)
        if sign == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    raise RuntimeError(f"components: not done after {MAX_ROUNDS} rounds")
