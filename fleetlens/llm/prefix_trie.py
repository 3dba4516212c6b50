"""Prefix trie of conversations by adaptive radix trees.

Each turn has a fixed-width big-endian id of 16 bytes (the head of SHA-256 over role and
text), and a conversation is the run of its turns' ids.  Conversations are dealt in
ranges of (ids, conv_id), so a task holds a run of neighbours; it puts them in an
adaptive radix tree (nodes of 4, 16, 48 or 256 children that grow and shrink, and
compressed paths) and emits a trie node at every turn-aligned byte depth.  Only nodes on
the path of a task's first or last key can reach into other tasks: those are sent as
partial sums under a digest of their path and added up by Spark, so a start that a
third of all conversations share is split over many tasks.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import Scratch, trim

#: Bytes of a turn id.
WIDTH = 16
#: Conversations of this many neighbours start alike ...
GROUP = 100
#: ... in their first crc32(conv_id) mod SHARES turns.
SHARES = 6
#: Bytes of conv_ids in one row, where a node's ends lie in several tasks.
CHUNK = 1 << 18
BROADCAST_ROWS = 1_000_000

PLAIN, NAMED, PARTIAL, ENDS = range(4)


class Few:
    """Up to 4 or 16 children: edge bytes in ascending order beside their nodes."""

    __slots__ = ("edges", "nodes", "room")

    def __init__(self, room: int = 4, items=()):
        self.room = room
        self.edges, self.nodes = bytearray(b for b, _ in items), [n for _, n in items]

    def get(self, edge: int):
        at = self.edges.find(edge)
        return self.nodes[at] if at >= 0 else None

    def put(self, edge: int, node) -> bool:
        """False where there is no room for another child."""
        at = self.edges.find(edge)
        if at >= 0:
            self.nodes[at] = node
            return True
        if len(self.edges) == self.room:
            return False
        at = sum(e < edge for e in self.edges)
        self.edges.insert(at, edge)
        self.nodes.insert(at, node)
        return True

    def items(self):
        return list(zip(self.edges, self.nodes))


class Indexed:
    """Up to 48 children: a table from edge byte to place."""

    __slots__ = ("place", "nodes", "room")

    def __init__(self, items=()):
        self.room = 48
        self.place, self.nodes = bytearray(256), []
        for edge, node in items:
            self.put(edge, node)

    def get(self, edge: int):
        at = self.place[edge]
        return self.nodes[at - 1] if at else None

    def put(self, edge: int, node) -> bool:
        at = self.place[edge]
        if at:
            self.nodes[at - 1] = node
            return True
        if len(self.nodes) == self.room:
            return False
        self.nodes.append(node)
        self.place[edge] = len(self.nodes)
        return True

    def items(self):
        return [(edge, self.nodes[at - 1]) for edge, at in enumerate(self.place) if at]


class Every:
    """Up to 256 children, one place for each edge byte."""

    __slots__ = ("nodes", "room")

    def __init__(self, items=()):
        self.room = 256
        self.nodes = [None] * 256
        for edge, node in items:
            self.nodes[edge] = node

    def get(self, edge: int):
        return self.nodes[edge]

    def put(self, edge: int, node) -> bool:
        self.nodes[edge] = node
        return True

    def items(self):
        return [(edge, node) for edge, node in enumerate(self.nodes) if node is not None]


def layout(items):
    """The smallest node layout that holds these children."""
    n = len(items)
    return Few(4, items) if n <= 4 else Few(16, items) if n <= 16 else Indexed(items) if n <= 48 else Every(items)


class Node:
    """A tree node: ``path`` holds the bytes from its parent's end to its own (the edge
    byte first), ``lens`` the code points of the turns that end inside it."""

    __slots__ = ("path", "lens", "kids", "n", "least", "ends", "n_ends", "done", "named")

    def __init__(self, path: bytes, lens, n: int = 0, least=None):
        self.path, self.lens, self.n, self.least = path, lens, n, least
        self.kids = Few()
        self.ends, self.n_ends = bytearray(), 0
        # Top nodes, leaves, weighted and distinct code points of subtrees already emitted
        self.done = (0, 0, 0, 0)
        self.named = False

    def add(self, node: Node) -> None:
        if not self.kids.put(node.path[0], node):
            self.kids = layout(sorted([*self.kids.items(), (node.path[0], node)], key=lambda x: x[0]))

    def end(self, conv_id: int) -> None:
        self.ends += b",%d" % conv_id
        self.n_ends += 1


def _shared(path: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``path`` the key has from ``at`` on."""
    if key.startswith(path, at):
        return len(path)
    low, high = 0, min(len(path), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if path[:mid] == key[at : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class RadixTree:
    """An adaptive radix tree over keys that come in ascending order."""

    def __init__(self):
        self.root = Node(b"", ())

    def insert(self, key: bytes, lens, conv_id: int) -> None:
        node, at = self.root, 0
        while True:
            node.n += 1
            node.least = conv_id if node.least is None else min(node.least, conv_id)
            if at == len(key):
                node.end(conv_id)
                return
            child = node.kids.get(key[at])
            if child is None:
                leaf = Node(key[at:], tuple(lens[at // WIDTH :]), 1, conv_id)
                leaf.end(conv_id)
                node.add(leaf)
                return
            same = _shared(child.path, key, at)
            if same < len(child.path):
                turns = (at + same) // WIDTH - at // WIDTH
                upper = Node(child.path[:same], child.lens[:turns], child.n, child.least)
                upper.named = child.named
                child.path, child.lens = child.path[same:], child.lens[turns:]
                upper.add(child)
                node.kids.put(upper.path[0], upper)
                child = upper
            node, at = child, at + same


def _next_path(path: bytes, turn_id: bytes) -> bytes:
    return hashlib.blake2b(path + turn_id, digest_size=16).digest()


ROOT_PATH = bytes(16)


def _paths(key: bytes) -> list[bytes]:
    out = [ROOT_PATH]
    for at in range(0, len(key), WIDTH):
        out.append(_next_path(out[-1], key[at : at + WIDTH]))
    return out


_FIELDS = [
    ("kind", pa.int32()), ("task", pa.int32()), ("path", pa.binary()), ("parent_path", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("weight", pa.int64()), ("lens", pa.int64()), ("len", pa.int64()), ("first", pa.bool_()), ("last", pa.bool_()), ("ends_sha256", pa.string()), ("ends", pa.binary()),
]
_ROWS = "kind int, task int, path binary, parent_path binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, weight long, lens long, len long, first boolean, last boolean, ends_sha256 string, ends binary"


class Emitter:
    """Trie nodes of the tree of one task."""

    def __init__(self, task: int, first_key: bytes):
        self.task, self.first = task, _paths(first_key)
        self.tree = RadixTree()
        self.rows: list[tuple] = []

    def subtree(self, top: Node, path: bytes, part: bytes, depth: int, parent, last: list[bytes] | None = None) -> tuple[int, int, int, int]:
        """Emit the trie nodes at and below ``top``; ``path``, ``depth`` and ``parent``
        (its conv_id, None if not final) are those of the trie node above and ``part``
        the bytes of an unfinished turn id behind it.  With ``last``, the paths of the
        last key, nodes on them are partial.  Returns top nodes, leaves, weighted and
        distinct code points."""
        order, stack = [], [(top, path, part, depth, parent, -1)]
        while stack:
            node, path, part, depth, parent, above = stack.pop()
            place = len(order)
            data = part + node.path
            turns = len(data) // WIDTH
            begin = depth if node is self.tree.root else depth + 1
            spots = [(path, None)] if node is self.tree.root else []
            for i in range(turns):
                spots.append((_next_path(path, data[i * WIDTH : (i + 1) * WIDTH]), path))
                path = spots[-1][0]
            depth += turns
            # Whether the deepest trie node's members are all here
            whole = bool(spots) and not self._open(spots[-1][0], depth, last) and not node.named
            down = node.least if whole else None if spots or node.named else parent
            order.append((node, spots, begin, parent, above))
            for _, kid in node.kids.items():
                stack.append((kid, path, data[turns * WIDTH :], depth, down, place))
        sums = [list(node.done) for node, *_ in order]
        for place in range(len(order) - 1, -1, -1):
            node, spots, begin, parent, above = order[place]
            tops, leaves, weight, lens = sums[place]
            if not tops:
                leaves = 1
            own = (0,) if node is self.tree.root else node.lens
            for i in range(len(spots) - 1, -1, -1):
                weight, lens = weight + node.n * own[i], lens + own[i]
                deepest = i == len(spots) - 1
                up = parent if i == 0 else None if node.named or self._open(spots[i - 1][0], begin + i - 1, last) else node.least
                self._row(node, spots[i], begin + i, up, tops if deepest else 1, leaves, weight, lens, own[i], deepest, last)
            sums[place] = [1 if spots else tops, leaves, weight, lens]
            if above >= 0:
                sums[above] = [a + b for a, b in zip(sums[above], sums[place])]
        return tuple(sums[0])

    def _open(self, path: bytes, depth: int, last) -> bool:
        """Whether a trie node may have members in other tasks."""
        return (depth < len(self.first) and self.first[depth] == path) or (last is not None and depth < len(last) and last[depth] == path)

    def _row(self, node, spot, depth, parent, children, leaves, weight, lens, length, deepest, last) -> None:
        path, above = spot
        first = depth < len(self.first) and self.first[depth] == path
        at_end = last is not None and depth < len(last) and last[depth] == path
        ends = bytes(node.ends[1:]) if deepest else b""
        kind = PARTIAL if first or at_end else NAMED if node.named else PLAIN
        sha = None if kind == PARTIAL else hashlib.sha256(ends).hexdigest()
        self.rows.append((kind, self.task, path, above, depth, node.least, parent, node.n, children, leaves, weight, lens, length, first, at_end, sha, None))
        if kind == PARTIAL:
            for i in range(0, len(ends), CHUNK):
                # depth holds the place among the chunks of this task
                self.rows.append((ENDS, self.task, path, None, i // CHUNK, None, None, None, None, None, None, None, None, None, None, None, ends[i : i + CHUNK]))

    def settle(self, key: bytes) -> None:
        """Emit all subtrees that no later key can reach: those beside the path of ``key``,
        the last one so far.  Their sums stay with the nodes on the path."""
        paths = _paths(key)
        node, at = self.tree.root, 0
        while True:
            node.named = True
            items = node.kids.items()
            if not items:
                return
            depth = at // WIDTH
            on = items[-1][1] if at < len(key) else None
            for _, kid in items:
                if kid is not on:
                    got = self.subtree(kid, paths[depth], key[depth * WIDTH : at], depth, None)
                    node.done = tuple(a + b for a, b in zip(node.done, got))
            if on is None:
                node.kids = Few()
                return
            node.kids = layout([(on.path[0], on)])
            node, at = on, at + len(on.path)

    def finish(self, key: bytes) -> None:
        self.subtree(self.tree.root, ROOT_PATH, b"", 0, None, _paths(key))

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[] for _ in _FIELDS]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)], names=[n for n, _ in _FIELDS])


def _grow(batches):
    emitter, key = None, b""
    task = TaskContext.get().partitionId()
    for batch in batches:
        for key, lens, conv_id in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if emitter is None:
                emitter = Emitter(task, key)
            emitter.tree.insert(key, lens, conv_id)
        if emitter is not None:
            emitter.settle(key)
            yield emitter.batch()
    if emitter is not None:
        emitter.finish(key)
        yield emitter.batch()
    trim()


def _hash_ends(batches):
    """SHA-256 of each path's chunks, which come in order; one hash state is held."""
    schema = pa.schema([("path", pa.binary()), ("ends_sha256", pa.string())])
    path, task, state = None, None, None
    for batch in batches:
        out = []
        for p, t, chunk in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if p != path:
                if path is not None:
                    out.append((path, state.hexdigest()))
                path, task, state = p, t, hashlib.sha256()
            elif t != task:
                state.update(b",")
                task = t
            state.update(chunk)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], schema.field(i).type) for i in range(2)], schema=schema)
    if path is not None:
        yield pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([state.hexdigest()])], schema=schema)


def turn_keys(turns: DataFrame, group: int = GROUP, shares: int = SHARES) -> DataFrame:
    """conv_id, key (turn ids) and lens (code points by turn) of the rebuilt conversations.

    Texts stay where they are: only ids and lengths are shuffled.  Turns are ordered by
    turn, NULL first; equal numbers by turn id.  Rows with a NULL conv_id belong to no
    conversation and are left out."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    mark = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").cast("long").alias("turn"), mark.alias("id"), F.length(text).alias("len"))
    own = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    own = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    starts = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, shares - 1).alias("shared"))
    n = (F.crc32(F.col("conv_id").cast("string")) % shares).cast("int")
    both = own.join(starts, F.col("conv_id") - F.col("conv_id") % group == F.col("base"), "left").withColumn("h", n)
    rest = F.expr("slice(turns, h + 1, size(turns))")
    whole = F.when(F.col("shared").isNull(), rest).otherwise(F.concat(F.expr("slice(shared, 1, h)"), rest))
    ids = F.array_join(F.transform("whole", lambda t: t["id"]), "")
    return both.withColumn("whole", whole).select("conv_id", F.unhex(ids).alias("key"), F.transform("whole", lambda t: t["len"]).alias("lens"))


def prefix_trie(turns: DataFrame, group: int = GROUP, shares: int = SHARES) -> DataFrame:
    """The trie of the rebuilt conversations, a row for each node.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.  The root has depth 0 and a NULL parent;
    turnless conversations end there.  A NULL role or text is empty; an empty table has
    no nodes; repeated rows are turns of their own; further columns are not read.  A
    conversation is one key of 16 bytes a turn, held whole by a task, as is the run of
    conv_ids that end at one node in one task."""
    spark = turns.sparkSession
    scratch = Scratch(spark, "trie")
    keys = scratch.save(turn_keys(turns, group, shares), "keys")
    dealt = keys.select("key", "lens", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = scratch.save(dealt.mapInArrow(_grow, _ROWS), "nodes")
    partial = found.where(F.col("kind") == PARTIAL)

    # The tasks that have rows, one number each, in the order of the keys
    tasks = sorted(r.task for r in partial.where("depth = 0").select("task").collect())
    follows = spark.createDataFrame(list(zip(tasks, tasks[1:])), "task int, next int")
    last = partial.where("last").select("task", "path", "depth", "len").join(F.broadcast(follows), "task")
    first = partial.where("first").select(F.col("task").alias("next"), "path")
    # What two neighbours share was counted in both of them.
    both = last.join(first, ["next", "path"])
    by_task = Window.partitionBy("task")
    ends = last.groupBy("task").agg(F.max("depth").alias("end_depth"))
    shared = both.select(
        "task", "path", "depth",
        F.sum("len").over(by_task.orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)).alias("lens"),
        F.max("depth").over(by_task).alias("shared_depth"),
    ).join(ends, "task")
    twice = shared.select(
        "path", F.lit(0).cast("long").alias("n_convs"), (-(F.col("depth") < F.col("shared_depth")).cast("long")).alias("n_children"),
        (-(F.col("end_depth") == F.col("shared_depth")).cast("long")).alias("n_leaves"), F.lit(0).cast("long").alias("weight"), (-F.col("lens")).alias("lens"),
    )
    sums = ["n_convs", "n_children", "n_leaves", "weight", "lens"]
    joined = partial.select("path", "parent_path", "depth", "conv_id", *sums).unionByName(twice, allowMissingColumns=True)
    merged = joined.groupBy("path").agg(F.max("parent_path").alias("parent_path"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in sums])
    chunks = found.where(F.col("kind") == ENDS).select("path", "task", F.col("depth").alias("place"), "ends")
    hashed = chunks.repartition("path").sortWithinPartitions("path", "task", "place").select("path", "task", "ends").mapInArrow(_hash_ends, "path binary, ends_sha256 string")
    nothing = hashlib.sha256(b"").hexdigest()
    merged = merged.join(hashed, "path", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))

    out = ["path", "parent_path", "depth", "conv_id", "parent_conv_id", *sums, "ends_sha256"]
    merged = scratch.save(merged.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*out), "merged")
    named = merged.select("path", "conv_id").unionByName(found.where(F.col("kind") == NAMED).select("path", "conv_id"))
    names = named.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("named"))
    if named.count() <= BROADCAST_ROWS:
        names = F.broadcast(names)
    nodes = found.where(F.col("kind").isin(PLAIN, NAMED)).select(*out).unionByName(merged)
    parents = nodes.join(names, "parent_path", "left")
    return parents.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "named").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", (F.col("weight") - F.col("lens")).alias("saved_tokens"), "ends_sha256"
    )


def q_prefix_trie(spark, sf_dir) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
