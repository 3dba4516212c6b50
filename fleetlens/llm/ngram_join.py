"""N-gram Jaccard join by a token-group matrix.

A document is the set of its 5-word shingles.  Two link when their sets' Jaccard
similarity is 0.8 or more, compared exactly (100 * intersection >= 80 * union).

1. Tokens (shingle hashes) get a global order, rare ones first, from counts over all
   documents.  A set of n tokens can only reach the threshold with a set that holds one
   of its n - ceil(0.8 n) + 1 first tokens (its prefix) in its own prefix.
2. Partition: documents that share a least prefix token are compared in short runs by
   their signatures, and joined where the exact comparison finds them linked, too; they
   form groups (large groups are cut into blocks of about 64).
3. Matrix: for each token the groups whose union of prefixes holds it.
4. Each document queries the matrix with its prefix.  The hits bound its overlap with
   a group: what the prefix misses, the union misses.  Only groups whose bound reaches
   the threshold are opened, and only groups outside the document's own are asked.
5. Opened groups' members are compared by signature, those that may link exactly: first
   the likeliest member of each group's block with the most hits; then, in the groups
   that this has not joined, all members of all opened blocks.

A signature is a bitmap of the parities of hashed tokens; with h different bits two sets
share at most (|a| + |b| - h) / 2 tokens, so it rules out pairs and never loses one.

Every pair of linked documents is either in one group or found by 4 and 5, so the
components are exact.  Equal sets are one node from the start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import Scratch, Words, blocks, documents, mix, row_hash, trim, utf8_parts
from fleetlens.llm.components import components

SHINGLE = 5
#: Similarity in hundredths.
PERCENT = 80
BUCKET_BITS = 16
#: Members of a group's block, and neighbours that a run compares.
BLOCK = 64
#: Queries that meet one copy of a block's members.
QUERIES = 256
#: Rows up to which a table of ids (40 bytes a row) is broadcast.
BROADCAST_ROWS = 1_000_000
#: Sets that a task remembers, so copies send their prefixes once.
REMEMBERED = 200_000
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_LOW = np.uint64((1 << (64 - BUCKET_BITS)) - 1)
_SHIFT = np.uint64(64 - BUCKET_BITS)


def shingles(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, ends): the shingle hashes of a block of texts, one text after another;
    text i's stand before ends[i].  A text of fewer words has one, of all its words."""
    words = Words(data, offs)
    counts = words.counts()
    h = words.hash
    with np.errstate(over="ignore"):
        n = max(0, len(h) - SHINGLE + 1)
        tokens = np.zeros(n, dtype=np.uint64)
        for i in range(SHINGLE):
            tokens += h[i : i + n] * _MULTIPLIERS[i]
        tokens = mix(tokens)
    whole = words.doc[:n] == words.doc[SHINGLE - 1 :] if n else np.zeros(0, bool)
    doc, tokens = words.doc[:n][whole], tokens[whole]
    few = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(few):
        ends = np.cumsum(counts)
        with np.errstate(over="ignore"):
            short = np.array([mix(np.array([(h[ends[d] - counts[d] : ends[d]] * _MULTIPLIERS[: counts[d]]).sum() + np.uint64(counts[d])], dtype=np.uint64))[0] for d in few], dtype=np.uint64)
        doc, tokens = np.concatenate([doc, few]), np.concatenate([tokens, short])
        order = np.argsort(doc, kind="stable")
        doc, tokens = doc[order], tokens[order]
    return tokens, np.cumsum(np.bincount(doc, minlength=words.n_docs))


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1 if n else 0


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < PERCENT * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def signature(tokens: np.ndarray) -> bytes:
    """Parities of the tokens' counts in W = 2^k >= max(64, n) bits."""
    width = max(64, 1 << (len(tokens) - 1).bit_length())
    return np.packbits(np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1, bitorder="little").tobytes()


def shared_at_most(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> int:
    """Bound on the common tokens of two sets, from (size, signature as uint64)."""
    (n, x), (m, y) = a, b
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):  # the wider one folds to the other's width
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return min(n, m, (n + m - int(np.bitwise_count(x ^ y).sum())) // 2)


def may_link(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> bool:
    n, m = a[0], b[0]
    if 100 * min(n, m) < PERCENT * max(n, m):
        return False
    both = shared_at_most(a, b)
    return 100 * both >= PERCENT * (n + m - both)


def _text_sets(column):
    """The set (sorted uint64) of each text of an Arrow column, in order."""
    data, offs = utf8_parts(column)
    for i, j in blocks(offs):
        tokens, ends = shingles(data, offs[i : j + 1])
        begin = 0
        for end in ends:
            yield np.unique(tokens[begin:end])
            begin = end


def _node(tokens: np.ndarray) -> int:
    """A set's id: a 64-bit hash of its sorted tokens."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - 2**63


def _bucket_counts(batches):
    counts = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for batch in batches:
        data, offs = utf8_parts(batch.column(0))
        for i, j in blocks(offs):
            tokens, _ = shingles(data, offs[i : j + 1])
            counts += np.bincount((tokens >> _SHIFT).astype(np.int64), minlength=len(counts))
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], names=["bucket", "n"])


def token_ranks(texts: DataFrame) -> np.ndarray:
    """The place of each of 65,536 token buckets in the order of their counts over all
    texts.  (The order decides how many candidates there are, never the result; the
    table has this size whatever the corpus.)"""
    counts = texts.mapInArrow(_bucket_counts, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    full = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for r in counts.collect():
        full[r.bucket] = r.n
    ranks = np.empty(len(full), dtype=np.uint64)
    ranks[np.argsort(full, kind="stable")] = np.arange(len(full), dtype=np.uint64)
    return ranks


def _facts(shared):
    def run(batches):
        ranks, seen = shared.value, set()
        for batch in batches:
            sizes, nodes, prefixes, signatures = [], [], [], []
            for doc_id, tokens in zip(batch.column(0).to_pylist(), _text_sets(batch.column(1))):
                sizes.append(len(tokens))
                node = _node(tokens) if len(tokens) else None
                nodes.append(node)
                # Rows with a NULL doc_id are dropped, so none may stand for its set.
                if doc_id is None or node is None or node in seen:
                    prefixes.append(None)
                    signatures.append(None)
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(node)
                ordered = (ranks[(tokens >> _SHIFT).astype(np.int64)] << _SHIFT) | (tokens & _LOW)
                k = prefix_length(len(tokens))
                prefixes.append(np.sort(np.partition(ordered, k - 1)[:k]).view(np.int64))
                signatures.append(signature(tokens))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(signatures, pa.binary()), batch.column(2)], names=["doc_id", "n", "node", "prefix", "signature", "row"])
        trim()

    return run


def _own_text(batches):
    """Rows whose text is that of the node (not of another row with its doc_id)."""
    seen = set()
    for batch in batches:
        keep = []
        for i, (node, tokens) in enumerate(zip(batch.column(0).to_pylist(), _text_sets(batch.column(1)))):
            if node not in seen and len(tokens) and _node(tokens) == node:
                keep.append(i)
                seen.add(node)
                if len(seen) > REMEMBERED:
                    seen.clear()
        yield batch.take(pa.array(keep, pa.int64()))


def _pairs(found):
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])


def _signed(sizes, signatures):
    return [(n, np.frombuffer(x, dtype=np.uint64)) for n, x in zip(sizes.to_pylist(), signatures.to_pylist())]


def _runs(batches):
    """Rows come sorted by key, size and node.  Rows of one key are compared in runs of
    ``BLOCK``, each beginning with the last row of the one before it; of pairs that may
    link a spanning forest is told."""
    key, run = None, []

    def compare():
        found, tree = [], list(range(len(run)))

        def root(i):
            while tree[i] != i:
                i = tree[i]
            return i

        for i in range(1, len(run)):
            for j in range(i - 1, -1, -1):
                a, b = root(i), root(j)
                if a != b and may_link(run[i][1], run[j][1]):
                    tree[max(a, b)] = min(a, b)
                    found.append((run[i][0], run[j][0]))
        return found

    for batch in batches:
        found = []
        for k, node, signed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _signed(batch.column(2), batch.column(3))):
            if k != key or len(run) >= BLOCK:
                found += compare()
                run = [] if k != key else run[-1:]
                key = k
            run.append((node, signed))
        yield _pairs(found)
    yield _pairs(compare())


def _open(batches):
    """Rows come sorted by block and side: members first, then the queries.  Tells the
    members that a query may link with; ``best``: the likeliest of them."""
    at, members = None, []
    for batch in batches:
        found, best = [], []
        for block, side, node, signed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), _signed(batch.column(3), batch.column(4))):
            if block != at:
                at, members = block, []
            if side == 0:
                members.append((node, signed))
                continue
            near = [(shared_at_most(signed, theirs) / max(signed[0], theirs[0]), other) for other, theirs in members if may_link(signed, theirs)]
            top = max(near, default=(0, 0))[1]
            found += [(node, other) for _, other in near]
            best += [other == top for _, other in near]
        pairs = _pairs(found)
        yield pa.RecordBatch.from_arrays([*pairs.columns, pa.array(best, pa.bool_())], names=["a", "b", "best"])


def _exact(batches):
    """The pairs of texts that link."""
    for batch in batches:
        keep = [linked(x, y) for x, y in zip(_text_sets(batch.column(2)), _text_sets(batch.column(3)))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, rows: DataFrame, sets: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """Of a table of pairs those whose texts link.  Only the texts in pairs are moved."""
    pairs = scratch.save(pairs.select("a", "b").distinct(), f"{label}-pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = scratch.save(sets.select("node", F.col("rep").alias("doc_id")).join(nodes, "node"), f"{label}-wanted")
    small = F.broadcast if wanted.count() <= BROADCAST_ROWS else (lambda x: x)
    texts = rows.select("doc_id", "text").join(small(wanted), "doc_id").select("node", "text")
    texts = scratch.save(texts.mapInArrow(_own_text, "node long, text string").dropDuplicates(["node"]), f"{label}-texts")
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    out = scratch.save(both.mapInArrow(_exact, "a long, b long"), f"{label}-links")
    scratch.drop(f"{label}-texts", f"{label}-wanted", f"{label}-pairs")
    return out


def _differ(df: DataFrame, column: str) -> DataFrame:
    """Rows whose token stands with two or more values of a column."""
    same = Window.partitionBy("token")
    return df.withColumns({"_least": F.min(column).over(same), "_most": F.max(column).over(same)}).where("_least != _most").drop("_least", "_most")


def _meeting(opened: DataFrame, members: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """Queries (node, block) and the blocks' members by signature: the pairs a, b that may
    link, and whether b is the query's best.  Many queries are dealt to copies of a block."""
    copies = scratch.save(opened.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("copies")), f"{label}-copies")
    facts = ["node", "n", "signature"]
    asking = opened.select("node", "block").join(copies, "block").join(members.select(*facts), "node")
    asking = asking.select(F.xxhash64("block", F.pmod(F.hash("node"), F.col("copies"))).alias("place"), F.lit(1).alias("side"), *facts)
    asked_of = members.join(copies, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), *facts)
    asked_of = asked_of.select(F.xxhash64("block", "copy").alias("place"), F.lit(0).alias("side"), *facts)
    # A place holds one copy of a block and some 256 queries, in one task
    met = asking.unionByName(asked_of).repartition("place").sortWithinPartitions("place", "side")
    return met.mapInArrow(_open, "a long, b long, best boolean")


def similar_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and row
    (a hash of doc_id and text) of every row.

    Texts that are NULL or without words have no shingles and link with nothing.  Rows
    with a NULL doc_id link with nothing and have a NULL component_id.  Equal sets are
    linked whatever their order or repetition of shingles; rows that repeat are answered
    each.  An empty table gives no rows; further columns are not read."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngrams")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranks = spark.sparkContext.broadcast(token_ranks(rows.select("text")))
    facts = scratch.save(rows.withColumn("row", row_hash()).mapInArrow(_facts(ranks), "doc_id long, n long, node long, prefix array<long>, signature binary, row long"), "facts")
    usable = facts.where("doc_id is not null and node is not null")
    sets = scratch.save(usable.groupBy("node").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.max("signature").alias("signature")), "sets")

    postings = usable.where("prefix is not null").select(F.posexplode("prefix").alias("pos", "token"), "node")
    shared = scratch.save(_differ(postings, "node"), "shared")
    keys = shared.groupBy("node").agg(F.min("token").alias("key1"), F.min(F.xxhash64("token")).alias("key2"))
    chosen = scratch.save(keys.join(sets, "node").select("node", "n", "signature", "key1", "key2"), "chosen")

    # 2. Partition: runs of documents that share a least token, in two orders of tokens
    keyed = chosen.select("node", "n", "signature", F.explode(F.array("key1", "key2")).alias("key"))
    ordered = keyed.repartitionByRange("key", "n", "node").sortWithinPartitions("key", "n", "node")
    alike = ordered.select("key", "node", "n", "signature").mapInArrow(_runs, "a long, b long")
    first = _verified(alike, rows, sets, scratch, "first")
    similar = components(first, scratch, "first-trees").withColumnRenamed("component", "grp")
    members = chosen.select("node", "n", "signature").join(similar, "node", "left").withColumn("grp", F.coalesce("grp", "node"))
    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    members = members.join(sizes, "grp").withColumn("block", F.xxhash64("grp", F.pmod(F.hash("node"), F.ceil(F.col("size") / BLOCK).cast("int"))))
    members = scratch.save(members.select("node", "n", "signature", "grp", "size", "block"), "members")

    # 3. Matrix rows of the tokens that stand in more than one group
    tagged = scratch.save(_differ(shared.join(members.drop("signature"), "node"), "grp"), "tagged")
    matrix = tagged.groupBy("token", "grp", "size", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("pos")).alias("rest"))
    # 4. A pair of groups is asked once: by the smaller one's documents.  At the first
    # token that two sets share, what stands before it in either prefix is not shared,
    # so the sets have at most n - pos tokens in common; a link needs 80 / 180 of both.
    enough = PERCENT * (F.col("q.n") + F.col("m.low"))
    q, m = tagged.alias("q"), matrix.alias("m")
    asked = (
        (F.col("q.token") == F.col("m.token"))
        & (F.struct("q.size", "q.grp") < F.struct("m.size", "m.grp"))
        & (100 * F.col("m.high") >= PERCENT * F.col("q.n"))
        & (100 * F.col("q.n") >= PERCENT * F.col("m.low"))
        & ((100 + PERCENT) * (F.col("q.n") - F.col("q.pos")) >= enough)
        & ((100 + PERCENT) * F.col("m.rest") >= enough)
    )
    hits = q.join(m, asked).groupBy(F.col("q.node").alias("node"), F.col("q.n").alias("n"), F.col("q.grp").alias("grp"), F.col("m.grp").alias("asked"), F.col("m.block").alias("block")).agg(F.count(F.lit(1)).alias("hits"))
    need = F.ceil(F.col("n") * PERCENT / 100)
    bound = F.col("hits") + F.col("n") - (F.col("n") - need + 1)  # the prefix's misses are the union's
    opened = scratch.save(hits.where(bound >= need).drop("n"), "opened")
    # 5. A third of all documents may be one group: its blocks are asked one at first
    likeliest = opened.groupBy("node", "asked").agg(F.max(F.struct("hits", "block")).getField("block").alias("block"))
    likely = scratch.save(_meeting(likeliest, members, scratch, "likely"), "likely")
    second = _verified(likely.where("best"), rows, sets, scratch, "second")
    links = first.unionByName(second)
    final = components(links, scratch, "second-trees")
    tree = final.withColumnRenamed("component", "tree")
    apart = opened.select("node", "grp", "asked", "block")
    for end in ("grp", "asked"):
        apart = apart.join(tree.select(F.col("node").alias(end), F.col("tree").alias(f"tree_{end}")), end, "left").withColumn(f"tree_{end}", F.coalesce(f"tree_{end}", end))
    apart = scratch.save(apart.where("tree_grp != tree_asked").select("node", "block"), "apart")
    rest = scratch.save(_meeting(apart, members, scratch, "rest").join(likely.where("best").select("a", "b"), ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        links = links.unionByName(_verified(rest, rows, sets, scratch, "third"))
        final = components(links, scratch, "all-trees")
    joined = sets.select("node", "rep").join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    joined = scratch.save(joined, "joined")
    least = scratch.save(joined.groupBy("component").agg(F.min("rep").alias("component_id")), "least")
    answers = scratch.save(joined.join(least, "component").select("node", "component_id"), "answers")
    # Equal sets may be many: both sides are plain tables, so their rows can be split.
    linked_rows = usable.select("doc_id", "n", "node", "row").join(answers, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "row")
    alone = facts.where("doc_id is null or node is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "row")
    return linked_rows.unionByName(alone)


def q_ngram_join(spark, sf_dir) -> DataFrame:
    return similar_documents(documents(spark, sf_dir)).drop("row")
