"""Phrase collocations by set-oriented relational mining (SETM).

The occurrences of a length are a relation of (place, item) in sorted runs: a place
counts the words of a run of texts and leaves one out between pieces, so places sort by
piece and position, and neighbours in a piece differ by one.  A run holds whole pieces,
so the merge join of a relation with itself, one place on, needs no shuffle.  Each
round counts the joined groups, keeps those that are frequent, semi-joins the groups'
occurrences to them and persists what is left as the next length's relation.  A
frequent phrase of k + 1 words is two frequent phrases of k words one place apart, so
only their occurrences are joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import BLOCK_BYTES, LOWER, Scratch, blocks, byte_class, documents, mix, run_hashes, trim, utf8_parts

MIN_COUNT = 30
MAX_WORDS = 4
#: A phrase goes where a longer one has this share of its occurrences (in hundredths).
COVERED = 80
TOP = 2000
SCALE = 2_000_000
#: Frequent groups are sent to every task only after a count of at most this many (16 to
#: 24 bytes each); beyond it occurrences are joined with them in Spark, by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Occurrences of a relation in one row, unless a piece has more.
ROW_ITEMS = 1 << 14
#: Bytes of a Parquet row group of a relation.
ROW_GROUP = 4 << 20
#: Occurrences that are counted together in a task.
FLUSH = 1 << 20
#: Each language's candidates are ranked in this many parts before their best are.
PARTS = 64

_BLANK = byte_class([0x20, 0x09])
_CUT = byte_class(b".,;:!?\x0a\x0b\x0c\x0d")


class PieceWords:
    """Words of a block of texts with their places: row, piece (numbered over the block)
    and position in the piece.  A-Z are lower-cased."""

    def __init__(self, text: np.ndarray, offs: np.ndarray):
        cut = _CUT[text]
        inside = ~(cut | _BLANK[text])
        edges = offs[:-1][offs[:-1] < len(text)]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[edges] = inside[edges]
        at = np.flatnonzero(first)
        self.row = np.searchsorted(offs, at, side="right") - 1
        # Signs that cut, and starts of texts, open a new piece
        opened = np.zeros(len(text), dtype=np.int64)
        opened[cut] = 1
        np.add.at(opened, edges, 1)
        self.piece = np.cumsum(opened)[at]
        starts = np.flatnonzero(np.append(True, self.piece[1:] != self.piece[:-1])) if len(at) else at
        self.pos = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at)))) if len(at) else at
        self.letters = LOWER[text[inside]]
        self.begin = np.cumsum(inside)[at] - 1 if len(at) else at
        self.length = np.diff(np.append(self.begin, len(self.letters))) if len(at) else at
        self.hash = run_hashes(self.letters, self.begin, self.length) if len(at) else np.zeros(0, np.uint64)

    def strings(self, which: np.ndarray) -> pa.Array:
        n = self.length[which]
        ends = np.cumsum(n)
        at = np.repeat(self.begin[which] - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)
        offsets = np.append(0, ends).astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(self.letters[at].tobytes())])


def _keys(words: PieceWords, salts: np.ndarray) -> np.ndarray:
    """Keys of (language, word): the word's hash mixed with its text's language."""
    return mix(words.hash ^ salts[words.row]).view(np.int64)


def cut_long(data: np.ndarray, offs: np.ndarray, limit: int = BLOCK_BYTES) -> np.ndarray:
    """Offsets with cuts inside texts of more than ``limit`` bytes, at signs that end a
    piece, so no piece is parted."""
    more = []
    for i in np.flatnonzero(np.diff(offs) > limit).tolist():
        ends = np.flatnonzero(_CUT[data[offs[i] : offs[i + 1]]])
        at = np.searchsorted(ends, np.arange(limit, offs[i + 1] - offs[i], limit))
        more.append(offs[i] + np.unique(ends[at[at < len(ends)]]))
    return np.sort(np.concatenate([offs, *more]), kind="stable") if more else offs


def _batch_blocks(batch):
    """(words, salts by row, languages by row) of blocks of a batch of (lang, salt, text)."""
    data, texts = utf8_parts(batch.column(2))
    salts, langs = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), batch.column(0)
    offs = cut_long(data, texts)
    if len(offs) > len(texts):
        owner = np.minimum(np.searchsorted(texts, offs[:-1], side="right") - 1, len(salts) - 1)
        salts, langs = salts[owner], langs.take(pa.array(owner))
    for i, j in blocks(offs):
        yield PieceWords(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]), salts[i:j], langs.slice(i, j - i)


def _count_words(batches):
    for batch in batches:
        for words, salts, langs in _batch_blocks(batch):
            keys, at, counts = np.unique(_keys(words, salts), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), langs.take(pa.array(words.row[at])), words.strings(at).cast(pa.string()), pa.array(counts)], names=["key", "lang", "word", "n"])
    trim()


def places(piece: np.ndarray) -> np.ndarray:
    """Places of the words of a run: one on within a piece, two on into the next."""
    steps = np.ones(len(piece), dtype=np.int64)
    steps[1:] += piece[1:] != piece[:-1]
    return np.cumsum(steps)


def merge_join(place: np.ndarray) -> np.ndarray:
    """Rows of a sorted run that have a neighbour one place on, which is the next row."""
    return np.flatnonzero(place[1:] == place[:-1] + 1)


class GroupTable:
    """Groups (left, right, id) sorted by both, to semi-join pairs with."""

    def __init__(self, lefts: np.ndarray, rights: np.ndarray, ids: np.ndarray):
        self.lefts, place = np.unique(lefts, return_inverse=True)
        self.rights, other = np.unique(rights, return_inverse=True)
        # places in both lists give one number a group, in the order of the table
        self.keys, self.ids = place * len(self.rights) + other, ids

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of pairs, -1 where they are no group of the table."""
        if not len(self.ids):
            return np.full(len(left), -1)
        i = np.minimum(np.searchsorted(self.lefts, left), len(self.lefts) - 1)
        j = np.minimum(np.searchsorted(self.rights, right), len(self.rights) - 1)
        key = i * len(self.rights) + j
        row = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.lefts[i] == left) & (self.rights[j] == right) & (self.keys[row] == key), self.ids[row], -1)


def _run_batch(run: int, place: np.ndarray, item: np.ndarray) -> pa.RecordBatch:
    """A sorted run as rows of about ROW_ITEMS occurrences, cut where no neighbours are
    parted; places are stored as steps, which are mostly 1."""
    gaps = np.flatnonzero(place[1:] != place[:-1] + 1) + 1
    near = np.searchsorted(gaps, np.arange(ROW_ITEMS, len(place), ROW_ITEMS))
    starts = np.unique(np.append(0, gaps[near[near < len(gaps)]]))
    steps = np.diff(place, prepend=0).astype(np.int32)
    steps[starts] = place[starts]
    ends = pa.array(np.append(starts, len(place)), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), run)), pa.ListArray.from_arrays(ends, pa.array(steps)), pa.ListArray.from_arrays(ends, pa.array(item.astype(np.int64)))], names=["run", "steps", "items"])


_RUNS = "run long, steps array<int>, items array<long>"


def _runs(batch):
    """(run, places, items) of the rows of a batch of runs."""
    for i in range(len(batch)):
        steps, items = batch.column(1)[i].values, batch.column(2)[i].values
        yield batch.column(0)[i].as_py(), np.cumsum(steps.to_numpy(zero_copy_only=False).astype(np.int64)), items.to_numpy(zero_copy_only=False)


def _text_runs(batches):
    """(run, places, words, salts, languages) of texts; a run's number has its task's above."""
    run = TaskContext.get().partitionId() << 32
    for batch in batches:
        for words, salts, langs in _batch_blocks(batch):
            yield run, places(words.piece), words, salts, langs
            run += 1


def _with_neighbour(place: np.ndarray) -> np.ndarray:
    joined = np.zeros(len(place) + 1, dtype=bool)
    at = merge_join(place)
    joined[at] = joined[at + 1] = True
    return joined[:-1]


def _word_runs(table):
    """Relation of the frequent words that have a frequent neighbour."""

    def run(batches):
        keys, ids = table.value
        for number, place, words, salts, _ in _text_runs(batches):
            key = _keys(words, salts)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1) if len(keys) else np.zeros(0, np.int64)
            known = np.flatnonzero(keys[at] == key) if len(keys) else at
            keep = known[_with_neighbour(place[known])]
            if len(keep):
                yield _run_batch(number, place[keep], ids[at[keep]])
        trim()

    return run


def _word_rows(by_name: bool):
    """The same occurrences as rows, for a join in Spark."""

    def run(batches):
        for number, place, words, salts, langs in _text_runs(batches):
            head = [pa.array(np.full(len(place), number)), pa.array(place)]
            if by_name:
                every = np.arange(len(place))
                yield pa.RecordBatch.from_arrays([*head, langs.take(pa.array(words.row)), words.strings(every).cast(pa.string())], names=["run", "place", "lang", "word"])
            else:
                yield pa.RecordBatch.from_arrays([*head, pa.array(_keys(words, salts))], names=["run", "place", "key"])
        trim()

    return run


def _counted(left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    width = int(right.max()) + 1
    if (int(left.max()) + 1) * width < 1 << 63:  # one number a pair, sorted in place
        key = left * width + right
        key.sort()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        counts = np.diff(np.append(first, len(key)))
        left, right = np.divmod(key[first], width)
    else:
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        first = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
        counts = np.diff(np.append(first, len(left)))
        left, right = left[first], right[first]
    return pa.RecordBatch.from_arrays([pa.array(left), pa.array(right), pa.array(counts)], names=["left", "right", "a"])


def _count_pairs(batches):
    """Partial counts of joined groups, summed over runs up to FLUSH occurrences."""
    held, size = [], 0
    for batch in batches:
        for _, place, items in _runs(batch):
            at = merge_join(place)
            if not len(at):
                continue
            held.append((items[at], items[at + 1]))
            size += len(at)
            if size >= FLUSH:
                left, right = (np.concatenate(x) for x in zip(*held))
                held, size = [], 0
                yield _counted(left, right)
    if size:
        yield _counted(*(np.concatenate(x) for x in zip(*held)))
    del held
    trim()


def _extend(table):
    """The relation of the frequent groups: merge join, then semi-join."""

    def run(batches):
        known = GroupTable(*table.value)
        for batch in batches:
            for number, place, items in _runs(batch):
                at = merge_join(place)
                ids = known.find(items[at], items[at + 1])
                keep = np.flatnonzero(ids >= 0)
                if len(keep):
                    yield _run_batch(number, place[at[keep]], ids[keep])
        trim()

    return run


def _pair_rows(batches):
    for batch in batches:
        for number, place, items in _runs(batch):
            at = merge_join(place)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), number)), pa.array(place[at]), pa.array(items[at]), pa.array(items[at + 1])], names=["run", "place", "left", "right"])
    trim()


def _as_runs(rows: DataFrame) -> DataFrame:
    """Rows (run, place, id) as sorted runs again; a run is at most a block of texts."""
    run = rows.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("place", "id"))).alias("r"))
    steps = "transform(r, (x, i) -> cast(x.place - if(i = 0, 0, r[i - 1].place) as int))"
    return run.select("run", F.expr(steps).alias("steps"), F.expr("transform(r, x -> x.id)").alias("items"))


def _save_runs(scratch: Scratch, relation: DataFrame, name: str) -> DataFrame:
    """Persist a relation; its rows are long, so row groups are kept small."""
    relation.write.option("parquet.block.size", ROW_GROUP).parquet(scratch.path(name))
    return scratch.spark.read.schema(_RUNS).parquet(scratch.path(name))


def _numbered(scratch: Scratch, df: DataFrame, name: str, rows: int) -> tuple[DataFrame, bool]:
    """Save with an id for each row; the ids of a small table are dense.  Also whether
    the table is small enough to be sent to every task."""
    saved = scratch.save(df, f"{name}-counted")
    small = saved.count() <= rows
    saved = saved.coalesce(1) if small else saved
    return scratch.save(saved.withColumn("id", F.monotonically_increasing_id()), name), small


def _send(df: DataFrame, *columns: str):
    """A small table as sorted arrays in every task."""
    got = df.select(*columns).toArrow()
    arrays = [got.column(c).to_numpy(zero_copy_only=False) for c in columns]
    order = np.lexsort(arrays[-2::-1])
    return df.sparkSession.sparkContext.broadcast(tuple(a[order] for a in arrays))


def mine_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, covered: int = COVERED, broadcast_rows: int = BROADCAST_ROWS, by_name: bool | None = None) -> DataFrame:
    """Every candidate that stays: lang, words (their number), phrase, a, l, r, n, score.

    Counting is exact: words go by a 64-bit key, and if two words of the corpus share
    one, the occurrences carry the words themselves (``by_name`` forces that).  NULL and
    empty texts have no words; a NULL lang is ``und``; repeated rows count each; an empty
    table gives no rows; other columns are not read.  ``max_words`` is 2 or more."""
    scratch = Scratch(docs.sparkSession, "phrases")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.where("text is not null").select(lang.alias("lang"), F.xxhash64(lang).alias("salt"), F.col("text").cast("string").alias("text"))

    counted = texts.mapInArrow(_count_words, "key long, lang string, word string, n long").groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))
    vocabulary = scratch.save(counted, "vocabulary")
    totals = scratch.save(vocabulary.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    words, small = _numbered(scratch, vocabulary.where(F.col("n") >= min_count), "words", broadcast_rows)
    if by_name is None:
        by_name = not vocabulary.groupBy("key").count().where("count > 1").isEmpty()

    if by_name:
        rows = texts.mapInArrow(_word_rows(True), "run long, place long, lang string, word string")
        relation = _as_runs(rows.join(words.select("lang", "word", "id"), ["lang", "word"]))
    elif small:
        relation = texts.mapInArrow(_word_runs(_send(words, "key", "id")), _RUNS)
    else:
        rows = texts.mapInArrow(_word_rows(False), "run long, place long, key long")
        relation = _as_runs(rows.join(words.select("key", "id"), "key"))
    relation = _save_runs(scratch, relation, "relation-1")
    scratch.drop("vocabulary", "words-counted")

    # first[j - 1] and rest[j - 1]: occurrences of the phrase's first and last j words
    shorter = words.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("tail"), F.col("n").alias("a"), F.array().cast("array<long>").alias("first"), F.array().cast("array<long>").alias("rest"))
    levels = []
    for k in range(2, max_words + 1):
        groups = relation.mapInArrow(_count_pairs, "left long, right long, a long").groupBy("left", "right").agg(F.sum("a").alias("a"))
        groups, small = _numbered(scratch, groups.where(F.col("a") >= min_count), f"groups-{k}", broadcast_rows)
        one = shorter.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("head"), F.col("a").alias("a_left"), F.col("first").alias("f"))
        other = shorter.select(F.col("id").alias("right"), "tail", F.col("a").alias("a_right"), F.col("rest").alias("s"))
        level = groups.join(one, "left").join(other, "right").select(
            "id", "left", "right", "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "tail", "a", F.concat("f", F.array("a_left")).alias("first"), F.concat("s", F.array("a_right")).alias("rest")
        )
        shorter = scratch.save(level, f"phrases-{k}")
        levels.append(shorter)
        if k < max_words:
            if small:
                longer = relation.mapInArrow(_extend(_send(groups, "left", "right", "id")), _RUNS)
            else:
                rows = relation.mapInArrow(_pair_rows, "run long, place long, left long, right long")
                longer = _as_runs(rows.join(groups.select("left", "right", "id"), ["left", "right"]))
            relation = _save_runs(scratch, longer, f"relation-{k}")
            scratch.drop(f"relation-{k - 1}", f"groups-{k}-counted")

    out = None
    for k, level in zip(range(2, max_words + 1), levels):
        if k < max_words:
            # A longer phrase that covers this one has one between them, one word longer,
            # that covers it too: only those are asked.
            longer = levels[k - 1]
            ends = longer.select(F.col("left").alias("id"), F.col("a").alias("over")).unionByName(longer.select(F.col("right").alias("id"), F.col("a").alias("over")))
            over = ends.groupBy("id").agg(F.max("over").alias("over"))
            a, b = F.col("over").cast("decimal(28,0)"), F.col("a").cast("decimal(28,0)")
            level = level.join(over, "id", "left").where(F.col("over").isNull() | (a * 100 < b * covered))
        cuts = F.transform(F.sequence(F.lit(1), F.lit(k - 1)), lambda j: F.struct(F.element_at("first", j).alias("l"), F.element_at("rest", F.lit(k) - j).alias("r"), j.alias("k")))
        cut = level.select("lang", "phrase", "a", F.explode(cuts).alias("cut")).select("lang", "phrase", "a", "cut.*") if k > 2 else level.select("lang", "phrase", "a", F.col("first")[0].alias("l"), F.col("rest")[0].alias("r"), F.lit(1).alias("k"))
        both = "cast(l as decimal(20,0)) + cast(r as decimal(20,0))"
        cut = cut.withColumn("score", F.expr(f"cast(a as decimal(20,0)) * cast({SCALE} as decimal(7,0)) div ({both})"))
        if k > 2:
            best = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
            cut = best.select("lang", "phrase", "a", "best.*")
        cut = cut.select("lang", F.lit(k).alias("words"), "phrase", "a", "l", "r", "score")
        out = cut if out is None else out.unionByName(cut)
    return out.join(F.broadcast(totals) if totals.count() <= broadcast_rows else totals, "lang").select("lang", "words", "phrase", "a", "l", "r", "n", "score")


def top_phrases(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """Each language's first ``top`` phrases by score, a, phrase, with their rank.  A
    language's candidates are ranked in parts first, so no task holds them all."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    found = mine_phrases(docs, **options).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    near = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def q_phrase_mining(spark, sf_dir) -> DataFrame:
    return top_phrases(documents(spark, sf_dir))


PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k),
f AS (SELECT lang, w[i : i + k - 1] AS p, k, count(*) AS a FROM places GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM f WHERE k > 1 AND a >= 30),
inner_parts AS (SELECT lang, p AS q, a AS b, k AS kq, unnest(range(2, k)) AS k FROM candidates WHERE k > 2),
contained AS (SELECT lang, b, q, k, unnest(range(1, kq - k + 2)) AS i FROM inner_parts),
covering AS (SELECT lang, q[i : i + k - 1] AS p, max(b) AS b FROM contained GROUP BY ALL),
kept AS (SELECT c.* FROM candidates c LEFT JOIN covering v ON c.lang = v.lang AND c.p = v.p WHERE v.b IS NULL OR 100 * v.b < 80 * c.a),
cuts AS (SELECT lang, p, k, a, unnest(range(1, k)) AS c FROM kept),
scored AS (
  SELECT x.lang, x.p, x.a, x.c, l.a AS l, r.a AS r, CAST((2000000::HUGEINT * x.a) // (l.a + r.a) AS BIGINT) AS score
  FROM cuts x JOIN f l ON l.lang = x.lang AND l.p = x.p[1 : x.c] JOIN f r ON r.lang = x.lang AND r.p = x.p[x.c + 1 : x.k]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
ranked AS (SELECT *, array_to_string(p, ' ') AS phrase FROM best)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
