"""Line dedup by a segment-partition edit join, in DataFrame operations only.

A line of at least ``min_chars`` characters is a repeat if the same line, or one at
most ``threshold`` edits away, stands earlier: at a smaller doc_id, or higher up in the
document.  Earlier lines count whether or not they are repeats themselves.

Two lines within t edits agree on one of t + 1 segments of the shorter, up to a shift.
Every different line puts its segments in an index by (length, segment, content) and
probes it, for each length up to its own, with the substrings at the shifts that t
edits leave possible.  Pairs are then verified by a banded bit-parallel edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Scratch, carried, documents, row_hash

THRESHOLD = 1
MIN_CHARS = 20
#: Rows up to which a table of line keys (24 bytes a row) is broadcast.
BROADCAST_ROWS = 1_000_000
#: Letters whose counts tell most different lines apart before they are read.
_COUNTED = "eatn"
_LAST = 2**63 - 1


def banded_distance(a: str, b: str, threshold: int) -> Column:
    """Edit distance of two text columns whose lengths differ by at most ``threshold``
    (up to 30), exact where it is within it and above it otherwise.

    The band of 2t + 1 diagonals of the distance matrix is kept as bit words of its
    vertical +1 and -1 steps; each character of ``b`` moves the band down one row."""
    k = threshold
    full = (1 << (2 * k + 1)) - 1
    let = lambda value, name, body: f"transform(array({value}), {name} -> {body})[0]"
    chars = lambda c: f"filter(split({c}, ''), ch -> ch != '')"
    # Before the first and behind the last row there is no character to match.
    match = " + ".join(f"if(j - {k} + {p} between 1 and s.m and get(s.ca, j - {k} + {p} - 1) = get(s.cb, j - 1), {1 << p}L, 0L)" for p in range(2 * k + 1))
    below = f"(s.m - j + {k})"
    step = let(
        match, "x",
        let(
            f"((((x & acc.vp) + acc.vp) ^ acc.vp) | x | acc.vn) & {full}L", "d",
            let(
                f"named_struct('d', d, 'hp', (acc.vn | ({full}L & ~(d | acc.vp))), 'hn', d & acc.vp)", "w",
                f"named_struct('vp', (w.hn | ({full}L & ~(shiftright(w.d, 1) | w.hp))), 'vn', shiftright(w.d, 1) & w.hp, "
                f"'score', acc.score + if(j + {k} <= s.m, if((w.d & {1 << (2 * k)}L) = 0, 1, 0), "
                f"cast(shiftright(w.hp, cast({below} as int)) & 1 as int) - cast(shiftright(w.hn, cast({below} as int)) & 1 as int)))",
            ),
        ),
    )
    start = f"named_struct('vp', {full & ~((1 << k) - 1)}L, 'vn', 0L, 'score', least(s.m, {k}))"
    run = f"if(s.n = 0, s.m, aggregate(sequence(1, s.n), {start}, (acc, j) -> {step}, acc -> acc.score))"
    sized = let(f"named_struct('ca', {chars(a)}, 'cb', {chars(b)})", "q", "named_struct('ca', q.ca, 'cb', q.cb, 'm', size(q.ca), 'n', size(q.cb))")
    return F.expr(let(sized, "s", run))


def _segments(length: str, k: int) -> list[tuple[str, str]]:
    """(start from 0, size) of the k + 1 segments, as SQL over a length: even sizes,
    the longer ones last."""
    longer = f"({length} % {k + 1})"
    base = f"cast({length} div {k + 1} as int)"
    out = []
    for i in range(k + 1):
        start = f"({i} * {base} + greatest(0, {i} - ({k + 1} - {longer})))"
        size = f"({base} + if({i} >= {k + 1} - {longer}, 1, 0))"
        out.append((start, size))
    return out


def segment_keys(k: int) -> tuple[Column, Column]:
    """(index keys, probe keys): arrays of long, for columns ``line`` and ``len``."""
    key = lambda length, i, start, size: f"xxhash64(cast({length} as int), {i}, substring(line, cast({start} as int) + 1, cast({size} as int)))"
    index = [key("len", i, s, n) for i, (s, n) in enumerate(_segments("len", k))]
    probes = []
    for less in range(k + 1):
        length = f"(len - {less})"
        for i, (s, n) in enumerate(_segments(length, k)):
            # The i-th segment moved by d: i edits at most before it, k - i behind it
            # seen from either end, and the shift on both sides makes k at most.
            for d in range(-k, k + 1):
                if abs(d) <= i and abs(d - less) <= k - i and abs(d) + abs(d - less) <= k:
                    probes.append(f"if({s} + {d} >= 0 and {s} + {d} + {n} <= len, {key(length, i, f'{s} + {d}', n)}, null)")
    return F.expr(f"array({', '.join(index)})"), F.expr(f"array_compact(array({', '.join(probes)}))")


def _letters() -> Column:
    """Counts of four letters in one long, 16 bits each (clipped, which only brings
    counts nearer)."""
    parts = [F.shiftleft(F.least(F.col("len") - F.length(F.replace(F.col("line"), F.lit(c), F.lit(""))), F.lit(0x7FFF)).cast("long"), 16 * i) for i, c in enumerate(_COUNTED)]
    total = parts[0]
    for p in parts[1:]:
        total = total.bitwiseOR(p)
    return total


def _letters_differ(a: str, b: str) -> Column:
    part = lambda c, i: F.shiftright(c, 16 * i).bitwiseAND(F.lit(0xFFFF))
    return sum(F.abs(part(a, i) - part(b, i)) for i in range(len(_COUNTED)))


def _rows(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), carried(docs))
    return rows.select("doc_id", "text", F.coalesce("doc_id", F.lit(_LAST)).alias("rank"), row_hash().alias("rid"), "carried")


def _lines(rows: DataFrame, min_chars: int) -> DataFrame:
    lines = rows.select("rank", "rid", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    lines = lines.withColumn("len", F.length("line")).where(F.col("len") >= min_chars)
    return lines.withColumn("h", F.xxhash64("line")).withColumn("g", F.hash("line", "len"))


def repeated_lines(rows: DataFrame, scratch: Scratch, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """rid and line_no of every repeat (a line's rid is a hash of its document)."""
    lines = _lines(rows, min_chars)
    index, probes = segment_keys(threshold)
    place = F.struct("rank", "rid", "line_no")
    facts = lines.select("h", "g", "len", place.alias("at"), _letters().alias("letters"), index.alias("index"), probes.alias("probes"))
    # Reduced in the map tasks first: a line of a third of all documents is one row each.
    different = facts.groupBy("h", "g").agg(F.min("at").alias("at"), F.first("len").alias("len"), F.first("letters").alias("letters"), F.first("index").alias("index"), F.first("probes").alias("probes"), F.count(F.lit(1)).alias("n"))
    different = scratch.save(different, "lines")

    shorter = different.select("h", "g", "at", "len", "letters", F.explode("index").alias("key"))
    longer = different.select("h", "g", "at", "len", "letters", F.explode("probes").alias("key"))
    a, b = shorter.alias("a"), longer.alias("b")
    near = (
        (F.col("a.key") == F.col("b.key"))
        & F.col("b.len").between(F.col("a.len"), F.col("a.len") + threshold)
        & ((F.col("a.len") < F.col("b.len")) | (F.col("a.at") < F.col("b.at")))
        & (_letters_differ("a.letters", "b.letters") <= 2 * threshold)
    )
    later = F.col("a.at") < F.col("b.at")
    ends = [F.when(later, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(n) for x, y, c, n in (("a", "b", "h", "h0"), ("a", "b", "g", "g0"), ("b", "a", "h", "h1"), ("b", "a", "g", "g1"))]
    pairs = scratch.save(a.join(b, near).select(*ends).distinct(), "pairs")

    # The texts of the lines in pairs, from each one's first place
    wanted = pairs.select(F.col("h0").alias("h"), F.col("g0").alias("g")).union(pairs.select("h1", "g1")).distinct()
    wanted = scratch.save(wanted.join(different.select("h", "g", "at"), ["h", "g"]).select("h", "g", "at.rank", "at.rid", "at.line_no"), "wanted")
    small = F.broadcast if wanted.count() <= BROADCAST_ROWS else (lambda x: x)
    texts = scratch.save(lines.join(small(wanted), ["h", "g", "rank", "rid", "line_no"]).select("h", "g", "line").dropDuplicates(["h", "g"]), "texts")
    both = pairs.join(texts.select(F.col("h").alias("h0"), F.col("g").alias("g0"), F.col("line").alias("line0")), ["h0", "g0"])
    both = both.join(texts.select(F.col("h").alias("h1"), F.col("g").alias("g1"), F.col("line").alias("line1")), ["h1", "g1"])
    edited = both.where(banded_distance("line0", "line1", threshold) <= threshold).select(F.col("h1").alias("h"), F.col("g1").alias("g")).distinct()

    # A line that has an earlier near one goes everywhere; of the others the first stays.
    marked = different.select("h", "g", "at", "n").join(edited.withColumn("edited", F.lit(True)), ["h", "g"], "left")
    marked = scratch.save(marked.where("n > 1 or edited").select("h", "g", "at", F.coalesce("edited", F.lit(False)).alias("edited")), "marked")
    # Both sides are plain scans, so a frequent line's rows can be split between tasks.
    hits = lines.select("h", "g", "rank", "rid", "line_no").join(marked, ["h", "g"])
    return hits.where(F.col("edited") | (F.struct("rank", "rid", "line_no") != F.col("at"))).select("rid", "line_no")


def dedup_lines(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text without its repeated lines, n_lines, n_removed, and carried, the
    other columns.

    Rows equal in doc_id and text are one document, answered for each row; among other
    rows of one doc_id the smaller row hash is earlier; NULL doc_ids come last.  NULL
    texts stay NULL (0 lines), empty texts empty (1 line); lines shorter than
    ``min_chars`` stay; an empty table gives no rows."""
    scratch = Scratch(docs.sparkSession, "lines")
    rows = _rows(docs)
    gone = repeated_lines(rows, scratch, threshold, min_chars)
    places = gone.groupBy("rid").agg(F.array_sort(F.collect_set("line_no")).alias("gone"))
    joined = rows.select("rid", "doc_id", "text", "carried").join(places, "rid", "left")
    lines = F.expr("split(text, '\\n', -1)")
    # Kept lines are the slices between removed ones.
    kept = F.expr(
        "transform(array(split(text, '\\n', -1)), ls -> array_join(flatten(transform(sequence(0, size(gone)), "
        "j -> slice(ls, if(j = 0, 0, gone[j - 1] + 1) + 1, coalesce(get(gone, j), size(ls)) - if(j = 0, 0, gone[j - 1] + 1)))), '\\n'))[0]"
    )
    return joined.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        "carried",
    )


def q_line_dedup(spark, sf_dir) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_removed")
