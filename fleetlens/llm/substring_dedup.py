"""Substring dedup by hashing lines and the sentences in them.

Units are lines, cut further behind sentence ends, so a passage is found also where it
stands inside a longer line.  A unit is normalised (lower case, runs of white space as
one space) and hashed; digests are grouped over the whole corpus.  The occurrence of
the smallest doc_id, there the first, is kept; later ones are repeats.  A run of
neighbouring repeats of ``min_words`` words or more is removed, with the offsets it had.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import Scratch, carried, documents, row_hash

MIN_WORDS = 25
UNIT = re.compile(r"(?:[^\n.!?]++|[.!?]++(?![ \t]))*+(?:[.!?]++[ \t]++|\n|\Z)")
_LAST = 2**63 - 1


def units(text: str) -> list[tuple[int, int]]:
    """(start, end) of the units in code points; they follow one another to the end."""
    return [m.span() for m in UNIT.finditer(text) if m.end() > m.start()]


def _digest(unit: str) -> tuple[int, int, int]:
    words = unit.lower().split()
    h = xxhash.xxh3_128_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))
    return (h & (2**64 - 1)) - 2**63, (h >> 64 & (2**32 - 1)) - 2**31, len(words)


def _unit_rows(batches):
    """A row for each different unit of each document, at its first place."""
    for batch in batches:
        ranks, rids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out: list[list] = [[] for _ in range(5)]
        for rank, rid, text in zip(ranks, rids, batch.column(2).to_pylist()):
            seen = set()
            for i, (a, b) in enumerate(units(text or "")):
                h, g, n = _digest(text[a:b])
                if n and (h, g) not in seen:
                    seen.add((h, g))
                    for column, value in zip(out, (h, g, rank, rid, i)):
                        column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["h", "g", "rank", "rid", "place"])


def removed_spans(text: str, repeats: set[int], min_words: int) -> tuple[list[tuple[int, int]], int]:
    """Spans to remove, and the number of units; ``repeats``: units that an earlier
    document has.  Repeats within the text itself are found here."""
    spans, run_start, run_words, seen = [], None, 0, set()
    all_units = units(text)
    for i, (a, b) in enumerate([*all_units, (len(text), len(text))]):
        again = False
        if i < len(all_units):
            h, g, n = _digest(text[a:b])
            again = i in repeats or n == 0 and run_start is not None or (h, g) in seen
            if n:
                seen.add((h, g))
        if again:
            run_start = a if run_start is None else run_start
            run_words += n
        elif run_start is not None:
            if run_words >= min_words:
                spans.append((run_start, a))
            run_start, run_words = None, 0
    return spans, len(all_units)


def _cut(min_words: int):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            texts, removed, counts = [], [], []
            for text, places in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                spans, n = removed_spans(text or "", set(places or ()), min_words)
                kept, at = [], 0
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                texts.append("".join([*kept, text[at:]]) if spans else text)
                removed.append([{"start": a, "end": b} for a, b in spans])
                counts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(removed, spans_type), pa.array(counts, pa.int64()), batch.column(2)], names=["doc_id", "text", "removed", "n_units", "carried"])

    return run


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without its repeats, removed (array of start and end, code points of
    the original text), n_units, and carried, the other columns.

    Ranks: the smaller doc_id keeps a unit, NULL doc_ids come last; rows that share a
    doc_id keep units that they share.  Rows equal in doc_id and text are one document,
    answered for each row.  NULL texts stay NULL, empty texts empty; an empty table
    gives no rows."""
    scratch = Scratch(docs.sparkSession, "substring")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), carried(docs))
    rows = rows.select("doc_id", "text", "carried", F.coalesce("doc_id", F.lit(_LAST)).alias("rank"), row_hash().alias("rid"))
    found = rows.where("text != ''").select("rank", "rid", "text").mapInArrow(_unit_rows, "h long, g int, rank long, rid long, place int")
    # Counted before the shuffle, so a unit of a third of all documents costs a row a task
    shared = found.groupBy("h", "g").agg(F.min("rank").alias("first"), F.max("rank").alias("last")).where("first < last")
    shared = scratch.save(shared.select("h", "g", "first"), "shared")
    # Both sides are plain scans, so a frequent unit's rows can be split between tasks.
    repeats = found.join(shared, ["h", "g"]).where(F.col("rank") > F.col("first")).select("rid", "place")
    places = repeats.groupBy("rid").agg(F.collect_set("place").alias("places"))
    schema = T.StructType([*rows.select("doc_id", "text").schema.fields, *T._parse_datatype_string("removed array<struct<start:long,end:long>>, n_units long").fields, rows.schema["carried"]])
    return rows.join(places, "rid", "left").select("doc_id", "text", "carried", "places").mapInArrow(_cut(min_words), schema)


def q_substring_dedup(spark, sf_dir) -> DataFrame:
    cut = remove_repeats(documents(spark, sf_dir))
    return cut.select("doc_id", "text", "removed", "n_units")
