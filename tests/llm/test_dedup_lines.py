import random

import pytest

from fleetlens.llm.line_dedup import banded_distance, dedup_lines
from fleetlens.llm.substring_dedup import remove_repeats, units


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, line, n):
    line = list(line)
    for _ in range(n):
        at = rng.randrange(len(line) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            line.insert(at, rng.choice("abcé "))
        elif line:
            at = min(at, len(line) - 1)
            line[at : at + 1] = [rng.choice("xyzß")] if kind == 1 else []
    return "".join(line)


def schema(extra=""):
    return "doc_id long, text string" + extra


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_banded_distance_is_exact_within_the_threshold(spark, threshold):
    rng = random.Random(threshold)
    pairs = []
    for _ in range(250):
        a = "".join(rng.choice("abcé") for _ in range(rng.randrange(0, 12)))
        b = edited(rng, a, rng.randrange(0, threshold + 2)) if rng.random() < 0.8 else "".join(rng.choice("abcé") for _ in range(len(a)))
        if abs(len(a) - len(b)) <= threshold:
            pairs.append((a, b))
    pairs += [("", ""), ("a", ""), ("", "a"), ("abc", "abc")]
    for r in spark.createDataFrame(pairs, "a string, b string").withColumn("d", banded_distance("a", "b", threshold)).collect():
        want = distance(r.a, r.b)
        assert (r.d == want) if want <= threshold else (r.d > threshold), r


def brute_lines(docs, threshold, min_chars):
    rows = sorted({(d if d is not None else 2**63 - 1, t) for d, t in docs if t is not None})
    seen, out = [], {}
    for d, t in rows:
        kept = []
        for line in t.split("\n"):
            again = len(line) >= min_chars and any(line == s or abs(len(line) - len(s)) <= threshold and distance(line, s) <= threshold for s in seen)
            if len(line) >= min_chars:
                seen.append(line)
            if not again:
                kept.append(line)
        out[d, t] = "\n".join(kept)
    return out


@pytest.mark.parametrize("threshold", [1, 2])
def test_line_dedup_equals_brute_force(spark, threshold):
    rng = random.Random(7)
    pool = ["".join(rng.choice("abcdeté ") for _ in range(rng.randrange(6, 30))) for _ in range(40)]
    docs = []
    for i in range(120):
        docs.append((i, "\n".join(edited(rng, rng.choice(pool), rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(rng.randrange(0, 6)))))
    docs += [(200, None), (201, ""), (None, pool[0]), (202, "\n\n"), (203, "\n".join([pool[1]] * 300)), (5, docs[5][1])]
    want = brute_lines(docs, threshold, 8)
    got = dedup_lines(spark.createDataFrame([(*d, "x", 1) for d in docs], schema(", line string, rid int")), threshold, 8).collect()
    assert len(got) == len(docs)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r.text)
    for d, t in docs:
        assert (None if t is None else want[d if d is not None else 2**63 - 1, t]) in by_id[d], (d, t)


def test_line_dedup_of_an_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], schema())).count() == 0


def test_units_join_up_to_the_text():
    for t in ("", "a. b! c\nd", "...... x.y\n\n. ", "no end", "\n", "a" * 1000 + "." * 5000 + "x"):
        spans = units(t)
        assert "".join(t[a:b] for a, b in spans) == t and all(a < b for a, b in spans)


def brute_repeats(docs, min_words):
    first = {}
    norm = lambda u: " ".join(u.lower().split())
    for d, t in docs:
        for a, b in units(t or ""):
            k = norm(t[a:b])
            r = d if d is not None else 2**63 - 1
            first[k] = min(first.get(k, r), r)
    out = []
    for d, t in docs:
        r, seen, flags = d if d is not None else 2**63 - 1, set(), []
        for a, b in units(t or ""):
            k = norm(t[a:b])
            flags.append((a, b, len(k.split()), bool(k) and (first[k] < r or k in seen), not k))
            seen.add(k)
        spans, i = [], 0
        while i < len(flags):
            if not flags[i][3]:
                i += 1
                continue
            j = i
            while j < len(flags) and (flags[j][3] or flags[j][4]):
                j += 1
            if sum(f[2] for f in flags[i:j]) >= min_words:
                spans.append((flags[i][0], flags[j - 1][1]))
            i = j
        out.append((d, t, spans))
    return out


def test_substring_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    sentence = lambda: " ".join(rng.choice("ab cd ef gh ij".split()) + str(rng.randrange(60)) for _ in range(rng.randrange(2, 9))).capitalize() + rng.choice(".!?")
    passages = [" ".join(sentence() for _ in range(4)) for _ in range(6)]
    docs = []
    for i in range(80):
        parts = [rng.choice(passages) if rng.random() < 0.3 else sentence() for _ in range(rng.randrange(0, 8))]
        docs.append((i, rng.choice(["\n", " "]).join(parts)))
    docs += [(100, None), (101, ""), (None, passages[0]), (102, (passages[1] + "\n") * 50), (103, " \n \n"), (104, passages[2].upper())]
    got = remove_repeats(spark.createDataFrame([(*d, 5) for d in docs], schema(", rank int")), 10).collect()
    found = {r.doc_id: r for r in got}
    assert len(got) == len(docs)
    for d, t, spans in brute_repeats(docs, 10):
        assert [(s.start, s.end) for s in found[d].removed] == spans, d
        if t is not None:
            kept, at = "", 0
            for a, b in spans:
                kept, at = kept + t[at:a], b
            assert found[d].text == kept + t[at:]
    assert found[100].text is None and found[101].text == ""


def test_substring_dedup_answers_repeated_rows_and_empty_tables(spark):
    text = "one two three four five six. " * 3
    got = remove_repeats(spark.createDataFrame([(1, text), (1, text), (2, text)], schema()), 5).collect()
    assert sorted((r.doc_id, len(r.removed)) for r in got) == [(1, 1), (1, 1), (2, 1)]
    assert remove_repeats(spark.createDataFrame([], schema())).count() == 0
