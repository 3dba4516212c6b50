"""Token counts, phrase mining and the prefix trie against plain loops."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from fleetlens.llm.phrase_mining import mine_phrases, top_phrases
from fleetlens.llm.prefix_trie import RadixTree, prefix_trie
from fleetlens.llm.token_counts import TokenCounter, count_tokens

tokenizers = pytest.importorskip("public_tokenizers")
FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ODD_TEXTS = [
    None, "", "a", "'s", "it's", "it's's", "''s", "x'll y'Ve 'd'm 're 'r e ' s 'S İstanbul", "<|endoftext|>", "a<|endoftext|><|startoftext|>b <|endoftext| >", "é é 日本語 1234 ½ ٣ ́́x ΑΣ Σ ẞ ﬁ   \x85 \xa0 q",
    "aaaa" * 700, "ab" * 1500 + " x", "\t\n ", "rock'n'roll 'tis y'all'd've", "'ſ ' s", "K Å", "👍🏽 👨‍👩‍👧", "x" * 1200 + "́",
]


def library_counts(name, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizers.path(name))
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_counts_equal_the_library(name):
    rng = random.Random(4)
    signs = [*"abcdeéßİ '’.,123\n\tSTMDLVR<|>ΑΣσς日́가½", "<|endoftext|>", "'re", "'ll"]
    texts = [*ODD_TEXTS, *("".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(800))]
    texts += ["".join(rng.choice(letters) for _ in range(5000)) for letters in ("abcdefghijklmnopqrst", "abc", "a")]
    counter = TokenCounter(tokenizers.path(name), cache_words=50)
    want = library_counts(name, texts)
    assert counter.count(pa.array(texts)).tolist() == want
    assert counter.count(pa.array(texts[::-1])).tolist() == want[::-1]


@pytest.mark.parametrize("name", FILES)
def test_long_texts_are_cut_where_no_token_goes_on(name):
    import fleetlens.llm.token_counts as module

    rng = random.Random(9)
    signs = [*"ab é.'\n\u2003\t ", "<|endoftext|>", "  ", "'re", "\u0301", "word", "1"]
    texts = ["", "".join(rng.choice(signs) for _ in range(3000)), None, "x" * 500, "".join(rng.choice(signs) for _ in range(2000)), ""]
    data, offs = module.utf8_parts(pa.array(texts))
    cuts = module.cut_long(data, offs, 100)
    assert len(cuts) > len(offs) + 30
    raw = data.tobytes()
    parts = [raw[a:b].decode() for a, b in zip(cuts, cuts[1:])]
    assert sum(library_counts(name, parts)) == sum(library_counts(name, texts))
    whole = [texts[1] + "\n" + "some words " * 150_000, *texts]
    assert TokenCounter(tokenizers.path(name)).count(pa.array(whole)).tolist() == library_counts(name, whole)


def test_long_sequences_merge_as_short_ones(monkeypatch):
    import fleetlens.llm.token_counts as module

    table = TokenCounter(tokenizers.path(FILES[0])).merges
    rng = np.random.default_rng(2)
    words = [bytes(rng.choice(list(b"abcdehilnorst"), int(n)).tolist()) for n in rng.integers(1, 90, 300)]
    data, length = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    rounds = table.count(data, length)
    monkeypatch.setattr(module, "LONG_SEQUENCE", 0)
    assert table.count(data, length).tolist() == rounds.tolist()


def test_ranks_below_a_just_formed_symbol_merge_first():
    """A vocabulary where abc comes of (ab, c) or (a, bc), and (abc, a) ranks between."""
    from tokenizers import Tokenizer, models

    import fleetlens.llm.token_counts as module

    vocab = {s: i for i, s in enumerate([*module.byte_signs(), "bc", "abc", "abca", "ab"])}
    merges = [("b", "c"), ("abc", "a"), ("a", "bc")]
    library = Tokenizer(models.BPE(vocab=vocab, merges=merges))
    table = module.MergeTable({"vocab": vocab, "merges": [list(m) for m in merges]})
    assert table.unsafe.any()
    texts = ["abcabc", "abcabcabca", "aabcbcabc"]
    want = [len(library.encode(t).ids) for t in texts]
    data, length = np.frombuffer("".join(texts).encode(), np.uint8), np.array([len(t) for t in texts])
    assert table._count_rounds(table.inner[data].copy(), length).tolist() == want
    at = np.cumsum(length) - length
    assert [table._count_long(table.inner[data[a : a + n]]) for a, n in zip(at, length)] == want


def test_count_tokens_keeps_every_row(spark):
    rows = [(i if i else None, t, "x", 5) for i, t in enumerate(ODD_TEXTS)] + [(3, "twice", "x", 5)] * 2 + [(99, "word " * 3000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string, n_tokens int").repartition(3)
    got = Counter(tuple(r) for r in count_tokens(docs, tokenizers.path(FILES[0])).collect())
    counts = library_counts(FILES[0], [t for _, t, *_ in rows])
    assert got == Counter((d, len((t or "").encode()), n, n > 2048) for (d, t, *_), n in zip(rows, counts))
    assert count_tokens(docs.where("false"), tokenizers.path(FILES[0])).count() == 0


LOWER = {c: c + 32 for c in range(65, 91)}


def plain_phrases(rows, min_count=30, top=2000, covered=80):
    total, f = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            f[lang].update(tuple(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= min_count}
        gone = {q[i : i + k] for q, b in candidates.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if 100 * b >= covered * count[q[i : i + k]]}
        found = []
        for p, a in candidates.items():
            if p not in gone:
                score, _, left, right = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def phrase_rows():
    rng = random.Random(3)
    signs = ["a ", "b ", "C ", "\t d", "e. ", "f, ", "ÀÉ ", "\n", "x\x0by "]
    rows = [(i, "".join(rng.choice(signs) for _ in range(rng.randrange(30))), rng.choice(["en", None, "und", ""])) for i in range(500)]
    return rows + [(None, None, "en"), (1, "", "de"), (2, "only ", None), (3, "long words " * 5000, "en"), (3, "long words " * 5000, "en")]


@pytest.mark.parametrize("options", [{}, {"by_name": True}, {"broadcast_rows": 0}, {"top": 3}])
def test_phrases_equal_a_plain_count(spark, options):
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, n int, phrase string").repartition(5)
    got = sorted(tuple(r) for r in top_phrases(docs, **options).collect())
    assert len(got) >= 8 and got == plain_phrases(rows, top=options.get("top", 2000))


def test_pieces_of_long_texts_stay_whole():
    import fleetlens.llm.phrase_mining as module

    rng = random.Random(7)
    texts = ["", "".join(rng.choice(["a ", "b", "É. ", "c, ", "\n", "dd "]) for _ in range(900)), None, "x y " * 200, "z. " * 100, ""]
    langs, salts = pa.array(list("abcdef")), pa.array(range(6), pa.int64())

    def found(limit):
        module.cut_long.__defaults__ = (limit,)
        batch = pa.RecordBatch.from_arrays([langs, salts, pa.array(texts)], names=["lang", "salt", "text"])
        out = []
        for words, salt, lang in module._batch_blocks(batch):
            new = np.append(True, words.piece[1:] != words.piece[:-1])
            out += zip(words.hash.tolist(), words.pos.tolist(), new.tolist(), salt[words.row].tolist(), lang.take(pa.array(words.row)).to_pylist())
        return out

    whole = module.cut_long.__defaults__
    try:
        assert found(50) == found(1 << 20) and len(found(50)) > 500
    finally:
        module.cut_long.__defaults__ = whole


def test_no_phrases_without_words(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "", None), (3, "one", "en")], "doc_id long, text string, lang string")
    assert mine_phrases(docs).count() == 0 and mine_phrases(docs.where("false")).count() == 0


def plain_trie(rows, group=100, shares=6):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append(((t is not None, t or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    own = {c: [x[2] for x in sorted(found)] for c, found in turns.items()}
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % shares
        whole = tuple(own.get(c - c % group if c >= 0 else c + -c % group, [])[:h] + mine[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
            if d:
                kids[whole[: d - 1]].add(whole[:d])
        ends[whole].append(c)
    leaves, saved = Counter(), Counter()
    for p in sorted(members, key=len, reverse=True):
        if not kids[p]:
            leaves[p] = 1
        if p:
            saved[p] += (len(members[p]) - 1) * len(p[-1][1])
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    sha = lambda found: hashlib.sha256(",".join(map(str, sorted(found))).encode()).hexdigest()
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], sha(ends[p])) for p, m in members.items())


def mixed_turns():
    rng = random.Random(3)
    return [
        (c, None if rng.random() < 0.05 else t, rng.choice(["u", None]), rng.choice(["x", "yy", "zzé", None]))
        for c in range(-5, 300) if rng.random() > 0.1 for t in range(rng.choice([1, 2, 3, 8]))
    ]


CASES = {
    "mixed": mixed_turns(),
    "one conversation in many copies": [(c, 0, "u", "same") for c in range(300)],
    "a common start, many ends": [(c, t, "u", f"same{t}") for c in range(300) for t in range(7)] + [(c, t, "u", f"same{t}") for c in range(300, 400) for t in range(12)],
    "many children": [(c, t, "u", f"t{c if t == 3 else 0}") for c in range(500) for t in range(4)],
    "a very long one": [(100, t, "u", f"{t % 7}") for t in range(3000)] + [(c, t, "u", f"{t % 7}") for c in (150, 160) for t in range(2990)],
    "repeated rows, null ids": [(7, 1, "a", "b"), (7, 1, "a", "b"), (None, 1, "a", "c")],
    "only turnless": [(c, 0, "u", "x") for c in (1, 2, 3, 101) if zlib.crc32(str(c).encode()) % 6],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
def test_trie_equals_a_plain_one(spark, case):
    """Small batches and eight ranges, so nodes are settled early and cross tasks."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "13"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        turns = spark.createDataFrame([(*r, "x", 1) for r in CASES[case]], "conv_id long, turn int, role string, text string, path string, depth int").repartition(5)
        names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        assert Counter(tuple(r) for r in prefix_trie(turns).select(*names).collect()) == plain_trie(CASES[case])
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_tree_nodes_grow_and_hold_all_keys():
    rng = np.random.default_rng(5)
    keys = sorted({bytes(rng.integers(0, 256 if i % 2 else 30, 16, dtype=np.uint8)) for i in range(2000)})
    tree = RadixTree()
    for i, key in enumerate(keys):
        tree.insert(key, (1,), i)
    assert {type(tree.root.kids).__name__, tree.root.kids.room} == {"Every", 256}
    found, stack = [], [(tree.root, b"")]
    while stack:
        node, head = stack.pop()
        head += node.path
        found += [head] * node.n_ends
        stack += [(kid, head) for _, kid in node.kids.items()]
    assert sorted(found) == keys and tree.root.n == len(keys)
