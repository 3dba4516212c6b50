import hashlib
import random
import re
import struct
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from fleetlens.llm import sp_tokenizer
from fleetlens.llm.common import Scratch
from fleetlens.llm.components import components
from fleetlens.llm.embedding_dedup import near_vectors
from fleetlens.llm.fm_quality import fit_quality, machine, score_quality
from fleetlens.llm.ngram_join import similar_documents
from fleetlens.llm.packing import packed_digest, piece_lengths
from fleetlens.llm.simhash import fingerprint_report, near_fingerprints, simhash
from fleetlens.llm.sp_tokenizer import SentencePieceTokenizer, encode_documents
from fleetlens.llm.token_binary import decode_ids, encode_ids, read_block, read_shard, shard_bytes, token_digest
from fleetlens.llm.toxicity_chain import fit_toxicity, score_toxicity

tokenizers = pytest.importorskip("public_tokenizers")
ODD = [(None, "null id"), (3, None), (4, ""), (5, " \n\t "), (6, "a"), (6, "a"), (7, "Ünïcode ﬁ 日本 text. " * 3), (8, "long " * 30_000)]


def table(spark, rows, extra=True):
    """Documents with further columns whose names clash with the operators' own."""
    if extra:
        return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, node string, row int, start int")
    return spark.createDataFrame(rows, "doc_id long, text string")


def library(name):
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(tokenizers.path(name))
    out.encode_special_tokens = True
    return lambda t: out.encode(t or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_gives_every_id_once_in_powers_of_two(spark):
    assert piece_lengths(5000) == [2048, 2048, 512, 256, 128, 8]
    got = packed_digest(table(spark, ODD), tokenizers.path("word_bpe_49k.json")).collect()
    ids_of = library("word_bpe_49k.json")
    want = sorted((d or -1, crc(ids), len(ids), s, n) for d, t in ODD for whole in [[*ids_of(t), 1]] for s, n in [(sum(piece_lengths(len(whole))[:i]), n) for i, n in enumerate(piece_lengths(len(whole)))] for ids in [whole[s : s + n]])
    assert sorted((r.doc_id or -1, r.ids_crc32, r.length, r.start, r.length) for r in got) == want
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and {r.offset for r in got} == {0}
    assert packed_digest(table(spark, []), tokenizers.path("word_bpe_49k.json")).count() == 0


def test_blocks_of_ids_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, 5000):
        for high in (1, 2, 50_257, 2**32):
            ids = rng.integers(0, high, n).astype(np.uint32)
            ids[::37] = 2**32 - 1
            starts, body = encode_ids(ids, 512)
            assert np.array_equal(decode_ids(starts, body, n), ids)
    parts = [rng.integers(0, 50_000, k).astype(np.uint32) for k in (3, 0, 700)]
    content = shard_bytes([5, None, 9], parts)
    names, back = read_shard(content)
    assert names == [5, None, 9] and all(np.array_equal(a, b) for a, b in zip(parts, back))
    assert np.array_equal(read_block(content, 1), np.concatenate(parts)[256:512])


def test_token_files_hold_all_documents_in_order(spark):
    got = token_digest(table(spark, ODD), tokenizers.path("byte_bpe_50k.json")).orderBy("start").collect()
    ids_of, at = library("byte_bpe_50k.json"), 0
    for r, (d, t) in zip(got, sorted(ODD, key=lambda x: (x[0] is not None, x[0], x[1] or "")), strict=True):
        ids = [*ids_of(t), 0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids), crc(ids))
        at += len(ids)
    assert token_digest(table(spark, []), tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_fingerprint_report_equals_its_definition(spark):
    rows = [r for r in ODD if r[0] is not None] + [(i, f"word{i} and more words {i % 3}") for i in range(20, 60)]
    got = fingerprint_report(table(spark, rows)).collect()
    ordered = sorted(rows, key=lambda x: (x[0], x[1] or ""))
    want = []
    for k, (d, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        want.append((d, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest(), simhash([t])[0].tobytes().hex()))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint) for r in got) == sorted(want)
    assert fingerprint_report(table(spark, [])).count() == 0
    assert fingerprint_report(table(spark, [(1, "alone")])).first().near_next == 1.0


def test_near_fingerprints_finds_all_pairs(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(128) for _ in range(20)]
    prints = {b ^ sum(1 << p for p in rng.sample(range(128), k)) for b in base for k in (0, 1, 2, 3, 5)}
    want = {(f"{a:032x}", f"{b:032x}") for a in prints for b in prints if f"{a:032x}" < f"{b:032x}" and (a ^ b).bit_count() <= 3}
    df = spark.createDataFrame([(i, f"{p:032x}") for i, p in enumerate([*prints, *prints])], "doc_id long, fingerprint string")
    assert {(r.fingerprint_a, r.fingerprint_b) for r in near_fingerprints(df, 3).collect()} == want


def brute_components(docs):
    sets = []
    for d, t in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        words = [w.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))) for w in words]
        sets.append(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    tree = list(range(len(docs)))

    def root(i):
        while tree[i] != i:
            i = tree[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and None not in (docs[i][0], docs[j][0]) and 100 * both >= 80 * len(a | sets[j]):
                tree[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d if d is not None else -1, len(sets[i]), least.get(root(i), -1)) for i, (d, _) in enumerate(docs))


def test_ngram_join_equals_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(40))
    bases = [[word() for _ in range(rng.randrange(3, 80))] for _ in range(15)]
    docs = list(ODD)
    for i in range(10, 260):
        text = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 4)):
            text[rng.randrange(len(text))] = word()
        docs.append((i, " ".join(text) if rng.random() < 0.8 else " ".join(text).upper()))
    got = similar_documents(table(spark, docs)).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id if r.component_id is not None else -1) for r in got) == brute_components(docs)
    assert similar_documents(table(spark, [])).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(50)] + [(900, 901), (903, 901), (7, 7)]
    random.Random(1).shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r.node: r.component for r in components(df, Scratch(spark, "test")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{500 + i: 500 for i in range(1, 50)}, 901: 900, 903: 900}


def test_near_vectors_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((12, 16))
    rows = [(i, (base[i % 12] + 0.15 * rng.standard_normal(16)).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]
    odd = [(300, None), (301, [0.0] * 16), (302, [float("nan")] + [1.0] * 15), (303, [None] + [1.0] * 15), (304, []), (None, rows[0][1]), (305, [1.0] * 8)]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in near_vectors(df, block=16).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    reach = near.copy()
    for _ in range(8):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    for k, (i, _) in enumerate(rows):
        assert (got[i].n_links, got[i].component_id) == (int(near[k].sum()) - 1, rows[int(np.flatnonzero(reach[k])[0])][0])
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in odd if i is not None)
    assert got[None].n_links == 0 and got[None].component_id is None
    assert near_vectors(df.limit(0)).count() == 0


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    x, w, v = rng.standard_normal(6), rng.standard_normal(6), rng.standard_normal((6, 3))
    z, _ = machine(np.zeros(6, int), np.arange(6), x, 1, 0.3, w, v)
    pairs = sum(v[i] @ v[j] * x[i] * x[j] for i in range(6) for j in range(i))
    assert abs(z[0] - (0.3 + w @ x + pairs)) < 1e-12


def test_classifiers_learn_and_answer_every_row(spark):
    rng = random.Random(4)
    words = "one two three four five six seven eight nine ten".split()
    docs, labels = list(ODD), []
    for i in range(100, 700):
        poor, toxic = rng.random() < 0.3, rng.random() < 0.3
        text = [rng.choice(words) for _ in range(40)]
        text = [w + "###" for w in text] if poor else text
        docs.append((i, " ".join([*text, *(["horrid"] if toxic else [])])))
        labels.append((i, int(not poor), int(poor), int(toxic)))
    labels += [(3, None, None, None), (None, 1, 0, 0)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, poor int, toxic int")
    truth = {d: (q, t) for d, q, _, t in labels}
    df = table(spark, docs)
    scored = score_quality(df, fit_quality(df, lab)).collect()
    assert len(scored) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    held = [r for r in scored if r.held_out and r.doc_id in truth and r.doc_id >= 100]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in scored if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id][0] for r in held]) > 0.95
    toxic = score_toxicity(df, fit_toxicity(df, lab)).collect()
    assert len(toxic) == len(docs)
    assert np.mean([r.toxic == bool(truth[r.doc_id][1]) for r in toxic if r.held_out and r.doc_id in truth and r.doc_id >= 100]) > 0.95
    none = lab.limit(0)
    assert not any(r.toxic for r in score_toxicity(df, fit_toxicity(df, none)).collect())
    assert score_quality(df, fit_quality(df, none)).count() == len(docs)
    assert score_quality(df.limit(0), fit_quality(df, lab)).count() == 0


def _field(number, payload):
    size, out = len(payload), b""
    while size > 127:
        out, size = out + bytes([size & 127 | 128]), size >> 7
    return bytes([number << 3 | 2]) + out + bytes([size]) + payload


def unigram_model():
    """A hand-written unigram model with byte fallback, as a protobuf."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [(p, s, 1) for p, s in (("▁", -3.0), ("▁the", -2.0), ("▁cat", -2.5), ("at", -3.5), ("c", -5.0), ("t", -4.0), ("h", -5.0), ("e", -4.5), ("a", -4.6), ("he", -3.7), ("s", -4.4))]
    body = b"".join(_field(1, _field(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", s) + bytes([3 << 3, k])) for p, s, k in pieces)
    trainer = bytes([3 << 3, 1]) + bytes([(35 << 3 | 0) & 127 | 128, 35 << 3 >> 7, 1])
    normal = bytes([3 << 3, 1, 4 << 3, 0, 5 << 3, 1])
    return body + _field(2, trainer) + _field(3, normal)


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_sentencepiece_parity(spark, kind):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = open(tokenizers.path("piece_bpe_32k.model"), "rb").read() if kind == "bpe" else unigram_model()
    own, other = SentencePieceTokenizer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ["", " ", "the cat", "  the  cats ", "that hat\nsat é 日", "a▁b", "<s> <unk>"]
    for t, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == other.encode(t), t
        assert own.decode(ids) == other.decode(other.encode(t)), t
    if kind == "bpe":
        rows = encode_documents(table(spark, ODD), model).collect()
        assert len(rows) == len(ODD) and all(r.parity and r.round_trip for r in rows if r.doc_id != 3)


def bpe_model(byte_fallback):
    """A hand-written BPE model whose pieces cross signs, as a protobuf."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256) if byte_fallback]
    pieces += [(p, -float(i), 1) for i, p in enumerate(("a.", "a.b", "▁a", "▁▁", "é,", "日本", "bb", "▁", "a", "b", ".", ",", "é", "日", "本"))]
    body = b"".join(_field(1, _field(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", s) + bytes([3 << 3, k])) for p, s, k in pieces)
    trainer = bytes([3 << 3, 2]) + bytes([(35 << 3 | 0) & 127 | 128, 35 << 3 >> 7, int(byte_fallback)])
    return body + _field(2, trainer) + _field(3, bytes([3 << 3, 1, 4 << 3, 0, 5 << 3, 1]))


@pytest.mark.parametrize("kind", ["file", "fallback", "unknown"])
def test_sentencepiece_cuts_keep_the_ids(kind):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = open(tokenizers.path("piece_bpe_32k.model"), "rb").read() if kind == "file" else bpe_model(kind == "fallback")
    own, other = SentencePieceTokenizer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(7)
    signs = ["a", "b", "the", "Été", "é", ".", ",", "...", '."', " ", "  ", "\n", "\r\r", "\t", "▁", "日", "本", "語", "🙂", "\u00a0", "0", "<0x0A>", "()"]
    texts = ["", "\n", "\n\n", "a.b", "a. b", "▁▁ ▁a", "é,日本"] + ["".join(rng.choices(signs, k=rng.randint(1, 40))) for _ in range(300)]
    assert [x.tolist() for x in own.encode(texts)] == other.encode(texts)
    if kind != "unknown":
        assert [x.tolist() for x in own.encode_column(pa.array(texts))] == other.encode(texts)


def test_sentencepiece_learns_words_apart_from_signs():
    own = SentencePieceTokenizer(open(tokenizers.path("piece_bpe_32k.model"), "rb").read())
    own.encode(["word other.\nword,\nother!\n;"])
    known = len(own.cache.keys)
    own.encode(["other.\nword! word,", "word;\n\nother, other!", "word\nother.\n"])
    assert len(own.cache.keys) == known


def test_sentencepiece_tokenizer_is_kept_across_tasks():
    model = bpe_model(True)
    sent = cloudpickle.dumps(sp_tokenizer._rows(SimpleNamespace(value=model), 1, False))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a.b b", None]})
    kept = []
    for _ in range(2):  # each task unpickles its function anew
        assert sum(b.num_rows for b in cloudpickle.loads(sent)([batch])) == 2
        kept.append(sp_tokenizer._loaded[hash(model)])
    assert kept[0] is kept[1]


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    import corpus_pipeline

    text = "This is a fairly long line of words that stands here once, and nowhere else at all."
    docs = [(1, text, "en", "s", len(text)), (2, text, "en", "s", len(text)), (3, None, None, None, None), (4, "", "en", "s", 0), (None, "clean words", "en", "s", 11)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = df
    for name, stage in corpus_pipeline.STAGES:
        out = Scratch(spark, "test").save(stage(spark, out, str(tmp_path)), name)
        if name != "packing":
            assert out.columns == df.columns
            assert all(r.n_chars == len(r.text) for r in out.where("text is not null").collect())
    assert sorted({r.doc_id or -1 for r in out.collect()}) == [-1, 1, 3, 4]
    empty = df.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
