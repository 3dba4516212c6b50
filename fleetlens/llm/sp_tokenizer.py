"""SentencePiece models on the tokenizers library.

The model file (a protobuf) is read here: pieces with scores and types, the trainer's
model type and byte fallback, the normaliser's rules.  From them a tokenizers backend
is rebuilt: normaliser, "▁" for spaces, unigram scores or merge ranks, byte fallback.
Batches are encoded by the library on several threads; ``parity`` compares each text's
ids with those of the sentencepiece library.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Scratch, blocks, documents, utf8_parts
from fleetlens.llm.tokens import ChunkCache, ids_crc32

SPACE = "▁"
#: Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
#: Threads of the library in a task.
THREADS = 2


def _fields(data: bytes):
    """(number, wire type, value) of a protobuf message."""
    at, end = 0, len(data)

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < end:
        tag = varint()
        wire = tag & 7
        if wire == 0:
            value = varint()
        elif wire == 2:
            size = varint()
            value = data[at : at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[wire]
            value = data[at : at + size]
            at += size
        yield tag >> 3, wire, value


class Model:
    """What a SentencePiece model file says."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.byte_fallback, self.unk_id = UNIGRAM, False, 0
        self.charsmap, self.dummy_prefix, self.trim, self.escape, self.suffix = b"", True, True, True, False
        for number, _, value in _fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, _, v in _fields(value):
                    if n == 1:
                        piece = v.decode("utf-8")
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                self.pieces.append((piece, score, kind))
            elif number == 2:
                for n, _, v in _fields(value):
                    if n == 3:
                        self.kind = v
                    elif n == 24:
                        self.suffix = bool(v)
                    elif n == 35:
                        self.byte_fallback = bool(v)
            elif number == 3:
                for n, _, v in _fields(value):
                    if n == 2:
                        self.charsmap = v
                    elif n == 3:
                        self.dummy_prefix = bool(v)
                    elif n == 4:
                        self.trim = bool(v)
                    elif n == 5:
                        self.escape = bool(v)
        unknown = [i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN]
        self.unk_id = unknown[0] if unknown else 0
        if self.kind not in (UNIGRAM, BPE) or self.suffix or not self.escape:
            raise ValueError("only unigram and BPE models with escaped spaces in front are rebuilt")


def backend(model: Model):
    """The tokenizers backend of a model; it takes text whose spaces are already "▁"."""
    from tokenizers import AddedToken, Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        # Only normal and user-defined pieces are found in text: the others get names from
        # a private area of Unicode.  Byte pieces keep theirs, for the fallback, so a text
        # with the letters "<0x41>" themselves may differ; ``parity`` tells.
        worst = min((s for _, s, k in model.pieces if k == NORMAL), default=0.0)
        found = (NORMAL, USER_DEFINED)
        vocab = [(p if k in (*found, BYTE) else f"\U000F0000{i}", s if k in found else worst) for i, (p, s, k) in enumerate(model.pieces)]
        core = models.Unigram(vocab, model.unk_id, model.byte_fallback)
    else:
        ids = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        score = {p: s for p, s, k in model.pieces if k in (NORMAL, USER_DEFINED)}
        # sentencepiece joins the neighbours whose joined piece scores best, whatever
        # the two parts: every split into two pieces is a merge of that rank.
        merges = []
        for piece, s in sorted(score.items(), key=lambda x: (-x[1], ids[x[0]])):
            merges += [(piece[:i], piece[i:]) for i in range(1, len(piece)) if piece[:i] in score and piece[i:] in score]
        core = models.BPE(ids, merges, unk_token=model.pieces[model.unk_id][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    out = Tokenizer(core)
    own = [AddedToken(p, normalized=False) for p, _, k in model.pieces if k == USER_DEFINED]
    if own:
        out.add_tokens(own)
    out.decoder = decoders.Sequence([decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()])
    out.encode_special_tokens = True
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    return out, normalizers.Sequence(steps) if steps else None


class SentencePieceTokenizer:
    """Encoder and decoder of one model file (as bytes)."""

    def __init__(self, data: bytes, threads: int = THREADS):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.model = Model(data)
        self.library, self.rules = backend(self.model)
        pieces = [p for p, _, k in self.model.pieces if k in (NORMAL, USER_DEFINED)]
        # Where no piece has "▁" behind another sign, merges never cross such a place:
        # chunks (spaces, then other signs) are encoded apart, each different one once.
        self.by_chunk = self.model.kind == BPE and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.plain = self.by_chunk and self.rules is None and not self.model.trim and self.model.dummy_prefix
        self.cache = ChunkCache(chunk_starts(self.model), lambda chunks: self._library([c.replace(" ", SPACE) for c in chunks]))
        self.bytes = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode() if k in (NORMAL, USER_DEFINED) else b"" for p, _, k in self.model.pieces]
        self.bytes[self.model.unk_id] = " ⁇ ".encode()

    def normalise(self, text: str) -> str:
        """The text as the model sees it, spaces escaped."""
        if self.rules is not None:
            text = self.rules.normalize_str(text)
        if self.model.trim:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        if self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", SPACE)

    def _library(self, texts: list[str]) -> list[list[int]]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        got = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return got

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        texts = [self.normalise(t) for t in texts]
        if not self.by_chunk:
            return [np.array(ids, dtype=np.uint32) for ids in self._library(texts)]
        data, offs = utf8_parts(pa.array([t.replace(SPACE, " ") for t in texts], pa.large_string()))
        return [ids for i, j in blocks(offs) for ids in self.cache.encode(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])]

    def encode_column(self, column) -> list[np.ndarray]:
        """The ids (uint32) of each text of an Arrow string column; NULL is empty."""
        if not self.plain:
            return self.encode(pc.fill_null(column, "").to_pylist())
        data, offs = utf8_parts(column)
        out = []
        for i, j in blocks(offs):
            at = offs[i : j + 1] - offs[i]
            full = np.diff(at) > 0  # texts get a space in front, but empty ones
            text = np.insert(data[offs[i] : offs[j]], at[:-1][full], 0x20)
            out += self.cache.encode(text, at + np.concatenate([[0], np.cumsum(full)]))
        return out

    def decode(self, ids) -> str:
        raw = b"".join(map(self.bytes.__getitem__, np.asarray(ids).tolist())).decode("utf-8", "replace")
        return raw[1:] if self.model.dummy_prefix and raw.startswith(" ") else raw


def _space_runs(text: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """First bytes of the chunks: runs of spaces, and the texts' starts."""
    space = text == 0x20
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[edges] = True
    return np.flatnonzero(first)


def chunk_starts(model: Model):
    """How a block of texts is cut into chunks.  Where every unknown sign falls back to its
    bytes, a merge can only cross two neighbours that stand side by side in a piece: texts
    are cut between all others (as byte pairs, which rules out some more cuts).  Else
    neighbouring unknown signs are one id, and texts are cut at runs of spaces alone."""
    if not model.byte_fallback or sum(k == BYTE for _, _, k in model.pieces) < 256:
        return _space_runs
    joined = np.zeros((256, 256), dtype=bool)
    joined[:, 0x80:0xC0] = True  # inside a sign
    joined[0x20, 0x20] = True
    for a, b in {ab for p, _, k in model.pieces if k in (NORMAL, USER_DEFINED, UNUSED) for ab in zip(p, p[1:])}:
        # "▁" stands for a space, and for itself where a text holds it
        for x in (" ", SPACE) if a == SPACE else a:
            for y in (" ", SPACE) if b == SPACE else b:
                joined[x.encode()[-1], y.encode()[0]] = True
    apart = ~joined.ravel()

    def starts(text: np.ndarray, edges: np.ndarray) -> np.ndarray:
        first = np.zeros(len(text), dtype=bool)
        first[1:] = apart[text[:-1].astype(np.uint16) << 8 | text[1:]]
        first[edges] = True
        return np.flatnonzero(first)

    return starts


_loaded: dict[int, SentencePieceTokenizer] = {}


def tokenizer(data: bytes, threads: int) -> SentencePieceTokenizer:
    """One tokenizer per Python worker, so its cache lives across tasks.  (A task's own
    function is sent with copies of the globals it names; this one is imported.)"""
    if hash(data) not in _loaded:
        _loaded[hash(data)] = SentencePieceTokenizer(data, threads)
    return _loaded[hash(data)]


def _rows(model, threads: int, verify: bool):
    def run(batches):
        data = model.value
        tok = tokenizer(data, threads)
        if verify:
            import sentencepiece

            other = sentencepiece.SentencePieceProcessor(model_proto=data)
        for batch in batches:
            column = pc.fill_null(batch.column(1), "")
            _, offs = utf8_parts(column)
            for i, j in blocks(offs):
                texts = column[i:j].to_pylist()
                ids = tok.encode_column(column[i:j])
                decoded = [tok.decode(x) for x in ids]
                same = [a.tolist() == b for a, b in zip(ids, other.encode(texts, num_threads=threads))] if verify else [None] * len(ids)
                at = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(ids).astype(np.int32))), pa.array(decoded, pa.string()), pa.array([t == d for t, d in zip(texts, decoded)]), pa.array(same, pa.bool_()), pa.array([ids_crc32(x) for x in ids], pa.int64())],
                    names=["doc_id", "ids", "decoded", "round_trip", "parity", "ids_crc32"],
                )

    return run


def encode_documents(docs: DataFrame, model: bytes, threads: int = THREADS, verify: bool = True) -> DataFrame:
    """doc_id, ids, decoded, round_trip (decoded equals the text), parity (ids equal those
    of the sentencepiece library) and ids_crc32 of every row.

    A NULL text counts as empty and has no ids; repeated rows are answered each; NULL
    doc_ids are kept; further columns are not read; an empty table gives no rows.
    ``model`` is the model file's content; it is broadcast (half a megabyte)."""
    Scratch(docs.sparkSession, "pieces")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_rows(shared, threads, verify), "doc_id long, ids array<int>, decoded string, round_trip boolean, parity boolean, ids_crc32 long")


def q_sentencepiece(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        out = encode_documents(documents(spark, sf_dir), f.read())
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"), "round_trip", "parity")
