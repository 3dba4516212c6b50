"""Token ids by the tokenizers library, with a cache of white-space chunks.

The byte-level and word-end tokenizers split a text before they merge, and no
split part runs from a non-space character into white space.  So the ids of a text
are the ids of its chunks (white space, then non-space) one after the other; each
distinct chunk is encoded once by the library and its ids are looked up from then on.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa

from fleetlens.llm.common import SPACE_BYTES, blocks, byte_class, run_hashes, utf8_parts

# Unicode White_Space, as the tokenizers' patterns see it (Python's \s has more).
_WS = "\t-\r " + "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
CHUNK = re.compile(rf"[{_WS}]*[^{_WS}]+|[{_WS}]+\Z")
#: One space at most, then letters or signs alone: one split part each.
_JOINABLE = re.compile("( ?[A-Za-zÀ-ÖØ-öø-įı-ȿ]+|[.,!?;:]+)")
#: Byte-level tokenizers write each byte as a sign: printable Latin-1 as itself, the
#: others as the signs from U+0100 on, in order.  The line end stays, as a separator.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)} | {10: 10}
_SPACE = byte_class(SPACE_BYTES)
_SIGN = byte_class(b".,!?;:")
_ASCII_LETTER = byte_class([*range(65, 91), *range(97, 123)])
#: Lead bytes of letters of two bytes (U+00C0 to U+023F, without the signs U+00D7 and
#: U+00F7 and U+0130, whose lower case is two characters), and lead bytes under which non-ASCII white space may stand.
_LEAD = byte_class(range(0xC3, 0xC9))
_RARE = byte_class([0xC2, 0xE1, 0xE2, 0xE3])
#: Chunks that are kept; beyond it the cache starts anew (ids stay the same).
CACHE_CHUNKS = 1_000_000


def chunk_starts(text: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """First bytes of the chunks of a block of texts that start at ``edges``."""
    space = _SPACE[text]
    lead = _LEAD[text]
    after = np.append(text[1:], 0)
    lead &= ~((text == 0xC3) & ((after == 0x97) | (after == 0xB7)) | (text == 0xC4) & (after == 0xB0))
    letter = _ASCII_LETTER[text] | lead
    letter[1:] |= lead[:-1]
    first = np.zeros(len(text), dtype=bool)
    first[1:] = (space[1:] & ~space[:-1]) | (letter[:-1] & _SIGN[text[1:]])
    # A lone line end between a non-space character and a letter
    first[2:] |= (text[1:-1] == 10) & ~space[:-2] & letter[2:]
    second = edges + 1
    second = second[second < len(text)]
    first[second] = (space[second] & ~space[second - 1]) | (letter[second - 1] & _SIGN[text[second]])
    first[edges] = True
    return np.flatnonzero(first)


class ChunkCache:
    """Ids of chunks, by a hash of their bytes.  ``starts`` cuts a block of texts into
    chunks; ``chunk_ids`` gives the ids of a list of chunks."""

    def __init__(self, starts, chunk_ids, limit: int = CACHE_CHUNKS):
        self.starts, self.chunk_ids, self.limit = starts, chunk_ids, limit
        self._clear()

    def _clear(self) -> None:
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.start, self.size = array("q"), array("q")

    def _learn(self, chunks: list[str]) -> None:
        """Append the ids of new chunks, in their order."""
        got = self.chunk_ids(chunks)
        ids = np.array(list(chain.from_iterable(got)), dtype=np.uint32)
        sizes = np.array(list(map(len, got)), dtype=np.int64)
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.start.extend((self.used + np.cumsum(sizes) - sizes).tolist())
        self.size.extend(sizes.tolist())
        self.used += len(ids)

    def _rows_of(self, hashes: np.ndarray, at: np.ndarray, starts, length, text) -> np.ndarray:
        """Cache rows of sorted hashes; unknown chunks are learnt."""
        if len(self.keys) > self.limit:
            self._clear()
        place = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(hashes), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = text.tobytes()
            spans = zip(starts[at[new]].tolist(), length[at[new]].tolist())
            first = len(self.start)
            self._learn([raw[s : s + n].decode("utf-8", "surrogatepass") for s, n in spans])
            self.keys = np.insert(self.keys, place[new], hashes[new])
            self.rows = np.insert(self.rows, place[new], np.arange(first, first + len(new)))
            place = np.searchsorted(self.keys, hashes)
        return self.rows[place]

    def encode(self, text: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
        """The ids of each text of a block of bytes."""
        edges = offs[:-1][np.diff(offs) > 0]
        if not len(edges):
            return [np.zeros(0, np.uint32)] * (len(offs) - 1)
        starts = self.starts(text, edges)
        length = np.diff(np.append(starts, len(text)))
        hashes, at, row = np.unique(run_hashes(text, starts, length), return_index=True, return_inverse=True)
        place = self._rows_of(hashes, at, starts, length, text)
        n = np.array(self.size)[place]
        begin = np.array(self.start)[place][row]
        n = n[row]
        ends = np.cumsum(n)
        ids = self.flat[np.arange(ends[-1]) + np.repeat(begin - (ends - n), n)]
        last = np.concatenate([[0], ends])[np.searchsorted(starts, offs[1:-1])]
        return np.split(ids, last)


class ChunkTokenizer:
    """``path``: a tokenizers JSON file whose split never joins a non-space character
    with white space behind it, nor a letter with a sign behind it.  Special-token
    strings in a text are ordinary text.  Chunks are known by a 64-bit hash of their
    bytes: with 1,000,000 kept, one new chunk in 10^13 would be taken for another."""

    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks fill the cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.normal = self.library.normalizer
        words = [" the", "word", " Été", "ß", ".", "?!", " naïve", "Ünique"]
        self.direct = [self._ids(w) for w in words] == self._direct(words)
        self.cache = ChunkCache(chunk_starts, self._chunk_ids, cache_chunks)

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _direct(self, words: list[str]) -> list[list[int]]:
        """Ids of chunks that are one split part each: normaliser and merges only."""
        if self.normal:
            joined = self.normal.normalize_str(" ".join(w.lstrip(" ") for w in words)).replace(" ", "\n")
        else:
            joined = "\n".join(words)
        merge = self.library.model.tokenize
        return [[t.id for t in merge(w)] for w in joined.encode("utf-8").decode("latin-1").translate(_BYTE_SIGNS).split("\n")]

    def _chunk_ids(self, chunks: list[str]) -> list[list[int]]:
        match = _JOINABLE.fullmatch
        plain = [i for i, c in enumerate(chunks) if match(c)] if self.direct else []
        got: list = [None] * len(chunks)
        if plain:
            for i, ids in zip(plain, self._direct([chunks[i] for i in plain])):
                got[i] = ids
        rest = [i for i, ids in enumerate(got) if ids is None]
        for i, e in zip(rest, self.library.encode_batch_fast([chunks[i] for i in rest], add_special_tokens=False)):
            got[i] = e.ids
        return got

    def encode_column(self, column) -> list[np.ndarray]:
        """The ids (uint32) of each text of an Arrow string column; NULL is empty."""
        data, offs = utf8_parts(column)
        out: list[np.ndarray] = []
        for i, j in blocks(offs):
            part = self.cache.encode(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            rare = _RARE[data[offs[i] : offs[j]]]
            if rare.any():  # texts that may hold non-ASCII white space are cut by the pattern
                places = np.unique(np.searchsorted(offs[i : j + 1], offs[i] + np.flatnonzero(rare), side="right") - 1)
                for p in places.tolist():
                    raw = data[offs[i + p] : offs[i + p + 1]].tobytes().decode("utf-8", "surrogatepass")
                    got = self.library.encode_batch_fast(CHUNK.findall(raw), add_special_tokens=False)
                    part[p] = np.array([x for e in got for x in e.ids], dtype=np.uint32)
            out += part
        return out

    def encode(self, texts: list) -> list[np.ndarray]:
        return self.encode_column(pa.array(texts, pa.large_string()))


_loaded: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    """One tokenizer per Python worker, so its cache lives across tasks."""
    if path not in _loaded:
        _loaded[path] = ChunkTokenizer(path)
    return _loaded[path]


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
