"""Token counts by rank-synchronous array merging.

Texts are normalised and split into pre-tokens over arrays of code points.  All
pre-tokens of a block that are not yet known are held as one ragged array of symbols;
in each round every sequence applies its own lowest-rank pair, all sequences at once,
until no pair has a rank.  The symbols that survive are counted.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import BLOCK_BYTES, blocks, documents, run_hashes, ship_package, trim, utf8_parts

#: A document above this many tokens is over the limit.
TOKEN_LIMIT = 2048
#: Counts of pre-tokens that a worker keeps; beyond it they are merged anew.
CACHE_WORDS = 2_000_000
#: Longer sequences take their ranks from a queue, so their work is not symbols x rounds.
LONG_SEQUENCE = 512
NO_RANK = np.int64(1 << 40)

#: Bytes that byte-level files write as themselves (printable Latin-1); the others are
#: written as the signs from U+0100 on, in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The split that has an array form here; any other is left to the library.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Endings that the pattern takes off behind an apostrophe.
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")
#: Below it no character changes under NFC, whatever stands beside it.
FIRST_COMBINING = 0x300
OTHER, LETTER, NUMBER, SPACE = range(4)


def byte_signs() -> list[str]:
    """The sign of each byte in the vocabulary of a byte-level file."""
    signs, extra = [], 256
    for b in range(256):
        if b in _PRINTABLE:
            signs.append(chr(b))
        else:
            signs.append(chr(extra))
            extra += 1
    return signs


class MergeTable:
    """Symbols and ranked pairs of a BPE file."""

    def __init__(self, model: dict):
        if model.get("type", "BPE") != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("rank-synchronous merging takes plain BPE files")
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        signs = byte_signs()
        self.inner = np.array([vocab[s] for s in signs], dtype=np.int64)
        self.last = np.array([vocab[s + end] for s in signs], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.width = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.ranks = np.argsort(keys, kind="stable")
        self.keys = keys[self.ranks]
        # A rank is unsafe where its symbol may at once form a pair of a lower rank:
        # then only the leftmost pair may merge before ranks are compared again.
        lowest = np.full(self.width, len(pairs))
        for r in range(len(pairs) - 1, -1, -1):
            a, b = divmod(int(keys[r]), self.width)
            lowest[a] = lowest[b] = r
        self.unsafe = lowest[self.merged] < np.arange(len(pairs))

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, NO_RANK where they do not merge."""
        if not len(self.keys):
            return np.full(len(a), NO_RANK)
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def count(self, data: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Symbols that survive in each run of bytes; all lengths are positive."""
        sym = self.inner[data]
        ends = np.cumsum(length)
        sym[ends - 1] = self.last[data[ends - 1]]
        out = np.zeros(len(length), dtype=np.int64)
        long = length > LONG_SEQUENCE
        for i in np.flatnonzero(long).tolist():
            out[i] = self._count_long(sym[ends[i] - length[i] : ends[i]])
        short = np.flatnonzero(~long)
        if len(short):
            out[short] = self._count_rounds(sym[np.repeat(~long, length)], length[short])
        return out

    def _count_rounds(self, sym: np.ndarray, length: np.ndarray) -> np.ndarray:
        out = np.zeros(len(length), dtype=np.int64)
        seq = np.repeat(np.arange(len(length)), length)
        rank = np.full(len(sym), NO_RANK)
        inside = np.flatnonzero(seq[1:] == seq[:-1])
        rank[inside] = self.rank(sym[inside], sym[inside + 1])
        while len(sym):
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            low = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(sym)))
            done = low == NO_RANK
            if done.any():
                out[seq[starts[done]]] = size[done]
                stay = np.repeat(~done, size)
                sym, seq, rank, low, size = sym[stay], seq[stay], rank[stay], low[~done], size[~done]
                continue_from = np.cumsum(size) - size
                if not len(sym):
                    break
                starts = continue_from
            hit = rank == np.repeat(low, size)
            at = np.flatnonzero(hit)
            at = _apart(at)
            unsafe = self.unsafe[rank[at]]
            if unsafe.any():
                leftmost = np.append(True, seq[at[1:]] != seq[at[:-1]])
                at = at[leftmost | ~unsafe]
            sym[at] = self.merged[rank[at]]
            stay = np.ones(len(sym), dtype=bool)
            stay[at + 1] = False
            sym, seq, rank = sym[stay], seq[stay], rank[stay]
            at = at - np.arange(len(at))  # one symbol less for each merge before
            rank[at] = NO_RANK
            near = np.unique(np.concatenate([at, at[at > 0] - 1]))
            near = near[near + 1 < len(sym)]
            near = near[seq[near] == seq[near + 1]]
            rank[near] = self.rank(sym[near], sym[near + 1])
        return out

    def _count_long(self, sym: np.ndarray) -> int:
        """The same merges for one long sequence: positions wait in a queue by rank, and
        a linked list leads from symbol to symbol."""
        n = len(sym)
        sym, after, before = sym.copy(), np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.append(self.rank(sym[:-1], sym[1:]), NO_RANK)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def put(at: np.ndarray) -> None:
            at = at[rank[at] != NO_RANK]
            at = at[np.argsort(rank[at], kind="stable")]
            cuts = np.flatnonzero(np.diff(rank[at])) + 1
            for part in np.split(at, cuts) if len(at) else []:
                r = int(rank[part[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(queue, r)
                waiting[r].append(part)

        put(np.arange(n - 1))
        left = n
        while queue:
            r = heapq.heappop(queue)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            if self.unsafe[r] and len(at) > 1:
                put(at[1:])
                at = at[:1]
            # Overlapping pairs follow one another in the list: take every second one.
            follows = np.append(False, after[at[:-1]] == at[1:])
            run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            gone = after[at]
            sym[at] = self.merged[r]
            after[at] = after[gone]
            rank[gone] = NO_RANK
            inner = after[at] < n
            before[after[at[inner]]] = at[inner]
            left -= len(at)
            near = np.unique(np.concatenate([at, before[at][before[at] >= 0]]))
            closed = near[after[near] >= n]
            rank[closed] = NO_RANK
            near = near[after[near] < n]
            rank[near] = self.rank(sym[near], sym[after[near]])
            put(near)
        return left


def _apart(at: np.ndarray) -> np.ndarray:
    """Of positions that follow one another, every second one from the left."""
    follows = np.append(False, at[1:] == at[:-1] + 1)
    if not follows.any():
        return at
    run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
    return at[(np.arange(len(at)) - run) % 2 == 0]


class WordSplit:
    """WORD_PATTERN over arrays of code points.  Character classes and lower case are
    asked of the library; texts with characters from FIRST_COMBINING on, or whose lower
    case is longer, are normalised by the library first."""

    def __init__(self, normalizer):
        from tokenizers import normalizers

        self.normal = normalizer
        lower = normalizers.Lowercase()
        small = [lower.normalize_str(chr(c)) for c in range(FIRST_COMBINING)]
        self.lower = np.array([ord(s[0]) for s in small], dtype=np.uint32)
        self.rare = np.array([len(s) != 1 for s in small])
        self.kinds = self._ask("".join(map(chr, range(0x400))), 0x400)

    @staticmethod
    def _ask(chars: str, size: int) -> np.ndarray:
        from tokenizers import Regex, pre_tokenizers

        out = np.full(size, OTHER, dtype=np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            found = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(chars)
            out[np.array([ord(c) for run, _ in found for c in run], dtype=np.int64)] = kind
        return out

    def kind(self, codes: np.ndarray) -> np.ndarray:
        if len(codes) and int(codes.max()) >= len(self.kinds):  # once a worker
            every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
            self.kinds = self._ask(every, 0x110000)
        return self.kinds[codes]

    def words(self, codes: np.ndarray, size: np.ndarray):
        """(codes of the words, starts, lengths, row of each word) of texts that follow
        one another; ``size`` holds their code points."""
        kind = self.kind(codes)
        row = np.repeat(np.arange(len(size)), size)
        keep = kind != SPACE
        begin = np.ones(len(codes), dtype=bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER) | (row[1:] != row[:-1])
        codes, row, kind, begin = codes[keep], row[keep], kind[keep], begin[keep]
        if not len(codes):
            return codes, np.zeros(0, np.int64), np.zeros(0, np.int64), row
        # An apostrophe at the start of a split part takes an ending from the letters
        # behind it; as letters follow, it is a part of one sign.
        quote = np.flatnonzero((codes == 39) & begin)
        quote = quote[quote + 1 < len(codes)]
        quote = quote[(row[quote + 1] == row[quote]) & (kind[quote + 1] == LETTER) & begin[quote + 1] & self._beside(keep, quote)]
        if len(quote):
            padded = np.append(codes, [0, 0]).astype(np.int64)
            same = np.append(begin[1:], True)  # the letter run ends behind this place
            for end in ENDINGS:
                at = quote[padded[quote + 1] == ord(end[0])]
                if len(end) == 2:
                    at = at[(padded[at + 2] == ord(end[1])) & ~same[at + 1]]
                begin[at + 1] = False
                rest = at + 1 + len(end)
                rest = rest[rest < len(codes)]
                begin[rest] = True
        starts = np.flatnonzero(begin)
        return codes, starts, np.diff(np.append(starts, len(codes))), row[starts]

    @staticmethod
    def _beside(keep: np.ndarray, quote: np.ndarray) -> np.ndarray:
        """Whether no white space stood between a kept place and the next."""
        place = np.flatnonzero(keep)
        return place[quote + 1] == place[quote] + 1


class TokenCounter:
    """Token counts of texts, as the file at ``path`` gives them without begin, end or
    other added tokens.  Special strings inside texts count one token each, as by the
    library's default.  Pre-tokens are known by a 64-bit hash of their code points."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.merges = MergeTable(spec["model"])
        added = spec.get("added_tokens") or []
        if any(t.get("normalized") or t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in added):
            raise ValueError("added tokens must be plain strings of the raw text")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.mark = sorted({n[0] for n in names})
        self.split = WordSplit(self.library.normalizer) if self._has_word_split(spec) else None
        self.limit = cache_words
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    @staticmethod
    def _has_word_split(spec: dict) -> bool:
        steps = (spec.get("normalizer") or {}).get("normalizers") or []
        plain = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        split = len(parts) == 2 and parts[0]["type"] == "Split" and parts[0]["pattern"] == {"Regex": WORD_PATTERN} and parts[0]["behavior"] == "Removed" and parts[0]["invert"]
        return plain and split and parts[1]["type"] == "ByteLevel" and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"]

    def sections(self, text: str) -> tuple[list[str], int]:
        """The text between special strings, and how many of those there are."""
        if self.special is None:
            return [text], 0
        found = self.special.findall(text)
        return (self.special.split(text), len(found)) if found else ([text], 0)

    def count(self, column) -> np.ndarray:
        """Tokens of each text of an Arrow string column; NULL counts as empty."""
        data, texts = utf8_parts(column)
        out = np.zeros(len(texts) - 1, dtype=np.int64)
        offs = cut_long(data, texts)
        # the text of each part (that of an empty one does not matter)
        owner = np.minimum(np.searchsorted(texts, offs[:-1], side="right") - 1, len(out) - 1)
        for i, j in blocks(offs):
            raw = data[offs[i] : offs[j]]
            size = np.diff(offs[i : j + 1])
            np.add.at(out, owner[i:j], self._count_block(raw, size) if self.split else self._count_any(raw, size))
        return out

    def _count_any(self, raw: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Any other split: pre-tokens by the library, merges here."""
        out = np.zeros(len(size), dtype=np.int64)
        normal, cut = self.library.normalizer, self.library.pre_tokenizer
        back = {s: b for b, s in enumerate(byte_signs())}
        at, words, rows = 0, [], array("q")
        for r, n in enumerate(size.tolist()):
            parts, special = self.sections(raw[at : at + n].tobytes().decode("utf-8", "replace"))
            at += n
            out[r] += special
            for part in parts:
                for word, _ in cut.pre_tokenize_str(normal.normalize_str(part) if normal else part):
                    words.append(word)
                    rows.append(r)
        if words:
            distinct = dict.fromkeys(words)
            flat = np.array([back[s] for w in distinct for s in w], dtype=np.int64)
            counts = dict(zip(distinct, self.merges.count(flat, np.array([len(w) for w in distinct], dtype=np.int64)).tolist()))
            np.add.at(out, np.array(rows), np.array([counts[w] for w in words]))
        return out

    def _count_block(self, raw: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = np.zeros(len(size), dtype=np.int64)
        codes, length, row = self._normalised(raw, size, out)
        flat, starts, n, part = self.split.words(codes, length)
        if not len(starts):
            return out
        hashes, first, place = np.unique(run_hashes(flat, starts, n), return_index=True, return_inverse=True)
        got = self._known(hashes, flat, starts[first], n[first])
        out += np.bincount(row[part], weights=got[place], minlength=len(size)).astype(np.int64)
        return out

    def _normalised(self, raw: np.ndarray, size: np.ndarray, out: np.ndarray):
        """Code points of the block's texts, normalised, as (codes, lengths, row);
        special strings are cut out and counted in ``out``."""
        owner = np.repeat(np.arange(len(size)), size)
        rare = np.zeros(len(size), dtype=bool)
        rare[owner[raw >= 0xCC]] = True  # lead bytes from U+0300 on
        for mark in self.mark:
            rare[owner[raw == mark.encode("utf-8")[0]]] = True
        pair = np.flatnonzero((raw[:-1] >= 0xC0) & (raw[:-1] < 0xCC) & (raw[1:] >= 0x80))
        odd = (raw[pair].astype(np.int64) & 31) << 6 | raw[pair + 1] & 63
        rare[owner[pair[self.split.rare[odd]]]] = True
        plain = raw[~rare[owner]]
        codes, head = _code_points(plain, size[~rare])
        lengths, rows, parts = [head], [np.flatnonzero(~rare)], [self.split.lower[codes]]
        edge = np.append(0, np.cumsum(size))
        for r in np.flatnonzero(rare).tolist():
            pieces, special = self.sections(raw[edge[r] : edge[r + 1]].tobytes().decode("utf-8", "replace"))
            out[r] += special
            for piece in pieces:
                got = np.frombuffer(self.split.normal.normalize_str(piece).encode("utf-32-le"), dtype=np.uint32)
                parts.append(got)
                lengths.append(np.array([len(got)]))
                rows.append(np.array([r]))
        return np.concatenate(parts), np.concatenate(lengths), np.concatenate(rows)

    def _known(self, hashes: np.ndarray, flat: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Counts of distinct pre-tokens; those not met before are merged together."""
        if len(self.keys) > self.limit:
            self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(hashes), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            n = n[new]
            codes = flat[np.repeat(starts[new] - (np.cumsum(n) - n), n) + np.arange(n.sum())].astype(np.uint32)
            data = np.frombuffer(codes.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8"), dtype=np.uint8)
            width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
            counts = self.merges.count(data, np.add.reduceat(width, np.cumsum(n) - n))
            self.counts = np.insert(self.counts, at[new], counts)
            self.keys = np.insert(self.keys, at[new], hashes[new])
            at = np.searchsorted(self.keys, hashes)
        return self.counts[at]


def cut_long(data: np.ndarray, offs: np.ndarray, limit: int = BLOCK_BYTES) -> np.ndarray:
    """Offsets with cuts inside texts of more than ``limit`` bytes, in front of a space or
    line end behind a visible ASCII character: there no split part, special string or
    composed character goes on, so the parts' tokens are the text's."""
    more = []
    for i in np.flatnonzero(np.diff(offs) > limit).tolist():
        text = data[offs[i] : offs[i + 1]]
        ends = np.flatnonzero(((text[1:] == 32) | (text[1:] == 10)) & (text[:-1] > 32) & (text[:-1] < 127)) + 1
        at = np.searchsorted(ends, np.arange(limit, len(text), limit))
        more.append(offs[i] + np.unique(ends[at[at < len(ends)]]))
    return np.sort(np.concatenate([offs, *more]), kind="stable") if more else offs


def _code_points(raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, how many of them each text has) of UTF-8 texts below U+0300."""
    lead = (raw & 0xC0) != 0x80
    total = np.append(0, np.cumsum(lead))
    ends = np.cumsum(size)
    at = np.flatnonzero(lead)
    codes = raw[at].astype(np.uint32)
    two = np.flatnonzero(codes >= 0xC0)
    codes[two] = (codes[two] & 31) << 6 | raw[at[two] + 1] & 63
    return codes, total[ends] - total[ends - size]


_counters: dict[str, TokenCounter] = {}


def token_counter(path: str) -> TokenCounter:
    """One counter per Python worker, so its cache lives across tasks."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def _count_batches(path: str, limit: int):
    def run(batches):
        counter = token_counter(path)
        for batch in batches:
            tokens = counter.count(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(tokens), pa.array(tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
        trim()

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row.

    One narrow pass without a shuffle: texts of any length are counted whole, block by
    block.  A NULL or empty text has 0 bytes and 0 tokens; NULL doc_ids and repeated
    rows are kept, each row for itself; an empty table gives no rows; further columns
    are not read."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return rows.mapInArrow(_count_batches(tokenizer_path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def q_token_counts(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
