"""BPE encoding and decoding with a pair occurrence index.

Texts are cut into pre-tokens. The distinct pre-tokens of a batch that no earlier
batch of the worker has met are laid end to end in one symbol list. An index holds,
for each pair of neighbouring symbols, every position at which it stands. The active
merge ranks are applied in ascending order: all positions of the pair with the lowest
rank are merged, and only the lists of the pairs that this touches change. Merges
never cross a pre-token, so this equals merging each pre-token for itself.

Defined results: a null text counts as empty and has no ids; a text of any length is
encoded whole; equal rows give equal rows; an empty table gives an empty table. Other
columns are carried along, and one that has the name of an output is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import tokenizer_path

VOCABULARY = "byte_bpe_50k.json"

#: Pre-tokens that a worker remembers at most, in each of two generations.
CACHE_LIMIT = 250_000
#: Longer pre-tokens are not remembered.
CACHE_MAX_CHARS = 64

# The characters of Latin-1 that are letters, numbers and white space.
_LATIN_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_LATIN_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
_SPACE_WIDE = _SPACE + "  -     　"


def _category_ranges(category: str) -> str:
    """The code points of one general category, or of all that begin so, as the inside of a character class."""
    out, start = [], None
    for cp in range(sys.maxunicode + 2):
        inside = cp <= sys.maxunicode and unicodedata.category(chr(cp)).startswith(category)
        if inside and start is None:
            start = cp
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{cp - 1:08x}")
            start = None
    return "".join(out)


def _byte_level_pattern(letter: str, number: str, space: str) -> re.Pattern:
    return re.compile(
        f" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{number}]+| ?[^{space}{letter}{number}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


def _word_pattern(letter: str, number: str, space: str) -> re.Pattern:
    return re.compile(f"[{letter}]+|'(?:[stmd]|re|ve|ll)|[{number}]|[^{space}{letter}{number}]+")


@lru_cache(maxsize=None)
def splitter(kind: str, wide: bool) -> re.Pattern:
    """The pre-tokenizing pattern; the narrow one is exact for Latin-1 texts and much faster."""
    make = {"byte_level": _byte_level_pattern, "word": _word_pattern}[kind]
    if wide:
        return make(_category_ranges("L"), _category_ranges("N"), _SPACE_WIDE)
    return make(_LATIN_L, _LATIN_N, _SPACE)


@lru_cache(maxsize=1)
def _unassigned() -> re.Pattern:
    """Code points that Python's Unicode tables don't know; a tokenizer's may."""
    return re.compile(f"[{_category_ranges('Cn')}]")


def split_byte_level(text: str) -> list[str]:
    """The pre-tokens of a text without special strings."""
    if is_latin1(text):
        return splitter("byte_level", False).findall(text)
    if _unassigned().search(text):
        from tokenizers import pre_tokenizers

        cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(text)
        return [text[start:end] for _, (start, end) in cut]
    return splitter("byte_level", True).findall(text)


def is_latin1(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PairIndexBpe:
    """Encoder and decoder for a byte-level BPE vocabulary file."""

    def __init__(self, path: str = VOCABULARY, cache_limit: int = CACHE_LIMIT):
        self.cache_limit = cache_limit
        with open(tokenizer_path(path), encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        byte_ids = np.zeros(256, np.int64)
        for ch, b in alphabet.items():
            byte_ids[b] = vocab[ch]
        self.byte_ids = byte_ids
        keys, self._left, self._right, self._merged = [], [], [], []
        for pair in spec["model"]["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            keys.append(vocab[left] << 32 | vocab[right])
            self._left.append(vocab[left])
            self._right.append(vocab[right])
            self._merged.append(vocab[left + right])
        #: left id << 32 | right id -> rank, for single pairs and (sorted) for whole arrays
        self.rank_of = {k: rank for rank, k in enumerate(keys)}
        self._by_key = np.argsort(np.array(keys, np.int64))
        self._keys = np.array(keys, np.int64)[self._by_key]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(alphabet[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._special_packed = {t: struct.pack("<I", i) for t, i in self.special.items()}
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    # -- the pair occurrence index

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Packed token ids of each word, all words merged together."""
        ends = np.cumsum([len(w) for w in words])
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        n = len(ids)
        if n == 0:
            return [b"" for _ in words]
        nxt = np.arange(1, n + 1)
        prv = np.arange(-1, n - 1)
        nxt[ends[ends > 0] - 1] = -1
        prv[ends[ends < n]] = -1
        prv[0] = -1

        # rank -> all positions of its pair; every pair has one rank
        pairs = ids[:-1] << 32 | ids[1:]
        found = np.minimum(np.searchsorted(self._keys, pairs), len(self._keys) - 1)
        at = np.flatnonzero((self._keys[found] == pairs) & (nxt[:-1] >= 0))
        ranks = self._by_key[found[at]]
        order = np.argsort(ranks, kind="stable")
        active, starts = np.unique(ranks[order], return_index=True)
        active = active.tolist()
        where = {r: p.tolist() for r, p in zip(active, np.split(at[order], starts[1:]))}

        sym, nxt, prv = ids.tolist(), nxt.tolist(), prv.tolist()
        rank_of, lefts, rights, results = self.rank_of, self._left, self._right, self._merged
        heappush, heappop = heapq.heappush, heapq.heappop
        while active:
            rank = heappop(active)
            left, right, merged = lefts[rank], rights[rank], results[rank]
            positions = where.pop(rank)
            if left == right:
                positions.sort()  # of overlapping occurrences the leftmost is merged
            high = merged << 32
            for i in positions:
                j = nxt[i]
                if j < 0 or sym[i] != left or sym[j] != right:
                    continue  # an earlier merge took one of the two
                sym[i] = merged
                sym[j] = -1
                k = nxt[i] = nxt[j]
                if k >= 0:
                    prv[k] = i
                    r = rank_of.get(high | sym[k])
                    if r is not None:
                        if r in where:
                            where[r].append(i)
                        else:
                            where[r] = [i]
                            heappush(active, r)
                h = prv[i]
                if h >= 0:
                    r = rank_of.get(sym[h] << 32 | merged)
                    if r is not None:
                        if r in where:
                            where[r].append(h)
                        else:
                            where[r] = [h]
                            heappush(active, r)
        left_over = np.array(sym, np.int64)
        alive = left_over >= 0
        tokens = left_over[alive].astype("<u4").tobytes()
        bounds = (np.cumsum(alive)[np.maximum(ends, 1) - 1] * 4).tolist()
        out, start = [], 0
        for w, end in zip(words, bounds):
            if w:
                out.append(tokens[start:end])
                start = end
            else:
                out.append(b"")
        return out

    # -- texts

    def _learn(self, tokens: set[str]) -> dict[str, bytes]:
        """Packed ids for all of ``tokens``; short ones stay in the worker's cache."""
        if len(self._new) > self.cache_limit:
            self._old, self._new = self._new, {}
        new, old = self._new, self._old
        missing = []
        for t in tokens.difference(new):
            known = old.get(t)
            if known is None:
                missing.append(t)
            else:
                new[t] = known
        long: dict[str, bytes] = {}
        # in slices, so that the index stays small beside one batch of texts
        for s in range(0, len(missing), 50_000):
            part = missing[s : s + 50_000]
            for t, ids in zip(part, self.merge_words([t.encode() for t in part])):
                (new if len(t) <= CACHE_MAX_CHARS else long)[t] = ids
        return long

    def _pieces(self, text: str) -> list[str]:
        if self._special is None or not any(s in text for s in self.special):
            return split_byte_level(text)
        out = []
        for i, part in enumerate(self._special.split(text)):
            out.extend([part] if i % 2 else split_byte_level(part))
        return out

    def encode_batch(self, texts: list[str], specials: bool = True) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers.

        With ``specials`` the strings of added tokens give their ids, else they
        are ordinary text.
        """
        out: list[bytes] = []
        group: list[list[str]] = []
        distinct: set[str] = set()
        held = 0
        for text in texts:
            pieces = self._pieces(text) if specials else split_byte_level(text)
            group.append(pieces)
            distinct.update(pieces)
            held += len(pieces)
            if held > 500_000:
                out.extend(self._pack(group, distinct, specials))
                group, distinct, held = [], set(), 0
        out.extend(self._pack(group, distinct, specials))
        return out

    def _pack(self, group: list[list[str]], distinct: set[str], specials: bool) -> list[bytes]:
        reserved = {t: self._special_packed[t] for t in distinct & self._special_packed.keys()} if specials else {}
        long = self._learn(distinct.difference(reserved))
        look = self._new
        if long or reserved:
            extra = long | reserved
            return [b"".join([extra[p] if p in extra else look[p] for p in pieces]) for pieces in group]
        get = look.__getitem__
        return [b"".join(map(get, pieces)) for pieces in group]

    def decode(self, packed: bytes) -> str:
        ids = memoryview(packed).cast("I") if sys.byteorder == "little" else struct.unpack(f"<{len(packed) // 4}I", packed)
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(path: str = VOCABULARY, cache_limit: int = CACHE_LIMIT) -> PairIndexBpe:
    """One codec, with its cache, for each worker process."""
    return PairIndexBpe(path, cache_limit)


def _with(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    names = {f.name.lower() for f in fields}
    return T.StructType([f for f in schema.fields if f.name.lower() not in names] + list(fields))


def slices(batch: pa.RecordBatch, rows: int = 1024):
    """Parts of a batch, so that what Python holds of long texts stays small."""
    for s in range(0, max(batch.num_rows, 1), rows):
        yield batch.slice(s, rows)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens", path: str = VOCABULARY) -> DataFrame:
    """Adds ``ids`` (packed little-endian unsigned 32-bit integers) and ``n_tokens``."""
    schema = _with(df.schema, T.StructField(ids, T.BinaryType(), False), T.StructField(n_tokens, T.LongType(), False))
    kept = schema.names[:-2]

    def run(batches):
        bpe = codec(path)
        for whole in batches:
            for batch in slices(whole):
                packed = bpe.encode_batch([t or "" for t in batch.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in kept] + [pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64())],
                    names=schema.names,
                )

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", text: str = "decoded", path: str = VOCABULARY) -> DataFrame:
    """Adds ``text``, the text of the packed ``ids``; ill-formed UTF-8 gives U+FFFD."""
    schema = _with(df.schema, T.StructField(text, T.StringType(), False))
    kept = schema.names[:-1]

    def run(batches):
        bpe = codec(path)
        for whole in batches:
            for batch in slices(whole):
                out = [bpe.decode(p or b"") for p in batch.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(out, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)
