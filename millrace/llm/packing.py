"""Vector bin packing of token sequences with the dot-product heuristic.

A piece asks for three things at once: tokens, one segment, and loss-bearing tokens.
Each sequence has a limit for all three. The piece put next into a sequence is the one
that fits and has the largest dot product of its demand with what is left, both
relative to the limits. If none fits, the piece with the largest product is cut and
its head fills the sequence. Items longer than a sequence first give whole sequences.

Every task packs its own rows out of a bounded pool, so nothing is shuffled and a task
that is run again gives the same sequences. What remains at a task's end is dealt into
sequences whose lengths are powers of two and which need no padding.

Defined results: a null text counts as empty, its only id is the end mark; an item of
any length is cut; equal rows are packed each for itself; a null doc_id is kept; an
item without ids gives no piece; an empty table gives none. Other columns are left out.
"""

from __future__ import annotations

import json
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .bpe import byte_alphabet, is_latin1, slices, splitter
from .common import tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
MAX_TOKENS, MAX_SEGMENTS, MAX_LOSS = 1024, 64, 1024
#: Pieces that a task holds at once; which of them share a sequence depends on it.
POOL = 1536
PIECE_CACHE = 400_000

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class _PieceIds(dict):
    """Packed ids of a pre-token, asked from the tokenizer when first met."""

    def __init__(self, ids_of):
        self.ids_of = ids_of

    def __missing__(self, piece: str) -> bytes:
        packed = self.ids_of(piece)
        if len(piece) <= 64:
            if len(self) >= PIECE_CACHE:
                self.clear()
            self[piece] = packed
        return packed


class DocumentIds:
    """Ids of whole texts under a tokenizer, plus the end mark.

    Where the tokenizer cuts texts as the byte-level pattern does and changes nothing
    before, Latin-1 texts are cut here and their pre-tokens looked up. All others, and
    texts with a special string, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(path))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        spec = json.loads(self.tokenizer.to_str())
        cut = spec["pre_tokenizer"] or {}
        self.by_piece = spec["normalizer"] is None and cut.get("type") == "ByteLevel" and not cut["add_prefix_space"] and cut.get("use_regex", True)
        self.pieces = _PieceIds(self._merged(spec["model"]) if self.by_piece else self._whole)
        self.end = struct.pack("<I", END_ID)

    def _merged(self, model: dict):
        """Packed ids of one pre-token, by merging alone where the ids follow the order of the merges."""
        import tiktoken

        vocab, alphabet = model["vocab"], byte_alphabet()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if model["type"] != "BPE" or any(vocab[a + b] != len(alphabet) + k for k, (a, b) in enumerate(merges)):
            return self._whole
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if i < len(alphabet) + len(merges)}
        encoding = tiktoken.Encoding("pre-tokens", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

        def ids_of(piece: str) -> bytes:
            ids = encoding.encode_ordinary(piece)
            return struct.pack(f"<{len(ids)}I", *ids)

        return ids_of

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if not self.by_piece or not is_latin1(text) or any(s in text for s in self.special):
            return self._whole(text) + self.end
        return b"".join(map(self.pieces.__getitem__, splitter("byte_level", False).findall(text))) + self.end


@lru_cache(maxsize=2)
def document_ids(path: str = VOCABULARY) -> DocumentIds:
    return DocumentIds(path)


class Packer:
    """Packs the items of one task; ``add`` and ``finish`` yield pieces.

    A piece is (doc_id, start, length, ids, doc_tokens, sequence, offset).
    """

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int, first_sequence: int = 0, pool: int = POOL):
        if min(max_tokens, max_segments, max_loss, pool) < 1:
            raise ValueError("all limits are at least 1")
        self.limits = np.array([max_tokens, max_segments, max_loss], np.float64)
        self.max_tokens, self.max_segments, self.max_loss = max_tokens, max_segments, max_loss
        self.next_sequence = first_sequence
        self.size = pool
        self.items: list[tuple | None] = []  # (doc_id, ids from base on, start, end, doc_tokens, sums of loss or None, base)
        self.tokens = np.zeros(0)
        self.loss = np.zeros(0)

    @staticmethod
    def _loss(item, start, end) -> int:
        sums = item[5]
        return end - start if sums is None else int(sums[end] - sums[start])

    def _head(self, item, tokens: int, loss: int) -> int:
        """The longest head of an item within both limits."""
        _, _, start, end, _, sums, _ = item
        stop = min(end, start + tokens)
        if sums is None:
            return min(stop - start, loss)
        return int(np.searchsorted(sums, sums[start] + loss, side="right")) - 1 - start if sums[stop] - sums[start] > loss else stop - start

    def _piece(self, item, length: int, sequence: int, offset: int):
        doc_id, ids, start, _, doc_tokens, _, base = item
        at = 4 * (start - base)
        return doc_id, start, length, ids[at : at + 4 * length], doc_tokens, sequence, offset

    def add(self, doc_id, ids: bytes, loss_mask: bytes | None = None):
        n = len(ids) // 4
        if loss_mask is not None and (len(loss_mask) != n or loss_mask.strip(b"\0\1")):
            raise ValueError("a loss mask has a byte for each id, 0 or 1")
        sums = None if loss_mask is None else np.concatenate([[0], np.cumsum(np.frombuffer(loss_mask, np.uint8), dtype=np.int64)])
        start = 0
        while n - start >= self.max_tokens:
            item = (doc_id, ids, start, n, n, sums, 0)
            length = self._head(item, self.max_tokens, self.max_loss)
            if length < self.max_tokens:
                break
            yield self._piece(item, length, self.next_sequence, 0)
            self.next_sequence += 1
            start += length
        while start < n:  # more than one part only where loss is the scarce thing
            item = (doc_id, ids, start, n, n, sums, 0)
            stop = start + self._head(item, self.max_tokens, self.max_loss)
            self.items.append((doc_id, ids[4 * start : 4 * stop], start, stop, n, sums, start))
            start = stop
        if len(self.items) >= self.size:
            yield from self._pack(keep=True)

    def finish(self):
        yield from self._pack(keep=False)

    def _pack(self, keep: bool):
        """Packs the pool; with ``keep`` the last sequence's pieces stay in it."""
        self.tokens = np.array([i[3] - i[2] for i in self.items], np.float64)
        self.loss = np.array([self._loss(i, i[2], i[3]) for i in self.items], np.float64)
        total = float(self.tokens.sum())
        while total > 0:
            chosen, total = self._fill(total)
            length = sum(n for _, n in chosen)
            if total <= 0 and length < self.max_tokens:
                left = [(*i[:3], i[2] + n, *i[4:]) for i, n in chosen]
                if keep:
                    self.items = left
                    return
                yield from self._powers_of_two(left)
            else:
                yield from self._emit(chosen)
        self.items = []

    def _fill(self, total: float):
        """The pieces of one sequence as (item, length), and the tokens still in the pool."""
        max_tokens, max_segments, max_loss = self.limits
        room, segments, loss = max_tokens, max_segments, max_loss
        chosen = []
        while room > 0 and segments > 0 and total > 0:
            score = self.tokens * (room / max_tokens**2) + self.loss * (loss / max_loss**2)  # a segment is the same for all
            score[self.tokens <= 0] = -1.0
            fits = np.where((self.tokens <= room) & (self.loss <= loss), score, -1.0)
            k = int(fits.argmax())
            if fits[k] >= 0:
                n = int(self.tokens[k])
            else:
                k = int(score.argmax())
                n = self._head(self.items[k], int(room), int(loss))
                if n <= 0:
                    break
            item = self.items[k]
            used = self._loss(item, item[2], item[2] + n)
            chosen.append((item, n))
            self.items[k] = (*item[:2], item[2] + n, *item[3:])
            self.tokens[k] -= n
            self.loss[k] -= used
            room -= n
            loss -= used
            segments -= 1
            total -= n
        return chosen, total

    def _emit(self, chosen):
        offset = 0
        for item, n in chosen:
            yield self._piece(item, n, self.next_sequence, offset)
            offset += n
        self.next_sequence += 1

    def _powers_of_two(self, items):
        """The last pieces of a task in sequences of descending powers of two."""
        left = sum(i[3] - i[2] for i in items)
        k = 0
        while left > 0:
            size = 1 << (left.bit_length() - 1)
            chosen, room = [], size
            while room > 0:
                item = items[k]
                n = min(room, item[3] - item[2])
                chosen.append((item, n))
                items[k] = (*item[:2], item[2] + n, *item[3:])
                k += item[2] + n == item[3]
                room -= n
            yield from self._emit(chosen)
            left -= size


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in range(7)]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in PIECES.split(", ")])


def pack(
    items: DataFrame,
    ids: str | None = None,
    loss_mask: str | None = None,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = MAX_LOSS,
    path: str = VOCABULARY,
) -> DataFrame:
    """Pieces of all items with their sequences; see ``PIECES``.

    ``ids`` names a column of packed ids, for example of formatted turns, and
    ``loss_mask`` one with a byte for each of them, 0 or 1, anything else fails; without ``ids`` the ``text`` is
    encoded and ended by id 0. Without ``loss_mask`` every id bears loss, as in plain
    documents, and a ``max_loss`` of ``max_tokens`` never binds; with the masks of
    formatted turns all three limits do. A limit below 1 is an error.
    """
    if min(max_tokens, max_segments, max_loss) < 1:
        raise ValueError("all limits are at least 1")
    columns = ["doc_id", ids or "text"] + ([loss_mask] if loss_mask else [])

    def run(batches):
        encode = None if ids else document_ids(path).encode
        packer = Packer(max_tokens, max_segments, max_loss, TaskContext.get().partitionId() << 33)
        rows: list[tuple] = []
        for whole in batches:
            for batch in slices(whole, 256):
                given = batch.column(1).to_pylist()
                masks = batch.column(2).to_pylist() if loss_mask else [None] * len(given)
                for doc_id, value, mask in zip(batch.column(0).to_pylist(), given, masks):
                    rows.extend(packer.add(doc_id, encode(value or "") if encode else value or b"", mask))
                if rows:
                    yield _batch(rows)
                    rows = []
        yield _batch(list(packer.finish()))

    return items.select(*columns).mapInArrow(run, PIECES)
