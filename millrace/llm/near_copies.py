"""Near copies by the similarity of word shingles.

Two texts are near copies when the sets of their shingles of ``shingle`` words have a
Jaccard similarity of at least ``similarity``; components join what such pairs connect.
Words are those of simhash. The candidates come from SimHash and its index. A text's long
fingerprint has a part for each of some 20 tables: a few leading bits, which name a node
of the table, and a code of CODE bits. Nodes are shuffled, so each text moves once for
each table, however many texts there are. Within a node the same is done again in
memory: bits of the code, as many as divide the node by NODE_SIZE, are the masked pattern
of a lower node, for several choices of bits; and within a lower node simhash's
Gray-ordered tree finds the members that differ in at most ``radius`` of 64 bits. What
differs in more than ``limit`` bits of the whole code is dropped: hardly any pair is left
that is not similar at all. Fingerprints of two texts at a similarity of 0.8 differ in up
to 0.1615 of their bits (0.19, if they have 4 and 5 shingles; both counted over all
sizes), so a pair is found in a table with a chance that follows, and there are as many
tables as let MISSED of such pairs through in all; of more similar ones fewer. Every
candidate is then verified on the shingle sets themselves, so nothing less similar is linked.

What candidates connect is one group, and the text of each candidate moves to it once. One
task holds the distinct texts of one group at a time and reports links as a forest, never
all pairs. Groups of LARGE texts and more are compared by what a single node connects.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import repeat
from math import acos, ceil, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import checkpointed, text_digest, text_or_empty
from .simhash import BROADCAST_IDS, HASH_SEED, _LOWER, _roots, components, keep_first, linked_pairs

SHINGLE = 5
SIMILARITY = 0.8
#: The share of pairs at the threshold that no table finds.
MISSED = 1e-5
#: Members that a lowest node should have.
NODE_SIZE = 128
#: Leading bits of the nodes that are shuffled; the most bits that divide these in memory; bits of a code.
OUTER, INNER, CODE = 5, 12, 192
#: The share of near codes of a node that its lower nodes should find.
FOUND = 0.95
#: Texts in groups of so many are compared by the groups of single nodes.
LARGE = 20_000
#: Texts of so few shingles are in more tables, as their votes are close.
FEW = 5

def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of the distinct shingles; fewer than ``shingle`` words form one, none give none."""
    from xxhash import xxh64_intdigest

    words = text.encode().translate(_LOWER).split()
    joined = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)] if words else []
    return np.unique(np.fromiter(map(xxh64_intdigest, joined, repeat(HASH_SEED)), np.uint64))


class Tables:
    """Tables of long fingerprints for n texts: leading bits, radius, and how many a text is in."""

    def __init__(self, n: int, similarity: float = SIMILARITY):
        self.width = max(-(-n // NODE_SIZE) - 1, 0).bit_length()
        self.outer = min(self.width, max(OUTER, self.width - INNER))
        self.inner = self.width - self.outer
        expected = acos(2 * similarity / (1 + similarity)) / pi  # two sets of equal size
        most, few = expected + 0.01, expected + 0.0385
        self.radius, self.limit = (int(bits * few + 3 * sqrt(bits * few * (1 - few))) for bits in (64 - self.width, CODE))
        self.parts = ceil(log(1 - FOUND) / log(1 - (1 - most) ** self.inner)) if self.inner else 1
        self.most, self.few = self._tables(most), self._tables(few)
        #: The codes of tables overlap, their leading bits don't.
        self.words = [k - 1 - (-(self.outer + CODE) // 64) for k in (self.most, self.few)]

    def _tables(self, differing: float) -> int:
        within = 0.99 * (1 - (1 - (1 - differing) ** self.inner) ** self.parts if self.inner else 1)
        return ceil(log(MISSED) / log(1 - (1 - differing) ** self.outer * within))

    def fingerprint(self, shingles: np.ndarray) -> bytes:
        """A bit is set where over half of the shingles' hashes have it; 64 bits of hash for each word of it."""
        n, words = len(shingles), self.words[len(shingles) <= FEW]
        votes = np.zeros(64 * words, np.int64)
        steps = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for s in range(0, n, 255):
            h = shingles[s : s + 255, None] + steps
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(31)
            votes += np.unpackbits(h.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
        return np.packbits(2 * votes > n).tobytes()

    def codes(self, prints: list[bytes]):
        """For each table the positions of the texts in it, their leading bits as a number, and their codes in words."""
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(prints):
            by_length.setdefault(len(p), []).append(i)
        for length, at in by_length.items():
            bits = np.unpackbits(np.frombuffer(b"".join(prints[i] for i in at), np.uint8).reshape(-1, length), axis=1)
            for t in range(self.few if length == 8 * self.words[1] else self.most):
                start = t * 64 + self.outer
                lead = bits[:, t * 64 : start].astype(np.int64) @ (1 << np.arange(self.outer)[::-1])
                yield t, np.array(at), lead, np.packbits(bits[:, start : start + CODE], axis=1).view(np.uint64)

    def within(self, t: int, lead: np.ndarray, words: np.ndarray):
        """The 64-bit codes of each lower part of table ``t``: the leading bits, those that divide a node, and others."""
        bits = np.ascontiguousarray(np.unpackbits(words.view(np.uint8), axis=1).T)
        head = (lead >> np.arange(self.outer)[::-1, None] & 1).astype(np.uint8)
        rng = np.random.default_rng([HASH_SEED, t])
        disjoint = CODE // max(self.inner, 1)
        for j in range(self.parts):
            if j % disjoint == 0:
                order = rng.permutation(CODE)
            places = np.roll(order, -(j % disjoint) * self.inner)[: 64 - self.outer]
            whole = np.packbits(np.concatenate([head, bits[places]]), axis=0)
            yield np.ascontiguousarray(whole.T).view(">u8").reshape(-1).astype(np.uint64)

    def pattern(self, codes: np.ndarray) -> np.ndarray:
        """The leading ``width`` bits of 64-bit codes."""
        return (codes >> np.uint64(32) >> np.uint64(32 - self.width)).view(np.int64)

    def windows(self, prints: list[bytes]):
        """For each lower part of each table the positions of the texts in it, and their 64-bit codes."""
        for t, at, lead, words in self.codes(prints):
            for j, codes in enumerate(self.within(t, lead, words)):
                yield t * self.parts + j, at, codes


def similar_roots(sets: list[np.ndarray], similarity: float = SIMILARITY) -> np.ndarray:
    """The smallest position that pairs of similar sets connect to each position; empty sets are equal.

    A set is compared through an index from shingles to the sets without a label yet,
    which is built again whenever these have halved, so that a large group that is
    nearly or wholly one component costs little more than one look at its sets.
    """
    least = Fraction(str(similarity))
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    known, at = np.unique(np.concatenate(sets), return_inverse=True)
    label = np.full(n, -1)

    def index() -> tuple[np.ndarray, np.ndarray, int]:
        """Where the holders of each shingle begin among ``holders``: sets without a label, ascending."""
        free = np.repeat(label < 0, sizes)
        own = at[free]
        order = np.argsort(own, kind="stable")
        begin = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(known)))])
        return begin, np.repeat(np.arange(n, dtype=np.int32), sizes)[free][order], int((label < 0).sum())

    begin, holders, indexed = index()
    for s in range(n):
        if label[s] >= 0:
            continue
        label[s] = s
        reached = [s]
        while reached and (label < 0).any():
            v = reached.pop()
            mine = at[first[v] : first[v + 1]]
            counts = begin[mine + 1] - begin[mine]
            places = np.repeat(begin[mine] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            common = np.bincount(holders[places], minlength=n)
            near = (label < 0) & (least.denominator * common >= least.numerator * (sizes[v] + sizes - common))
            label[near] = s
            reached += np.flatnonzero(near).tolist()
            if 2 * int((label < 0).sum()) <= indexed:
                begin, holders, indexed = index()
    return label


def _with_vertex(docs: DataFrame) -> DataFrame:
    """All copies of a text are one vertex."""
    return docs.select(text_digest(text_or_empty("text")).alias("vertex"), text_or_empty("text").alias("text"))


def _prints(texts: DataFrame, shingle: int, tables: Tables) -> DataFrame:
    """vertex, its fingerprint and a number for it."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                prints = [tables.fingerprint(shingle_set(t, shingle)) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.binary())], names=["vertex", "print"])

    prints = texts.mapInArrow(run, "vertex binary, print binary").dropDuplicates(["vertex"])
    return checkpointed(prints.withColumn("id", F.monotonically_increasing_id()))


def _groups(prints: DataFrame, tables: Tables) -> DataFrame:
    """The distinct groups of texts that the nodes connect, as sorted arrays of numbers."""

    def deal(batches):
        for whole in batches:
            for batch in slices(whole, 10_000):
                ids = batch.column(0).to_numpy()
                for t, at, lead, words in tables.codes(batch.column(1).to_pylist()):
                    order = np.argsort(lead, kind="stable")
                    starts = np.flatnonzero(np.diff(lead[order], prepend=-1))
                    ends = np.append(starts, len(order)).astype(np.int32)
                    columns = [(ids[at[order]], ends), (words[order].view(np.int64).reshape(-1), ends * np.int32(words.shape[1]))]
                    lists = [pa.ListArray.from_arrays(pa.array(e), pa.array(c)) for c, e in columns]
                    yield pa.RecordBatch.from_arrays([pa.array(t << tables.outer | lead[order][starts]), *lists], names=["node", "ids", "words"])

    def connected(node: int, ids: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
        """The groups of one node."""
        n = len(ids)
        label = np.arange(n)

        def near(order: np.ndarray, codes: np.ndarray):
            for i, j in linked_pairs(tables.pattern(codes)[order], codes[order], tables.radius, known=label[order]):
                i, j = order[i], order[j]
                alike = np.bitwise_count(words[i] ^ words[j]).sum(axis=1, dtype=np.int64) <= tables.limit
                yield label[i[alike]], label[j[alike]]

        if n > 1:
            t, lead = node >> tables.outer, node & ((1 << tables.outer) - 1)
            for codes in tables.within(t, np.full(n, lead), words):
                label = _roots(n, near(np.argsort(codes, kind="stable"), codes))[label]
        at = np.flatnonzero(np.bincount(label, minlength=n)[label] > 1)
        at = at[np.lexsort((ids[at], label[at]))]
        starts = np.flatnonzero(np.diff(label[at], prepend=-1))
        members = pa.ListArray.from_arrays(pa.array(np.append(starts, len(at)).astype(np.int32)), pa.array(ids[at]))
        return pa.RecordBatch.from_arrays([members], names=["members"])

    def run(batches):
        node, ids, words = None, [], []

        def groups() -> pa.RecordBatch:
            return connected(node, np.concatenate(ids), np.concatenate(words).view(np.uint64).reshape(-1, CODE // 64))

        for batch in batches:
            keys = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
                if keys[s] != node:
                    if ids:
                        yield groups()
                    node, ids, words = int(keys[s]), [], []
                ids.append(batch.column(1).slice(s, e - s).flatten().to_numpy())
                words.append(batch.column(2).slice(s, e - s).flatten().to_numpy())
        if ids:
            yield groups()

    nodes = prints.select("id", "print").mapInArrow(deal, "node long, ids array<long>, words array<long>")
    return nodes.repartition("node").sortWithinPartitions("node").mapInArrow(run, "members array<long>").distinct()


def _members(groups: DataFrame, large: int) -> tuple[DataFrame, DataFrame | None]:
    """group and id: of what groups connect, and of the groups in what has ``large`` texts or more."""
    joined = components(groups.select(F.explode("members").alias("a"), F.col("members")[0].alias("b")))
    whole = joined.select("component", "vertex").unionByName(joined.select("component", F.col("component").alias("vertex")).distinct())
    crowded = checkpointed(whole.groupBy("component").count().filter(F.col("count") >= large).select("component"))
    if crowded.isEmpty():
        return whole.toDF("group", "id"), None
    first = whole.join(crowded, "component", "left_semi").select(F.col("vertex").alias("first"))
    again = groups.join(first, F.col("members")[0] == F.col("first"), "left_semi")
    again = checkpointed(again.withColumn("group", F.monotonically_increasing_id())).select("group", F.explode("members").alias("id"))
    return whole.join(crowded, "component", "left_anti").toDF("group", "id"), again


def _links_in(texts: DataFrame, members: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """Verified links of all groups; a task reads its groups one after another and holds one at a time."""

    def once(batches):
        """Of the copies of a text in a task one moves."""
        seen = set()
        for batch in batches:
            new = []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(new, pa.bool_()))

    def run(batches):
        group, vertices, sets = None, [], []

        def links() -> pa.RecordBatch:
            label = similar_roots(sets, similarity) if len(sets) > 1 else np.arange(len(sets))
            linked = np.flatnonzero(label != np.arange(len(label)))
            a, b = ([vertices[i] for i in at.tolist()] for at in (linked, label[linked]))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

        for whole in batches:
            for batch in slices(whole):
                for g, vertex, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if g != group:
                        if len(sets) > 1:
                            yield links()
                        group, vertices, sets = g, [], []
                    if not vertices or vertex != vertices[-1]:
                        vertices.append(vertex)
                        sets.append(shingle_set(text, shingle))
        if len(sets) > 1:
            yield links()

    members = checkpointed(members)
    if members.count() <= BROADCAST_IDS:  # then only the candidates' texts move
        members = F.broadcast(members)
    rows = texts.join(members, "vertex").select("group", "vertex", "text").mapInArrow(once, "group long, vertex binary, text string")
    return rows.repartition("group").sortWithinPartitions("group", "vertex").mapInArrow(run, "a binary, b binary")


def similar_texts(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, large: int = LARGE) -> DataFrame:
    """vertex (``text_digest``) and component (its smallest vertex) of every text that has a near copy."""
    texts = _with_vertex(docs)
    tables = Tables(docs.count(), similarity)
    prints = _prints(texts, shingle, tables)
    whole, crowded = _members(checkpointed(_groups(prints, tables)), large)
    vertices = prints.select("id", "vertex")
    # a group that holds all that is connected has the components, too
    found = _links_in(texts, whole.join(vertices, "id").select("group", "vertex"), similarity, shingle).select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    if crowded is None:
        return checkpointed(found)
    return checkpointed(found.unionByName(components(_links_in(texts, crowded.join(vertices, "id").select("group", "vertex"), similarity, shingle))))


def first_of_similar(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component of near copies, with all its columns: that of the smallest doc_id.

    Exact copies, repeated rows and rows without a doc_id count as copies like any others.
    """
    return keep_first(docs, similar_texts(docs, similarity, shingle))
