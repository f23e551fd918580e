"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints that differ in at most ``radius`` bits agree on at least one of
``radius + 1`` bands, and so on any bits of it. The topmost nodes of the index are the
values of the leading bits of each band, as many of these as give nodes of some
NODE_SIZE members: the masked bit pattern that the members share. A node with too many
members is split the same way on the bits that its pattern leaves open, until all nodes
are small; since the distance must lie in the open bits, no pair is lost. Within a node
the members are sorted by Gray rank, so that neighbours share most bits; runs of
FAN_OUT of them form lower nodes that hold the bits common to the run, and those again
form higher ones, up to one. From there down two nodes meet with the differences that
their parents have shown; the bits that only they have fixed add to these, and a pair of
nodes whose sum exceeds the radius is pruned with all its members. This is the only way
in which members meet, in nodes of any size.

A node reports links as a forest (each linked fingerprint once), never all its pairs.
Components come from alternating star contraction over these links.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import checkpointed, free_name, joined_by_key, text_digest, text_or_empty

RADIUS = 3
SHINGLE = 3
#: Members that a topmost node should have, and those that it may have before it is split further.
NODE_SIZE, NODE_LIMIT = 256, 20_000
#: Members or nodes that form one node of the next level.
FAN_OUT = 8
HASH_SEED = 42
#: Ids of dropped documents that are sent to every task; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text: bit set where over half of the shingle hashes have it.

    Words are runs of non-blanks with A-Z lower-cased; fewer than ``shingle`` words
    form one shingle, none give 0.
    """
    from xxhash import xxh64_intdigest

    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    votes = np.zeros(64, np.int64)
    for s in range(0, n, 65536):  # long texts in parts
        part = words[s : s + 65536 + shingle - 1] if n > 1 else words
        joined = map(b" ".join, zip(*(part[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter(map(xxh64_intdigest, joined, repeat(HASH_SEED)), np.uint64)
        votes += _bit_counts(hashes)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the values have each bit, the highest bit first."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and its fingerprint as a signed 64-bit integer; a null text counts as empty."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                values = np.array([simhash(t or "", shingle) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint long")


# -- the index within one node


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code word in the reflected binary Gray code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Level:
    """Nodes of one level of many indexes: the bits that a node's members share, which bits these are, and its children."""

    def __init__(self, group: np.ndarray, pattern: np.ndarray, mask: np.ndarray, starts: np.ndarray, stops: np.ndarray):
        self.group, self.pattern, self.mask, self.starts, self.stops = group, pattern, mask, starts, stops

    def above(self) -> Level:
        """Runs of FAN_OUT nodes of a group as one node each."""
        first = np.flatnonzero(np.concatenate([[True], self.group[1:] != self.group[:-1]]))
        place = np.arange(len(self.group)) - np.repeat(first, np.diff(np.append(first, len(self.group))))
        starts = np.flatnonzero(place % FAN_OUT == 0)
        ones = np.bitwise_and.reduceat(self.pattern & self.mask, starts)  # 1 in all members
        zeros = np.bitwise_and.reduceat(~self.pattern & self.mask, starts)  # 0 in all members
        return Level(self.group[starts], ones, ones | zeros, starts, np.append(starts[1:], len(self.group)))


def _levels(group: np.ndarray, codes: np.ndarray) -> list[Level]:
    """From the members up to one node for each group; the codes of a group are in Gray order."""
    none = np.zeros(0, np.int64)
    levels = [Level(group, codes, np.full(len(codes), np.uint64(0xFFFFFFFFFFFFFFFF)), none, none)]
    while len(levels) == 1 or (levels[-1].group[1:] == levels[-1].group[:-1]).any():
        levels.append(levels[-1].above())
    return levels


def linked_pairs(group: np.ndarray, codes: np.ndarray, radius: int, visited: list[int] | None = None, known: np.ndarray | None = None):
    """All pairs of different positions of a group whose codes differ in at most ``radius`` bits.

    Equal values of ``group`` are neighbours, the codes of a group distinct. Yields
    arrays (i, j) of positions, a bounded number of node pairs at a time, so that dense
    nodes need little memory. ``visited`` takes the numbers of pairs that met. Positions
    of one ``known`` label are linked already: pairs of nodes that hold no other are left out.
    """
    if len(codes) < 2:
        return
    order = np.lexsort((gray_rank(codes), np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]))))
    levels = _levels(group[order], codes[order])
    low = high = [] if known is None else [known[order]]
    if known is not None:
        for level in levels[1:]:
            low, high = [*low, np.minimum.reduceat(low[-1], level.starts)], [*high, np.maximum.reduceat(high[-1], level.starts)]
    roots = np.arange(len(levels[-1].group))
    stack = [(len(levels) - 1, roots, roots, np.zeros(len(roots), np.int64))]
    child = np.arange(FAN_OUT)
    while stack:
        level, left, right, differences = stack.pop()
        if level == 0:
            yield order[left], order[right]
            continue
        here, below = levels[level], levels[level - 1]
        for s in range(0, len(left), 4096):
            p, q = left[s : s + 4096], right[s : s + 4096]
            a, b = here.starts[p][:, None, None] + child[:, None], here.starts[q][:, None, None] + child
            met = (a < here.stops[p][:, None, None]) & (b < here.stops[q][:, None, None]) & (a <= b if level > 1 else a < b)
            at, i, j = np.nonzero(met)
            a, b, p, q = here.starts[p[at]] + i, here.starts[q[at]] + j, p[at], q[at]
            # what the parents have compared is counted already
            fresh = below.mask[a] & below.mask[b] & ~(here.mask[p] & here.mask[q])
            total = differences[s : s + 4096][at] + np.bitwise_count((below.pattern[a] ^ below.pattern[b]) & fresh)
            if visited is not None:
                visited.append(len(a))
            near = total <= radius
            if known is not None:
                near &= np.minimum(low[level - 1][a], low[level - 1][b]) < np.maximum(high[level - 1][a], high[level - 1][b])
            if near.any():
                stack.append((level - 1, a[near], b[near], total[near]))


def _roots(n: int, pairs) -> np.ndarray:
    """The smallest position connected to each position by the pairs."""
    label = np.arange(n)

    def root(x: int) -> int:
        while label[x] != x:
            label[x] = label[label[x]]
            x = int(label[x])
        return x

    for i, j in pairs:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            continue
        for a, b in np.unique(np.stack([a[apart], b[apart]]), axis=1).T.tolist():
            a, b = root(a), root(b)
            if a != b:
                label[max(a, b)] = min(a, b)
        while not np.array_equal(label, higher := label[label]):
            label = higher
    return label


def node_links(group: np.ndarray, vertices: np.ndarray, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole nodes, given as runs of equal ``group``: (vertex, a smaller vertex of its tree)."""
    crowded = np.zeros(len(group), bool)
    same = group[1:] == group[:-1]
    crowded[1:] |= same
    crowded[:-1] |= same
    at = np.flatnonzero(crowded)
    by_vertex = at[np.argsort(vertices[at], kind="stable")]
    place = np.empty(len(group), np.int64)
    place[by_vertex] = np.arange(len(by_vertex))
    label = _roots(len(by_vertex), ((place[at[i]], place[at[j]]) for i, j in linked_pairs(group[at], codes[at], radius)))
    linked = np.flatnonzero(label != np.arange(len(label)))
    return vertices[by_vertex[linked]], vertices[by_vertex[label[linked]]]


# -- the upper nodes


def _bands(open_bits: list[int], radius: int) -> list[list[int]]:
    """The open bits in radius + 1 bands of nearly equal width."""
    k = radius + 1
    return [open_bits[i * len(open_bits) // k : (i + 1) * len(open_bits) // k] for i in range(k)]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def _top_width(n: int, radius: int) -> int:
    """Leading bits of a band whose values divide n fingerprints into nodes of some NODE_SIZE."""
    return min(max(-(-n // NODE_SIZE) - 1, 0).bit_length(), 64 // (radius + 1))


@lru_cache(maxsize=65_536)
def _next_masks(mask: int, radius: int, depth: int, width: int) -> tuple[int, ...]:
    """The masks of the nodes below those of a mask, which says which bits a node's pattern fixes.

    The topmost nodes fix ``width`` bits of their band, the next the whole of it, those
    below a band of the open bits each.
    """
    fixed = [b for b in range(64) if mask >> b & 1]
    if depth == 0:
        following = [band[len(band) - width :] for band in _bands(list(range(64)), radius)]
    elif depth == 1:
        following = [band for band in _bands(list(range(64)), radius) if set(fixed) <= set(band)]
    else:
        following = [fixed + band for band in _bands([b for b in range(64) if b not in set(fixed)], radius)]
    return tuple(sorted({_mask(x) for x in following}))


def _split(nodes: DataFrame, radius: int, depth: int, width: int) -> DataFrame:
    """Each member under its nodes of the next level."""

    def run(batches):
        for batch in batches:
            vertex, code, mask = (batch.column(c).to_numpy() for c in ("vertex", "code", "mask"))
            for m in np.unique(mask).tolist():
                at = np.flatnonzero(mask == m)
                for below in _next_masks(m, radius, depth, width):
                    columns = [vertex[at], code[at], np.full(len(at), below), code[at] & np.int64(below)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["vertex", "code", "mask", "pattern"])

    return nodes.select("vertex", "code", "mask").mapInArrow(run, "vertex long, code long, mask long, pattern long")


def near_links(codes: DataFrame, n: int, radius: int = RADIUS, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links (a, b) that connect exactly the vertices connected by near codes.

    ``codes`` has ``n`` distinct ``code`` values with a ``vertex`` each.
    """
    width = _top_width(n, radius)
    nodes = codes.select("vertex", "code", F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("pattern"))
    found = None
    for depth in range(64):
        nodes = _split(nodes, radius, depth, width)
        # once few bits are open a node can't have many members
        last = 64 - _fixed_bits(depth + 1, radius, width) <= (node_limit - 1).bit_length() - 1
        large = None if last else checkpointed(nodes.groupBy("mask", "pattern").count().filter(F.col("count") > node_limit))
        done = last or large.isEmpty()
        links = _links_in(nodes if done else nodes.join(large, ["mask", "pattern"], "left_anti"), radius)
        found = links if found is None else found.unionByName(links)
        if done:
            return found
        nodes = checkpointed(nodes.join(large, ["mask", "pattern"], "left_semi"))
    return found


def _fixed_bits(depth: int, radius: int, width: int) -> int:
    fixed = width if depth == 1 else 0
    for _ in range(depth - 1):
        fixed += (64 - fixed) // (radius + 1)
    return fixed


def _links_in(nodes: DataFrame, radius: int) -> DataFrame:
    """Links of all nodes; a task reads its nodes one after another and holds few at a time."""

    def run(batches):
        held: list[pa.RecordBatch] = []

        def links(rows: pa.Table, whole: bool):
            """The links of all nodes but, unless ``whole``, the last; and the rows of that one."""
            mask, pattern, vertex, code = (rows.column(c).to_numpy() for c in ("mask", "pattern", "vertex", "code"))
            new = np.concatenate([[True], (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])])
            group = np.cumsum(new)
            end = len(group) if whole else int(np.flatnonzero(new)[-1])
            a, b = node_links(group[:end], vertex[:end], code[:end].view(np.uint64), radius) if end else (np.zeros(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"]), rows.slice(end)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= 100_000:
                out, rest = links(pa.Table.from_batches(held).combine_chunks(), False)
                held = rest.to_batches()
                yield out
        if held:
            yield links(pa.Table.from_batches(held).combine_chunks(), True)[0]

    return (
        nodes.select("mask", "pattern", "vertex", "code")
        .repartition("mask", "pattern")
        .sortWithinPartitions("mask", "pattern")
        .mapInArrow(run, "a long, b long")
    )


# -- components


def _star_round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; edges run from the larger to the smaller vertex."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    large = both.join(lowest, F.col("a") == F.col("u")).filter("b > u").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    smallest = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    joined = large.join(smallest, F.col("a") == F.col("u"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(smallest.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """vertex and component (its smallest vertex) for every vertex that has a link."""
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = checkpointed(edges)
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
        before = state
        edges = checkpointed(_star_round(edges))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, node_limit: int = NODE_LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    component_id is the smallest doc_id that links reach. Texts without a word have
    fingerprint zero, which links like any other; repeated rows stay repeated; a null
    doc_id links as well, and a component of nothing else has a null id; an empty
    table gives an empty table. Other columns are left out.
    """
    prints = checkpointed(fingerprints(docs, shingle))
    # one vertex for all copies of a fingerprint
    codes = checkpointed(prints.groupBy(F.col("fingerprint").alias("code")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows")))
    n, rows = codes.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    roots = checkpointed(components(near_links(codes.select("code", F.col("code").alias("vertex")), n, radius, node_limit)))
    rooted = codes.join(roots, codes["code"] == roots["vertex"], "left").withColumn("component", F.coalesce("component", "code"))
    # a component is named by its smallest document
    named = rooted.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n_codes"))
    linked = named.filter("n_codes > 1")
    labels = checkpointed(
        rooted.join(linked.select("component", "component_id"), "component", "left").select(
            "code", "rows", F.when(F.col("component_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
        )
    )
    out = joined_by_key(prints, "fingerprint", labels, "code", "rows", rows)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The documents that are the smallest of their component, with all their columns.

    Of repeated rows with the same doc_id all stay, as do rows without a doc_id.
    """
    groups = near_duplicates(docs, radius, shingle)
    drop = checkpointed(groups.filter("doc_id <> component_id").select("doc_id").distinct())
    if drop.count() <= BROADCAST_IDS:  # then the texts need not move
        drop = F.broadcast(drop)
    return docs.join(drop, "doc_id", "left_anti").select(*docs.columns)


def keep_first(docs: DataFrame, roots: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest doc_id.

    ``roots`` has the component of texts, each named by its ``text_digest`` as ``vertex``; a
    text that it lacks is a component of its own. A row without a doc_id stays only
    where its component has no other, and of repeated rows one stays.
    """
    keys = [free_name(docs, k) for k in ("_none", "_id", "_text")]
    doc_id = F.col("doc_id").cast("long")
    keyed = docs.select("*", doc_id.isNull().alias(keys[0]), F.coalesce(doc_id, F.lit(0)).alias(keys[1]), text_digest(text_or_empty("text")).alias(keys[2]))
    rows = checkpointed(keyed.groupBy(*keys).agg(F.count("*").alias("n")).select(*[F.col(k).alias(c) for k, c in zip(keys, ("none", "id", "vertex"))], "n"))
    named = rows.join(roots, "vertex", "left").withColumn("component", F.coalesce("component", "vertex"))
    first = checkpointed(named.groupBy("component").agg(F.min(F.struct("none", "id", "vertex")).alias("first")).select("first.*"))
    same = ["none", "id", "vertex"]
    drop = rows.join(first, same, "left_anti").select(*same, F.lit(False).alias("repeated"))
    again = rows.filter("n > 1").join(first, same, "left_semi").select(*same, F.lit(True).alias("repeated"))
    drop = checkpointed(drop.unionByName(again).select(*[F.col(c).alias(k) for k, c in zip(keys, same)], "repeated"))
    n, repeated = drop.agg(F.count("*"), F.count_if("repeated")).first()
    small = F.broadcast if n <= BROADCAST_IDS else lambda x: x  # then the texts need not move
    kept = keyed.join(small(drop.select(*keys)), keys, "left_anti")
    if repeated:
        kept = kept.unionByName(keyed.join(small(drop.filter("repeated").select(*keys)), keys, "left_semi").dropDuplicates(keys))
    return kept.select(*docs.columns)
