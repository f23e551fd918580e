"""Near-duplicate vectors by spherical-cap filters.

Vectors are compared within a label by their cosine. A filter direction stands for the
cap of the vectors around it. The directions are random product codes: a direction is
made of one of ``words`` code words in each of ``blocks`` blocks of a randomly turned
space, so that words^blocks directions need only blocks * words inner products. A vector
is list-decoded block by block: what a partial direction loses against the best one only
grows, and partial directions that have lost more than ``margin`` are given up. So each
vector meets exactly the directions whose inner product exceeds its own best one less
the margin. Vectors that share a filter are verified in double precision.

The margin is set before any data are read: the smallest at which all of CHECKED random
pairs at exactly the threshold share a filter. As the code is turned at random, the
chance of a pair depends on its angle alone, so about 1 pair in 1,000 at the threshold is
missed at most, and fewer of those above it (none of 4,000 at a cosine of 0.95). The number of directions follows the
number of vectors of the largest label, so that filters hold few vectors by chance.

Copies of a vector in a label are one class with a weight, so they are never paired.
Filters of one class are dropped; those of more than CELL classes are split into cells of
two parts each, which go to different tasks. A pair of classes is counted in the first
filter that both have, so that no pair is ever emitted: a task sends one row for each of
a cell's linked classes, with its links and a representative. A group of g different
vectors that are all linked takes g^2 / 2 products, spread over cells.

Defined results: vectors that are null, zero, or hold a null or non-finite component,
and those without a label, link with nothing; they are components of their own. Shorter
vectors are padded with zeros. A component is named by its smallest vec_id. A row without
an id links like others and is never ``kept``; a component of nothing else has a null id.
Repeated rows are vectors each for itself; an empty table gives an empty table. Other
columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, joined_by_key
from .simhash import _roots, components

THRESHOLD = 0.93
CODES = 3
#: Random pairs at the threshold that all have to share a filter.
CHECKED = 4_000
#: Directions of a code for each vector of the largest label, and code words of a block at most.
DIRECTIONS, WORDS = 32, 512
#: Classes of a part of a cell.
CELL = 2_048
#: Classes of a group that is compared with others in one step, and pairs of a step.
SMALL, STEP = 48, 1 << 15
SEED = 20_240_901
#: Cosines this near to the threshold are computed again with exact sums.
CLOSE = 1e-9


@dataclass(frozen=True)
class Code:
    """Random product codes over turned spaces, and the margin of their lists."""

    turns: np.ndarray  # code, component, turned component
    words: np.ndarray  # code, block, word, component of the block
    margin: float

    def filters(self, vectors: np.ndarray, margin: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter that a row of unit vectors has, by row."""
        margin = self.margin if margin is None else margin
        rows, ids = [], []
        codes, blocks, words, width = self.words.shape
        for c in range(codes):
            turned = vectors @ self.turns[c][: vectors.shape[1]]
            row, lost, found = np.arange(len(vectors)), np.zeros(len(vectors)), np.full(len(vectors), c, np.int64)
            for b in range(blocks):
                fits = turned[:, b * width : (b + 1) * width] @ self.words[c, b].T
                short = fits.max(axis=1, keepdims=True) - fits
                total = lost[:, None] + short[row]
                at, word = np.nonzero(total <= margin * math.sqrt(blocks))
                lost, found, row = total[at, word], found[at] * words + word, row[at]
            rows.append(row)
            ids.append(found)
        row, found = np.concatenate(rows), np.concatenate(ids)
        order = np.lexsort((found, row))
        return row[order], found[order]


def _pairs_at(cosine: float, dims: int, n: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    x, z = rng.standard_normal((2, n, max(dims, 2)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return x, cosine * x + math.sqrt(max(1 - cosine * cosine, 0)) * z


def _meet(code: Code, x: np.ndarray, y: np.ndarray, margin: float) -> int:
    """How many pairs of rows share a filter."""
    (r, f), (s, g) = code.filters(x, margin), code.filters(y, margin)
    most = int(max(f.max(), g.max())) + 1
    if most * len(x) < 1 << 62:
        return len(np.unique(np.intersect1d(r * most + f, s * most + g) // most))
    return len({a for a, _ in {*zip(r.tolist(), f.tolist())} & {*zip(s.tolist(), g.tolist())}})


@lru_cache(maxsize=8)
def make_code(dims: int, directions: int, threshold: float = THRESHOLD, codes: int = CODES, checked: int = CHECKED) -> Code:
    """Codes of about ``directions`` filters each, with the smallest margin that finds all checked pairs."""
    rng = np.random.default_rng(SEED)
    blocks = 2
    while WORDS**blocks < directions and blocks < 6:
        blocks += 1
    words = min(max(math.ceil(directions ** (1 / blocks)), 2), WORDS)
    width = -(-max(dims, 2) // blocks)
    turns = np.stack([np.linalg.qr(rng.standard_normal((blocks * width,) * 2))[0] for _ in range(codes)])
    chosen = rng.standard_normal((codes, blocks, words, width))
    chosen /= np.linalg.norm(chosen, axis=3, keepdims=True)
    code = Code(turns, chosen, 0.0)
    x, y = _pairs_at(threshold, dims, checked, rng)
    margins = [0.0025 * k for k in range(1, 400)]
    low, high = 0, 8
    while _meet(code, x, y, margins[high]) < checked and high < len(margins) - 1:
        low, high = high + 1, min(2 * high, len(margins) - 1)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if _meet(code, x, y, margins[middle]) == checked else (middle + 1, high)
    return Code(turns, chosen, margins[low])


# -- classes of equal vectors


def _scaled(vector: list | None) -> bytes | None:
    """The vector without zeros at its end, scaled by a power of two, as bytes; null if it can't link."""
    if vector is None:
        return None
    values = np.array(vector, np.float64)  # a null component is not a number
    most = np.abs(values).max(initial=0)
    if not np.isfinite(values).all() or most == 0:
        return None
    values = np.ldexp(values, -int(np.frexp(most)[1]))[: np.flatnonzero(values)[-1] + 1] + 0.0
    short = values.astype(np.float32)
    return b"f" + short.tobytes() if np.array_equal(short, values) else b"d" + values.tobytes()


def _vectors(packed: list[bytes]) -> np.ndarray:
    rows = [np.frombuffer(p, np.float32 if p[:1] == b"f" else np.float64, offset=1) for p in packed]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for at, r in zip(out, rows):
        at[: len(r)] = r
    return out


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _keyed(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, key (a digest of label and vector, null if it can't link) and the packed vector."""
    given = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")

    def run(batches):
        for batch in batches:
            labels = batch.column("label").to_pylist()
            packed = [None if label is None else _scaled(v) for label, v in zip(labels, batch.column("embedding").to_pylist())]
            keys = [None if p is None else hashlib.blake2b(repr(label).encode() + b"\0" + p, digest_size=16).digest() for label, p in zip(labels, packed)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], names=["vec_id", "label", "key", "vector"])

    return given.mapInArrow(run, given.select("vec_id", "label").schema.add("key", "binary").add("vector", "binary"))


# -- filters


def _filters(classes: DataFrame, code: Code) -> DataFrame:
    """label, id and ``filters`` of every class."""

    def run(batches):
        for whole in batches:
            for s in range(0, whole.num_rows, 1024):
                batch = whole.slice(s, 1024)
                row, found = code.filters(_units(_vectors(batch.column("vector").to_pylist())))
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(found))], names=["label", "id", "filters"])

    return classes.select("label", "id", "vector").mapInArrow(run, classes.select("label", "id").schema.add("filters", T.ArrayType(T.LongType())))


def _cells(hits: DataFrame) -> DataFrame:
    """label, filter, cell and id of the classes in filters of more than one; all pairs of a filter meet in a cell."""
    sizes = hits.groupBy("label", "filter").agg(F.count("*").alias("size")).filter("size > 1")
    parts = F.ceil(F.col("size") / F.lit(CELL)).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    placed = hits.join(sizes, ["label", "filter"]).withColumn("parts", parts).withColumn("part", own)
    cell = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least("part", k).alias("low"), F.greatest("part", k).alias("high")))
    return placed.select("label", "filter", "id", "part", F.explode(cell).alias("cell"))


def _exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    dot, aa, bb = math.fsum(a * b), math.fsum(a * a), math.fsum(b * b)
    return dot / (math.sqrt(aa) * math.sqrt(bb))


def _linked(cosines: np.ndarray, vectors: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    near = cosines >= threshold
    for at in np.flatnonzero(np.abs(cosines - threshold) < CLOSE).tolist():
        near[at] = _exact_cosine(vectors[i[at]], vectors[j[at]]) >= threshold
    return near


def _first_met(filters: np.ndarray, own: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether no filter before ``own`` is in the lists of both; lists are padded with -1 and -2 on either side."""
    out = np.empty(len(i), bool)
    step = max(STEP * 64 // max(filters.shape[1] ** 2, 1), 1)
    for s in range(0, len(i), step):
        a, b, f = filters[i[s : s + step]], filters[j[s : s + step]], own[s : s + step]
        common = (a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None] & (a < f[:, None])[:, :, None]
        out[s : s + step] = ~common.any(axis=(1, 2))
    return out


def _group_pairs(starts: np.ndarray, sizes: np.ndarray):
    """All pairs (i, j), i < j, of positions within the groups, in bounded steps of whole groups."""
    counts = sizes * (sizes - 1) // 2
    low = 0
    while low < len(sizes):
        high = low + max(int(np.searchsorted(np.cumsum(counts[low:]), STEP, "right")), 1)
        n = np.repeat(sizes[low:high], sizes[low:high])
        first = np.repeat(starts[low:high], sizes[low:high])
        place = np.arange(len(n)) - np.repeat(np.cumsum(sizes[low:high]) - sizes[low:high], sizes[low:high])
        later = n - place - 1
        i = np.repeat(first + place, later)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
        yield i, j
        low = high


def _verified(cells: DataFrame, threshold: float) -> DataFrame:
    """id, links and root: for each linked class of a cell its links first met there, and a class of its tree."""
    names = ["filter", "low", "high", "part", "id", "n", "vector", "filters"]

    def links(rows: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        ids, weight, filter_, part, low, high = (rows.column(c).to_numpy() for c in ("id", "n", "filter", "part", "low", "high"))
        vectors = _vectors(rows.column("vector").to_pylist())
        units = _units(vectors)
        lists = rows.column("filters").to_pylist()
        padded = np.full((len(lists), max(map(len, lists), default=0)), -1, np.int64)
        for at, own in zip(padded, lists):
            at[: len(own)] = own
        found = np.zeros(len(ids), np.int64)
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = np.diff(np.append(starts, len(group)))
        edges = []

        def count(i: np.ndarray, j: np.ndarray, near: np.ndarray) -> None:
            i, j = i[near], j[near]
            edges.append((i, j))
            fresh = _first_met(padded, filter_[i], i, j)
            np.add.at(found, i[fresh], weight[j[fresh]])
            np.add.at(found, j[fresh], weight[i[fresh]])

        small = sizes <= SMALL
        for i, j in _group_pairs(starts[small], sizes[small]):
            apart = (low[i] == high[i]) | (part[i] != part[j])  # other pairs meet in the cells of one part
            i, j = i[apart], j[apart]
            count(i, j, _linked(np.einsum("ij,ij->i", units[i], units[j]), vectors, i, j, threshold))
        for start, size in zip(starts[~small].tolist(), sizes[~small].tolist()):
            at = np.arange(start, start + size)
            two = low[start] != high[start]
            left = at[part[at] == low[start]] if two else at
            right = at[part[at] == high[start]] if two else at
            earlier = _earlier(lists, at, int(filter_[start]))
            for s in range(0, len(left), max(STEP // max(len(right), 1), 1)):
                own = left[s : s + max(STEP // max(len(right), 1), 1)]
                i, j = np.repeat(own, len(right)), np.tile(right, len(own))
                near = _linked((units[own] @ units[right].T).ravel(), vectors, i, j, threshold)
                if not two:
                    near &= i < j
                i, j = i[near], j[near]
                edges.append((i, j))
                fresh = (earlier[own - start] @ earlier[right - start].T == 0).ravel()[near]
                np.add.at(found, i[fresh], weight[j[fresh]])
                np.add.at(found, j[fresh], weight[i[fresh]])
        root = _roots(len(ids), edges)
        linked = np.flatnonzero((found > 0) | (root != np.arange(len(ids))))
        return pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(found[linked]), pa.array(ids[root[linked]])], names=["id", "links", "root"])

    def run(batches):
        held, last, number = [], None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "filter", "low", "high"))))
            group = np.empty(len(keys), np.int64)
            for k, key in enumerate(keys):
                number += key != last
                last = key
                group[k] = number
            held.append((batch.select(names), group))
            if sum(len(g) for _, g in held) >= 8_192:
                rows, group = pa.Table.from_batches([b for b, _ in held]), np.concatenate([g for _, g in held])
                whole = int(np.searchsorted(group, group[-1]))  # the last group may go on
                if whole:
                    yield links(rows.slice(0, whole).combine_chunks(), group[:whole])
                    held = [(b, group[whole + p : whole + p + b.num_rows]) for b, p in _placed(rows.slice(whole).to_batches())]
        if held:
            yield links(pa.Table.from_batches([b for b, _ in held]).combine_chunks(), np.concatenate([g for _, g in held]))

    placed = cells.select("label", "filter", F.col("cell.low").alias("low"), F.col("cell.high").alias("high"), "part", "id", "n", "vector", "filters")
    keys = ["label", "filter", "low", "high"]
    return placed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "id long, links long, root long")


def _placed(batches: list[pa.RecordBatch]):
    at = 0
    for b in batches:
        yield b, at
        at += b.num_rows


def _earlier(lists: list[list[int]], at: np.ndarray, own: int) -> np.ndarray:
    """By class of a group, which of the filters before ``own`` that several have it has."""
    before = [[f for f in lists[k] if f < own] for k in at.tolist()]
    flat = np.array([f for fs in before for f in fs], np.int64)
    row = np.repeat(np.arange(len(before)), [len(fs) for fs in before])
    known, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    several = times[column] > 1
    names, place = np.unique(column[several], return_inverse=True)
    out = np.zeros((len(before), max(len(names), 1)), np.float32)
    out[row[several], place] = 1
    return out


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, directions: int = DIRECTIONS) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id and kept (vec_id = component_id) of every vector."""
    keyed = _keyed(embeddings)
    grouped = keyed.filter(F.col("key").isNotNull()).groupBy("label", "key", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    classes = checkpointed(grouped.withColumn("id", F.monotonically_increasing_id()))
    dims = F.max(F.expr("(length(vector) - 1) div if(substring(vector, 1, 1) = X'66', 4, 8)"))  # the packed vector begins with its kind
    by_label = classes.groupBy("label").agg(F.count("*").alias("classes"), F.sum("n").alias("rows"), dims.alias("dims"))
    largest, rows, dims = by_label.agg(*[F.coalesce(x, F.lit(0)) for x in (F.max("classes"), F.sum("rows"), F.max("dims"))]).first()
    # powers of two, so that tables of about one size have one code
    code = make_code(max(int(dims), 1), 1 << math.ceil(math.log2(max(largest * directions, 64))), threshold)

    listed = checkpointed(_filters(classes, code))
    hits = listed.select("label", "id", F.explode("filters").alias("filter"))
    cells = _cells(hits)
    known = classes.select("id", "n", "vector").join(listed.select("id", "filters"), "id")
    found = checkpointed(_verified(cells.join(known, "id"), threshold))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = checkpointed(components(found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))))

    rooted = classes.select("id", "key", "first", "n").join(roots, F.col("id") == F.col("vertex"), "left").withColumn("component", F.coalesce("component", "id"))
    named = rooted.groupBy("component").agg(F.min("first").alias("component_id"))
    table = (
        rooted.join(named, "component")
        .join(links, "id", "left")
        .select(F.col("key").alias("_key"), F.col("n").alias("_n"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    )
    members = keyed.select("vec_id", "key")
    out = joined_by_key(members.filter(F.col("key").isNotNull()), "key", checkpointed(table), "_key", "_n", rows).select("vec_id", "n_links", "component_id")
    alone = members.filter(F.col("key").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return out.unionByName(alone).select("vec_id", "n_links", "component_id", kept)


def oracle() -> str:
    return """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(m.b, e.vec_id)) AS component_id, e.vec_id = least(e.vec_id, coalesce(m.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) m ON m.a = e.vec_id
"""
