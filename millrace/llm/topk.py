"""Exact top-k inner products with block-at-a-time pruning.

Components are integers, floor(scale * x). Vectors are laid out in blocks: ranges of
the documents in the order of their length, a coarse sketch and their id, so that
similar vectors are neighbours. A block keeps a forward index (its ids and its matrix)
and, for each component, its largest and smallest value. For a query, each component's
weight times the better of the two is the most that this component can add in the
block; their sum bounds every score in it. A query visits its blocks in descending order
of this bound, scores them through their forward indexes, and stops where the bound
falls below its k-th score so far, which rises from visit to visit. What is left out
can't be among the k best, so the result is exact.

Neighbouring blocks form a shelf, which one task holds. A query first visits the shelf
where it lies itself, then the others in rounds: the shelf of highest bound, the next
two, the next four and so on, each round with the k-th score that the last one found.
Queries travel to shelves in bounded groups, each shelf goes to few tasks, and a task
sends at most k hits a query and shelf. Nothing is broadcast.

Arithmetic is exact for every finite vector: floating point only where products and
sums of that size are exact in it, 64-bit integers up to 2^62, and Python's integers
beyond.

Defined results: vectors that are null, or hold a null or non-finite component (also
once scaled), take no part, nor do rows without an id. Shorter vectors are padded with
zeros; an empty vector scores 0. Ties go to the smaller id; repeated rows are candidates
each for itself, and of rows that share a query's id the least vector is the query. A
query's own id is no candidate of it. A score beyond the range of a long is given as
that range's end; its rank is that of the true score. Fewer than k candidates give all
of them; an empty table gives an empty table. Other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

SCALE, K, QUERY_STEP = 64, 20, 20
#: Vectors of a block, queries of a group, and shelves whose bounds are compared at once.
BLOCK, GROUP, PART = 1024, 256, 1024
#: Values of a block's or group's matrix, and of all matrices of a shelf; one vector may have more.
BLOCK_VALUES, SHELF_VALUES = 1 << 20, 1 << 21
#: Queries that one task compares with a shelf.
TASK_QUERIES = 1 << 20

_MOST, _LEAST = np.iinfo(np.int64).max, np.iinfo(np.int64).min
#: Scores from here on are ends of the range: the true score is in ``wide``.
_TOP, _BOTTOM = _MOST, _LEAST + 1
#: Makes true scores of finite vectors positive, so that their digits sort like them.
_OFFSET = 1 << 2300

HITS = "query_id long, vec_id long, score long, wide string"


# -- arithmetic


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All integer inner products of the rows, as int64 where they fit, otherwise as Python integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    size_a, size_b = np.abs(a).max(axis=1).astype(float), np.abs(b).max(axis=1).astype(float)
    most = size_a.max() * size_b.max() * width
    for kind, exact in ((np.float32, 2.0**24), (np.float64, 2.0**53)):
        if most < exact:
            return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    if most < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    # few vectors are large: the products of the others keep to 64 bits
    large_a, large_b = size_a >= 2.0**20, size_b >= 2.0**20
    if width >= 1 << 22:
        large_a[:] = True
    out = np.empty((len(a), len(b)), object)
    out[np.ix_(~large_a, ~large_b)] = exact_products(a[~large_a], b[~large_b])
    out[large_a] = _python_ints(a[large_a]) @ _python_ints(b).T
    out[np.ix_(~large_a, large_b)] = _python_ints(a[~large_a]) @ _python_ints(b[large_b]).T
    return out


def _python_ints(values: np.ndarray) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(values).astype(object)


def clipped(products: np.ndarray) -> np.ndarray:
    """The products as int64, those beyond it as the ends of the range."""
    if products.dtype != object:
        return products
    return np.clip(products, _BOTTOM, _TOP).astype(np.int64)


def wide_key(score: int) -> str:
    """Digits that sort like the score."""
    return format(score + _OFFSET, "0577x")


# -- matrices as bytes


def _integers(rows: list[np.ndarray] | np.ndarray) -> np.ndarray:
    """Whole numbers given as doubles: int64 where they fit."""
    values = np.asarray(rows)
    return values.astype(np.int64) if not values.size or np.abs(values).max() < 2.0**62 else values


def _packed(values: np.ndarray) -> bytes:
    """A matrix with its width; its values in 16 bits where they fit, else in 64."""
    if values.dtype != np.float64:
        values = values.astype(np.int16 if not values.size or np.abs(values).max() < 1 << 15 else np.int64)
    return values.dtype.char.encode() + int(values.shape[1]).to_bytes(7, "little") + np.ascontiguousarray(values).tobytes()


def _matrix(raw: bytes) -> np.ndarray:
    width = int.from_bytes(raw[1:8], "little")
    values = np.frombuffer(raw, np.dtype(raw[:1].decode()), offset=8)
    return values.reshape(-1, width) if width else np.zeros((0, 0), np.int64)


def _longs(values) -> bytes:
    return np.ascontiguousarray(values, "<i8").tobytes()


def _from_longs(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i8")


def _padded(lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Rows of these lengths as one matrix, at least one column wide."""
    width = max(int(lengths.max(initial=0)), 1)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return _integers(out)


def _ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64), column.flatten().to_numpy(zero_copy_only=False)


def _cuts(lengths: np.ndarray, rows: int) -> list[tuple[int, int]]:
    """Runs of at most ``rows`` rows whose padded matrix has at most BLOCK_VALUES values, or of one row."""
    out, start = [], 0
    while start < len(lengths):
        widest = np.maximum.accumulate(np.maximum(lengths[start : start + rows], 1))
        fits = np.flatnonzero(widest * np.arange(1, len(widest) + 1) <= BLOCK_VALUES)
        stop = start + (int(fits[-1]) + 1 if len(fits) else 1)
        out.append((start, stop))
        start = stop
    return out


# -- the blocks


def quantised(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as a whole double; null where a component has none."""

    def scaled(x: Column) -> Column:
        return F.lit(float(scale)) * x.cast("double")

    # doubles from 2^53 on are whole
    whole = F.transform(embedding, lambda x: F.when(F.abs(scaled(x)) < 2.0**53, F.floor(scaled(x)).cast("double")).otherwise(scaled(x)))
    return F.when(F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(scaled(x)) < float("inf"))), whole)


def _sketched(usable: DataFrame) -> DataFrame:
    """With ``size`` and a sketch: vectors with the same two largest components lie together."""

    def run(batches):
        for batch in batches:
            lengths, values = _ragged(batch.column("components"))
            sketch = np.zeros(len(lengths), np.int64)
            ends = np.cumsum(lengths)
            for n in np.unique(lengths[lengths > 0]).tolist():
                at = np.flatnonzero(lengths == n)
                rows = values[(ends[at] - n)[:, None] + np.arange(n)]
                for _ in range(min(n, 2)):
                    top = np.abs(rows).argmax(axis=1)
                    each = np.arange(len(at))
                    sketch[at] = (sketch[at] << 31) + 2 * np.minimum(top, (1 << 29) - 1) + (rows[each, top] < 0)
                    rows[each, top] = 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths), pa.array(sketch)], names=["vec_id", "components", "size", "sketch"])

    return usable.mapInArrow(run, "vec_id long, components array<double>, size long, sketch long")


def build_blocks(vectors: DataFrame, block: int = BLOCK, shelf_values: int = SHELF_VALUES) -> DataFrame:
    """One row per block: shelf, place in it, upper, lower, ids and matrix (packed)."""
    names = ["shelf", "place", "upper", "lower", "ids", "matrix"]

    def run(batches):
        shelf, place, room = TaskContext.get().partitionId() << 32, 0, shelf_values
        ids, rows = np.zeros(0, np.int64), pa.array([], pa.list_(pa.float64()))

        def blocks(last: bool):
            nonlocal shelf, place, room, ids, rows
            lengths, values = _ragged(rows)
            starts = np.concatenate([[0], np.cumsum(lengths)])
            cuts = _cuts(lengths, block)
            for s, e in cuts if last else cuts[:-1]:
                matrix = _padded(lengths[s:e], values[starts[s] : starts[e]])
                if place and matrix.size > room:
                    shelf, place, room = shelf + 1, 0, shelf_values
                fields = [shelf, place, *(_packed(x) for x in (matrix.max(axis=0)[None], matrix.min(axis=0)[None])), _longs(ids[s:e]), _packed(matrix)]
                place, room = place + 1, room - matrix.size
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64() if isinstance(x, int) else pa.binary()) for x in fields], names=names)
            rest = len(ids) if last or not cuts else cuts[-1][0]
            ids, rows = ids[rest:], rows.slice(rest)

        for batch in batches:
            ids = np.concatenate([ids, batch.column("vec_id").to_numpy()])
            rows = pa.concat_arrays([rows, batch.column("components").cast(rows.type)])
            if len(ids) >= block:
                yield from blocks(False)
        yield from blocks(True)

    return vectors.mapInArrow(run, "shelf long, place long, upper binary, lower binary, ids binary, matrix binary")


# -- queries in groups


def _own_queries(blocks: DataFrame, query_step: int) -> DataFrame:
    """vec_id, shelf and components of each query; of rows that share an id the least is the query."""

    def run(batches):
        for whole in batches:
            for i in range(whole.num_rows):
                ids = _from_longs(whole.column("ids")[i].as_py())
                at = np.flatnonzero(ids % query_step == 0)
                rows = _matrix(whole.column("matrix")[i].as_py())[at].astype(float)
                ends = pa.array(np.arange(len(at) + 1, dtype=np.int32) * (rows.shape[1] if len(at) else 0))
                components = pa.ListArray.from_arrays(ends, pa.array(rows.reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(np.full(len(at), whole.column("shelf")[i].as_py())), components], names=["vec_id", "shelf", "components"])

    found = blocks.select("shelf", "ids", "matrix").mapInArrow(run, "vec_id long, shelf long, components array<double>")
    return found.groupBy("vec_id").agg(F.min(F.struct("components", "shelf")).alias("q")).select("vec_id", "q.shelf", "q.components")


def _groups(queries: DataFrame, salts: int, parts: int) -> DataFrame:
    """Bounded groups of queries of one shelf, with their k-th score and its id so far."""

    def run(batches):
        made = TaskContext.get().partitionId()
        for batch in batches:
            lengths, values = _ragged(batch.column("components"))
            starts = np.concatenate([[0], np.cumsum(lengths)])
            ids, shelves, kth, kth_ids = (batch.column(c).to_numpy() for c in ("vec_id", "shelf", "kth_score", "kth_id"))
            edges = np.flatnonzero(np.diff(shelves)) + 1
            rows = []
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(shelves)]):
                for s, e in _cuts(lengths[low:high], GROUP):
                    s, e = low + s, low + e
                    matrix = _padded(lengths[s:e], values[starts[s] : starts[e]])
                    rows.append((int(shelves[s]), made % salts, _longs(ids[s:e]), _packed(matrix), _longs(kth[s:e]), _longs(kth_ids[s:e])))
                    made += 1
            kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["shelf", "salt", "query_ids", "queries", "kth_scores", "kth_ids"])

    placed = queries.repartition(parts, "shelf").sortWithinPartitions("shelf", "vec_id")
    return placed.mapInArrow(run, "shelf long, salt long, query_ids binary, queries binary, kth_scores binary, kth_ids binary")


# -- which shelf a query visits


def bounds(queries: np.ndarray, uppers: np.ndarray, lowers: np.ndarray) -> np.ndarray:
    """The most that any vector of each block can score for each query.

    Both sides may be padded: a component that a vector lacks is zero in its block's matrix.
    """
    most = exact_products(np.maximum(queries, 0), uppers)
    least = exact_products(np.minimum(queries, 0), lowers)
    if most.dtype != object and least.dtype != object and most.size and max(int(np.abs(most).max()), int(np.abs(least).max())) >= 1 << 61:
        most = most.astype(object)
    return clipped(most + least)


def _stacked(rows: list[np.ndarray]) -> np.ndarray:
    width = max(r.shape[1] for r in rows)
    kind = np.float64 if any(r.dtype == np.float64 for r in rows) else np.int64
    return np.concatenate([np.pad(r.astype(kind), ((0, 0), (0, width - r.shape[1]))) for r in rows])


def _reach(bound: np.ndarray, kth: np.ndarray) -> np.ndarray:
    return bound >= kth[:, None]


def _summaries(blocks: DataFrame, parts: int) -> DataFrame:
    """The bounds of all blocks of a shelf as its own; up to PART shelves a row, each with its part's number."""

    def of_shelf(batches):
        for batch in batches:
            for shelf, upper, lower in zip(*(batch.column(c).to_pylist() for c in ("shelf", "upper", "lower"))):
                up, low = _stacked([_matrix(x) for x in upper]).max(axis=0), _stacked([_matrix(x) for x in lower]).min(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([shelf], pa.int64()), pa.array([_packed(up[None])], pa.binary()), pa.array([_packed(low[None])], pa.binary())], names=["shelf", "upper", "lower"])

    def rows(batches):
        for whole in batches:
            part = whole.column("part").to_numpy()
            for p in np.unique(part).tolist():
                mine = np.flatnonzero(part == p)
                for s in range(0, len(mine), PART):
                    b = whole.take(pa.array(mine[s : s + PART]))
                    packed = [_packed(_stacked([_matrix(x) for x in b.column(c).to_pylist()])) for c in ("upper", "lower")]
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([_longs(b.column("shelf").to_numpy())], pa.binary()), *(pa.array([x], pa.binary()) for x in packed)], names=["part", "shelves", "uppers", "lowers"])

    shelves = blocks.groupBy("shelf").agg(F.collect_list("upper").alias("upper"), F.collect_list("lower").alias("lower"))
    bounded = shelves.mapInArrow(of_shelf, "shelf long, upper binary, lower binary").withColumn("part", F.pmod(F.xxhash64("shelf"), F.lit(parts)))
    return bounded.repartition(parts, "part").sortWithinPartitions("part", "shelf").mapInArrow(rows, "part long, shelves binary, uppers binary, lowers binary")


def _visits(groups: DataFrame, summaries: DataFrame, parts: int, first: int, stop: int) -> DataFrame:
    """The queries of each group that go to a shelf, of those whose bound is of the ranks from ``first`` to ``stop``."""
    met = groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))).join(summaries, "part")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, kth, kth_ids, shelves = (_from_longs(row[c]) for c in ("query_ids", "kth_scores", "kth_ids", "shelves"))
                queries = _matrix(row["queries"])
                bound = bounds(queries, _matrix(row["uppers"]), _matrix(row["lowers"]))
                bound[:, shelves == row["shelf"]] = _LEAST  # it has been there
                order = np.argsort(~bound, axis=1, kind="stable")
                rank = np.empty(order.shape, np.int64)
                np.put_along_axis(rank, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), axis=1)
                go = _reach(bound, kth) & (rank >= first) & (rank < stop) & (shelves != row["shelf"])[None, :]
                out = [(int(shelves[s]), np.flatnonzero(go[:, s])) for s in np.flatnonzero(go.any(axis=0))]
                columns = [
                    pa.array([s for s, _ in out], pa.int64()),
                    pa.array([row["salt"]] * len(out), pa.int64()),
                    pa.array([_longs(ids[q]) for _, q in out], pa.binary()),
                    pa.array([_packed(queries[q]) for _, q in out], pa.binary()),
                    pa.array([_longs(kth[q]) for _, q in out], pa.binary()),
                    pa.array([_longs(kth_ids[q]) for _, q in out], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["shelf", "salt", "query_ids", "queries", "kth_scores", "kth_ids"])

    return met.mapInArrow(run, "shelf long, salt long, query_ids binary, queries binary, kth_scores binary, kth_ids binary")


# -- scoring


class Best:
    """The k best hits so far of each query of a group."""

    def __init__(self, kth: np.ndarray, kth_ids: np.ndarray, k: int):
        self.k, self.kth = k, kth.copy()
        # equal ends of the range say nothing about the true scores
        self.kth_ids = np.where((kth >= _TOP) | (kth <= _BOTTOM), _MOST, kth_ids)
        self.query = self.ids = self.scores = np.zeros(0, np.int64)
        self.true = np.zeros(0, object)

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray, true: np.ndarray) -> None:
        query, ids, scores, true = (np.concatenate(x) for x in ((self.query, query), (self.ids, ids), (self.scores, scores), (self.true, true)))
        beyond = np.flatnonzero((scores >= _TOP) | (scores <= _BOTTOM))
        finer = np.zeros(len(scores), np.int64)
        if len(beyond):
            finer[beyond] = np.unique(true[beyond], return_inverse=True)[1]
        order = np.lexsort((ids, -finer, ~scores, query))
        query, ids, scores, true = query[order], ids[order], scores[order], true[order]
        begins = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, np.int64)
        place = np.arange(len(query)) - np.repeat(begins, np.diff(np.append(begins, len(query))))
        self.query, self.ids, self.scores, self.true = (x[place < self.k] for x in (query, ids, scores, true))
        last = np.flatnonzero(place == self.k - 1)
        better = last[scores[last] >= self.kth[query[last]]]
        q = query[better]
        higher = scores[better] > self.kth[q]
        at_end = (scores[better] >= _TOP) | (scores[better] <= _BOTTOM)
        self.kth_ids[q] = np.where(at_end, _MOST, np.where(higher, ids[better], np.minimum(self.kth_ids[q], ids[better])))
        self.kth[q] = scores[better]


def visit(queries: np.ndarray, query_ids: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], uppers: np.ndarray, lowers: np.ndarray, best: Best) -> int:
    """Scores blocks for all queries of a group, and says how many (query, block) pairs it scored.

    Each query meets its blocks in descending order of bound: one, then two, then four and
    so on, and stops once the next bound is below its k-th score.
    """
    bound = bounds(queries, uppers, lowers)
    order = np.argsort(~bound, axis=1, kind="stable")
    sorted_bound = np.take_along_axis(bound, order, axis=1)
    scored, first = 0, 0
    while first < len(blocks):
        stop = min(2 * first + 1, len(blocks))
        go = _reach(sorted_bound[:, first:stop], best.kth)
        if not go.any():
            break
        asked, column = np.nonzero(go)
        where = order[asked, first + column]
        scored += len(asked)
        found = []
        for b in np.unique(where).tolist():
            q, (ids, matrix) = asked[where == b], blocks[b]
            products = exact_products(queries[q], matrix)
            scores = clipped(products)
            open_ = ids[None, :] != query_ids[q][:, None]
            kth = best.kth[q]
            if scores.shape[1] > 2 * best.k:  # only the k best of a block can count
                inner = np.where(open_, scores, _LEAST)
                kth = np.maximum(kth, np.partition(inner, -best.k, axis=1)[:, -best.k])
            tied = (scores == kth[:, None]) & ((kth > best.kth[q])[:, None] | (ids[None, :] < best.kth_ids[q][:, None]))
            i, j = np.nonzero(open_ & ((scores > kth[:, None]) | tied))
            true = products[i, j] if products.dtype == object else np.zeros(len(i), object)
            if products.dtype != object:  # may still lie at an end
                at_end = np.flatnonzero((scores[i, j] >= _TOP) | (scores[i, j] <= _BOTTOM))
                true[at_end] = [int(x) for x in products[i[at_end], j[at_end]]]
            found.append((q[i], ids[j], scores[i, j], true))
        if found:
            best.add(*(np.concatenate(x) for x in zip(*found)))
        first = stop
    return scored


def _scored(visits: DataFrame, blocks: DataFrame, salts: int, units: int, k: int) -> DataFrame:
    """The k best hits of each visited shelf for each query that visits it.

    Blocks and the groups that visit them meet by sorting: a task reads the blocks of a
    shelf first and holds them while its groups stream by.
    """
    nothing = [F.lit(None).cast("binary").alias(c) for c in ("query_ids", "queries", "kth_scores", "kth_ids")]
    no_block = [F.lit(None).cast("binary").alias(c) for c in ("upper", "lower", "ids", "matrix")]
    laid = blocks.select("shelf", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"), "place", "upper", "lower", "ids", "matrix", *nothing)
    asked = visits.select("shelf", "salt", F.lit(1 << 40).cast("long").alias("place"), *no_block, "query_ids", "queries", "kth_scores", "kth_ids")

    def run(batches):
        here, blocks_here, uppers, lowers, bound = None, [], [], [], None
        for whole in batches:
            for n in range(whole.num_rows):
                row = whole.slice(n, 1).to_pylist()[0]
                if (row["shelf"], row["salt"]) != here:
                    here, blocks_here, uppers, lowers, bound = (row["shelf"], row["salt"]), [], [], [], None
                if row["ids"] is not None:
                    blocks_here.append((_from_longs(row["ids"]), _matrix(row["matrix"])))
                    uppers.append(_matrix(row["upper"]))
                    lowers.append(_matrix(row["lower"]))
                    continue
                if bound is None:
                    bound = _stacked(uppers), _stacked(lowers)
                query_ids = _from_longs(row["query_ids"])
                best = Best(_from_longs(row["kth_scores"]), _from_longs(row["kth_ids"]), k)
                visit(_matrix(row["queries"]), query_ids, blocks_here, *bound, best)
                wide = [wide_key(int(t)) if s >= _TOP or s <= _BOTTOM else None for s, t in zip(best.scores.tolist(), best.true)]
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[best.query]), pa.array(best.ids), pa.array(best.scores), pa.array(wide, pa.string())], names=["query_id", "vec_id", "score", "wide"])

    together = laid.unionByName(asked).repartition(units, "shelf", "salt").sortWithinPartitions("shelf", "salt", "place")
    return together.mapInArrow(run, HITS)


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("wide"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, k: int = K, scale: int = SCALE, query_step: int = QUERY_STEP, block: int = BLOCK, shelf_values: int = SHELF_VALUES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all vectors for each id divisible by ``query_step``."""
    spark = vectors.sparkSession
    usable = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("components"))
        .filter("vec_id IS NOT NULL AND components IS NOT NULL")
    )
    n_values = usable.agg(F.sum(F.size("components").cast("long"))).first()[0] or 0
    laid_out = _sketched(usable).repartitionByRange("size", "sketch", "vec_id").sortWithinPartitions("size", "sketch", "vec_id")
    # a task lays out about one shelf, however many ranges there are
    blocks = checkpointed(build_blocks(laid_out.select("vec_id", "components").coalesce(n_values // shelf_values + 1), block, shelf_values))
    queries = checkpointed(_own_queries(blocks, query_step))
    n_shelves, n_queries = max(blocks.agg(F.count_distinct("shelf")).first()[0], 1), queries.count()
    salts = max(-(-n_queries // TASK_QUERIES), min(-(-2 * spark.sparkContext.defaultParallelism // n_shelves), -(-n_queries // GROUP)), 1)
    units, parts = min(n_shelves * salts, 10_000), -(-n_shelves // PART)
    none = queries.withColumns({"kth_score": F.lit(_LEAST).cast("long"), "kth_id": F.lit(_MOST).cast("long")})
    hits = checkpointed(_top(_scored(_groups(none, salts, min(n_shelves, 10_000)), blocks, salts, units, k), k))
    if n_shelves > 1:
        summaries = checkpointed(_summaries(blocks, parts))
        largest = summaries.agg(F.max(F.length("shelves"))).first()[0] // 8
        first = 0
        while first < largest:
            stop = 2 * first + 1
            kth = hits.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id"))
            known = queries.join(kth, "vec_id", "left").fillna({"kth_score": _LEAST, "kth_id": _MOST})
            visits = _visits(_groups(known, salts, min(n_shelves, 10_000)), summaries, parts, first, stop)
            more = _scored(visits, blocks, salts, units, k)
            hits = checkpointed(_top(hits.drop("rank").unionByName(more), k))
            first = stop
    return hits.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
