"""Vector compression by product codes, whose entries are searched as in a VA-file.

Components are integers, floor(SCALE * x). Vectors are cut into PARTS equal parts; each
part is written as the number of its nearest codebook entry. The codebook of a position
begins with the parts of the ENTRIES vectors of smallest id and is moved ROUNDS times to
the floored means of the parts that it is nearest to.

The nearest entry is found by VA-file filtering: each coordinate of the entries is
quantised into at most 2^CELL_BITS cells of about as many entries each, of which the
smallest and largest value are kept. For a part, a table gives the least and the largest
squared distance from its coordinate to each cell; the sums over an entry's cells bound
its distance from below and above. Only entries whose lower bound does not exceed the
smallest upper bound can be nearest, and these alone are compared with integer distances.

Tasks keep the sums and counts of the entries and send them once, as digits of 40 bits,
so sums are exact at any size. The codebooks (PARTS * ENTRIES parts of one vector) are all that
the driver sees. Vectors are read again in each round and never move.

Defined results: vectors that are null, or hold a null or non-finite component (also
once scaled), are dropped. Shorter vectors are padded with zeros to the longest, and that
to a multiple of PARTS. Of rows that share an id the least vector gives an entry; a row
without an id is coded, but gives none. With fewer ids than ENTRIES there are fewer
entries, with none all codes are null. Repeated rows are coded and counted each for itself. An error
beyond the range of a long is given as that range's end. An empty table gives an empty
table. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT_KEYS, checkpointed
from .topk import _ragged, quantised

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
CELL_BITS = 3
#: Values of a matrix that are worked on at once.
VALUES = 1 << 18
#: Bits of a digit of a sum; a digit's own sum keeps to 64 bits in a task.
DIGIT = 40

_MOST = np.iinfo(np.int64).max


def _limit(width: int) -> int:
    """Below it in size, components of vectors of ``width`` have squared distances of at most 2^61."""
    return math.isqrt((1 << 61) // max(width, 1)) // 2


def _whole(values: np.ndarray) -> np.ndarray:
    """Whole doubles as int64 where their distances keep to 64 bits, else as Python integers."""
    if not values.size or np.abs(values).max() < _limit(values.shape[1]):
        return values.astype(np.int64)
    return np.frompyfunc(int, 1, 1)(values).astype(object)


def _same_kind(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (a, b) if a.dtype == b.dtype else (a.astype(object), b.astype(object))


class CellFile:
    """The entries of one codebook, approximated by cells."""

    def __init__(self, entries: np.ndarray, bits: int = CELL_BITS):
        n, width = entries.shape
        cells = min(1 << bits, n)
        self.entries = entries
        rank = np.argsort(np.argsort(entries, axis=0, kind="stable"), axis=0, kind="stable")
        self.cell = rank * cells // n  # of each entry and coordinate
        self.low = np.empty((width, cells), entries.dtype)
        self.high = np.empty((width, cells), entries.dtype)
        for j in range(width):
            for c in range(cells):
                inside = entries[self.cell[:, j] == c, j]
                self.low[j, c], self.high[j, c] = inside.min(), inside.max()
        #: Picks an entry's cells from a flattened table.
        self.picks = np.zeros((width * cells, n))
        self.picks[(np.arange(width) * cells + self.cell).ravel(), np.repeat(np.arange(n), width)] = 1

    def bounds(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the squared distance of each part to each entry."""
        x = parts[:, :, None]
        below, above = self.low - x, x - self.high
        least = np.maximum(np.maximum(below, above), 0) ** 2
        most = np.maximum(above + (self.high - self.low), below + (self.high - self.low)) ** 2
        n = len(parts)
        if parts.dtype == object:
            picks = self.picks.astype(np.int64).astype(object)
            return least.reshape(n, -1) @ picks, most.reshape(n, -1) @ picks
        # below 2^53 floating point is exact here
        table = np.concatenate([least, most]).reshape(2 * n, -1).astype(np.float64)
        sums = table @ self.picks if table.max(initial=0) * max(parts.shape[1], 1) < 2.0**53 else table.astype(np.int64) @ self.picks.astype(np.int64)
        return sums[:n], sums[n:]

    def nearest(self, parts: np.ndarray, compared: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part, ties to the smaller number, and its squared distance."""
        if not parts.shape[1]:
            return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        lower, upper = self.bounds(parts)
        row, entry = np.nonzero(lower <= upper.min(axis=1)[:, None])
        if compared is not None:
            compared.append(len(row))
        distance = ((parts[row] - self.entries[entry]) ** 2).sum(axis=1)
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        best = np.minimum.reduceat(distance, starts)
        # entries of a row ascend, so the first that is as near is the smallest
        at = np.flatnonzero(distance == best[row])
        _, first = np.unique(row[at], return_index=True)
        return entry[at[first]], best


def _matrices(batch: pa.RecordBatch, width: int):
    """Slices of the batch with their vectors padded to ``width``."""
    lengths, values = _ragged(batch.column("components"))
    ends = np.cumsum(lengths)
    step = max(VALUES // max(width, 1), 1)
    for s in range(0, batch.num_rows, step):
        own = lengths[s : s + step]
        out = np.zeros((len(own), width))
        out[np.arange(width) < own[:, None]] = values[ends[s] - lengths[s] : ends[s] - lengths[s] + own.sum()]
        yield batch.slice(s, step), _whole(out)


def assign(matrix: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the vectors by part, and their squared distances by part; ``books`` is by part, entry and component."""
    parts, entries, width = books.shape
    codes, errors = np.zeros((len(matrix), parts), np.int64), []
    for j in range(parts):
        own, book = _same_kind(matrix[:, j * width : (j + 1) * width], books[j])
        codes[:, j], found = CellFile(book).nearest(own)
        errors.append(found)
    return codes, np.array(errors, object if any(e.dtype == object for e in errors) else np.int64).T


def _sums(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """part, entry, place (of a component, -1 for the count), digit and value: the tasks' sums."""
    parts, entries, width = books.shape

    def run(batches):
        totals = np.zeros((parts, entries, width), object)
        counts = np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, matrix in _matrices(batch, parts * width):
                codes, _ = assign(matrix, books)
                for j in range(parts):
                    own, at = matrix[:, j * width : (j + 1) * width], codes[:, j]
                    order = np.argsort(at, kind="stable")
                    starts = np.flatnonzero(np.concatenate([[True], np.diff(at[order]) != 0])) if len(at) else order
                    if len(at) and width:
                        totals[j, at[order][starts]] += np.add.reduceat(own[order], starts, axis=0).astype(object)
                    counts[j] += np.bincount(at, minlength=entries)
        rows = [(*at, -1, 0, int(n)) for at, n in np.ndenumerate(counts) if n]
        for at, total in np.ndenumerate(totals):
            total, digit = int(total), 0
            while total:  # digits have the sign of the sum
                rest, sign = abs(total), 1 if total > 0 else -1
                rows.append((*at, digit, sign * (rest & ((1 << DIGIT) - 1))))
                total, digit = sign * (rest >> DIGIT), digit + 1
        columns = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "place", "digit", "value"])

    found = vectors.select("components").mapInArrow(run, "part long, entry long, place long, digit long, value long")
    return found.groupBy("part", "entry", "place", "digit").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))


def _first_vectors(vectors: DataFrame, entries: int) -> list[list[float]]:
    """The vectors of the smallest ids, one each."""
    with_id = vectors.filter(F.col("vec_id").isNotNull()).select("vec_id", "components")
    order = ["vec_id", "components"]
    rows = with_id.orderBy(*order).limit(entries).collect()
    if len({r["vec_id"] for r in rows}) < len(rows):  # repeated ids
        ids = [r["vec_id"] for r in with_id.select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
        rows = with_id.filter(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("components").alias("components")).orderBy("vec_id").collect()
    return [r["components"] for r in rows]


def _as_books(values: np.ndarray) -> np.ndarray:
    """int64 where distances to it keep to 64 bits."""
    small = not values.size or max(map(abs, values.ravel().tolist())) < _limit(values.shape[0] * values.shape[2])
    return values.astype(np.int64) if small else values


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks by part, entry and component; ``vectors`` has vec_id and whole ``components``."""
    longest = vectors.agg(F.max(F.size("components"))).first()[0] or 0
    width = -(-longest // parts)
    firsts = _first_vectors(vectors, entries)
    start = np.zeros((len(firsts), parts * width), object)
    for i, v in enumerate(firsts):
        start[i, : len(v)] = [int(x) for x in v]
    books = start.reshape(len(firsts), parts, width).transpose(1, 0, 2)
    for _ in range(rounds if len(firsts) else 0):
        totals, counts = np.zeros(books.shape, object), np.zeros(books.shape[:2], object)
        for r in _sums(vectors, _as_books(books)).collect():
            if r["place"] < 0:
                counts[r["part"], r["entry"]] += int(r["value"])
            else:
                totals[r["part"], r["entry"], r["place"]] += int(r["value"]) << (DIGIT * r["digit"])
        books = books.copy()
        used = counts > 0
        books[used] = totals[used] // counts[used][:, None]
    return _as_books(books)


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id and label with ``code``, two hex digits for each part, and ``error``, the sum of squared distances."""
    parts, entries, width = books.shape

    def run(batches):
        for batch in batches:
            for rows, matrix in _matrices(batch, parts * width):
                if entries:
                    codes, errors = assign(matrix, books)
                    texts = pa.array([c.tobytes().hex() for c in codes.astype(np.uint8)], pa.string())
                    sums = [min(int(e), _MOST) for e in errors.sum(axis=1)]
                else:
                    texts, sums = pa.nulls(rows.num_rows, pa.string()), pa.nulls(rows.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("label"), texts, pa.array(sums, pa.int64())], names=["vec_id", "label", "code", "error"])

    schema = vectors.select("vec_id", "label").schema.add("code", "string").add("error", "long")
    return vectors.select("vec_id", "label", "components").mapInArrow(run, schema)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """With the sum of the errors of equal labels, nulls together; labels of many rows are broadcast, so that these stay where they are."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST)).cast("long")
    by_label = checkpointed(coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"), F.count("*").alias("_rows")))
    n, rows = by_label.agg(F.count("*"), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    same = F.col("label").eqNullSafe(F.col("_label"))
    is_hot = F.lit(True) if n <= HOT_KEYS else F.col("_rows") > rows // HOT_KEYS
    hot = F.broadcast(by_label.filter(is_hot))
    found = coded.join(hot, same)
    if n > HOT_KEYS:
        others = coded.join(hot, same, "left_anti").join(by_label.filter(~is_hot), same)
        found = found.unionByName(others)
    return found


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector with finite components."""
    vectors = embeddings.select("vec_id", "label", quantised(F.col("embedding"), scale).alias("components")).filter(F.col("components").isNotNull())
    books = train(vectors, parts, entries, rounds)
    coded = checkpointed(encode(vectors, books))
    return _with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def oracle() -> str:
    """The same in SQL, one step for each round."""
    steps = [
        f"e AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"p AS (SELECT vec_id, label, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS q FROM e, range({PARTS}) r(part))",
        f"b0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, q AS b FROM p WHERE vec_id IN (SELECT vec_id FROM e ORDER BY vec_id LIMIT {ENTRIES}))",
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT vec_id, label, part, q, entry, d FROM (SELECT p.*, entry, list_sum(list_transform(list_zip(q, b), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d "
            f"FROM p JOIN b{r} USING (part)) QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)"
        )
        if r < ROUNDS:
            steps.append(
                f"m{r} AS (SELECT part, entry, list(floor_mean ORDER BY place) AS b FROM (SELECT part, entry, place, ((s - ((s % n) + n) % n) // n)::BIGINT AS floor_mean "
                f"FROM (SELECT part, entry, place, sum(x)::HUGEINT AS s, count(*) AS n FROM (SELECT part, entry, unnest(q) AS x, unnest(range(len(q))) AS place FROM a{r}) GROUP BY part, entry, place)) GROUP BY part, entry)"
            )
            steps.append(f"b{r + 1} AS MATERIALIZED (SELECT o.part, o.entry, coalesce(m.b, o.b) AS b FROM b{r} o LEFT JOIN m{r} m ON o.part = m.part AND o.entry = m.entry)")
    final = f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT sha256(string_agg(array_to_string(b, ','), ',' ORDER BY part, entry)) FROM b{ROUNDS}) AS codebooks_sha256
FROM (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id, label)"""
    return "WITH " + ",\n".join(steps) + final
