"""Keyed tables that follow a changelog and are merged on read.

A table is cut into ranges of its key's hash. Base files hold the rows of a range, delta
files the changes of one commit: for each of its keys the last one. A commit writes its
delta and nothing else, so what it writes follows the batch and not the table. Reading
merges the deltas into the ranges that have any; the others are read as they are.
``compact`` rewrites the ranges whose deltas have grown, splits those that have become
large, and drops tombstones past a horizon.

A file ``log/<n>`` makes commit n visible: it names every range with its base file and
the last delta that is merged into it, and all deltas that some range still needs. It is
written whole and never replaced, so of two writers of one number the later goes on from
what the earlier has committed; what a broken attempt has left is never named.

Each key keeps the order of its last change and deleted keys stay as tombstones, so a
change that comes late never wins, whether right before, during or after a compaction. Of
equal orders the later commit wins. Once tombstones before a horizon are gone, changes
before it can't be judged any more and are refused, or ignored if the writer says so.

Rows that were there before the first change (``adopt``) are older than any change; all of
them stay until a change of their key. Null keys are keys like others.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changelog import DELETED, ORDER, ROW_KIND, _place, stored, upsert_kinds, visible
from .files import numbers, read_text, remove, write_new

#: Rows that a range should have, and the share of pending changes from which it is rewritten.
RANGE_ROWS, PENDING_SHARE = 2_000_000, 0.25
#: Ranges whose names are sent to every task; more are joined by a shuffle.
BROADCAST_RANGES = 1_000_000
ATTEMPTS = 20

_HASH, _RANGE, _COMMIT = "_hash", "_range", "_commit"


@dataclass(frozen=True)
class Range:
    """The keys whose hash begins with the ``depth`` bits of ``prefix``."""

    depth: int
    prefix: int
    path: str | None = None
    rows: int = 0
    #: Rows of deltas that are not merged yet, and the last commit that is.
    pending: int = 0
    applied: int = -1

    @property
    def name(self) -> str:
        return f"{self.depth}-{self.prefix}"


@dataclass(frozen=True)
class State:
    """What one commit makes visible."""

    number: int
    key: list[str]
    schema: T.StructType
    ranges: list[Range]
    #: (commit, path) of the deltas that a range still needs.
    deltas: list[tuple[int, str]]
    batch: int | None = None
    horizon: object = None

    def to_json(self) -> str:
        ranges = [[r.depth, r.prefix, r.path, r.rows, r.pending, r.applied] for r in self.ranges]
        return json.dumps({"key": self.key, "schema": self.schema.jsonValue(), "ranges": ranges, "deltas": self.deltas, "batch": self.batch, "horizon": self.horizon})


def _state(number: int, text: str) -> State:
    o = json.loads(text)
    return State(number, o["key"], T.StructType.fromJson(o["schema"]), [Range(*r) for r in o["ranges"]], [tuple(d) for d in o["deltas"]], o["batch"], o["horizon"])


def state(spark: SparkSession, folder: str) -> State | None:
    """The table's last commit; None where there is no table."""
    found = numbers(spark, f"{folder}/log")
    return _state(found[-1], read_text(spark, f"{folder}/log/{found[-1]}")) if found else None


def exists(spark: SparkSession, folder: str) -> bool:
    return bool(numbers(spark, f"{folder}/log"))


# -- ranges


def _nullable(schema: T.StructType) -> T.StructType:
    """The same columns, any of which may be null, at any depth."""
    text = schema.json()
    for kind in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{kind}":false', f'"{kind}":true')
    return T.StructType.fromJson(json.loads(text))


def _hashed(schema: T.StructType, *more: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_HASH, T.LongType()), *more])


def _hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*key)


def _name(depth: int) -> Column:
    prefix = F.shiftrightunsigned(_HASH, 64 - depth) if depth else F.lit(0).cast("long")
    return F.concat(F.lit(f"{depth}-"), prefix.cast("string"))


def _in_ranges(df: DataFrame, ranges: Sequence[Range]) -> DataFrame:
    """The rows that lie in one of the ranges, with its name; ranges never overlap."""
    depths = sorted({r.depth for r in ranges})
    if len(depths) == 1 and len(ranges) == 1 << depths[0]:
        return df.withColumn(_RANGE, _name(depths[0]))
    names = df.sparkSession.createDataFrame([(r.name,) for r in ranges], f"{_RANGE} string")
    small = F.broadcast(names) if len(ranges) <= BROADCAST_RANGES else names
    return df.withColumn(_RANGE, F.explode(F.array(*[_name(d) for d in depths]))).join(small, _RANGE, "left_semi")


def _pending(spark: SparkSession, now: State) -> dict[str, int]:
    """By range how many rows of deltas are not merged yet."""
    return {r[_RANGE]: r["n"] for r in _unmerged(spark, now, now.ranges).groupBy(_RANGE).agg(F.count("*").alias("n")).collect()} if now.deltas else {}


def _unmerged(spark: SparkSession, now: State, ranges: Sequence[Range]) -> DataFrame:
    """The rows of deltas that the ranges don't hold yet, with range and commit."""
    parts = [spark.read.schema(_hashed(now.schema)).parquet(path).withColumn(_COMMIT, F.lit(number)) for number, path in now.deltas]
    rows = _in_ranges(reduce(DataFrame.unionByName, parts), ranges)
    applied = {r.name: r.applied for r in ranges}
    if len(set(applied.values())) == 1:
        return rows.filter(F.col(_COMMIT) > next(iter(applied.values())))
    merged = spark.createDataFrame(list(applied.items()), f"{_RANGE} string, _applied int")
    small = F.broadcast(merged) if len(ranges) <= BROADCAST_RANGES else merged
    return rows.join(small, _RANGE).filter(F.col(_COMMIT) > F.col("_applied")).drop("_applied")


# -- writing


def _last_changes(changes: DataFrame, key: Sequence[str], order: Sequence[Column | str], schema: T.StructType) -> DataFrame:
    """The last change of each key in the stored layout; with map-side combine, so a hot key's changes meet in their own tasks first."""
    rest = [f for f in schema.fields if f.name not in {*key, ORDER, DELETED}]
    given = {c.lower() for c in changes.columns}
    values = [(F.col(f.name) if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in rest]
    at = _place(order).cast(schema[ORDER].dataType)
    row = F.struct(*values, (F.col(ROW_KIND) == "-D").alias(DELETED))
    last = upsert_kinds(changes).select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in key], at.alias(ORDER), row.alias("_row")).groupBy(*key).agg(F.max(ORDER).alias(ORDER), F.max_by("_row", ORDER).alias("_row"))
    return last.select(*[F.col(f.name) if f.name in {*key, ORDER} else F.col(f"_row.{f.name}").alias(f.name) for f in schema.fields])


def _commit(spark: SparkSession, folder: str, make) -> State:
    """Commits what ``make`` says of the last state; makes it anew where another writer was faster."""
    for _ in range(ATTEMPTS):
        now = state(spark, folder)
        new = make(now)
        if new is now or write_new(spark, f"{folder}/log/{new.number}", new.to_json()):
            return new
    raise RuntimeError(f"{folder} is written by too many")


def adopt(rows: DataFrame, folder: str, key: Sequence[str], order: Sequence[Column | str], changes: DataFrame) -> State:
    """A new table of rows that are older than any change; ``changes`` tells the type of their order."""
    spark = rows.sparkSession
    base = stored(rows, order, changes)

    def make(now: State | None) -> State:
        if now is not None:
            return now
        empty = State(0, list(key), _nullable(base.schema), [Range(0, 0)], [])
        return replace(empty, ranges=_written_base(spark, folder, base.withColumn(_HASH, _hash(key)), [(Range(0, 0, rows=base.count()))], -1, empty.schema, key))

    return _commit(spark, folder, make)


def append(changes: DataFrame, folder: str, key: Sequence[str], order: Sequence[Column | str], columns: Sequence[str] | None = None, batch: int | None = None, late: str = "fail") -> State:
    """Commits the changes of a changelog (with ``_row_kind``).

    ``batch`` is the number of a micro-batch: one that was committed is not committed
    again. ``columns`` are those of a new table, by default all. ``late`` says what
    happens to changes before the horizon: ``fail`` or ``ignore``.
    """
    if late not in ("fail", "ignore"):
        raise ValueError(f"no policy {late} for changes before the horizon")
    spark, folder = changes.sparkSession, folder.rstrip("/")
    now = state(spark, folder)
    if now is None:
        names = list(columns) if columns is not None else [c for c in changes.columns if c != ROW_KIND]
        now = adopt(changes.select(*names).limit(0), folder, key, order, changes)
    if now.key != list(key):
        raise ValueError(f"the table's key is {now.key}, not {list(key)}")
    if batch is not None and now.batch is not None and batch <= now.batch:
        return now
    last = _last_changes(changes, key, order, now.schema)
    if now.horizon is not None:
        before = F.coalesce(F.col(f"{ORDER}.o0") < _horizon(now), F.lit(True))
        refuse = F.raise_error(F.lit("a change before the table's horizon")).cast("boolean")
        last = last.filter(~before if late == "ignore" else F.when(~before, True).otherwise(refuse))
    path = f"{folder}/delta-{uuid.uuid4().hex}"
    # sorted by hash, so that a compaction reads little of what other ranges need
    last.withColumn(_HASH, _hash(key)).repartitionByRange(_HASH).sortWithinPartitions(_HASH).write.parquet(path)

    def make(now: State) -> State:
        if batch is not None and now.batch is not None and batch <= now.batch:
            return now
        new = replace(now, number=now.number + 1, deltas=[*now.deltas, (now.number + 1, path)], batch=now.batch if batch is None else batch)
        own = _pending(spark, replace(new, deltas=new.deltas[-1:]))
        return replace(new, ranges=[replace(r, pending=r.pending + own.get(r.name, 0)) for r in new.ranges])

    return _commit(spark, folder, make)


def _horizon(now: State) -> Column:
    return F.lit(now.horizon).cast(now.schema[ORDER].dataType["o0"].dataType)


# -- reading


def _resolved(spark: SparkSession, now: State, ranges: Sequence[Range]) -> DataFrame:
    """The stored rows of the ranges after their deltas; only touched keys and changes are shuffled."""
    paths = [r.path for r in ranges if r.path]
    base = spark.read.schema(_hashed(now.schema)).parquet(*paths) if paths else spark.createDataFrame([], _hashed(now.schema))
    if not now.deltas or not any(r.pending for r in ranges):
        return base
    key = now.key
    rest = [f.name for f in now.schema.fields if f.name not in {*key, ORDER}]
    at = lambda commit: F.struct(F.col(ORDER), commit.cast("int").alias("commit"))
    given = _unmerged(spark, now, ranges).select(*key, _HASH, at(F.col(_COMMIT)).alias("_at"), F.struct(*rest).alias("_row"))
    best = lambda df: df.groupBy(*key, _HASH).agg(F.max("_at").alias("_at"), F.max_by("_row", "_at").alias("_row"))
    last = best(given)
    same = reduce(lambda a, b: a & b, [base[k].eqNullSafe(last[k]) for k in key], base[_HASH] == last[_HASH])
    touched = base.join(last.select(*key, _HASH), same, "left_semi").select(*key, _HASH, at(F.lit(-1)).alias("_at"), F.struct(*rest).alias("_row"))
    decided = best(touched.unionByName(last))
    rows = decided.select(*[F.col(k) for k in key], *[F.col(f"_row.{c}").alias(c) for c in rest], F.col(f"_at.{ORDER}").alias(ORDER), _HASH)
    # of adopted rows that share a key the changes replace all, unless they lose
    kept = base.join(last.select(*key, _HASH), same, "left_anti").select(*rows.columns)
    return kept.unionByName(rows)


def read(spark: SparkSession, folder: str, with_order: bool = False) -> DataFrame:
    """The table after its last commit; ``with_order`` shows tombstones and orders as well."""
    folder = folder.rstrip("/")
    now = state(spark, folder)
    if now is None:
        raise FileNotFoundError(f"no table below {folder}")
    names = now.schema.names
    clean, dirty = [r for r in now.ranges if not r.pending], [r for r in now.ranges if r.pending]
    parts = [_resolved(spark, now, some).select(*names) for some in (clean, dirty) if some]
    table = reduce(DataFrame.unionByName, parts)
    return table if with_order else visible(table)


# -- compaction


def _children(r: Range, extra: int) -> list[Range]:
    return [Range(r.depth + extra, (r.prefix << extra) + i) for i in range(1 << extra)]


def _written_base(spark: SparkSession, folder: str, rows: DataFrame, ranges: Sequence[Range], applied: int, schema: T.StructType, key: Sequence[str], range_rows: int = RANGE_ROWS) -> list[Range]:
    """Writes the rows of ranges, cut so that none is much larger than ``range_rows``, and gives the new ranges."""
    cut = [c for r in ranges for c in _children(r, max(math.ceil(math.log2(max(r.rows + r.pending, 1) / range_rows)), 0))]
    path = f"{folder}/base-{uuid.uuid4().hex}"
    placed = _in_ranges(rows.select(*schema.names, _HASH), cut)
    placed.repartition(_RANGE).sortWithinPartitions(_RANGE, *key).write.partitionBy(_RANGE).parquet(path)
    # nothing is read but the folders' names and the footers
    counts = spark.read.schema(_hashed(schema, T.StructField(_RANGE, T.StringType()))).parquet(path).groupBy(_RANGE).agg(F.count("*").alias("n"))
    found = {r[_RANGE]: r["n"] for r in counts.collect()}
    return [replace(c, path=f"{path}/{_RANGE}={c.name}" if c.name in found else None, rows=found.get(c.name, 0), applied=applied) for c in cut]


def compact(spark: SparkSession, folder: str, pending_share: float = PENDING_SHARE, range_rows: int = RANGE_ROWS, horizon=None) -> State:
    """Merges the deltas into the ranges where they are more than ``pending_share`` of the rows.

    Commits that come meanwhile stay pending. ``horizon`` is a value of the first order
    column: tombstones of changes before it go, and from then on such changes are late.
    It never goes back.
    """
    folder = folder.rstrip("/")
    now = state(spark, folder)
    if now is None:
        raise FileNotFoundError(f"no table below {folder}")
    limit = horizon if now.horizon is None or (horizon is not None and horizon > now.horizon) else now.horizon
    # a horizon holds for the whole table, so then all ranges are rewritten
    chosen = [r for r in now.ranges if r.pending > pending_share * r.rows or (limit != now.horizon and (r.rows or r.pending))]
    if not chosen:
        return now
    rows = _resolved(spark, now, chosen)
    if limit is not None:
        rows = rows.filter(~(F.col(DELETED) & F.coalesce(F.col(f"{ORDER}.o0") < _horizon(replace(now, horizon=limit)), F.lit(False))))
    written = _written_base(spark, folder, rows, chosen, now.number, now.schema, now.key, range_rows)
    gone, idle = {r.name for r in chosen}, {r.name for r in now.ranges if not r.pending}

    def make(last: State) -> State:
        if any(r.name in gone and r.applied != applied[r.name] for r in last.ranges) or not gone <= {r.name for r in last.ranges}:
            raise RuntimeError("another compaction has rewritten the same ranges")
        if limit != now.horizon and last.number != now.number:
            raise RuntimeError("a horizon can't move while others write")
        # what has nothing pending is as good as merged
        ranges = [replace(r, applied=now.number) if r.name in idle else r for r in last.ranges if r.name not in gone] + written
        new = replace(last, number=last.number + 1, ranges=ranges, horizon=limit)
        least = min(r.applied for r in ranges)
        new = replace(new, deltas=[d for d in last.deltas if d[0] > least])
        pending = _pending(spark, new)
        return replace(new, ranges=[replace(r, pending=pending.get(r.name, 0)) for r in ranges])

    applied = {r.name: r.applied for r in chosen}
    return _commit(spark, folder, make)


def clean(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Deletes the data and the log of commits before the last ``keep``, and says what that was."""
    folder = folder.rstrip("/")
    found = numbers(spark, f"{folder}/log")
    states = {n: _state(n, read_text(spark, f"{folder}/log/{n}")) for n in found}
    used = lambda s: {d for _, d in s.deltas} | {r.path.rsplit("/", 1)[0] for r in s.ranges if r.path}
    held = set().union(*[used(states[n]) for n in found[-keep:]])
    old = sorted(set().union(*[used(states[n]) for n in found[:-keep]]) - held) + [f"{folder}/log/{n}" for n in found[:-keep]]
    for path in old:
        remove(spark, path)
    return old
