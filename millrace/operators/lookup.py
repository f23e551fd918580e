"""Lookup joins: probe rows against a keyed table.

Equality on the whole key of the looked-up side; a null key or a miss finds nothing, and
a left join keeps the probe row. The table is broadcast only when its measured size is
under a bound; otherwise both sides are joined by their keys, and the optimizer may
still broadcast by its own statistics.
"""

from __future__ import annotations

import time
from collections import OrderedDict
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.retry import with_retries
from ..plans.ranges import in_segments

#: Rows of a table that is small enough to be sent to every executor.
BROADCAST_ROWS = 100_000


def key_positions(wanted: Sequence[str], declared: Sequence[str]) -> list[int]:
    """Where each declared key column stands among the join's columns; partial keys are refused."""
    missing = [k for k in declared if k not in wanted]
    if missing or len(wanted) != len(declared):
        raise ValueError(f"a lookup needs exactly the key {list(declared)}, not {list(wanted)}")
    return [list(wanted).index(k) for k in declared]


def small(table: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most so many rows; reads no more than that."""
    return table.limit(rows + 1).count() <= rows


def lookup(probe: DataFrame, table: DataFrame, on: dict[str, str], key: Sequence[str], how: str = "left", table_filter: Column | None = None, cache: str = "none") -> DataFrame:
    """Joins by ``on``: probe column -> key column of the table.

    ``table_filter`` is applied to the table before the join. ``cache`` = "full" keeps
    the table in executor memory for repeated use and broadcasts it if small, which is
    counted now; ``ReloadingTable`` bounds how long it is kept.
    """
    if how not in ("left", "inner"):
        raise ValueError("lookups are left or inner joins")
    key_positions(list(on.values()), key)
    side = table.filter(table_filter) if table_filter is not None else table
    if cache == "full":
        side = side.cache()
        if small(side):
            side = F.broadcast(side)
    renamed = side.select([F.col(c).alias(f"_key_{c}") if c in key else F.col(c) for c in side.columns])
    condition = [F.col(p) == F.col(f"_key_{k}") for p, k in on.items()]
    return probe.join(renamed, condition, how).drop(*[f"_key_{k}" for k in key])


def lookup_as_of(probe: DataFrame, versions: DataFrame, on: dict[str, str], at: str, since: str, how: str = "left", deleted: Column | None = None) -> DataFrame:
    """Each probe row with the version of its key that held at its time, the last with ``since`` <= ``at``.

    ``on`` maps probe columns to the versions' keys; the other columns of the versions
    follow those of the probe. Versions and probes of a key stand together in the order of
    time, so a version is carried to the probes behind it. They lie in range partitions
    of key and time; a key over several hands the last version from part to part, of which
    there are fewer than keys and partitions. A version with ``deleted``, a null key or
    a null time finds nothing. Of versions of one time the one of the largest hash holds.
    """
    if how not in ("left", "inner"):
        raise ValueError("lookups are left or inner joins")
    values = [c for c in versions.columns if c not in on.values()]
    if clash := set(values) & set(probe.columns):
        raise ValueError(f"both sides have columns {sorted(clash)}")
    keys = [f"_k{i}" for i in range(len(on))]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on.values()], F.col(since).isNotNull())
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    left = versions.filter(known).select(*[F.col(k).alias(n) for k, n in zip(on.values(), keys)], F.col(since).alias("_t"), F.struct(F.struct(*values).alias("row"), gone.alias("gone")).alias("_v"))
    right = probe.select(*[F.col(k).alias(n) for k, n in zip(on, keys)], F.col(at).alias("_t"), F.struct(*[F.col(c) for c in probe.columns]).alias("_probe"))
    placed = in_segments(left.unionByName(right, allowMissingColumns=True), keys, "_t")
    place = F.struct("_t", F.xxhash64("_v"))
    segments = placed.groupBy("_g", "_p").agg(F.max_by(F.when(F.col("_v").isNotNull(), F.struct("_v")), F.when(F.col("_v").isNotNull(), place)).alias("_last"))
    earlier = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    carried = segments.select("_g", "_p", F.last("_last", ignorenulls=True).over(earlier)["_v"].alias("_before"))
    # versions of a time come before its probes
    until = Window.partitionBy("_g", "_p").orderBy("_t", F.col("_v").isNull(), F.xxhash64("_v")).rowsBetween(Window.unboundedPreceding, 0)
    held = placed.withColumn("_own", F.last("_v", ignorenulls=True).over(until)).filter(F.col("_probe").isNotNull()).join(carried, ["_g", "_p"])
    found = F.coalesce("_own", "_before")
    row = F.when(F.col("_t").isNotNull() & ~found["gone"], found["row"]).alias("_row")
    out = held.select("_probe", row)
    out = out.filter(F.col("_row").isNotNull()) if how == "inner" else out
    return out.select(*[F.col("_probe")[c].alias(c) for c in probe.columns], *[F.col("_row")[c].alias(c) for c in values])


class ReloadingTable:
    """A table kept in executor memory and loaded anew once it is older than ``ttl_seconds``.

    For lookups from ``foreachBatch``: ``current`` is asked in each micro-batch, and
    whatever it replaces is released. Without a ttl it never expires.
    """

    def __init__(self, load: Callable[[], DataFrame], ttl_seconds: float | None = None, clock: Callable[[], float] = time.monotonic):
        self._load, self._ttl, self._clock = load, ttl_seconds, clock
        self._table, self._loaded_at = None, 0.0

    def current(self) -> DataFrame:
        if self._table is None or (self._ttl is not None and self._clock() - self._loaded_at >= self._ttl):
            fresh = self._load().cache()
            self.release()
            self._table, self._loaded_at = fresh, self._clock()
        return self._table

    def release(self) -> None:
        if self._table is not None:
            self._table.unpersist()
            self._table = None


def remote_lookup(
    probe: DataFrame,
    columns: Sequence[str],
    fetch: Callable[[list[tuple]], list[tuple | None]],
    schema: T.StructType,
    batch: int = 256,
    cache_rows: int = 10_000,
    ttl_seconds: float | None = None,
    cache_misses: bool = True,
    concurrency: int = 8,
    attempts: int = 3,
    backoff: tuple[int, int] = (100, 5_000),
) -> DataFrame:
    """Looks keys up through a client call, a batch of distinct keys at a time.

    A task has up to ``concurrency`` calls under way; answers come in any order, rows
    keep theirs. A ``RetryableError`` of a class that lookups retry is tried up to
    ``attempts`` times, with a ``backoff`` from and to so many milliseconds; any other
    error fails the task, and with it all calls that have not begun.

    ``fetch`` maps keys, in Python's types, to rows (or None). Each task remembers the
    answers that it used last, up to ``cache_rows`` and no longer than ``ttl_seconds``;
    ``cache_misses`` says whether also that there is none. Keys holding a null are never
    asked for. Probe columns pass through untouched.
    """
    names = [f.name for f in schema.fields]
    kinds = [f.type for f in to_arrow_schema(schema)]

    def run(batches):
        with ThreadPoolExecutor(concurrency) as pool:
            try:
                yield from answered(batches, pool)
            finally:
                pool.shutdown(wait=False, cancel_futures=True)

    def answered(batches, pool):
        known: OrderedDict[tuple, tuple[float, tuple | None]] = OrderedDict()
        for rows in batches:
            keys = list(zip(*(rows.column(c).to_pylist() for c in columns)))
            now = time.monotonic()
            if ttl_seconds is not None:
                for k in [k for k in dict.fromkeys(keys) if k in known and now - known[k][0] >= ttl_seconds]:
                    del known[k]
            new = list(dict.fromkeys(k for k in keys if None not in k and k not in known))
            parts = [new[s : s + batch] for s in range(0, len(new), batch)]
            for part, answer in zip(parts, pool.map(lambda p: with_retries(lambda: fetch(p), attempts, *backoff), parts)):
                if len(answer) != len(part):
                    raise ValueError(f"{len(answer)} answers to {len(part)} keys")
                known.update((k, (now, row)) for k, row in zip(part, answer))
            for k in dict.fromkeys(keys):
                if k in known:
                    known.move_to_end(k)
            found = [known[k][1] if k in known else None for k in keys]
            values = [pa.array([r[i] if r is not None else None for r in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*rows.columns, *values], names=[*rows.schema.names, *names])
            if not cache_misses:
                for k in [k for k, (_, row) in known.items() if row is None]:
                    del known[k]
            while len(known) > cache_rows:
                known.popitem(last=False)

    return probe.mapInArrow(run, T.StructType(probe.schema.fields + schema.fields))
