"""The partition ledger of a change stream as streaming state.

A change stream is read partition by partition: partitions split, merge and end, and a
child may be read once all its parents have finished. This module folds the records that
say so into the ledger, derives the stream's frontier (no record before it can still
come), and holds data records back until the frontier has passed them. All of it is
state of one stateful operator, so it is restored with the query's checkpoint.

Rows of the input are ``EVENT`` plus the columns of the data:

=========  =====================================================================
CREATED    ``token`` begins at ``watermark_ms``; ``parents`` are the partitions
           that have to finish first
PROGRESS   all records of ``token`` before ``watermark_ms`` have been read
FINISHED   ``token`` has been read to its end
MERGED     ``token`` has finished, and its keys [start, end) go on in a partition
           of the keys [target_start, target_end) (null: no end), which begins when
           the parents' keys tile it, at the lowest of their watermarks
RECORD     a change of ``token`` at ``watermark_ms``
=========  =====================================================================

The work is spread over slots. Control rows are few; every slot gets all of them and
folds the same ledger. Data rows go to the slot of their partition, and wait there in
chunks of some CHUNK records in order of time, so a batch touches only the chunks that it
fills or releases. A task holds HELD records or one chunk at a time, whatever a batch
brings or releases: records travel through it as bytes, and go out chunk by chunk. Slot 0
reports what happened to the ledger.

Defined results: control rows may repeat and come in any order. What is said of a
partition before it is created is kept until then, a parent that is not known yet holds
its children back, and progress never goes back. A second creation with other parents, or a
partition that begins before the frontier that was given out, fails the query. A record
without time waits until the stream has ended. One that comes after the frontier has
passed it goes out at once, as ``late``. Null kinds and unknown ones fail the query.
"""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor

EVENT = "stream string, kind string, token string, parents array<string>, watermark_ms long, start string, end string, target_start string, target_end string"

#: Slots of a stream, and the span of time over which a chunk that the frontier cuts is halved.
SLOTS, BUCKET_MS = 32, 60_000
#: Records of a full chunk, and new ones that a task holds before it writes chunks.
CHUNK, HELD = 2_000, 20_000
#: Waiting for a merge to be complete: after this with the tokens at hand, and without any.
RESUME_MS, RESTART_MS = 120_000, 1_200_000

CONTROL = ("CREATED", "PROGRESS", "FINISHED", "MERGED")
CREATED, SCHEDULED, FINISHED = "CREATED", "SCHEDULED", "FINISHED"

#: What comes out: RECORD with its data; SCHEDULED, FRONTIER and DONE of the ledger; RESUME and RESTART of merges that lack parents.
OUTPUT = "stream string, kind string, token string, watermark_ms long, late boolean"


class Ledger:
    """The partitions of a stream: token -> [state, watermark, parents], merges by target, and what came too early."""

    def __init__(self, partitions: dict, merges: dict, early: dict, frontier: int | None):
        self.partitions, self.merges, self.early, self.frontier = partitions, merges, early, frontier

    def apply(self, rows: Sequence[dict]) -> None:
        """Control rows in any order: creations first, ends last."""
        place = {"CREATED": 0, "PROGRESS": 1, "MERGED": 2, "FINISHED": 2}
        for row in sorted(rows, key=lambda r: place[r["kind"]]):
            if row["kind"] == "CREATED":
                self._create(row["token"], row["watermark_ms"], list(row["parents"] or []))
            elif row["kind"] == "MERGED":
                self._merge(row)
            else:
                self._move(row["token"], row["watermark_ms"], row["kind"] == "FINISHED")

    def _create(self, token: str, watermark: int, parents: list[str]) -> None:
        known = self.partitions.get(token)
        if known is not None:
            if sorted(known[2]) != sorted(parents):
                raise ValueError(f"partition {token} was created with other parents")
            return
        if watermark is None:
            raise ValueError(f"partition {token} begins at no time")
        if self.frontier is not None and watermark - 1 < self.frontier:
            raise ValueError(f"partition {token} begins at {watermark}, behind the frontier {self.frontier}")
        self.partitions[token] = [CREATED, watermark, parents]
        reached, ended = self.early.pop(token, (None, False))
        if reached is not None or ended:
            self._move(token, reached, ended)

    def _move(self, token: str, watermark: int | None, ended: bool) -> None:
        known = self.partitions.get(token)
        if known is None:
            before, had_ended = self.early.get(token, (None, False))
            reached = [w for w in (before, watermark) if w is not None]
            self.early[token] = (max(reached) if reached else None, had_ended or ended)
            return
        if watermark is not None and known[0] != FINISHED:
            known[1] = max(known[1], watermark)
        if ended:
            known[0] = FINISHED

    def _merge(self, row: dict) -> None:
        target = (row["target_start"] or "", row["target_end"])
        self.merges.setdefault(target, {})
        if row["token"] in self.merges[target]:
            return
        known = self.partitions.get(row["token"])
        low = max([w for w in (row["watermark_ms"], known[1] if known else None) if w is not None], default=None)
        self.merges[target][row["token"]] = (row["start"] or "", row["end"], low)
        self._move(row["token"], None, True)

    def settle(self) -> list[tuple[str, str | None, int | None]]:
        """Creates what is merged completely, schedules what may be read and moves the frontier; says what is new."""
        out = []
        for parents in self.merges.values():  # parents that were not known yet
            for token, (start, end, low) in parents.items():
                if low is None and token in self.partitions:
                    parents[token] = (start, end, self.partitions[token][1])
        for target in sorted(self.merges, key=lambda t: (t[0], t[1] is not None, t[1] or "")):
            parents = self.merges[target]
            if all(w is not None for *_, w in parents.values()) and tiles(target, [(s, e) for s, e, _ in parents.values()]):
                token = f"[{target[0]},{'' if target[1] is None else target[1]})@{'+'.join(sorted(parents))}"
                low = min(w for *_, w in parents.values())
                del self.merges[target]
                if token not in self.partitions:
                    self.partitions[token] = [CREATED, low, sorted(parents)]
                    reached, ended = self.early.pop(token, (None, False))
                    if reached is not None or ended:
                        self._move(token, reached, ended)
        for token in sorted(self.partitions):
            known = self.partitions[token]
            if known[0] == CREATED and all(self.partitions.get(p, (None,))[0] == FINISHED for p in known[2]):
                known[0] = SCHEDULED
                out.append((SCHEDULED, token, known[1]))
        self._forget()
        open_at = [k[1] for k in self.partitions.values() if k[0] != FINISHED] + [w for m in self.merges.values() for *_, w in m.values() if w is not None]
        if open_at and (self.frontier is None or min(open_at) - 1 > self.frontier):
            self.frontier = min(open_at) - 1
            out.append(("FRONTIER", None, self.frontier))
        elif open_at and min(open_at) - 1 < self.frontier:
            raise ValueError(f"the frontier would go back from {self.frontier} to {min(open_at) - 1}")
        return out

    def _forget(self) -> None:
        """A finished partition is kept while a child may still ask for it."""
        asked = {p for k in self.partitions.values() if k[0] == CREATED for p in k[2]}
        for token, known in self.partitions.items():
            if known[0] == FINISHED and token not in asked:
                known[2] = []  # its own lineage is settled

    @property
    def is_done(self) -> bool:
        return bool(self.partitions) and not self.merges and all(k[0] == FINISHED for k in self.partitions.values())


def tiles(target: tuple[str, str | None], ranges: Sequence[tuple[str, str | None]]) -> bool:
    """Whether the ranges, each once, follow one another from the target's start to its end."""
    at: str | None = target[0]
    for start, end in sorted(set(ranges), key=lambda r: r[0].encode()):
        if at is None or start != at:
            return False
        at = end
    return bool(ranges) and at == target[1]


class Waiting:
    """The waiting records of a slot: (watermark, event) in chunks in order of time, and what the chunks hold.

    Records without a watermark have chunks of their own. A chunk is at least doubled
    when it is written again with new records, and at most halved when the frontier cuts it.
    """

    def __init__(self, chunks, index, span_ms: int):
        self.chunks, self.index, self.span_ms = chunks, index, span_ms
        held = index.get()
        #: chunk -> its lowest watermark, and how many records it has
        self.known: dict[int, tuple[int | None, int]] = pickle.loads(held[0]) if held else {}
        self.next = max(self.known, default=-1) + 1
        self.changed = False

    def add(self, rows: list[tuple[int | None, bytes]]) -> None:
        for timeless in (False, True):
            part = [r for r in rows if (r[0] is None) == timeless]
            if not part:
                continue
            for n, chunk in sorted((n, c) for c, (low, n) in self.known.items() if (low is None) == timeless and n < CHUNK):
                if n > len(part) or n + len(part) > CHUNK:
                    break
                part += self._take(chunk)
            if not timeless:
                part.sort(key=lambda r: r[0])
            for s in range(0, len(part), CHUNK):
                self._put(part[s : s + CHUNK])

    def release(self, frontier: int | None, done: bool) -> Iterator[list[bytes]]:
        """The events that the frontier has passed, or all of them."""
        for chunk, (low, _) in sorted(self.known.items(), key=lambda c: (c[1][0] is None, c[1][0] or 0)):
            if not done and (low is None or frontier is None or low > frontier):
                continue
            rows = self._take(chunk)
            n = len(rows) if done else bisect_right(rows, frontier, key=lambda r: r[0])
            yield [event for _, event in rows[:n]]
            rest = rows[n:]
            half = len(rest) // 2 if rest and rest[-1][0] - rest[0][0] > self.span_ms else 0
            for part in (rest[:half], rest[half:]):
                if part:
                    self._put(part)

    def save(self) -> None:
        if self.changed:
            self.index.update((pickle.dumps(self.known),))

    def _take(self, chunk: int) -> list[tuple[int | None, bytes]]:
        rows = pickle.loads(self.chunks.getValue((chunk,))[0])
        self.chunks.removeKey((chunk,))
        del self.known[chunk]
        self.changed = True
        return rows

    def _put(self, rows: list[tuple[int | None, bytes]]) -> None:
        self.chunks.updateValue((self.next,), (pickle.dumps(rows),))
        self.known[self.next] = (rows[0][0], len(rows))
        self.next += 1
        self.changed = True


#: What control rows say besides their kind, token and watermark.
_SAID = ("parents", "start", "end", "target_start", "target_end")


@F.arrow_udf(T.BinaryType())
def _packed(*columns: pa.Array) -> pa.Array:
    """Events as bytes: kind, token, watermark, what a control row says, or a record's data."""
    n = 3 + len(_SAID)
    rows = zip(*(c.to_pylist() for c in columns))
    return pa.array([pickle.dumps((*r[:3], r[3:n], None) if r[0] in CONTROL else (*r[:3], None, r[n:])) for r in rows], pa.binary())


def _unpacked(event: Column, fields: Sequence[T.StructField], types: Sequence[pa.DataType]) -> Column:
    """Kind, token, watermark and data of the events."""

    @F.arrow_udf(T.StructType(list(fields)))
    def run(events: pa.Array) -> pa.Array:
        rows = [(*e[:3], *(e[4] or (None,) * (len(types) - 3))) for e in map(pickle.loads, events.to_pylist())]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
        return pa.StructArray.from_arrays(columns, names=[f.name for f in fields])

    return run(event)


def _frame(stream: str, events: list[bytes], late: bool = False) -> pd.DataFrame:
    return pd.DataFrame({"stream": pd.Series([stream] * len(events), dtype=object), "late": pd.Series([late] * len(events), dtype=bool), "event": pd.Series(events, dtype=object)})


def _news(kind: str, token: str | None, watermark: int | None) -> bytes:
    return pickle.dumps((kind, token, watermark, None, None))


class Gate(StatefulProcessor):
    """One slot of a stream: the ledger, and the records that wait."""

    def __init__(self, recover: bool, resume_ms: int, restart_ms: int, bucket_ms: int):
        self.recover, self.resume_ms, self.restart_ms, self.bucket_ms = recover, resume_ms, restart_ms, bucket_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.partitions = handle.getMapState("partitions", "token string", "state string, watermark_ms long, parents array<string>")
        self.merges = handle.getMapState("merges", "target_start string, target_end string, token string", "start string, end string, watermark_ms long")
        self.early = handle.getMapState("early", "token string", "watermark_ms long, ended boolean")
        self.at = handle.getValueState("at", "frontier long, done boolean")
        # of other types than in checkpoints with buckets of rows, so that Spark refuses those
        self.waiting = handle.getMapState("waiting", "chunk long", "rows binary")
        self.buckets = handle.getValueState("buckets", "chunks binary")
        self.overdue = handle.getValueState("overdue", "targets array<struct<start:string,end:string>>")

    # -- state as plain values and back, only what has changed

    def _ledger(self) -> tuple[Ledger, dict, dict, dict]:
        partitions = {k[0]: [v[0], v[1], list(v[2])] for k, v in self.partitions.iterator()}
        merges: dict = {}
        for k, v in self.merges.iterator():
            merges.setdefault((k[0], k[1]), {})[k[2]] = tuple(v)
        early = {k[0]: (v[0], v[1]) for k, v in self.early.iterator()}
        frontier = self.at.get()
        flat = {(*t, k): v for t, m in merges.items() for k, v in m.items()}
        return Ledger({k: [*v[:2], list(v[2])] for k, v in partitions.items()}, merges, dict(early), frontier[0] if frontier else None), partitions, flat, early

    def _store(self, state, before: dict, now: dict) -> None:
        key = lambda k: k if isinstance(k, tuple) else (k,)
        for k in before.keys() - now.keys():
            state.removeKey(key(k))
        for k, v in now.items():
            if before.get(k) != v:
                state.updateValue(key(k), tuple(v))

    def handleInputRows(self, key, rows, timerValues):
        stream, slot = key
        at = self.at.get()
        before, done = (at[0], at[1]) if at else (None, False)
        frontier = before
        waiting = Waiting(self.waiting, self.buckets, self.bucket_ms)
        control, held, news = [], [], []
        for frame in rows:
            late = []
            for event in frame["event"]:
                kind, token, watermark, said, _ = pickle.loads(event)
                if kind in CONTROL:
                    control.append(dict(zip(_SAID, said), kind=kind, token=token, watermark_ms=watermark))
                elif watermark is not None and before is not None and watermark <= before:
                    late.append(event)
                else:
                    held.append((watermark, event))
            if late:
                yield _frame(stream, late, True)
            if len(held) >= HELD:
                waiting.add(held)
                held = []
        if control:
            ledger, partitions, merges, early = self._ledger()
            ledger.apply(control)
            news = ledger.settle()
            self._store(self.partitions, partitions, ledger.partitions)
            self._store(self.merges, merges, {(*t, k): v for t, m in ledger.merges.items() for k, v in m.items()})
            self._store(self.early, early, ledger.early)
            if ledger.is_done and not done:
                news.append(("DONE", None, ledger.frontier))
            frontier, done = ledger.frontier, ledger.is_done
            self.at.update((frontier, done))
            if self.recover and slot == 0 and ledger.merges and not list(self.handle.listTimers()):
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.resume_ms)
        if slot == 0 and news:
            yield _frame(stream, [_news(*n) for n in news])
        due = lambda w: done or (w is not None and frontier is not None and w <= frontier)
        yield _frame(stream, [event for w, event in held if due(w)])
        waiting.add([r for r in held if not due(r[0])])
        for events in waiting.release(frontier, done):
            yield _frame(stream, events)
        waiting.save()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """Merges that still lack parents are to be resumed with the tokens at hand; those that lack them at the second look, to be restarted."""
        now = timerValues.getCurrentProcessingTimeInMs()
        waiting = sorted({(k[0], k[1]) for k in self.merges.keys()}, key=lambda t: (t[0], t[1] or ""))
        seen = {tuple(t) for t in (self.overdue.get() or ([],))[0]}
        for target in waiting:
            yield _frame(key[0], [_news("RESTART" if target in seen else "RESUME", f"[{target[0]},{'' if target[1] is None else target[1]})", now)])
        self.overdue.update((waiting,))
        if waiting:
            self.handle.registerTimer(now + max(self.restart_ms - self.resume_ms, 1))

    def close(self) -> None:
        pass


def gated(events: DataFrame, slots: int = SLOTS, recover: bool = False, resume_ms: int = RESUME_MS, restart_ms: int = RESTART_MS, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """A stream of ``OUTPUT`` and the data's columns: records that the frontier has passed, and what happened to the ledger.

    The query needs the RocksDB state store. With a zero-delay watermark on what is
    released nothing is dropped that is not ``late``. ``recover`` sets timers for merges
    that stay incomplete; Spark then never ends a query by itself, so it takes a trigger
    by time.
    """
    own = T.StructType.fromDDL(EVENT)
    data = [f for f in events.schema.fields if f.name not in own.names]
    if clash := {f.name for f in data} & set(T.StructType.fromDDL(OUTPUT).names):
        raise ValueError(f"data can't have columns {sorted(clash)}")
    known = F.col("kind").isin("RECORD", *CONTROL)
    checked = events.withColumn("kind", F.when(known, F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("no event of a change stream is "), F.coalesce("kind", F.lit("null")))).cast("string")))
    every = F.sequence(F.lit(0), F.lit(slots - 1))
    slot = F.when(F.col("kind") == "RECORD", F.array(F.pmod(F.xxhash64("token"), F.lit(slots)).cast("int"))).otherwise(every)
    named = lambda f: F.col("`" + f.name.replace("`", "``") + "`")
    event = _packed("kind", "token", "watermark_ms", *_SAID, *map(named, data))
    fields = [T.StructField("kind", T.StringType()), own["token"], own["watermark_ms"], *data]
    types = to_arrow_schema(T.StructType(fields)).types
    gate = Gate(recover, resume_ms, restart_ms, bucket_ms)
    keyed = checked.withColumn("slot", F.explode(slot)).select("stream", "slot", event.alias("event")).groupBy("stream", "slot")
    out = keyed.transformWithStateInPandas(gate, "stream string, late boolean, event binary", "append", "processingTime" if recover else "none")
    out = out.select("stream", "late", _unpacked(F.col("event"), fields, types).alias("event")).select("stream", "late", "event.*")
    return out.select(*T.StructType.fromDDL(OUTPUT).names, *map(named, data))


@contextmanager
def state_store(spark: SparkSession):
    """A session that starts queries with the state store they need."""
    name, wanted = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name)
    spark.conf.set(name, wanted)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def records(gated_stream: DataFrame) -> DataFrame:
    """The released data alone."""
    return gated_stream.filter("kind = 'RECORD'").drop("kind")


def ledger_news(gated_stream: DataFrame) -> DataFrame:
    """What happened to the ledger: partitions to be read, the frontier, the end, merges to be recovered."""
    return gated_stream.filter("kind <> 'RECORD'").select("stream", "kind", "token", "watermark_ms")
