"""Change-stream ledgers as streaming state: replay, restarts, late parents, merges, regressions."""

import pickle
import random
import time

import pytest
from pyspark.sql import Row

from millrace.streaming import lineage

SCHEMA = lineage.EVENT + ", n int, body struct<a:string,b:array<int>>"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event(kind, token, at=None, parents=None, n=None, keys=(None, None), target=(None, None), stream="s"):
    body = ("x", [n, n]) if n is not None else None
    return (stream, kind, token, parents, at, *keys, *target, n, body)


def run(spark, folder, slots=3, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    out = lineage.gated(stream, slots, **options).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        if not options.get("recover"):
            out.trigger(availableNow=True).start().awaitTermination(60)
            return
        query = out.trigger(processingTime="1 second").start()
        until = time.time() + 40
        while time.time() < until and query.isActive and {"RESUME", "RESTART"} - ({r["kind"] for r in spark.read.parquet(f"{folder}/out").collect()} if query.lastProgress else set()):
            time.sleep(1)
        query.stop()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def batch(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def seen(spark, folder):
    found = spark.read.parquet(f"{folder}/out").collect()
    data = sorted((r["n"], r["late"]) for r in found if r["kind"] == "RECORD")
    return data, sorted((r["kind"], r["token"] or "", r["watermark_ms"]) for r in found if r["kind"] != "RECORD")


def test_records_wait_for_the_frontier_over_restarts(spark, tmp_path):
    """Each batch is a query of its own that goes on from the checkpoint."""
    folder = str(tmp_path)
    batch(spark, folder, [event("CREATED", "a", 100), event("CREATED", "b", 100, []), event("RECORD", "a", 100, n=1), event("RECORD", "b", 150, n=2), event("RECORD", "b", None, n=9)])
    run(spark, folder)
    assert seen(spark, folder) == ([], [("FRONTIER", "", 99), ("SCHEDULED", "a", 100), ("SCHEDULED", "b", 100)])
    batch(spark, folder, [event("PROGRESS", "a", 200), event("RECORD", "a", 120, n=3)])
    run(spark, folder)
    assert seen(spark, folder)[0] == []  # b has not moved
    batch(spark, folder, [event("PROGRESS", "b", 151), event("PROGRESS", "b", 140)])
    run(spark, folder)
    assert seen(spark, folder)[0] == [(1, False), (2, False), (3, False)]
    batch(spark, folder, [event("RECORD", "a", 149, n=4), event("FINISHED", "a"), event("FINISHED", "b")])
    run(spark, folder)
    data, news = seen(spark, folder)
    assert data == [(1, False), (2, False), (3, False), (4, True), (9, False)] and news[0] == ("DONE", "", 150)
    kept = spark.read.parquet(f"{folder}/out").filter("n = 9").first()
    assert kept["body"] == Row(a="x", b=[9, 9]) and kept["token"] == "b"
    run(spark, folder)  # nothing new: nothing comes twice
    assert seen(spark, folder)[0] == data


def test_children_wait_for_all_parents_also_late_ones(spark, tmp_path):
    folder = str(tmp_path)
    batch(spark, folder, [event("CREATED", "a", 10), event("CREATED", "c", 30, ["a", "b"]), event("CREATED", "d", 30, ["a"])])
    run(spark, folder)
    assert ("SCHEDULED", "c", 30) not in seen(spark, folder)[1]
    batch(spark, folder, [event("FINISHED", "a"), event("CREATED", "c", 30, ["b", "a"]), event("FINISHED", "b")])  # b has ended before it is known
    run(spark, folder)
    news = seen(spark, folder)[1]
    assert ("SCHEDULED", "d", 30) in news and ("SCHEDULED", "c", 30) not in news
    batch(spark, folder, [event("CREATED", "b", 30)])
    run(spark, folder)
    assert ("SCHEDULED", "c", 30) in seen(spark, folder)[1]


def test_merges_begin_when_their_parents_tile_them(spark, tmp_path):
    folder = str(tmp_path)
    batch(spark, folder, [event("CREATED", "a", 10), event("CREATED", "b", 10), event("PROGRESS", "a", 70), event("PROGRESS", "b", 50), event("RECORD", "b", 45, n=1), event("RECORD", "b", 60, n=2)])
    merge = lambda token, *keys: event("MERGED", token, keys=keys, target=("", None))
    batch(spark, folder, [merge("a", "", "m"), merge("a", "", "m")])
    run(spark, folder)
    data, news = seen(spark, folder)
    assert data == [(1, False)] and news[-2:] == [("SCHEDULED", "a", 70), ("SCHEDULED", "b", 50)] and ("FRONTIER", "", 49) in news
    batch(spark, folder, [merge("b", "m", None)])
    run(spark, folder)
    data, news = seen(spark, folder)
    assert ("SCHEDULED", "[,)@a+b", 50) in news and ("FRONTIER", "", 59) not in news and data == [(1, False)]
    batch(spark, folder, [event("PROGRESS", "[,)@a+b", 61)])
    run(spark, folder)
    assert seen(spark, folder)[0] == [(1, False), (2, False)]


@pytest.mark.parametrize(
    "rows, error",
    [
        ([event("CREATED", "x", 40)], "behind the frontier"),
        ([event("CREATED", "a", 50, ["z"])], "other parents"),
        ([event("SPLIT", "a", 50)], "no event"),
        ([event(None, "a", 50)], "no event"),
    ],
)
def test_broken_protocols_fail(spark, tmp_path, rows, error):
    folder = str(tmp_path)
    batch(spark, folder, [event("CREATED", "a", 50)])
    run(spark, folder)
    batch(spark, folder, rows)
    with pytest.raises(Exception, match=error):
        run(spark, folder)


def test_streams_and_orders_are_independent(spark, tmp_path):
    """Whatever the order of events and batches, a whole stream releases every record once, none before the frontier."""
    r = random.Random(5)
    rows = []
    for stream in ("s", "t"):
        for k in range(4):
            rows += [event("CREATED", f"p{k}", 100, stream=stream), event("PROGRESS", f"p{k}", 300 + k, stream=stream), event("FINISHED", f"p{k}", stream=stream)]
            rows += [event("RECORD", f"p{k}", r.randrange(100, 400), n=r.randrange(10**6), stream=stream) for _ in range(20)]
    r.shuffle(rows)
    rows.sort(key=lambda x: x[1] != "CREATED")  # nothing begins behind the frontier
    folder = str(tmp_path)
    for s in range(0, len(rows), 50):
        batch(spark, folder, rows[s : s + 50])
    run(spark, folder, bucket_ms=7)
    data, news = seen(spark, folder)
    assert [n for n, _ in data] == sorted(x[9] for x in rows if x[1] == "RECORD")
    assert [k for k, *_ in news].count("DONE") == 2 and [k for k, *_ in news].count("SCHEDULED") == 8


def test_incomplete_merges_are_recovered_by_timer(spark, tmp_path):
    folder = str(tmp_path)
    batch(spark, folder, [event("CREATED", "a", 10), event("MERGED", "a", keys=("", "m"), target=("", None))])
    run(spark, folder, slots=1, recover=True, resume_ms=1, restart_ms=2)
    news = [(kind, token) for kind, token, _ in seen(spark, folder)[1]]
    assert ("RESUME", "[,)") in news and ("RESTART", "[,)") in news


def test_tiles():
    whole = ("", None)
    assert lineage.tiles(whole, [("m", None), ("", "m")]) and lineage.tiles(whole, [("", None), ("", None)])
    assert not any(lineage.tiles(whole, x) for x in ([], [("", "m")], [("", "m"), ("n", None)], [("", "n"), ("m", None)], [("a", None)]))
    assert lineage.tiles(("b", "d"), [("b", "c"), ("c", "d")]) and not lineage.tiles(("b", "d"), [("b", "c"), ("c", "e")])


class Kept(dict):
    """A map state of one slot; it refuses chunks of more records than a task may hold."""

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        assert len(pickle.loads(value[0])) <= lineage.CHUNK
        self[key] = value

    def removeKey(self, key):
        del self[key]


class Held:
    value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_a_slot_holds_few_records_at_a_time(monkeypatch):
    """Large batches wait in chunks, in order of time, and go out chunk by chunk, each record once and none too early."""
    monkeypatch.setattr(lineage, "CHUNK", 16)
    r = random.Random(8)
    chunks, index = Kept(), Held()
    expected, released = {}, []
    for at in range(0, 1000, 50):
        new = [(r.choice([None, *range(at, 1200)]), f"{at}-{k}".encode()) for k in range(r.choice([1, 3, 100]))]
        waiting = lineage.Waiting(chunks, index, 7)
        waiting.add(new)
        expected |= {e: w for w, e in new}
        for part in waiting.release(at, False):
            assert 0 < len(part) <= 16 and all(expected[e] is not None and expected[e] <= at for e in part)
            released += part
        waiting.save()
        assert sorted(released) == sorted(e for e, w in expected.items() if w is not None and w <= at)
        sizes = [n for _, n in waiting.known.values()]
        assert sizes == [len(pickle.loads(chunks[(c,)][0])) for c in waiting.known] and sum(sizes) == len(expected) - len(released)
    waiting = lineage.Waiting(chunks, index, 7)
    for part in waiting.release(None, True):
        released += part
    assert sorted(released) == sorted(expected) and not chunks
