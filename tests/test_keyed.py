"""Keyed tables that are merged on read: late changes around compactions, splits, horizons, writers at once."""

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace.plans import positions
from millrace.sources import catalog, files, keyed, relational
from millrace.streaming import sinks

SCHEMA = "_row_kind string, k int, v string, o int"


def changes(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def put(spark, folder, rows, **options):
    return keyed.append(changes(spark, rows), folder, ["k"], ["o"], **options)


def held(spark, folder):
    return sorted((r["k"] if r["k"] is not None else -1, r["v"]) for r in keyed.read(spark, folder).collect())


class Model:
    """The table row by row."""

    def __init__(self):
        self.rows = {}

    def put(self, rows):
        for kind, k, v, o in rows:
            if k not in self.rows or o >= self.rows[k][0]:
                self.rows[k] = (o, None if kind == "-D" else v, kind == "-D")

    def held(self):
        return sorted((k if k is not None else -1, v) for k, (_, v, gone) in self.rows.items() if not gone)


def test_random_changes_and_compactions(spark, tmp_path):
    r, folder, model = random.Random(3), str(tmp_path / "t"), Model()
    order = list(range(1000))
    r.shuffle(order)
    for step in range(6):
        rows = []
        for k in r.sample(range(40), 15):
            rows.append((r.choice(["+I", "+U", "-D"]), None if k == 7 else k, f"v{len(order)}", order.pop()))
        model.put(rows)
        put(spark, folder, rows)
        if step in (1, 4):
            keyed.compact(spark, folder, r.choice([0.0, 0.3]), range_rows=8)
        assert held(spark, folder) == model.held()
    now = keyed.state(spark, folder)
    assert len(now.ranges) >= 4 and len({x.depth for x in now.ranges}) >= 1
    assert keyed.compact(spark, folder, 0.0, range_rows=8).deltas == []
    assert held(spark, folder) == model.held()
    before = held(spark, folder)
    assert keyed.clean(spark, folder, keep=1) and held(spark, folder) == before
    assert len([x for x in os.listdir(folder) if x.startswith("delta-")]) == 0


def test_late_changes_before_during_and_after_a_compaction(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    put(spark, folder, [("+U", 1, "new", 9), ("-D", 2, None, 9), ("+I", 3, "c", 1)])
    put(spark, folder, [("+U", 1, "late", 3), ("+I", 2, "late", 4)])  # right before
    assert held(spark, folder) == [(1, "new"), (3, "c")]
    written = keyed._written_base

    def meanwhile(*args, **options):
        out = written(*args, **options)
        put(spark, folder, [("+U", 1, "later", 5), ("+U", 3, "d", 2), ("+I", 2, "late", 8)])  # after its data, before its commit
        return out

    monkeypatch.setattr(keyed, "_written_base", meanwhile)
    keyed.compact(spark, folder, 0.0)
    monkeypatch.setattr(keyed, "_written_base", written)
    assert held(spark, folder) == [(1, "new"), (3, "d")]
    assert len(keyed.state(spark, folder).deltas) == 1
    put(spark, folder, [("+U", 1, "late", 8), ("+I", 2, "late", 8)])  # right after
    assert held(spark, folder) == [(1, "new"), (3, "d")]
    put(spark, folder, [("+I", 2, "back", 10), ("+U", 1, "equal order, later commit", 9)])
    assert held(spark, folder) == [(1, "equal order, later commit"), (2, "back"), (3, "d")]


def test_bytes_written_follow_the_batch(spark, tmp_path):
    folder = str(tmp_path / "t")
    size = lambda: sum(f.stat().st_size for f in (tmp_path / "t").rglob("*") if f.is_file())
    keyed.append(spark.range(200_000).selectExpr("'+I' AS _row_kind", "cast(id AS int) AS k", "sha2(cast(id AS string), 256) AS v", "1 AS o"), folder, ["k"], ["o"])
    keyed.compact(spark, folder, range_rows=50_000)
    whole = size()
    for n in range(3):
        put(spark, folder, [("+U", n, "x", 2), ("-D", 100 + n, None, 2)])
    assert size() - whole < whole / 50
    assert len(keyed.state(spark, folder).ranges) == 4 and sum(r.rows for r in keyed.state(spark, folder).ranges) == 200_000
    assert held(spark, folder)[:2] == [(0, "x"), (1, "x")] and keyed.read(spark, folder).count() == 200_000 - 3
    assert sum(r.pending for r in keyed.state(spark, folder).ranges) == 6


def test_only_ranges_with_many_changes_are_rewritten(spark, tmp_path):
    folder = str(tmp_path / "t")
    put(spark, folder, [("+I", k, "a", 1) for k in range(64)])
    keyed.compact(spark, folder, range_rows=16)
    before = {r.name: r.path for r in keyed.state(spark, folder).ranges}
    touched = put(spark, folder, [("+U", 1, "b", 2)])
    keyed.compact(spark, folder, pending_share=0.0, range_rows=16)
    after = {r.name: r.path for r in keyed.state(spark, folder).ranges}
    assert sum(r.pending for r in touched.ranges) == 1
    assert len([n for n in after if after[n] != before.get(n)]) <= 2 < len(after)
    assert keyed.compact(spark, folder).number == keyed.state(spark, folder).number


def test_tombstones_go_past_the_horizon(spark, tmp_path):
    folder = str(tmp_path / "t")
    put(spark, folder, [("+I", 1, "a", 1), ("-D", 2, None, 5), ("-D", 3, None, 50)])
    keyed.compact(spark, folder, horizon=10)
    assert sorted(r["k"] for r in keyed.read(spark, folder, with_order=True).filter("_deleted").collect()) == [3]
    with pytest.raises(Exception, match="horizon"):
        put(spark, folder, [("+I", 2, "late", 4)])
    put(spark, folder, [("+I", 2, "late", 4), ("+I", 4, "d", 11)], late="ignore")
    assert held(spark, folder) == [(1, "a"), (4, "d")]
    keyed.compact(spark, folder, 0.0, horizon=3)  # it never goes back
    assert keyed.state(spark, folder).horizon == 10


def test_two_writers_of_one_number(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    put(spark, folder, [("+I", 1, "a", 1)])
    real, raced = keyed.write_new, []

    def write_new(s, path, text):
        if not raced:
            raced.append(path)
            put(spark, folder, [("+I", 2, "b", 1)])  # another writer is faster
        return real(s, path, text)

    monkeypatch.setattr(keyed, "write_new", write_new)
    put(spark, folder, [("+I", 3, "c", 1)])
    assert held(spark, folder) == [(1, "a"), (2, "b"), (3, "c")]
    assert not real(spark, f"{folder}/log/1", "taken") and files.read_text(spark, f"{folder}/log/1") != "taken"
    monkeypatch.setattr(keyed, "write_new", real)
    with pytest.raises(ValueError):
        keyed.append(changes(spark, [("+I", 1, "a", 1)]), folder, ["v"], ["o"])


def test_streamed_batches_once(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    run = lambda cp: sinks.merge_once(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src), out, ["k"], ["o"], ["k", "v"]).option("checkpointLocation", str(tmp_path / cp)).trigger(availableNow=True).start().awaitTermination()
    for rows in ([("+U", 1, "new", 9), ("-D", 2, None, 9)], [("+U", 1, "old", 3), ("+I", 2, "late", 4), ("+I", 3, "c", 1)], [("+U", 3, "d", 2)]):
        changes(spark, rows).coalesce(1).write.mode("append").parquet(src)
        run("cp")
    assert held(spark, out) == [(1, "new"), (3, "d")] and keyed.read(spark, out).columns == ["k", "v"]
    number = keyed.state(spark, out).number
    run("cp2")  # all batches delivered again
    assert keyed.state(spark, out).number == number and held(spark, out) == [(1, "new"), (3, "d")]


def test_empty_batches_and_tables(spark, tmp_path):
    folder = str(tmp_path / "t")
    put(spark, folder, [])
    assert held(spark, folder) == []
    keyed.compact(spark, folder, 0.0)
    put(spark, folder, [("+I", None, "n", 1)])
    assert held(spark, folder) == [(-1, "n")]
    with pytest.raises(FileNotFoundError):
        keyed.read(spark, str(tmp_path / "none"))


# -- tables by options


def test_no_row_is_lost_when_a_table_begins_to_follow(spark, tmp_path):
    """Plain rows before and after the first change, and two changes at once."""
    plain = lambda rows: spark.createDataFrame(rows, "k int, v string, o int")
    for connector, more in (("relational", {}), ("warehouse", {"sink.cdc.enabled": "true"})):
        o = {"path": str(tmp_path / connector), "key": "k", "order": "o"}
        read = lambda o=o, c=connector: sorted((r["k"], r["v"]) for r in catalog.table(spark, c, {"path": o["path"]}).collect())
        catalog.insert(plain([(1, "a", 1), (4, "old", 9)]), connector, {"path": o["path"]})
        assert read() == [(1, "a"), (4, "old")]
        catalog.insert(changes(spark, [("+I", 2, "b", 1), ("+U", 4, "changed", 2)]), connector, o | more)
        assert read() == [(1, "a"), (2, "b"), (4, "changed")]
        catalog.insert(plain([(3, "c", 1), (2, "late", 0)]), connector, o | more)
        assert read() == [(1, "a"), (2, "b"), (3, "c"), (4, "changed")]
        with pytest.raises(ValueError):
            catalog.insert(plain([(5, "e", 1)]).drop("o"), connector, o | more)
        with pytest.raises(ValueError):
            catalog.insert(plain([(5, "e", 1)]), connector, {"path": o["path"]})
    assert relational.follows(spark, str(tmp_path / "relational"))


def test_start_positions_by_options(spark, tmp_path):
    topic = str(tmp_path / "topic")
    old = datetime(2024, 1, 1)
    message = lambda n, at: (bytearray(b'{"n":%d}' % n), {}, None, str(n), at)
    from millrace.streaming import bus

    put_messages = lambda rows: spark.createDataFrame(rows, bus.MESSAGE).coalesce(1).write.mode("append").parquet(topic)
    put_messages([message(1, old), message(2, old + timedelta(days=1))])

    def got(name, **options):
        o = {"topic": topic, "format": "json", "schema": "n int", "subscription": name} | {k.replace("_", "-").replace("--", "."): v for k, v in options.items()}
        out = str(tmp_path / f"out-{name}")
        sinks.append_once(catalog.table(spark, "bus", o), out).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start().awaitTermination()
        return sorted(r["n"] for r in sinks.committed(spark, out, "n int").collect())

    ms = str(int((old + timedelta(hours=1)).replace(tzinfo=timezone.utc).timestamp() * 1000))
    assert got("all", scan__startup__mode="earliest-retained") == [1, 2]
    assert got("at", scan__startup__mode="timestamp", scan__startup__timestamp_millis=ms) == [2]
    assert got("new", scan__startup__mode="latest") == []
    put_messages([message(3, datetime.now(timezone.utc) + timedelta(minutes=1))])
    assert got("new", scan__startup__mode="latest") == [3]  # also what came while it was down
    for bad in ({"scan__startup__mode": "nonsense"}, {"scan__startup__mode": "timestamp"}, {"scan__startup__mode": "latest", "scan__startup__timestamp_millis": ms}):
        with pytest.raises(ValueError):
            got(f"bad{len(bad)}{bad['scan__startup__mode']}", **bad)
    with pytest.raises(ValueError):
        catalog.table(spark, "bus", {"topic": topic, "sink.retryy": "1"})
    catalog.check_options("bus", {"topic": topic, "sink.retry.max-attempts": "1", "emulator-endpoint": "x"})


def test_change_streams_by_options(spark, tmp_path):
    from millrace.operators.changelog import RECORD

    folder = str(tmp_path / "records")
    at = lambda day: datetime(2024, 1, day)
    record = lambda table, day, kind, new, old: (table, at(day), day, str(day), kind, "NEW_ROW_AND_OLD_VALUES", [('{"id":1}', new, old)])
    rows = [record("t", 1, "INSERT", '{"v":"a"}', None), record("t", 2, "UPDATE", '{"v":"b"}', '{"v":"a"}'), record("other", 2, "INSERT", '{"v":"x"}', None), record("t", 3, "DELETE", None, '{"v":"b"}')]
    spark.createDataFrame(rows, RECORD).write.parquet(folder)
    ms = lambda d: str(int(d.replace(tzinfo=timezone.utc).timestamp() * 1000))
    base = {"path": folder, "scan.mode": "change-stream", "schema": "id bigint, v string", "key": "id", "table": "t", "scan.change-stream.retention": "1000000000s"}

    def got(name, mode, **more):
        stream = catalog.table(spark, "relational", base | {"scan.change-stream.name": name, "scan.change-stream.changelog-mode": mode} | more)
        out = str(tmp_path / name)
        sinks.append_once(stream, out).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start().awaitTermination()
        return sorted((r["mod_number"], r["record_sequence"], r["row_number"], r["_row_kind"], r["id"], r["v"]) for r in sinks.committed(spark, out, "id int").collect())

    assert got("full", "full", **{"scan.startup.mode": "earliest"}) == [(0, "1", 0, "+I", 1, "a"), (0, "2", 0, "-U", 1, "a"), (0, "2", 1, "+U", 1, "b"), (0, "3", 0, "-D", 1, "b")]
    assert got("upsert", "upsert", **{"scan.startup.mode": "timestamp", "scan.startup.timestamp-millis": ms(at(2)), "scan.end-timestamp-millis": ms(at(3))}) == [(0, "2", 0, "+U", 1, "b")]
    for bad in ({"scan.mode": "nonsense"}, {"scan.startup.mode": "nonsense"}, {"scan.startup.mode": "timestamp"}, {"scan.startup.timestamp-millis": "1"}, {"scan.change-stream.changelog-mode": "all"}):
        with pytest.raises(ValueError):
            got("bad", "full", **bad)
    with pytest.raises(ValueError):
        catalog.table(spark, "relational", {"path": folder, "scan.startup.mode": "latest"})


def test_kept_starts(spark, tmp_path):
    now, place = datetime(2024, 5, 1, tzinfo=timezone.utc), str(tmp_path / "s")
    first = positions.kept_start(spark, place, "latest", retention=timedelta(days=7), now=now)
    assert first == now == positions.kept_start(spark, place, "latest", retention=timedelta(days=7), now=now + timedelta(days=30))
    assert positions.kept_start(spark, place + "2", "earliest") is None is positions.kept_start(spark, place + "2", "latest")
    assert positions.kept_start(spark, place + "3", "at", now - timedelta(days=9), timedelta(days=7), now) == now - timedelta(days=7) + positions.SAFETY


def test_odd_values(spark):
    """Null batches, unknown changes, payloads of all kinds and bounds that are no text."""
    from millrace.functions import codec
    from millrace.operators import changelog, failures
    from millrace.plans import ranges
    from millrace.streaming import bus

    df = spark.createDataFrame([(None, 1, True), (None, 2, False), ("b", 3, False)], "batch string, n int, bad boolean")
    assert sorted((r["n"], r["failed"]) for r in failures.isolate(df, "batch", F.col("bad"), F.col("n") == 1).collect()) == [(1, True), (2, False), (3, False)]
    for kind, mods in (("REPLACE", [('{"k":1}', "{}", "{}")]), (None, [('{"k":1}', "{}", "{}")]), ("INSERT", None)):
        for mode in ("full", "upsert"):
            records = spark.createDataFrame([("t", datetime(2024, 1, 1), 1, "1", kind, "NEW_ROW_AND_OLD_VALUES", mods)], changelog.RECORD)
            with pytest.raises(Exception, match="kind|without mods"):
                changelog.expand(records, spark.createDataFrame([], "k int, v int").schema, ["k"], mode).collect()
    payloads = [b'{"k":1}', b"{}", b"", b"  ", None, b"null", b"{oops", b'\xff{"k":1}', b"[1]", b'{"k":"x"}']
    m = spark.createDataFrame([(i, bytearray(p) if p is not None else None) for i, p in enumerate(payloads)], "i int, payload binary")
    found = {r["i"]: (r["k"], r["_failed"]) for r in bus.decode_json(m, "k int", "nack").collect()}
    assert {i for i, (_, failed) in found.items() if not failed} == {0, 1} and found[0] == (1, False)
    assert sorted(r["i"] for r in bus.decode_json(m, "k int", "drop").collect()) == [0, 1]
    for i in range(2, len(payloads)):
        with pytest.raises(Exception, match="no JSON"):
            bus.decode_json(m.filter(F.col("i") == i), "k int").collect()
    cell = spark.createDataFrame([(bytearray(b"a\xff"),)], "c binary").select(codec.decode_cell(F.col("c"), "string").cast("binary").alias("b"))
    assert bytes(cell.first()["b"]) == b"a\xff"
    text = spark.createDataFrame([("þ",), ("ÿx",), ("Ā",)], "t string")
    assert [r["t"] for r in text.filter(ranges.predicate(F.col("t"), [ranges.prefix("ÿ".encode())], as_text=True)).collect()] == ["ÿx"]
