from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators.changelog import RECORD
from millrace.sources import catalog, kv, relational, warehouse
from millrace.streaming import bus, changes, sinks


def drain(writer, checkpoint):
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def test_append_once_survives_replay(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    spark.range(10).write.mode("append").parquet(src)
    stream = lambda: spark.readStream.schema("id long").parquet(src)
    drain(sinks.append_once(stream(), out), cp)
    spark.range(10, 15).write.mode("append").parquet(src)
    drain(sinks.append_once(stream(), out), cp)
    assert sinks.committed(spark, out).count() == 15
    # the same batches delivered again, as after a lost commit
    drain(sinks.append_once(stream(), out), str(tmp_path / "cp2"))
    assert sinks.committed(spark, out).count() == 15


def test_unfinished_batch_is_invisible(spark, tmp_path):
    out = str(tmp_path / "out")
    spark.range(3).write.parquet(f"{out}/batch-0")
    spark.range(9).write.parquet(f"{out}/batch-1")
    (tmp_path / "out" / "batch-1" / "_SUCCESS").unlink()
    assert sinks.committed(spark, out).count() == 3


def test_upsert_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    schema = "_row_kind string, k int, v string, o int"
    spark.createDataFrame([("+I", 1, "a", 1), ("+I", 2, "b", 2)], schema).write.parquet(src)
    run = lambda: drain(sinks.upsert_once(spark.readStream.schema(schema).parquet(src), out, ["k"], ["o"], ["k", "v"]), cp)
    run()
    spark.createDataFrame([("+U", 1, "z", 3), ("-D", 2, None, 4), ("+I", 3, "c", 5)], schema).write.mode("append").parquet(src)
    run()
    assert sorted(tuple(r) for r in sinks.current(spark, out).collect()) == [(1, "z"), (3, "c")]


def test_upsert_once_in_any_order_of_batches(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    schema = "_row_kind string, k int, v string, o int"
    run = lambda c=cp: drain(sinks.upsert_once(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), out, ["k"], ["o"], ["k", "v"], 8), c)
    for rows in ([("+U", 1, "new", 9), ("-D", 2, None, 9), *[("+I", k, "x", 1) for k in range(10, 30)]], [("+U", 1, "old", 3), ("+I", 2, "late", 4), ("+I", 3, "c", 1)], [("+U", 10, "y", 2)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        run()
    wanted = sorted([(1, "new"), (3, "c"), (10, "y"), *[(k, "x") for k in range(11, 30)]])
    assert sorted(map(tuple, sinks.current(spark, out).collect())) == wanted
    assert sinks.current(spark, out, with_order=True).filter("_deleted").count() == 1
    # the last batch touched one bucket and left the others where they are
    assert len([x for x in (tmp_path / "out" / "batch-2").iterdir() if x.name.startswith("_bucket=")]) == 1
    run(str(tmp_path / "cp2"))  # all batches delivered again
    assert sorted(map(tuple, sinks.current(spark, out).collect())) == wanted
    assert any("manifest-0" in p for p in sinks.clean(spark, out, keep=1))
    assert sorted(map(tuple, sinks.current(spark, out).collect())) == wanted


def test_records_without_commit_time_wait(spark):
    batch = spark.createDataFrame([(datetime(2024, 1, 1), 1), (None, 2)], "commit_ts timestamp, n int")
    ledger = spark.createDataFrame([("RUNNING", 4102444800000)], "state string, watermark_ms long")
    out, held = changes.release_to_frontier(batch, None, ledger)
    assert [r["n"] for r in out.collect()] == [1] and [r["n"] for r in held.collect()] == [2]


def test_bus_round_trip(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1, {"source": "sql"}, "key-1"), ("b", 2, {"source": "x"}, "")], "id string, amount int, attrs map<string,string>, okey string")
    body = F.to_json(F.struct("id", "amount"))
    bus.publish(df.select(*bus.message(body, F.col("attrs"), F.col("okey"), publish_time=F.lit(datetime(2024, 1, 1)))), topic)
    stream = bus.subscribe(spark, topic, "attributes['source'] = 'sql'", start=datetime(2023, 1, 1))
    drain(sinks.append_once(bus.decode_json(stream, "id string, amount int"), out), str(tmp_path / "cp"))
    row = sinks.committed(spark, out).collect()
    assert [(r["id"], r["amount"], r["ordering_key"], r["subscription"]) for r in row] == [("a", 1, "key-1", "default")]
    assert spark.read.parquet(topic).filter("ordering_key IS NULL").count() == 1


def test_null_attribute_is_refused(spark):
    bad = spark.range(1).select(*bus.message(F.lit("x"), F.create_map(F.lit("a"), F.lit(None).cast("string"))))
    with pytest.raises(Exception, match="keys and values"):
        bad.collect()


def test_decode_policies(spark):
    m = spark.createDataFrame([(bytearray(b'{"k":1}'),), (bytearray(b"{oops"),)], "payload binary")
    assert bus.decode_json(m, "k int", "drop").count() == 1
    assert bus.decode_json(m, "k int", "nack").filter("_failed").count() == 1
    with pytest.raises(Exception):
        bus.decode_json(m, "k int", "fail").collect()


def test_frontier_gates_records(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    rows = [("t", datetime(2024, 1, 1, h), h, str(h), "INSERT", "NEW_ROW", []) for h in range(4)]
    spark.createDataFrame(rows, RECORD).write.parquet(src)
    state = {"ledger": [("RUNNING", int(datetime(2024, 1, 1, 2).timestamp() * 1000))]}
    ledger = lambda s: s.createDataFrame(state["ledger"], "state string, watermark_ms long")
    drain(changes.gated(changes.read(spark, src, end=datetime(2024, 1, 1, 3)), out, ledger), cp)
    assert spark.read.parquet(f"{out}/out/batch-0").count() == 2
    spark.createDataFrame(rows[:0] + [("t", datetime(2024, 1, 1, 2, 30), 9, "9", "INSERT", "NEW_ROW", [])], RECORD).write.mode("append").parquet(src)
    state["ledger"] = [("FINISHED", 0)]
    drain(changes.gated(changes.read(spark, src, end=datetime(2024, 1, 1, 3)), out, ledger), cp)
    assert spark.read.parquet(f"{out}/out/batch-1").count() == 2
    assert spark.read.parquet(f"{out}/held/batch-1").count() == 0


def test_tables_by_options(spark, tmp_path):
    path = str(tmp_path / "cells")
    c = spark.createDataFrame([(bytearray(b"r1"), "f", "q", 1, bytearray(b"\x00" * 7 + b"\x05")), (bytearray(b"r2"), "f", "q", 1, bytearray(b"\x00" * 7 + b"\x06"))], "row_key binary, family string, qualifier string, ts_micros long, value binary")
    kv.store(c, path, 2)
    catalog.create_view(spark, "kv_view", "kv", {"path": path, "families": "f:q bigint", "scan.row-ranges": "[r2,)", "sink.retry.max-attempts": "3"})
    assert [tuple(r) for r in spark.sql("SELECT row_key, f.q FROM kv_view").collect()] == [("r2", 6)]
    with pytest.raises(ValueError):
        catalog.table(spark, "kv", {"path": path, "families": "f:q bigint", "no.such": "1"})
    with pytest.raises(ValueError):
        catalog.table(spark, "nothing", {})


def test_base64_keys_in_options(spark, tmp_path):
    import base64

    path = str(tmp_path / "cells")
    rows = [(bytearray(k), "f", "q", 1, bytearray(b"\x00" * 7 + bytes([i]))) for i, k in enumerate((b"\xfe\x01", b"\xff\x01", b"\xff\xff"))]
    kv.store(spark.createDataFrame(rows, "row_key binary, family string, qualifier string, ts_micros long, value binary"), path, 1)
    b64 = lambda b: base64.b64encode(b).decode()
    base = {"path": path, "families": "f:q bigint", "scan.row-key-encoding": "base64", "key-type": "binary"}
    got = lambda o: sorted(r["f"]["q"] for r in catalog.table(spark, "kv", base | o).collect())
    assert got({"scan.row-prefix": b64(b"\xff")}) == [1, 2]
    assert got({"scan.row-range.start-closed": b64(b"\xfe\x01"), "scan.row-range.end-open": b64(b"\xff\x01")}) == [0]
    with pytest.raises(ValueError):
        got({"scan.row-prefix": b64(b"a"), "scan.row-ranges": "[YQ==,)"})


def test_snapshot_options_restrict_what_the_snapshot_gives(spark, tmp_path):
    path = str(tmp_path / "v")
    spark.createDataFrame([(1, "a", datetime(2024, 1, 1), False), (1, "b", datetime(2024, 1, 2), False), (2, "a", datetime(2024, 1, 1), False), (2, None, datetime(2024, 1, 3), True)], "k int, v string, t timestamp, gone boolean").write.parquet(path)
    o = {"path": path, "key": "k", "version-time": "t", "deleted": "gone", "columns": "k"}
    for at, restriction, wanted in (("2024-02-01", "v = 'a'", []), ("2024-01-01 12:00:00", "v = 'a'", [1, 2]), ("2024-02-01", "v = 'b'", [1]), ("2024-01-02 12:00:00", "true", [1, 2])):
        df = catalog.table(spark, "warehouse", o | {"source.snapshot-time": at, "source.row-restriction": restriction})
        assert df.columns == ["k"] and sorted(r["k"] for r in df.collect()) == wanted
    stale = catalog.table(spark, "relational", {"path": path, "key": "k", "version-time": "t", "scan.timestamp-bound.exact-staleness": "60s"})
    assert stale.count() == 2
    with pytest.raises(ValueError):
        catalog.table(spark, "warehouse", {"path": path, "source.snapshot-time": "2024-01-01"})


def test_inserts_by_options(spark, tmp_path):
    topic, queue, table, cells_path = (str(tmp_path / n) for n in ("topic", "queue", "table", "cells"))
    df = spark.createDataFrame([("a", 1, "key-1"), ("b", 2, "")], "id string, amount int, okey string")
    o = {"topic": topic, "format": "json", "ordering-key": "okey"}
    catalog.insert(df, "bus", o)
    back = catalog.table(spark, "bus", {"topic": topic, "format": "json", "schema": "id string, amount int", "scan.ordering-mode": "PER_KEY"})
    assert sorted((r["id"], r["amount"], r["ordering_key"] or "") for r in back.collect()) == [("a", 1, "key-1"), ("b", 2, "")]
    stream = catalog.table(spark, "bus", {"topic": topic, "format": "json", "schema": "id string, amount int", "scan.startup.mode": "earliest"})
    drain(sinks.append_once(stream, str(tmp_path / "seen")), str(tmp_path / "cp"))
    assert sinks.committed(spark, str(tmp_path / "seen")).count() == 2

    tasks = {"queue": queue, "http.url": "https://host/path", "http.headers": "A:1,B:2", "name-column": "id", "body": "id"}
    catalog.insert(df, "tasks", tasks)
    catalog.insert(df, "tasks", tasks)  # named tasks once
    rows = spark.read.parquet(queue).collect()
    assert sorted(r["body"] for r in rows) == ["a", "b"] and rows[0]["headers"] == {"A": "1", "B": "2"}
    catalog.insert(df, "tasks", {"queue": queue + "2", "app-engine.relative-uri": "/work", "app-engine.service": "s"})
    assert spark.read.parquet(queue + "2").first()["routing"]["service"] == "s"
    with pytest.raises(ValueError):
        catalog.insert(df, "tasks", {"queue": queue})

    kv_options = {"path": cells_path, "families": "f:amount int;g:okey string", "key-column": "id"}
    catalog.insert(df, "kv", kv_options)
    read = catalog.table(spark, "kv", {"path": cells_path, "families": "f:amount int", "scan.row-prefix": "b"})
    assert [(r["row_key"], r["f"]["amount"]) for r in read.collect()] == [("b", 2)]

    changelog_of = lambda rows: spark.createDataFrame(rows, "_row_kind string, k int, v string, o int")
    o = {"path": table, "key": "k", "order": "o"}
    catalog.insert(changelog_of([("+U", 1, "new", 5), ("-D", 2, None, 7)]), "relational", o)
    catalog.insert(changelog_of([("+U", 1, "old", 4), ("+I", 2, "late", 6), ("+I", 3, "c", 1)]), "relational", o)
    assert sorted((r["k"], r["v"]) for r in relational.read_current(spark, table).collect()) == [(1, "new"), (3, "c")]

    assert sorted((r["k"], r["v"]) for r in catalog.table(spark, "relational", {"path": table, "columns": "k,v"}).collect()) == [(1, "new"), (3, "c")]

    cdc = {"path": str(tmp_path / "cdc"), "key": "k", "order": "o", "sink.cdc.enabled": "true", "sink.cdc.max-staleness": "5m"}
    with pytest.raises(FileNotFoundError):
        catalog.insert(changelog_of([("+U", 1, "a", 1)]), "warehouse", cdc | {"sink.create-disposition": "create-never"})
    catalog.insert(changelog_of([("+U", 1, "a", 2)]), "warehouse", cdc)
    catalog.insert(changelog_of([("+U", 1, "late", 1), ("+U", 2, "b", 1)]), "warehouse", cdc)
    assert sorted((r["k"], r["v"]) for r in catalog.table(spark, "warehouse", {"path": cdc["path"], "source.row-restriction": "k < 9"}).collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        catalog.insert(changelog_of([("+U", 1, "x", 9)]), "warehouse", cdc | {"sink.cdc.max-staleness": "1m"})
    catalog.insert(changelog_of([("+U", 1, "x", 9)]), "warehouse", cdc | {"sink.cdc.max-staleness": "1m", "sink.cdc.table-reconciliation": "reconcile"})
    with pytest.raises(ValueError):
        catalog.insert(changelog_of([("+U", 1, "x", 9)]), "warehouse", cdc | {"key": "v"})

    path = str(tmp_path / "w")
    catalog.insert(df, "warehouse", {"path": path, "sink.table-create.clustered-fields": "id"})
    catalog.insert(df.select("id", F.col("amount").cast("long").alias("amount")), "warehouse", {"path": path, "sink.file-loads.write-disposition": "truncate-data"})
    kept = spark.read.parquet(path)
    assert kept.count() == 2 and kept.schema["amount"].dataType.simpleString() == "int" and kept.filter("okey IS NULL").count() == 2
    with pytest.raises(ValueError):
        catalog.insert(df.withColumn("more", F.lit(1)), "warehouse", {"path": path, "sink.file-loads.write-disposition": "truncate-data"})


def test_records_none_to_many_a_message(spark):
    m = spark.createDataFrame([(bytearray(b"a,b"),), (bytearray(b""),), (None,)], "payload binary")
    out = bus.expand(m, lambda p: F.filter(F.split(F.decode(p, "UTF-8"), ","), lambda x: x != ""))
    assert sorted(r["record"] for r in out.collect()) == ["a", "b"]


def test_split_owners(spark):
    subs = spark.createDataFrame([("b",), ("a",), ("c",)], "subscription string")
    one = sorted(map(tuple, bus.split_owners(subs, 2).collect()))
    assert one == [(0, "a", 0), (1, "b", 1), (2, "c", 0)]
    many = sorted(map(tuple, bus.split_owners(subs, 5, "none").collect()))
    assert many == [(0, "a", 0), (1, "b", 1), (2, "c", 2), (3, "a", 3), (4, "b", 4)]


def test_write_dispositions(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        warehouse.write(spark.range(1), path, create="never")
    warehouse.write(spark.range(3), path, "empty")
    with pytest.raises(Exception, match="exists"):
        warehouse.write(spark.range(3), path, "empty")
    warehouse.write(spark.range(2), path)
    assert spark.read.parquet(path).count() == 5
    warehouse.write(spark.range(1), path, "truncate", cluster_by=["id"])
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        warehouse.write(spark.range(1), path, "truncate", streaming=True)
    by_day = spark.range(3).withColumn("ts", F.timestamp_seconds(F.col("id") * 86400))
    warehouse.write(by_day, str(tmp_path / "p"), partition_by=F.date_trunc("day", "ts").cast("date"))
    assert len([x for x in (tmp_path / "p").iterdir() if x.name.startswith("_partition=")]) == 3


def test_index_rules(spark, tmp_path):
    path = str(tmp_path / "i")
    relational.store(spark.range(5).select("id", (F.col("id") * 2).alias("v")), path, ["v"], 1)
    index = relational.Index(path, ["v"], ["v", "id"], null_filtered=True)
    with pytest.raises(ValueError):
        relational.index_scan(spark, index, ["other"])
    with pytest.raises(ValueError):
        relational.index_scan(spark, index, ["id"])
    from millrace.plans.keysets import Condition

    assert relational.index_scan(spark, index, ["id"], [Condition("v", ">=", 6)]).count() == 2
