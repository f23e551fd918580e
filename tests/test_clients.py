"""Lookups as of a time, calls under way at once, batches isolated by halving, and appends to many destinations."""

import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.retry import RetryableError
from millrace.operators import failures, lookup
from millrace.sources import files
from millrace.streaming import sinks


@pytest.mark.parametrize("spread", [False, True])
def test_lookup_as_of(spark, spread):
    """Also where one hot key lies over several partitions."""
    if spread:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        r = random.Random(2)
        versions = [(r.choice(["a", "a", "a", "b", None]), r.choice([None, *range(100)]), i, i % 9 == 0) for i in range(80)]
        probes = [(r.choice(["a", "a", "b", "c", None]), r.choice([None, *range(100)]), i) for i in range(300)]
        best = {}
        for k, t, v, gone in versions:
            if k is not None and t is not None:
                best.setdefault((k, t), []).append((v, gone))
        single = [(k, t, *x[0]) for (k, t), x in best.items()] + [v for v in versions if v[0] is None or v[1] is None]
        v = spark.createDataFrame(single, "k string, since int, v int, gone boolean").repartition(3)
        p = spark.createDataFrame(probes, "key string, at int, n int").repartition(3)
        wanted = {}
        for k, at, n in probes:
            held = max(((t, x, gone) for kk, t, x, gone in single if kk == k and k is not None and t is not None and at is not None and t <= at), default=None)
            wanted[n] = None if held is None or held[2] else held[1]
        found = lookup.lookup_as_of(p, v, {"key": "k"}, "at", "since", deleted=F.col("gone"))
        assert found.columns == ["key", "at", "n", "since", "v", "gone"]
        assert {x["n"]: x["v"] for x in found.collect()} == wanted and found.count() == 300
        inner = lookup.lookup_as_of(p, v, {"key": "k"}, "at", "since", "inner", F.col("gone"))
        assert {x["n"] for x in inner.collect()} == {n for n, x in wanted.items() if x is not None}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_lookups_are_under_way_at_once(spark):
    df = spark.range(8).coalesce(1)
    schema = T.StructType([T.StructField("v", T.LongType()), T.StructField("took", T.DoubleType())])

    def slow(keys):
        began = time.time()
        time.sleep(0.05 + 0.02 * (keys[0][0] == 0))  # the first answers last
        return [(k[0] * 10, began) for k in keys]

    rows = lookup.remote_lookup(df, ["id"], slow, schema, batch=1, concurrency=8).collect()
    assert [(r["id"], r["v"]) for r in rows] == [(i, i * 10) for i in range(8)]
    assert max(r["took"] for r in rows) - min(r["took"] for r in rows) < 0.045  # all calls began before any had ended
    tries = []

    def flaky(keys):
        tries.append(keys)
        if len(tries) % 2:
            raise RetryableError("UNAVAILABLE")
        return [(k[0], 0.0) for k in keys]

    assert sorted(r["v"] for r in lookup.remote_lookup(df, ["id"], flaky, schema, batch=8, backoff=(1, 2)).collect()) == list(range(8))

    def broken(keys):
        raise RetryableError("PERMISSION_DENIED" if keys[0][0] == 5 else "UNAVAILABLE")

    for fetch in (broken, lambda keys: []):
        with pytest.raises(Exception, match="PERMISSION_DENIED|UNAVAILABLE|answers"):
            lookup.remote_lookup(df, ["id"], fetch, schema, batch=1, backoff=(1, 2)).collect()


def test_rejected_batches_are_halved(spark, tmp_path):
    log = str(tmp_path)

    def send(rows):
        with open(f"{log}/calls", "a") as f:
            f.write(f"{len(rows)}\n")
        if any(r["n"] % 100 == 37 for r in rows):
            raise failures.Rejected("37 is bad")

    df = spark.range(1000).select(F.col("id").alias("n"), F.when(F.col("id") < 900, F.floor(F.col("id") / 300)).alias("batch")).repartition(5)
    out = failures.sent(df, "batch", send, "n").collect()
    assert len(out) == 1000 and {r["n"] for r in out if r["failed"]} == {n for n in range(1000) if n % 100 == 37}
    assert {r["error"] for r in out} == {None, "37 is bad"}
    calls = len(open(f"{log}/calls").readlines())
    assert calls <= 4 + 2 * 10 * 9  # a few for each bad row

    def refuse(rows):
        raise failures.Rejected("no")

    with pytest.raises(Exception, match="in a row"):
        failures.sent(df.filter("n < 300"), "batch", refuse, "n").count()
    assert failures.sent(df.limit(5), "batch", refuse, "n", most=6).filter("failed").count() == 5
    with pytest.raises(Exception, match="down"):
        failures.sent(df, "batch", lambda rows: (_ for _ in ()).throw(OSError("down"))).count()


def test_batches_are_visible_at_all_destinations_or_none(spark, tmp_path, monkeypatch):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = "n int, dest string"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    run = lambda cp="cp": sinks.append_routed_once(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), out, "dest").option("checkpointLocation", str(tmp_path / cp)).trigger(availableNow=True).start().awaitTermination()
    got = lambda d: sorted(r["n"] for r in sinks.routed(spark, out, d, schema).collect())
    put([(1, "a"), (2, "b/c d"), (3, "a")])
    real = sinks.write_new
    monkeypatch.setattr(sinks, "write_new", lambda *a: (_ for _ in ()).throw(OSError("crash before the commit")))
    with pytest.raises(Exception, match="crash"):
        run()
    assert got("a") == got("b/c d") == []  # the files of all destinations are there, none is seen
    monkeypatch.setattr(sinks, "write_new", real)
    run()
    assert got("a") == [1, 3] and got("b/c d") == [2] and got("none") == []
    put([(4, "b/c d")])
    run()
    run("cp2")  # all batches delivered again
    assert got("a") == [1, 3] and got("b/c d") == [2, 4] and files.numbers(spark, f"{out}/log") == [0, 1]
    put([(5, None)])
    with pytest.raises(Exception, match="destination"):
        run()
