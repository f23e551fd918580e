"""Batches and ranges of one group over many partitions equal what a single task finds."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.plans import ranges, staging


@pytest.fixture
def partitions(spark):
    """Small inputs stay in many partitions."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield 7
    for k, v in before.items():
        spark.conf.set(k, v)


def brute_batches(rows, limits):
    """(group, i) -> batch of rows (group, i, *sizes)."""
    out, state = {}, {}
    for g, i, *sizes in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        sizes = [s or 0 for s in sizes]
        totals, count, batch = state.get(g, ([0] * len(sizes), 0, 0))
        if count and any(t + s > m for t, s, m in zip(totals, sizes, limits)):
            totals, count, batch = [0] * len(sizes), 0, batch + 1
        state[g] = ([t + s for t, s in zip(totals, sizes)], count + 1, batch)
        out[g, i] = batch
    return out


@pytest.mark.parametrize("seed", range(5))
def test_batches_of_groups_over_partitions(spark, partitions, seed):
    r = random.Random(seed)
    groups = [("a", 400), (None, 60), ("b", 3), ("c", 1), ("d", 250)][: r.choice([1, 5])]
    kind = [[0, 1, 2, 9], [1, 1, 1, 500], [3, None, 0, 150], [0, 0, 1]][seed % 4]
    rows = [(g, i, r.choice(kind), r.choice([1, 1, 2])) for g, n in groups for i in range(n)]
    limits = [r.choice([5, 100, 10**6]), r.choice([7, 10**6])]  # some batches span several partitions
    df = spark.createDataFrame(rows, "g string, i int, size long, two int").repartition(3)
    out = staging.greedy_batches(df, ["g"], "i", {"size": limits[0], "two": limits[1]})
    assert out.columns == ["g", "i", "size", "two", "batch"] and df.columns == ["g", "i", "size", "two"]
    got = out.withColumn("p", F.spark_partition_id()).collect()
    assert {(x["g"], x["i"]): x["batch"] for x in got} == brute_batches(rows, limits) and len(got) == len(rows)
    assert len({x["p"] for x in got if x["g"] == "a"}) > 1


def test_batches_of_nothing(spark, partitions):
    empty = spark.createDataFrame([], "g string, i int, size long")
    assert staging.greedy_batches(empty, ["g"], "i", {"size": 5}).count() == 0


def brute_islands(rows):
    out = []
    for g in {r[0] for r in rows}:
        islands = []
        for s, e in sorted(((s, e) for x, s, e in rows if x == g), key=lambda r: (r[0], r[1] is None, r[1] or 0)):
            if islands and (islands[-1][1] is None or s <= islands[-1][1]):
                islands[-1][1] = None if islands[-1][1] is None or e is None else max(islands[-1][1], e)
            else:
                islands.append([s, e])
        out += [(g, *i) for i in islands]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_islands_and_gaps_over_partitions(spark, partitions, seed):
    r = random.Random(seed)
    length = r.choice([3, 12, 200])
    rows = [(r.choice(["a", "a", "a", None]), s, s + r.randrange(1, length)) for s in (r.randrange(2000) for _ in range(300))]
    rows += [("a", 500, 1900)] * (seed % 2) + [(None, 1990, None), ("b", 5, 6)]
    df = spark.createDataFrame(rows, "g string, start int, end int").repartition(3)
    islands = brute_islands(rows)
    key = lambda x: (x[0] or "", x[1])
    assert sorted(map(tuple, ranges.coalesced(df, ["g"]).collect()), key=key) == sorted(islands, key=key)
    assert sorted(map(tuple, ranges.coalesced(df, ["g"], small_groups=True).collect()), key=key) == sorted(islands, key=key)
    between = []
    for g in {x[0] for x in rows}:
        own = sorted((x for x in islands if x[0] == g), key=lambda x: x[1])
        between += [(g, a[2], b[1]) for a, b in zip(own, own[1:])]
    assert sorted(map(tuple, ranges.gaps(df, ["g"]).collect()), key=key) == sorted(between, key=key)


def test_islands_without_groups_and_of_bytes(spark, partitions):
    df = spark.createDataFrame([(bytearray(s), bytearray(e)) for s, e in ((b"a", b"c"), (b"c", b"d"), (b"\xfe", b"\xff"), (b"b", b"ba"))], "start binary, end binary")
    assert sorted((bytes(r["start"]), bytes(r["end"])) for r in ranges.coalesced(df, []).collect()) == [(b"a", b"d"), (b"\xfe", b"\xff")]
    assert [(bytes(r["start"]), bytes(r["end"])) for r in ranges.gaps(df, []).collect()] == [(b"d", b"\xfe")]
    assert ranges.coalesced(df.limit(0), []).count() == 0
