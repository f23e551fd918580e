from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.plans import keysets, positions, ranges, staging
from millrace.plans.ranges import KeyRange

keys = st.binary(max_size=3)
key_ranges = st.builds(KeyRange, keys, st.one_of(st.none(), keys))
sets = st.lists(key_ranges, max_size=6)


def holds(chosen, key):
    return any(key in r for r in chosen)


@given(sets, sets, keys)
@settings(max_examples=300, deadline=None)
def test_range_algebra_agrees_with_membership(a, b, key):
    assert holds(ranges.union(a), key) == holds(a, key)
    assert holds(ranges.intersection(a, b), key) == (holds(a, key) and holds(b, key))
    assert holds(ranges.complement(a), key) != holds(a, key)


@given(sets)
@settings(max_examples=200, deadline=None)
def test_union_is_disjoint_and_sorted(a):
    out = ranges.union(a)
    assert all(x.end is not None and x.end < y.start for x, y in zip(out, out[1:]))


@given(keys, keys)
@settings(max_examples=200, deadline=None)
def test_comparisons(value, key):
    for op, truth in {"=": key == value, "<>": key != value, "<": key < value, "<=": key <= value, ">": key > value, ">=": key >= value, "prefix": key.startswith(value)}.items():
        assert holds(ranges.from_comparison(op, value), key) == truth, op
    assert ranges.from_comparison("=", None) == []
    assert holds(ranges.from_comparison("in", [value, None]), value)


def test_parse():
    assert ranges.parse("[a,b);[c,)") == [KeyRange(b"a", b"b"), KeyRange(b"c", None)]
    assert ranges.parse(r"[a\,b,c]") == [KeyRange(b"a,b", b"c\x00")]
    assert ranges.parse("[YQ==,Yg==)", "base64") == [KeyRange(b"a", b"b")]
    for bad in ("a,b", "[a;b)", "[b,a)"):
        with pytest.raises(ValueError):
            ranges.parse(bad)


def test_type_gates():
    assert ranges.can_push("string", "<") and ranges.can_push("bigint", "=")
    assert not ranges.can_push("bigint", "<") and not ranges.can_push("double", "=")


def test_split_at_samples():
    parts = ranges.split_at([KeyRange(b"a", b"z")], [(b"m", 100), (b"m", 90), (b"", 5), (b"zz", 300)])
    assert [p for p, _ in parts] == [KeyRange(b"a", b"m"), KeyRange(b"m", b"z")]
    assert [n for _, n in parts] == [100, 200]


def test_predicate_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("k")).write.parquet(path)
    df = spark.read.parquet(path).filter(ranges.predicate(F.col("k"), ranges.parse("[000010,000020);[000500,000501]"), as_text=True))
    assert df.count() == 12
    assert "GreaterThanOrEqual(k,000010)" in df._jdf.queryExecution().toString()


def test_coalesced_with_unbounded_end(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 5, None), (1, 100, 110), (2, 0, 1), (2, 3, 4)], "g int, start int, end int")
    assert sorted(tuple(r) for r in ranges.coalesced(df, ["g"]).collect()) == [(1, 0, None), (2, 0, 1), (2, 3, 4)]
    covered = ranges.fully_covered(df, F.lit(0), F.lit(50), ["g"]).collect()
    assert {r["g"]: r["covered"] for r in covered} == {1: True, 2: False}


def test_keyset_selection():
    c = keysets.Condition
    s = keysets.select(["a", "b", "c"], [c("a", "=", 1), c("b", ">", 2), c("c", "=", 3), c("x", "=", 4), c("a", "is_not_null")])
    assert [x.column for x in s.enforced] == ["a", "b"]
    assert {(x.column, x.op) for x in s.remaining} == {("c", "="), ("x", "="), ("a", "is_not_null")}
    assert keysets.select(["a"], [c("a", "=", 1), c("a", "=", 2)]).empty
    assert keysets.select(["a"], [c("a", ">", 5), c("a", "<=", 5)]).empty
    assert not keysets.select(["a"], [c("a", ">=", 5), c("a", "<=", 5)]).empty
    assert keysets.select(["a"], [c("a", "=", float("nan"))]).remaining


def test_loads_pack_in_name_order(spark):
    files = spark.createDataFrame([("d", "parquet", f"f{i:02}", 40, 1) for i in range(7)] + [("e", "avro", "x", 500, 1)], "destination string, format string, uri string, bytes long, rows long")
    planned = staging.plan_loads(files, max_files=3, max_bytes=100)
    got = {r["uri"]: r["load_index"] for r in planned.collect()}
    assert got == {"f00": 0, "f01": 0, "f02": 1, "f03": 1, "f04": 2, "f05": 2, "f06": 3, "x": 0}
    loads = {(r["destination"], r["load_index"]): r for r in staging.loads(planned, "7").collect()}
    assert loads["e", 0]["direct"] and not loads["d", 0]["direct"]
    again = {r["load_id"] for r in staging.loads(planned, "7").collect()}
    assert again == {r["load_id"] for r in loads.values()} and all(i.endswith("-c7") for i in again)
    assert staging.copy_levels(1) == [] and staging.copy_levels(2500, 1200) == [3, 1]


def test_start_positions():
    now = datetime(2024, 1, 10, tzinfo=timezone.utc)
    week = timedelta(days=7)
    assert positions.start_time("latest", now, week) == now
    assert positions.start_time("at", now, week, at=now - timedelta(days=30)) == now - week + positions.SAFETY
    with pytest.raises(ValueError):
        positions.start_time("at", now, week, at=now + timedelta(seconds=1))
    with pytest.raises(positions.StartExpired):
        positions.restored_start(now - timedelta(days=8), now, week)
    assert positions.restored_start(now - timedelta(days=8), now, week, "latest") == now


def test_query_results_are_reused_within_the_window(spark, tmp_path):
    results = positions.QueryResults(spark, str(tmp_path / "r"), timedelta(hours=1))
    first = results.query("q", "SELECT rand() AS x").first()["x"]
    assert results.query("q", "SELECT rand() AS x").first()["x"] == first
    later = datetime.now(timezone.utc) + timedelta(hours=3)
    assert results.query("q", "SELECT rand() AS x", now=later).first()["x"] != first


def test_number_bounds_of_padded_keys():
    import random

    r = random.Random(1)
    for _ in range(400):
        cut = lambda: str(r.randrange(1000)).zfill(3)[: r.randint(1, 3)] + r.choice(["", "", "\x00", "5", "x"])
        low, high = cut().encode(), r.choice([None, cut().encode()])
        chosen = [KeyRange(low, high)]
        bounds = ranges.number_bounds(chosen, 3)
        inside = {n for n in range(1000) if str(n).zfill(3).encode() in chosen[0]}
        if bounds is not None:
            assert {n for n in range(1000) if any(a <= n and (b is None or n < b) for a, b in bounds)} == inside
    assert ranges.number_bounds([KeyRange(b"a", None)], 3) is None


def test_the_key_range_query_pushes_its_ranges_down(spark, sf):
    from millrace import queries

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = queries.queries()["kv_range_scan"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert "GreaterThanOrEqual(o_orderkey,100)" in pushed and "LessThan(o_orderkey,200)" in pushed


def test_stored_cells_are_pruned_by_key(spark, tmp_path):
    from millrace.operators import cells
    from millrace.sources import kv

    families = {"f": {"v": "bigint"}}
    df = spark.range(5000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("k"), F.col("id").alias("v"))
    kv.store(cells.to_cells(df, F.col("k"), families, {("f", "v"): "v"}), str(tmp_path / "cells"), 5)
    found = kv.scan(spark, str(tmp_path / "cells"), families, ranges.parse("[000010,000013);[004000,004001]"))
    assert sorted((r["row_key"], r["f"]["v"]) for r in found.collect()) == [("000010", 10), ("000011", 11), ("000012", 12), ("004000", 4000), ("004001", 4001)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert "GreaterThanOrEqual(row_key" in pushed and "LessThan(row_key" in pushed


def test_greedy_batches_with_nulls_and_wide_numbers(spark):
    rows = [(None, i, 4) for i in range(5)] + [("g", i, s) for i, s in enumerate([5, None, 3, 20, 1, None, 8, 0])]
    rows = [(g, i, s, 9007199254740993) for g, i, s in rows]
    df = spark.createDataFrame(rows, "g string, i int, size long, big long").repartition(3)
    out = staging.greedy_batches(df, ["g"], "i", {"size": 8}).collect()
    assert {r["big"] for r in out} == {9007199254740993}
    batches = {(r["g"], r["i"]): r["batch"] for r in out}
    assert [batches[None, i] for i in range(5)] == [0, 0, 1, 1, 2]
    assert [batches["g", i] for i in range(8)] == [0, 0, 0, 1, 2, 2, 3, 3]
    assert {r["size"] for r in out if (r["g"], r["i"]) in (("g", 1), ("g", 5))} == {None}
    with pytest.raises(ValueError):
        staging.greedy_batches(df, [], "i", {"size": 8})


def test_greedy_batches_over_many_arrow_batches(spark):
    import random

    r = random.Random(4)
    sizes = [r.choice([1, 2, 30, 70, 150]) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(sizes)), "i int, size int").withColumn("g", F.lit(1)).withColumn("one", F.lit(1))
    want, total, count, batch = {}, 0, 0, 0
    for i, s in enumerate(sizes):
        if count and (total + s > 100 or count + 1 > 7):
            total, count, batch = 0, 0, batch + 1
        total, count = total + s, count + 1
        want[i] = batch
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = {x["i"]: x["batch"] for x in staging.greedy_batches(df, ["g"], "i", {"size": 100, "one": 7}).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want


def test_staging_rolls_by_size(spark, tmp_path):
    df = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("h")).coalesce(1)
    staging.staging_files(df, str(tmp_path / "s"), max_bytes=100_000)
    files = [f for f in (tmp_path / "s").iterdir() if f.suffix == ".parquet"]
    assert 4 <= len(files) <= 9 and spark.read.parquet(str(tmp_path / "s")).count() == 4000


def test_gaps_at_the_ends(spark):
    df = spark.createDataFrame([(1, 5, 10), (1, 12, None), (2, 0, 20)], "g int, start int, end int")
    found = ranges.gaps(df, ["g"], low=0, high=30)
    assert sorted(map(tuple, found.collect())) == [(1, 0, 5), (1, 10, 12), (2, 20, 30)]
    assert sorted(map(tuple, ranges.gaps(df, ["g"]).collect())) == [(1, 10, 12)]


def test_a_wrong_query_is_not_tried_again(spark, tmp_path, monkeypatch):
    results = positions.QueryResults(spark, str(tmp_path / "r"), timedelta(hours=1))
    tried = []
    sql = spark.sql
    monkeypatch.setattr(results, "spark", type("S", (), {"sql": lambda self, q: tried.append(q) or sql(q), "read": spark.read, "_jvm": spark._jvm, "_jsc": spark._jsc})())
    with pytest.raises(Exception, match="nowhere_at_all"):
        results.query("q", "SELECT no_such FROM nowhere_at_all")
    assert len(tried) == 1


def test_loads_run_once(spark, tmp_path):
    for i in range(5):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.parquet(str(tmp_path / f"f{i}"))
    files = spark.createDataFrame([("d" if i < 4 else "e", "parquet", str(tmp_path / f"f{i}"), 10, 10) for i in range(5)], "destination string, format string, uri string, bytes long, rows long")
    planned = staging.plan_loads(files, max_files=3)
    out = str(tmp_path / "tables")
    assert len(staging.run_loads(spark, planned, out, "1")) == 3
    assert staging.run_loads(spark, planned, out, "1") == []  # the same loads again
    assert sorted(r["id"] for r in staging.loaded(spark, out, "d").collect()) == list(range(40)) and staging.loaded(spark, out, "e").count() == 10
    with pytest.raises(FileNotFoundError):
        staging.loaded(spark, out, "x")
