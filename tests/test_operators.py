import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import cells, changelog, failures, ledger, lookup, routing, schemas

FAMILIES = {"a": {"x": "bigint", "y": "string"}, "b": {"z": "bigint"}}


def order_cells(spark):
    df = spark.createDataFrame([("r1", 1, "p", None, 10), ("r1", 2, None, None, 20), ("r2", None, None, 5, 10)], "k string, x long, y string, z long, t long")
    return cells.to_cells(df, F.col("k"), FAMILIES, {("a", "x"): "x", ("a", "y"): "y", ("b", "z"): "z"}, F.col("t"))


def test_rows_exist_where_read_families_do(spark):
    c = order_cells(spark)
    rows = {r["row_key"]: r for r in cells.read_rows(c, FAMILIES).collect()}
    assert rows["r1"]["a"]["x"] == 2 and rows["r1"]["a"]["y"] is None and rows["r1"]["b"] is None and rows["r2"]["a"] is None
    assert [r["row_key"] for r in cells.read_rows(c, {"b": FAMILIES["b"]}).collect()] == ["r2"]
    assert sorted(r["row_key"] for r in cells.read_rows(c, {}).collect()) == ["r1", "r2"]
    old = cells.read_rows(cells.as_of(c, 15), {"a": FAMILIES["a"]}).collect()
    assert [(r["row_key"], r["a"]["x"], r["a"]["y"]) for r in old] == [("r1", 1, "p")]


def test_empty_key_is_refused(spark):
    df = spark.createDataFrame([("", 1)], "k string, x long")
    with pytest.raises(Exception, match="non-empty key"):
        cells.to_cells(df, F.col("k"), {"a": {"x": "bigint"}}, {("a", "x"): "x"}).collect()


@pytest.mark.parametrize("both,kept", [(False, [30]), (True, [20, 30])])
def test_garbage_rules(spark, both, kept):
    c = spark.createDataFrame([(bytearray(b"r"), "f", "q", t, bytearray(b"v")) for t in (10, 20, 30)], "row_key binary, family string, qualifier string, ts_micros long, value binary")
    out = cells.collect_garbage(c, max_versions=1, min_ts_micros=15, both=both)
    assert sorted(r["ts_micros"] for r in out.collect()) == kept


KEYED = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])


def record(spark, mod_type, keys, new, old, capture="NEW_ROW_AND_OLD_VALUES"):
    return spark.createDataFrame([("t", None, 1, "1", mod_type, capture, [(keys, new, old)])], changelog.RECORD)


def test_expand_update_overlays_old_values(spark):
    r = record(spark, "UPDATE", '{"id":"1"}', '{"name":"Grace","n":"4"}', '{"name":"Ada"}')
    rows = changelog.expand(r, KEYED, ["id"]).orderBy("row_number").collect()
    assert [(x["_row_kind"], x["id"], x["name"], x["n"]) for x in rows] == [("-U", 1, "Ada", 4), ("+U", 1, "Grace", 4)]


def test_expand_explicit_null_and_absent(spark):
    rows = changelog.expand(record(spark, "INSERT", '{"id":1}', '{"name":null,"n":2}', None), KEYED, ["id"]).collect()
    assert rows[0]["name"] is None
    with pytest.raises(Exception, match="lacks name"):
        changelog.expand(record(spark, "INSERT", '{"id":1}', '{"n":2}', None), KEYED, ["id"]).collect()
    with pytest.raises(Exception, match="full changelog"):
        changelog.expand(record(spark, "INSERT", '{"id":1}', '{"name":"a","n":2}', None, "NEW_VALUES"), KEYED, ["id"]).collect()


def test_upsert_delete_has_key_alone(spark):
    rows = changelog.expand(record(spark, "DELETE", '{"id":3}', None, '{"name":"x","n":1}'), KEYED, ["id"], "upsert").collect()
    assert [(r["_row_kind"], r["id"], r["name"], r["n"]) for r in rows] == [("-D", 3, None, None)]


def test_update_before_is_refused(spark):
    df = spark.createDataFrame([("-U", 1, 1)], "_row_kind string, k int, o int")
    with pytest.raises(Exception, match="cannot take -U"):
        changelog.materialize(df, ["k"], ["o"]).collect()


def test_materialize_by_sequence(spark):
    df = spark.createDataFrame([("+I", 1, "a", "1/0", 1), ("+U", 1, "b", "A", 2), ("+U", 1, "c", "9/FF", 3), ("+I", 2, "x", "1", 4), ("-D", 2, None, "1", 5)], "_row_kind string, k int, v string, s string, i int")
    assert [(r["k"], r["v"]) for r in changelog.materialize_by_sequence(df, ["k"], "s", "i").collect()] == [(1, "b")]
    with pytest.raises(Exception, match="valid sequence"):
        changelog.materialize_by_sequence(df.withColumn("s", F.lit(None).cast("string")), ["k"], "s", "i").collect()


def entries(spark, *given):
    rows = [(i, k, f, q, v, b, c) for i, (k, f, q, v, b, c) in enumerate(given)]
    return spark.createDataFrame([("r", rows)], f"row_key string, entries {changelog.ENTRIES}")


@pytest.mark.parametrize(
    "given,change",
    [
        ([("DELETE_CELLS", "f", "q", None, False, False), ("SET_CELL", "f", "q", "v", False, False)], "UPSERT"),
        ([("DELETE_CELLS", "f", "q", None, False, False)], "DELETE"),
        ([("SET_CELL", "f", "other", "v", False, False)], "UNRELATED"),
        ([("SET_CELL", "f", "q", "v", False, False)], None),
        ([("DELETE_CELLS", "f", "q", None, True, False)], None),
        ([("DELETE_CELLS", "f", "q", None, False, False)] * 2, None),
        ([("DELETE_FAMILY", "f", None, None, False, False)], None),
        ([("ADD_TO_CELL", "f", None, "1", False, True)], None),
    ],
)
def test_selected_cell(spark, given, change):
    out = changelog.selected_cell(entries(spark, *given), "f", "q")
    if change is None:
        with pytest.raises(Exception, match="breaks the protocol"):
            out.collect()
    else:
        assert out.first()["change"] == change


def test_filter_entries(spark):
    m = entries(spark, ("SET_CELL", "f", "q", "v", False, False), ("SET_CELL", "g", "q", "v", False, False))
    assert changelog.filter_entries(m, families=["f"]).selectExpr("size(entries) AS n").first()["n"] == 1
    assert changelog.filter_entries(m, families=["h"]).count() == 0


def test_lookup_rules(spark):
    probe = spark.createDataFrame([(1,), (None,), (9,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert sorted(map(str, (tuple(r) for r in lookup.lookup(probe, dim, {"k": "id"}, ["id"]).collect()))) == ["(1, 'a')", "(9, None)", "(None, None)"]
    assert lookup.lookup(probe, dim, {"k": "id"}, ["id"], "inner", cache="full").count() == 1
    with pytest.raises(ValueError):
        lookup.lookup(probe, dim, {"k": "v"}, ["id"])
    asked = lookup.remote_lookup(probe, ["k"], lambda ks: [("x",) if k == (1,) else None for k in ks], T.StructType([T.StructField("v", T.StringType())]))
    assert sorted(str(r["v"]) for r in asked.collect()) == ["None", "None", "x"]


def test_routing_and_tasks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, d string")
    routed, lost = routing.route(df, F.col("d"))
    routing.write_routed(routed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1 and lost.first()["_reason"] == "no destination"
    with pytest.raises(Exception, match="i2 is null"):
        routing.add_fields(df, {"i2": F.lit(None).cast("int")}, "fail").collect()
    with pytest.raises(Exception, match="no HTTP URL"):
        df.select(routing.http_task(F.lit("ftp://x"), F.lit("b"))).collect()
    task = df.select(routing.http_task(F.lit("http://x/y"), F.lit("b"), "get").alias("t")).first()["t"]
    assert task["method"] == "GET" and task["body"] is None
    with pytest.raises(Exception, match="relative URI"):
        df.select(routing.app_engine_task(F.lit("y"), F.lit("b"))).collect()


def test_failure_policies(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    good = F.col("v") > 0
    with pytest.raises(Exception, match="bad row"):
        failures.handle(df, good, "fail", "bad row", F.col("v"), "c", "d").collect()
    assert failures.handle(df, good, "drop", "bad row", F.col("v"), "c", "d").count() == 1
    folder = str(tmp_path / "dlq")
    assert failures.handle(df, good, "dead_letter", "bad row", F.col("v"), "c", "d", folder).count() == 1
    dead = spark.read.parquet(folder)
    assert dead.columns == failures.DEAD_LETTER and dead.count() == 2


def test_ledger(spark):
    p = spark.createDataFrame([("a", "FINISHED"), ("b", "RUNNING"), ("c", "CREATED"), ("d", "CREATED")], "token string, state string")
    e = spark.createDataFrame([("c", "a"), ("d", "a"), ("d", "b"), ("c", "forgotten")], "child string, parent string")
    assert [r["token"] for r in ledger.schedulable(p, e).collect()] == ["c"]
    none = spark.createDataFrame([("FINISHED", 5)], "state string, watermark_ms long")
    assert ledger.frontier(none).first()["frontier_ms"] is None
    parents = spark.createDataFrame([(0, None, 0, 5, "x", 7), (0, None, 5, None, "y", 3), (0, 9, 0, 4, "z", 1), (0, None, 0, 5, "x", 7)], "target_start int, target_end int, start int, end int, token string, watermark_ms long")
    assert [(r["tokens"], r["watermark_ms"]) for r in ledger.merged(parents).collect()] == [(["x", "y"], 3)]


def test_schema_union():
    a = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("s", T.StructType([T.StructField("x", T.LongType())]))])
    b = T.StructType([T.StructField("ID", T.LongType(), True), T.StructField("s", T.StructType([T.StructField("y", T.StringType(), False)])), T.StructField("new", T.StringType(), False)])
    u = schemas.union_schema(a, b)
    assert [f.name for f in u.fields] == ["id", "s", "new"] and u["id"].nullable and u["new"].nullable
    assert [f.name for f in u["s"].dataType.fields] == ["x", "y"]
    with pytest.raises(schemas.SchemaConflict):
        schemas.union_schema(a, T.StructType([T.StructField("id", T.StringType())]))
    with pytest.raises(schemas.SchemaConflict):
        schemas.union_schema(a, b, allow_new_fields=False)
    with pytest.raises(schemas.SchemaConflict):
        schemas.union_schema(a, b, allow_relaxation=False)
    with pytest.raises(schemas.SchemaConflict):
        schemas.check_names(T.StructType([T.StructField("a", T.LongType()), T.StructField("A", T.LongType())]))


def test_type_names():
    assert schemas.warehouse_type(T.DecimalType(38, 9)) == "NUMERIC" and schemas.warehouse_type(T.DecimalType(38, 10)) == "BIGNUMERIC"
    assert schemas.warehouse_type(T.MapType(T.StringType(), T.LongType())) == "ARRAY<STRUCT<key STRING, value INT64>>"
    with pytest.raises(ValueError):
        schemas.warehouse_type(T.ArrayType(T.ArrayType(T.LongType())))
    assert schemas.relational_type(T.ArrayType(T.LongType()), "postgres") == "bigint[]"
    with pytest.raises(ValueError):
        schemas.relational_type(T.IntegerType())
    assert "PRIMARY KEY (id) NOT ENFORCED" in schemas.ddl("t", T.StructType([T.StructField("id", T.LongType(), False)]), ["id"])


CHANGE = "_row_kind string, k int, v string, o int"


def test_a_late_change_never_wins(spark):
    import itertools

    batches = [[("+I", 1, "a", 1), ("+I", 2, "b", 2), ("+I", 4, "x", 3)], [("-D", 2, None, 9), ("+U", 1, "new", 8)], [("+U", 1, "old", 5), ("+I", 2, "again", 6), ("-D", 4, None, 2), ("+U", 3, "c", 1)], [("+U", None, "null key", 1)]]
    for order in itertools.permutations(range(4)):
        table = None
        for n in order:
            c = spark.createDataFrame(batches[n], CHANGE)
            table = changelog.merge(table if table is not None else changelog.stored(c.select("k", "v").limit(0), ["o"], c), c, ["k"], ["o"])
        assert sorted(map(str, map(tuple, changelog.visible(table).collect()))) == ["(1, 'new')", "(3, 'c')", "(4, 'x')", "(None, 'null key')"]
        if order[0] != 0:
            break
    # equal orders: the later batch
    c = spark.createDataFrame([("+U", 1, "later", 8)], CHANGE)
    assert ("later",) in [(r["v"],) for r in changelog.visible(changelog.merge(table, c, ["k"], ["o"])).collect()]


def test_remote_lookup_keeps_types_and_forgets(spark):
    asked = []
    big = 9007199254740993
    probe = spark.createDataFrame([(big, 1.5), (None, None), (5, 2.5), (5, None)], "k long, w double").coalesce(1)
    schema = T.StructType([T.StructField("v", T.LongType()), T.StructField("s", T.StringType())])

    def fetch(ks):
        assert all(type(k[0]) is int for k in ks)
        return [(k[0], "x") if k[0] != 5 else None for k in ks]

    rows = lookup.remote_lookup(probe, ["k"], fetch, schema).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, [(big, 1.5, big, "x"), (None, None, None, None), (5, 2.5, None, None), (5, None, None, None)]))
    # what was used last stays: key 0 is in every batch, the others pass by
    import tempfile

    log = tempfile.mkdtemp() + "/asked"
    keys = [k for i in range(1, 40) for k in (0, i)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").coalesce(1)

    def logged(ks):
        with open(log, "a") as f:
            f.write("".join(f"{k[0]}\n" for k in ks))
        return [(k[0], "y") for k in ks]

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert lookup.remote_lookup(df, ["k"], logged, schema, cache_rows=3).filter("v = k").count() == len(keys)
        first = [int(x) for x in open(log)]
        assert first.count(0) == 1 and len(first) == 40
        lookup.remote_lookup(df, ["k"], logged, schema, ttl_seconds=0.0).count()
        assert [int(x) for x in open(log)][40:].count(0) > 30
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    del asked


def test_reloading_table(spark):
    loads, now = [], [0.0]
    t = lookup.ReloadingTable(lambda: loads.append(1) or spark.range(len(loads)), 60, lambda: now[0])
    assert t.current().count() == 1
    now[0] = 59.0
    assert t.current().count() == 1
    now[0] = 61.0
    old = t.current
    assert old().count() == 2 and len(loads) == 2
    t.release()


def test_json_change_records(spark):
    text = '{"table_name":"t","commit_timestamp":"2024-01-02T03:04:05.123456789Z","record_sequence":"7","mod_type":"INSERT","value_capture_type":"NEW_ROW_AND_OLD_VALUES","mods":[{"keys":{"id":"1"},"new_values":{"name":"Ada","n":"4"},"old_values":{}}]}'
    r = changelog.decode_json_records(spark.createDataFrame([(text,)], "record string"))
    row = changelog.expand(r, KEYED, ["id"]).first()
    assert (row["_row_kind"], row["id"], row["name"], row["n"], row["commit_nanos"] % 10**9) == ("+I", 1, "Ada", 4, 123456789)
    with pytest.raises(Exception):
        changelog.decode_json_records(spark.createDataFrame([("{oops",)], "record string")).collect()


def test_envelope_keeps_every_entry(spark):
    m = entries(spark, ("SET_CELL", "f", "q", "v", False, False), ("DELETE_FAMILY", "f", None, None, False, False))
    rows = changelog.envelope(m).collect()
    assert [(r["_row_kind"], r["kind"]) for r in rows] == [("+I", "SET_CELL"), ("+I", "DELETE_FAMILY")]


def test_constraint_policies(spark):
    from millrace.sources import relational

    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    good, bad = relational.checked(df, {"positive": F.col("v") > 0}, "route")
    assert good.count() == 2 and bad.first()["violates"] == ["positive"]
    with pytest.raises(Exception, match="constraint violated: positive"):
        relational.checked(df, {"positive": F.col("v") > 0})[0].collect()
    with pytest.raises(ValueError):
        relational.checked(df, {}, "ignore")


def test_entries_can_be_excluded(spark):
    m = entries(spark, ("SET_CELL", "f", "q", "v", False, False), ("SET_CELL", "g", "q", "v", False, False), ("DELETE_FAMILY", "f", None, None, False, False))
    left = lambda **o: [e["family"] for r in changelog.filter_entries(m, **o).collect() for e in r["entries"]]
    assert left(exclude_families=["f"]) == ["g"] and left(exclude_qualifiers=["f:q"]) == ["g", "f"] and left(exclude_families=["f|g"]) == []
    with pytest.raises(ValueError):
        left(families=["f"], exclude_families=["g"])


def test_tokens_of_http_tasks(spark):
    one = lambda **o: spark.range(1).select(routing.http_task(F.lit("https://h/p"), F.lit("b"), **o).alias("t")).first()["t"]["token"]
    assert one() is None and tuple(one(oidc=("a@x", None))) == ("OIDC", "a@x", "https://h/p") and one(oauth=("a@x", "s"))["target"] == "s"
    with pytest.raises(ValueError):
        one(oidc=("a", None), oauth=("a", None))


def test_skipped_rows_are_counted(spark):
    from pyspark.sql import Observation

    seen = Observation("skips")
    df = spark.createDataFrame([("a",), (None,), (None,)], "v string")
    assert routing.serialized(df, F.upper("v"), skipped=seen).count() == 1 and seen.get["skipped"] == 2


def test_many_rejections_in_a_row_stop(spark):
    df = spark.createDataFrame([("l", i, i % 4 != 0) for i in range(12)], "lane string, i int, failed boolean")
    assert failures.stop_after_consecutive(df, "lane", "i", most=4).count() == 12
    with pytest.raises(Exception, match="3 rejections in a row"):
        failures.stop_after_consecutive(df, "lane", "i", most=3).collect()
