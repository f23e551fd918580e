"""The registered queries and their SQL oracles: each applies one part of the library to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import codec, formats, retry, sequences
from .operators import cells, changelog, failures, ledger, lookup, routing, schemas
from .plans import keysets, positions, ranges, staging
from .sources import catalog, files, keyed, kv, relational, warehouse
from .streaming import bus, lineage

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its own name, with its oracle where SQL has one."""

    def register(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- wide-column tables: orders with a padded key and two families

FAMILIES = {"info": {"customer": "bigint", "status": "string"}, "amt": {"cents": "bigint"}}
_COLUMNS = {("info", "customer"): "customer", ("info", "status"): "status", ("amt", "cents"): "cents"}
KEY_RANGES = r"[0000000100,0000000200);[0000001000,0000001050];[0000014000,)"


def _orders(spark: SparkSession, sf_dir: str, wanted: Column | None = None) -> DataFrame:
    """Orders as rows to write; large ones alone have a family of amounts."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    orders = _table(spark, sf_dir, "orders")
    return (orders.filter(wanted) if wanted is not None else orders).select(
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("k"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_totalprice") > 250000, cents).alias("cents"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("written"),
    )


def _order_cells(orders: DataFrame) -> DataFrame:
    return cells.to_cells(orders, F.col("k"), FAMILIES, _COLUMNS, F.col("written"))


_ORDERS_SQL = """(SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS row_key, o_custkey AS customer, o_orderstatus AS status,
  CASE WHEN o_totalprice > 250000 THEN round(o_totalprice * 100)::BIGINT END AS cents, epoch_us(o_orderdate) AS written FROM orders)"""


def kv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = ranges.parse(KEY_RANGES)
    # what the ranges say of the number reaches the scan; the padded key decides
    orders = _orders(spark, sf_dir, ranges.number_predicate(F.col("o_orderkey"), chosen, 10))
    in_range = orders.filter(ranges.predicate(F.col("k"), chosen, as_text=True))
    rows = cells.read_rows(_order_cells(in_range), FAMILIES)
    return rows.select("row_key", "info.customer", "info.status", F.col("amt.cents").cast("string").alias("cents"))


@query(f"SELECT row_key, customer, status, cents::VARCHAR AS cents FROM {_ORDERS_SQL} WHERE (row_key >= '0000000100' AND row_key < '0000000200' OR row_key BETWEEN '0000001000' AND '0000001050' OR row_key >= '0000014000') AND status = 'F'")
def kv_range_scan(spark, sf_dir):
    return kv_orders(spark, sf_dir).filter("status = 'F'")


@query(f"SELECT row_key, cents FROM {_ORDERS_SQL} WHERE cents IS NOT NULL")
def kv_family_projection(spark, sf_dir):
    rows = cells.read_rows(_order_cells(_orders(spark, sf_dir)), {"amt": FAMILIES["amt"]})
    return rows.select("row_key", "amt.cents")


@query(f"SELECT row_key FROM {_ORDERS_SQL}")
def kv_keys_only(spark, sf_dir):
    return cells.read_rows(_order_cells(_orders(spark, sf_dir)), {})


@query(f"SELECT row_key, customer, status FROM {_ORDERS_SQL} WHERE status = 'O'")
def kv_existence_prefilter(spark, sf_dir):
    found = cells.with_cell_value(_order_cells(_orders(spark, sf_dir)), "info", "status", F.encode(F.lit("O"), "UTF-8"))
    rows = cells.read_rows(found, {"info": FAMILIES["info"]})
    return rows.select("row_key", "info.customer", "info.status").filter("status = 'O'")


def _event_cells(spark, sf_dir) -> DataFrame:
    """Events as versions of one cell per user and type."""
    e = _table(spark, sf_dir, "events")
    return e.select(
        F.encode(F.lpad(F.col("user_id").cast("string"), 8, "0"), "UTF-8").alias("row_key"),
        F.lit("e").alias("family"),
        F.col("event_type").alias("qualifier"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_micros"),
        codec.encode_cell(F.col("event_id"), "bigint").alias("value"),
    )


_EVENT_CELLS_SQL = "(SELECT lpad(user_id::VARCHAR, 8, '0') AS row_key, event_type AS qualifier, epoch_us(ts) AS ts_micros, event_id FROM events)"


@query(f"""SELECT row_key, qualifier, ts_micros, event_id FROM (SELECT *, row_number() OVER (PARTITION BY row_key, qualifier ORDER BY ts_micros DESC, event_id DESC) AS v FROM {_EVENT_CELLS_SQL})
WHERE v <= 3 AND ts_micros >= 1704844800000000""")
def gc_versions_age(spark, sf_dir):
    kept = cells.collect_garbage(_event_cells(spark, sf_dir), max_versions=3, min_ts_micros=1704844800000000)
    return kept.select(F.decode("row_key", "UTF-8").alias("row_key"), "qualifier", "ts_micros", codec.decode_cell(F.col("value"), "bigint").alias("event_id"))


@query(f"""SELECT row_key, qualifier, ts_micros, event_id FROM (SELECT *, row_number() OVER (PARTITION BY row_key, qualifier ORDER BY ts_micros DESC, event_id DESC) AS v FROM {_EVENT_CELLS_SQL} WHERE ts_micros <= 1705276800000000) WHERE v = 1""")
def kv_as_of(spark, sf_dir):
    found = cells.as_of(_event_cells(spark, sf_dir), 1705276800000000)
    return found.select(F.decode("row_key", "UTF-8").alias("row_key"), "qualifier", "ts_micros", codec.decode_cell(F.col("value"), "bigint").alias("event_id"))


@query("""WITH e AS (SELECT user_id, event_type, epoch_us(ts) AS t, event_id FROM events), d AS (SELECT user_id, max(t) AS gone FROM e WHERE event_type = 'error' GROUP BY 1)
SELECT user_id, event_type, event_id FROM (SELECT e.*, row_number() OVER (PARTITION BY e.user_id, event_type ORDER BY t DESC, event_id DESC) AS v FROM e LEFT JOIN d USING (user_id) WHERE event_type <> 'error' AND (gone IS NULL OR t > gone)) WHERE v = 1""")
def kv_mutations(spark, sf_dir):
    """Half of the events are stored cells, the others and all errors change them."""
    events = _event_cells(spark, sf_dir).withColumn("kind", F.when(F.col("qualifier") == "error", "-D").otherwise("+I"))
    is_stored = (F.pmod(codec.decode_cell(F.col("value"), "bigint"), F.lit(2)) == 0) & (F.col("kind") == "+I")
    path = files.scratch(spark, "cells")
    kv.store(events.filter(is_stored), path)
    left = cells.apply_mutations(spark.read.parquet(path), events.filter(~is_stored))
    return left.select(F.decode("row_key", "UTF-8").cast("bigint").alias("user_id"), F.col("qualifier").alias("event_type"), codec.decode_cell(F.col("value"), "bigint").alias("event_id"))


@query("SELECT event_id, (epoch_us(ts) - epoch_us(ts) % 1000) AS cell_micros FROM events")
def cell_timestamps(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", cells.cell_micros(F.col("ts"), truncate_to_millis=True).alias("cell_micros"))


# -- relational and warehouse scans


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem WHERE l_orderkey = 42")
def keyset_point(spark, sf_dir):
    return relational.scan(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"], [keysets.Condition("l_orderkey", "=", 42)])


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey >= 100 AND l_orderkey < 2000 AND l_linenumber >= 3 AND l_returnflag = 'A'")
def keyset_prefix_range(spark, sf_dir):
    c = keysets.Condition
    wanted = [c("l_orderkey", ">=", 100), c("l_orderkey", "<", 2000), c("l_linenumber", ">=", 3), c("l_returnflag", "=", "A")]
    return relational.scan(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber", "l_partkey"], wanted)


@query("SELECT l_orderkey FROM lineitem WHERE l_orderkey = 1 AND l_orderkey = 2")
def keyset_contradiction(spark, sf_dir):
    c = keysets.Condition
    return relational.scan(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey"], ["l_orderkey"], [c("l_orderkey", "=", 1), c("l_orderkey", "=", 2)])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice >= 450000 AND o_orderstatus = 'O'")
def index_scan_residual(spark, sf_dir):
    index = relational.Index(f"{sf_dir}/orders.parquet", ["o_totalprice"], ["o_totalprice", "o_orderkey", "o_custkey", "o_orderstatus"])
    c = keysets.Condition
    return relational.index_scan(spark, index, ["o_orderkey", "o_custkey"], [c("o_totalprice", ">=", 450000.0), c("o_orderstatus", "=", "O")])


@query("SELECT count(*) AS n FROM lineitem")
def column_prune_count(spark, sf_dir):
    return warehouse.scan(spark, f"{sf_dir}/lineitem.parquet", []).agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_brand FROM part WHERE p_size > 40 AND p_type = 'ECONOMY'")
def row_restriction(spark, sf_dir):
    return warehouse.scan(spark, f"{sf_dir}/part.parquet", ["p_partkey", "p_brand"], "p_size > 40 AND p_type = 'ECONOMY'")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS v FROM events WHERE ts <= TIMESTAMP '2024-01-15') WHERE v = 1 AND event_type <> 'error'""")
def snapshot_read(spark, sf_dir):
    versions = _table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    at = F.lit("2024-01-15").cast("timestamp")
    return warehouse.snapshot(versions, ["user_id"], "ts", at, F.col("event_type") == "error").select("user_id", "event_id", "event_type")


# -- lookups


@query("SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'MACHINERY'")
def lookup_join_inner(spark, sf_dir):
    probe = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    dim = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return lookup.lookup(probe, dim, {"o_custkey": "c_custkey"}, ["c_custkey"], "inner", F.col("c_mktsegment") == "MACHINERY")


@query("SELECT o_orderkey, k::VARCHAR AS k, c_name FROM (SELECT o_orderkey, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS k FROM orders) LEFT JOIN customer ON k = c_custkey")
def lookup_join_left(spark, sf_dir):
    probe = _table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("k"))
    return lookup.lookup(probe, _table(spark, sf_dir, "customer").select("c_custkey", "c_name"), {"k": "c_custkey"}, ["c_custkey"]).withColumn("k", F.col("k").cast("string"))


@query("""WITH v AS (SELECT user_id, epoch_us(ts) AS since, max(event_id) AS version FROM events WHERE event_type <> 'view' GROUP BY ALL),
p AS (SELECT event_id, user_id AS who, epoch_us(ts) AS at FROM events WHERE event_type = 'view')
SELECT p.event_id, p.who, v.version FROM p ASOF LEFT JOIN v ON p.who = v.user_id AND p.at >= v.since""")
def lookup_as_of(spark, sf_dir):
    """Views with the last other event of their user until then."""
    e = _versions(spark, sf_dir)
    versions = e.filter("event_type <> 'view'").groupBy("user_id", F.col("t").alias("since")).agg(F.max("event_id").alias("version"))
    probe = e.filter("event_type = 'view'").select("event_id", F.col("user_id").alias("who"), F.col("t").alias("at"))
    return lookup.lookup_as_of(probe, versions, {"who": "user_id"}, "at", "since").select("event_id", "who", "version")


# -- changelogs: events as changes of users' state, an error deletes it


def _versions(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))


_VERSIONS_SQL = """SELECT user_id, event_id, event_type, epoch_us(ts) AS t,
  event_type = 'error' AS gone, lag(event_type) OVER w AS before_type, lag(event_id) OVER w AS before_id, coalesce(NOT (lag(event_type) OVER w = 'error'), FALSE) AS had
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""

_FULL_SQL = f"""WITH v AS ({_VERSIONS_SQL})
SELECT '+I' AS kind, user_id, t, event_id AS id, event_type AS type FROM v WHERE NOT gone AND NOT had
UNION ALL SELECT '-U', user_id, t, before_id, before_type FROM v WHERE NOT gone AND had
UNION ALL SELECT '+U', user_id, t, event_id, event_type FROM v WHERE NOT gone AND had
UNION ALL SELECT '-D', user_id, t, before_id, before_type FROM v WHERE gone AND had"""


@query(_FULL_SQL)
def changelog_full(spark, sf_dir):
    v = _versions(spark, sf_dir).select("user_id", "t", F.col("event_id").alias("n"), F.col("event_id").alias("id"), F.col("event_type").alias("type"))
    out = changelog.from_versions(v, ["user_id"], ["t", "n"], ["id", "type"], F.col("type") == "error", "full")
    return out.select(F.col(changelog.ROW_KIND).alias("kind"), "user_id", "t", "id", "type")


@query(f"""WITH v AS ({_VERSIONS_SQL})
SELECT CASE WHEN had THEN '+U' ELSE '+I' END AS kind, user_id, t, event_id::VARCHAR AS id, event_type AS type FROM v WHERE NOT gone
UNION ALL SELECT '-D', user_id, t, NULL, NULL FROM v WHERE gone AND had""")
def changelog_upsert(spark, sf_dir):
    v = _versions(spark, sf_dir).select("user_id", "t", F.col("event_id").alias("n"), F.col("event_id").alias("id"), F.col("event_type").alias("type"))
    out = changelog.from_versions(v, ["user_id"], ["t", "n"], ["id", "type"], F.col("type") == "error", "upsert")
    return out.select(F.col(changelog.ROW_KIND).alias("kind"), "user_id", "t", F.col("id").cast("string").alias("id"), "type")


def _records(spark, sf_dir) -> DataFrame:
    """Events as change records of a table of users, one mod each."""
    e = _table(spark, sf_dir, "events")
    mod = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    keys = F.to_json(F.struct(F.col("user_id").alias("id")))
    new = F.to_json(F.struct(F.col("event_type").alias("state"), F.col("event_id").alias("seen")))
    old = F.to_json(F.struct(F.lit("past").alias("state")))
    whole = F.to_json(F.struct(F.lit("past").alias("state"), F.lit(-1).alias("seen")))
    return e.select(
        F.lit("users").alias("table"),
        F.col("ts").cast("timestamp").alias("commit_ts"),
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("commit_nanos"),
        F.lpad(F.col("event_id").cast("string"), 8, "0").alias("record_sequence"),
        mod.alias("mod_type"),
        F.lit("NEW_ROW_AND_OLD_VALUES").alias("capture_type"),
        F.array(F.struct(keys.alias("keys"), F.when(mod != "DELETE", new).alias("new_values"), F.when(mod == "DELETE", whole).when(mod == "UPDATE", old).alias("old_values"))).alias("mods"),
    )


_USERS = T.StructType([T.StructField("id", T.LongType()), T.StructField("state", T.StringType()), T.StructField("seen", T.LongType())])


@query("""WITH e AS (SELECT user_id, event_id, event_type FROM events)
SELECT '+I' AS kind, user_id AS id, event_type AS state, event_id AS seen, lpad(event_id::VARCHAR, 8, '0') AS record_sequence FROM e WHERE event_type = 'signup'
UNION ALL SELECT '-U', user_id, 'past', event_id, lpad(event_id::VARCHAR, 8, '0') FROM e WHERE event_type NOT IN ('signup', 'error')
UNION ALL SELECT '+U', user_id, event_type, event_id, lpad(event_id::VARCHAR, 8, '0') FROM e WHERE event_type NOT IN ('signup', 'error')
UNION ALL SELECT '-D', user_id, 'past', -1, lpad(event_id::VARCHAR, 8, '0') FROM e WHERE event_type = 'error'""")
def change_records_full(spark, sf_dir):
    out = changelog.expand(_records(spark, sf_dir), _USERS, ["id"], "full")
    return out.select(F.col(changelog.ROW_KIND).alias("kind"), "id", "state", "seen", "record_sequence")


@query("""SELECT CASE event_type WHEN 'signup' THEN '+I' WHEN 'error' THEN '-D' ELSE '+U' END AS kind, user_id AS id,
CASE WHEN event_type <> 'error' THEN event_type END AS state, CASE WHEN event_type <> 'error' THEN event_id::VARCHAR END AS seen, lpad(event_id::VARCHAR, 8, '0') AS record_sequence FROM events""")
def change_records_upsert(spark, sf_dir):
    out = changelog.expand(_records(spark, sf_dir), _USERS, ["id"], "upsert")
    return out.select(F.col(changelog.ROW_KIND).alias("kind"), "id", "state", F.col("seen").cast("string").alias("seen"), "record_sequence")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS v FROM events) WHERE v = 1 AND event_type <> 'error'""")
def upsert_materialize(spark, sf_dir):
    changes = _versions(spark, sf_dir).withColumn(changelog.ROW_KIND, F.when(F.col("event_type") == "error", "-D").otherwise("+U"))
    sequence = sequences.sections(F.col("t") * 1000, F.col("event_id"))
    out = changelog.materialize_by_sequence(changes.withColumn("sequence", sequence), ["user_id"], "sequence", "event_id")
    return out.select("user_id", "event_id", "event_type")


_MERGED_SQL = """WITH c AS (SELECT event_id % 3000 AS k, event_id, event_type, row_number() OVER (PARTITION BY event_id % 3000 ORDER BY ts DESC, event_id DESC) AS v FROM events),
l AS (SELECT * FROM c WHERE v = 1)
SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT k FROM l)
UNION ALL SELECT k, event_type FROM l WHERE event_type <> 'error'"""


def _segment_changes(spark, sf_dir) -> DataFrame:
    """Events as changes of customers' segments."""
    return _versions(spark, sf_dir).select(
        (F.col("event_id") % 3000).alias("c_custkey"),
        F.col("event_type").alias("c_mktsegment"),
        "t",
        "event_id",
        F.when(F.col("event_type") == "error", "-D").otherwise("+U").alias(changelog.ROW_KIND),
    )


@query(_MERGED_SQL)
def merge_upsert(spark, sf_dir):
    target = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return relational.upsert(target, _segment_changes(spark, sf_dir), ["c_custkey"], ["t", "event_id"])


@query(_MERGED_SQL)
def merge_upsert_late(spark, sf_dir):
    """The same changes in batches of which the later ones hold older changes too: the result may not depend on it."""
    changes, order = _segment_changes(spark, sf_dir), ["t", "event_id"]
    table = changelog.stored(_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), order, changes)
    for part in (2, 0, 1):
        table = relational.upsert(table, changes.filter(F.pmod("event_id", F.lit(3)) == part), ["c_custkey"], order)
    return changelog.visible(table)


@query(_MERGED_SQL)
def options_merge_late(spark, sf_dir):
    """As ``merge_upsert_late``, through a table's options: plain rows, then three commits with a compaction between them."""
    o = {"path": files.scratch(spark, "followed"), "key": "c_custkey", "order": "t,event_id"}
    catalog.insert(_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "relational", {"path": o["path"]})
    changes = _segment_changes(spark, sf_dir)
    for part in (2, 0, 1):
        catalog.insert(changes.filter(F.pmod("event_id", F.lit(3)) == part), "relational", o)
        if part == 0:
            keyed.compact(spark, f"{o['path']}/{relational.FOLLOWED}", pending_share=0.0)
    return catalog.table(spark, "relational", {"path": o["path"]})


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 6 = 0 THEN 'X' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 12 <> 3""")
def options_follow(spark, sf_dir):
    """Plain rows, changes, plain rows: a table that begins to follow a changelog loses none; late rows lose against newer changes."""
    o = {"path": files.scratch(spark, "followed"), "key": "k", "order": "o"}
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    part = lambda n, m: F.col("k") % m == n
    catalog.insert(orders.filter(part(0, 3)).withColumn("o", F.lit(1)), "relational", {"path": o["path"]})
    new = orders.filter(part(1, 3)).select(F.lit("+I").alias(changelog.ROW_KIND), "*", F.lit(2).alias("o"))
    updated = orders.filter(part(0, 6)).select(F.lit("+U").alias(changelog.ROW_KIND), "k", F.lit("X").alias("v"), F.lit(3).alias("o"))
    deleted = orders.filter(part(3, 12)).select(F.lit("-D").alias(changelog.ROW_KIND), "k", F.lit(None).cast("string").alias("v"), F.lit(3).alias("o"))
    catalog.insert(new.unionByName(updated).unionByName(deleted), "relational", o)
    catalog.insert(orders.filter(part(2, 3)).withColumn("o", F.lit(4)), "relational", o)
    catalog.insert(orders.filter(part(6, 12) | part(3, 12)).select("k", F.lit("late").alias("v"), F.lit(2).alias("o")), "relational", o)
    return catalog.table(spark, "relational", {"path": o["path"], "columns": "k,v"})


@query("""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN user_id WHEN event_id % 7 = 1 THEN NULL END AS user, event_id % 7 > 1 AS failed FROM events""")
def bus_bad_payloads(spark, sf_dir):
    """Payloads that are a record, an empty record, null, nothing, ill-formed UTF-8, the literal null, and no JSON."""
    n = F.pmod("event_id", F.lit(7))
    good = F.to_json(F.struct(F.col("user_id").alias("user")))
    payload = F.when(n == 0, good).when(n == 1, "{}").when(n == 3, "").when(n == 5, "null").when(n == 6, "{oops").cast("binary")
    broken = F.concat(F.unhex(F.lit("FF")), good.cast("binary"))
    messages = _table(spark, sf_dir, "events").select("event_id", F.when(n == 4, broken).otherwise(payload).alias("payload"))
    return bus.decode_json(messages, "user bigint", "nack").select("event_id", "user", F.col("_failed").alias("failed"))


@query("""WITH e AS (SELECT event_id, user_id % 4 AS part, epoch_us(ts) // 1000 AS ms FROM events), t AS (SELECT (min(ms) + max(ms)) // 2 AS half FROM e)
SELECT event_id, 'p' || part AS token, ms FROM e, t WHERE ms < half""")
def change_stream_frontier(spark, sf_dir):
    """Events as the records of four partitions, of which three have ended and one is half read: what the frontier has passed."""
    e = _table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("p"), (F.col("user_id") % 4).cast("string")).alias("token"), F.unix_millis(F.col("ts").cast("timestamp")).alias("watermark_ms"))
    ends = e.agg(F.min("watermark_ms").alias("low"), F.expr("(min(watermark_ms) + max(watermark_ms)) div 2").alias("half"))
    part = lambda p: F.concat(F.lit("p"), F.lit(p))
    said = [F.struct(F.lit("CREATED").alias("kind"), part(p).alias("token"), F.col("low").alias("watermark_ms")) for p in "0123"]
    said += [F.struct(F.lit("FINISHED").alias("kind"), part(p).alias("token"), F.lit(None).cast("bigint").alias("watermark_ms")) for p in "012"]
    said += [F.struct(F.lit("PROGRESS").alias("kind"), part("3").alias("token"), F.col("half").alias("watermark_ms"))]
    control = ends.select(F.inline(F.array(*said)))
    events = e.withColumn("kind", F.lit("RECORD")).unionByName(control, allowMissingColumns=True).withColumn("stream", F.lit("s"))
    schema = T.StructType.fromDDL(lineage.EVENT)
    rows = events.select(*[F.col(f.name) if f.name in events.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], "event_id")
    folder = files.scratch(spark, "change-stream")
    rows.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    released = lineage.records(lineage.gated(stream, slots=4)).select("event_id", "token", F.col("watermark_ms").alias("ms"))
    with lineage.state_store(spark):
        released.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(released.schema).parquet(f"{folder}/out")


@query("""SELECT event_id, CASE WHEN event_type = 'view' THEN 'UNRELATED' WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END AS change,
CASE WHEN event_type NOT IN ('view', 'error') THEN props END AS cell_value FROM events""")
def selected_cell_fold(spark, sf_dir):
    def entry(i, kind, family, value=None):
        return F.struct(
            F.lit(i).alias("entry_index"),
            F.lit(kind).alias("kind"),
            F.lit(family).alias("family"),
            F.lit("q").alias("qualifier"),
            (value if value is not None else F.lit(None).cast("string")).alias("value"),
            F.lit(False).alias("bounded"),
            F.lit(False).alias("computed"),
        )

    other, delete, put = entry(0, "SET_CELL", "other", F.col("props")), entry(1, "DELETE_CELLS", "cf"), entry(2, "SET_CELL", "cf", F.col("props"))
    entries = F.when(F.col("event_type") == "view", F.array(other)).when(F.col("event_type") == "error", F.array(other, delete)).otherwise(F.array(put, other, delete))
    mutations = _table(spark, sf_dir, "events").select("event_id", "props", "event_type").withColumn("entries", entries.cast(changelog.ENTRIES))
    return changelog.selected_cell(mutations, "cf", "q").select("event_id", "change", "cell_value")


@query("""SELECT event_id, CASE WHEN event_type = 'click' THEN 'id,value' ELSE 'id' END AS names FROM events WHERE event_type IN ('click', 'view', 'purchase') AND event_type = 'click'""")
def cdc_filter_columns(spark, sf_dir):
    values = F.create_map(F.lit("id"), F.col("user_id").cast("string"), F.lit("value"), F.col("value").cast("string"), F.lit("props"), F.col("props"))
    records = _table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("table"), values.alias("new"))
    kept = changelog.filter_tables(records, include=["click", "vi.*", "purchase"])
    out = changelog.filter_columns(kept, ["new"], include=[r"click\.value"], keys=["id"], skip_unchanged=True)
    return out.select("event_id", F.array_join(F.array_sort(F.map_keys("new")), ",").alias("names"))


# -- sequence numbers


@query("SELECT event_id, printf('%016X/%016X/%016X', epoch_us(ts) * 1000, event_id, user_id) AS sequence FROM events")
def cdc_seq_commit(spark, sf_dir):
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return _table(spark, sf_dir, "events").select("event_id", sequences.from_commit(nanos, F.lpad(F.col("event_id").cast("string"), 8, "0"), F.col("user_id")).alias("sequence"))


@query("""SELECT event_id, CASE WHEN event_type = 'signup' THEN printf('%016X/%016X/%016X/%016X', 0, 0, 0, 0)
ELSE printf('%016X/%016X/%016X/%016X', CASE WHEN user_id % 2 = 0 THEN 1 ELSE 2 END, event_id, user_id, 0) END AS sequence FROM events""")
def cdc_seq_mysql(spark, sf_dir):
    uuids = ["11111111-1111-1111-1111-111111111111", "22222222-2222-2222-2222-222222222222"]
    gtid = F.concat(F.when(F.col("user_id") % 2 == 0, uuids[0]).otherwise(uuids[1].upper()), F.lit(":"), F.col("event_id").cast("string"))
    snap = F.when(F.col("event_type") == "signup", "true").otherwise("false")
    return _table(spark, sf_dir, "events").select("event_id", sequences.from_mysql(snap, gtid, F.col("user_id").cast("string"), F.lit("0"), uuids).alias("sequence"))


@query("SELECT event_id, printf('%016X/%016X', CASE WHEN event_id % 5 = 0 THEN 0 ELSE event_id END, event_id + 7) AS sequence FROM events")
def cdc_seq_postgres(spark, sf_dir):
    lsn = F.col("event_id") + 7
    pair = F.concat(F.lit("["), F.when(F.col("event_id") % 5 == 0, "null").otherwise(F.concat(F.lit('"'), F.col("event_id").cast("string"), F.lit('"'))), F.lit(',"'), lsn.cast("string"), F.lit('"]'))
    return _table(spark, sf_dir, "events").select("event_id", sequences.from_postgres(pair, lsn).alias("sequence"))


@query("SELECT event_id, printf('%016X', event_id + 1) AS sequence FROM events")
def cdc_seq_ticdc(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", sequences.from_ticdc(F.col("event_id") + 1, F.lit("main"), "main").alias("sequence"))


@query("""SELECT event_id, CASE WHEN event_type = 'click' THEN printf('%016X', event_id + 1) ELSE printf('%016X/%016X/%016X', epoch_us(ts) * 1000, event_id, 0) END AS sequence FROM events""")
def cdc_seq_dispatch(spark, sf_dir):
    s = lambda c: c.cast("string")
    ti = F.create_map(F.lit("connector"), F.lit("TiCDC"), F.lit("commit_ts"), s(F.col("event_id") + 1), F.lit("cluster_id"), F.lit("main"))
    sp = F.create_map(F.lit("connector"), F.lit("spanner"), F.lit("ts_ns"), s(F.unix_micros(F.col("ts").cast("timestamp")) * 1000), F.lit("sequence"), s(F.col("event_id")), F.lit("mod_number"), F.lit("0"))
    source = F.when(F.col("event_type") == "click", ti).otherwise(sp)
    return _table(spark, sf_dir, "events").select("event_id", sequences.from_source(source, ticdc_cluster="main").alias("sequence"))


# -- codecs and formats


@query("""SELECT o_orderkey, printf('%016X', o_custkey - 500) AS big, printf('%08X', o_custkey::INTEGER) AS whole, hex(encode(o_orderpriority)) AS txt, CASE WHEN o_orderstatus = 'F' THEN 'FF' ELSE '00' END AS flag,
printf('%08X', date_diff('day', DATE '1970-01-01', o_orderdate::DATE)) AS day, printf('%016X', epoch_ms(o_orderdate)) AS instant FROM orders""")
def cell_codec_encode(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    e = lambda c, t: F.hex(codec.encode_cell(c, t))
    return o.select(
        "o_orderkey",
        e(F.col("o_custkey") - 500, "bigint").alias("big"),
        e(F.col("o_custkey").cast("int"), "int").alias("whole"),
        e(F.col("o_orderpriority"), "string").alias("txt"),
        e(F.col("o_orderstatus") == "F", "boolean").alias("flag"),
        e(F.col("o_orderdate").cast("date"), "date").alias("day"),
        e(F.col("o_orderdate"), "timestamp").alias("instant"),
    )


@query("""SELECT o_orderkey, o_custkey - 500 AS big, (o_custkey - 500)::SMALLINT AS small, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS txt, o_orderstatus = 'F' AS flag, o_totalprice AS dbl,
round(o_totalprice * 100)::BIGINT AS cents FROM orders""")
def cell_codec_round_trip(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")

    def both(c, t):
        return codec.decode_cell(codec.encode_cell(c, t), t)

    return o.select(
        "o_orderkey",
        both(F.col("o_custkey") - 500, "bigint").alias("big"),
        both((F.col("o_custkey") - 500).cast("smallint"), "smallint").alias("small"),
        both(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), "string").alias("txt"),
        both(F.col("o_orderstatus") == "F", "boolean").alias("flag"),
        both(F.col("o_totalprice"), "double").alias("dbl"),
        (both(F.col("o_totalprice").cast("decimal(12,2)"), "decimal(12,2)") * 100).cast("bigint").alias("cents"),
    )


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN '7FF8000000000000' WHEN 1 THEN '7FF0000000000000' WHEN 2 THEN 'FFF0000000000000' WHEN 3 THEN '' ELSE 'a number' END AS dbl,
CASE event_id % 5 WHEN 0 THEN 'NaN' WHEN 1 THEN 'Infinity' WHEN 2 THEN '-Infinity' WHEN 3 THEN 'null' ELSE CASE WHEN value < 0 THEN 'negative' ELSE 'right' END END AS back,
printf('%016X', epoch_us(ts) // 1000) AS local, (epoch_us(ts) // 1000) AS local_ms, ((event_id - 5000)::HUGEINT * 1234567890123456)::VARCHAR AS wide FROM events""")
def cell_codec_special(spark, sf_dir):
    """What a cell must keep apart: NaN, infinities and null; times without zone; decimals beyond 64 bits."""
    e = _table(spark, sf_dir, "events")
    n = F.col("event_id") % 5
    v = F.when(n == 0, float("nan")).when(n == 1, float("inf")).when(n == 2, float("-inf")).when(n != 3, F.col("value"))
    cell = codec.encode_cell(v, "double")
    back = codec.decode_cell(cell, "double")
    local = codec.encode_cell(F.col("ts").cast("timestamp_ntz"), "timestamp_ntz")
    wide = (F.col("event_id") - 5000).cast("decimal(10,0)") * F.lit(1234567890123456).cast("decimal(16,0)")
    again = codec.decode_cell(codec.encode_cell(wide.cast("decimal(28,0)"), "decimal(28,0)"), "decimal(28,0)")
    ms = codec.decode_cell(local, "timestamp_ntz")
    return e.select(
        "event_id",
        F.when(n == 4, "a number").otherwise(F.hex(cell)).alias("dbl"),
        F.when(n == 4, F.when(back.eqNullSafe(F.col("value")), F.when(back < 0, "negative").otherwise("right")).otherwise("wrong")).otherwise(F.coalesce(back.cast("string"), F.lit("null"))).alias("back"),
        F.hex(local).alias("local"),
        F.unix_millis(ms.cast("timestamp")).alias("local_ms"),
        again.cast("string").alias("wide"),
    )


@query("""SELECT event_id, '{"id":' || event_id || ',"at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '","day":"' || strftime(ts, '%Y-%m-%d') || '"}' AS body FROM events""")
def json_instants(spark, sf_dir):
    at = F.col("ts").cast("timestamp")
    return _table(spark, sf_dir, "events").select("event_id", formats.json_body(F.col("event_id").alias("id"), at.alias("at"), at.cast("date").alias("day")).alias("body"))


@query("SELECT event_id, (event_id % 120)::TINYINT AS tiny, (epoch_us(ts) // 1000) AS millis, (epoch_us(ts) // 1000000) * 1000000000 AS whole_seconds FROM events")
def narrow_and_truncate(spark, sf_dir):
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + 999
    return _table(spark, sf_dir, "events").select(
        "event_id",
        formats.narrowed(F.col("event_id") % 120, "tinyint").alias("tiny"),
        F.unix_millis(formats.timestamp_from_nanos(nanos, 3)).alias("millis"),
        formats.truncated_time(nanos, 0).alias("whole_seconds"),
    )


@query("SELECT p_partkey, to_json({'id': p_partkey, 'name': p_name, 'size': p_size, 'tags': [p_brand, p_type]})::VARCHAR AS body FROM part")
def json_render(spark, sf_dir):
    p = _table(spark, sf_dir, "part")
    return p.select("p_partkey", formats.json_body(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"), F.array("p_brand", "p_type").alias("tags")).alias("body"))


@query("""SELECT p_partkey, 'name=' || replace(url_encode(p_name), '%20', '+') || CASE WHEN p_size % 2 = 0 THEN '&kind=' || replace(url_encode(p_type), '%20', '+') ELSE '' END
|| '&tags=' || replace(url_encode(p_brand), '%20', '+') || '&tags=' || replace(url_encode('a b&c=' || p_size), '%20', '+') AS body FROM part""")
def form_encode(spark, sf_dir):
    p = _table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("kind"),
        F.array("p_brand", F.concat(F.lit("a b&c="), F.col("p_size").cast("string"))).alias("tags"),
    )
    return p.select("p_partkey", formats.form_body(p, ["name", "kind", "tags"]).alias("body"))


@query("SELECT p_partkey, 'brand:' || p_brand || ',type:' || p_type AS entries, p_brand AS brand FROM part")
def map_entries_roundtrip(spark, sf_dir):
    m = F.create_map(F.lit("type"), F.col("p_type"), F.lit("brand"), F.col("p_brand"))
    entries = formats.map_to_entries(m)
    return _table(spark, sf_dir, "part").select(
        "p_partkey",
        F.array_join(F.transform(entries, lambda e: F.concat_ws(":", e["key"], e["value"])), ",").alias("entries"),
        F.element_at(formats.entries_to_map(entries), "brand").alias("brand"),
    )


@query("SELECT event_id, lower(printf('%08X-0000-4000-8000-%012X', user_id, event_id)) AS uuid FROM events")
def uuid_parse(spark, sf_dir):
    raw = F.concat(F.lpad(F.hex("user_id"), 8, "0"), F.lit("-0000-4000-8000-"), F.lpad(F.hex("event_id"), 12, "0"))
    return _table(spark, sf_dir, "events").select("event_id", formats.parse_uuid(raw).alias("uuid"))


@query("""SELECT doc_id, CASE WHEN strlen(text) <= 1024 THEN text ELSE
  (SELECT max_by(substr(text, 1, n::BIGINT), n) FROM (SELECT unnest(range(240, 1011)) AS n) WHERE strlen(substr(text, 1, n::BIGINT)) <= 1010) || '...[truncated]' END AS text FROM documents""")
def error_text_truncation(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", formats.truncate_utf8(F.col("text")).alias("text"))


@query("SELECT n, least(100 * pow(2, n - 1), 5000)::BIGINT AS backoff_ms FROM (SELECT unnest(range(1, 21)) AS n)")
def retry_schedule(spark, sf_dir):
    return spark.range(1, 21).select(F.col("id").alias("n"), retry.base_backoff_ms(F.col("id"), 100, 5000).alias("backoff_ms"))


@query("""SELECT event_id, CASE event_type WHEN 'view' THEN 'TRANSIENT' WHEN 'click' THEN 'ROW_LEVEL' WHEN 'error' THEN 'TRANSIENT' ELSE 'TERMINAL' END AS class FROM events""")
def error_classes(spark, sf_dir):
    t = F.col("event_type")
    chain = F.when(t == "view", F.array(F.lit("UNAVAILABLE"))).when(t == "click", F.array(F.lit("INVALID_ARGUMENT"))).when(t == "error", F.array(F.lit("INVALID_ARGUMENT"), F.lit("ABORTED"))).otherwise(F.array(F.lit("PERMISSION_DENIED")))
    return _table(spark, sf_dir, "events").select("event_id", retry.chain_class(chain).alias("class"))


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'TRANSIENT' WHEN 1 THEN 'TERMINAL' WHEN 2 THEN 'CANCELLATION' WHEN 3 THEN 'ROW_LEVEL' WHEN 4 THEN 'DONE' ELSE 'ROW_LEVEL' END AS class FROM events""")
def service_error_classes(spark, sf_dir):
    n = F.col("event_id") % 6
    chain = F.when(n.isin(0, 1), F.array(F.lit("OTHER"), F.lit("UNAVAILABLE"))).when(n == 2, F.array(F.lit("CANCELLED"))).when(n == 4, F.array(F.lit("ALREADY_EXISTS"))).otherwise(F.array(F.lit("OUT_OF_RANGE")))
    of = lambda service, **more: retry.service_class(service, chain, **more)
    case = F.when(n == 0, of("warehouse")).when(n == 1, of("kv")).when(n == 2, of("bus")).when(n == 3, of("relational", route_violations=True)).when(n == 4, of("tasks")).otherwise(of("warehouse", rejected_rows=F.lit(True)))
    return _table(spark, sf_dir, "events").select("event_id", case.alias("class"))


# -- routing, tasks, failures


@query("""SELECT coalesce(CASE WHEN n_regionkey < 4 THEN 'region_' || n_regionkey END, 'unroutable') AS destination, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def route_destinations(spark, sf_dir):
    c = _table(spark, sf_dir, "customer").join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_regionkey")
    routed, lost = routing.route(c, F.when(F.col("n_regionkey") < 4, F.concat(F.lit("region_"), F.col("n_regionkey").cast("string"))))
    both = routed.select(F.col(routing.DESTINATION).alias("destination")).unionByName(lost.select(F.lit("unroutable").alias("destination")))
    return both.groupBy("destination").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, s_name, 'N' || s_nationkey AS origin, length(s_name) AS name_length FROM supplier")
def additional_fields(spark, sf_dir):
    s = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return routing.add_fields(s, {"origin": F.concat(F.lit("N"), F.col("s_nationkey").cast("string")), "name_length": F.length("s_name").cast("bigint")}, "fail").drop("s_nationkey")


@query("SELECT DISTINCT sha256(user_id || ':' || event_type) AS task_id FROM events WHERE event_type <> 'view' AND user_id >= 10")
def task_identity_dedup(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    tasks = e.filter("event_type <> 'view'").select(formats.task_id(F.concat_ws(":", F.col("user_id").cast("string"), "event_type")).alias("task_id"), "user_id")
    existing = tasks.filter("user_id < 10").select("task_id").distinct()
    return routing.deduplicated_tasks(tasks, existing).select("task_id")


@query("SELECT page_id, url, 'POST' AS method, 'page ' || page_id AS body, sha256(url) AS task_id FROM pages")
def http_tasks(spark, sf_dir):
    p = _table(spark, sf_dir, "pages").select("page_id", routing.http_task(F.col("url"), F.concat(F.lit("page "), F.col("page_id").cast("string")), dedupe_key=F.col("url")).alias("t"))
    return p.select("page_id", "t.url", "t.method", "t.body", "t.task_id")


@query("SELECT 'good' AS part, doc_id, NULL AS dlq_error FROM documents WHERE n_chars >= 200 UNION ALL SELECT 'dead', doc_id, 'too short' FROM documents WHERE n_chars < 200 OR n_chars IS NULL")
def dlq_split(spark, sf_dir):
    good, bad = failures.split(_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), F.col("n_chars") >= 200)
    dead = failures.dead_letters(bad, F.col("doc_id"), F.lit("too short"), "documents", "topic")
    return good.select(F.lit("good").alias("part"), "doc_id", F.lit(None).cast("string").alias("dlq_error")).unionByName(dead.select(F.lit("dead").alias("part"), F.col("payload").alias("doc_id"), "dlq_error"))


@query("""WITH e AS (SELECT event_id, event_id // 50 AS batch, event_type = 'error' AND value > 100 AS rejected, value > 300 AS alone FROM events), b AS (SELECT batch, bool_or(rejected) AS s FROM e GROUP BY 1)
SELECT event_id, s AND alone AS failed FROM e JOIN b USING (batch)""")
def isolate_before_routing(spark, sf_dir):
    """A batch is rejected for one of its rows; only those that fail alone as well are to blame."""
    rejected = (F.col("event_type") == "error") & (F.col("value") > 100)
    e = _table(spark, sf_dir, "events").select("event_id", F.floor(F.col("event_id") / 50).alias("batch"), rejected.alias("rejected"), (F.col("value") > 300).alias("alone"))
    found = failures.isolate(e, "batch", F.col("rejected"), F.col("alone"))
    return failures.stop_after_consecutive(found, "batch", "event_id", most=51).select("event_id", "failed")


@query("SELECT event_id, CASE WHEN try_cast(json_extract_string(p, '$.k') AS BIGINT) IS NULL THEN 'nack' ELSE 'ok' END AS verdict, try_cast(json_extract_string(p, '$.k') AS BIGINT)::VARCHAR AS k FROM (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '{}' ELSE props END AS p FROM events)")
def bus_decode_policy(spark, sf_dir):
    body = F.when(F.col("event_id") % 9 == 0, F.lit("{broken")).otherwise(F.col("props"))
    m = _table(spark, sf_dir, "events").select("event_id", F.encode(body, "UTF-8").alias("payload"))
    out = bus.decode_json(m, "k long", "nack")
    return out.select("event_id", F.when(F.col("_failed"), "nack").otherwise("ok").alias("verdict"), F.col("k").cast("string").alias("k"))


@query("SELECT conv_id::VARCHAR AS ordering_key, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM conversations")
def bus_ordering(spark, sf_dir):
    c = _table(spark, sf_dir, "conversations")
    m = c.select("turn", *bus.message(F.col("text"), None, F.col("conv_id").cast("string"), publish_time=F.timestamp_seconds(F.col("turn"))))
    # places are counted as the rows come, within the task that has the key
    w = Window.partitionBy("ordering_key").orderBy("_at")
    came = bus.per_key_order(m).withColumn("_at", F.monotonically_increasing_id())
    return came.select("ordering_key", "turn", F.row_number().over(w).cast("bigint").alias("place"))


# -- schemas, weights, planning


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::VARCHAR AS nation FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey::VARCHAR FROM supplier")
def schema_union(spark, sf_dir):
    left = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    right = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ID"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("nation"))
    return schemas.union(left, right)


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 3 ELSE CASE WHEN o_custkey IS NOT NULL THEN 3 ELSE 0 END + CASE WHEN o_totalprice > 100000 THEN 2 ELSE 0 END + 1 END::BIGINT AS cells FROM orders""")
def cell_weights(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price"), "o_orderpriority", (F.col("o_orderstatus") == "P").alias("is_delete"), F.lit("orders").alias("table")
    )
    index = F.inline(F.array(*[F.struct(F.lit("orders").alias("table"), F.lit(i).alias("index"), F.lit(c).alias("column")) for i, c in [("by_customer", "o_custkey"), ("by_price", "o_custkey"), ("by_price", "price")]]))
    return schemas.cell_weights(o, spark.range(1).select(index), ["o_custkey", "price", "o_orderpriority"]).select("o_orderkey", "cells")


@query("""WITH RECURSIVE o AS (SELECT o_custkey % 16 AS lane, o_custkey % 97 + 1 AS size, row_number() OVER (PARTITION BY o_custkey % 16 ORDER BY o_orderkey) AS place FROM orders),
g AS (SELECT lane, place, 0::BIGINT AS batch, size::BIGINT AS total, 1::BIGINT AS n, size::BIGINT AS own FROM o WHERE place = 1
  UNION ALL SELECT o.lane, o.place, CASE WHEN total + o.size > 2000 OR n + 1 > 64 THEN batch + 1 ELSE batch END, CASE WHEN total + o.size > 2000 OR n + 1 > 64 THEN o.size ELSE total + o.size END,
    CASE WHEN total + o.size > 2000 OR n + 1 > 64 THEN 1 ELSE n + 1 END, o.size FROM g JOIN o ON o.lane = g.lane AND o.place = g.place + 1)
SELECT lane, batch, count(*) AS n, sum(own)::BIGINT AS total FROM g GROUP BY lane, batch""")
def greedy_batches(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 16).alias("lane"), (F.col("o_custkey") % 97 + 1).alias("size"), F.lit(1).alias("one"))
    return staging.greedy_batches(o, ["lane"], "o_orderkey", {"size": 2000, "one": 64}).groupBy("lane", "batch").agg(F.count("*").alias("n"), F.sum("size").alias("total"))


@query("""SELECT 'd' || (o_custkey % 4) AS destination, 'parquet' AS format, ((row_number() OVER (PARTITION BY o_custkey % 4 ORDER BY printf('f%010d', o_orderkey)) - 1) // 500)::BIGINT AS load_index, o_orderkey FROM orders""")
def load_binpack(spark, sf_dir):
    files = _table(spark, sf_dir, "orders").select(
        F.concat(F.lit("d"), (F.col("o_custkey") % 4).cast("string")).alias("destination"), F.lit("parquet").alias("format"), F.format_string("f%010d", "o_orderkey").alias("uri"), F.lit(1).cast("bigint").alias("bytes"), "o_orderkey"
    )
    return staging.plan_loads(files, max_files=500).select("destination", "format", "load_index", "o_orderkey")


@query("""WITH s AS (SELECT 'user-' || user_id AS subscription, row_number() OVER (ORDER BY 'user-' || user_id) - 1 AS n, count(*) OVER () AS total FROM (SELECT DISTINCT user_id FROM events)),
k AS (SELECT unnest(range(0, 1024)) AS i)
SELECT 'per_key' AS mode, n AS split, subscription, n % 8 AS owner FROM s
UNION ALL SELECT 'none', n + i * total, subscription, (n + i * total) % 1024 FROM s JOIN k ON n + i * total < greatest(total, 1024)""")
def split_plan(spark, sf_dir):
    users = _table(spark, sf_dir, "events").select(F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("subscription"))
    parts = [bus.split_owners(users, p, mode).withColumn("mode", F.lit(mode)) for mode, p in (("per_key", 8), ("none", 1024))]
    return parts[0].unionByName(parts[1]).select("mode", "split", "subscription", "owner")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS v FROM events WHERE ts <= TIMESTAMP '2024-01-15') WHERE v = 1 AND event_type = 'click'""")
def options_snapshot(spark, sf_dir):
    """A snapshot declared by options, whose restriction says something of the rows it gives."""
    o = {"path": f"{sf_dir}/events.parquet", "source.snapshot-time": "2024-01-15", "key": "user_id", "version-time": "ts", "deleted": "event_type = 'error'", "source.row-restriction": "event_type = 'click'", "columns": "user_id, event_id, event_type"}
    return catalog.table(spark, "warehouse", o)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey < 700 AND o_totalprice > 1000")
def options_query(spark, sf_dir):
    o = {"source.query": f"SELECT * FROM parquet.`{sf_dir}/orders.parquet` WHERE o_totalprice > 1000", "source.row-restriction": "o_orderstatus = 'F' AND o_custkey < 700", "columns": "o_orderkey,o_custkey"}
    return catalog.table(spark, "warehouse", o)


@query("""SELECT event_id, user_id AS id, event_type AS state, (epoch_us(ts) * 1000 + 7) AS commit_nanos FROM events WHERE event_type <> 'error'""")
def change_records_json(spark, sf_dir):
    """Change records that arrive as JSON, in a changelog of upserts."""
    e = _table(spark, sf_dir, "events").filter("event_type <> 'error'")
    mods = F.array(F.struct(F.to_json(F.struct(F.col("user_id").cast("string").alias("id"))).alias("keys"), F.to_json(F.struct(F.col("event_type").alias("state"), F.col("event_id").alias("seen"))).alias("new_values"), F.lit("{}").alias("old_values")))
    at = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    json = F.to_json(F.struct(F.lit("users").alias("table_name"), F.concat(at, F.lit("007Z")).alias("commit_timestamp"), F.lit("1").alias("record_sequence"), F.lit("UPDATE").alias("mod_type"), F.lit("NEW_ROW").alias("value_capture_type"), mods.alias("mods")))
    out = changelog.expand(changelog.decode_json_records(e.select(json.alias("record"))), _USERS, ["id"], "upsert")
    return out.select(F.col("seen").alias("event_id"), "id", "state", "commit_nanos")


@query("""SELECT s_suppkey, CASE WHEN s_acctbal >= 0 AND s_nationkey < 20 THEN '' WHEN s_acctbal < 0 AND s_nationkey >= 20 THEN 'balance,nation' WHEN s_acctbal < 0 THEN 'balance' ELSE 'nation' END AS violates FROM supplier""")
def constraint_routes(spark, sf_dir):
    good, bad = relational.checked(_table(spark, sf_dir, "supplier"), {"balance": F.col("s_acctbal") >= 0, "nation": F.col("s_nationkey") < 20}, "route")
    return good.select("s_suppkey", F.lit("").alias("violates")).unionByName(bad.select("s_suppkey", F.array_join("violates", ",").alias("violates")))


@query("""SELECT event_id, k AS entry_index, CASE k WHEN 0 THEN 'DELETE_CELLS' ELSE 'SET_CELL' END AS kind, CASE k WHEN 1 THEN event_type END AS value FROM events, (VALUES (0), (1)) v(k)""")
def change_envelope(spark, sf_dir):
    def entry(i, kind, value):
        return F.struct(F.lit(i).alias("entry_index"), F.lit(kind).alias("kind"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"), value.alias("value"), F.lit(False).alias("bounded"), F.lit(False).alias("computed"))

    both = F.array(entry(1, "SET_CELL", F.col("event_type")), entry(0, "DELETE_CELLS", F.lit(None).cast("string")))
    rows = changelog.envelope(_table(spark, sf_dir, "events").select("event_id", both.cast(changelog.ENTRIES).alias("entries")))
    return rows.select("event_id", F.col("entry_index").cast("bigint").alias("entry_index"), "kind", "value")


_RANGES_SQL = """(SELECT user_id % 20 AS g, event_id * 10 AS s, event_id * 10 + CASE WHEN value > 60 THEN 400 ELSE 25 END AS e FROM events)"""


def _event_ranges(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    return e.select((F.col("user_id") % 20).alias("g"), (F.col("event_id") * 10).alias("start"), (F.col("event_id") * 10 + F.when(F.col("value") > 60, 400).otherwise(25)).cast("bigint").alias("end"))


_ISLANDS_SQL = f"""SELECT g, min(s) AS "start", max(e) AS "end" FROM (SELECT *, sum(n) OVER (PARTITION BY g ORDER BY s ROWS UNBOUNDED PRECEDING) AS i FROM
(SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY g ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM {_RANGES_SQL})) GROUP BY g, i"""


@query(_ISLANDS_SQL)
def range_coalesce(spark, sf_dir):
    return ranges.coalesced(_event_ranges(spark, sf_dir), ["g"])


@query(f"""SELECT g, "end" AS "start", nxt AS "end" FROM (SELECT *, lead("start") OVER (PARTITION BY g ORDER BY "start") AS nxt FROM ({_ISLANDS_SQL})) WHERE nxt IS NOT NULL""")
def range_gaps(spark, sf_dir):
    return ranges.gaps(_event_ranges(spark, sf_dir), ["g"])


@query("SELECT user_id % 10 AS stream, min(CASE WHEN event_type <> 'error' THEN (epoch_us(ts) // 1000) END) - 1 AS frontier_ms FROM events GROUP BY 1")
def watermark_frontier(spark, sf_dir):
    parts = _table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("stream"), F.when(F.col("event_type") == "error", "FINISHED").otherwise("RUNNING").alias("state"), F.unix_millis(F.col("ts").cast("timestamp")).alias("watermark_ms"))
    return ledger.frontier(parts, by=["stream"])


@query("""WITH p AS (SELECT event_id AS token, CASE WHEN event_type IN ('signup', 'view') THEN 'CREATED' ELSE 'FINISHED' END AS state FROM events)
SELECT token FROM p c WHERE state = 'CREATED' AND NOT EXISTS (SELECT 1 FROM p q WHERE q.token = c.token // 2 AND q.token <> c.token AND q.state <> 'FINISHED')""")
def lineage_ready(spark, sf_dir):
    p = _table(spark, sf_dir, "events").select(F.col("event_id").alias("token"), F.when(F.col("event_type").isin("signup", "view"), "CREATED").otherwise("FINISHED").alias("state"))
    edges = p.select(F.col("token").alias("child"), F.floor(F.col("token") / 2).alias("parent")).filter("child <> parent")
    return ledger.schedulable(p, edges).select("token")


@query("""SELECT event_id, CASE WHEN has AND age >= 120000 THEN 'RESUME' WHEN age >= 1200000 THEN 'RESTART' ELSE 'WAIT' END AS action FROM (SELECT event_id, event_type = 'click' AS has, 1706659200000 - (epoch_us(ts) // 1000) AS age FROM events)""")
def missing_recovery(spark, sf_dir):
    m = _table(spark, sf_dir, "events").select("event_id", (F.col("event_type") == "click").alias("has_tokens"), F.unix_millis(F.col("ts").cast("timestamp")).alias("missing_since_ms"))
    return ledger.recovery(m, F.lit(1706659200000)).select("event_id", "action")


@query("""WITH p AS (SELECT event_id // 4 AS t, (event_id % 4) * 25 AS s, (event_id % 4) * 25 + CASE WHEN event_type = 'error' THEN 20 ELSE 25 END AS e, event_id AS token, (epoch_us(ts) // 1000) AS w FROM events)
SELECT t * 1000 AS target_start, min(w) AS watermark_ms, string_agg(token, ',' ORDER BY token::VARCHAR) AS tokens FROM p GROUP BY t HAVING sum(e - s) = 100""")
def merge_cover(spark, sf_dir):
    base = F.floor(F.col("event_id") / 4) * 1000
    start = base + (F.col("event_id") % 4) * 25
    p = _table(spark, sf_dir, "events").select(
        base.alias("target_start"), (base + 100).alias("target_end"), start.alias("start"), (start + F.when(F.col("event_type") == "error", 20).otherwise(25)).alias("end"), F.col("event_id").cast("string").alias("token"), F.unix_millis(F.col("ts").cast("timestamp")).alias("watermark_ms")
    )
    return ledger.merged(p).select("target_start", "watermark_ms", F.array_join("tokens", ",").alias("tokens"))


@query("SELECT event_id, greatest((epoch_us(ts) // 1000), epoch_ms(TIMESTAMP '2024-01-31') - 604800000 + 60000) AS start_ms FROM events")
def start_clamp(spark, sf_dir):
    at = positions.clamp(F.col("ts").cast("timestamp"), F.lit("2024-01-31").cast("timestamp"), 604800)
    return _table(spark, sf_dir, "events").select("event_id", F.unix_millis(at).alias("start_ms"))


@query("""SELECT event_id, 'q_' || regexp_replace('user ' || user_id, '[^A-Za-z0-9_-]', '_', 'g') || '_' || substr(sha256('user ' || user_id || '|' || event_type || '|3600'), 1, 16) || '_' || (epoch_us(ts) // 3600000000)::VARCHAR AS bucket FROM events""")
def query_bucket_id(spark, sf_dir):
    name = F.concat(F.lit("user "), F.col("user_id").cast("string"))
    return _table(spark, sf_dir, "events").select("event_id", positions.bucket_id("q", name, F.col("event_type"), F.col("ts"), 3600).alias("bucket"))


# -- relational work that is left to Spark SQL


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity)::BIGINT AS quantity, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS cents FROM lineitem GROUP BY 1, 2")
def host_group(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (1, 2)")
def host_cube(spark, sf_dir):
    return _table(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT event_id, row_number() OVER w AS place, (epoch_us(ts) - lag(epoch_us(ts)) OVER w)::VARCHAR AS waited FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def host_window(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    return _versions(spark, sf_dir).select("event_id", F.row_number().over(w).cast("bigint").alias("place"), (F.col("t") - F.lag("t").over(w)).cast("string").alias("waited"))


@query("(SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') EXCEPT SELECT s_suppkey FROM supplier")
def host_set_ops(spark, sf_dir):
    a = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    b = _table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k"))
    return a.intersect(b).subtract(_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")))


@query("SELECT o_orderkey, round(o_totalprice * 100)::BIGINT AS cents FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def host_topk(spark, sf_dir):
    return _table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-range scan of the wide-column orders, looked up in customers."""
    dim = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return lookup.lookup(kv_orders(spark, sf_dir), dim, {"customer": "c_custkey"}, ["c_custkey"])


@query(f"""SELECT row_key, customer, status, cents::VARCHAR AS cents, c_name, c_mktsegment FROM {_ORDERS_SQL} LEFT JOIN customer ON customer = c_custkey
WHERE row_key >= '0000000100' AND row_key < '0000000200' OR row_key BETWEEN '0000001000' AND '0000001050' OR row_key >= '0000014000'""")
def kv_scan_with_lookup(spark, sf_dir):
    return flagship(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
