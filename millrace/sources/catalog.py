"""Tables declared by connector name and options: read as views, written by inserts."""

from __future__ import annotations

import base64
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cells, changelog, routing
from ..operators.changelog import ROW_KIND
from ..plans import positions, ranges
from ..plans.positions import QueryResults
from ..streaming import bus, changes
from . import kv, relational, warehouse
from .files import exists

# Groups of options that only tune a remote transport; they change nothing here.
TRANSPORT = ("sink.retry", "sink.recovery", "scan.ack", "scan.flow-control", "scan.shutdown", "sink.in-flight", "sink.channel-pool", "emulator", "service-account", "scan.parallel-pull", "sink.default-stream")

# Options of the connectors.
_KNOWN = {
    "warehouse": {
        "path", "source.query", "source.row-restriction", "source.snapshot-time", "source.max-stream-count", "source.reuse-query-result-within", "source.result-folder", "columns", "key", "version-time", "deleted",
        "sink.create-disposition", "sink.file-loads.write-disposition", "sink.table-create.clustered-fields", "sink.table-create.time-partitioning.field", "sink.table-create.time-partitioning.type",
        "sink.cdc.enabled", "sink.cdc.max-staleness", "sink.cdc.table-reconciliation", "order",
    },
    "kv": {"path", "families", "scan.row-ranges", "scan.row-prefix", "scan.row-range.start-closed", "scan.row-range.end-open", "scan.row-key-encoding", "scan.timestamp-micros", "key-type", "key-column"},
    "relational": {
        "scan.mode", "scan.change-stream.name", "scan.change-stream.changelog-mode", "scan.change-stream.retention", "scan.startup.mode", "scan.startup.timestamp-millis",
        "scan.end-timestamp-millis", "schema", "table",
        "path", "columns", "scan.timestamp-bound.read-timestamp", "scan.timestamp-bound.exact-staleness", "scan.query", "key", "version-time", "deleted", "order",
    },
    "bus": {"topic", "subscription", "format", "schema", "scan.deserialization-failure-policy", "scan.startup.mode", "scan.startup.timestamp-millis", "scan.auto-create.filter", "scan.ordering-mode", "sink.message-ordering.enabled", "ordering-key", "attributes"},
    "tasks": {"queue", "http.url", "http.method", "http.headers", "http.oidc.service-account-email", "http.oidc.audience", "http.oauth.service-account-email", "http.oauth.scope", "app-engine.relative-uri", "app-engine.service", "app-engine.version", "app-engine.instance", "name-column", "body"},
}
_PARTITION_UNITS = {"HOUR": "hour", "DAY": "day", "MONTH": "month", "YEAR": "year"}


def check_options(connector: str, options: dict[str, str]) -> dict[str, str]:
    """The options that mean something; unknown ones are refused."""
    if connector not in _KNOWN:
        raise ValueError(f"no connector {connector}")
    real = {k: v for k, v in options.items() if not any(k == t or k.startswith((f"{t}.", f"{t}-")) for t in TRANSPORT)}
    if unknown := set(real) - _KNOWN[connector]:
        raise ValueError(f"{connector} has no options {sorted(unknown)}")
    return real


def _names(text: str | None) -> list[str]:
    return [c.strip() for c in (text or "").split(",") if c.strip()]


def _families(text: str) -> dict[str, dict[str, str]]:
    """``family:qualifier type,qualifier type;family:...``"""
    return {f.strip(): dict(q.strip().split(" ") for q in qualifiers.split(",")) for f, qualifiers in (p.split(":") for p in text.split(";"))}


def _needs(connector: str, o: dict[str, str], *names: str) -> None:
    if missing := [n for n in names if n not in o]:
        raise ValueError(f"{connector} needs {missing}")


def _key_ranges(o: dict[str, str]) -> list[ranges.KeyRange] | None:
    encoding = o.get("scan.row-key-encoding", "utf8").lower()
    key = lambda text: base64.b64decode(text, validate=True) if encoding == "base64" else text.encode()
    start, end = o.get("scan.row-range.start-closed"), o.get("scan.row-range.end-open")
    if sum((("scan.row-ranges" in o), ("scan.row-prefix" in o), start is not None or end is not None)) > 1:
        raise ValueError("row ranges, a row prefix and range bounds exclude each other")
    if "scan.row-ranges" in o:
        return ranges.parse(o["scan.row-ranges"], encoding)
    if "scan.row-prefix" in o:
        return [ranges.prefix(key(o["scan.row-prefix"]))]
    if start is not None or end is not None:
        return [ranges.KeyRange(key(start or ""), key(end) if end else None)]
    return None


def _versions_at(df: DataFrame, o: dict[str, str], at) -> DataFrame:
    deleted = F.expr(o["deleted"]) if "deleted" in o else None
    return warehouse.snapshot(df, _names(o["key"]), o["version-time"], at, deleted)


def table(spark: SparkSession, connector: str, options: dict[str, str]) -> DataFrame:
    """A table's rows; a topic's are a stream under ``scan.startup.mode``, otherwise what it holds now.

    A restriction applies to the rows that a snapshot or a query gives, never before.
    """
    o = check_options(connector, options)
    if connector == "kv":
        _needs(connector, o, "path", "families")
        return kv.scan(spark, o["path"], _families(o["families"]), _key_ranges(o), int(o["scan.timestamp-micros"]) if "scan.timestamp-micros" in o else None, o.get("key-type", "string"))
    if connector == "bus":
        return _topic(spark, o)
    if connector == "tasks":
        raise ValueError("tasks can only be written")
    mode = _chosen(o.get("scan.mode", "bounded"), {"bounded": "bounded", "change-stream": "change-stream"}, "scan.mode")
    if mode == "change-stream":
        return _change_stream(spark, o)
    if unused := sorted(k for k in o if k.startswith(("scan.change-stream", "scan.startup", "scan.end-timestamp"))):
        raise ValueError(f"{unused} need scan.mode = change-stream")
    columns = _names(o["columns"]) if "columns" in o else None
    restriction = o.get("source.row-restriction")
    query = o.get("source.query") or o.get("scan.query")
    at = o.get("source.snapshot-time") or o.get("scan.timestamp-bound.read-timestamp")
    stale = o.get("scan.timestamp-bound.exact-staleness")
    if stale:
        if at:
            raise ValueError("either a read timestamp or a staleness")
        at = datetime.now(timezone.utc) - timedelta(seconds=float(stale.removesuffix("s")))
    if query:
        if at:
            raise ValueError("a query has no snapshot")
        if "source.reuse-query-result-within" in o:
            _needs(connector, o, "source.result-folder")
            window = timedelta(seconds=float(o["source.reuse-query-result-within"]))
            df = QueryResults(spark, o["source.result-folder"], window).query("query", query)
        else:
            df = spark.sql(query)
    else:
        _needs(connector, o, "path")
        if not at:
            if relational.follows(spark, o["path"]) or relational.versions(spark, o["path"].rstrip("/")):
                df = relational.read_current(spark, o["path"].rstrip("/"))
                df = df.where(restriction) if restriction else df
                return df.select(*columns) if columns else df
            streams = int(o["source.max-stream-count"]) if "source.max-stream-count" in o else None
            return warehouse.scan(spark, o["path"], columns, restriction, streams)
        _needs(connector, o, "key", "version-time")
        instant = F.lit(at).cast("timestamp")
        df = _versions_at(spark.read.parquet(o["path"]), o, instant)
    df = df.where(restriction) if restriction else df
    return df.select(*columns) if columns else df


def _topic(spark: SparkSession, o: dict[str, str]) -> DataFrame:
    _needs("bus", o, "topic")
    mode = o.get("scan.startup.mode")
    start = _instant(o, "scan.startup.timestamp-millis", mode is None or mode.lower() == "timestamp")
    if mode is not None:
        subscription = o.get("subscription", "default")
        kind = _chosen(mode, {"continue-from-subscription": "earliest", "earliest-retained": "earliest", "earliest": "earliest", "latest": "latest", "timestamp": "at"}, "scan.startup.mode")
        # the position of a subscription is found once, so that a restart does not skip what came meanwhile
        begun = positions.kept_start(spark, f"{o['topic'].rstrip('/')}/_subscriptions/{subscription}", kind, start)
        messages = bus.subscribe(spark, o["topic"], o.get("scan.auto-create.filter"), begun, subscription=subscription)
    else:
        messages = spark.read.schema(bus.MESSAGE).parquet(o["topic"])
        messages = messages.filter(F.col("publish_time") >= F.lit(start)) if start else messages
        messages = messages.where(o["scan.auto-create.filter"]) if "scan.auto-create.filter" in o else messages
        if o.get("scan.ordering-mode", "").upper() == "PER_KEY":
            messages = bus.per_key_order(messages)
    if o.get("format", "raw") == "raw":
        return messages
    _needs("bus", o, "schema")
    return bus.decode_json(messages, o["schema"], o.get("scan.deserialization-failure-policy", "fail"))


def _chosen(value: str, meanings: dict[str, str], option: str) -> str:
    """What an option's value means; one that means nothing is refused."""
    if value.lower() not in meanings:
        raise ValueError(f"{option} is none of {sorted(meanings)}: {value}")
    return meanings[value.lower()]


def _instant(o: dict[str, str], option: str, allowed: bool) -> datetime | None:
    if option in o and not allowed:
        raise ValueError(f"{option} needs the mode timestamp")
    return datetime.fromtimestamp(int(o[option]) / 1000, timezone.utc) if option in o else None


_MODES = {"earliest": "earliest", "latest": "latest", "timestamp": "at"}


def _change_stream(spark: SparkSession, o: dict[str, str]) -> DataFrame:
    """A table's change records as a changelog: a stream from ``scan.startup.mode`` to ``scan.end-timestamp-millis``.

    The start is found once for ``scan.change-stream.name`` and kept beside the records.
    """
    _needs("relational", o, "path", "scan.change-stream.name", "scan.change-stream.changelog-mode", "schema", "key", "table")
    changelog_mode = _chosen(o["scan.change-stream.changelog-mode"], {"full": "full", "upsert": "upsert"}, "scan.change-stream.changelog-mode")
    kind = _chosen(o.get("scan.startup.mode", "latest"), _MODES, "scan.startup.mode")
    at = _instant(o, "scan.startup.timestamp-millis", kind == "at")
    if kind == "at" and at is None:
        raise ValueError("scan.startup.mode = timestamp needs scan.startup.timestamp-millis")
    retention = timedelta(seconds=float(o.get("scan.change-stream.retention", "604800s").removesuffix("s")))
    place = f"{o['path'].rstrip('/')}/_streams/{o['scan.change-stream.name']}"
    start = positions.kept_start(spark, place, kind, at, retention)
    records = changes.read(spark, o["path"], start=start, end=_instant(o, "scan.end-timestamp-millis", True))
    own = records.filter(F.col("table") == o["table"])
    return changelog.expand(own, T.StructType.fromDDL(o["schema"]), _names(o["key"]), changelog_mode)


def create_view(spark: SparkSession, name: str, connector: str, options: dict[str, str]) -> None:
    table(spark, connector, options).createOrReplaceTempView(name)


def insert(df: DataFrame, connector: str, options: dict[str, str]) -> None:
    """Writes rows to a table by its options; for a changelog they have ``_row_kind``."""
    o = check_options(connector, options)
    if connector == "warehouse" and o.get("sink.cdc.enabled", "false").lower() == "true":
        _needs(connector, o, "path", "key", "order")
        _keep_contract(df.sparkSession, o)
        relational.follow(df, o["path"], _names(o["key"]), _names(o["order"]))
    elif connector == "warehouse":
        _needs(connector, o, "path")
        if relational.follows(df.sparkSession, o["path"]):
            raise ValueError("the table follows a changelog: insert with sink.cdc.enabled")
        unit, field = o.get("sink.table-create.time-partitioning.type", "DAY"), o.get("sink.table-create.time-partitioning.field")
        warehouse.write(
            df,
            o["path"],
            o.get("sink.file-loads.write-disposition", "append").lower().replace("write-", ""),
            o.get("sink.create-disposition", "if_needed").lower().replace("create-", "").replace("-", "_"),
            F.date_trunc(_PARTITION_UNITS[unit], field).cast("date" if unit != "HOUR" else "timestamp") if field else None,
            _names(o.get("sink.table-create.clustered-fields")),
        )
    elif connector == "kv":
        _needs(connector, o, "path", "families", "key-column")
        families = _families(o["families"])
        places = {(f, q): q for f, qualifiers in families.items() for q in qualifiers}
        stamp = F.lit(int(o["scan.timestamp-micros"])).cast("bigint") if "scan.timestamp-micros" in o else F.unix_micros(F.current_timestamp())
        kv.store(cells.to_cells(df, F.col(o["key-column"]), families, places, stamp), o["path"], mode="append")
    elif connector == "relational":
        _needs(connector, o, "path")
        if ROW_KIND not in df.columns and not relational.follows(df.sparkSession, o["path"]):
            df.write.mode("append").parquet(o["path"])
            return
        _needs(connector, o, "key", "order")
        relational.follow(df, o["path"], _names(o["key"]), _names(o["order"]))
    elif connector == "bus":
        _needs(connector, o, "topic")
        own = [c for c in (o.get("ordering-key"), o.get("attributes")) if c]
        ordered = o.get("sink.message-ordering.enabled", "true").lower() == "true"
        body = F.to_json(F.struct(*[c for c in df.columns if c not in own])) if o.get("format", "raw") == "json" else F.col("payload")
        bus.publish(df.select(*bus.message(body, F.col(o["attributes"]) if "attributes" in o else None, F.col(o["ordering-key"]) if "ordering-key" in o and ordered else None)), o["topic"])
    else:
        _insert_tasks(df, o)


def _keep_contract(spark: SparkSession, o: dict[str, str]) -> None:
    """Checks the table's contract, and stores it where it is new or may be reconciled."""
    place = f"{o['path'].rstrip('/')}/_contract"
    known = spark.read.parquet(place).first().asDict() if exists(spark, place) else None
    wanted = contract(known, _names(o["key"]), o.get("sink.cdc.max-staleness"), o.get("sink.cdc.table-reconciliation", "verify-only"), o.get("sink.create-disposition", "create-if-needed"))
    if wanted != known:
        spark.createDataFrame([(wanted["primary_key"], wanted["max_staleness"])], "primary_key array<string>, max_staleness string").coalesce(1).write.mode("overwrite").parquet(place)


def contract(existing: dict | None, primary_key: list[str], max_staleness: str | None, policy: str = "verify-only", create: str = "create-if-needed") -> dict:
    """The properties that a table of upserts shall have: its primary key and how stale reads may be.

    A missing table is created unless that is denied. Of an existing one the key has to
    agree under every policy; another staleness is an error under ``verify-only`` and is
    taken over under ``reconcile``. A staleness that is not given is not managed.
    """
    if policy not in ("verify-only", "reconcile"):
        raise ValueError(f"no reconciliation policy {policy}")
    if existing is None:
        if create == "create-never":
            raise FileNotFoundError("the table is missing and must not be created")
        return {"primary_key": primary_key, "max_staleness": max_staleness}
    if existing["primary_key"] != primary_key:
        raise ValueError(f"the table's key is {existing['primary_key']}, not {primary_key}")
    if max_staleness is None or existing["max_staleness"] == max_staleness:
        return existing
    if policy == "verify-only":
        raise ValueError(f"the table's staleness is {existing['max_staleness']}, not {max_staleness}")
    return existing | {"max_staleness": max_staleness}


def _insert_tasks(df: DataFrame, o: dict[str, str]) -> None:
    """Tasks with a name are written once, however often they are inserted."""
    _needs("tasks", o, "queue")
    body = F.col(o["body"]) if "body" in o else F.to_json(F.struct("*"))
    name = F.col(o["name-column"]) if "name-column" in o else None
    if ("http.url" in o) == ("app-engine.relative-uri" in o):
        raise ValueError("tasks need either http.url or app-engine.relative-uri")
    token = lambda kind, target: (o[f"http.{kind}.service-account-email"], o.get(f"http.{kind}.{target}")) if f"http.{kind}.service-account-email" in o else None
    if "http.url" in o:
        headers = F.create_map(*[F.lit(x) for pair in o["http.headers"].split(",") for x in pair.split(":", 1)]) if "http.headers" in o else None
        task = routing.http_task(F.lit(o["http.url"]), body, o.get("http.method", "POST"), headers, dedupe_key=name, oidc=token("oidc", "audience"), oauth=token("oauth", "scope"))
        rows = df.select(task.alias("t")).select("t.*")
    else:
        part = lambda n: F.lit(o[n]) if n in o else None
        task = routing.app_engine_task(F.lit(o["app-engine.relative-uri"]), body, part("app-engine.service"), part("app-engine.version"), part("app-engine.instance"))
        rows = df.select((F.sha2(name, 256) if name is not None else F.lit(None).cast("string")).alias("task_id"), task.alias("t")).select("task_id", "t.*")
    spark = df.sparkSession
    existing = spark.read.schema(T.StructType([T.StructField("task_id", T.StringType())])).parquet(o["queue"]) if exists(spark, o["queue"]) else None
    routing.deduplicated_tasks(rows, existing).write.mode("append").parquet(o["queue"])
