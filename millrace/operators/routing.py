"""Per-record destinations, added fields, and what cannot be routed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DESTINATION, REASON = "_destination", "_reason"

# Fixed value: the scope of an OAuth token that names none.
DEFAULT_SCOPE = "https://www.googleapis.com/auth/cloud-platform"


def route(df: DataFrame, destination: Column, reason: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with a destination, and the rows that have none with the reason."""
    placed = df.withColumn(DESTINATION, destination)
    why = reason if reason is not None else F.lit("no destination")
    return placed.filter(F.col(DESTINATION).isNotNull()), placed.filter(F.col(DESTINATION).isNull()).drop(DESTINATION).withColumn(REASON, why)


def write_routed(routed: DataFrame, folder: str, options: dict[str, str] | None = None) -> None:
    """One folder per destination, in one pass; no job per destination."""
    routed.write.mode("append").options(**(options or {})).partitionBy(DESTINATION).parquet(folder)


def serialized(df: DataFrame, payload: Column, name: str = "payload", skipped: Observation | None = None) -> DataFrame:
    """Rows with their payload; a null payload means that the row is skipped, which ``skipped`` counts."""
    out = df.withColumn(name, payload)
    if skipped is not None:
        out = out.observe(skipped, F.count(F.when(F.col(name).isNull(), 1)).alias("skipped"))
    return out.filter(F.col(name).isNotNull())


def add_fields(df: DataFrame, fields: dict[str, Column], nulls: str = "allow") -> DataFrame:
    """Columns computed from the original row; with ``nulls="fail"`` none may be null."""
    clash = {n.lower() for n in fields} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"fields exist already: {sorted(clash)}")
    if nulls == "fail":
        fields = {n: F.when(c.isNotNull(), c).otherwise(F.raise_error(F.lit(f"{n} is null"))) for n, c in fields.items()}
    return df.withColumns(fields)


def http_task(url: Column, body: Column, method: Column | str = "POST", headers: Column | None = None, schedule_at: Column | None = None, dedupe_key: Column | None = None, oidc: tuple[str, str | None] | None = None, oauth: tuple[str, str | None] | None = None) -> Column:
    """An HTTP task; methods without body carry none.

    ``oidc`` is an account and an audience (by default the URL), ``oauth`` an account and
    a scope; a task takes one of them at most.
    """
    if oidc and oauth:
        raise ValueError("either an OIDC or an OAuth token")
    text = lambda v: F.lit(v).cast("string")
    if oidc:
        token = F.struct(F.lit("OIDC").alias("kind"), text(oidc[0]).alias("account"), (text(oidc[1]) if oidc[1] else url).alias("target"))
    elif oauth:
        token = F.struct(F.lit("OAUTH").alias("kind"), text(oauth[0]).alias("account"), text(oauth[1] or DEFAULT_SCOPE).alias("target"))
    else:
        token = F.lit(None).cast("struct<kind:string,account:string,target:string>")
    verb = F.upper(F.lit(method)) if isinstance(method, str) else F.upper(method)
    known = F.when(verb.isin("POST", "GET", "HEAD", "PUT", "DELETE", "PATCH", "OPTIONS"), verb).otherwise(F.raise_error(F.concat(F.lit("no HTTP method: "), verb)).cast("string"))
    right_url = F.when(url.rlike("^https?://[^/\\s]+"), url).otherwise(F.raise_error(F.concat(F.lit("no HTTP URL: "), F.coalesce(url, F.lit("null")))).cast("string"))
    return F.struct(
        F.when(dedupe_key.isNotNull(), F.sha2(dedupe_key, 256)).alias("task_id") if dedupe_key is not None else F.lit(None).cast("string").alias("task_id"),
        right_url.alias("url"),
        known.alias("method"),
        (headers if headers is not None else F.create_map().cast("map<string,string>")).alias("headers"),
        F.when(known.isin("POST", "PUT", "PATCH"), body).alias("body"),
        (schedule_at.cast("timestamp") if schedule_at is not None else F.lit(None).cast("timestamp")).alias("schedule_at"),
        token.alias("token"),
    )


def app_engine_task(relative_uri: Column, body: Column, service: Column | None = None, version: Column | None = None, instance: Column | None = None) -> Column:
    """A task for a service inside the platform; its URI starts with a slash."""
    none = F.lit(None).cast("string")
    uri = F.when(relative_uri.startswith("/"), relative_uri).otherwise(F.raise_error(F.concat(F.lit("not a relative URI: "), F.coalesce(relative_uri, F.lit("null")))).cast("string"))
    routing = F.struct((service if service is not None else none).alias("service"), (version if version is not None else none).alias("version"), (instance if instance is not None else none).alias("instance"))
    return F.struct(uri.alias("relative_uri"), body.alias("body"), routing.alias("routing"))


def deduplicated_tasks(tasks: DataFrame, existing: DataFrame | None = None, task_id: str = "task_id") -> DataFrame:
    """Each named task once, and none that exists already; unnamed ones all stay."""
    named = tasks.filter(F.col(task_id).isNotNull()).dropDuplicates([task_id])
    if existing is not None:
        named = named.join(existing.select(task_id), task_id, "left_anti")
    return named.unionByName(tasks.filter(F.col(task_id).isNull()))


Resolver = Callable[[DataFrame], Column]
