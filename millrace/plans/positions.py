"""Where a stream starts, and which stored result a query may reuse."""

from __future__ import annotations

import hashlib
import re
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import exists, read_text, write_new

SAFETY = timedelta(minutes=1)


class StartExpired(Exception):
    """A restored position lies before what the service still keeps."""


def start_time(mode: str, now: datetime, retention: timedelta, at: datetime | None = None, ago: timedelta | None = None) -> datetime:
    """The instant to read from: ``latest``, ``earliest``, ``at`` or ``ago``.

    Requests from before the retained time are moved to its first safe instant; requests
    for the future are refused.
    """
    earliest = now - retention + SAFETY
    wanted = {"latest": now, "earliest": earliest, "at": at, "ago": now - ago if ago is not None else None}[mode]
    if wanted is None:
        raise ValueError(f"start mode {mode} needs its time")
    if wanted > now:
        raise ValueError("a start in the future")
    return max(wanted, earliest)


def restored_start(restored: datetime, now: datetime, retention: timedelta, fallback: str | None = None) -> datetime:
    """A checkpoint's position, or the fallback's where that has expired."""
    if restored >= now - retention + SAFETY:
        return restored
    if fallback is None:
        raise StartExpired(f"{restored.isoformat()} is no longer retained")
    return start_time(fallback, now, retention)


def kept_start(spark: SparkSession, path: str, mode: str, at: datetime | None = None, retention: timedelta | None = None, now: datetime | None = None) -> datetime | None:
    """Where a stream begins: found at its first start and kept in a small file.

    A restarted query reads from its checkpoint on; what bounds it from below must stay
    what it was, or it would leave out what came while it was down. None is the
    beginning of all that is kept.
    """
    now = now or datetime.now(timezone.utc)
    if exists(spark, path):
        found = read_text(spark, path).strip()
        return datetime.fromisoformat(found) if found else None
    if retention is None:
        if mode == "at" and at is None:
            raise ValueError("a start at a time needs the time")
        start = {"earliest": None, "latest": now, "at": at}[mode]
    else:
        start = start_time(mode, now, retention, at)
    if not write_new(spark, path, start.isoformat() if start else "\n"):  # another was first
        return kept_start(spark, path, mode, at, retention, now)
    return start


def clamp(requested: Column, now: Column, retention_seconds: int) -> Column:
    """``start_time`` for a column of requests; those for the future are an error."""
    earliest = now - F.make_dt_interval(secs=F.lit(retention_seconds - SAFETY.seconds))
    return F.when(requested > now, F.raise_error(F.lit("a start in the future")).cast("timestamp")).otherwise(F.greatest(requested, earliest))


def bucket_id(prefix: Column | str, name: Column, spec: Column, at: Column, window_seconds: int) -> Column:
    """The identity of a query's result: equal for the same query within a time bucket."""
    start = F.lit(prefix) if isinstance(prefix, str) else prefix
    label = F.substring(F.regexp_replace(name, "[^A-Za-z0-9_-]", "_"), 1, 64)
    digest = F.substring(F.sha2(F.concat_ws("|", name, spec, F.lit(str(window_seconds))), 256), 1, 16)
    bucket = F.floor(F.unix_seconds(at.cast("timestamp")) / window_seconds).cast("bigint")
    return F.concat_ws("_", start, label, digest, bucket.cast("string"))


class QueryResults:
    """Results of SQL queries kept as Parquet and reused within a window.

    A result made in the present or previous bucket is reused while younger than the
    window; a failed identity is not used again, the next attempt has its own.
    """

    def __init__(self, spark: SparkSession, folder: str, window: timedelta):
        self.spark, self.folder, self.window = spark, folder.rstrip("/"), window

    def _path(self, name: str, sql: str, bucket: int, attempt: int) -> str:
        label = re.sub("[^A-Za-z0-9_-]", "_", name)[:64]
        digest = hashlib.sha256(f"{name}|{sql}|{self.window.total_seconds()}".encode()).hexdigest()[:16]
        return f"{self.folder}/{label}_{digest}_{bucket}" + (f"_r{attempt}" if attempt else "")

    def _written(self, path: str) -> datetime | None:
        """When a finished result was written; its success file says so on any file system."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return datetime.fromtimestamp(fs.getFileStatus(p).getModificationTime() / 1000, timezone.utc) if fs.exists(p) else None

    def query(self, name: str, sql: str, now: datetime | None = None, attempts: int = 3) -> DataFrame:
        now = now or datetime.now(timezone.utc)
        bucket = int(now.timestamp() // self.window.total_seconds())
        for b in (bucket, bucket - 1):
            for attempt in range(attempts):
                path = self._path(name, sql, b, attempt)
                made = self._written(path)
                if made is not None and now - made <= self.window:
                    return self.spark.read.parquet(path)
        failure: Exception | None = None
        for attempt in range(attempts):
            path = self._path(name, sql, bucket, attempt)
            try:
                self.spark.sql(sql).write.parquet(path)
                return self.spark.read.parquet(path)
            except AnalysisException as e:
                if e.getCondition() != "PATH_ALREADY_EXISTS":  # a query that is wrong stays wrong
                    raise
                failure = e  # the path is taken by a failed attempt
        raise failure
