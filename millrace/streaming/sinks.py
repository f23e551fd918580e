"""Streaming writes whose effect is once per micro-batch, also after a restart.

A batch is written to a folder named by its id and becomes visible when that write has
finished; a batch that is delivered again finds itself finished, or replaces what an
attempt has left. Readers see finished batches alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.changelog import merge, stored, visible
from ..sources import keyed
from ..sources.files import escaped, exists, finished_folders, numbers, read_text, remove, write_new

BATCH, MANIFEST = "batch-", "manifest-"


def append_once(stream: DataFrame, folder: str) -> DataStreamWriter:
    """Each row of the stream exactly once below ``folder``; read with ``committed``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id not in finished_folders(batch.sparkSession, folder, BATCH):
            batch.write.mode("overwrite").parquet(f"{folder}/{BATCH}{batch_id}")

    return stream.writeStream.foreachBatch(write)


def committed(spark: SparkSession, folder: str, schema=None) -> DataFrame:
    """The rows of all finished batches."""
    paths = [p for _, p in sorted(finished_folders(spark, folder, BATCH).items())]
    if not paths:
        if schema is None:
            raise FileNotFoundError(f"no finished batch below {folder}")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(*paths)


ROUTED = "_to"


def append_routed_once(stream: DataFrame, folder: str, destination: str) -> DataStreamWriter:
    """Each row of the stream exactly once at the destination that its column names; read with ``routed``.

    A batch writes the files of all destinations, in one pass, below a folder of its own and then one small
    file, ``log/<batch>``, that makes them visible, all or none. A batch that is
    delivered again finds its file; what an attempt has left is never named. Rows
    without a destination are an error, not lost.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if exists(spark, f"{folder}/log/{batch_id}"):
            return
        name = f"{BATCH}{batch_id}-{uuid.uuid4().hex}"
        to = F.when(F.col(destination).isNotNull(), F.col(destination).cast("string")).otherwise(F.raise_error(F.lit("a row without destination")).cast("string"))
        batch.withColumn(ROUTED, to).write.option("compression", "zstd").partitionBy(ROUTED).parquet(f"{folder}/{name}")
        found = [r[0] for r in spark.read.parquet(f"{folder}/{name}").select(ROUTED).distinct().collect()] if not batch.isEmpty() else []
        write_new(spark, f"{folder}/log/{batch_id}", json.dumps({"folder": name, "destinations": sorted(map(str, found))}))

    return stream.writeStream.foreachBatch(write)


def routed(spark: SparkSession, folder: str, destination: str, schema) -> DataFrame:
    """The rows of all committed batches at one destination."""
    kept = [json.loads(read_text(spark, f"{folder}/log/{n}")) for n in numbers(spark, f"{folder}/log")]
    names = [k["folder"] for k in kept if destination in k["destinations"]]
    if not names:
        return spark.createDataFrame([], schema)
    # only this destination's folders are listed and read
    paths = [f"{folder}/{n}/{escaped(spark, ROUTED, destination)}" for n in names]
    return spark.read.schema(schema).parquet(*paths)


#: Parts of a keyed table that are rewritten separately.
BUCKETS = 256


def upsert_once(changes: DataFrame, folder: str, key: Sequence[str], order: Sequence[Column | str], columns: Sequence[str], buckets: int = BUCKETS) -> DataStreamWriter:
    """A keyed table that follows a changelog; read with ``current``.

    Rows lie in buckets of their key. A batch rewrites only the buckets that its keys
    fall in, and then writes a manifest that names the folder of every bucket; the
    manifest makes it visible, so a batch that is delivered again finds itself done or
    replaces what an attempt has left. Each key keeps the order of its last change, so a
    late change of a lower order never wins, whatever batch it comes in.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = finished_folders(spark, folder, MANIFEST)
        if batch_id in done:
            return
        before = max((b for b in done if b < batch_id), default=None)
        held = dict(map(tuple, spark.read.parquet(done[before]).collect())) if before is not None else {}
        bucket = F.pmod(F.xxhash64(*key), F.lit(buckets))
        placed = batch.withColumn("_bucket", bucket).persist()
        try:
            touched = [r[0] for r in placed.select("_bucket").distinct().collect()]  # at most ``buckets``
            paths = [held[b] for b in touched if b in held]
            target = spark.read.parquet(*paths) if paths else stored(placed.select(*columns).limit(0), order, placed)
            merged = merge(target, placed.drop("_bucket"), key, order)
            data = f"{folder}/{BATCH}{batch_id}"
            merged.withColumn("_bucket", bucket).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(data)
            now = held | {b: f"{data}/_bucket={b}" for b in touched}
            spark.createDataFrame(list(now.items()), "bucket long, path string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/{MANIFEST}{batch_id}")
        finally:
            placed.unpersist()

    return changes.writeStream.foreachBatch(write)


def merge_once(changes: DataFrame, folder: str, key: Sequence[str], order: Sequence[Column | str], columns: Sequence[str], compact_every: int = 16, **options) -> DataStreamWriter:
    """A keyed table that follows a changelog and is merged on read; read with ``keyed.read``.

    A batch writes its last changes alone, however large the table is, and is committed
    once. Every ``compact_every`` batches the ranges with many changes are rewritten;
    ``options`` are those of ``keyed.compact``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        before = keyed.state(batch.sparkSession, folder)
        now = keyed.append(batch, folder, key, order, columns, batch_id)
        if compact_every and (before is None or now.number != before.number) and batch_id % compact_every == compact_every - 1:
            keyed.compact(batch.sparkSession, folder, **options)

    return changes.writeStream.foreachBatch(write)


def current(spark: SparkSession, folder: str, with_order: bool = False) -> DataFrame:
    """The newest finished version; ``with_order`` shows tombstones and orders as well."""
    done = finished_folders(spark, folder, MANIFEST)
    if not done:
        raise FileNotFoundError(f"no finished version below {folder}")
    paths = [r["path"] for r in spark.read.parquet(done[max(done)]).collect()]
    if not paths:
        raise FileNotFoundError(f"the table below {folder} has no rows yet")
    table = spark.read.parquet(*paths)
    return table if with_order else visible(table)


def clean(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Deletes what only versions before the last ``keep`` need, and says what that was."""
    done = finished_folders(spark, folder, MANIFEST)
    last = sorted(done)[-keep:]
    used = {r["path"].rsplit("/", 1)[0].rsplit("/", 1)[1] for b in last for r in spark.read.parquet(done[b]).collect()}
    old = [path for b, path in done.items() if b not in last]
    # data of a batch that is not finished yet has a higher number
    old += [path for b, path in finished_folders(spark, folder, BATCH).items() if last and b <= last[-1] and f"{BATCH}{b}" not in used]
    for path in old:
        remove(spark, path)
    return old


def for_each_once(stream: DataFrame, folder: str, act: Callable[[DataFrame, int], DataFrame]) -> DataStreamWriter:
    """Calls ``act`` on each batch and keeps what it returns, once per batch id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id not in finished_folders(batch.sparkSession, folder, BATCH):
            act(batch, batch_id).write.mode("overwrite").parquet(f"{folder}/{BATCH}{batch_id}")

    return stream.writeStream.foreachBatch(write)
