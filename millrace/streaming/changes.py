"""Change streams: records in files, a frontier that gates them, and deduplication."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.changelog import RECORD
from ..operators.ledger import frontier
from ..sources.files import finished_folders
from .sinks import BATCH


def read(spark: SparkSession, folder: str, schema: str = RECORD, start: datetime | None = None, end: datetime | None = None, max_files: int | None = None) -> DataFrame:
    """A stream of change records with commit times in [start, end)."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.parquet(folder)
    if start is not None:
        df = df.filter(F.col("commit_ts") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("commit_ts") < F.lit(end))
    return df


def release_to_frontier(batch: DataFrame, held: DataFrame | None, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that no unfinished partition can precede any more, and those that have to wait.

    Everything up to the frontier goes out, so a zero-delay watermark on what is
    released drops nothing that may still come. A record without commit time waits, as
    nothing says that it is due.
    """
    waiting = batch if held is None else held.unionByName(batch)
    limit = frontier(ledger).first()[0]  # the ledger folds to one number
    if limit is None:
        return waiting, waiting.limit(0)
    due = F.coalesce(F.unix_millis("commit_ts") <= limit, F.lit(False))
    return waiting.filter(due), waiting.filter(~due)


def gated(stream: DataFrame, folder: str, ledger) -> DataStreamWriter:
    """Writes released records to ``folder/out`` and keeps the rest in ``folder/held``, once per batch.

    ``ledger`` is called for each batch and returns the partitions' states.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = finished_folders(spark, f"{folder}/held", BATCH)
        if batch_id in done:
            return
        before = [p for b, p in sorted(done.items()) if b < batch_id]
        out, held = release_to_frontier(batch, spark.read.parquet(before[-1]) if before else None, ledger(spark))
        out.write.mode("overwrite").parquet(f"{folder}/out/{BATCH}{batch_id}")
        # the held rows come last: with them the batch is complete
        held.write.mode("overwrite").parquet(f"{folder}/held/{BATCH}{batch_id}")

    return stream.writeStream.foreachBatch(write)


def deduplicated(stream: DataFrame, key: list[str], event_time: str, horizon: str) -> DataFrame:
    """Each key once within a horizon of event time."""
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(key)


def latest_by_window(stream: DataFrame, event_time: str, delay: str, width: str, key: list[str], values: Column) -> DataFrame:
    """Per key and window the value of the last event, for late data up to ``delay``."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width), *key).agg(F.max_by(values, event_time).alias("value"))
