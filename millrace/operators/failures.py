"""What happens to rows that fail: stop the job, drop and count them, or keep them aside."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.formats import truncate_utf8

#: Columns of a dead letter.
DEAD_LETTER = ["payload", "dlq_connector", "dlq_destination", "dlq_error", "dlq_timestamp", "dlq_partition"]


def split(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid rows; a null verdict counts as invalid."""
    verdict = F.coalesce(valid, F.lit(False))
    return df.filter(verdict), df.filter(~verdict)


def fail_job(df: DataFrame, valid: Column, message: str) -> DataFrame:
    """The rows; an invalid one fails the query."""
    return df.filter(F.when(F.coalesce(valid, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def log_and_drop(df: DataFrame, valid: Column, name: str = "dropped") -> DataFrame:
    """The valid rows; the number of others is observed under ``name``."""
    verdict = F.coalesce(valid, F.lit(False))
    return df.observe(name, F.count(F.when(~verdict, 1)).alias("rows")).filter(verdict)


def dead_letters(df: DataFrame, payload: Column, error: Column, connector: str, destination: Column | str, at: Column | None = None) -> DataFrame:
    """Failed rows as dead letters; long errors are cut at the attribute limit."""
    target = F.lit(destination) if isinstance(destination, str) else destination
    return df.select(
        payload.alias("payload"),
        F.lit(connector).alias("dlq_connector"),
        target.alias("dlq_destination"),
        truncate_utf8(error).alias("dlq_error"),
        (at if at is not None else F.current_timestamp()).alias("dlq_timestamp"),
        F.spark_partition_id().alias("dlq_partition"),
    )


def handle(df: DataFrame, valid: Column, policy: str, message: str, payload: Column, connector: str, destination: str, dead_letter_folder: str | None = None) -> DataFrame:
    """The rows that go on under a policy: ``fail``, ``drop`` or ``dead_letter``."""
    if policy == "fail":
        return fail_job(df, valid, message)
    if policy == "drop":
        return log_and_drop(df, valid)
    if policy == "dead_letter":
        if dead_letter_folder is None:
            raise ValueError("the dead-letter policy needs a folder")
        good, bad = split(df, valid)
        dead_letters(bad, payload, F.lit(message), connector, destination).write.mode("append").parquet(dead_letter_folder)
        return good
    raise ValueError(f"no failure policy {policy}")


def isolate(df: DataFrame, batch: str, rejected: Column, alone: Column) -> DataFrame:
    """Which rows of rejected batches are to blame.

    A batch's rejection only makes its rows suspects: each counts as failed only where
    it is rejected ``alone`` as well; the rest of the batch goes through. Rows without a
    batch are one batch.
    """
    suspects = df.groupBy(F.col(batch).alias("_batch")).agg(F.max(F.coalesce(rejected, F.lit(False))).alias("_suspect"))
    judged = df.join(suspects, F.col(batch).eqNullSafe(F.col("_batch")))
    return judged.withColumn("failed", F.col("_suspect") & F.coalesce(alone, F.lit(False))).drop("_suspect", "_batch")


class Rejected(Exception):
    """A call was refused for the rows it holds; which of them, it doesn't say."""


def sent(df: DataFrame, batch: str, send: Callable[[list[dict]], None], order: str | None = None, most: int | None = None) -> DataFrame:
    """Sends the rows batch by batch through a client call and says which have ``failed``, and why (``error``).

    A batch that ``send`` refuses with ``Rejected`` is halved and sent again until the
    refused calls hold one row each; only these have failed, so a batch of n rows with k
    bad ones takes at most 1 + 2 k log2(n) calls or so. Any other error fails the task, and a
    task that runs again sends its rows again. ``most`` confirmed failures in a row, in the
    order of a batch's rows, fail the query (``MAX_CONSECUTIVE``). A batch is held by one
    task; null batches are one.
    """
    names = df.columns
    limit = MAX_CONSECUTIVE if most is None else most
    schema = T.StructType([*df.schema.fields, T.StructField("failed", T.BooleanType()), T.StructField("error", T.StringType())])

    def run(batches):
        in_a_row = 0

        def verdicts(rows: list[dict]) -> list[str | None]:
            nonlocal in_a_row
            try:
                send(rows)
                in_a_row = 0
                return [None] * len(rows)
            except Rejected as e:
                if len(rows) > 1:
                    half = len(rows) // 2
                    return verdicts(rows[:half]) + verdicts(rows[half:])
                in_a_row += 1
                if in_a_row >= limit:
                    raise RuntimeError(f"{in_a_row} rejections in a row: {e}") from e
                return [str(e)]

        def judged(held: list[pa.RecordBatch]) -> pa.Table:
            nonlocal in_a_row
            in_a_row = 0
            table = pa.Table.from_batches(held)
            errors = verdicts(table.to_pylist())
            return table.append_column("failed", pa.array([e is not None for e in errors])).append_column("error", pa.array(errors, pa.string()))

        held, last = [], None
        for rows in batches:
            keys = rows.column(batch).to_pylist()
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for low, high in zip(edges, edges[1:]):
                if low == high:
                    continue
                if held and keys[low] != last:
                    yield from judged(held).to_batches()
                    held = []
                last = keys[low]
                held.append(rows.slice(low, high - low))
        if held:
            yield from judged(held).to_batches()

    by = [batch, *([order] if order else [])]
    return df.repartition(batch).sortWithinPartitions(*by).select(*names).mapInArrow(run, schema)


#: Confirmed rejections in a row after which a dropping policy gives up.
MAX_CONSECUTIVE = 100


def stop_after_consecutive(df: DataFrame, lane: str, order: str, failed: str = "failed", most: int = MAX_CONSECUTIVE) -> DataFrame:
    """The rows; ``most`` confirmed failures in a row within a lane fail the query, as then the table is at fault, not the rows."""
    w = Window.partitionBy(lane).orderBy(order)
    good = F.sum(F.when(F.col(failed), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    run = F.sum(F.when(F.col(failed), 1).otherwise(0)).over(Window.partitionBy(lane, "_good").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    counted = df.withColumn("_good", good).withColumn("_run", run)
    refuse = F.raise_error(F.format_string("%d rejections in a row", F.col("_run"))).cast("boolean")
    return counted.filter(F.when(F.col("_run") < most, True).otherwise(refuse)).drop("_good", "_run")
