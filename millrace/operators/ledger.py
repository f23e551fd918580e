"""Partition ledgers of change streams: frontier, lineage, merges and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ranges import coalesced, gaps


def frontier(ledger: DataFrame, state: str = "state", watermark: str = "watermark_ms", by: list[str] | None = None) -> DataFrame:
    """The source watermark: 1 ms before the earliest unfinished partition, null if none is left."""
    lowest = F.min(F.when(F.col(state) != "FINISHED", F.col(watermark))) - 1
    return ledger.groupBy(*(by or [])).agg(lowest.alias("frontier_ms"))


def advance(previous: Column, current: Column) -> Column:
    """The frontier never goes back."""
    return F.greatest(previous, current)


def schedulable(partitions: DataFrame, edges: DataFrame) -> DataFrame:
    """Created partitions of which every known parent is finished.

    ``partitions`` has token and state, ``edges`` child and parent; a parent that is in
    no ledger row does not hold its children back.
    """
    pending = partitions.filter("state <> 'FINISHED'").select(F.col("token").alias("parent"))
    held = edges.join(pending, "parent", "left_semi").select(F.col("child").alias("token"))
    return partitions.filter("state = 'CREATED'").join(held, "token", "left_anti")


def merged(parents: DataFrame) -> DataFrame:
    """New partitions whose parents' ranges tile them, with all tokens and the lowest watermark.

    ``parents`` has target_start, target_end (null: unbounded), start, end, token and
    watermark_ms. Repeated transitions count once.
    """
    by = ["target_start", "target_end"]
    once = parents.dropDuplicates([*by, "start", "end", "token"])
    whole = coalesced(once.select(*by, "start", "end"), by, small_groups=True)
    reaches = F.col("end").isNull() | F.coalesce(F.col("end") >= F.col("target_end"), F.lit(False))
    covered = whole.filter((F.col("start") <= F.col("target_start")) & reaches).select(*by).withColumn("_covered", F.lit(True))
    same = once["target_start"].eqNullSafe(covered["target_start"]) & once["target_end"].eqNullSafe(covered["target_end"])
    return once.join(covered, same, "left_semi").groupBy(*by).agg(F.array_sort(F.collect_set("token")).alias("tokens"), F.min("watermark_ms").alias("watermark_ms"))


def missing(ledger: DataFrame, by: list[str]) -> DataFrame:
    """Ranges between those that the ledger covers."""
    return gaps(ledger, by)


def recovery(missing_ranges: DataFrame, now_ms: Column, with_tokens_after_ms: int = 120_000, without_after_ms: int = 1_200_000) -> DataFrame:
    """What to do about missing ranges: WAIT, RESUME with their tokens, or RESTART without.

    ``missing_ranges`` has missing_since_ms and has_tokens.
    """
    age = now_ms - F.col("missing_since_ms")
    action = F.when(F.col("has_tokens") & (age >= with_tokens_after_ms), "RESUME").when(age >= without_after_ms, "RESTART").otherwise("WAIT")
    return missing_ranges.withColumn("action", action)
