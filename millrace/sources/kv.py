"""Wide-column tables stored as cells sorted by row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cells import CELL, Families, as_of, read_rows
from ..plans.ranges import KeyRange, predicate


def store(cells: DataFrame, path: str, partitions: int | None = None, mode: str = "overwrite") -> None:
    """Cells in files of disjoint key ranges, sorted, so that range scans skip row groups."""
    ordered = (cells.repartitionByRange(partitions, "row_key") if partitions else cells.repartitionByRange("row_key")).sortWithinPartitions("row_key", "family", "qualifier", F.desc("ts_micros"))
    ordered.select(*CELL).write.mode(mode).parquet(path)


def scan(spark: SparkSession, path: str, families: Families, ranges: Sequence[KeyRange] | None = None, ts_micros: int | None = None, key_type: str = "string") -> DataFrame:
    """Rows of the named families within key ranges, as of an instant."""
    cells = spark.read.parquet(path)
    if ranges is not None:
        cells = cells.filter(predicate(F.col("row_key"), list(ranges)))
    if ts_micros is not None:
        cells = as_of(cells, ts_micros)
    return read_rows(cells, families, key_type)
