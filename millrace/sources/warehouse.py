"""Warehouse tables: column-pruned scans, snapshots, queries, and append or replace writes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import exists


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None, row_restriction: str | None = None, max_streams: int | None = None) -> DataFrame:
    """A table's rows; the restriction and the columns reach the Parquet scan."""
    df = spark.read.parquet(path)
    if row_restriction:
        df = df.where(row_restriction)
    if columns is not None:
        df = df.select(*columns)
    # only ever merges read tasks, as a bound on parallel streams does
    return df.coalesce(max_streams) if max_streams else df


def snapshot(versions: DataFrame, key: Sequence[str], version_time: str, at: datetime | Column, deleted: Column | None = None) -> DataFrame:
    """A versioned table as of an instant: per key its last version until then, unless deleted."""
    rest = [c for c in versions.columns if c not in set(key)]
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    until = versions.filter(F.col(version_time) <= (at if isinstance(at, Column) else F.lit(at)))
    last = until.withColumn("_gone", gone).groupBy(*key).agg(F.max_by(F.struct("_gone", *rest), version_time).alias("_v"))
    return last.filter(~F.col("_v._gone")).select(*key, *[F.col(f"_v.{c}").alias(c) for c in rest])


def as_declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in a table's columns and types: missing ones are null, further ones are refused, casts are checked."""
    declared = {f.name.lower() for f in schema.fields}
    if further := [c for c in df.columns if c.lower() not in declared]:
        raise ValueError(f"the table has no columns {further}")
    given = {c.lower() for c in df.columns}
    return df.select(*[(F.col(f.name) if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def write(df: DataFrame, path: str, disposition: str = "append", create: str = "if_needed", partition_by: Column | None = None, cluster_by: Sequence[str] = (), max_records_per_file: int = 0, streaming: bool = False) -> None:
    """Writes a table: ``append``, ``truncate``, ``truncate-data`` or ``empty`` (only into an absent one).

    ``truncate`` takes the new rows' schema; ``truncate-data`` keeps the table's, and
    refuses rows that do not fit it.

    ``create="never"`` needs the table. At most four cluster columns order the rows of
    each file; ``partition_by``, for example ``date_trunc``, makes folders.
    """
    if disposition not in ("append", "truncate", "truncate-data", "empty"):
        raise ValueError(f"no write disposition {disposition}")
    if streaming and disposition != "append":
        raise ValueError("streams only append")
    if len(cluster_by) > 4:
        raise ValueError("at most four cluster columns")
    if create == "never" and not exists(df.sparkSession, path):
        raise FileNotFoundError(path)
    if disposition == "truncate-data" and exists(df.sparkSession, path):
        df = as_declared(df, df.sparkSession.read.parquet(path).schema)
    out = df.withColumn("_partition", partition_by) if partition_by is not None else df
    if cluster_by:
        out = out.sortWithinPartitions(*(["_partition"] if partition_by is not None else []), *cluster_by)
    mode = {"append": "append", "truncate": "overwrite", "truncate-data": "overwrite", "empty": "errorifexists"}[disposition]
    writer = out.write.mode(mode).option("compression", "zstd")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    (writer.partitionBy("_partition") if partition_by is not None else writer).parquet(path)
