"""Relational tables with a declared primary key, their indexes, and keyed writes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changelog import DELETED, ORDER, ROW_KIND, merge, stored, visible
from ..plans.keysets import Condition, select
from . import keyed
from .files import finished_folders, has_rows


@dataclass
class Index:
    """A stored projection, sorted by other columns than the table."""

    path: str
    key: Sequence[str]
    columns: Sequence[str]
    ready: bool = True
    null_filtered: bool = False


def store(df: DataFrame, path: str, primary_key: Sequence[str], partitions: int | None = None) -> None:
    """A table in files of disjoint key ranges, sorted by its key."""
    ordered = (df.repartitionByRange(partitions, *primary_key) if partitions else df.repartitionByRange(*primary_key)).sortWithinPartitions(*primary_key)
    ordered.write.mode("overwrite").parquet(path)


def scan(spark: SparkSession, path: str, primary_key: Sequence[str], columns: Sequence[str] | None = None, conditions: Sequence[Condition] = ()) -> DataFrame:
    """Rows that meet all conditions; those on the key prune files, a contradiction reads nothing."""
    df = select(list(primary_key), list(conditions)).apply(spark.read.parquet(path))
    return df.select(*columns) if columns is not None else df


def index_scan(spark: SparkSession, index: Index, columns: Sequence[str], conditions: Sequence[Condition] = ()) -> DataFrame:
    """Rows read through an index alone; it must be complete, ready and hold the columns.

    An index that leaves out null keys serves only conditions that do so as well.
    """
    if not index.ready:
        raise ValueError("the index is not ready to be read")
    wanted = {*columns, *(c.column for c in conditions)}
    if lacking := wanted - set(index.columns):
        raise ValueError(f"the index does not hold {sorted(lacking)}")
    if index.null_filtered and not set(index.key) <= {c.column for c in conditions}:
        raise ValueError("an index without null keys needs conditions on its keys")
    return select(list(index.key), list(conditions)).apply(spark.read.parquet(index.path)).select(*columns)


def upsert(target: DataFrame, changes: DataFrame, primary_key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The table after a changelog; without a primary key only inserts are possible.

    A stored table (see ``changelog.merge``) stays one and never loses a newer change to
    a late one; a plain table's rows are older than any change.
    """
    if not primary_key:
        bad = F.when(F.col(ROW_KIND) == "+I", F.col(ROW_KIND)).otherwise(F.raise_error(F.lit("a table without key only takes inserts")).cast("string"))
        return target.unionByName(changes.withColumn(ROW_KIND, bad).filter(f"{ROW_KIND} = '+I'").select(*target.columns))
    merged = merge(target, changes, primary_key, order)
    return merged if {ORDER, DELETED} <= set(target.columns) else visible(merged)


VERSION = "version-"


def versions(spark: SparkSession, folder: str) -> dict[int, str]:
    """The finished versions of a table that follows a changelog."""
    return finished_folders(spark, folder, VERSION)


def next_version(before: DataFrame | None, changes: DataFrame, folder: str, number: int, primary_key: Sequence[str], order: Sequence[str]) -> None:
    """Writes the version after ``changes``; readers see it once it is finished."""
    columns = [c for c in changes.columns if c != ROW_KIND]
    target = before if before is not None else stored(changes.select(*columns).limit(0), order, changes)
    merge(target, changes, primary_key, order).write.mode("overwrite").parquet(f"{folder}/{VERSION}{number}")


def read_current(spark: SparkSession, folder: str) -> DataFrame:
    if follows(spark, folder):
        return read_followed(spark, folder)
    done = versions(spark, folder)
    if not done:
        raise FileNotFoundError(f"no finished version below {folder}")
    return visible(spark.read.parquet(done[max(done)]))


#: Where a table that follows a changelog keeps its commits, hidden from plain readers of its folder.
FOLLOWED = "_keyed"


def follows(spark: SparkSession, path: str) -> bool:
    """Whether the table follows a changelog."""
    return keyed.exists(spark, f"{path.rstrip('/')}/{FOLLOWED}")


def follow(changes: DataFrame, path: str, key: Sequence[str], order: Sequence[str], **options) -> None:
    """Applies changes to a table, of which a commit writes no more than the changes.

    Rows that were written before the first change are older than any and stay. Rows
    without ``_row_kind`` are inserts; they need the order columns, as without these
    nothing says whether they are newer than what the table has.
    """
    spark, path = changes.sparkSession, path.rstrip("/")
    if ROW_KIND not in changes.columns:
        if lacking := set(order) - set(changes.columns):
            raise ValueError(f"the table follows a changelog, so its rows need {sorted(lacking)}")
        changes = changes.withColumn(ROW_KIND, F.lit("+I"))
    folder = f"{path}/{FOLLOWED}"
    if not keyed.exists(spark, folder) and has_rows(spark, path):
        keyed.adopt(spark.read.parquet(path), folder, key, order, changes)
    keyed.append(changes, folder, key, order, **options)


def read_followed(spark: SparkSession, path: str) -> DataFrame:
    return keyed.read(spark, f"{path.rstrip('/')}/{FOLLOWED}")


#: What to do with a row that violates a constraint.
VIOLATION_POLICIES = ("fail", "route")


def checked(df: DataFrame, constraints: dict[str, Column], policy: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Rows that meet all constraints, and those that do not with the names of what they violate.

    Under ``fail`` the first violation fails the query and the second part is empty;
    under ``route`` the violators are for a dead-letter table. A null is no violation.
    """
    if policy not in VIOLATION_POLICIES:
        raise ValueError(f"no constraint-violation policy {policy}")
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in constraints.items()]))
    tried = df.withColumn("_violates", broken)
    if policy == "fail":
        refuse = F.raise_error(F.concat(F.lit("constraint violated: "), F.array_join("_violates", ", "))).cast("boolean")
        good = tried.filter(F.when(F.size("_violates") == 0, True).otherwise(refuse))
        return good.drop("_violates"), tried.limit(0).withColumnRenamed("_violates", "violates")
    return tried.filter(F.size("_violates") == 0).drop("_violates"), tried.filter(F.size("_violates") > 0).withColumnRenamed("_violates", "violates")
