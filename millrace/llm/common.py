"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than this share of all rows is hot; there are at most so many hot keys.
HOT_KEYS = 10_000

#: Words are maximal runs of anything but the ASCII blanks.
WORD = "[^\\x20\\x09-\\x0D]+"
BLANK = "[\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where this machine has a tokenizer: a bare name is one of the public tokenizers, anything else a path."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is the cluster's ``spark.checkpoint.dir``; only a session without one (a
    test) gets a local folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file system for a path has it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from the shared folder, without its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def text_digest(text: Column) -> Column:
    """128 bits of a text's SHA-256, which stand for the text."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside nested lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column's name as a reference to it, also with dots."""
    return "`" + name.replace("`", "``") + "`"


def joined_by_key(rows: DataFrame, key: str, table: DataFrame, table_key: str, count: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for each key that occurs.

    ``count`` is the column of ``table`` that says how many of the ``total`` rows have the
    key. The hot keys, over total / HOT_KEYS rows each and so fewer than HOT_KEYS, are
    broadcast and their rows stay where they are; only the others are shuffled.
    """
    is_hot = F.col(count) > total // HOT_KEYS
    by_key = F.col(key) == F.col(table_key)
    hot = F.broadcast(table.filter(is_hot))
    found = rows.join(hot, by_key)
    others = rows.join(F.broadcast(table.filter(is_hot).select(table_key)), by_key, "left_anti").join(table.filter(~is_hot), by_key)
    return found.unionByName(others)
