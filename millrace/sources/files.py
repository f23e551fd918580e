"""Small questions to the file system that Spark itself uses for a path."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``; only a local session without one gets a folder of its own."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="millrace-"))
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, with its partitions and their order, and read back from the cluster's shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def finished_names(spark: SparkSession, folder: str, prefix: str) -> dict[str, str]:
    """Name behind the prefix -> path of the folders that hold a finished write."""
    fs, p = _fs(spark, f"{folder}/{prefix}*/_SUCCESS")
    parents = [status.getPath().getParent() for status in fs.globStatus(p) or []]
    return {parent.getName()[len(prefix) :]: parent.toString() for parent in parents}


def finished_folders(spark: SparkSession, folder: str, prefix: str) -> dict[int, str]:
    """Number -> path of the folders ``prefix<number>`` that hold a finished write."""
    return {int(name): path for name, path in finished_names(spark, folder, prefix).items()}


#: Characters that partition folders write as % and two hex digits, besides control characters.
_ESCAPED = '"#%\'*/:=?\\\x7f{[]^'


def escaped(spark: SparkSession, column: str, value: str) -> str:
    """The name of a partition's folder."""
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in value)


def has_rows(spark: SparkSession, folder: str) -> bool:
    """Whether a finished write has left visible Parquet files right in the folder."""
    fs, p = _fs(spark, f"{folder}/[!._]*.parquet")
    return bool(fs.globStatus(p))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file whole, or says that the path is taken; of several writers one wins."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    aside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    kind = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(kind, 1)
    options[0] = kind.NONE  # a rename that never replaces
    try:
        spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(aside, p, options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in str(e.java_exception):
            raise
        return False
    finally:
        fs.delete(aside, False)


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The files of a folder that are named by a number, in order."""
    fs, p = _fs(spark, f"{folder}/[0-9]*")
    return sorted(int(s.getPath().getName()) for s in fs.globStatus(p) or [] if s.getPath().getName().isdigit())
