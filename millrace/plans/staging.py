"""Which staged files a load commits together, in DataFrame operations.

Files of one destination and format are loaded in the order of their names, as many at
once as the limits on files and bytes admit. One load per destination goes straight to
its table; more go to temporary tables that copies then gather, level by level.
Identities are digests of what a load holds, so planning again names the same loads.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..sources.files import checkpointed, finished_names

# Limits of a load and of a copy.
MAX_FILES = 10_000
MAX_BYTES = 11 * 1024**4
COPY_FAN_IN = 1_200
STAGING_BYTES = 16 * 1024**2


def plan_loads(files: DataFrame, max_files: int = MAX_FILES, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Each file with its load: the columns of ``files`` and load_index.

    ``files`` has destination, format, uri, bytes and rows.
    """
    counted = files.withColumn("_one", F.lit(1))
    batched = greedy_batches(counted, ["destination", "format"], "uri", {"_one": max_files, "bytes": max_bytes})
    return batched.drop("_one").withColumnRenamed("batch", "load_index")


def loads(planned: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """One row per load with its digest, and whether it may go straight to its table."""
    grouped = planned.groupBy("destination", "format", "load_index").agg(
        F.count("*").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sum("rows").alias("rows"),
        # uris in order, digested in two steps so that no group has to be one string
        F.sha2(F.array_join(F.array_sort(F.collect_list(F.sha2("uri", 256))), ","), 256).alias("_uris"),
    )
    suffix = F.lit(f"-c{checkpoint}" if checkpoint else "")
    per_destination = F.count("*").over(Window.partitionBy("destination"))
    return grouped.withColumns(
        {"load_id": F.concat(F.substring(F.sha2(F.concat_ws("|", "destination", "format", "_uris"), 256), 1, 32), suffix), "direct": per_destination == 1}
    ).drop("_uris")


LOAD = "load-"


def run_loads(spark: SparkSession, planned: DataFrame, folder: str, checkpoint: str | None = None) -> list[str]:
    """Loads the staged Parquet files of every planned load, each once, and says which loads were new.

    A load goes to a folder named by its identity below its destination's and is visible
    once finished (``loaded``), so a run that was cut short goes on where it stopped.
    The driver sees loads and file names, never rows. Where a service would gather
    temporary tables by copies, one job reads all files of a load.
    """
    out = []
    ids = loads(planned, checkpoint).select("destination", "format", "load_index", "load_id")
    members = planned.join(ids, ["destination", "format", "load_index"]).groupBy("destination", "load_id").agg(F.array_sort(F.collect_list("uri")).alias("uris"))
    for row in members.orderBy("destination", "load_id").collect():
        place = f"{folder}/{row['destination']}"
        done = finished_names(spark, place, LOAD)
        if row["load_id"] in done:
            continue
        spark.read.parquet(*row["uris"]).write.mode("overwrite").parquet(f"{place}/{LOAD}{row['load_id']}")
        out.append(row["load_id"])
    return out


def loaded(spark: SparkSession, folder: str, destination: str) -> DataFrame:
    """The rows of all finished loads of a destination."""
    place = f"{folder}/{destination}"
    names = finished_names(spark, place, LOAD)
    if not names:
        raise FileNotFoundError(f"no finished load below {place}")
    return spark.read.option("mergeSchema", "true").parquet(*[f"{place}/{LOAD}{n}" for n in sorted(names)])


def copy_levels(load_count: int, fan_in: int = COPY_FAN_IN) -> list[int]:
    """How many copies each level makes until one table is left."""
    out = []
    while load_count > 1:
        load_count = -(-load_count // fan_in)
        out.append(load_count)
    return out


class _Segment:
    """The rows of a group in one partition: how they follow the group's earlier ones, and where a batch from each row ends.

    Rows have their number in the segment; the next start of row i is the first row
    behind it with which a batch from i would exceed a limit, or ``n``.
    """

    def __init__(self, sizes: np.ndarray, limits: np.ndarray):
        self.n = sizes.shape[1]
        #: Totals before each row, and behind the last.
        self.sums = np.concatenate([np.zeros((len(sizes), 1), np.int64), np.cumsum(sizes, axis=1)], axis=1)
        self.limits = limits

    def first_over(self, carried: np.ndarray) -> np.ndarray:
        """For each column of ``carried`` (totals from a batch's start to the segment's, may be negative) the first row that exceeds a limit, or n."""
        over = [np.searchsorted(s[1:], limit - c, "right") for s, c, limit in zip(self.sums, carried, self.limits[:, 0])]
        return np.min(over, axis=0)

    def successors(self) -> np.ndarray:
        own = np.arange(self.n)
        return np.maximum(self.first_over(-self.sums[:, : self.n]), own + 1)

    def last_starts(self, following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the last start of the batches that begin with it, and how many starts that are: pointer doubling."""
        stop = following >= self.n
        at, count = np.where(stop, np.arange(self.n), following), np.where(stop, 1, 2)
        while True:
            further = at[at]
            if (further == at).all():
                return at, count
            count, at = count + count[at] - 1, further


def _of_batch(rows: pa.RecordBatch, by: list[str], sizes: dict[str, int]) -> tuple[list[tuple], np.ndarray]:
    own = np.array([rows.column(c).cast(pa.int64()).fill_null(0).to_numpy() for c in sizes], np.int64).reshape(len(sizes), -1)
    return list(zip(*(rows.column(c).to_pylist() for c in by))), own


def _segments(batches, by: list[str], sizes: dict[str, int]):
    """Whole segments of a partition, one at a time: key, their record batches and sizes."""
    key, held, own = None, [], []
    for rows in batches:
        keys, numbers = _of_batch(rows, by, sizes)
        edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for low, high in zip(edges, edges[1:]):
            if low == high:
                continue
            if held and keys[low] != key:
                yield key, held, np.concatenate(own, axis=1)
                held, own = [], []
            key = keys[low]
            held.append(rows.slice(low, high - low))
            own.append(numbers[:, low:high])
    if held:
        yield key, held, np.concatenate(own, axis=1)


def greedy_batches(df: DataFrame, by: list[str], order: str, sizes: dict[str, int]) -> DataFrame:
    """Numbers consecutive rows of each group into batches: a new one begins where a limit would overflow.

    ``sizes`` maps a whole-number column, not negative, to its limit in a batch; a null size counts as
    0. Limits are checked before a row is added, never against an empty batch, so a row
    that alone exceeds one is a batch of its own. Null keys form one group.

    Where a batch ends depends on where the last one did, but where one that begins with
    a given row would end does not. Rows lie in range partitions of group and order. A
    group within a partition is cut there. For the part of a larger group in a
    partition, binary search on prefix sums finds each row's next start, and doubling
    these pointers the last start that it leads to. Only rows whose next start lies in a
    later partition go on: they are sent there with their totals, and get the next
    partition's last start that they lead to. Doubling the pointers between these finds the ones that
    count, at most one for each partition; so one group is spread over all tasks, whose
    memory holds one partition's rows.
    """
    if not by:
        raise ValueError("batches need a grouping")
    limits = np.array(list(sizes.values()), np.int64)[:, None]
    names = df.columns
    placed = checkpointed(df.select(*names).repartitionByRange(*by, order).sortWithinPartitions(*by, order))
    parts = _spanning(placed, by, sizes)
    entries = _entries(placed, parts, by, sizes, limits) if parts else {}

    def run(batches):
        p = TaskContext.get().partitionId()
        for place, (_, held, own) in enumerate(_segments(batches, by, sizes)):
            segment = _Segment(own, limits)
            known = entries.get((p, place == 0))
            first, number = known if known else (0, 0)
            starts = np.zeros(segment.n + 1, np.int64)
            following = segment.successors()
            at = first
            while at < segment.n:
                starts[at] = 1
                at = int(following[at])
            numbers = np.cumsum(starts[: segment.n]) + number - 1
            s = 0
            for rows in held:
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(numbers[s : s + rows.num_rows])], names=[*names, "batch"])
                s += rows.num_rows

    return placed.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())]))


def _spanning(placed: DataFrame, by: list[str], sizes: dict[str, int]) -> list[list[tuple]]:
    """The groups that several partitions hold: their parts (partition, whether its first group, rows, totals), in order.

    Of each partition the driver sees its first and its last group, however many it has.
    """
    kind = placed.select(*by).schema.add("p", T.IntegerType()).add("first", T.BooleanType()).add("rows", T.LongType()).add("totals", T.ArrayType(T.LongType()))

    def run(batches):
        p, last, place = TaskContext.get().partitionId(), None, 0
        out = []
        for place, (key, held, own) in enumerate(_segments(batches, by, sizes)):
            last = (*key, p, place == 0, own.shape[1], own.sum(axis=1).tolist())
            if place == 0:
                out.append(last)
        if place > 0:
            out.append(last)
        columns = list(zip(*out)) if out else [()] * len(kind)
        yield pa.RecordBatch.from_arrays([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, kind)], names=kind.names)

    found = placed.select(*by, *[c for c in sizes if c not in by]).mapInArrow(run, kind).collect()
    groups: dict[tuple, list] = {}
    for r in sorted(found, key=lambda r: (r["p"], not r["first"])):
        groups.setdefault(tuple(r[: len(by)]), []).append((r["p"], r["first"], r["rows"], r["totals"]))
    return [g for g in groups.values() if len(g) > 1]


def _entries(placed: DataFrame, groups: list[list[tuple]], by: list[str], sizes: dict[str, int], limits: np.ndarray) -> dict[tuple, tuple[int, int]]:
    """(partition, whether its first group) -> the first start in it, and its batch's number: of every part of a spanning group."""
    # the parts of all groups by number, with the totals of their group before them and behind them
    number, before, behind, ends = {}, [], [], []
    for group in groups:
        total = np.zeros(len(sizes), np.int64)
        for p, first, rows, totals in group:
            number[p, first] = len(before)
            before.append(total)
            total = total + np.array(totals, np.int64)
            behind.append(total)
        ends += [len(before)] * len(group)
    before, behind = np.array(before), np.array(behind)
    columns = [f"total{k}" for k in range(len(sizes))]

    def tails(batches):
        """Rows whose batch goes on into a later part, as (from: part, row; to: part), with the batch's totals until there."""
        p = TaskContext.get().partitionId()
        for place, (_, _, own) in enumerate(_segments(batches, by, sizes)):
            part = number.get((p, place == 0))
            if part is None or part + 1 == ends[part]:
                continue
            segment = _Segment(own, limits)
            row = np.flatnonzero(segment.successors() >= segment.n)
            start = before[part][:, None] + segment.sums[:, row]
            # the first later part that exceeds a limit
            later = behind[part + 1 : ends[part]]
            to = part + 1 + np.min([np.searchsorted(later[:, k], start[k] + limits[k, 0], "right") for k in range(len(sizes))], axis=0)
            go = to < ends[part]
            arrays = [np.full(go.sum(), part), row[go], to[go], *(before[to[go], k] - start[k][go] for k in range(len(sizes)))]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["part", "row", "to", *columns])

    def own_sizes(batches):
        p = TaskContext.get().partitionId()
        for place, (_, _, own) in enumerate(_segments(batches, by, sizes)):
            if (part := number.get((p, place == 0))) is not None:
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([own.tobytes()], pa.binary())], names=["part", "sizes"])

    def arrive(left: pa.Table, right: pa.Table) -> pa.Table:
        """Where tails enter a part, how many starts it has from there, and the last of them."""
        own = np.frombuffer(right.column("sizes")[0].as_py(), np.int64).reshape(len(sizes), -1)
        segment = _Segment(own, limits)
        last, count = segment.last_starts(segment.successors())
        entry = segment.first_over(np.array([left.column(c).to_numpy() for c in columns]).reshape(len(sizes), -1))
        arrays = [left.column("part"), left.column("row"), left.column("to"), pa.array(entry), pa.array(last[entry]), pa.array(count[entry])]
        return pa.table(arrays, names=["part", "row", "to", "entry", "last", "count"])

    def begin(batches):
        """From the first row of a group its last start in the first part."""
        p = TaskContext.get().partitionId()
        for place, (_, _, own) in enumerate(_segments(batches, by, sizes)):
            part = number.get((p, place == 0))
            if part is not None and (part == 0 or ends[part - 1] == part):
                segment = _Segment(own, limits)
                last, count = segment.last_starts(segment.successors())
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (part, last[0], count[0])], names=["part", "row", "count"])

    needed = placed.select(*by, *[c for c in sizes if c not in by])
    out = needed.mapInArrow(tails, "part long, row long, to long, " + ", ".join(f"{c} long" for c in columns))
    held = needed.mapInArrow(own_sizes, "part long, sizes binary")
    hops = checkpointed(out.groupBy("to").cogroup(held.groupBy("part")).applyInArrow(lambda left, right: arrive(left, right) if left.num_rows else _NO_HOPS, "part long, row long, to long, entry long, last long, count long"))
    firsts = checkpointed(needed.mapInArrow(begin, "part long, row long, count long"))
    # tails that batches of the first rows lead to: after k rounds those within 2^k hops
    reached = firsts.select("part", "row")
    leap = hops.select("part", "row", F.col("to").alias("to_part"), F.col("last").alias("to_row"))
    for _ in range(max(len(g) for g in groups).bit_length()):
        reached = checkpointed(reached.unionByName(reached.join(leap, ["part", "row"]).select(F.col("to_part").alias("part"), F.col("to_row").alias("row"))).distinct())
        over = leap.select(F.col("part").alias("to_part"), F.col("row").alias("to_row"), F.col("to_part").alias("p2"), F.col("to_row").alias("r2"))
        leap = checkpointed(leap.join(over, ["to_part", "to_row"]).select("part", "row", F.col("p2").alias("to_part"), F.col("r2").alias("to_row")))
    # at most one a part: where its first batch begins, and how many begin in it
    begun = {r["to"]: (r["entry"], r["count"]) for r in hops.join(reached, ["part", "row"], "left_semi").select("to", "entry", "count").distinct().collect()}
    begun |= {r["part"]: (0, r["count"]) for r in firsts.collect()}
    found = {}
    for group in groups:
        batch = 0
        for p, first, rows, _ in group:
            entry, count = begun.get(number[p, first], (rows, 0))
            found[p, first] = (entry, batch)
            batch += count
    return found


_NO_HOPS = pa.table([pa.array([], pa.int64())] * 6, names=["part", "row", "to", "entry", "last", "count"])


def staging_files(df: DataFrame, folder: str, max_bytes: int = STAGING_BYTES, sample_rows: int = 10_000) -> None:
    """Writes rows to be loaded in files of about ``max_bytes`` each.

    Spark rolls files by rows, so the bytes of a row are estimated from the sizes of a
    bounded number of rows as text; they only decide how many go into a file.
    """
    size = df.limit(sample_rows).agg(F.avg(F.length(F.to_json(F.struct("*"))))).first()[0] or 1.0
    df.write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", max(int(max_bytes / size), 1)).parquet(folder)
