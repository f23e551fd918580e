"""Key ranges over unsigned bytes, as predicates that prune a sorted table.

A range set is a small sorted list that a user writes or a predicate implies. It
becomes one Column predicate; on a table sorted by its key, Parquet statistics then
skip all row groups outside the ranges. Large range tables (the splits of a stream, the
coverage of a key space) are DataFrames; for these see ``coalesced`` and ``gaps``.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import checkpointed


@dataclass(frozen=True, order=True)
class KeyRange:
    """Keys from ``start`` (inclusive, b'' for the first) to ``end`` (exclusive, None for no end)."""

    start: bytes = b""
    end: bytes | None = None

    @property
    def is_empty(self) -> bool:
        return self.end is not None and self.start >= self.end

    def __contains__(self, key: bytes) -> bool:
        return self.start <= key and (self.end is None or key < self.end)

    def after(self, key: bytes) -> KeyRange:
        """What remains behind ``key``."""
        return KeyRange(max(self.start, key + b"\x00"), self.end)

    def __str__(self) -> str:
        return f"[{self.start.hex()},{'' if self.end is None else self.end.hex()})"


def closed(start: bytes, end: bytes) -> KeyRange:
    return KeyRange(start, end + b"\x00")


def opened(start: bytes, end: bytes | None) -> KeyRange:
    return KeyRange(start + b"\x00", end)


def point(key: bytes) -> KeyRange:
    return closed(key, key)


def prefix(start: bytes) -> KeyRange:
    """All keys that begin with ``start``."""
    stem = start.rstrip(b"\xff")
    return KeyRange(start, stem[:-1] + bytes([stem[-1] + 1]) if stem else None)


def union(ranges: list[KeyRange]) -> list[KeyRange]:
    """Disjoint ranges in order that hold the same keys."""
    out: list[KeyRange] = []
    for r in sorted((r for r in ranges if not r.is_empty), key=lambda r: r.start):
        if out and (out[-1].end is None or r.start <= out[-1].end):
            end = None if out[-1].end is None or r.end is None else max(out[-1].end, r.end)
            out[-1] = KeyRange(out[-1].start, end)
        else:
            out.append(r)
    return out


def intersection(left: list[KeyRange], right: list[KeyRange]) -> list[KeyRange]:
    out = []
    for a in union(left):
        for b in union(right):
            ends = [e for e in (a.end, b.end) if e is not None]
            both = KeyRange(max(a.start, b.start), min(ends) if ends else None)
            if not both.is_empty:
                out.append(both)
    return union(out)


def complement(ranges: list[KeyRange]) -> list[KeyRange]:
    out, start = [], b""
    for r in union(ranges):
        if start < r.start:
            out.append(KeyRange(start, r.start))
        if r.end is None:
            return out
        start = r.end
    return [*out, KeyRange(start, None)]


def from_comparison(op: str, values: list[bytes] | bytes | None) -> list[KeyRange]:
    """The keys that satisfy one comparison; a comparison with null satisfies none."""
    if op in ("is_null",):
        return []
    if op == "is_not_null":
        return [KeyRange()]
    if values is None:
        return []
    if op == "in":
        return union([point(v) for v in values if v is not None])
    single = {
        "=": lambda v: [point(v)],
        "<>": lambda v: complement([point(v)]),
        "<": lambda v: [KeyRange(b"", v)],
        "<=": lambda v: [KeyRange(b"", v + b"\x00")],
        ">": lambda v: [KeyRange(v + b"\x00", None)],
        ">=": lambda v: [KeyRange(v, None)],
        "prefix": lambda v: [prefix(v)],
    }
    return union(single[op](values))


def can_push(data_type: str, op: str) -> bool:
    """Which comparisons of a key column's type agree with the order of its bytes."""
    if data_type in ("string", "binary"):
        return True
    # two's complement puts negative numbers last, so only equality carries over
    return data_type in ("tinyint", "smallint", "int", "bigint", "date", "timestamp") and op in ("=", "in")


def parse(text: str, encoding: str = "utf8") -> list[KeyRange]:
    """Ranges written as ``[a,b);(c,d];[e,)``, with backslash before , ; and brackets in a key."""

    def key(raw: str) -> bytes:
        plain, escaped = [], False
        for ch in raw:
            if escaped or ch != "\\":
                plain.append(ch)
                escaped = False
            else:
                escaped = True
        return base64.b64decode("".join(plain), validate=True) if encoding == "base64" else "".join(plain).encode()

    def split(raw: str, at: str) -> list[str]:
        out, current, escaped = [], "", False
        for ch in raw:
            if ch == at and not escaped:
                out.append(current)
                current = ""
            else:
                current += ch
            escaped = ch == "\\" and not escaped
        return [*out, current]

    out = []
    for item in (p.strip() for p in split(text, ";")):
        if not item:
            continue
        if item[0] not in "[(" or item[-1] not in "])" or len(parts := split(item[1:-1], ",")) != 2:
            raise ValueError(f"not a range: {item}")
        low, high = key(parts[0]), key(parts[1])
        start = low if item[0] == "[" or not parts[0] else low + b"\x00"
        end = None if not parts[1] else high + b"\x00" if item[-1] == "]" else high
        r = KeyRange(start, end)
        if r.is_empty:
            raise ValueError(f"an empty range: {item}")
        out.append(r)
    return union(out)


def _text(b: bytes) -> Column:
    try:
        return F.lit(b.decode())
    except UnicodeDecodeError:
        return F.lit(bytearray(b)).cast("string")


def predicate(column: Column, ranges: list[KeyRange], as_text: bool = False) -> Column:
    """The ranges as one predicate over a binary key, or over text whose bytes are the key.

    A bound that is no UTF-8, such as the end of the keys that begin with U+00FF, is
    compared as bytes; text is ordered by its bytes as well.
    """

    def bound(b: bytes) -> Column:
        # the first string after b is b + NUL in both orders
        return _text(b) if as_text else F.lit(bytearray(b))

    def one(r: KeyRange) -> Column:
        low = column >= bound(r.start) if r.start else column.isNotNull()
        return low if r.end is None else low & (column < bound(r.end))

    chosen = union(ranges)
    return reduce(lambda a, b: a | b, map(one, chosen)) if chosen else F.lit(False)


def number_bounds(chosen: list[KeyRange], width: int) -> list[tuple[int, int | None]] | None:
    """The numbers whose ``width`` digits, padded with zeros, lie in the ranges: low inclusive, high exclusive.

    None where a bound is no string of digits, so that numbers can't tell.
    """

    def first(bound: bytes) -> int | None:
        """The smallest number whose padded digits are not below the bound."""
        head = bound[:width]
        if not head.isdigit():
            return None
        return int(head.ljust(width, b"0")) + (len(bound) > width)

    out = []
    for r in union(chosen):
        low, high = first(r.start) if r.start else 0, None if r.end is None else first(r.end)
        if low is None or (r.end is not None and high is None):
            return None
        out.append((low, high))
    return out


def number_predicate(column: Column, chosen: list[KeyRange], width: int) -> Column:
    """A predicate on the number behind a padded key that holds wherever the ranges do.

    A scan can push it down, as it can't push what is said of the padded text. Numbers
    that ``width`` digits can't hold are let through; the exact predicate on the text has
    to follow.
    """
    bounds = number_bounds(chosen, width)
    if bounds is None:
        return F.lit(True)
    inside = [(column >= low) if high is None else (column >= low) & (column < high) for low, high in bounds]
    return reduce(lambda a, b: a | b, inside, (column < 0) | (column >= 10**width))


def split_at(ranges: list[KeyRange], samples: list[tuple[bytes, int]]) -> list[tuple[KeyRange, int]]:
    """Ranges cut at sampled keys, with an estimate of the bytes of each part.

    A sample is a key and the bytes before it; samples may repeat, the largest counts.
    """
    offsets: dict[bytes, int] = {}
    for key, offset in samples:
        if key:
            offsets[key] = max(offset, offsets.get(key, 0))
    keys = sorted(offsets)
    out = []
    for r in union(ranges):
        inner = [k for k in keys if r.start < k and (r.end is None or k < r.end)]
        for low, high in zip([r.start, *inner], [*inner, r.end]):
            below = max((offsets[k] for k in keys if k <= low), default=0)
            above = min((offsets[k] for k in keys if high is not None and k >= high), default=max(offsets.values(), default=0))
            out.append((KeyRange(low, high), max(above - below, 0)))
    return out


# -- range tables


def in_segments(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """The rows in range partitions of group and order, with their group as ``_g`` and their partition as ``_p``.

    A segment is the part of a group in one partition. There are fewer segments than
    groups and partitions together, so what is known of each is small, however large a
    group is.
    """
    group = F.struct(*by) if by else F.lit(True)
    placed = df.withColumn("_g", group).repartitionByRange("_g", order)
    return checkpointed(placed.withColumn("_p", F.spark_partition_id()))


def _open_or_max(end: str, w) -> tuple[Column, Column]:
    """Whether an end in the window is open, and the largest of the others."""
    return F.coalesce(F.max(F.col(end).isNull()).over(w), F.lit(False)), F.max(end).over(w)


def coalesced(df: DataFrame, by: list[str], start: str = "start", end: str = "end", small_groups: bool = False) -> DataFrame:
    """Overlapping or touching ranges of each group as one; a null end is unbounded.

    A prefix scan: ranges lie in range partitions of group and start, and each segment
    of a group finds the islands that its own ranges form. What reaches into it from
    earlier segments is a running maximum over segments, as is the island that this
    belongs to; with both each row knows its island's start, and islands are put together
    by that. So one group of all ranges is spread over all tasks. ``small_groups`` says
    that each group fits a task and spares the checkpoint.
    """
    ranges = df.select(*by, F.col(start).alias("_s"), F.col(end).alias("_e"))
    placed = ranges.withColumns({"_g": F.struct(*by) if by else F.lit(True), "_p": F.lit(0)}) if small_groups else in_segments(ranges, by, "_s")
    w = Window.partitionBy("_g", "_p").orderBy("_s", "_e")
    until, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    is_open, most = _open_or_max("_e", before)
    local = placed.withColumn("_new", ~(is_open | F.coalesce(F.col("_s") <= most, F.lit(False))))

    segments = local.groupBy("_g", "_p").agg(F.max(F.when(F.col("_new"), F.col("_s"))).alias("_last"), F.max(F.col("_e").isNull()).alias("_open"), F.max("_e").alias("_most"))
    earlier = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    segments = segments.select("_g", "_p", "_last", F.coalesce(F.max("_open").over(earlier), F.lit(False)).alias("_open_in"), F.max("_most").over(earlier).alias("_reach"))
    reached = F.col("_open_in") | F.coalesce(F.col("_last") <= F.col("_reach"), F.lit(False))
    segments = segments.withColumn("_own", F.when(~reached, F.struct("_last")))
    segments = segments.withColumn("_into", F.last("_own", ignorenulls=True).over(earlier)["_last"]).select("_g", "_p", "_open_in", "_reach", "_into")

    known = local.join(segments, ["_g", "_p"])
    inside = F.col("_open_in") | F.coalesce(F.col("_s") <= F.col("_reach"), F.lit(False))
    begins = F.when(F.col("_new") & ~inside, F.struct("_s"))
    island = F.coalesce(F.last(begins, ignorenulls=True).over(until)["_s"], F.col("_into"))
    whole = F.when(F.max(F.col("_e").isNull()), F.lit(None)).otherwise(F.max("_e"))
    found = known.select("_g", "_e", island.alias("_island")).groupBy("_g", "_island").agg(whole.alias("_end"))
    return found.select(*[F.col("_g")[c].alias(c) for c in by], F.col("_island").alias(start), F.col("_end").alias(end))


def gaps(df: DataFrame, by: list[str], start: str = "start", end: str = "end", low=None, high=None) -> DataFrame:
    """What lies between the ranges of each group; from ``low`` and up to ``high`` as well, where these are given.

    The next island of a segment's last one is the first of the next segment, so this is
    spread like ``coalesced``.
    """
    ends = []
    if low is not None:
        ends.append(df.select(*by).distinct().select(*by, F.lit(low).cast(df.schema[start].dataType).alias(start), F.lit(low).cast(df.schema[end].dataType).alias(end)))
    if high is not None:
        ends.append(df.select(*by).distinct().select(*by, F.lit(high).cast(df.schema[start].dataType).alias(start), F.lit(high).cast(df.schema[end].dataType).alias(end)))
    whole = reduce(lambda a, b: a.unionByName(b), ends, df.select(*by, start, end))
    islands = coalesced(whole, by, start, end).select(*by, F.col(start).alias("_s"), F.col(end).alias("_e"))
    placed = in_segments(islands, by, "_s")
    segments = placed.groupBy("_g", "_p").agg(F.min("_s").alias("_first"))
    after = segments.select("_g", "_p", F.lead("_first").over(Window.partitionBy("_g").orderBy("_p")).alias("_after"))
    following = placed.withColumn("_own", F.lead("_s").over(Window.partitionBy("_g", "_p").orderBy("_s"))).join(after, ["_g", "_p"])
    found = following.withColumn("_next", F.coalesce("_own", "_after")).filter(F.col("_next").isNotNull() & F.col("_e").isNotNull())
    return found.select(*[F.col("_g")[c].alias(c) for c in by], F.col("_e").alias(start), F.col("_next").alias(end))


def fully_covered(df: DataFrame, target_start, target_end, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Per group whether its ranges tile the whole target."""
    held = (F.col(start) <= target_start) & (F.col(end).isNull() | (F.col(end) >= target_end))
    return coalesced(df, by, start, end).groupBy(*by).agg(F.max(held).alias("covered"))
