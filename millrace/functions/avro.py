"""Rows from single Avro records in binary encoding, by the schema that wrote them.

Integers become bigint, float double, enums their symbol, maps arrays of key and value,
bytes and fixed binary. Logical types: date; timestamps in millis or micros as timestamp,
local ones as timestamp without zone; times as bigint microseconds of the day; decimals
with their precision and scale; UUID on strings as text. A union of null and one other
type is nullable, all other unions are refused, as are records that contain themselves,
have no fields or fields that differ by case alone, and logical types finer than
microseconds or without precision.

For a table of files Spark's own data source is the way; this decodes a column of
payloads where that source is not installed, in Arrow batches.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable
from datetime import date, timedelta
from decimal import Context
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Reads a value at a position of the bytes and gives the position behind it.
Reader = Callable[[bytes, int], tuple[object, int]]

# Logical types that rows can't hold.
REFUSED = {"timestamp-nanos", "local-timestamp-nanos", "duration", "big-decimal"}
_EPOCH = date(1970, 1, 1)


def _long(raw: bytes, at: int) -> tuple[int, int]:
    shift = value = 0
    while True:
        byte = raw[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1), at
        shift += 7


def _bytes(raw: bytes, at: int) -> tuple[bytes, int]:
    size, at = _long(raw, at)
    if size < 0 or at + size > len(raw):
        raise ValueError("the payload ends inside a value")
    return raw[at : at + size], at + size


def _packed(layout: str) -> Reader:
    width = struct.calcsize(layout)
    return lambda raw, at: (struct.unpack_from(layout, raw, at)[0], at + width)


def _then(read: Reader, turn: Callable) -> Reader:
    def run(raw: bytes, at: int):
        value, at = read(raw, at)
        return turn(value), at

    return run


def _blocks(read_item: Reader) -> Reader:
    """Items in blocks with their count; a negative one is followed by the block's size."""

    def run(raw: bytes, at: int):
        out = []
        while True:
            count, at = _long(raw, at)
            if count == 0:
                return out, at
            if count < 0:
                count, at = -count, _long(raw, at)[1]
            for _ in range(count):
                item, at = read_item(raw, at)
                out.append(item)

    return run


def _pair(read: Reader) -> Reader:
    def run(raw: bytes, at: int):
        key, at = _bytes(raw, at)
        value, at = read(raw, at)
        return {"key": key.decode(), "value": value}, at

    return run


def _nullable(read: Reader, null_at: int) -> Reader:
    def run(raw: bytes, at: int):
        branch, at = _long(raw, at)
        if branch not in (0, 1):
            raise ValueError(f"a union of two has no branch {branch}")
        return (None, at) if branch == null_at else read(raw, at)

    return run


def _record(fields: list[tuple[str, Reader]]) -> Reader:
    def run(raw: bytes, at: int):
        out = {}
        for name, read in fields:
            out[name], at = read(raw, at)
        return out, at

    return run


def _logical(schema: dict, kind: str, read: Reader) -> tuple[T.DataType, Reader] | None:
    name = schema.get("logicalType")
    if name in REFUSED or (name == "uuid" and kind != "string"):
        raise ValueError(f"rows can't hold {name}")
    if name == "decimal" and kind in ("bytes", "fixed"):
        scale = schema.get("scale", 0)
        exact = Context(prec=max(schema["precision"], 1))
        return T.DecimalType(schema["precision"], scale), _then(read, lambda b: exact.create_decimal(int.from_bytes(b, "big", signed=True)).scaleb(-scale, exact))
    if name == "date" and kind == "int":
        return T.DateType(), _then(read, lambda d: _EPOCH + timedelta(days=d))
    unit = 1000 if name in ("time-millis", "timestamp-millis", "local-timestamp-millis") else 1
    if name in ("time-millis", "time-micros"):
        return T.LongType(), _then(read, lambda v: v * unit)
    if name in ("timestamp-millis", "timestamp-micros"):
        return T.TimestampType(), _then(read, lambda v: v * unit)
    if name in ("local-timestamp-millis", "local-timestamp-micros"):
        return T.TimestampNTZType(), _then(read, lambda v: v * unit)
    return None


def _full_name(name: str, space: str) -> str:
    """A dotted name is whole, any other is of the enclosing namespace."""
    return name if "." in name or not space else f"{space}.{name}"


def _compiled(schema, named: dict, above: tuple[str, ...], space: str = "") -> tuple[T.DataType, Reader]:
    """``space`` is the enclosing namespace; ``named`` has the types defined so far, by full name, with theirs."""
    if isinstance(schema, list):
        others = [s for s in schema if s != "null"]
        if len(others) != 1 or len(schema) != 2:
            raise ValueError(f"only unions of null and one type become columns, not {schema}")
        kind, read = _compiled(others[0], named, above, space)
        return kind, _nullable(read, schema.index("null"))
    if isinstance(schema, str):
        if (full := _full_name(schema, space)) in named:
            definition, around = named[full]
            return _compiled(definition, named, above, around)
        schema = {"type": schema}
    kind = schema["type"]
    if isinstance(kind, (dict, list)):
        return _compiled(kind, named, above, space)
    full = ""
    if kind in ("record", "enum", "fixed"):
        full = _full_name(schema["name"], schema.get("namespace", space))
        named[full] = (schema, space)
        space = full.rpartition(".")[0]
    if kind == "record":
        if full in above:
            raise ValueError(f"{full} contains itself")
        names = [f["name"] for f in schema["fields"]]
        if not names or len({n.lower() for n in names}) < len(names):
            raise ValueError(f"{full} has no fields, or fields that differ by case alone")
        parts = [(f["name"], *_compiled(f["type"], named, (*above, full), space)) for f in schema["fields"]]
        return T.StructType([T.StructField(n, t) for n, t, _ in parts]), _record([(n, read) for n, _, read in parts])
    if kind == "array":
        item, read = _compiled(schema["items"], named, above, space)
        return T.ArrayType(item), _blocks(read)
    if kind == "map":
        value, read = _compiled(schema["values"], named, above, space)
        return T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", value)])), _blocks(_pair(read))
    if kind == "enum":
        return T.StringType(), _then(_long, schema["symbols"].__getitem__)
    size = schema.get("size", 0)
    plain: dict[str, tuple[T.DataType, Reader]] = {
        "boolean": (T.BooleanType(), lambda raw, at: (raw[at] != 0, at + 1)),
        "int": (T.LongType(), _long),
        "long": (T.LongType(), _long),
        "float": (T.DoubleType(), _packed("<f")),
        "double": (T.DoubleType(), _packed("<d")),
        "bytes": (T.BinaryType(), _bytes),
        "string": (T.StringType(), _then(_bytes, bytes.decode)),
        "fixed": (T.BinaryType(), lambda raw, at: (raw[at : at + size], at + size)),
    }
    if kind not in plain:
        raise ValueError(f"no column holds {kind}")
    return _logical(schema, kind, plain[kind][1]) or plain[kind]


@lru_cache(maxsize=16)
def _of(schema: str) -> tuple[T.StructType, Reader]:
    kind, read = _compiled(json.loads(schema), {}, ())
    if not isinstance(kind, T.StructType):
        raise ValueError("rows are records")
    return kind, read


def row_schema(schema: str) -> T.StructType:
    """The columns of a record schema, given as JSON."""
    return _of(schema)[0]


def decode(payload: Column, schema: str) -> Column:
    """The payload as a struct of the record's fields; a null is null, bytes that are no such record fail the query."""
    rows = row_schema(schema)
    kind = to_arrow_type(rows)

    @F.arrow_udf(rows)
    def run(payloads: pa.Array) -> pa.Array:
        read = _of(schema)[1]

        def one(raw: bytes | None):
            if raw is None:
                return None
            value, end = read(raw, 0)
            if end != len(raw):
                raise ValueError("the payload does not end with its record")
            return value

        return pa.array([one(p) for p in payloads.to_pylist()], kind)

    return run(payload)
