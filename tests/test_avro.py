"""Rows from Avro records, against an encoder of their own."""

import datetime
import json
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions import avro

SCHEMA = {
    "type": "record",
    "name": "R",
    "namespace": "t",
    "fields": [
        {"name": "id", "type": "long"},
        {"name": "name", "type": ["null", "string"]},
        {"name": "ok", "type": "boolean"},
        {"name": "x", "type": "double"},
        {"name": "f", "type": "float"},
        {"name": "color", "type": {"type": "enum", "name": "Color", "symbols": ["RED", "BLUE"]}},
        {"name": "again", "type": "Color"},
        {"name": "tags", "type": {"type": "array", "items": "string"}},
        {"name": "counts", "type": {"type": "map", "values": "int"}},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "local", "type": ["null", {"type": "long", "logicalType": "local-timestamp-micros"}]},
        {"name": "clock", "type": {"type": "int", "logicalType": "time-millis"}},
        {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 20, "scale": 2}},
        {"name": "raw", "type": {"type": "fixed", "name": "Four", "size": 4}},
        {"name": "inner", "type": {"type": "record", "name": "Inner", "fields": [{"name": "y", "type": "int"}]}},
    ],
}


def zigzag(n):
    n, out = (n << 1) ^ (n >> 63), b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def text(s):
    b = s.encode() if isinstance(s, str) else s
    return zigzag(len(b)) + b


def record(i, name, local=None):
    tags = zigzag(-2) + zigzag(4) + text("a") + text("b") + zigzag(1) + text("c") + zigzag(0)  # two blocks, one with its size
    counts = zigzag(1) + text("k") + zigzag(-5) + zigzag(0)
    price = text((-1250).to_bytes(2, "big", signed=True))
    return (
        zigzag(i) + (zigzag(0) if name is None else zigzag(1) + text(name)) + b"\x01" + struct.pack("<d", 1.5) + struct.pack("<f", 0.25) + zigzag(1) + zigzag(0)
        + tags + counts + zigzag(-1) + zigzag(-1) + (zigzag(0) if local is None else zigzag(1) + zigzag(local)) + zigzag(1500) + price + b"\x00\x01\x02\x03" + zigzag(7)
    )


def test_rows(spark):
    df = spark.createDataFrame([(0, bytearray(record(-(2**62), "日", 1_000_001))), (1, bytearray(record(5, None))), (2, None)], "i int, p binary").repartition(2)
    v = avro.decode(F.col("p"), json.dumps(SCHEMA))
    rows = {r["i"]: r for r in df.select("i", v.alias("r"), F.unix_micros(v["at"]).alias("at")).collect()}
    r = rows[0]["r"]
    assert (r["id"], r["name"], r["ok"], r["x"], r["f"], r["color"], r["again"], r["tags"], [tuple(c) for c in r["counts"]]) == (-(2**62), "日", True, 1.5, 0.25, "BLUE", "RED", ["a", "b", "c"], [("k", -5)])
    assert (r["day"], rows[0]["at"], r["local"], r["clock"], r["price"], bytes(r["raw"]), r["inner"]["y"]) == (
        datetime.date(1969, 12, 31), -1000, datetime.datetime(1970, 1, 1, 0, 0, 1, 1), 1_500_000, Decimal("-12.50"), b"\x00\x01\x02\x03", 7
    )
    assert rows[1]["r"]["name"] is None and rows[1]["r"]["local"] is None and rows[2]["r"] is None
    for wrong in (record(1, "x") + b"\x00", record(1, "x")[:-1], b""):
        with pytest.raises(Exception):
            spark.range(1).select(avro.decode(F.lit(bytearray(wrong)), json.dumps(SCHEMA))).collect()


def test_refused_schemas():
    def of(*fields):
        return json.dumps({"type": "record", "name": "R", "fields": [{"name": n, "type": t} for n, t in fields]})

    for wrong in (
        of(), of(("a", "int"), ("A", "int")), of(("me", ["null", "R"])), of(("u", ["int", "string"])), of(("u", ["null", "int", "string"])),
        of(("t", {"type": "long", "logicalType": "timestamp-nanos"})), of(("t", {"type": "fixed", "name": "D", "size": 12, "logicalType": "duration"})), json.dumps("int"),
    ):
        with pytest.raises(ValueError):
            avro.row_schema(wrong)


def test_names_of_nested_types_and_branches_of_unions():
    """A nested type is of its parent's namespace; a union of two has no third branch."""
    import pytest

    from millrace.functions import avro

    inner = {"type": "enum", "name": "B", "symbols": ["x", "y"]}
    schema = {"type": "record", "name": "A", "namespace": "n", "fields": [{"name": "a", "type": inner}, {"name": "b", "type": "n.B"}, {"name": "c", "type": "B"}, {"name": "d", "type": {"type": "record", "name": "m.C", "fields": [{"name": "e", "type": {"type": "fixed", "name": "F", "size": 1}}, {"name": "f", "type": "m.F"}]}}]}
    kind, read = avro._of(json.dumps(schema))
    assert read(b"\x02\x00\x02ab", 0)[0] == {"a": "y", "b": "x", "c": "y", "d": {"e": b"a", "f": b"b"}}
    _, read = avro._of(json.dumps({"type": "record", "name": "U", "fields": [{"name": "v", "type": ["null", "int"]}]}))
    assert read(b"\x00", 0)[0] == {"v": None} and read(b"\x02\x0a", 0)[0] == {"v": 5}
    with pytest.raises(ValueError):
        read(b"\x0e\x0a", 0)
