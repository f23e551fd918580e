"""Rows from Protobuf messages."""

import json

import pytest
from pyspark.sql import functions as F

pytest.importorskip("google.protobuf")
from google.protobuf import any_pb2, descriptor_pb2, duration_pb2, field_mask_pb2, struct_pb2, timestamp_pb2, wrappers_pb2  # noqa: E402

from millrace.functions import protobuf  # noqa: E402

P = descriptor_pb2.FieldDescriptorProto


def descriptors(*extra):
    file = descriptor_pb2.FileDescriptorProto(name="t.proto", package="t", syntax="proto3")
    known = [timestamp_pb2, duration_pb2, field_mask_pb2, wrappers_pb2, struct_pb2, any_pb2]
    file.dependency.extend(m.DESCRIPTOR.name for m in known)
    color = file.enum_type.add(name="Color")
    for i, n in enumerate(("RED", "BLUE")):
        color.value.add(name=n, number=i)
    inner = file.message_type.add(name="Inner")
    inner.field.add(name="x", number=1, type=P.TYPE_INT32, label=P.LABEL_OPTIONAL)
    m = file.message_type.add(name="M")
    entry = m.nested_type.add(name="CountsEntry")
    entry.options.map_entry = True
    entry.field.add(name="key", number=1, type=P.TYPE_STRING, label=P.LABEL_OPTIONAL)
    entry.field.add(name="value", number=2, type=P.TYPE_INT64, label=P.LABEL_OPTIONAL)
    kinds = [("id", P.TYPE_INT64, None), ("name", P.TYPE_STRING, None), ("color", P.TYPE_ENUM, ".t.Color"), ("inner", P.TYPE_MESSAGE, ".t.Inner"), ("at", P.TYPE_MESSAGE, ".google.protobuf.Timestamp"), ("took", P.TYPE_MESSAGE, ".google.protobuf.Duration"), ("mask", P.TYPE_MESSAGE, ".google.protobuf.FieldMask"), ("maybe", P.TYPE_MESSAGE, ".google.protobuf.Int64Value"), ("doc", P.TYPE_MESSAGE, ".google.protobuf.Struct"), ("any", P.TYPE_MESSAGE, ".google.protobuf.Any")]
    for i, (n, t, ref) in enumerate(kinds, 1):
        m.field.add(name=n, number=i, type=t, label=P.LABEL_OPTIONAL, type_name=ref)
    m.field.add(name="tags", number=20, type=P.TYPE_STRING, label=P.LABEL_REPEATED)
    m.field.add(name="counts", number=21, type=P.TYPE_MESSAGE, label=P.LABEL_REPEATED, type_name=".t.M.CountsEntry")
    for add in extra:
        add(file)
    out = descriptor_pb2.FileDescriptorSet()
    for k in known:
        k.DESCRIPTOR.CopyToProto(out.file.add())
    out.file.append(file)
    return out.SerializeToString()


def test_rows(spark):
    d = descriptors()
    m = protobuf._message(d, "t.M")(id=2**62, name="日", color=1, tags=["a", "b"], counts={"k": 5})
    m.inner.x = 7
    m.at.seconds, m.at.nanos = -1, 999_999_999
    m.took.seconds, m.took.nanos = -1, -1_999
    m.mask.paths.extend(["a_b", "c"])
    m.maybe.value = 0
    m.doc["k"] = [1, None]
    m.any.type_url = "x/y"
    odd = protobuf._message(d, "t.M")(color=9)
    df = spark.createDataFrame([(0, bytearray(m.SerializeToString())), (1, bytearray(odd.SerializeToString())), (2, None)], "i int, p binary").repartition(2)
    rows = {r["i"]: r for r in df.select("i", protobuf.decode(F.col("p"), d, "t.M").alias("m"), F.unix_micros(protobuf.decode(F.col("p"), d, "t.M")["at"]).alias("at")).collect()}
    full = rows[0]["m"]
    assert (full["id"], full["name"], full["color"], full["inner"]["x"], rows[0]["at"], full["took"], full["mask"], full["maybe"]) == (2**62, "日", "BLUE", 7, -1, -1_000_001, "a_b,c", 0)
    assert json.loads(full["doc"]) == {"k": [1, None]} and full["any"]["type_url"] == "x/y" and full["tags"] == ["a", "b"] and [tuple(e) for e in full["counts"]] == [("k", 5)]
    bare = rows[1]["m"]
    assert (bare["id"], bare["name"], bare["color"], bare["inner"], bare["maybe"], bare["tags"]) == (0, "", "UNKNOWN_ENUM_VALUE_Color_9", None, None, [])
    assert rows[2]["m"] is None
    with pytest.raises(Exception):
        spark.range(1).select(protobuf.decode(F.lit(bytearray(b"\xff\xff")), d, "t.M")).collect()


def test_refused_messages():
    def add(name, *fields):
        def run(file):
            m = file.message_type.add(name=name)
            for i, (n, t, ref) in enumerate(fields, 1):
                m.field.add(name=n, number=i, type=t, label=P.LABEL_OPTIONAL, type_name=ref)

        return run

    d = descriptors(add("Empty"), add("Self", ("me", P.TYPE_MESSAGE, ".t.Self")), add("Case", ("a", P.TYPE_INT32, None), ("A", P.TYPE_INT32, None)))
    for name in ("t.Empty", "t.Self", "t.Case"):
        with pytest.raises(ValueError):
            protobuf.row_schema(d, name)
