"""Rows from serialized Protobuf messages, by a descriptor set.

Integers become bigint, enums their value's name, maps arrays of key and value, repeated
fields arrays, messages structs. Well-known types: Timestamp becomes a timestamp and
Duration bigint microseconds, both cut to microseconds; FieldMask its paths joined by
commas; a wrapper the scalar that it wraps, null where unset; Struct, Value and
ListValue JSON text; Any a struct of type_url and value, not unpacked. A field that
tells whether it is set is null where unset, any other has its default. Messages that
contain themselves, have no fields, or whose fields differ by case alone are refused.

Decoding is Arrow-batched and needs the protobuf package on the workers.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

try:
    from google.protobuf import descriptor_pb2, descriptor_pool, json_format, message_factory
except ImportError:  # the package is optional
    descriptor_pb2 = None

_WELL_KNOWN = "google.protobuf."
_JSON = {_WELL_KNOWN + n for n in ("Struct", "Value", "ListValue")}
_WRAPPERS = {_WELL_KNOWN + n + "Value" for n in ("Double", "Float", "Int64", "UInt64", "Int32", "UInt32", "Bool", "String", "Bytes")}
_SINGLE = {
    _WELL_KNOWN + "Timestamp": T.TimestampType(),
    _WELL_KNOWN + "Duration": T.LongType(),
    _WELL_KNOWN + "FieldMask": T.StringType(),
    **{n: T.StringType() for n in _JSON},
    _WELL_KNOWN + "Any": T.StructType([T.StructField("type_url", T.StringType()), T.StructField("value", T.BinaryType())]),
}


@lru_cache(maxsize=16)
def _message(descriptors: bytes, name: str):
    if descriptor_pb2 is None:
        raise ImportError("Protobuf rows need the protobuf package")
    pool = descriptor_pool.DescriptorPool()
    for file in descriptor_pb2.FileDescriptorSet.FromString(descriptors).file:
        pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(name))


def _scalar_type(field) -> T.DataType:
    kinds = {
        field.CPPTYPE_BOOL: T.BooleanType(),
        field.CPPTYPE_DOUBLE: T.DoubleType(),
        field.CPPTYPE_FLOAT: T.DoubleType(),
        field.CPPTYPE_ENUM: T.StringType(),
        field.CPPTYPE_STRING: T.BinaryType() if field.type == field.TYPE_BYTES else T.StringType(),
    }
    return kinds.get(field.cpp_type, T.LongType())


def _is_map(field) -> bool:
    return field.message_type is not None and field.message_type.GetOptions().map_entry


def _field_type(field, above: tuple[str, ...]) -> T.DataType:
    if field.message_type is None:
        one = _scalar_type(field)
    elif field.message_type.full_name in _WRAPPERS:
        one = _scalar_type(field.message_type.fields_by_name["value"])
    else:
        one = _SINGLE.get(field.message_type.full_name) or _struct(field.message_type, above)
    return T.ArrayType(one) if field.is_repeated else one


def _struct(descriptor, above: tuple[str, ...] = ()) -> T.StructType:
    name = descriptor.full_name
    if name in above:
        raise ValueError(f"{name} contains itself")
    if not descriptor.fields:
        raise ValueError(f"{name} has no fields")
    if len({f.name.lower() for f in descriptor.fields}) < len(descriptor.fields):
        raise ValueError(f"fields of {name} differ by case alone")
    return T.StructType([T.StructField(f.name, _field_type(f, (*above, name))) for f in descriptor.fields])


def row_schema(descriptors: bytes, name: str) -> T.StructType:
    """The columns of a message type."""
    return _struct(_message(descriptors, name).DESCRIPTOR)


def _single(field, value):
    if field.message_type is None:
        if field.enum_type is not None:
            known = field.enum_type.values_by_number.get(value)
            return known.name if known else f"UNKNOWN_ENUM_VALUE_{field.enum_type.name}_{value}"
        return value
    name = field.message_type.full_name
    if name in _WRAPPERS:
        return value.value
    if name == _WELL_KNOWN + "Timestamp":
        return value.seconds * 1_000_000 + value.nanos // 1000
    if name == _WELL_KNOWN + "Duration":  # seconds and nanos have one sign; cut towards zero
        return value.seconds * 1_000_000 + int(value.nanos / 1000)
    if name == _WELL_KNOWN + "FieldMask":
        return ",".join(value.paths)
    if name in _JSON:
        return json_format.MessageToJson(value, indent=None)
    return _values(value)


def _values(message) -> dict:
    out = {}
    for field in message.DESCRIPTOR.fields:
        value = getattr(message, field.name)
        if _is_map(field):
            key_of, value_of = (field.message_type.fields_by_name[n] for n in ("key", "value"))
            out[field.name] = [{"key": _single(key_of, k), "value": _single(value_of, value[k])} for k in value]
        elif field.is_repeated:
            out[field.name] = [_single(field, v) for v in value]
        elif field.has_presence and not message.HasField(field.name):
            out[field.name] = None
        else:
            out[field.name] = _single(field, value)
    return out


def decode(payload: Column, descriptors: bytes, name: str) -> Column:
    """The payload as a struct of the message's fields; a null is null, bytes that are no such message fail the query."""
    schema = row_schema(descriptors, name)
    kind = to_arrow_type(schema)

    @F.arrow_udf(schema)
    def run(payloads: pa.Array) -> pa.Array:
        read = _message(descriptors, name).FromString
        return pa.array([None if p is None else _values(read(p)) for p in payloads.to_pylist()], kind)

    return run(payload)
