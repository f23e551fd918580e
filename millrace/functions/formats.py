"""Bodies and small value formats: JSON, form fields, map entries, identifiers, limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRUNCATION_MARK = "...[truncated]"
ATTRIBUTE_LIMIT = 1024


def json_body(*fields: Column | str, keep_nulls: bool = True) -> Column:
    """The fields as one JSON object: bytes in base64, decimals bare, ISO dates and times, instants in UTC."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": str(not keep_nulls).lower(), "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def check_json_types(schema: T.StructType) -> None:
    """Refuses maps without string keys, which JSON objects cannot hold."""
    for field in schema.fields:
        stack = [field.dataType]
        while stack:
            t = stack.pop()
            if isinstance(t, T.MapType):
                if not isinstance(t.keyType, T.StringType):
                    raise ValueError(f"{field.name}: JSON objects need string keys")
                stack.append(t.valueType)
            elif isinstance(t, T.ArrayType):
                stack.append(t.elementType)
            elif isinstance(t, T.StructType):
                stack += [f.dataType for f in t.fields]


def form_body(df: DataFrame, columns: list[str]) -> Column:
    """The columns as an application/x-www-form-urlencoded body, in their order.

    Null fields are left out, arrays repeat their name, null elements are an error.
    Only strings and arrays of strings are allowed.
    """
    parts = []
    for name in columns:
        kind = df.schema[name].dataType
        key = F.url_encode(F.lit(name))
        if isinstance(kind, T.StringType):
            parts.append(F.array(F.when(F.col(name).isNotNull(), F.concat(key, F.lit("="), F.url_encode(F.col(name))))))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            refuse = F.raise_error(F.lit(f"{name} holds a null element")).cast("string")
            pairs = F.transform(F.col(name), lambda v: F.when(v.isNull(), refuse).otherwise(F.concat(key, F.lit("="), F.url_encode(v))))  # noqa: B023
            parts.append(F.coalesce(pairs, F.array().cast("array<string>")))
        else:
            raise ValueError(f"{name}: form fields are strings or arrays of strings")
    return F.array_join(F.array_compact(F.concat(*parts)), "&")


def map_to_entries(column: Column) -> Column:
    """A map as an array of key and value, in key order."""
    return F.array_sort(F.map_entries(column))


def entries_to_map(column: Column) -> Column:
    return F.map_from_entries(column)


def parse_uuid(column: Column) -> Column:
    """The canonical lower-case form of a 36-character UUID; anything else is an error."""
    right = column.rlike("^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$")
    return F.when(column.isNull() | right, F.lower(column)).otherwise(F.raise_error(F.concat(F.lit("not a UUID: "), column)))


def truncate_utf8(column: Column, limit: int = ATTRIBUTE_LIMIT, mark: str = TRUNCATION_MARK) -> Column:
    """At most ``limit`` bytes of UTF-8, cut between characters and then marked."""
    room = limit - len(mark.encode())
    cut = F.substring(F.encode(column, "UTF-8"), 1, room)
    # a cut inside a character leaves up to three bytes of it, which are dropped
    whole = F.regexp_replace(F.hex(cut), "(?:(?:F[0-7](?:[89AB][0-9A-F]){0,2})|(?:E[0-9A-F](?:[89AB][0-9A-F]){0,1})|(?:[CD][0-9A-F]))$", "")
    return F.when(F.octet_length(column) <= limit, column).otherwise(F.concat(F.decode(F.unhex(whole), "UTF-8"), F.lit(mark)))


def task_id(key: Column) -> Column:
    """The task name of a deduplication key."""
    return F.sha2(key, 256)


def identifier(name: str, dialect: str = "standard") -> str:
    """The stored form of a written identifier: quotes off, and folded where the dialect folds."""
    quote = {"standard": "`", "postgres": '"'}[dialect]
    if len(name) > 1 and name[0] == quote == name[-1]:
        return name[1:-1].replace(quote * 2, quote)
    return name.lower() if dialect == "postgres" else name


def table_identifier(name: str, dialect: str = "standard") -> tuple[str, ...]:
    """The parts of a written, possibly qualified name, each in its stored form; quotes may hold dots."""
    quote = {"standard": "`", "postgres": '"'}[dialect]
    parts, part, quoted = [], "", False
    for ch in name:
        if ch == quote:
            quoted = not quoted
        if ch == "." and not quoted:
            parts.append(part)
            part = ""
        else:
            part += ch
    parts.append(part)
    if quoted or not all(parts):
        raise ValueError(f"not a table name: {name}")
    return tuple(identifier(p, dialect) for p in parts)


# Ranges of whole-number types.
_WHOLE_RANGES = {"tinyint": (-(1 << 7), (1 << 7) - 1), "smallint": (-(1 << 15), (1 << 15) - 1), "int": (-(1 << 31), (1 << 31) - 1)}


def narrowed(column: Column, name: str) -> Column:
    """A 64-bit whole number as a narrower type; one that does not fit is an error, never wrapped."""
    low, high = _WHOLE_RANGES[name]
    refuse = F.raise_error(F.concat(column.cast("string"), F.lit(f" does not fit {name}"))).cast(name)
    return F.when(column.isNull() | column.between(low, high), column.cast(name)).otherwise(refuse)


def truncated_time(nanos: Column, precision: int) -> Column:
    """Nanoseconds (of an epoch or a day) cut, not rounded, to so many fractional digits; times before the epoch go down."""
    if not 0 <= precision <= 9:
        raise ValueError("fractional digits are 0 to 9")
    unit = 10 ** (9 - precision)
    return nanos - F.pmod(nanos, F.lit(unit))


def timestamp_from_nanos(nanos: Column, precision: int = 6) -> Column:
    """The timestamp of epoch nanoseconds, cut to at most microseconds."""
    cut = truncated_time(nanos, min(precision, 6))
    return F.timestamp_micros((cut.cast("decimal(20,0)") / 1000).cast("bigint"))
