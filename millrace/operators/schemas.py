"""Table schemas: unions that only widen, column type mappings, and mutation weights."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaConflict(ValueError):
    """Two schemas that no widening makes one."""


def check_names(schema: T.StructType, path: str = "") -> None:
    """Refuses columns whose names differ only in case."""
    seen: dict[str, str] = {}
    for f in schema.fields:
        other = seen.setdefault(f.name.lower(), f.name)
        if other is not f.name:
            raise SchemaConflict(f"{path}{f.name} and {path}{other} differ in case only")
        if isinstance(f.dataType, T.StructType):
            check_names(f.dataType, f"{path}{f.name}.")


def union_schema(current: T.StructType, incoming: T.StructType, allow_new_fields: bool = True, allow_relaxation: bool = True, path: str = "") -> T.StructType:
    """``current`` widened to hold ``incoming``: new fields at the end and nullable, types unchanged."""
    check_names(current, path)
    check_names(incoming, path)
    known = {f.name.lower(): f for f in current.fields}
    given = {f.name.lower(): f for f in incoming.fields}
    out = []
    for f in current.fields:
        other = given.get(f.name.lower())
        if other is None:
            nullable = True
        else:
            nullable = f.nullable or other.nullable
        if nullable and not f.nullable and not allow_relaxation:
            raise SchemaConflict(f"{path}{f.name} would become nullable")
        kind = f.dataType if other is None else _union_type(f.dataType, other.dataType, allow_new_fields, allow_relaxation, f"{path}{f.name}")
        out.append(T.StructField(f.name, kind, nullable, f.metadata))
    for name, f in given.items():
        if name not in known:
            if not allow_new_fields:
                raise SchemaConflict(f"{path}{f.name} would be new")
            out.append(T.StructField(f.name, f.dataType, True, f.metadata))
    return T.StructType(out)


def _union_type(a: T.DataType, b: T.DataType, new: bool, relax: bool, path: str) -> T.DataType:
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return union_schema(a, b, new, relax, path + ".")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_union_type(a.elementType, b.elementType, new, relax, path + "[]"), a.containsNull or b.containsNull)
    if a != b:
        raise SchemaConflict(f"{path} is {a.simpleString()}, not {b.simpleString()}")
    return a


def union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both under the union of their schemas."""
    schema = union_schema(left.schema, right.schema)
    given = {c.lower(): c for c in right.columns}
    aligned = right.select([F.col(given[f.name.lower()]).alias(f.name) if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return left.unionByName(aligned, allowMissingColumns=True)


def warehouse_type(kind: T.DataType, path: str = "") -> str:
    """The warehouse's name of a column type; types it cannot hold are refused."""
    if isinstance(kind, T.DecimalType):
        return "NUMERIC" if kind.scale <= 9 and kind.precision - kind.scale <= 29 else "BIGNUMERIC"
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.ArrayType, T.MapType)):
            raise ValueError(f"{path}: arrays cannot hold arrays")
        return f"ARRAY<{warehouse_type(kind.elementType, path)}>"
    if isinstance(kind, T.MapType):
        return f"ARRAY<STRUCT<key {warehouse_type(kind.keyType, path)}, value {warehouse_type(kind.valueType, path)}>>"
    if isinstance(kind, T.StructType):
        check_names(kind, path)
        return "STRUCT<" + ", ".join(f"{f.name} {warehouse_type(f.dataType, f'{path}.{f.name}')}" for f in kind.fields) + ">"
    # Names of the scalar types.
    names = {"string": "STRING", "boolean": "BOOL", "binary": "BYTES", "tinyint": "INT64", "smallint": "INT64", "int": "INT64", "bigint": "INT64", "float": "FLOAT64", "double": "FLOAT64", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "DATETIME"}
    name = kind.simpleString()
    if name.startswith("time("):
        return "TIME"
    if name not in names:
        raise ValueError(f"{path}: no column can be {name}")
    return names[name]


def relational_type(kind: T.DataType, dialect: str = "standard") -> str:
    """The relational service's name of a column type."""
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, T.ArrayType):
        inner = relational_type(kind.elementType, dialect)
        return f"ARRAY<{inner}>" if dialect == "standard" else f"{inner}[]"
    if isinstance(kind, T.DecimalType):
        if dialect == "standard" and (kind.precision, kind.scale) != (38, 9):
            raise ValueError("NUMERIC is DECIMAL(38,9)")
        return "NUMERIC" if dialect == "standard" else "numeric"
    # Names of the scalar types in both dialects.
    names = {
        "string": ("STRING(MAX)", "varchar"),
        "boolean": ("BOOL", "boolean"),
        "binary": ("BYTES(MAX)", "bytea"),
        "bigint": ("INT64", "bigint"),
        "float": ("FLOAT32", "real"),
        "double": ("FLOAT64", "double precision"),
        "date": ("DATE", "date"),
        "timestamp": ("TIMESTAMP", "timestamptz"),
    }
    name = kind.simpleString()
    if name not in names:
        raise ValueError(f"no column can be {name}")
    return names[name][dialect != "standard"]


def ddl(table: str, schema: T.StructType, primary_key: list[str] | None = None) -> str:
    """A CREATE TABLE statement with the warehouse's types."""
    check_names(schema)
    columns = [f"  {f.name} {warehouse_type(f.dataType, f.name)}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields]
    if primary_key:
        columns.append(f"  PRIMARY KEY ({', '.join(primary_key)}) NOT ENFORCED")
    return f"CREATE TABLE {table} (\n" + ",\n".join(columns) + "\n)"


def cell_weights(mutations: DataFrame, indexes: DataFrame, columns: list[str], table: str = "table", delete: str = "is_delete") -> DataFrame:
    """Mutations with what they cost: each written column counts once and once per index on it.

    A delete counts once and once per index of its table. ``indexes`` has table, index
    and column; it is service metadata of some rows per table.
    """
    per_column = indexes.groupBy(table, "column").agg(F.countDistinct("index").alias("n"))
    by_table = per_column.groupBy(table).agg(F.map_from_entries(F.collect_list(F.struct("column", "n"))).alias("_by_column"))
    totals = indexes.groupBy(table).agg(F.countDistinct("index").alias("_indexes"))
    known = by_table.join(totals, table)
    joined = mutations.join(known, table, "left")
    each = [F.when(F.col(c).isNotNull(), 1 + F.coalesce(F.try_element_at("_by_column", F.lit(c)), F.lit(0))).otherwise(0) for c in columns]
    written = reduce(lambda a, b: a + b, each, F.lit(0))
    weight = F.when(F.col(delete), 1 + F.coalesce("_indexes", F.lit(0))).otherwise(written)
    return joined.withColumn("cells", weight.cast("long")).drop("_by_column", "_indexes")
