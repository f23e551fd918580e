"""Wide-column tables: rows of families and qualifiers over a table of cells.

The stored truth is one row per cell version: row_key, family, qualifier, ts_micros,
value. A table row exists exactly where one of its retained cells does, so which
families are read decides which rows appear.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codec import decode_cell, encode_cell

CELL = ["row_key", "family", "qualifier", "ts_micros", "value"]

#: Families of a table: family -> {qualifier: type}.
Families = dict[str, dict[str, str]]


def to_cells(df: DataFrame, row_key: Column, families: Families, columns: dict[tuple[str, str], str], ts_micros: Column | None = None) -> DataFrame:
    """The cells of upserted rows: every qualifier of each family is written.

    ``columns`` names the source column of each (family, qualifier). A family whose
    columns are all null writes no cells; a null or empty key is an error.
    """
    checked = F.when(row_key.isNotNull() & (F.octet_length(row_key) > 0), row_key).otherwise(F.raise_error(F.lit("a row needs a non-empty key")).cast("string"))
    stamp = ts_micros if ts_micros is not None else F.lit(0).cast("bigint")
    cells = []
    for family, qualifiers in families.items():
        written = reduce(lambda a, b: a | b, [F.col(columns[family, q]).isNotNull() for q in qualifiers])
        own = [F.struct(F.lit(family).alias("family"), F.lit(q).alias("qualifier"), encode_cell(F.col(columns[family, q]), t).alias("value")) for q, t in qualifiers.items()]
        cells.append(F.when(written, F.array(*own)).otherwise(F.array().cast("array<struct<family:string,qualifier:string,value:binary>>")))
    flat = df.select(F.encode(checked, "UTF-8").alias("row_key"), stamp.alias("ts_micros"), F.explode(F.concat(*cells)).alias("c"))
    return flat.select("row_key", "c.family", "c.qualifier", "ts_micros", "c.value")


def latest(cells: DataFrame) -> DataFrame:
    """The newest version of each cell."""
    return cells.groupBy("row_key", "family", "qualifier").agg(F.max(F.struct("ts_micros", "value")).alias("v")).select("row_key", "family", "qualifier", "v.ts_micros", "v.value")


def as_of(cells: DataFrame, ts_micros: int) -> DataFrame:
    """The newest version of each cell that is not younger than an instant."""
    return latest(cells.filter(F.col("ts_micros") <= ts_micros))


def read_rows(cells: DataFrame, families: Families, key_type: str = "string") -> DataFrame:
    """row_key and a struct per family, from newest cells.

    Only cells of the named families are read. A family without cells in a row is null;
    without any family the keys of all rows are read.
    """
    if not families:
        return cells.select(decode_cell(F.col("row_key"), key_type, nullable=False).alias("row_key")).distinct()
    kept = cells.filter(F.col("family").isin(*families))
    values = []
    for family, qualifiers in families.items():
        here = F.col("family") == family
        values.append(F.max(here).alias(f"has_{family}"))
        for q in qualifiers:
            values.append(F.max(F.when(here & (F.col("qualifier") == q), F.struct("ts_micros", "value")))["value"].alias(f"{family}.{q}"))
    # versions compete inside the one aggregation: no separate pass for the newest
    grouped = kept.groupBy("row_key").agg(*values)
    out = [decode_cell(F.col("row_key"), key_type, nullable=False).alias("row_key")]
    for family, qualifiers in families.items():
        fields = [decode_cell(F.col(f"`{family}.{q}`"), t).alias(q) for q, t in qualifiers.items()]
        out.append(F.when(F.col(f"has_{family}"), F.struct(*fields)).alias(family))
    return grouped.select(*out)


def with_cell_value(cells: DataFrame, family: str, qualifier: str, value: Column) -> DataFrame:
    """All cells of the rows of which some version of one cell has a value.

    A best-effort reduction before reading: the exact predicate on the newest version
    has to be applied to the rows all the same.
    """
    keys = cells.filter((F.col("family") == family) & (F.col("qualifier") == qualifier) & (F.col("value") == value)).select("row_key").distinct()
    return cells.join(keys, "row_key", "left_semi")


def collect_garbage(cells: DataFrame, max_versions: int | None = None, min_ts_micros: int | None = None, both: bool = False) -> DataFrame:
    """The versions that a garbage rule keeps.

    A version goes when it is beyond the newest ``max_versions`` or older than
    ``min_ts_micros``; with ``both`` only when it is beyond both.
    """
    if max_versions is None and min_ts_micros is None:
        return cells
    versions = Window.partitionBy("row_key", "family", "qualifier").orderBy(F.desc("ts_micros"), F.desc("value"))
    old = F.col("ts_micros") < F.lit(min_ts_micros) if min_ts_micros is not None else None
    if max_versions is None:
        return cells.filter(~old)
    surplus = F.col("_version") > max_versions
    gone = surplus if old is None else (surplus & old if both else surplus | old)
    return cells.withColumn("_version", F.row_number().over(versions)).filter(~gone).drop("_version")


def apply_mutations(cells: DataFrame, mutations: DataFrame) -> DataFrame:
    """Newest cells after upserts and row deletions.

    ``mutations`` has the columns of cells and ``kind``: '+I' and '+U' write a cell,
    '-D' deletes the whole row up to its ts_micros, '-U' is refused.
    """
    kind = F.when(F.col("kind").isin("+I", "+U", "-D"), F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("a table cannot apply "), F.coalesce("kind", F.lit("null")))).cast("string"))
    checked = mutations.withColumn("kind", kind)
    deleted = checked.filter("kind = '-D'").groupBy("row_key").agg(F.max("ts_micros").alias("_gone"))
    written = cells.select(*CELL).unionByName(checked.filter("kind <> '-D'").select(*CELL))
    alive = written.join(deleted, "row_key", "left").filter(F.col("_gone").isNull() | (F.col("ts_micros") > F.col("_gone")))
    return latest(alive.drop("_gone"))


def cell_micros(ts: Column, truncate_to_millis: bool = False) -> Column:
    micros = F.unix_micros(ts.cast("timestamp"))
    return micros - F.pmod(micros, F.lit(1000)) if truncate_to_millis else micros
