"""Changelogs: producing insert/update/delete rows, and applying them.

A changelog row is an ordinary row with ``_row_kind``: '+I', '-U', '+U' or '-D'.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sequences import comparable, is_valid

ROW_KIND = "_row_kind"

#: One transaction's changes to one table.
RECORD = (
    "table string, commit_ts timestamp, commit_nanos long, record_sequence string, mod_type string, capture_type string, "
    "mods array<struct<keys:string,new_values:string,old_values:string>>"
)


_OBJECT = "map<string,string>"


def _typed(values: Column, field: T.StructField, required: bool, place: str) -> Column:
    """One value of a parsed JSON object: an explicit null is null, an absent one an error where required."""
    text = F.try_element_at(values, F.lit(field.name))
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
        value = F.from_json(text, field.dataType, {"mode": "FAILFAST"})
    elif isinstance(field.dataType, T.BinaryType):
        value = F.unbase64(text)
    else:  # services write 64-bit numbers as strings
        value = text.cast(field.dataType)
    if not required:
        return value
    present = F.coalesce(F.map_contains_key(values, F.lit(field.name)), F.lit(False))
    return F.when(present, value).otherwise(F.raise_error(F.lit(f"{place} lacks {field.name}")).cast(field.dataType))


def expand(records: DataFrame, schema: T.StructType, primary_key: Sequence[str], mode: str = "full") -> DataFrame:
    """The changelog of change records, with their ordering columns.

    ``full`` gives whole rows: '+I', adjacent '-U' and '+U', '-D'. It needs records that
    capture new rows and old values; the row before an update is the row after it,
    overlaid with the old values. ``upsert`` gives '+I' and '+U' whole, and '-D' with the
    key alone. A record whose mods cannot all be converted, or that has none listed
    (null), or is of another kind than INSERT, UPDATE and DELETE, fails the query; an
    empty list gives no rows. Each JSON object is parsed once.
    """
    if mode not in ("full", "upsert"):
        raise ValueError(f"no changelog mode {mode}")
    key = [f for f in schema.fields if f.name in set(primary_key)]
    rest = [f for f in schema.fields if f.name not in set(primary_key)]
    if len(key) != len(set(primary_key)) or not key:
        raise ValueError("the primary key must be columns of the schema")
    if mode == "full":
        refuse = F.raise_error(F.lit("a full changelog needs new rows and old values")).cast("boolean")
        records = records.filter(F.when(F.col("capture_type") == "NEW_ROW_AND_OLD_VALUES", True).otherwise(refuse))
    mods = F.when(F.col("mods").isNotNull(), F.col("mods")).otherwise(F.raise_error(F.lit("a change record without mods")))
    parsed = F.transform(mods, lambda m: F.struct(*[F.from_json(m[c], _OBJECT).alias(c) for c in ("keys", "new_values", "old_values")]))
    flat = records.select("table", "commit_ts", "commit_nanos", "record_sequence", "mod_type", F.posexplode(parsed).alias("mod_number", "m"))

    def row(kind: str, source: str) -> Column:
        values = {f.name: _typed(F.col("m.keys"), f, True, "keys") for f in key}
        for f in rest:
            new = _typed(F.col("m.new_values"), f, source in ("new", "overlay"), "new values")
            old = _typed(F.col("m.old_values"), f, source == "old_row", "old values")
            if source == "overlay":
                changed = F.coalesce(F.map_contains_key("m.old_values", F.lit(f.name)), F.lit(False))
                values[f.name] = F.when(changed, old).otherwise(new)
            else:
                values[f.name] = {"new": new, "old_row": old}.get(source, F.lit(None).cast(f.dataType))
        return F.struct(F.lit(kind).alias(ROW_KIND), *[values[f.name].alias(f.name) for f in schema.fields])

    mod = F.col("mod_type")
    unknown = F.raise_error(F.concat(F.lit("no changelog row for a change of kind "), F.coalesce(mod, F.lit("null"))))
    if mode == "full":
        rows = (
            F.when(mod == "INSERT", F.array(row("+I", "new")))
            .when(mod == "UPDATE", F.array(row("-U", "overlay"), row("+U", "new")))
            .when(mod == "DELETE", F.array(row("-D", "old_row")))
            .otherwise(unknown)
        )
    else:
        rows = F.when(mod == "INSERT", F.array(row("+I", "new"))).when(mod == "UPDATE", F.array(row("+U", "new"))).when(mod == "DELETE", F.array(row("-D", "key"))).otherwise(unknown)
    out = flat.select("table", "commit_ts", "commit_nanos", "record_sequence", F.col("mod_number").cast("long"), F.posexplode(rows).alias("_n", "r"))
    return out.select(F.col(f"r.{ROW_KIND}").alias(ROW_KIND), *[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields], "commit_ts", "commit_nanos", "record_sequence", "mod_number", F.col("_n").cast("long").alias("row_number"))


#: One change record as JSON, as services with a JSON dialect give it.
JSON_RECORD = "table_name string, commit_timestamp timestamp, record_sequence string, mod_type string, value_capture_type string, mods array<struct<keys:string,new_values:string,old_values:string>>"


def decode_json_records(records: DataFrame, column: str = "record") -> DataFrame:
    """Change records written as JSON, in the columns of ``RECORD``; what is no such record fails the query.

    The values of a mod may be JSON objects or strings that hold them.
    """
    r = F.from_json(F.col(column), JSON_RECORD, {"mode": "FAILFAST", "timeZone": "UTC"})
    ts = F.get_json_object(column, "$.commit_timestamp")
    # digits behind the microseconds, which a timestamp does not hold
    digits = F.rpad(F.regexp_extract(ts, r"\.([0-9]+)", 1), 9, "0")
    parsed = records.withColumns({"_r": r, "_below": F.when(digits != "", F.substring(digits, 7, 3).cast("long")).otherwise(F.lit(0))})
    return parsed.select(
        F.col("_r.table_name").alias("table"),
        F.col("_r.commit_timestamp").alias("commit_ts"),
        (F.unix_micros("_r.commit_timestamp") * 1000 + F.col("_below")).alias("commit_nanos"),
        F.col("_r.record_sequence").alias("record_sequence"),
        F.col("_r.mod_type").alias("mod_type"),
        F.col("_r.value_capture_type").alias("capture_type"),
        F.col("_r.mods").alias("mods"),
    )


def envelope(mutations: DataFrame) -> DataFrame:
    """Every entry of every mutation as one inserted row, in order, with its mutation's own columns; see ``ENTRIES``."""
    carried = [c for c in mutations.columns if c != "entries"]
    return mutations.select(F.lit("+I").alias(ROW_KIND), *carried, F.inline(F.array_sort("entries")))


def from_versions(versions: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str], deleted: Column, mode: str = "full") -> DataFrame:
    """The changelog between successive versions of each key.

    A version is a row, or with ``deleted`` the end of one; deleting what is not there
    gives nothing.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    gone = F.coalesce(deleted, F.lit(False))
    seen = versions.withColumns({"_gone": gone, "_had": F.coalesce(~F.lag(gone).over(w), F.lit(False)), "_before": F.lag(F.struct(*values)).over(w), "_now": F.struct(*values)})

    def change(kind: str, image: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(image).alias("image"))

    nothing = F.struct(*[F.lit(None).cast(versions.schema[v].dataType).alias(v) for v in values])
    key_only = F.struct(F.lit("-D").alias("kind"), nothing.alias("image"))
    update = F.array(change("-U", "_before"), change("+U", "_now")) if mode == "full" else F.array(change("+U", "_now"))
    delete = F.array(change("-D", "_before")) if mode == "full" else F.array(key_only)
    kinds = F.when(~F.col("_gone") & ~F.col("_had"), F.array(change("+I", "_now"))).when(~F.col("_gone"), update).when(F.col("_had"), delete)
    carried = [c for c in versions.columns if c not in set(values)]
    exploded = seen.select(*carried, F.explode(kinds).alias("c"))
    return exploded.select(F.col("c.kind").alias(ROW_KIND), *carried, *[F.col(f"c.image.{v}").alias(v) for v in values])


def upsert_kinds(df: DataFrame) -> DataFrame:
    """A changelog fit for an upsert sink: an update's old row is refused, never taken for a deletion."""
    kind = F.col(ROW_KIND)
    return df.withColumn(ROW_KIND, F.when(kind.isin("+I", "+U", "-D"), kind).otherwise(F.raise_error(F.concat(F.lit("an upsert sink cannot take "), F.coalesce(kind, F.lit("null")))).cast("string")))


def require_insert_only(df: DataFrame) -> DataFrame:
    """Refuses anything but inserts."""
    kind = F.col(ROW_KIND)
    return df.withColumn(ROW_KIND, F.when(kind == "+I", kind).otherwise(F.raise_error(F.lit("an insert-only sink got a change")).cast("string")))


def materialize(changes: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The table after all changes: per key the row of highest order, unless that deletes it.

    One aggregation with map-side combine: a hot key's changes meet in their own tasks
    first.
    """
    rest = [c for c in changes.columns if c not in set(key)]
    place = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    last = upsert_kinds(changes).groupBy(*key).agg(F.max_by(F.struct(*rest), place).alias("_last"))
    return last.filter(F.col(f"_last.{ROW_KIND}") != "-D").select(*key, *[F.col(f"_last.{c}").alias(c) for c in rest if c != ROW_KIND])


def materialize_by_sequence(changes: DataFrame, key: Sequence[str], sequence: str, ingestion: str) -> DataFrame:
    """``materialize`` by change-sequence number; equal numbers in order of ingestion."""
    valid = F.when(F.coalesce(is_valid(F.col(sequence)), F.lit(False)), comparable(F.col(sequence))).otherwise(F.raise_error(F.lit("a change without valid sequence number")).cast("string"))
    return materialize(changes.withColumn("_sequence", valid), key, ["_sequence", ingestion]).drop("_sequence")


#: What a stored table keeps beside its columns: the order of each key's last change, and whether that deleted it.
ORDER, DELETED = "_order", "_deleted"


def stored(target: DataFrame, order: Sequence[Column | str], changes: DataFrame) -> DataFrame:
    """``target`` in the layout that ``merge`` keeps; rows of a plain table are older than any change."""
    if {ORDER, DELETED} <= set(target.columns):
        return target
    kind = changes.limit(0).select(_place(order).alias(ORDER)).schema[ORDER].dataType
    return target.select("*", F.lit(None).cast(kind).alias(ORDER), F.lit(False).alias(DELETED))


def visible(table: DataFrame) -> DataFrame:
    """The rows of a stored table, without deleted ones and without their order."""
    return table.filter(~F.col(DELETED)).drop(ORDER, DELETED)


def _place(order: Sequence[Column | str]) -> Column:
    return F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])


def merge(target: DataFrame, changes: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The stored table after ``changes``: each key keeps its change of highest order, whenever it came.

    A change replaces what is stored only if its order is not lower, so a late update
    loses against a newer row, and a late insert against a newer deletion; deleted keys
    stay as tombstones for that. Of equal orders the later batch wins. Read the result
    with ``visible``. Rows of untouched keys pass by a join with the keys alone; only
    touched rows and changes are shuffled.
    """
    before = stored(target, order, changes)
    names = [c for c in before.columns if c not in (ORDER, DELETED)]
    rest = [c for c in names if c not in set(key)]
    null = lambda c: F.lit(None).cast(before.schema[c].dataType)
    given = upsert_kinds(changes).select(
        *key,
        F.struct(_place(order).alias(ORDER), F.lit(1).alias("batch")).alias("_at"),
        F.struct(*[(F.col(c) if c in changes.columns else null(c)).cast(before.schema[c].dataType).alias(c) for c in rest], (F.col(ROW_KIND) == "-D").alias(DELETED)).alias("_row"),
    )
    last = given.groupBy(*key).agg(F.max("_at").alias("_at"), F.max_by("_row", "_at").alias("_row"))
    same = [before[k].eqNullSafe(last[k]) for k in key]
    touched = before.join(last.select(*key), same, "left_semi").select(
        *key, F.struct(F.col(ORDER), F.lit(0).alias("batch")).alias("_at"), F.struct(*rest, F.col(DELETED)).alias("_row")
    )
    decided = touched.unionByName(last).groupBy(*key).agg(F.max("_at").alias("_at"), F.max_by("_row", "_at").alias("_row"))
    fresh = decided.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest], F.col(f"_at.{ORDER}").alias(ORDER), F.col(f"_row.{DELETED}").alias(DELETED))
    return before.join(last.select(*key), same, "left_anti").unionByName(fresh)


# -- selected cells

ENTRIES = "array<struct<entry_index:int,kind:string,family:string,qualifier:string,value:string,bounded:boolean,computed:boolean>>"


def selected_cell(mutations: DataFrame, family: str, qualifier: str) -> DataFrame:
    """Each mutation as UPSERT with a value, DELETE, or UNRELATED, by what it does to one cell.

    ``mutations`` has row_key and entries; see ``ENTRIES``. The writers' protocol is one
    unbounded delete of the cell, then at most one set of it. Anything else that may
    touch the cell is an error: a set alone, a second delete or set, a bounded delete, a
    family delete, an aggregate, also where the qualifier is only known when applied.
    """
    mine = F.filter("entries", lambda e: (e["family"] == family) & (F.coalesce(e["computed"], F.lit(False)) | (e["qualifier"] == qualifier) | (e["kind"] == "DELETE_FAMILY")))
    state = F.aggregate(
        F.array_sort(mine),
        F.struct(F.lit("START").alias("at"), F.lit(None).cast("string").alias("value")),
        lambda acc, e: F.struct(
            F.when((acc["at"] == "START") & (e["kind"] == "DELETE_CELLS") & ~F.coalesce(e["bounded"], F.lit(False)) & ~F.coalesce(e["computed"], F.lit(False)), "DELETED")
            .when((acc["at"] == "DELETED") & (e["kind"] == "SET_CELL") & ~F.coalesce(e["computed"], F.lit(False)), "SET")
            .otherwise("BROKEN")
            .alias("at"),
            F.when(e["kind"] == "SET_CELL", e["value"]).otherwise(acc["value"]).alias("value"),
        ),
    )
    out = mutations.withColumn("_s", state)
    kind = (
        F.when(F.col("_s.at") == "START", "UNRELATED")
        .when(F.col("_s.at") == "DELETED", "DELETE")
        .when(F.col("_s.at") == "SET", "UPSERT")
        .otherwise(F.raise_error(F.lit("a mutation breaks the protocol of the selected cell")).cast("string"))
    )
    return out.withColumns({"change": kind, "cell_value": F.when(F.col("_s.at") == "SET", F.col("_s.value"))}).drop("_s")


# -- filters on change records


def filter_tables(records: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = (), column: str = "table") -> DataFrame:
    """Records whose table fully matches an included pattern, or none of the excluded."""
    if include and exclude:
        raise ValueError("either included or excluded tables")
    if include:
        return records.filter(F.col(column).rlike("^(?:" + "|".join(f"(?:{p})" for p in include) + ")$"))
    if exclude:
        return records.filter(~F.col(column).rlike("^(?:" + "|".join(f"(?:{p})" for p in exclude) + ")$"))
    return records


def filter_columns(records: DataFrame, values: Sequence[str], include: Sequence[str] = (), exclude: Sequence[str] = (), keys: Sequence[str] = (), skip_unchanged: bool = False, table: str = "table") -> DataFrame:
    """Maps of values reduced to columns whose ``table.column`` fully matches.

    Key columns always stay. With ``skip_unchanged`` a record goes when this has removed
    every value it had beside its keys; one that had none from the start stays.
    """
    if include and exclude:
        raise ValueError("either included or excluded columns")
    patterns, wanted = (include, True) if include else (exclude, False)
    if not patterns:
        return records
    regex = "^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")$"

    def kept(name: Column) -> Column:
        hit = F.concat_ws(".", F.col(table), name).rlike(regex)
        return (hit if wanted else ~hit) | name.isin(*keys) if keys else (hit if wanted else ~hit)

    def beside_keys(m: Column) -> Column:
        return F.size(F.filter(F.map_keys(m), lambda k: ~k.isin(*keys))) if keys else F.size(m)

    out = records
    if skip_unchanged:
        before = sum((F.coalesce(beside_keys(F.col(v)), F.lit(0)) for v in values), F.lit(0))
        after = sum((F.coalesce(beside_keys(F.map_filter(F.col(v), lambda k, _: kept(k))), F.lit(0)) for v in values), F.lit(0))
        out = out.filter((before == 0) | (after > 0))
    return out.withColumns({v: F.map_filter(F.col(v), lambda k, _: kept(k)) for v in values})


def filter_entries(mutations: DataFrame, families: Sequence[str] = (), qualifiers: Sequence[str] = (), exclude_families: Sequence[str] = (), exclude_qualifiers: Sequence[str] = ()) -> DataFrame:
    """Mutation entries reduced to included, or not excluded, families and ``family:qualifier`` names; empty mutations go.

    An entry without qualifier, such as the deletion of a family, passes what is said of
    qualifiers.
    """
    if (families and exclude_families) or (qualifiers and exclude_qualifiers):
        raise ValueError("either included or excluded names")

    def matches(name: Column, patterns: Sequence[str]) -> Column:
        return name.rlike("^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")$")

    def kept(e: Column) -> Column:
        keep, whole = F.lit(True), F.concat_ws(":", e["family"], e["qualifier"])
        if families or exclude_families:
            keep = keep & (matches(e["family"], families) if families else ~matches(e["family"], exclude_families))
        if qualifiers or exclude_qualifiers:
            keep = keep & (e["qualifier"].isNull() | (matches(whole, qualifiers) if qualifiers else ~matches(whole, exclude_qualifiers)))
        return keep

    return mutations.withColumn("entries", F.filter("entries", kept)).filter(F.size("entries") > 0)
