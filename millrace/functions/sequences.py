"""Change-sequence numbers: sections of sixteen upper-case hex digits joined by '/'.

Their lexicographic order is the numeric order of the sections, so one string column
orders the changes of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sections of one sequence number, at most.
MAX_SECTIONS = 4


def sections(*numbers: Column) -> Column:
    """The sequence number of non-negative whole numbers; an error for negative ones."""
    if not 1 <= len(numbers) <= MAX_SECTIONS:
        raise ValueError(f"a sequence number has 1 to {MAX_SECTIONS} sections")
    parts = [_checked(n.cast("bigint") >= 0, F.lpad(F.hex(n.cast("bigint")), 16, "0"), "negative sequence section") for n in numbers]
    return F.concat_ws("/", *parts)


def _checked(condition: Column, value: Column, message: str) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), value).otherwise(F.raise_error(F.lit(message)))


def is_valid(sequence: Column) -> Column:
    """One to four sections of one to sixteen hex digits."""
    return sequence.rlike("^[0-9A-Fa-f]{1,16}(/[0-9A-Fa-f]{1,16}){0,3}$")


def comparable(sequence: Column) -> Column:
    """A form whose string order is the section-wise numeric order for any valid spelling."""
    return F.array_join(F.transform(F.split(F.upper(sequence), "/"), lambda s: F.lpad(s, 16, "0")), "/")


def from_commit(commit_nanos: Column, record_sequence: Column, mod_number: Column) -> Column:
    """Commit time in nanoseconds, decimal record sequence and number within the record."""
    return sections(commit_nanos, record_sequence.cast("bigint"), mod_number)


def from_mysql(snapshot: Column, gtid: Column, position: Column, row: Column, source_uuids: Sequence[str]) -> Column:
    """Sections epoch, transaction, position and row of a binlog event.

    The epoch is the place of the GTID's server in ``source_uuids``. Rows of an initial
    snapshot come before everything else; incremental snapshots are refused, since
    their rows have no place among the events, and so are unknown servers.
    """
    known = F.array(*[F.lit(u.lower()) for u in source_uuids])
    server = F.lower(F.trim(F.element_at(F.split(gtid, ":"), 1)))
    transaction = F.try_element_at(F.split(gtid, ":"), F.lit(2)).cast("bigint")
    epoch = F.array_position(known, server)
    live = _checked(
        epoch > 0,
        sections(epoch, transaction, position.cast("bigint"), F.coalesce(row.cast("bigint"), F.lit(0))),
        "GTID of an unknown source",
    )
    state = F.lower(F.coalesce(snapshot, F.lit("false")))
    zeros = F.lit("/".join(["0" * 16] * 4))
    return (
        F.when(state == "incremental", F.raise_error(F.lit("incremental snapshots have no sequence")).cast("string"))
        .when(state.isin("true", "first", "first_in_data_collection", "last", "last_in_data_collection"), zeros)
        .otherwise(live)
    )


def from_postgres(sequence: Column, lsn: Column) -> Column:
    """Sections of the last committed and the current position, from a JSON pair.

    The first may be null (nothing committed yet: 0); the second must be ``lsn``.
    """
    pair = F.from_json(sequence, "array<string>")
    committed, current = F.get(pair, F.lit(0)).cast("bigint"), F.get(pair, F.lit(1)).cast("bigint")
    right = (F.size(pair) == 2) & (current == lsn.cast("bigint"))
    return _checked(right, sections(F.coalesce(committed, F.lit(0)), current), "sequence does not belong to its position")


def from_ticdc(commit_ts: Column, cluster_id: Column, expected_cluster: str) -> Column:
    """The positive commit timestamp of events of one cluster."""
    right = (commit_ts.cast("bigint") > 0) & (cluster_id == expected_cluster)
    return _checked(right, sections(commit_ts.cast("bigint")), "event of another cluster or without commit timestamp")


def from_source(source: Column, mysql_uuids: Sequence[str] = (), ticdc_cluster: str = "") -> Column:
    """The sequence of a change event by the connector named in its source properties.

    ``source`` is a map of strings.
    """

    def get(key: str) -> Column:
        return F.try_element_at(source, F.lit(key))

    connector = F.lower(get("connector"))
    refuse = F.raise_error(F.concat(F.lit("no sequence for connector "), F.coalesce(connector, F.lit("(none)")))).cast("string")
    return (
        F.when(connector == "mysql", from_mysql(get("snapshot"), get("gtid"), get("pos"), get("row"), mysql_uuids) if mysql_uuids else refuse)
        .when(connector == "postgresql", from_postgres(get("sequence"), get("lsn")))
        .when(connector == "ticdc", from_ticdc(get("commit_ts"), get("cluster_id"), ticdc_cluster))
        .when(connector == "spanner", from_commit(get("ts_ns"), get("sequence"), get("mod_number")))
        .otherwise(refuse)
    )
