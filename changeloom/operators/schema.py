"""Schemas on both sides: the columns every destination needs, and what both sides share."""

from __future__ import annotations

from ..functions.types import SourceColumn, SourceTable, TargetTable

CREATED_AT = "changelog_event_created_at"
ACTION = "changelog_action"
SERVER_ID = "changelog_gtid_server_id"
TXN_ID = "changelog_gtid_transaction_id"
EVENT_NO = "changelog_gtid_transaction_event_number"
UPDATED = "changelog_updated_columns"
#: Not required: distinguishes the rows of one event. Without it an event's rows share a key.
ROW_NO = "changelog_row_number"

#: Metadata columns and their declared types.
REQUIRED = {
    CREATED_AT: "DateTime64(9)",
    ACTION: "LowCardinality(String)",
    SERVER_ID: "LowCardinality(String)",
    TXN_ID: "UInt64",
    EVENT_NO: "UInt32",
    UPDATED: "Array(LowCardinality(String))",
}
METADATA = (*REQUIRED, ROW_NO)
EVENT_KEY = (SERVER_ID, TXN_ID, EVENT_NO)


class SchemaError(ValueError):
    """Some destination tables lack required columns; `problems` lists them by table."""

    def __init__(self, problems: dict[str, list[str]]):
        self.problems = problems
        super().__init__("; ".join(f"{t}: {', '.join(p)}" for t, p in sorted(problems.items())))


def check_schema(tables: list[TargetTable]) -> None:
    """Every required column by exact name and type, in every table; all gaps are told at once."""
    problems: dict[str, list[str]] = {}
    for table in tables:
        for name, kind in REQUIRED.items():
            own = table.by_name.get(name)
            if own is None:
                problems.setdefault(table.name, []).append(f"{name} {kind} is missing")
            elif own.type.replace(" ", "") != kind:
                problems.setdefault(table.name, []).append(f"{name} is {own.type}, not {kind}")
    if problems:
        raise SchemaError(problems)


def replicated_tables(sources: dict[str, SourceTable], targets: dict[str, TargetTable]) -> list[str]:
    """Tables that both sides have."""
    return sorted(sources.keys() & targets.keys())


def replicated_columns(source: SourceTable, target: TargetTable) -> list[tuple[int | None, SourceColumn]]:
    """Destination columns with their place in the source's current schema, in source order;
    then those that only an event's own column names can give."""
    data = {c.name for c in target.columns if c.name not in METADATA}
    shared = [(i, c) for i, c in enumerate(source.columns) if c.name in data]
    known = {c.name for _, c in shared}
    return shared + [(None, SourceColumn(c.name, "varchar")) for c in target.columns if c.name in data - known]


def target_pk(source: SourceTable, target: TargetTable) -> tuple[str, ...]:
    """The primary key's columns that the destination has."""
    return tuple(c for c in source.pk if c in target.by_name)
