"""Full-table snapshots as envelopes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.types import SourceTable

#: Reads one source table with its current columns.
TableReader = Callable[[str], DataFrame]


def wanted(table: str, dumped: bool, running: bool, listed: frozenset[str], forced: bool) -> bool:
    """Whether a table is to be scanned: listed ones unless a scan runs, all if forced, and
    those that have never been scanned."""
    return (not running and table in listed) or forced or not dumped


def _text(name: str, kind: str):
    return F.col(name) if kind == "string" else F.col(name).cast("string")


def snapshot_envelopes(rows: DataFrame, table: SourceTable) -> DataFrame:
    """Rows of a source table as snapshot envelopes: their transaction number is an ordinal
    of the scan, which tells rows of one scan apart and nothing more."""
    kinds = dict(rows.dtypes)
    image = F.array(*(_text(c, kinds[c]) for c in table.column_names))
    return rows.select(
        F.lit("dump").alias("server_id"),
        (F.monotonically_increasing_id() + 1).alias("txn_id"),
        F.lit(1).cast("long").alias("event_no"),
        F.lit(0).alias("row_no"),
        F.lit("dump").alias("action"),
        F.current_timestamp().alias("commit_ts"),
        F.lit(table.db).alias("db"),
        F.lit(table.name).alias("table"),
        F.array(*map(F.lit, table.column_names)).alias("column_names"),
        F.lit(None).cast("array<string>").alias("before"),
        image.alias("after"),
    )
