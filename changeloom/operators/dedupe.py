"""Deduplication within a batch and against what is stored.

Snapshot rows are known by their primary key, all others by (server, transaction, event
number, row number). Stored keys come from a range of the destination: the batch's bounds
are computed in one small aggregate and stand in the plan as literals, so that the scan
skips files and row groups. Both look-ups are anti-joins; which side is broadcast is
decided by Spark from measured sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import schema as S
from .translate import ROW

#: Servers named one by one in the pruning filter; beyond, one range over all of them. The filter
#: only prunes what is read: the anti-join behind it is exact in either case.
MOST_SERVERS = 64


def is_dump() -> Column:
    return F.col(S.ACTION) == "dump"


def pk_text(*columns: str) -> Column:
    """The key as one text, null parts left out."""
    return F.concat_ws("-", *(F.col(c).cast("string") for c in columns))


def event_key(stored: DataFrame | None = None) -> list[str]:
    """Columns that name a row of the change log, as far as the destination has them."""
    return [*S.EVENT_KEY, *([S.ROW_NO] if stored is not None and S.ROW_NO in stored.columns else [])]


def within_batch(rows: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """Each change once; each key's snapshot row once, and not if the batch changes that key.

    Snapshot rows of a table without a primary key are all kept.
    """
    events = rows.filter(~is_dump()).dropDuplicates([*S.EVENT_KEY, ROW])
    dumps = rows.filter(is_dump())
    if pk:
        dumps = dumps.dropDuplicates(list(pk))
        dumps = _anti(dumps, rows.filter(~is_dump()).select(*pk), list(pk))
    return events.unionByName(dumps)


def _anti(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key, nulls included, is not among `keys`."""
    other = keys.select(*(F.col(c).alias(f"__stored_{c}") for c in on))
    return rows.join(other, reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__stored_{c}")) for c in on)), "left_anti")


def pk_bounds(rows: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """Least and greatest key tuple of snapshot rows, and of each key column by itself."""
    key = F.struct(*pk)
    each = [f(c).alias(f"{n}_{c}") for c in pk for n, f in (("min", F.min), ("max", F.max))]
    return rows.filter(is_dump()).agg(F.min(key).alias("min_pk"), F.max(key).alias("max_pk"), F.count("*").alias("rows"), *each)


def txn_bounds(rows: DataFrame) -> DataFrame:
    """Least and greatest transaction of each server, over all but snapshot rows."""
    return rows.filter(~is_dump()).groupBy(S.SERVER_ID).agg(F.min(S.TXN_ID).alias("min_txn"), F.max(S.TXN_ID).alias("max_txn"))


def stored_events(stored: DataFrame, bounds: list) -> DataFrame:
    """Stored change keys in the batch's ranges."""
    one = lambda b: (F.col(S.SERVER_ID) == b[S.SERVER_ID]) & F.col(S.TXN_ID).between(b["min_txn"], b["max_txn"])
    if len(bounds) <= MOST_SERVERS:
        inside = reduce(lambda a, b: a | b, map(one, bounds))
    else:
        inside = F.col(S.TXN_ID).between(min(b["min_txn"] for b in bounds), max(b["max_txn"] for b in bounds))
    # rows stored before the destination had row numbers have none; they were the first of their event
    key = {S.ROW_NO: F.coalesce(F.col(S.ROW_NO), F.lit(0)).alias(S.ROW_NO)} if S.ROW_NO in stored.columns else {}
    return stored.filter(inside).select(*(key.get(c, F.col(c)) for c in event_key(stored))).distinct()


def drop_stored_events(rows: DataFrame, stored: DataFrame, bounds: list) -> DataFrame:
    """Changes that are not stored yet. `bounds`: collected rows of txn_bounds."""
    if not bounds:
        return rows
    on = event_key(stored)
    keys = stored_events(stored, bounds).select(*(F.col(c).alias(f"__stored_{c}") for c in on))
    own = {S.ROW_NO: F.col(ROW)}
    return rows.join(keys, reduce(lambda a, b: a & b, (own.get(c, F.col(c)) == F.col(f"__stored_{c}") for c in on)), "left_anti")


def drop_stored_dumps(rows: DataFrame, stored: DataFrame, pk: tuple[str, ...], bounds) -> DataFrame:
    """Snapshot rows whose key no stored row has, of any action. `bounds`: the row of pk_bounds."""
    if not pk or not bounds["rows"]:
        return rows
    # a box around the keys by single columns: a range of tuples would not be one of columns
    for c in pk:
        if bounds[f"min_{c}"] is not None:
            stored = stored.filter(F.col(c).between(bounds[f"min_{c}"], bounds[f"max_{c}"]) | F.col(c).isNull())
    return _anti(rows, stored.select(*pk).distinct(), list(pk))


def new_rows(rows: DataFrame, stored: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """All rows of a translated batch that the destination should get."""
    rows = within_batch(rows, pk)
    events = drop_stored_events(rows.filter(~is_dump()), stored, txn_bounds(rows).collect())
    dumps = rows.filter(is_dump())
    if pk:
        dumps = drop_stored_dumps(dumps, stored, pk, pk_bounds(rows, pk).first())
    return events.unionByName(dumps)
