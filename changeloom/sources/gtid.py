"""Sets of executed transactions: server ids with intervals of transaction numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Intervals = dict[str, list[tuple[int, int]]]


def parse(text: str) -> Intervals:
    """`sid:1-5:7,sid2:3` as closed intervals, merged and sorted."""
    found: Intervals = {}
    for part in filter(None, (p.strip() for p in text.replace("\n", "").split(","))):
        sid, *ranges = part.split(":")
        if not ranges:
            raise ValueError(f"no transactions in {part!r}")
        for r in ranges:
            low, _, high = r.partition("-")
            found.setdefault(sid.lower(), []).append((int(low), int(high or low)))
    return {sid: _merged(ranges) for sid, ranges in sorted(found.items())}


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if high < low or low < 1:
            raise ValueError(f"bad interval {low}-{high}")
        if out and low <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(high, out[-1][1])
        else:
            out.append((low, high))
    return out


def merge(*sets: Intervals) -> Intervals:
    every: Intervals = {}
    for s in sets:
        for sid, ranges in s.items():
            every.setdefault(sid, []).extend(ranges)
    return {sid: _merged(ranges) for sid, ranges in sorted(every.items())}


def text(intervals: Intervals) -> str:
    spell = lambda r: str(r[0]) if r[0] == r[1] else f"{r[0]}-{r[1]}"
    return ",".join(f"{sid}:{':'.join(map(spell, ranges))}" for sid, ranges in intervals.items())


def interval_sets(transactions: DataFrame) -> DataFrame:
    """server_id and the text of its set of transactions, from rows of server_id and txn_id.

    Runs are numbered by server, so one server's distinct transactions are ordered in one task.
    """
    w = Window.partitionBy("server_id").orderBy("txn_id")
    runs = transactions.select(F.lower("server_id").alias("server_id"), "txn_id").distinct().withColumn("run", F.col("txn_id") - F.row_number().over(w))
    runs = runs.groupBy("server_id", "run").agg(F.min("txn_id").alias("low"), F.max("txn_id").alias("high"))
    spelled = F.when(F.col("low") == F.col("high"), F.col("low").cast("string")).otherwise(F.format_string("%d-%d", "low", "high"))
    every = F.sort_array(F.collect_list(F.struct("low", spelled.alias("t"))))
    return runs.groupBy("server_id").agg(F.concat_ws(":", F.col("server_id"), F.array_join(F.transform(every, lambda x: x["t"]), ":")).alias("transactions"))


def contains(intervals: Intervals, server_id: Column, txn_id: Column) -> Column:
    """Whether a transaction is in the set, as an expression that a Parquet scan can push down."""
    found = F.lit(False)
    for sid, ranges in intervals.items():
        inside = F.lit(False)
        for low, high in ranges:
            inside = inside | txn_id.between(low, high)
        found = found | ((server_id == sid) & inside)
    return found


def up_to(server_id: Column, txn_id: Column) -> Column:
    """The text of all transactions up to one; empty for snapshot rows."""
    return F.when(server_id == "dump", "").otherwise(F.format_string("%s:1-%d", server_id, txn_id))
