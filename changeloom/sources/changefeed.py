"""The change feed: envelopes of row changes, batch or streaming.

Raw events have one row per rows event: its type, transaction, table, the column names of
the time (empty if unknown) and all row images as text, updates with before and after
images in turn. Envelopes have one row per changed row. Events are numbered in their
transaction before anything is filtered, so numbers stay the same when tables are added.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import SourceTable

_TEXTS = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


RAW_SCHEMA = _struct(
    event_type=T.StringType(), server_id=T.StringType(), txn_id=T.LongType(), event_no=T.LongType(), commit_ts=T.TimestampType(),
    db=T.StringType(), table=T.StringType(), column_names=_TEXTS, rows=T.ArrayType(_TEXTS),
)
ENVELOPE_SCHEMA = _struct(
    server_id=T.StringType(), txn_id=T.LongType(), event_no=T.LongType(), row_no=T.IntegerType(), action=T.StringType(), commit_ts=T.TimestampType(),
    db=T.StringType(), table=T.StringType(), column_names=_TEXTS, before=_TEXTS, after=_TEXTS,
)
#: Rows events by kind of change; the log has other events, which carry no rows.
ACTIONS = {
    "WriteRowsEventV0": "insert", "WriteRowsEventV1": "insert", "WriteRowsEventV2": "insert",
    "UpdateRowsEventV0": "update", "UpdateRowsEventV1": "update", "UpdateRowsEventV2": "update",
    "DeleteRowsEventV0": "delete", "DeleteRowsEventV1": "delete", "DeleteRowsEventV2": "delete",
}


class ChangeSource(Protocol):
    """What a source gives the engine: its changes as a stream of envelopes, its tables by name
    as they are now, and what they look like."""

    def changes(self) -> DataFrame: ...

    def table(self, name: str) -> DataFrame: ...

    def tables(self) -> dict[str, SourceTable]: ...


def read_feed(spark: SparkSession, path: str, schema: T.StructType = ENVELOPE_SCHEMA, format_: str = "parquet") -> DataFrame:
    return spark.read.schema(schema).format(format_).load(path)


def stream_feed(spark: SparkSession, path: str, schema: T.StructType = ENVELOPE_SCHEMA, format_: str = "parquet", max_files: int | None = None) -> DataFrame:
    """New files of a folder, in order of arrival; `max_files` a batch bounds what is admitted."""
    reader = spark.readStream.schema(schema).format(format_)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def number_events(events: DataFrame, position: str) -> DataFrame:
    """event_no from the position of rows events in the log, for readers that have none.

    Counts rows events of all schemas and tables, from 1 in each transaction.
    """
    order = Window.partitionBy("server_id", "txn_id").orderBy(position)
    return events.withColumn("event_no", F.row_number().over(order).cast("long"))


def envelopes(events: DataFrame) -> DataFrame:
    """One row per changed row of raw events: rows events only, images paired, rows numbered."""
    events = events.filter(F.col("event_type").isin(*ACTIONS))
    kind = F.create_map(*(F.lit(x) for pair in ACTIONS.items() for x in pair))[F.col("event_type")]
    rows, null = F.col("rows"), F.lit(None).cast("array<string>")
    pair = F.transform(
        F.sequence(F.lit(0), (F.size(rows) / 2).cast("int") - 1),
        lambda i: F.struct(F.get(rows, 2 * i).alias("before"), F.get(rows, 2 * i + 1).alias("after")),
    )
    one = lambda before: F.transform(rows, lambda r: F.struct((r if before else null).alias("before"), (null if before else r).alias("after")))
    images = F.when(kind == "update", F.when(F.size(rows) >= 2, pair)).when(kind == "delete", one(True)).otherwise(one(False))
    events = events.select("*", kind.alias("action"), F.posexplode(images).alias("row_no", "image"))
    return events.select(
        "server_id", "txn_id", "event_no", "row_no", "action", "commit_ts", "db", "table", "column_names",
        F.col("image.before").alias("before"), F.col("image.after").alias("after"),
    )


def select_tables(feed: DataFrame, db: str, tables: list[str]) -> DataFrame:
    """Changes of one schema's tables that have a destination. Both filters reach the scan."""
    return feed.filter((F.col("db") == db) & F.col("table").isin(*tables))
