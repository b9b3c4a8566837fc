"""Change feeds and snapshots made of the analytical test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.types import SourceColumn, SourceTable, TargetColumn, TargetTable
from ..operators.schema import REQUIRED, ROW_NO

SERVER = "3e11fa47-71ca-11e1-9e33-c80aa9429562"

EVENTS = SourceTable(
    "events",
    (
        SourceColumn("event_id", "bigint"), SourceColumn("updated_at", "datetime"), SourceColumn("user_id", "bigint"),
        SourceColumn("event_type", "varchar(20)"), SourceColumn("value", "decimal(18,4)"), SourceColumn("props", "json"),
    ),
    ("user_id",),
)
ORDERS = SourceTable(
    "orders",
    (
        SourceColumn("o_orderkey", "bigint"), SourceColumn("o_custkey", "bigint"), SourceColumn("o_orderstatus", "char(1)"),
        SourceColumn("o_totalprice", "decimal(18,2)"), SourceColumn("o_orderdate", "datetime"), SourceColumn("o_orderpriority", "varchar(15)"),
    ),
    ("o_orderkey",),
)
CUSTOMER = SourceTable(
    "customer",
    (
        SourceColumn("c_custkey", "bigint"), SourceColumn("c_name", "varchar(25)"), SourceColumn("c_nationkey", "int"),
        SourceColumn("c_acctbal", "decimal(12,2)"), SourceColumn("c_mktsegment", "varchar(10)"),
    ),
    ("c_custkey",),
)


def target(name: str, columns: dict[str, str], row_no: bool = False) -> TargetTable:
    """A destination with the metadata columns."""
    every = columns | REQUIRED | ({ROW_NO: "UInt32"} if row_no else {})
    return TargetTable(name, tuple(TargetColumn(n, t) for n, t in every.items()))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _image(table: SourceTable, values: dict) -> F.Column:
    return F.array(*(values.get(c, F.col(c)).cast("string") for c in table.column_names))


def event_versions(spark: SparkSession, sf_dir: str, value=None) -> DataFrame:
    """Each user's events as versions of one row: the last one's image is the before image."""
    value = F.col("value").cast("decimal(18,4)") if value is None else value
    rows = read(spark, sf_dir, "events").withColumns({"value": value, "updated_at": F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")})
    rows = rows.withColumn("after", _image(EVENTS, {}))
    before = F.lag("after").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return rows.select(
        F.lit(SERVER).alias("server_id"), F.col("event_id").alias("txn_id"), F.lit(1).cast("long").alias("event_no"), F.lit(0).alias("row_no"),
        F.when(before.isNull(), "insert").otherwise("update").alias("action"), F.col("ts").cast("timestamp").alias("commit_ts"),
        F.lit("appdb").alias("db"), F.lit("events").alias("table"), F.array(*map(F.lit, EVENTS.column_names)).alias("column_names"),
        before.alias("before"), "after",
    )


def inserts(rows: DataFrame, table: SourceTable, txn: str, values: dict | None = None, names: bool = True) -> DataFrame:
    """Every row as an insert of its own transaction."""
    return rows.select(
        F.lit(SERVER).alias("server_id"), F.col(txn).cast("long").alias("txn_id"), F.lit(1).cast("long").alias("event_no"), F.lit(0).alias("row_no"),
        F.lit("insert").alias("action"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col(txn)).alias("commit_ts"), F.lit(table.db).alias("db"), F.lit(table.name).alias("table"),
        (F.array(*map(F.lit, table.column_names)) if names else F.array().cast("array<string>")).alias("column_names"),
        F.lit(None).cast("array<string>").alias("before"), _image(table, values or {}).alias("after"),
    )


def order_values(status: str = "o_orderstatus") -> dict:
    return {
        "o_orderstatus": F.col(status), "o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"),
        "o_orderdate": F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"),
    }
