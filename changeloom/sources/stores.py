"""Destination tables and state: Parquet folders or tables of a Spark catalogue, and their protocols."""

from __future__ import annotations

import json
import time
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from ..functions.types import TargetTable

POSITION_KEY = "last_synced_gtid_set"
STATE_TABLE = "binlog_sync_state"
CATALOGUE_TABLE = "_schemas"


def dumped_key(table: str) -> str:
    return f"dumped-{table}"


class StateStore(Protocol):
    def get(self, key: str) -> str: ...

    def set(self, key: str, value: str) -> None: ...

    def dumped(self, table: str) -> bool: ...

    def set_dumped(self, table: str, done: bool) -> None: ...


class TargetStore(Protocol):
    def table(self, name: str) -> TargetTable | None: ...

    def read(self, name: str) -> DataFrame: ...

    def append(self, name: str, rows: DataFrame) -> None: ...


def is_missing(error: AnalysisException) -> bool:
    """Whether a read failed because nothing is there, and for no other reason."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class ParquetTargets:
    """One folder a table, and a catalogue of their declared schemas.

    The catalogue holds each version of a table's schema, so that neither planning nor a
    look-up opens all files of a table; tables written elsewhere are entered when they are
    first met. Columns are added by `append` or `declare`; files that lack them read as null.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._versions = ParquetState(spark, root, CATALOGUE_TABLE)
        #: As last seen by `table`, which the engine asks for every batch.
        self._known: dict[str, StructType] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self, table: TargetTable) -> None:
        """The table with no rows; nothing happens if it is there."""
        if self.table(table.name) is None:
            self.spark.createDataFrame([], table.schema).coalesce(1).write.mode("append").parquet(self.path(table.name))
            self.declare(table.name, table.schema)

    def declare(self, name: str, schema: StructType) -> None:
        """Enter a table's schema; columns that it had and that are not given stay."""
        known = self._known.get(name) or self._schema(name) or StructType()
        more = [f for f in schema.fields if f.name not in known.names]
        if more or not known.fields:
            # another writer may have added columns since
            known = self._schema(name) or StructType()
            known = StructType([*known.fields, *(f for f in schema.fields if f.name not in known.names)])
            self._versions.set(name, known.json())
        self._known[name] = known

    def _schema(self, name: str) -> StructType | None:
        text = self._versions.get(name)
        return StructType.fromJson(json.loads(text)) if text else None

    def table(self, name: str) -> TargetTable | None:
        known = self._schema(name)
        if known is None:
            try:
                known = self.spark.read.option("mergeSchema", "true").parquet(self.path(name)).schema
            except AnalysisException as error:
                if is_missing(error):
                    return None
                raise
            self.declare(name, known)
        self._known[name] = known
        return TargetTable.from_schema(name, known)

    def read(self, name: str) -> DataFrame:
        known = self._known.get(name) or self._schema(name)
        reader = self.spark.read.schema(known) if known is not None else self.spark.read.option("mergeSchema", "true")
        return reader.parquet(self.path(name))

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path(name))
        self.declare(name, rows.schema)


class CatalogTargets:
    """Tables of a Spark catalogue: a metastore, a lake format, or a database behind `jdbc_catalog`.

    Columns are those of the catalogue; declared types travel as column metadata where the
    catalogue keeps it, and follow from the columns' own types elsewhere.
    """

    def __init__(self, spark: SparkSession, namespace: str):
        self.spark, self.namespace = spark, namespace

    def path(self, name: str) -> str:
        return f"{self.namespace}.`{name}`"

    def create(self, table: TargetTable) -> None:
        """The table with no rows; nothing happens if it is there."""
        if self.table(table.name) is None:
            self.spark.createDataFrame([], table.schema).write.saveAsTable(self.path(table.name))

    def table(self, name: str) -> TargetTable | None:
        if not self.spark.catalog.tableExists(self.path(name)):
            return None
        self.spark.catalog.refreshTable(self.path(name))
        return TargetTable.from_schema(name, self.read(name).schema)

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.path(name))

    def append(self, name: str, rows: DataFrame) -> None:
        """Columns that the table lacks are added; those that the rows lack are null."""
        kinds = dict(rows.dtypes)
        known = self.read(name).columns
        more = [c for c in rows.columns if c not in known]
        if more:
            self.spark.sql(f"ALTER TABLE {self.path(name)} ADD COLUMNS ({', '.join(f'`{c}` {kinds[c]}' for c in more)})")
        rows.select(*(F.col(f"`{c}`") if c in kinds else F.lit(None).alias(c) for c in [*known, *more])).write.insertInto(self.path(name))


def jdbc_catalog(spark: SparkSession, name: str, url: str, user: str = "", password: str = "", query_seconds: int = 60, options: dict[str, str] | None = None) -> str:
    """Register a database as a Spark catalogue, with a limit on each query; its name."""
    login = {"user": user, "password": password} if user else {}
    own = {"url": url, "queryTimeout": str(query_seconds)} | login | (options or {})
    spark.conf.set(f"spark.sql.catalog.{name}", "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    for key, value in own.items():
        spark.conf.set(f"spark.sql.catalog.{name}.{key}", value)
    return name


class ParquetState:
    """Keys and values; the last write of a key wins. Writes append, reads take the newest version."""

    def __init__(self, spark: SparkSession, root: str, table: str = STATE_TABLE):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{table}"
        self._schema = "key string, value string, version long"
        try:
            spark.read.parquet(self.path)
        except AnalysisException as error:
            if not is_missing(error):
                raise
            spark.createDataFrame([], self._schema).coalesce(1).write.mode("append").parquet(self.path)

    def frame(self) -> DataFrame:
        versions = self.spark.read.schema(self._schema).parquet(self.path)
        return versions.groupBy("key").agg(F.max_by("value", "version").alias("value"))

    def get(self, key: str) -> str:
        row = self.frame().filter(F.col("key") == key).first()
        return row.value if row else ""

    def set(self, key: str, value: str) -> None:
        self.spark.createDataFrame([(key, value, time.time_ns())], self._schema).coalesce(1).write.mode("append").parquet(self.path)

    def dumped(self, table: str) -> bool:
        return self.get(dumped_key(table)) == "true"

    def set_dumped(self, table: str, done: bool) -> None:
        self.set(dumped_key(table), "true" if done else "false")
