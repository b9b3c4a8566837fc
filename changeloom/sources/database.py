"""A relational source over JDBC: its tables, their columns and keys, variables, and scans.

The database's own catalogue says what the tables look like, so nothing is typed by hand. A
table is scanned by several queries over ranges of a whole-number key column; which ranges is
decided by one query for its bounds. The driver's jar must be on the class path.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.types import SourceColumn, SourceTable

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def quoted(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("'", "''") + "'"


@dataclass(frozen=True)
class Dialect:
    """What is asked of one kind of database. `columns` gives table_name, column_name,
    column_type in order; `keys` gives table_name, column_name in the order of the key;
    `variable` gives one value."""

    tables: str
    columns: str
    keys: str
    variable: str
    name: Callable[[str, str], str] = field(default=lambda db, table: f"`{db}`.`{table}`")
    bound: Callable[[str], str] = field(default=lambda column: f"`{column}`")


MYSQL = Dialect(
    tables="SELECT table_name AS table_name FROM information_schema.tables WHERE table_schema = {db} AND table_type = 'BASE TABLE'",
    columns="SELECT table_name AS table_name, column_name AS column_name, column_type AS column_type, ordinal_position AS place FROM information_schema.columns WHERE table_schema = {db}",
    keys="SELECT table_name AS table_name, column_name AS column_name, ordinal_position AS place FROM information_schema.key_column_usage WHERE table_schema = {db} AND constraint_name = 'PRIMARY'",
    variable="SELECT {name} AS value",
)


class DatabaseSource:
    """One schema of a database. `options` are passed to every JDBC query (driver, properties)."""

    def __init__(self, spark: SparkSession, url: str, db: str, user: str = "", password: str = "", dialect: Dialect = MYSQL, partitions: int = 8, fetch_size: int = 10_000, query_seconds: int = 0, options: dict[str, str] | None = None):
        self.spark, self.db, self.dialect, self.partitions = spark, db, dialect, partitions
        self.options = {"url": url, "fetchsize": str(fetch_size), "queryTimeout": str(query_seconds)} | (options or {})
        if user:
            self.options |= {"user": user, "password": password}

    def query(self, sql: str) -> DataFrame:
        """The rows of a query, column names in lower case."""
        found = self.spark.read.format("jdbc").options(**self.options).option("query", sql).load()
        return found.toDF(*(c.lower() for c in found.columns))

    def table_names(self) -> list[str]:
        return sorted(r.table_name for r in self.query(self.dialect.tables.format(db=quoted(self.db))).collect())

    def variable(self, name: str) -> str | None:
        row = self.query(self.dialect.variable.format(name=name)).first()
        return None if row is None or row.value is None else str(row.value)

    def tables(self) -> dict[str, SourceTable]:
        """Every table with its columns, their declared types and its key, as they are now."""
        columns: dict[str, list] = {}
        for r in self.query(self.dialect.columns.format(db=quoted(self.db))).collect():
            columns.setdefault(r.table_name, []).append((r.place, r.column_name, r.column_type))
        keys: dict[str, list] = {}
        for r in self.query(self.dialect.keys.format(db=quoted(self.db))).collect():
            keys.setdefault(r.table_name, []).append((r.place, r.column_name))
        return {
            name: SourceTable(name, tuple(SourceColumn(c, str(kind).lower()) for _, c, kind in sorted(columns[name])), tuple(c for _, c in sorted(keys.get(name, []))), self.db)
            for name in self.table_names()
            if name in columns
        }

    def table(self, name: str) -> DataFrame:
        """All rows of a table as it is now; by ranges of the first whole-number column of its key."""
        source = self.tables().get(name)
        if source is None:
            raise ValueError(f"no table {name} in {self.db}")
        full = self.dialect.name(self.db, name)
        reader = self.spark.read.format("jdbc").options(**self.options).option("dbtable", full)
        plain = reader.load()
        kinds = {f.name: f.dataType for f in plain.schema}
        key = next((c for c in source.pk if isinstance(kinds.get(c), _WHOLE)), None)
        if key is None or self.partitions < 2:
            return plain
        bounds = self.query(f"SELECT MIN({self.dialect.bound(key)}) AS low, MAX({self.dialect.bound(key)}) AS high FROM {full}").first()
        if bounds.low is None or bounds.low == bounds.high:
            return plain
        # ranges only say which query reads a row; rows outside the bounds go to the outer ones
        return reader.options(partitionColumn=key, lowerBound=str(bounds.low), upperBound=str(bounds.high), numPartitions=str(self.partitions)).load()
