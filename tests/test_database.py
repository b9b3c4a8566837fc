"""A database source: catalogue, scan by key ranges, snapshots of it. Derby comes with Spark."""

import json

import pytest

from changeloom.__main__ import FeedAndDatabase, FolderSource, source_of, targets_of
from changeloom.config import Config
from changeloom.functions.types import SourceColumn, SourceTable
from changeloom.operators import schema as S
from changeloom.plans.feeds import target
from changeloom.sources import changefeed
from changeloom.sources.database import MYSQL, DatabaseSource, Dialect, quoted
from changeloom.sources.stores import ParquetState, ParquetTargets
from changeloom.streaming.engine import Engine

DERBY = Dialect(
    tables="SELECT t.tablename AS table_name FROM sys.systables t JOIN sys.sysschemas s ON s.schemaid = t.schemaid WHERE s.schemaname = {db} AND t.tabletype = 'T'",
    columns="SELECT t.tablename AS table_name, c.columnname AS column_name, CAST(c.columndatatype AS VARCHAR(80)) AS column_type, c.columnnumber AS place "
    "FROM sys.syscolumns c JOIN sys.systables t ON t.tableid = c.referenceid JOIN sys.sysschemas s ON s.schemaid = t.schemaid WHERE s.schemaname = {db}",
    # every test table has its key in its first columns
    keys="SELECT t.tablename AS table_name, c.columnname AS column_name, c.columnnumber AS place "
    "FROM sys.sysconstraints k JOIN sys.systables t ON t.tableid = k.tableid JOIN sys.syscolumns c ON c.referenceid = t.tableid JOIN sys.sysschemas s ON s.schemaid = t.schemaid "
    "WHERE s.schemaname = {db} AND k.type = 'P' AND c.columnnumber = 1",
    variable="SELECT CURRENT {name} AS value FROM sysibm.sysdummy1",
    name=lambda db, table: f'"{db}"."{table}"',
    bound=lambda column: f'"{column}"',
)


@pytest.fixture(scope="module")
def database(spark):
    url = "jdbc:derby:memory:shop;create=true"
    orders = spark.range(1, 1001).selectExpr("cast(id as int) as ID", "concat('name ', id) as NAME", "cast(id / 4 as decimal(10,2)) as PRICE")
    write = lambda df, name, types: df.write.format("jdbc").option("url", url).option("dbtable", name).option("createTableColumnTypes", types).mode("overwrite").save()
    write(orders, "ORDERS", "ID INT, NAME VARCHAR(100), PRICE DECIMAL(10,2)")
    write(spark.createDataFrame([("a", 1), ("b", 2)], "CODE string, N int"), "CODES", "CODE VARCHAR(9), N INT")
    manager = spark.sparkContext._jvm.java.sql.DriverManager
    spark.sparkContext._jvm.java.lang.Class.forName("org.apache.derby.jdbc.EmbeddedDriver")
    connection = manager.getConnection(url)
    try:
        statement = connection.createStatement()
        for table, key in (("ORDERS", "ID"), ("CODES", "CODE")):
            statement.execute(f"ALTER TABLE {table} ALTER COLUMN {key} NOT NULL")
            statement.execute(f"ALTER TABLE {table} ADD PRIMARY KEY ({key})")
    finally:
        connection.close()
    return url


def test_catalogue_and_variable(spark, database):
    source = DatabaseSource(spark, database, "APP", dialect=DERBY)
    assert source.table_names() == ["CODES", "ORDERS"] and source.variable("SCHEMA") == "APP"
    tables = source.tables()
    orders = tables["ORDERS"]
    assert orders.column_names == ("ID", "NAME", "PRICE") and orders.pk == ("ID",) and tables["CODES"].pk == ("CODE",) and orders.db == "APP"
    assert orders.columns[2].kind == "decimal" and orders.columns[1].kind == "text"
    assert DatabaseSource(spark, database, "NOBODY", dialect=DERBY).tables() == {}
    with pytest.raises(ValueError):
        source.table("NOTHING")


@pytest.mark.parametrize("name, partitions, want", [("ORDERS", 4, 4), ("ORDERS", 1, 1), ("CODES", 4, 1)])
def test_scan_by_key_ranges(spark, database, name, partitions, want):
    rows = DatabaseSource(spark, database, "APP", dialect=DERBY, partitions=partitions).table(name)
    assert rows.rdd.getNumPartitions() == want
    assert rows.count() == rows.distinct().count() == {"ORDERS": 1000, "CODES": 2}[name]


def test_snapshot_of_a_database_reaches_the_tables(spark, database, tmp_path):
    empty = spark.createDataFrame([], changefeed.ENVELOPE_SCHEMA)
    empty.write.parquet(f"file://{tmp_path}/feed")
    catalogue = {"feed": f"file://{tmp_path}/feed", "database": {"url": database}}
    config = Config(mysql_db="APP", scan_partitions=3, max_files=5)
    source = FeedAndDatabase(spark, catalogue, config, DERBY)
    targets, state = ParquetTargets(spark, f"file://{tmp_path}/tables"), ParquetState(spark, f"file://{tmp_path}/tables")
    targets.create(target("ORDERS", {"ID": "Int32", "NAME": "String", "PRICE": "UInt64"}))
    engine = Engine(spark, source.tables(), targets, state, config)
    assert engine.run_snapshot(source.table) == ["ORDERS"]
    assert engine.run_snapshot(source.table, force=True) == ["ORDERS"]
    rows = targets.read("ORDERS").orderBy("ID").collect()
    assert len(rows) == 1000 and (rows[2].ID, rows[2].NAME, rows[2].PRICE, rows[2][S.ACTION]) == (3, "name 3", 75, "dump")
    assert source.changes().isStreaming


def test_sources_of_a_catalogue(spark):
    by_hand = source_of(spark, json.loads('{"feed": "f", "sources": {"t": {"columns": {"id": "bigint"}, "pk": ["id"]}}}'), Config(mysql_db="d"))
    assert isinstance(by_hand, FolderSource) and by_hand.tables()["t"].pk == ("id",) and by_hand.tables()["t"].db == "d"
    asked = source_of(spark, {"database": {"url": "jdbc:mysql://{addr}/{db}"}}, Config(mysql_db="d", mysql_addr="h:1", mysql_user="u", mysql_password="p"))
    assert asked.database.options | {"fetchsize": "", "queryTimeout": ""} == {"url": "jdbc:mysql://h:1/d", "user": "u", "password": "p", "fetchsize": "", "queryTimeout": ""}
    assert asked.database.dialect is MYSQL and quoted("it's") == "'it''s'"


def test_tables_of_a_catalogue(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS store LOCATION 'file://{tmp_path}/store'")
    targets = targets_of(spark, {"destination": {"namespace": "spark_catalog.store"}}, Config())
    assert targets.table("orders") is None
    own = target("orders", {"ID": "Int32", "NAME": "LowCardinality(String)", "PRICE": "UInt64"})
    targets.create(own)
    targets.create(own)
    try:
        assert targets.table("orders").by_name["NAME"].type == "LowCardinality(String)"
        source = SourceTable("orders", tuple(SourceColumn(n, t) for n, t in (("ID", "int"), ("NAME", "varchar(9)"), ("PRICE", "decimal(10,2)"))), ("ID",), "APP")
        engine = Engine(spark, {"orders": source}, targets, ParquetState(spark, f"file://{tmp_path}/state"), Config(mysql_db="APP"))
        engine.check()
        rows = spark.createDataFrame([(1, "a", "1.50"), (2, "b", "2.00")], "ID int, NAME string, PRICE string")
        for _ in range(2):
            engine.run_snapshot(lambda _: rows, force=True)
        assert sorted((r.ID, r.NAME, r.PRICE) for r in targets.read("orders").collect()) == [(1, "a", 150), (2, "b", 200)]
        targets.append("orders", spark.createDataFrame([(3, 7)], "ID int, more int"))
        assert [(r.ID, r.NAME, r.more) for r in targets.read("orders").filter("ID > 1").orderBy("ID").collect()] == [(2, "b", None), (3, None, 7)]
        assert "more" in targets.table("orders").by_name
    finally:
        spark.sql("DROP DATABASE store CASCADE")


def test_a_database_as_destination_catalogue(spark, database):
    config = Config(clickhouse_db="APP", clickhouse_username="", clickhouse_addr="memory:shop")
    targets = targets_of(spark, {"destination": {"url": "jdbc:derby:{addr}"}}, config)
    assert targets.table("NOTHING") is None
    assert [c.name for c in targets.table("CODES").columns] == ["CODE", "N"]
    assert sorted(tuple(r) for r in targets.read("CODES").collect()) == [("a", 1), ("b", 2)]
    assert spark.conf.get("spark.sql.catalog.destination.queryTimeout") == "60"
