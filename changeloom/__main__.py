"""Replicate a change feed on storage into Parquet tables: `python -m changeloom catalog.json [flags]`.

The catalogue names where the feed, the tables and the checkpoints lie, and the source tables:
either a database that is asked for them and scanned for snapshots,

    {"feed": "...", "tables": "...", "checkpoints": "...",
     "database": {"url": "jdbc:mysql://{addr}/{db}", "options": {"driver": "..."}}}

(`{addr}` and `{db}` come from --mysql-addr and --mysql-db, the login from --mysql-user and
--mysql-password), or their columns by hand and a folder of snapshots:

    {..., "snapshots": "...", "sources": {"orders": {"columns": {"id": "bigint", ...}, "pk": ["id"]}}}

"tables" is a folder, where the state lies too. Destination tables may be in a Spark catalogue
instead, or in a database that becomes one (`{addr}` from --clickhouse-addr, the schema from
--clickhouse-db, the login from --clickhouse-username and --clickhouse-password):

    {..., "destination": {"namespace": "spark_catalog.default"}}
    {..., "destination": {"url": "jdbc:...://{addr}/{db}", "options": {"driver": "..."}}}
"""

from __future__ import annotations

import json
import logging
import os
import signal
import sys

from pyspark.sql import DataFrame, SparkSession

from .config import Config, load
from .functions.types import SourceColumn, SourceTable
from .sources.changefeed import ChangeSource, stream_feed
from .sources.database import MYSQL, DatabaseSource, Dialect
from .sources.stores import CatalogTargets, ParquetState, ParquetTargets, TargetStore, jdbc_catalog
from .streaming.engine import Engine
from .streaming.metrics import serve


class FolderSource:
    """Changes, snapshots and schemas on storage, as a catalogue names them."""

    def __init__(self, spark: SparkSession, catalogue: dict, config: Config):
        self.spark, self.catalogue, self.config = spark, catalogue, config

    def changes(self) -> DataFrame:
        return stream_feed(self.spark, self.catalogue["feed"], max_files=self.config.max_files or None)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.catalogue['snapshots']}/{name}")

    def tables(self) -> dict[str, SourceTable]:
        return {
            name: SourceTable(name, tuple(SourceColumn(c, t) for c, t in table["columns"].items()), tuple(table.get("pk", ())), self.config.mysql_db)
            for name, table in self.catalogue["sources"].items()
        }


class FeedAndDatabase(FolderSource):
    """Changes on storage; schemas and snapshots from the database itself."""

    def __init__(self, spark: SparkSession, catalogue: dict, config: Config, dialect: Dialect = MYSQL):
        super().__init__(spark, catalogue, config)
        own = catalogue["database"]
        url = own["url"].replace("{addr}", config.mysql_addr).replace("{db}", config.mysql_db)
        self.database = DatabaseSource(spark, url, config.mysql_db, config.mysql_user, config.mysql_password, dialect, config.scan_partitions, options=own.get("options"))

    def table(self, name: str) -> DataFrame:
        return self.database.table(name)

    def tables(self) -> dict[str, SourceTable]:
        return self.database.tables()


def source_of(spark: SparkSession, catalogue: dict, config: Config) -> ChangeSource:
    return (FeedAndDatabase if "database" in catalogue else FolderSource)(spark, catalogue, config)


def targets_of(spark: SparkSession, catalogue: dict, config: Config) -> TargetStore:
    own = catalogue.get("destination")
    if own is None:
        return ParquetTargets(spark, catalogue["tables"])
    if "namespace" in own:
        return CatalogTargets(spark, own["namespace"])
    url = own["url"].replace("{addr}", config.clickhouse_addr).replace("{db}", config.clickhouse_db)
    name = jdbc_catalog(spark, "destination", url, config.clickhouse_username, config.clickhouse_password, options=own.get("options"))
    return CatalogTargets(spark, f"{name}.`{config.clickhouse_db}`")


def main(arguments: list[str]) -> int:
    logging.basicConfig(level=logging.INFO)
    if not arguments or arguments[0].startswith("-"):
        print(__doc__, file=sys.stderr)
        return 2
    with open(arguments[0]) as file:
        catalogue = json.load(file)
    config = load(arguments[1:], dict(os.environ))
    spark = SparkSession.builder.appName("changeloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    targets, state = targets_of(spark, catalogue, config), ParquetState(spark, catalogue["tables"])
    source = source_of(spark, catalogue, config)
    engine = Engine(spark, source.tables(), targets, state, config)
    engine.check()
    server = serve(engine.stats)
    for number in (signal.SIGINT, signal.SIGTERM):
        signal.signal(number, engine.shutdown)
    reader = source.table if "database" in catalogue or "snapshots" in catalogue else None
    try:
        engine.supervise(source.changes(), catalogue["checkpoints"], reader)
    finally:
        server.shutdown()
        logging.info(engine.stats.report())
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
