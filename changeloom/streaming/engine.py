"""The replication engine: micro-batches of the change feed and snapshots into tables.

A batch of more than `batch_size` rows is applied in parts, cut between commit times. A part
is applied table by table: translate, drop what is stored, append, then note the
position. Appends are idempotent, because stored rows are looked up before, so a batch that
is retried, a replay from the start and a repeated snapshot write nothing twice. The stream's
checkpoint is the position; the state table mirrors the transactions that were applied.
"""

from __future__ import annotations

import contextlib
import io
import logging
import threading
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..functions.types import SourceTable, TargetTable
from ..operators import dedupe, schema
from ..operators.translate import KEPT, MISMATCH, NO_CHANGE, ROW, STATUS, UNKNOWN, Rules, translate
from ..sources import gtid, snapshot
from ..sources.changefeed import select_tables
from ..sources.stores import POSITION_KEY, StateStore, TargetStore
from .metrics import Stats

log = logging.getLogger(__name__)

#: A stream that lags less than this is caught up, and snapshots may start.
CAUGHT_UP_SECONDS = 10.0
RETRIES, PAUSE_SECONDS = 5, 1.0
_SKIPPED = {NO_CHANGE: "skipped_row_level_duplicates", MISMATCH: "skipped_column_mismatch", UNKNOWN: "skipped_unknown_actions"}


def batch_parts(feed: DataFrame, batch_size: int) -> DataFrame:
    """part, first_ts, rows: how a batch is cut by count. A commit time belongs to the part in
    which the rows before it end, so no transaction is cut, and a part has at most `batch_size`
    rows besides those of its last commit time. Rows without one come first."""
    times = feed.groupBy("commit_ts").agg(F.count("*").alias("n"))
    # one row a commit time of this batch, in one task
    upto = F.sum("n").over(Window.orderBy(F.col("commit_ts").asc_nulls_first()))
    parts = times.withColumn("part", F.floor((upto - F.col("n")) / batch_size).cast("long"))
    return parts.groupBy("part").agg(F.min("commit_ts").alias("first_ts"), F.sum("n").alias("rows"))


def plan_text(df: DataFrame) -> str:
    """What `explain` prints."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


class Engine:
    def __init__(self, spark: SparkSession, sources: dict[str, SourceTable], targets: TargetStore, state: StateStore, config: Config | None = None, stats: Stats | None = None):
        self.spark, self.sources, self.targets, self.state = spark, sources, targets, state
        self.config = config or Config()
        self.rules = Rules.of(self.config)
        self.stats = stats or Stats()
        self._dumping: set[str] = set()
        self._snapshots_done = False
        self._lock = threading.Lock()
        self._table_locks: dict[str, threading.Lock] = {}
        self._stop = threading.Event()
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def destination_tables(self) -> dict[str, TargetTable]:
        """Destination schemas as they are now; read for every batch, so columns may be added."""
        found = {name: self.targets.table(name) for name in self.sources}
        return {name: table for name, table in found.items() if table is not None}

    def check(self) -> None:
        schema.check_schema(list(self.destination_tables().values()))

    # batches

    def apply_in_parts(self, feed: DataFrame) -> None:
        """A micro-batch in parts of about `batch_size` rows, in order of commit time, so that the
        position moves on with each and a backlog is never one piece of work."""
        batch = feed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            starts = [r.first_ts for r in batch_parts(batch, self.config.batch_size).orderBy("part").collect()]
            for i in range(max(len(starts), 1)):
                part = batch
                if i:
                    part = part.filter(F.col("commit_ts") >= starts[i])
                if i + 1 < len(starts):
                    # rows without a commit time come first
                    part = part.filter(F.col("commit_ts").isNull() | (F.col("commit_ts") < starts[i + 1]) if i == 0 else F.col("commit_ts") < starts[i + 1])
                self.apply_batch(part)
        finally:
            batch.unpersist()

    def apply_batch(self, feed: DataFrame, tables: dict[str, TargetTable] | None = None) -> None:
        """Envelopes of any tables into their destinations, several tables at once."""
        tables = self.destination_tables() if tables is None else tables
        names = schema.replicated_tables(self.sources, tables)
        batch = self._after_start(feed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            own = select_tables(batch, self.config.mysql_db, names) if names else batch.limit(0)
            present = own.groupBy("table").agg(F.count("*").alias("n"), F.max(F.col("commit_ts").cast("double")).alias("newest")).collect()
            self.stats.add("enqueued_rows", sum(r.n for r in present))
            with ThreadPoolExecutor(max_workers=max(1, self.config.concurrent_batch_writes)) as pool:
                for done in [pool.submit(self._apply_table, own.filter(F.col("table") == r.table), self.sources[r.table], tables[r.table], r.n) for r in present]:
                    done.result()
            self._note_position(batch)
            self.stats.see(max((r.newest for r in present if r.newest is not None), default=None))
        finally:
            batch.unpersist()

    def _after_start(self, feed: DataFrame) -> DataFrame:
        """Without the transactions that `start_from_gtid` says are done."""
        if not self.config.start_from_gtid:
            return feed
        done = gtid.contains(gtid.parse(self.config.start_from_gtid), F.lower("server_id"), F.col("txn_id"))
        return feed.filter(~F.coalesce(done, F.lit(False)))

    def _apply_table(self, feed: DataFrame, source: SourceTable, target: TargetTable, n: int) -> None:
        with self._lock:
            one_writer = self._table_locks.setdefault(source.name, threading.Lock())
        with one_writer:
            rows = translate(feed, source, target, self.rules).persist(StorageLevel.MEMORY_AND_DISK)
            fresh = None
            try:
                for r in rows.filter(F.col(STATUS) != KEPT).groupBy(STATUS).count().collect():
                    self.stats.add(_SKIPPED[r[STATUS]], r["count"])
                kept = rows.filter(F.col(STATUS) == KEPT).drop(STATUS)
                pk = schema.target_pk(source, target)
                if len(pk) < len(source.pk):
                    log.warning("%s: the destination lacks key columns %s", source.name, sorted(set(source.pk) - set(pk)))
                fresh = dedupe.new_rows(kept, self.targets.read(source.name), pk).persist(StorageLevel.MEMORY_AND_DISK)
                is_dump = dedupe.is_dump()
                count = lambda df: df.agg(F.count_if(is_dump).alias("dumps"), F.count_if(~is_dump).alias("events")).first()
                before, after = count(kept), count(fresh)
                if self.config.profile:
                    with self._lock:  # it takes all that is printed
                        log.info("%s: %s", source.name, plan_text(fresh))
                if after.dumps + after.events:
                    self.targets.append(source.name, fresh.drop(ROW).sortWithinPartitions(schema.SERVER_ID, schema.TXN_ID))
                self.stats.add("skipped_persisted_duplicates", before.events - after.events)
                self.stats.add("skipped_dump_duplicates", before.dumps - after.dumps)
                self.stats.add("delivered_rows", after.dumps + after.events)
                self.stats.add("processed_rows", n)
            finally:
                if fresh is not None:
                    fresh.unpersist()
                rows.unpersist()

    def _note_position(self, batch: DataFrame) -> None:
        """Merge the batch's transactions into the stored set, after its rows are written."""
        seen = batch.filter(F.col("server_id") != "dump").groupBy("server_id").agg(F.max("txn_id").alias("last")).collect()
        if seen:
            stored = gtid.parse(self.state.get(POSITION_KEY))
            self.state.set(POSITION_KEY, gtid.text(gtid.merge(stored, {r.server_id: [(1, r.last)] for r in seen})))

    # snapshots

    def run_snapshot(self, reader: snapshot.TableReader, force: bool = False) -> list[str]:
        """Scan the tables that want it; a table counts as scanned once its rows are written."""
        tables = self.destination_tables()
        chosen = []
        with self._lock:
            for name in schema.replicated_tables(self.sources, tables):
                if snapshot.wanted(name, self.state.dumped(name), name in self._dumping, self.config.force_dump_tables, force):
                    self._dumping.add(name)
                    self.state.set_dumped(name, False)
                    chosen.append(name)

        def scan(name: str) -> None:
            try:
                rows = snapshot.snapshot_envelopes(reader(name), self.sources[name])
                self.apply_batch(rows, {name: tables[name]})
                self.state.set_dumped(name, True)
            finally:
                with self._lock:
                    self._dumping.discard(name)

        with ThreadPoolExecutor(max_workers=max(1, self.config.concurrent_mysql_dump_selects)) as pool:
            for done in [pool.submit(scan, name) for name in chosen]:
                done.result()
        return chosen

    def snapshot_due(self) -> bool:
        """Snapshots wait until the stream has caught up, unless they are to start at once, and
        never run beside an explicit start. A run of the engine has one snapshot: it is over once
        all tables that want it are scanned, and not due again."""
        if self.config.start_from_gtid or self._snapshots_done:
            return False
        lag = self.stats.lag_seconds
        return self.config.force_immediate_dump or (lag is not None and lag < CAUGHT_UP_SECONDS)

    # streams

    def start(self, feed: DataFrame, checkpoint: str, reader: snapshot.TableReader | None = None, available_now: bool = False) -> StreamingQuery:
        """One stream over the feed; snapshots run between its batches once they are due."""

        return self._start_at(feed, self.checkpoint_location(checkpoint), reader, available_now)

    def checkpoint_location(self, root: str) -> str:
        """A folder for each generation: replays start a new one, restarts keep the last."""
        generation = int(self.state.get("checkpoint_generation") or 0)
        if self.config.rewind or self.config.force_dump or self.config.force_immediate_dump or self.config.start_from_gtid:
            generation += 1
            self.state.set("checkpoint_generation", str(generation))
        return f"{root.rstrip('/')}/{generation}"

    def supervise(self, feed: DataFrame, checkpoint: str, reader: snapshot.TableReader | None = None, retries: int = RETRIES, pause: float = PAUSE_SECONDS) -> None:
        """Run until stopped; a failed stream starts again where it was, `retries` times in a row."""
        location = self.checkpoint_location(checkpoint)
        failures = 0
        while not self._stop.is_set():
            began = self.stats["delivered_rows"]
            query = self._start_at(feed, location, reader)
            try:
                while not self._stop.is_set() and not query.awaitTermination(1):
                    pass
                if self._stop.is_set():
                    query.stop()
                    return
            except Exception:
                failures = 1 if self.stats["delivered_rows"] > began else failures + 1
                if failures > retries:
                    raise
                log.exception("the stream failed; attempt %d of %d", failures, retries)
                time.sleep(pause)

    def _start_at(self, feed: DataFrame, location: str, reader: snapshot.TableReader | None, available_now: bool = False) -> StreamingQuery:
        def each(batch: DataFrame, _: int) -> None:
            self.apply_in_parts(batch)
            if reader is not None and self.snapshot_due():
                self.run_snapshot(reader, self.config.force_dump or self.config.force_immediate_dump)
                self._snapshots_done = True

        trigger = {"availableNow": True} if available_now else {"processingTime": f"{self.config.batch_write_interval.total_seconds()} seconds"}
        return feed.writeStream.foreachBatch(each).option("checkpointLocation", location).trigger(**trigger).start()

    def shutdown(self, *_: object) -> None:
        """Ask `supervise` to stop after the batch at work; fits a signal handler."""
        self._stop.set()
