"""End to end: change feeds and snapshots into tables, restarted and replayed."""

import urllib.request

import pytest
from pyspark.sql import functions as F

from changeloom import config as cfg
from changeloom.config import Config
from changeloom.functions.types import SourceColumn, SourceTable
from changeloom.operators import schema as S
from changeloom.operators.schema import SchemaError
from changeloom.plans.feeds import target
from changeloom.sources import changefeed, gtid
from changeloom.sources.stores import POSITION_KEY, ParquetState, ParquetTargets
from changeloom.streaming.engine import Engine
from changeloom.streaming.metrics import Stats, serve

SID = "3e11fa47-71ca-11e1-9e33-c80aa9429562"
SOURCE = SourceTable(
    "test",
    tuple(SourceColumn(n, t) for n, t in {
        "id": "int unsigned", "account_id": "int unsigned", "label": "varchar(100)", "name": "varchar(100)", "price": "decimal(10,2)", "price_two": "decimal(10,2)",
        "visits": "int", "description": "text", "created_at": "datetime", "ts_two": "datetime",
    }.items()),
    ("id",),
)
TARGET = {"id": "Int32", "name": "String", "price": "Decimal(10, 2)", "price_two": "UInt64", "description": "Nullable(String)", "created_at": "DateTime", "ts_two": "DateTime64(3)"}
ROW = {"id": "1", "account_id": "0", "label": "label", "name": "test thing", "price": "12.31", "price_two": "12.50", "visits": "0", "description": None, "created_at": "2022-03-04 05:06:07", "ts_two": "2022-03-04 05:06:07"}


def image(row):
    return [row[c] for c in SOURCE.column_names]


def feed(spark, changes, source=SOURCE):
    """(action, txn, before, after) with dicts as images."""
    rows = [(SID, txn, 1, 0, action, "appdb", source.name, list(source.column_names), before and [before[c] for c in source.column_names], after and [after[c] for c in source.column_names]) for action, txn, before, after in changes]
    fields = [f for f in changefeed.ENVELOPE_SCHEMA if f.name != "commit_ts"]
    df = spark.createDataFrame(rows, type(changefeed.ENVELOPE_SCHEMA)(fields))
    return df.withColumn("commit_ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("txn_id"))).select(*changefeed.ENVELOPE_SCHEMA.names)


def basic_changes():
    out, row, txn = [("insert", 1, None, ROW)], ROW, 1
    for change in ({"visits": "1"}, {"price": "12.33", "price_two": "15.33"}, {"visits": "2"}, {"ts_two": "2300-04-04 00:00:00"}, {"ts_two": "2001-01-22 00:00:00"}, {"ts_two": "0001-01-22 00:00:00"}):
        txn += 1
        out.append(("update", txn, row, row | change))
        row = row | change
    return out


def engine(spark, root, sources=None, columns=TARGET, **options):
    targets, state = ParquetTargets(spark, f"file://{root}/tables"), ParquetState(spark, f"file://{root}/tables")
    targets.create(target("test", columns))
    return Engine(spark, sources or {"test": SOURCE}, targets, state, Config(**options))


def stored(e):
    return e.targets.read("test").orderBy(S.TXN_ID, "id").collect()


def test_basic_trace_and_counters(spark, tmp_path):
    e = engine(spark, tmp_path)
    e.check()
    e.apply_batch(feed(spark, basic_changes()))
    rows = stored(e)
    assert len(rows) == 5
    assert [r.price_two for r in rows[:2]] == [1250, 1533] and str(rows[0].price) == "12.31" and str(rows[1].price) == "12.33"
    assert [r.ts_two.year for r in rows[2:]] == [2261, 2001, 1925]
    assert [r[S.UPDATED] for r in rows] == [[], ["price", "price_two"], ["ts_two"], ["ts_two"], ["ts_two"]]
    assert e.stats.snapshot() | {} == {
        "delivered_rows": 5, "enqueued_rows": 7, "processed_rows": 7, "skipped_row_level_duplicates": 2, "skipped_persisted_duplicates": 0,
        "skipped_column_mismatch": 0, "skipped_dump_duplicates": 0, "skipped_unknown_actions": 0,
    }
    assert e.state.get(POSITION_KEY) == f"{SID}:1-7"
    e.apply_batch(feed(spark, basic_changes()))
    assert len(stored(e)) == 5 and e.stats["skipped_persisted_duplicates"] == 5


@pytest.mark.parametrize("cut", [1, 3, 6])
def test_batches_may_be_cut_anywhere(spark, tmp_path, cut):
    e = engine(spark, tmp_path)
    changes = basic_changes()
    for part in (changes[:cut], changes[cut - 1 :]):
        e.apply_batch(feed(spark, part))
    assert [r[S.TXN_ID] for r in stored(e)] == [1, 3, 5, 6, 7]


def test_snapshot_and_stream_in_either_order(spark, tmp_path):
    e = engine(spark, tmp_path)
    source = spark.createDataFrame([tuple(image(ROW | {"id": str(i)})) for i in (1, 2)], ", ".join(f"{c} string" for c in SOURCE.column_names))
    e.apply_batch(feed(spark, [("insert", 5, None, ROW | {"id": "2"})]))
    assert e.run_snapshot(lambda _: source) == ["test"] and e.state.dumped("test")
    e.apply_batch(feed(spark, [("insert", i + 3, None, ROW | {"id": str(i)}) for i in (3, 4)] + [("delete", 9, ROW | {"id": "1"}, None)]))
    assert sorted((r.id, r[S.ACTION]) for r in stored(e)) == [(1, "delete"), (1, "dump"), (2, "insert"), (3, "insert"), (4, "insert")]
    assert e.run_snapshot(lambda _: source) == []
    assert e.run_snapshot(lambda _: source, force=True) == ["test"]
    assert len(stored(e)) == 5 and e.stats["skipped_dump_duplicates"] == 3


def test_destination_columns_may_be_added(spark, tmp_path):
    e = engine(spark, tmp_path)
    e.apply_batch(feed(spark, [("insert", 1, None, ROW)]))
    e.targets.append("test", spark.createDataFrame([], target("test", TARGET | {"visits": "Int32"}).schema))
    e.apply_batch(feed(spark, [("insert", 2, None, ROW | {"id": "2", "visits": "444"})]))
    assert [(r.id, r.visits) for r in stored(e)] == [(1, None), (2, 444)]
    e.check()


def test_stream_restart_rewind_and_start(spark, tmp_path):
    source = f"file://{tmp_path}/feed"
    changes = basic_changes()
    feed(spark, changes[:3]).write.parquet(source)
    run = lambda e, at="checkpoints": e.start(changefeed.stream_feed(spark, source, max_files=1), f"file://{tmp_path}/{at}", available_now=True).awaitTermination()
    first = engine(spark, tmp_path)
    run(first)
    feed(spark, changes[3:]).write.mode("append").parquet(source)
    again = engine(spark, tmp_path)
    run(again)
    assert len(stored(again)) == 5 and again.stats["enqueued_rows"] == 4
    replay = engine(spark, tmp_path, rewind=True)
    run(replay)
    assert len(stored(replay)) == 5 and replay.stats["skipped_persisted_duplicates"] == 5
    partial = engine(spark, tmp_path / "other", start_from_gtid=f"{SID}:1-4")
    run(partial, "others")
    assert [r[S.TXN_ID] for r in stored(partial)] == [5, 6, 7] and not partial.snapshot_due()


@pytest.mark.parametrize("options", [{"force_immediate_dump": True}, {"force_dump_tables": frozenset({"test"})}])
def test_a_run_has_one_snapshot(spark, tmp_path, options):
    source = f"file://{tmp_path}/feed"
    for i in range(3):
        feed(spark, [("insert", i + 1, None, ROW | {"id": str(i + 1)})]).coalesce(1).write.mode("append").parquet(source)
    table = spark.createDataFrame([tuple(image(ROW | {"id": "77"}))], ", ".join(f"{c} string" for c in SOURCE.column_names))
    e = engine(spark, tmp_path, **options)
    e.stats.see = lambda newest: setattr(e.stats, "lag_seconds", 1.0)
    read = []

    def reader(name):
        read.append(name)
        return table

    e.start(changefeed.stream_feed(spark, source, max_files=1), f"file://{tmp_path}/c", reader, available_now=True).awaitTermination()
    assert read == ["test"] and e.state.dumped("test") and not e.snapshot_due()
    assert sorted((r.id, r[S.ACTION]) for r in stored(e)) == [(1, "insert"), (2, "insert"), (3, "insert"), (77, "dump")]


def test_a_failed_snapshot_is_due_again(spark, tmp_path):
    source = f"file://{tmp_path}/feed"
    feed(spark, [("insert", 1, None, ROW)]).coalesce(1).write.parquet(source)
    e = engine(spark, tmp_path, force_immediate_dump=True)
    with pytest.raises(Exception, match="gone"):
        e.start(changefeed.stream_feed(spark, source), f"file://{tmp_path}/c", lambda _: (_ for _ in ()).throw(RuntimeError("gone")), available_now=True).awaitTermination()
    assert e.snapshot_due() and not e.state.dumped("test")


def test_a_row_number_column_added_later_keeps_replays_idempotent(spark, tmp_path):
    e = engine(spark, tmp_path)
    first = feed(spark, [("insert", 1, None, ROW), ("insert", 2, None, ROW | {"id": "2"})])
    e.apply_batch(first)
    e.apply_batch(first)
    assert len(stored(e)) == 2
    e.targets.append("test", spark.createDataFrame([], target("test", TARGET, row_no=True).schema))
    e.apply_batch(first)
    assert len(stored(e)) == 2
    several = feed(spark, [("insert", 3, None, ROW | {"id": "3"})]).withColumn("row_no", F.explode(F.array(F.lit(0), F.lit(1))))
    e.apply_batch(several)
    e.apply_batch(several)
    assert sorted(r[S.ROW_NO] for r in stored(e) if r.id == 3) == [0, 1] and len(stored(e)) == 4


def test_a_broken_table_is_no_missing_table(spark, tmp_path):
    e = engine(spark, tmp_path)
    broken = tmp_path / "tables" / "broken"
    broken.mkdir()
    assert e.targets.table("broken") is None and e.targets.table("nowhere") is None
    (broken / "part-0.parquet").write_bytes(b"no parquet at all")
    e.sources["broken"] = SOURCE
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        e.apply_batch(feed(spark, basic_changes()))


def test_tables_written_elsewhere_enter_the_catalogue(spark, tmp_path):
    e = engine(spark, tmp_path)
    spark.createDataFrame([(1, "x")], "id long, name string").write.parquet(f"file://{tmp_path}/tables/other")
    assert [c.name for c in e.targets.table("other").columns] == ["id", "name"]
    spark.createDataFrame([], "id long, more int").write.mode("append").parquet(f"file://{tmp_path}/tables/elsewhere")
    e.targets.append("other", spark.createDataFrame([(2, 5)], "id long, more int"))
    assert sorted(map(tuple, e.targets.read("other").collect())) == [(1, "x", None), (2, None, 5)]


@pytest.mark.parametrize("batch_size, sizes", [(3, [3, 3, 1]), (100, [7])])
def test_a_backlog_is_cut_by_count(spark, tmp_path, batch_size, sizes):
    e = engine(spark, tmp_path, batch_size=batch_size)
    seen, plain = [], e.apply_batch

    def counted(batch, tables=None):
        seen.append(batch.count())
        plain(batch, tables)

    e.apply_batch = counted
    e.apply_in_parts(feed(spark, basic_changes()))
    assert seen == sizes and [r[S.TXN_ID] for r in stored(e)] == [1, 3, 5, 6, 7]
    assert e.state.get(POSITION_KEY) == f"{SID}:1-7"


def test_transactions_and_changes_without_a_time_are_not_cut(spark, tmp_path):
    e = engine(spark, tmp_path, batch_size=2)
    rows = feed(spark, [("insert", i, None, ROW | {"id": str(i)}) for i in range(1, 8)])
    time = F.when(F.col("txn_id") == 7, None).when(F.col("txn_id") < 4, F.timestamp_seconds(F.lit(5))).otherwise(F.timestamp_seconds(F.lit(6)))
    seen = []
    e.apply_batch = lambda batch: seen.append(sorted(r.txn_id for r in batch.collect()))
    e.apply_in_parts(rows.withColumn("commit_ts", time))
    assert seen == [[1, 2, 3, 7], [4, 5, 6]]
    e.apply_in_parts(rows.limit(0))
    assert seen[2:] == [[]]


def test_profile_logs_plans(spark, tmp_path, caplog):
    e = engine(spark, tmp_path, profile=True)
    with caplog.at_level("INFO"):
        e.apply_batch(feed(spark, basic_changes()))
    assert "Physical Plan" in caplog.text


def test_supervisor_retries_then_gives_up_and_stops(spark, tmp_path):
    source = f"file://{tmp_path}/feed"
    feed(spark, basic_changes()).write.parquet(source)
    e = engine(spark, tmp_path, batch_write_interval=cfg.parse_duration("100ms"))
    failures = []
    plain = e.apply_batch

    def shaky(batch, tables=None):
        if len(failures) < 2:
            failures.append(1)
            raise RuntimeError("lost the destination")
        plain(batch, tables)
        e.shutdown()

    e.apply_batch = shaky
    e.supervise(changefeed.stream_feed(spark, source), f"file://{tmp_path}/checkpoints", pause=0.1)
    assert len(stored(e)) == 5 and len(failures) == 2
    broken = engine(spark, tmp_path / "b", batch_write_interval=cfg.parse_duration("100ms"))
    broken.apply_batch = lambda batch, tables=None: 1 / 0
    with pytest.raises(Exception, match="ZeroDivision|FOREACH"):
        broken.supervise(changefeed.stream_feed(spark, source), f"file://{tmp_path}/b/checkpoints", retries=1, pause=0.1)


def test_several_servers_are_merged(spark, tmp_path):
    e = engine(spark, tmp_path)
    batch = feed(spark, [("insert", 3, None, ROW)])
    e.apply_batch(batch)
    e.apply_batch(batch.withColumns({"server_id": F.lit("other"), "txn_id": F.lit(9).cast("long")}))
    assert gtid.parse(e.state.get(POSITION_KEY)) == {SID: [(1, 3)], "other": [(1, 9)]}


def test_table_without_destination_and_bad_schema(spark, tmp_path):
    e = engine(spark, tmp_path)
    e.apply_batch(feed(spark, [("insert", 1, None, ROW)]).withColumn("table", F.lit("unknown")))
    assert stored(e) == [] and e.stats["enqueued_rows"] == 0
    e.targets.append("bad", spark.createDataFrame([], "id long"))
    e.sources["bad"] = SOURCE
    with pytest.raises(SchemaError):
        e.check()


def test_state(spark, tmp_path):
    state = ParquetState(spark, f"file://{tmp_path}")
    assert state.get("a") == "" and not state.dumped("t")
    state.set("a", "1")
    state.set("a", "2")
    state.set_dumped("t", True)
    assert state.get("a") == "2" and ParquetState(spark, f"file://{tmp_path}").dumped("t")


def test_metrics():
    stats = Stats()
    stats.add("delivered_rows", 3)
    stats.see(100.0, now=90.0)
    assert stats.lag_seconds == 0.0
    stats.see(100.0, now=130.5)
    with pytest.raises(ValueError):
        stats.add("no_such", 1)
    server = serve(stats, 0)
    try:
        text = urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}/metrics").read().decode()
    finally:
        server.shutdown()
    assert "mysql_clickhouse_sink_delivered_rows 3" in text and "replication_delay 30.5" in text


def test_configuration_precedence(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"batch-size": 5, "mysql-db": "file", "rewind": true, "yaml-columns": ["a", "b"]}')
    env = {"CHANGELOOM_MYSQL_DB": "env", "CHANGELOOM_CLICKHOUSE_DB": "env", "OTHER": "x"}
    c = cfg.load(["--config", str(path), "--mysql-db=flag", "-batch-write-interval", "1m30s", "--force-dump"], env)
    assert (c.mysql_db, c.clickhouse_db, c.batch_size, c.rewind, c.force_dump, c.yaml_columns) == ("flag", "env", 5, True, True, ("a", "b"))
    assert c.batch_write_interval.total_seconds() == 90 and c.ignored_columns_for_deduplication == (".*updated_at",)
    assert cfg.load([]).force_dump_tables == frozenset() and cfg.load(["--assume-only-appended-columns=false"]).assume_only_appended_columns is False
    for bad in (["--nope"], ["x"], ["--batch-size"], ["--yaml-columns", r"\pN"], ["--rewind=maybe"], ["--batch-write-interval", "10"]):
        with pytest.raises(ValueError):
            cfg.load(bad)
