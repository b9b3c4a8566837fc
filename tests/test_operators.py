"""Translation, deduplication and the feed, against the rules of the change log."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from changeloom.config import Config
from changeloom.functions.types import SourceColumn, SourceTable, TargetColumn
from changeloom.operators import dedupe, schema
from changeloom.operators.translate import KEPT, MISMATCH, NO_CHANGE, ROW, STATUS, UNKNOWN, Rules, translate
from changeloom.plans.feeds import target
from changeloom.sources import changefeed, gtid, snapshot

TABLE = SourceTable("test_table", (SourceColumn("id", "bigint"), SourceColumn("name", "varchar(50)"), SourceColumn("description", "blob"), SourceColumn("updated_at", "varchar(20)")), ("id",))
COLUMNS = {"id": "Int64", "name": "String", "description": "String", "updated_at": "String"}
NAMES = list(TABLE.column_names)


def envelope(spark, *rows):
    base = {"server_id": "s1", "txn_id": 2, "event_no": 1, "row_no": 0, "action": "update", "db": "appdb", "table": "test_table", "column_names": NAMES, "before": None, "after": None}
    filled = [tuple((base | r).get(f.name) for f in changefeed.ENVELOPE_SCHEMA if f.name != "commit_ts") for r in rows]
    plain = [f for f in changefeed.ENVELOPE_SCHEMA if f.name != "commit_ts"]
    df = spark.createDataFrame(filled, type(changefeed.ENVELOPE_SCHEMA)(plain))
    return df.withColumn("commit_ts", F.timestamp_seconds(F.lit(1_700_000_000))).select(*changefeed.ENVELOPE_SCHEMA.names)


def run(spark, rows, columns=COLUMNS, **options):
    return translate(envelope(spark, *rows), TABLE, target("test_table", columns), Rules.of(Config(**options))).collect()


BEFORE, AFTER = ["12", "asdfe", "cool", "12-01-01"], ["12", "asdf", "pretty cool", "12-01-01"]


def test_update_lists_changed_columns_in_source_order(spark):
    row = run(spark, [{"before": BEFORE, "after": AFTER}])[0]
    assert row[STATUS] == KEPT and row[schema.UPDATED] == ["name", "description"]
    assert (row.id, row.name, row[schema.ACTION], row[schema.SERVER_ID], row[schema.TXN_ID], row[schema.EVENT_NO]) == (12, "asdf", "update", "s1", 2, 1)


def test_only_ignored_column_changed(spark):
    touched = [*AFTER[:3], "12-01-02"]
    assert run(spark, [{"before": AFTER, "after": touched}])[0][STATUS] == NO_CHANGE
    # the pattern may name the column first or the table first
    for pattern in (r"^updated_at\.test_table$", r"^test_table\.updated_at$"):
        assert run(spark, [{"before": AFTER, "after": touched}], ignored_columns_for_deduplication=(pattern,))[0][STATUS] == NO_CHANGE
    kept = run(spark, [{"before": BEFORE, "after": touched}])[0]
    assert kept.updated_at == "12-01-02" and kept[schema.UPDATED] == ["name", "description"]


def test_change_of_a_column_that_is_not_replicated(spark):
    assert run(spark, [{"before": BEFORE, "after": AFTER}], {"id": "Int64"})[0][STATUS] == NO_CHANGE


def test_null_is_equal_to_null_and_raw_values_are_compared(spark):
    rows = [{"before": ["1", None, "a", "x"], "after": ["1", None, "a", "x"]}, {"before": ["1", None, "a", "x"], "after": ["1", "", "a", "x"], "txn_id": 3}]
    assert [r[STATUS] for r in run(spark, rows)] == [NO_CHANGE, KEPT]


def test_actions(spark):
    rows = [
        {"action": "insert", "after": AFTER}, {"action": "delete", "before": BEFORE}, {"action": "dump", "server_id": "dump", "after": AFTER},
        {"action": "create", "after": AFTER}, {"action": None, "after": AFTER}, {"action": "update", "after": AFTER},
    ]
    got = run(spark, rows)
    assert [r[STATUS] for r in got] == [KEPT, KEPT, KEPT, UNKNOWN, UNKNOWN, KEPT]
    assert got[1].name == "asdfe" and all(r[schema.UPDATED] == [] for r in got)


def test_events_without_names_use_current_places(spark):
    assert run(spark, [{"before": BEFORE, "after": AFTER, "column_names": []}])[0][schema.UPDATED] == ["name", "description"]
    short = {"action": "insert", "after": AFTER[:2], "column_names": []}
    appended = run(spark, [short])[0]
    assert appended[STATUS] == KEPT and appended.description == ""
    assert run(spark, [short], assume_only_appended_columns=False)[0][STATUS] == MISMATCH
    assert run(spark, [short | {"column_names": ["id", "name"]}], assume_only_appended_columns=False)[0][STATUS] == KEPT


def test_names_of_the_time_win_over_places(spark):
    row = run(spark, [{"action": "insert", "after": ["x", "7"], "column_names": ["name", "id"]}])[0]
    assert (row.id, row.name) == (7, "x")
    gone = run(spark, [{"action": "insert", "after": ["7", "old"], "column_names": ["id", "removed"]}], {"id": "Int64", "removed": "String"})[0]
    assert gone.removed == "old"


def test_redaction_by_name_and_by_destination(spark):
    row = run(spark, [{"action": "insert", "after": AFTER}], COLUMNS | {"description": "UInt64"}, anonymize_fields=(r"test_table\.name",))[0]
    assert row.name.isdigit() and row.name != "asdf" and row.description > 0
    skipped = run(spark, [{"action": "insert", "after": AFTER}], anonymize_fields=("name",), skip_anonymize_fields=(r"\.name$",))[0]
    assert skipped.name == "asdf"
    documents = run(spark, [{"action": "insert", "after": ["1", "{a: {email: x, n: 1}}", '{"email": "x"}', "t"]}], yaml_columns=(r"\.name$",), json_columns=(r"\.description$",), anonymize_fields=("email",))[0]
    assert '"n": 1' in documents.name and '"x"' not in documents.name + documents.description


def test_event_without_commit_time_fails(spark):
    feed = envelope(spark, {"action": "insert", "after": AFTER}).withColumn("commit_ts", F.lit(None).cast("timestamp"))
    with pytest.raises(PySparkException):
        translate(feed, TABLE, target("test_table", COLUMNS), Rules.of(Config())).collect()


def test_empty_feed(spark):
    assert translate(envelope(spark, {"after": AFTER}).limit(0), TABLE, target("test_table", COLUMNS), Rules.of(Config())).count() == 0


def test_raw_events(spark):
    rows = [
        ("WriteRowsEventV2", 1, [["1"], ["2"], ["3"]]), ("UpdateRowsEventV1", 2, [["1"], ["4"], ["2"], ["5"]]),
        ("DeleteRowsEventV0", 3, [["5"]]), ("QueryEvent", 4, None), ("UpdateRowsEventV2", 5, []),
    ]
    df = spark.createDataFrame(rows, "event_type string, txn_id long, rows array<array<string>>")
    df = df.withColumns({"server_id": F.lit("s"), "event_no": F.lit(1).cast("long"), "commit_ts": F.current_timestamp(), "db": F.lit("d"), "table": F.lit("t"), "column_names": F.array(F.lit("id"))})
    got = sorted((r.txn_id, r.row_no, r.action, r.before, r.after) for r in changefeed.envelopes(df).collect())
    assert got == [
        (1, 0, "insert", None, ["1"]), (1, 1, "insert", None, ["2"]), (1, 2, "insert", None, ["3"]),
        (2, 0, "update", ["1"], ["4"]), (2, 1, "update", ["2"], ["5"]), (3, 0, "delete", ["5"], None),
    ]


def test_event_numbers_do_not_depend_on_filters(spark):
    rows = [("s", 1, p, t) for p, t in enumerate("abcab")]
    df = changefeed.number_events(spark.createDataFrame(rows, "server_id string, txn_id long, position long, table string"), "position")
    assert [(r.table, r.event_no) for r in df.filter("table = 'b'").orderBy("event_no").collect()] == [("b", 2), ("b", 5)]


# deduplication


def keyed(spark, rows):
    """(action, server, txn, event, row, id)"""
    return spark.createDataFrame(rows, f"{schema.ACTION} string, {schema.SERVER_ID} string, {schema.TXN_ID} long, {schema.EVENT_NO} long, {ROW} int, id long")


def test_within_batch(spark):
    rows = [("insert", "s", 1, 1, 0, 1)] * 2 + [("insert", "s", 1, 1, 1, 2), ("dump", "dump", 1, 1, 0, 1), ("dump", "dump", 2, 1, 0, 3), ("dump", "dump", 3, 1, 0, 3)]
    got = sorted((r[0], r.id) for r in dedupe.within_batch(keyed(spark, rows), ("id",)).collect())
    assert got == [("dump", 3), ("insert", 1), ("insert", 2)]
    assert dedupe.within_batch(keyed(spark, rows), ()).count() == 5


events = st.lists(st.tuples(st.just("insert"), st.sampled_from(["s1", "s2"]), st.integers(1, 5), st.integers(1, 2), st.just(0), st.integers(1, 9)), max_size=12)
dumps = st.lists(st.tuples(st.just("dump"), st.just("dump"), st.integers(1, 9), st.just(1), st.just(0), st.one_of(st.none(), st.integers(1, 9))), max_size=8)


@settings(max_examples=12, deadline=None)
@given(events, dumps, events, dumps)
def test_new_rows_against_sets(spark, stored_events, stored_dumps, batch_events, batch_dumps):
    stored, batch = stored_events + stored_dumps, batch_events + batch_dumps
    got = dedupe.new_rows(keyed(spark, batch), keyed(spark, stored).drop(ROW), ("id",)).collect()
    stored_keys = {r[1:4] for r in stored if r[0] != "dump"} | {r[1:4] for r in stored}
    wanted = {r[1:4] for r in batch_events} - stored_keys
    assert sorted(tuple(r)[1:4] for r in got if r[0] != "dump") == sorted(wanted)
    ids = {r[5] for r in batch_dumps} - {r[5] for r in batch_events} - {r[5] for r in stored}
    found = [r.id for r in got if r[0] == "dump"]
    assert len(found) == len(set(found)) and set(found) == ids


def test_bounds_reach_the_scan(spark, tmp_path):
    keyed(spark, [("insert", "s", t, 1, 0, t) for t in range(50)]).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    batch = keyed(spark, [("insert", "s", 10, 1, 0, 1), ("insert", "s", 99, 1, 0, 2), ("dump", "dump", 1, 1, 0, 7)])
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = dedupe.stored_events(stored, dedupe.txn_bounds(batch).collect())._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(changelog_gtid_transaction_id,10)" in plan and "LessThanOrEqual(changelog_gtid_transaction_id,99)" in plan
    assert [r.id for r in dedupe.new_rows(batch, stored, ("id",)).filter(dedupe.is_dump()).collect()] == []


def test_composite_keys_use_a_box(spark):
    rows = [("dump", "dump", 1, 1, 0, 1), ("dump", "dump", 2, 1, 0, 5)]
    label = F.when(F.col("id") == 1, "z").otherwise("a")
    batch = keyed(spark, rows).withColumn("label", label)
    stored = batch.drop(ROW)
    assert dedupe.new_rows(batch, stored, ("id", "label")).count() == 0
    b = dedupe.pk_bounds(batch, ("id", "label")).first()
    assert (b.min_label, b.max_label, tuple(b.min_pk)) == ("a", "z", (1, "z"))
    text = batch.select(dedupe.pk_text("id", "label").alias("t")).collect()
    assert sorted(r.t for r in text) == ["1-z", "5-a"]


# schemas and positions


def test_required_columns(spark):
    good = target("a", {"id": "Int64"})
    schema.check_schema([good])
    bad = type(good)("b", (TargetColumn("id", "Int64"), TargetColumn(schema.ACTION, "String")))
    worse = type(good)("c", good.columns[:-1])
    with pytest.raises(schema.SchemaError) as error:
        schema.check_schema([good, bad, worse])
    assert set(error.value.problems) == {"b", "c"} and len(error.value.problems["b"]) == 6
    assert schema.replicated_tables({"a": TABLE, "x": TABLE}, {"a": good, "b": bad}) == ["a"]
    assert schema.target_pk(SourceTable("t", TABLE.columns, ("id", "absent")), good) == ("id",)


@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 30), st.integers(0, 5)), min_size=1))
def test_gtid_sets(parts):
    text = ",".join(f"{s}:{low}-{low + n}" for s, low, n in parts)
    found = gtid.parse(text)
    members = {(s, t) for s, low, n in parts for t in range(low, low + n + 1)}
    assert {(s, t) for s, rs in found.items() for low, high in rs for t in range(low, high + 1)} == members
    assert gtid.parse(gtid.text(found)) == found == gtid.merge(found, gtid.parse(""))


def test_gtid_text(spark):
    assert gtid.text(gtid.parse("A:1-3:5,b:7:8")) == "a:1-3:5,b:7-8"
    df = spark.createDataFrame([("a", 4), ("a", 5), ("b", 7), ("dump", 3)], "s string, t long")
    inside = gtid.contains(gtid.parse("a:1-3:5,b:7"), F.col("s"), F.col("t"))
    assert [r.v for r in df.select(inside.alias("v")).collect()] == [False, True, True, False]
    assert [r.v for r in df.select(gtid.up_to(F.col("s"), F.col("t")).alias("v")).collect()] == ["a:1-4", "a:1-5", "b:1-7", ""]
    for bad in ("a", "a:3-1", "a:x"):
        with pytest.raises(ValueError):
            gtid.parse(bad)


@pytest.mark.parametrize(
    ("dumped", "running", "listed", "forced", "want"),
    [(False, False, False, False, True), (True, False, False, False, False), (True, False, True, False, True), (True, True, True, False, False), (True, False, False, True, True), (False, True, False, False, True)],
)
def test_snapshot_selection(dumped, running, listed, forced, want):
    assert snapshot.wanted("t", dumped, running, frozenset({"t"} if listed else ()), forced) is want
