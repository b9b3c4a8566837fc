"""The registered queries: each applies operators of this engine to whole test tables.

Next to each query stands SQL that gives the same rows from the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import convert as C
from ..functions.types import SourceColumn, TargetColumn
from ..operators import dedupe
from ..operators import schema as S
from ..operators.translate import KEPT, ROW, STATUS, Rules, translate
from ..sources import changefeed, gtid, snapshot
from ..sources.stores import ParquetState, ParquetTargets
from ..sources.workspace import new_folder
from ..streaming.engine import Engine
from ..streaming.engine import batch_parts as engine_parts
from . import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _registered(sql: str | None):
    def keep(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            SQL[query.__name__] = sql
        return query

    return keep


_VERSIONS = """WITH v AS (
  SELECT *, lag(event_type) OVER w AS p_type, lag(val) OVER w AS p_val, lag(props) OVER w AS p_props, lag(event_id) OVER w AS p_id
  FROM (SELECT *, {value} AS val FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
)
"""
_EXACT = "value::DECIMAL(18,4)"
_EVENT_TARGET = {"user_id": "Int64", "event_type": "LowCardinality(String)", "value": "Decimal(18, 4)", "props": "String"}


def _translated(feed: DataFrame, source, columns: dict[str, str], **options) -> DataFrame:
    return translate(feed, source, feeds.target(source.name, columns), Rules.of(Config(**options)))


def _kept(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(STATUS) == KEPT)


# sources


@_registered("""
SELECT event_id, CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS action
FROM events WHERE event_type <> 'view'
""")
def event_action_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log events to changes: rows events only, their kind gives the action."""
    kinds = {"signup": "WriteRowsEventV2", "purchase": "UpdateRowsEventV2", "click": "UpdateRowsEventV1", "error": "DeleteRowsEventV2", "view": "QueryEvent"}
    kind = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))[F.col("event_type")]
    row = F.array(F.col("event_id").cast("string"))
    rows = feeds.read(spark, sf_dir, "events").select(
        kind.alias("event_type"), F.lit(feeds.SERVER).alias("server_id"), F.col("event_id").alias("txn_id"), F.lit(1).cast("long").alias("event_no"),
        F.col("ts").cast("timestamp").alias("commit_ts"), F.lit("appdb").alias("db"), F.lit("events").alias("table"), F.array(F.lit("event_id")).alias("column_names"),
        F.when(kind.startswith("Update"), F.array(row, row)).otherwise(F.array(row)).alias("rows"),
    )
    return changefeed.envelopes(rows).select(F.col("txn_id").alias("event_id"), "action")


@_registered("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) - 1 AS row_no FROM lineitem)
SELECT l_orderkey AS txn_id, row_no::INT AS row_no, l_partkey AS part FROM l
""")
def multi_row_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An insert event of many rows gives each row, numbered."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    lines = feeds.read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(*order))).alias("ls"))
    events = lines.select(
        F.lit("WriteRowsEventV2").alias("event_type"), F.lit(feeds.SERVER).alias("server_id"), F.col("l_orderkey").alias("txn_id"), F.lit(1).cast("long").alias("event_no"),
        F.lit(None).cast("timestamp").alias("commit_ts"), F.lit("appdb").alias("db"), F.lit("lineitem").alias("table"), F.array(F.lit("l_partkey")).alias("column_names"),
        F.transform("ls", lambda x: F.array(x["l_partkey"].cast("string"))).alias("rows"),
    )
    return changefeed.envelopes(events).select("txn_id", "row_no", F.get("after", F.lit(0)).cast("long").alias("part"))


@_registered("""
SELECT l_orderkey AS txn_id, l_linenumber, l_partkey,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS event_no
FROM lineitem
""")
def txn_event_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a transaction numbered by place, before any filter."""
    rows = feeds.read(spark, sf_dir, "lineitem")
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    rows = rows.select(F.lit(feeds.SERVER).alias("server_id"), F.col("l_orderkey").alias("txn_id"), "l_linenumber", "l_partkey", place.alias("position"))
    return changefeed.number_events(rows, "position").drop("server_id", "position")


@_registered("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase') AND user_id % 2 = 0")
def table_schema_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of one schema and of tables that have a destination."""
    rows = feeds.read(spark, sf_dir, "events").withColumns({"db": F.when(F.col("user_id") % 2 == 0, "appdb").otherwise("other"), "table": F.col("event_type")})
    return changefeed.select_tables(rows, "appdb", ["click", "purchase", "no_such_table"]).select("event_id", "event_type")


# diff and metadata


@_registered(_VERSIONS.format(value=_EXACT) + """
SELECT event_id, user_id, CASE WHEN p_id IS NULL THEN 'insert' ELSE 'update' END AS action,
       CASE WHEN p_id IS NULL THEN '' ELSE concat_ws(',', CASE WHEN event_type IS DISTINCT FROM p_type THEN 'event_type' END,
         CASE WHEN val IS DISTINCT FROM p_val THEN 'value' END, CASE WHEN props IS DISTINCT FROM p_props THEN 'props' END) END AS updated_columns
FROM v WHERE p_id IS NULL OR event_type IS DISTINCT FROM p_type OR val IS DISTINCT FROM p_val OR props IS DISTINCT FROM p_props
""")
def update_diff_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates with the list of columns that changed; updates without change are dropped."""
    rows = _kept(_translated(feeds.event_versions(spark, sf_dir), feeds.EVENTS, _EVENT_TARGET))
    return rows.select(F.col(S.TXN_ID).cast("long").alias("event_id"), "user_id", F.col(S.ACTION).alias("action"), F.array_join(S.UPDATED, ",").alias("updated_columns"))


_ROUNDED = "floor(value / 50)::BIGINT::DECIMAL(18,4)"


@_registered(_VERSIONS.format(value=_ROUNDED) + """
SELECT event_id, val::DOUBLE AS value FROM v WHERE p_id IS NULL OR val IS DISTINCT FROM p_val
""")
def noop_update_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates that change no replicated column are dropped (values rounded, so that there are some)."""
    rounded = F.floor(F.col("value") / 50).cast("decimal(18,4)")
    rows = _kept(_translated(feeds.event_versions(spark, sf_dir, rounded), feeds.EVENTS, {"value": "Decimal(18, 4)"}))
    return rows.select(F.col(S.TXN_ID).cast("long").alias("event_id"), F.col("value").cast("double").alias("value"))


@_registered(_VERSIONS.format(value=_EXACT) + """
SELECT event_id, val::DOUBLE AS value FROM v WHERE p_id IS NULL OR event_type IS DISTINCT FROM p_type
""")
def ignored_column_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ignored columns keep no update alive, and are written where one is kept."""
    rows = _translated(feeds.event_versions(spark, sf_dir), feeds.EVENTS, _EVENT_TARGET | {"updated_at": "DateTime64(6)"}, ignored_columns_for_deduplication=(".*updated_at", "events.value", r"^props\."))
    return _kept(rows).select(F.col(S.TXN_ID).cast("long").alias("event_id"), F.col("value").cast("double").alias("value"))


@_registered("""
SELECT o_orderkey, 1700000000 + o_orderkey AS created_s, 'insert' AS action, '3e11fa47-71ca-11e1-9e33-c80aa9429562' AS server_id, o_orderkey AS txn_id, 1::BIGINT AS event_no,
       '3e11fa47-71ca-11e1-9e33-c80aa9429562:1-' || o_orderkey AS position, '' AS updated_columns FROM orders
""")
def changelog_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata columns and the position text of every change."""
    feed = feeds.inserts(feeds.read(spark, sf_dir, "orders"), feeds.ORDERS, "o_orderkey", feeds.order_values())
    rows = _translated(feed, feeds.ORDERS, {"o_orderkey": "Int64"})
    txn = F.col(S.TXN_ID).cast("long")
    return rows.select(
        "o_orderkey", F.unix_seconds(S.CREATED_AT).alias("created_s"), F.col(S.ACTION).alias("action"), F.col(S.SERVER_ID).alias("server_id"), txn.alias("txn_id"),
        F.col(S.EVENT_NO).cast("long").alias("event_no"), gtid.up_to(F.col(S.SERVER_ID), txn).alias("position"), F.array_join(S.UPDATED, ",").alias("updated_columns"),
    )


@_registered("""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'column_mismatch' ELSE 'kept' END AS status, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 3 <> 0 AND o_orderstatus IS NOT NULL) AS with_status
FROM orders GROUP BY 1
""")
def column_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without names whose rows are shorter than the schema are skipped, unless appended
    columns are assumed."""
    feed = feeds.inserts(feeds.read(spark, sf_dir, "orders"), feeds.ORDERS, "o_orderkey", feeds.order_values(), names=False)
    feed = feed.withColumn("after", F.when(F.col("txn_id") % 3 == 0, F.slice("after", 1, 4)).otherwise(F.col("after")))
    rows = _translated(feed, feeds.ORDERS, {"o_orderkey": "Int64", "o_orderstatus": "String"}, assume_only_appended_columns=False)
    held = F.count_if((F.col(STATUS) == KEPT) & (F.col("o_orderstatus") != ""))
    return rows.groupBy(F.col(STATUS).alias("status")).agg(F.count("*").alias("n"), held.alias("with_status"))


@_registered("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def appended_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shorter rows of events without names have nulls at their end, which become zero values."""
    feed = feeds.inserts(feeds.read(spark, sf_dir, "orders"), feeds.ORDERS, "o_orderkey", feeds.order_values(), names=False)
    feed = feed.withColumn("after", F.when(F.col("txn_id") % 3 == 0, F.slice("after", 1, 4)).otherwise(F.col("after")))
    return _kept(_translated(feed, feeds.ORDERS, {"o_orderkey": "Int64", "o_orderpriority": "String"})).select("o_orderkey", "o_orderpriority")


# conversions


def _prices(spark: SparkSession, sf_dir: str, kind: str, column: str) -> DataFrame:
    rows = feeds.read(spark, sf_dir, "lineitem")
    text = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    value = C.convert(text, SourceColumn("l_extendedprice", "decimal(18,2)"), TargetColumn(column, kind))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", value.alias(column))


@_registered("SELECT l_orderkey, l_linenumber, l_partkey, (l_extendedprice::DECIMAL(18,2) * 100)::BIGINT AS unscaled FROM lineitem")
def decimal_to_unscaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decimal in an integer column is its digits without the point."""
    return _prices(spark, sf_dir, "Int64", "unscaled")


@_registered("SELECT l_orderkey, l_linenumber, l_partkey, (l_extendedprice::DECIMAL(18,2))::DOUBLE AS price FROM lineitem")
def decimal_to_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prices(spark, sf_dir, "Float64", "price")


@_registered("SELECT l_orderkey, l_linenumber, l_partkey, (l_extendedprice::DECIMAL(18,2))::DECIMAL(20,4)::DOUBLE AS price FROM lineitem")
def decimal_rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prices(spark, sf_dir, "Decimal(20, 4)", "price").withColumn("price", F.col("price").cast("double"))


_CLAMP = """
WITH s AS (SELECT o_orderkey, o_orderdate + to_years(((o_orderkey % 9) - 4)::INT * 100) AS d FROM orders), y AS (
  SELECT *, CASE WHEN year(d) > {high} THEN {high} WHEN year(d) < {low} THEN {low} ELSE year(d) END AS yy FROM s)
SELECT o_orderkey, epoch_us(make_date(yy, month(d), 1) + CAST(day(d) - 1 AS INTEGER) + (d - date_trunc('day', d)))::BIGINT AS micros FROM y
"""


def _clamped(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    rows = feeds.read(spark, sf_dir, "orders")
    moved = F.col("o_orderdate").cast("timestamp") + F.make_interval(((F.col("o_orderkey") % 9 - 4) * 100).cast("int"))
    value = C.convert(F.date_format(moved, "yyyy-MM-dd HH:mm:ss.SSSSSS"), SourceColumn("d", "datetime"), TargetColumn("d", kind))
    return rows.select("o_orderkey", F.unix_micros(value).alias("micros"))


@_registered(_CLAMP.format(low=1970, high=2105))
def year_clamp_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years out of the short time types' range."""
    return _clamped(spark, sf_dir, "DateTime")


@_registered(_CLAMP.format(low=1925, high=2261))
def year_clamp_dt64(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clamped(spark, sf_dir, "Nullable(DateTime64(3))")


@_registered("""
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, '') AS name, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS nullable_name,
       coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END, 0)::INT AS nation, coalesce(CASE WHEN c_custkey % 5 = 0 THEN c_acctbal::DECIMAL(12,2) END, 0)::DECIMAL(12,2)::DOUBLE AS balance,
       0::BIGINT AS never_s FROM customer
""")
def null_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null becomes the type's zero where the destination can't hold it."""
    rows = feeds.read(spark, sf_dir, "customer")
    name = F.when(F.col("c_custkey") % 2 == 0, F.col("c_name"))
    text = SourceColumn("x", "varchar(25)")
    value = lambda column, source, kind: C.null_default(C.convert(column, source, t := TargetColumn("x", kind)), t)
    never = value(F.lit("0000-00-00 00:00:00"), SourceColumn("x", "datetime"), "DateTime")
    return rows.select(
        "c_custkey", value(name, text, "String").alias("name"), value(name, text, "Nullable(String)").alias("nullable_name"),
        value(F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey")).cast("string"), SourceColumn("x", "int"), "Int32").alias("nation"),
        value(F.when(F.col("c_custkey") % 5 == 0, F.col("c_acctbal").cast("decimal(12,2)")).cast("string"), SourceColumn("x", "decimal(12,2)"), "Decimal(12, 2)").cast("double").alias("balance"),
        F.unix_seconds(never).alias("never_s"),
    )


# keys and deduplication


def _as_rows(df: DataFrame, action, server, txn, row=None) -> DataFrame:
    """Translated rows with the metadata that deduplication reads."""
    return df.withColumns({S.ACTION: action, S.SERVER_ID: server, S.TXN_ID: txn.cast("long"), S.EVENT_NO: F.lit(1).cast("long"), ROW: F.lit(0) if row is None else row})


@_registered("SELECT DISTINCT l_orderkey, l_linenumber, l_orderkey || '-' || l_linenumber AS pk FROM lineitem")
def pk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return rows.withColumn("pk", dedupe.pk_text("l_orderkey", "l_linenumber"))


@_registered("""
SELECT min((l_partkey, l_suppkey)).l_partkey AS min_part, min((l_partkey, l_suppkey)).l_suppkey AS min_supp, max((l_partkey, l_suppkey)).l_partkey AS max_part, max((l_partkey, l_suppkey)).l_suppkey AS max_supp,
       min(l_suppkey) AS least_supp, max(l_suppkey) AS most_supp, count(*) AS n FROM (SELECT {'l_partkey': l_partkey, 'l_suppkey': l_suppkey} AS k, l_partkey, l_suppkey FROM lineitem)
""".replace("min((l_partkey, l_suppkey))", "min(k)").replace("max((l_partkey, l_suppkey))", "max(k)"))
def pk_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least and greatest key tuples of snapshot rows, and the box around them."""
    rows = _as_rows(feeds.read(spark, sf_dir, "lineitem"), F.lit("dump"), F.lit("dump"), F.col("l_orderkey"))
    b = dedupe.pk_bounds(rows, ("l_partkey", "l_suppkey"))
    return b.select(
        F.col("min_pk.l_partkey").alias("min_part"), F.col("min_pk.l_suppkey").alias("min_supp"), F.col("max_pk.l_partkey").alias("max_part"), F.col("max_pk.l_suppkey").alias("max_supp"),
        F.col("min_l_suppkey").alias("least_supp"), F.col("max_l_suppkey").alias("most_supp"), F.col("rows").alias("n"),
    )


@_registered("SELECT 's' || l_linenumber AS server_id, min(l_orderkey) AS min_txn, max(l_orderkey) AS max_txn FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1")
def txn_minmax_by_server(spark: SparkSession, sf_dir: str) -> DataFrame:
    server = F.concat(F.lit("s"), F.col("l_linenumber").cast("string"))
    rows = _as_rows(feeds.read(spark, sf_dir, "lineitem"), F.when(F.col("l_returnflag") == "A", "dump").otherwise("insert"), server, F.col("l_orderkey"))
    return dedupe.txn_bounds(rows).withColumnRenamed(S.SERVER_ID, "server_id")


@_registered("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > 30)")
def dump_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows whose key is not stored yet, by any action."""
    rows = _as_rows(feeds.read(spark, sf_dir, "orders").select("o_orderkey"), F.lit("dump"), F.lit("dump"), F.col("o_orderkey"))
    stored = feeds.read(spark, sf_dir, "lineitem").filter("l_quantity > 30").select(F.col("l_orderkey").alias("o_orderkey"))
    bounds = dedupe.pk_bounds(rows, ("o_orderkey",)).first()
    return dedupe.drop_stored_dumps(rows, stored, ("o_orderkey",), bounds).select("o_orderkey")


@_registered("""
SELECT o_orderkey, o_orderpriority FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = substr(o.o_orderstatus, 1, 1) OR FALSE)
""".replace(" OR FALSE", "").replace("substr(o.o_orderstatus, 1, 1)", "CASE o.o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'N' ELSE 'A' END"))
def event_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that are not stored yet, by server, transaction and event number."""
    flag = F.when(F.col("o_orderstatus") == "F", "R").when(F.col("o_orderstatus") == "O", "N").otherwise("A")
    rows = _as_rows(feeds.read(spark, sf_dir, "orders"), F.lit("insert"), flag, F.col("o_orderkey"))
    stored = _as_rows(feeds.read(spark, sf_dir, "lineitem"), F.lit("insert"), F.col("l_returnflag"), F.col("l_orderkey"))
    return dedupe.drop_stored_events(rows, stored, dedupe.txn_bounds(rows).collect()).select("o_orderkey", "o_orderpriority")


@_registered("""
WITH e AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'A'), d AS (
  SELECT DISTINCT l_orderkey FROM lineitem l WHERE l_returnflag = 'A' AND NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_returnflag <> 'A' AND x.l_orderkey = l.l_orderkey))
SELECT 'event' AS kind, l_orderkey, count(*) AS n FROM e GROUP BY 2 UNION ALL SELECT 'dump', l_orderkey, 1 FROM d
""")
def batch_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within a batch: changes once, snapshot rows once a key and not beside a change of the key."""
    rows = _as_rows(feeds.read(spark, sf_dir, "lineitem"), F.when(F.col("l_returnflag") == "A", "dump").otherwise("insert"), F.lit("s"), F.col("l_orderkey"), F.col("l_linenumber"))
    rows = dedupe.within_batch(rows, ("l_orderkey",)).withColumn("kind", F.when(dedupe.is_dump(), "dump").otherwise("event"))
    return rows.groupBy("kind", "l_orderkey").agg(F.count("*").alias("n"))


@_registered("""
SELECT 'dump' AS action, o_orderkey AS k, o_totalprice::DECIMAL(18,2)::DOUBLE AS price FROM orders
UNION ALL SELECT 'insert', event_id, value::DECIMAL(18,2)::DOUBLE FROM events
""")
def dump_stream_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot and stream share one envelope and one translation."""
    orders = feeds.read(spark, sf_dir, "orders").withColumns({"o_orderdate": F.col("o_orderdate").cast("string"), "o_totalprice": F.col("o_totalprice").cast("decimal(18,2)")})
    events = feeds.read(spark, sf_dir, "events").select(
        F.col("event_id").alias("o_orderkey"), F.col("user_id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.col("value").cast("decimal(18,2)").alias("o_totalprice"), F.col("ts").cast("string").alias("o_orderdate"), F.col("event_type").alias("o_orderpriority"),
    )
    feed = snapshot.snapshot_envelopes(orders, feeds.ORDERS).unionByName(feeds.inserts(events, feeds.ORDERS, "o_orderkey"))
    rows = _kept(_translated(feed, feeds.ORDERS, {"o_orderkey": "Int64", "o_totalprice": "Decimal(18, 2)"}))
    return rows.select(F.col(S.ACTION).alias("action"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").cast("double").alias("price"))


# documents and redaction


@_registered("""
SELECT event_id, '{"id": ' || event_id || ', "kind": "' || event_type || '", "nested": {"tags": ["' || event_type || '", "x y", null], "user": ' || user_id || '}, "props": ' || props || '}' AS doc FROM events
""")
def yaml_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """YAML documents with a header, keys with colons, nested lists and JSON in them to JSON text."""
    feed = feeds.event_versions(spark, sf_dir).withColumn("action", F.lit("insert"))
    part = lambda i: F.get("after", F.lit(i))
    yaml = "--- !ruby/hash:ActiveSupport::HashWithIndifferentAccess\n:id: %s\nprops: %s\nkind: %s\nnested:\n  :user: %s\n  tags:\n  - %s\n  - x y\n  - ~\n"
    doc = F.format_string(yaml, part(0), part(5), part(3), part(2), part(3))
    feed = feed.withColumn("after", F.concat(F.slice("after", 1, 5), F.array(doc)))
    rows = _translated(feed, feeds.EVENTS, {"props": "String"}, yaml_columns=(r"events\.props",))
    return rows.select(F.col(S.TXN_ID).cast("long").alias("event_id"), F.col("props").alias("doc"))


@_registered("SELECT count(*) AS n, count(DISTINCT event_type) AS kinds, count(*) AS hashed FROM events")
def anonymize_nested_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text inside documents becomes a stable number: as many as there are texts."""
    feed = feeds.event_versions(spark, sf_dir).withColumn("action", F.lit("insert"))
    doc = F.to_json(F.struct(F.struct(F.get("after", F.lit(3)).alias(":kind")).alias("who")))
    feed = feed.withColumn("after", F.concat(F.slice("after", 1, 5), F.array(doc)))
    rows = _translated(feed, feeds.EVENTS, {"props": "String"}, yaml_columns=("events.props",), anonymize_fields=(r"\.kind$",))
    kind = F.get_json_object("props", "$.who.kind")
    return rows.agg(F.count("*").alias("n"), F.count_distinct(kind).alias("kinds"), F.count_if(kind.rlike("^[0-9]{1,20}$")).alias("hashed"))


@_registered("SELECT c_mktsegment AS segment, count(DISTINCT c_name) AS names, count(DISTINCT c_name) AS numbers, 0::BIGINT AS plain FROM customer GROUP BY 1")
def hash_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes keep names apart, as text and as unsigned numbers; skipped fields stay."""
    feed = feeds.inserts(feeds.read(spark, sf_dir, "customer"), feeds.CUSTOMER, "c_custkey", {"c_acctbal": F.col("c_acctbal").cast("decimal(12,2)")})
    options = {"anonymize_fields": (r"customer\.c_(name|mktsegment)",), "skip_anonymize_fields": ("segment$",)}
    text = _translated(feed, feeds.CUSTOMER, {"c_name": "String", "c_mktsegment": "String"}, **options)
    number = _translated(feed, feeds.CUSTOMER, {"c_name": "UInt64", "c_mktsegment": "String"}, **options)
    a = text.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count_distinct("c_name").alias("names"), F.count_if(~F.col("c_name").rlike("^[0-9]+$")).alias("plain"))
    b = number.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count_distinct("c_name").alias("numbers"))
    return a.join(b, "segment")


# state, counters, streams


@_registered("""
SELECT user_id, arg_max(event_id, (ts, event_id)) AS last_event, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value::DECIMAL(18,4), (ts, event_id))::DOUBLE AS value FROM events GROUP BY 1
""".replace("(ts, event_id))", "{'t': ts, 'e': event_id})"))
def final_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest change of each key is the source's row."""
    columns = {"user_id": "Int64", "event_id": "Int64", "event_type": "String", "value": "Decimal(18, 4)"}
    rows = _kept(_translated(feeds.event_versions(spark, sf_dir), feeds.EVENTS, columns))
    newest = lambda c: F.max_by(c, F.struct(S.CREATED_AT, S.TXN_ID))
    return rows.groupBy("user_id").agg(newest("event_id").alias("last_event"), newest("event_type").alias("event_type"), newest("value").cast("double").alias("value"))


@_registered(_VERSIONS.format(value=_ROUNDED) + """
SELECT 'row_level_duplicate' AS status, count(*) AS n FROM v WHERE p_id IS NOT NULL AND val IS NOT DISTINCT FROM p_val HAVING count(*) > 0
UNION ALL SELECT 'kept', count(*) FROM v WHERE p_id IS NULL OR val IS DISTINCT FROM p_val HAVING count(*) > 0
""")
def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows are kept and skipped, and why."""
    rounded = F.floor(F.col("value") / 50).cast("decimal(18,4)")
    rows = _translated(feeds.event_versions(spark, sf_dir, rounded), feeds.EVENTS, {"value": "Decimal(18, 4)"})
    return rows.groupBy(F.col(STATUS).alias("status")).agg(F.count("*").alias("n"))


@_registered("SELECT user_id, max(epoch_us(ts)) // 1000000 AS newest_s, 1767225600 - max(epoch_us(ts)) // 1000000 AS behind_s FROM events GROUP BY 1")
def replication_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds between a fixed now and the newest change, never negative, here for each key."""
    feed = feeds.event_versions(spark, sf_dir).groupBy(F.get("after", F.lit(2)).cast("long").alias("user_id")).agg(F.max("commit_ts").alias("newest"))
    seconds = F.unix_seconds("newest")
    return feed.select("user_id", seconds.alias("newest_s"), F.greatest(F.lit(1_767_225_600) - seconds, F.lit(0)).cast("long").alias("behind_s"))


_STREAM_TARGET = {"o_orderkey": "Int64", "o_orderstatus": "String", "o_totalprice": "UInt64", "o_orderdate": "DateTime"}


@_registered("""
SELECT o_orderkey, o_orderstatus, (o_totalprice::DECIMAL(18,2) * 100)::BIGINT AS unscaled, 'dump' AS action FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, o_orderstatus, (o_totalprice::DECIMAL(18,2) * 100)::BIGINT, 'insert' FROM orders WHERE o_orderkey % 2 <> 0
""")
def stream_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd orders arrive by stream, a snapshot brings the rest; then both run again and add nothing."""
    root = new_folder(spark, "replay")
    orders = feeds.read(spark, sf_dir, "orders")
    feed = feeds.inserts(orders.filter("o_orderkey % 2 <> 0"), feeds.ORDERS, "o_orderkey", feeds.order_values())
    feed.write.parquet(f"{root}/feed")
    targets, state = ParquetTargets(spark, f"{root}/tables"), ParquetState(spark, f"{root}/tables")
    targets.create(feeds.target("orders", _STREAM_TARGET))
    rows = orders.withColumns(feeds.order_values())
    for config in (Config(), Config(rewind=True, force_dump_tables=frozenset({"orders"}))):
        engine = Engine(spark, {"orders": feeds.ORDERS}, targets, state, config)
        engine.check()
        engine.start(changefeed.stream_feed(spark, f"{root}/feed"), f"{root}/checkpoints", available_now=True).awaitTermination()
        engine.run_snapshot(lambda _: rows)
    stored = targets.read("orders")
    return stored.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("long").alias("unscaled"), F.col(S.ACTION).alias("action"))


@_registered("""
WITH r AS (
  SELECT DISTINCT 'server-' || l_linenumber AS server_id, l_orderkey AS txn FROM lineitem
), n AS (
  SELECT *, txn - row_number() OVER (PARTITION BY server_id ORDER BY txn) AS run FROM r
), i AS (
  SELECT server_id, min(txn) AS low, max(txn) AS high FROM n GROUP BY server_id, run
)
SELECT server_id, server_id || ':' || string_agg(CASE WHEN low = high THEN low::VARCHAR ELSE low || '-' || high END, ':' ORDER BY low) AS transactions FROM i GROUP BY server_id
""")
def merged_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions of every server as one set text; one row a server."""
    server = F.concat(F.lit("server-"), F.col("l_linenumber").cast("string"))
    return gtid.interval_sets(feeds.read(spark, sf_dir, "lineitem").select(server.alias("server_id"), F.col("l_orderkey").alias("txn_id")))


_PART_ROWS = 700


@_registered(f"""
WITH t AS (
  SELECT ts, count(*) AS n FROM events GROUP BY 1
), p AS (
  SELECT *, (sum(n) OVER (ORDER BY ts) - n)::BIGINT // {_PART_ROWS} AS part FROM t
)
SELECT part, min(ts)::TIMESTAMP AS first_ts, sum(n)::BIGINT AS rows FROM p GROUP BY part
""")
def batch_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the engine cuts the backlog of changes into batches by count."""
    return engine_parts(feeds.event_versions(spark, sf_dir), _PART_ROWS).withColumn("first_ts", F.col("first_ts").cast("timestamp_ntz"))
