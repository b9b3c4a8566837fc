"""Envelopes of one table to rows of its destination: diff, filter, project, convert, redact.

All decisions that depend on names and types are taken when the plan is built, so a batch is
one projection over the envelope. Rows carry a status: kept, or why they are skipped.

* An update is kept if a replicated column that is not ignored differs between its images,
  compared as they came (null equals null); the names of those columns go along, in source
  order. Ignored columns neither keep a row nor are listed, but their values are written.
* Inserts, deletes and snapshot rows have one image and an empty list. A delete's row is
  the image before it. An update without its first image can't be compared and is kept.
* Columns are found by the event's own names, or, where it has none, by their current
  place; a shorter row has nulls at its end. Without names, and unless columns are assumed to
  be only ever appended, a row of another width than the current schema's is a mismatch.
* Null in a column that can't be null becomes the type's zero.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import convert as C
from ..functions import redact as R
from ..functions.types import SourceColumn, SourceTable, TargetColumn, TargetTable
from . import schema as S

STATUS, ROW = "__status", "__row_no"
KEPT, NO_CHANGE, MISMATCH, UNKNOWN = "kept", "row_level_duplicate", "column_mismatch", "unknown_action"


@dataclass(frozen=True)
class Rules:
    """The patterns of a configuration, compiled."""

    ignored: R.Patterns
    yaml: R.Patterns
    json: R.Patterns
    redaction: R.Redaction
    assume_appended: bool = True
    strict: bool = False
    wrap: bool = False

    @staticmethod
    def of(config: Config) -> Rules:
        return Rules(
            R.Patterns(config.ignored_columns_for_deduplication), R.Patterns(config.yaml_columns), R.Patterns(config.json_columns),
            R.Redaction(config.anonymize_fields, config.skip_anonymize_fields), config.assume_only_appended_columns, config.strict_temporal, config.wrap_integers,
        )

    def is_ignored(self, table: str, column: str) -> bool:
        return self.ignored.matches(f"{column}.{table}") or self.ignored.matches(f"{table}.{column}")


def image_value(image: Column, name: str, place: int | None, names: Column) -> Column:
    """A column's text in an image: by the event's names, else by its current place."""
    by_place = F.get(image, F.lit(place)) if place is not None else F.lit(None).cast("string")
    by_name = F.get(image, (F.array_position(names, F.lit(name)) - 1).cast("int"))
    return F.when(F.size(names) > 0, by_name).otherwise(by_place)


def changed_columns(columns: list[tuple[int | None, SourceColumn]], table: str, rules: Rules) -> Column:
    """Names of the columns that differ between the images."""
    names = F.coalesce("column_names", F.array().cast("array<string>"))
    differs = [
        F.when(~image_value(F.col("before"), c.name, i, names).eqNullSafe(image_value(F.col("after"), c.name, i, names)), F.lit(c.name))
        for i, c in columns
        if not rules.is_ignored(table, c.name)
    ]
    return F.array_compact(F.array(*differs)) if differs else F.array().cast("array<string>")


def destination_value(text: Column, source: SourceColumn, target: TargetColumn, table: str, rules: Rules) -> Column:
    """One value in the destination's type, redacted, with nulls replaced where they can't stand."""
    if source.kind == "text":
        path = f"{table}.{source.name}"
        if rules.yaml.matches(path):
            text = R.document_udf(path, rules.redaction, True, target.is_uint64)(text)
        elif rules.json.matches(path) and not target.is_uint64:
            text = R.document_udf(path, rules.redaction, False)(text)
        else:
            text = R.redact_text(text, table, source.name, rules.redaction, target.is_uint64)
    return C.null_default(C.convert(text, source, target, rules.strict, rules.wrap), target)


def translate(feed: DataFrame, source: SourceTable, target: TargetTable, rules: Rules) -> DataFrame:
    """Destination columns in their order, with status and row number. `feed`: one table's envelopes."""
    columns = S.replicated_columns(source, target)
    names = F.coalesce("column_names", F.array().cast("array<string>"))
    row = F.coalesce("after", "before")
    both = (F.col("action") == "update") & F.col("before").isNotNull() & F.col("after").isNotNull()
    rows = feed.withColumn("__changed", F.when(both, changed_columns(columns, source.name, rules)).otherwise(F.array().cast("array<string>")))
    other_width = (F.size(names) == 0) & (F.size(row) != len(source.columns))
    status = (
        F.when(~F.coalesce(F.col("action").isin("insert", "update", "delete", "dump"), F.lit(False)), UNKNOWN)
        .when(F.lit(not rules.assume_appended) & other_width, MISMATCH)
        .when(both & (F.size("__changed") == 0), NO_CHANGE)
        .otherwise(KEPT)
    )
    by_name = {c.name: (i, c) for i, c in columns}
    created = F.when(F.col("commit_ts").isNull(), F.raise_error(F.lit("an event without a commit time"))).otherwise(F.col("commit_ts"))
    fixed = {
        S.CREATED_AT: created,
        S.ACTION: F.col("action"),
        S.SERVER_ID: F.col("server_id"),
        S.TXN_ID: F.col("txn_id"),
        S.EVENT_NO: F.col("event_no"),
        S.ROW_NO: F.coalesce("row_no", F.lit(0)),
        S.UPDATED: F.col("__changed"),
    }
    out = []
    for c in target.columns:
        if c.name in fixed:
            value = fixed[c.name]
        else:
            i, own = by_name[c.name]
            value = destination_value(image_value(row, c.name, i, names), own, c, source.name, rules)
        out.append(value.cast(c.spark_type).alias(c.name, metadata={"type": c.type}))
    return rows.withColumn(STATUS, status).select(*out, F.col(STATUS), F.coalesce("row_no", F.lit(0)).alias(ROW))
