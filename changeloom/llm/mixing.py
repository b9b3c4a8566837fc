"""Mixing sources to target weights with hash-threshold histograms.

A document's size is its number of words. Sources, in code point order with null last,
weigh 1, 2, 3, 1, 2, 3, ... and share the sum of all sizes; a target stops at
`max_repeats` times its source's size, and what is over is shared again by weight until
none is above. With the level L at which the free sources stand, target = L * weight or
the cap, so one ordering of the sources by cap / weight gives it without iterating.

A target of q whole passes and a rest takes every document q times, and for the rest
those documents whose 60-bit hash lies under the source's threshold. Thresholds come from
histograms: sizes summed by source and the leading 12 bits of the hash, a running sum over
at most 4096 buckets, and the bucket in which the budget ends; only that bucket is
summed again by its next 12 bits, and so on, until it holds a single hash. Larger budgets
give larger thresholds, so mixes are nested. Documents are never sorted, nor gathered by
source: sums are made where the rows lie, and the last step is a filter.

The hash is of doc_id, source and text, so a rerun takes the same documents. Rows that are
equal in all three have one hash. Where a budget ends among such repeats, as many of them are
taken as come nearest to it, by a second threshold over hashes of their places; which ones
makes no difference.

Cases: null text has size 0; documents of size 0 are taken 0 words and, if their hash
is under the threshold, as documents; null doc_id and null source are values like others;
whole texts of any length are counted; an empty table gives an empty result. Other columns
pass through and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
HASH_BITS, STEP_BITS = 60, 12
_P = "__mix_"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_of(*columns: Column) -> Column:
    """60 bits of md5 over the columns' text, each marked null or with its length."""
    parts = [F.concat(F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"))), F.coalesce(c.cast("string"), F.lit(""))) for c in columns]
    return F.conv(F.substr(F.md5(F.concat(*parts).cast("binary")), F.lit(1), F.lit(HASH_BITS // 4)), 16, 10).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target. One row per source: sums come from the map side."""
    sources = sized.groupBy(f"{_P}source").agg(F.sum(f"{_P}size").alias("source_size"))
    total = F.sum("source_size").over(Window.partitionBy())
    order = Window.orderBy(F.col(f"{_P}source").asc_nulls_last())
    sources = sources.withColumns({"total": total, "weight": F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1))})
    sources = sources.withColumn("cap", F.col("source_size") * max_repeats)
    # capped sources are a prefix of the order by cap / weight; equal ratios are capped together or not at all
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col(f"{_P}source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.withColumns(
        {
            "caps_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weights_from": F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    free = (F.col("total") - F.col("caps_before")) * F.col("weight") <= F.col("cap") * F.col("weights_from")
    # the level stands where the first free source stands
    first_free = F.min_by(F.struct("caps_before", "weights_from"), F.when(free, F.col("cap") / F.col("weight"))).over(Window.partitionBy())
    sources = sources.withColumns({"is_free": free, "level": first_free})
    shared = F.col("weight") * (F.col("total") - F.col("level")["caps_before"]) / F.col("level")["weights_from"]
    return sources.select(f"{_P}source", "source_size", F.when(F.col("is_free"), shared).otherwise(F.col("cap").cast("double")).cast("double").alias("target"))


def _with(df: DataFrame, small: DataFrame) -> DataFrame:
    """`small` has a row per source. Catalyst broadcasts it if its files are small enough,
    and else joins by source, where adaptive execution splits a hot source."""
    other = small.withColumnRenamed(f"{_P}source", f"{_P}other")
    return df.join(other, F.col(f"{_P}source").eqNullSafe(F.col(f"{_P}other"))).drop(f"{_P}other")


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, threshold, edge, edge_budget: the hashes under the threshold hold about `budget`
    words of the source.

    `budgets`: source, budget. The document in which the budget ends is in if that comes
    nearer. A budget of the whole source or more takes all. If it ends among several rows of
    one hash, that is `edge` (else null), and `edge_budget` words of them belong to the mix.
    """
    state = budgets.withColumns({"lo": F.lit(0).cast("long"), "rest": F.col("budget"), "done": F.lit(False), "edge": F.lit(None).cast("long")}).drop("budget")
    for level in range(HASH_BITS // STEP_BITS):
        shift = HASH_BITS - STEP_BITS * (level + 1)
        width = 1 << shift
        h = F.col(f"{_P}hash")
        rows = _with(sized.select(f"{_P}source", f"{_P}hash", f"{_P}size"), state.filter(~F.col("done")))
        rows = rows.filter((h >= F.col("lo")) & (h < F.col("lo") + width * (1 << STEP_BITS)))
        hist = rows.groupBy(f"{_P}source", "lo", "rest", F.shiftright(h, shift).alias("bucket")).agg(
            F.sum(f"{_P}size").alias("words"), F.count("*").alias("rows"), F.min(h).alias("least"), F.max(h).alias("most")
        )
        upto = F.sum("words").over(Window.partitionBy(f"{_P}source").orderBy("bucket"))
        hist = hist.withColumn("upto", upto)
        # the bucket where the budget ends: the first one with a larger running sum
        ends = hist.filter(F.col("upto") > F.col("rest")).groupBy(f"{_P}source").agg(F.min_by(F.struct("bucket", "words", "rows", "upto", "least", "most"), "bucket").alias("b"))
        found = _left_with(state, ends)
        b = F.col("b")
        before = b["upto"] - b["words"]
        left = F.col("rest") - before
        single = (b["least"] == b["most"]) | F.lit(shift == 0)
        # how many rows of a single hash come nearest
        near = F.floor(left / (b["words"] / b["rows"]) + 0.5)
        some = single & (near > 0) & (near < b["rows"])
        state = found.select(
            f"{_P}source",
            # all fits: the end of this range; a single hash: one side of it; else its bucket's start
            F.when(F.col("done"), F.col("lo"))
            .when(b.isNull(), F.col("lo") + width * (1 << STEP_BITS))
            .when(single, F.when(near >= b["rows"], b["most"] + 1).otherwise(b["least"]))
            .otherwise(b["bucket"] * width)
            .alias("lo"),
            F.when(F.col("done") | b.isNull(), F.col("rest")).otherwise(left).alias("rest"),
            (F.col("done") | b.isNull() | single).alias("done"),
            F.when(F.col("done"), F.col("edge")).when(some, b["least"]).alias("edge"),
        )
        state = common.materialize(state, "mix-thresholds")
        if state.filter(~F.col("done")).isEmpty():
            break
    return state.select(f"{_P}source", F.col("lo").alias("threshold"), "edge", F.when(F.col("edge").isNotNull(), F.col("rest")).alias("edge_budget"))


def _left_with(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.withColumnRenamed(f"{_P}source", f"{_P}other")
    return left.join(other, F.col(f"{_P}source").eqNullSafe(F.col(f"{_P}other")), "left").drop(f"{_P}other")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> tuple[DataFrame, DataFrame]:
    """The sized rows (id, source, size, hash; written once) and the decision per source:
    source, source_size, target, passes, threshold, edge, edge_budget."""
    sized = docs.select(
        F.col(id_col).alias(f"{_P}id"),
        F.col(source_col).alias(f"{_P}source"),
        size_of(F.col(text_col)).alias(f"{_P}size"),
        hash_of(F.col(id_col), F.col(source_col), F.col(text_col)).alias(f"{_P}hash"),
    )
    sized = common.materialize(sized, "mix-sized")
    wanted = common.materialize(targets(sized, weights, max_repeats), "mix-targets")
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_repeats))).otherwise(0).cast("long")
    wanted = wanted.withColumn("passes", passes)
    budgets = wanted.select(f"{_P}source", (F.col("target") - F.col("passes") * F.col("source_size")).alias("budget"))
    # one row a source, written, as several steps read it
    return sized, common.materialize(_with(wanted, thresholds(sized, budgets)), "mix-decision")


def _taken(rows: DataFrame, decision: DataFrame, max_repeats: int) -> DataFrame:
    """`rows` (with source, size and hash) joined to their source's decision, with `copies`."""
    rows = _with(rows, decision)
    h, p = F.col(f"{_P}hash"), F.col("passes")
    most = F.lit(max_repeats).cast("long")
    below = rows.withColumn(f"{_P}copies", F.least(p + (h < F.col("threshold")).cast("long"), most))
    if decision.filter("edge is not null").isEmpty():
        return below
    at_edge = F.coalesce(h == F.col("edge"), F.lit(False))
    # repeats at an edge, by their places: written once, so that all that follows sees the same ones
    edge = materialized_places(rows.filter(at_edge))
    own = edge.select(f"{_P}source", f"{_P}size", F.col(f"{_P}place").alias(f"{_P}hash"))
    second = thresholds(own, decision.filter("edge is not null").select(f"{_P}source", F.col("edge_budget").alias("budget")))
    edge = _with(edge, second.select(f"{_P}source", F.col("threshold").alias(f"{_P}second")))
    edge = edge.withColumn(f"{_P}copies", F.least(p + (F.col(f"{_P}place") < F.col(f"{_P}second")).cast("long"), most))
    return below.filter(~at_edge).unionByName(edge.drop(f"{_P}place", f"{_P}second"))


def materialized_places(rows: DataFrame) -> DataFrame:
    """Rows with a hash of HASH_BITS bits of their place in the table as it is written."""
    place = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND((1 << HASH_BITS) - 1)
    return common.materialize(rows.withColumn(f"{_P}place", place), "mix-edge")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixed corpus: the rows of `docs`, each as often as the mix takes it."""
    _, decision = plan(docs, id_col, text_col, source_col, weights, max_repeats)
    # a row is one value, so that no column of it meets one of ours
    rows = docs.select(
        F.struct(*docs.columns).alias(f"{_P}row"),
        F.col(source_col).alias(f"{_P}source"),
        size_of(F.col(text_col)).alias(f"{_P}size"),
        hash_of(F.col(id_col), F.col(source_col), F.col(text_col)).alias(f"{_P}hash"),
    )
    rows = _taken(rows, decision, max_repeats).filter(F.col(f"{_P}copies") > 0)
    rows = rows.select(f"{_P}row", F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{_P}copies"))).alias(f"{_P}copy"))
    return rows.select(f"{_P}row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: what the mix of all documents takes of each."""
    sized, decision = plan(common.read_table(spark, sf_dir, "documents"))
    return _taken(sized, decision, MAX_REPEATS).select(
        F.col(f"{_P}id").alias("doc_id"),
        F.col(f"{_P}size").alias("size"),
        "source_size",
        "target",
        (F.col(f"{_P}copies") * F.col(f"{_P}size")).alias("taken"),
    )


#: The same mix by sorting: the running sum by hash shows where each budget ends.
ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(CASE WHEN doc_id IS NULL THEN 'n' ELSE length(doc_id::VARCHAR) || ':' END || coalesce(doc_id::VARCHAR, '')
           || CASE WHEN source IS NULL THEN 'n' ELSE length(source) || ':' END || coalesce(source, '')
           || CASE WHEN text IS NULL THEN 'n' ELSE length(text) || ':' END || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sized GROUP BY source
), c AS (
  SELECT *, source_size * 3 AS cap, sum(source_size) OVER ()::BIGINT AS total FROM s
), r AS (
  SELECT *, coalesce(sum(cap) OVER w, 0)::BIGINT AS caps_before, (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::BIGINT AS weights_from FROM c
  WINDOW w AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, (total - caps_before) * weight <= cap * weights_from AS is_free FROM r
), l AS (
  SELECT arg_min(caps_before, cap::DOUBLE / weight) AS lc, arg_min(weights_from, cap::DOUBLE / weight) AS lw FROM f WHERE is_free
), t AS (
  SELECT source, source_size, CASE WHEN is_free THEN (weight * (total - lc))::DOUBLE / lw ELSE cap::DOUBLE END AS target FROM f, l
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS passes FROM t
), o AS (
  SELECT d.doc_id, d.size, q.source_size, q.target, q.passes, q.target - q.passes * q.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.n) AS upto, d.size AS own
  FROM (SELECT *, row_number() OVER (PARTITION BY source, h) AS n FROM sized) d JOIN q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, source_size, target,
       (size * least(passes + CASE WHEN upto <= rest OR (upto - own <= rest AND 2 * (rest - (upto - own)) >= own) THEN 1 ELSE 0 END, 3))::BIGINT AS taken
FROM o
"""
