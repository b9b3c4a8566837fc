r"""Document fingerprints by one-permutation MinHash. Native: DataFrame functions only.

A text's words (lower case, `[\p{L}\p{N}_]+`) give shingles of five; a shorter text has
one shingle of all its words. Each shingle is hashed once. The hash's leading bits
choose one of BINS bins, the least remaining value of a bin is its MinHash. Empty bins
are filled by optimal densification: an empty bin takes the value of the first full bin
in a fixed pseudo-random order that belongs to the bin (2-universal in effect: each
order is a permutation drawn from the bin's number, so the search always ends and the
first full bin is uniform among the full ones). The low BITS bits of each value are kept,
packed as hex text in bin order.

Likeness of two fingerprints: the share m of equal bins, corrected for chance matches of
BITS-bit values, (m - 2^-BITS) / (1 - 2^-BITS), not under 0.

Everything of one text is made in its row from arrays, so there is no shuffle.

Cases: null text counts as empty; a text without words has the fingerprint "" and
likeness 1 to another such text, 0 to any other; equal texts have equal fingerprints;
repeated rows give repeated results; an empty table gives an empty result; columns other
than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

import json
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

BINS, BITS, SHINGLE, SEED = 128, 8, 5, 42


def _once(value: Column, then) -> Column:
    return F.transform(F.array(value), then)[0]


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """64-bit hashes of the shingles, in order: words are hashed, then runs of word hashes."""
    words = F.regexp_extract_all(F.lower(common.text_or_empty(text)), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    runs = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - shingle), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(shingle)))
    )
    short = lambda h: F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(h)))
    return _once(hashes, lambda h: F.when(F.size(h) >= shingle, runs(h)).otherwise(short(h)))


def _probe_orders(bins: int) -> list[list[int]]:
    """For each bin an order of all bins, from a multiplicative hash of (bin, other)."""
    mask = (1 << 64) - 1

    def key(i: int, j: int) -> int:
        x = (i * bins + j + SEED) * 0x9E3779B97F4A7C15 & mask
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    return [sorted(range(bins), key=lambda j, i=i: key(i, j)) for i in range(bins)]


def fingerprint(text: Column, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE) -> Column:
    """Packed low bits as hex text; "" where there are no words."""
    shift = 64 - (bins.bit_length() - 1)
    bin_of = lambda h: F.shiftrightunsigned(h, shift).cast("int")
    # unsigned order within a bin is signed order, as all of a bin share their leading bit
    first = lambda s: F.filter(s, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(s, i - 1))))
    # constant: parsed once, when the plan is optimised
    table = F.from_json(F.lit(json.dumps(_probe_orders(bins))), "array<array<int>>")

    def pack(mins: Column) -> Column:
        full = F.transform(mins, bin_of)

        def value(b: Column, own: Column) -> Column:
            at = F.array_position(own, b)
            donor = F.when(at > 0, at).otherwise(F.array_position(own, F.get(F.array_intersect(F.get(table, b), own), F.lit(0))))
            return F.lpad(F.lower(F.hex(F.get(mins, (donor - 1).cast("int")).bitwiseAND((1 << bits) - 1))), (bits + 3) // 4, "0")

        every = F.sequence(F.lit(0), F.lit(bins - 1))
        return _once(full, lambda own: F.array_join(F.transform(every, lambda b: value(b, own)), ""))

    # leading bits order the bins: as signed numbers the upper half comes first, which only renames bins
    mins = lambda hashes: _once(F.sort_array(hashes), first)
    packed = _once(shingle_hashes(text, shingle), lambda hashes: F.when(F.size(hashes) == 0, F.lit("")).otherwise(_once(mins(hashes), pack)))
    return packed


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two fingerprints."""
    digits = (bits + 3) // 4
    cut = lambda f: F.regexp_extract_all(f, F.lit(f".{{{digits}}}"), F.lit(0))
    same = F.size(F.filter(F.zip_with(cut(a), cut(b), lambda x, y: x == y), lambda e: e))
    chance = 2.0**-bits
    estimate = F.greatest((same / bins - chance) / (1 - chance), F.lit(0.0))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(estimate)


def with_next(docs: DataFrame, make, id_col: str = "doc_id", text_col: str = "text", rows_per_block: int = 2000, most_blocks: int = 1 << 15) -> DataFrame:
    """id, text and what `make` adds to them, each also as next_*: the next row's in
    descending id, after the last the first's. `make` runs once a row, before rows move.

    Ids are cut into blocks at their quantiles. A block's rows meet in one task, with the
    first row of the following block as a guest; so the texts move once, and no task sees
    more than a block. Only the cuts and the first ids of blocks come to the driver,
    `most_blocks` numbers at most. Null ids come last; rows of equal id go by text, null
    texts last.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    seen = docs.agg(F.count("*").alias("n"), F.count("id").alias("known")).first()
    blocks = max(1, min(most_blocks, -(-seen.n // rows_per_block)))
    cuts: list = []
    if blocks > 1 and seen.known:
        shares = [i / blocks for i in range(1, blocks)]
        cuts = sorted({c for c in docs.agg(F.percentile_approx("id", shares, max(10_000, 4 * blocks)).alias("c")).first().c}, reverse=True)
    # blocks: 0 holds the largest ids; null ids have a block of their own after all others
    block, nulls = _block_of(F.col("id"), cuts), len(cuts) + 1
    heads = {r.block: r.head for r in docs.filter("id is not null").groupBy(block.alias("block")).agg(F.max("id").alias("head")).collect()}
    is_head = F.col("id") == F.get(F.array(*[F.lit(heads.get(b)) for b in range(nulls + 1)]), F.col("block"))
    if seen.known < seen.n:
        heads[nulls] = None
        most = docs.filter("id is null").agg(F.max("text").alias("t")).first().t
        is_head = F.when(F.col("id").isNull(), F.col("text").eqNullSafe(F.lit(most))).otherwise(is_head)
    held = sorted(heads)
    prior = dict(zip(held, [*held[-1:], *held[:-1]], strict=True))
    rows = docs.withColumn("block", F.when(F.col("id").isNull(), nulls).otherwise(block))
    into = F.array(F.struct("block", F.lit(False).alias("guest")))
    guest = F.array(F.struct(F.get(F.array(*[F.lit(prior.get(b, 0)) for b in range(nulls + 1)]), F.col("block")).alias("block"), F.lit(True).alias("guest")))
    rows = rows.withColumn("into", F.when(is_head, F.concat(into, guest)).otherwise(into)).drop("block")
    rows = make(rows)
    made = [c for c in rows.columns if c not in ("id", "into")]
    rows = rows.select("*", F.inline("into")).drop("into")
    order = Window.partitionBy("block").orderBy("guest", F.col("id").desc_nulls_last(), F.col("text").desc_nulls_last())
    rows = rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in made})
    return rows.filter(~F.col("guest")).drop("guest", "block")


def _block_of(id_: Column, cuts: list) -> Column:
    """Number of cuts above the id, by a 32-ary search in a constant array."""
    n = len(cuts)
    if not n:
        return F.lit(0)  # one block
    table = F.array(*map(F.lit, cuts))
    fan, step = 32, 1
    while step * fan < n:
        step *= fan
    position = F.lit(0)

    def advance(step: int, at: Column) -> Column:
        above = lambda k: F.coalesce(F.get(table, at + k * step - 1) > id_, F.lit(False))
        return at + step * F.size(F.filter(F.sequence(F.lit(1), F.lit(fan)), above))

    while step >= 1:
        position = _once(position, partial(advance, step))
        step //= fan
    return position


def edited_text(text: Column, next_text: Column) -> Column:
    """The last half of the code points (rounded down) replaced by the next text's first as many, or all."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - half), F.substr(next_text, F.lit(1), half))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: fingerprints of every whole text, of its edited text, and their likeness."""
    docs = common.read_table(spark, sf_dir, "documents")
    rows = with_next(docs, lambda rows: rows.withColumn("fingerprint", fingerprint(F.col("text"))))
    edited = edited_text(common.text_or_empty(F.col("text")), common.text_or_empty(F.col("next_text")))
    rows = rows.select(
        F.col("id").alias("doc_id"),
        F.length(common.text_or_empty(F.col("text"))).cast("long").alias("n_chars"),
        F.sha2(edited.cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint(edited).alias("edited_fingerprint"),
        "next_fingerprint",
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
