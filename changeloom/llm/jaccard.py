r"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of shingles: SHINGLE consecutive words (`\w+`, lower case); a text with fewer
words is one shingle of all of them. All pairs of texts with similarity of at least
THRESHOLD are found, counted and joined into classes.

1. Every row gets a 128-bit key of its shingle set and HASHES MinHash values. Rows of one
   key are copies; one of them, a node, stands for all, so copies never meet in pairs.
2. BANDS bands of MinHash values put nodes into buckets; at similarity 0.8 a pair shares no
   bucket with probability (1 - 0.8^4)^24 = 3e-6.
3. In a bucket, pairs are compared by their MinHash values, STEP at a time. With a uniform
   prior the posterior probability of reaching the threshold after m equal values of n is
   that of at most m successes of n + 1 at rate THRESHOLD; pairs for which it falls under
   TOLERANCE are dropped. Survivors leave a spanning forest of the bucket, never pairs.
4. Connected components of the survivors hold every pair that is left to verify. Within a
   component all pairs are verified exactly by their shingle sets; that gives each node its
   number of links and, again as a spanning forest, the links that make classes.

A bucket or component of any size is cut into blocks; a task sees two blocks, so its memory
is bounded, and every pair of blocks has a task. Links are counted where they are found and
summed by node. Neither pairs nor components nor signatures come to the driver: it sees
counts of changed rows only. Cut points are Parquet files in the shared folder.

Moving whole texts is what a join like this costs most, so only texts of nodes with survivors
move: a Bloom filter of at most BLOOM_BITS bits, whatever the number of nodes, tells most
others apart where they lie (a full filter only lets more texts move).

Result: one row per row of the input with class_id (least id of the class) and n_links
(other rows at or above the threshold, copies included).

Cases: texts without words, null ones too, have no shingles, are linked to nothing and are
classes of their own; rows of equal text are linked, equal ids or not; null ids are kept, a
class' id is the least known one; an empty table gives an empty result; other columns are
ignored, whatever their names; texts of any length are compared whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SHINGLE, THRESHOLD = 5, (4, 5)  # as a fraction, so that verification is exact
BANDS, BAND_ROWS, STEP, TOLERANCE, SEED = 24, 4, 16, 1e-6, 5
HASHES = BANDS * BAND_ROWS
BUCKET_BLOCK, NODE_BLOCK, SHINGLE_BLOCK = 1024, 1024, 1 << 21
BLOOM_BITS, SALTS = 1 << 26, 16
#: Keys that hold a greater share of the rows than one in so many are looked up apart: at most so many keys.
HOT_SHARE = 1000
_CACHE = 150_000
_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(0xD1342543DE82EF95, SHINGLE - 1 - k, 1 << 64) for k in range(SHINGLE)], np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        found = self[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, hashes: dict[str, int]) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([hashes[w] for w in words], np.uint64)
    if len(h) < SHINGLE:
        return _mixed((h * _POWERS[-len(h) :]).sum(dtype=np.uint64, keepdims=True) + np.array([len(h)], np.uint64) * _MIX)
    n = len(h) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total += h[k : k + n] * _POWERS[k]
    return np.unique(_mixed(total))


def set_key(sorted_hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(sorted_hashes.tobytes(), digest_size=16).digest() if len(sorted_hashes) else None


_rng = np.random.default_rng(SEED)
_A = (_rng.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)


def minhash(sorted_hashes: np.ndarray) -> np.ndarray:
    x = (sorted_hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, np.uint32(0xFFFFFFFF))
    for at in range(0, len(x), 512):
        np.minimum(out, (x[at : at + 512, None] * _A + _B).min(0), out=out)
    return out


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """A signed 64-bit number for each band; the band's number is part of it."""
    s = signature.reshape(BANDS, BAND_ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX
    for k in range(BAND_ROWS):
        h = _mixed(h ^ s[:, k] * _MIX)
    return h.view(np.int64)


def least_matches() -> list[tuple[int, int]]:
    """(n, m): after n values, pairs with fewer than m equal ones are dropped."""
    t = THRESHOLD[0] / THRESHOLD[1]
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < TOLERANCE:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


_LEAST = least_matches()


def surviving(signatures: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that Bayesian pruning leaves."""
    equal = np.zeros(len(i), np.int32)
    for n, least in _LEAST:
        if not len(i):
            break
        equal += (signatures[i, n - STEP : n] == signatures[j, n - STEP : n]).sum(1, dtype=np.int32)
        keep = equal >= least
        i, j, equal = i[keep], j[keep], equal[keep]
    return i, j


def forest(n: int, i: np.ndarray, j: np.ndarray, names: list[int]) -> list[tuple[int, int]]:
    """Edges from the least name of each connected set to its other members."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    sets: dict[int, list[int]] = {}
    for k in np.flatnonzero(np.bincount(label, minlength=n)[label] > 1):
        sets.setdefault(int(label[k]), []).append(names[k])
    return [(least, other) for own in sets.values() for least in [min(own)] for other in own if other != least]


def _pairs(n: int, blocks: np.ndarray, low: int, high: int, most: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs that a task of blocks (low, high) has to look at, in parts."""
    left = np.flatnonzero(blocks == low)
    right = left if low == high else np.flatnonzero(blocks == high)
    rows = max(1, most // max(len(right), 1))
    for at in range(0, len(left), rows):
        part = left[at : at + rows]
        i, j = np.repeat(part, len(right)), np.tile(right, len(part))
        if low == high:
            keep = i < j
            i, j = i[keep], j[keep]
        yield i, j


def _groups(batches, keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of equal keys, whole: rows come sorted by them, and a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        change[0] = first != last
        cuts = np.flatnonzero(change)
        if held and change[0]:
            yield pa.Table.from_batches(held)
            held = []
        starts = cuts if change[0] else np.r_[0, cuts]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            part = batch.slice(a, b - a)
            yield pa.Table.from_batches([*held, part])
            held = []
        held.append(batch.slice(starts[-1]))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def _block_pairs(df: DataFrame, blocks: Column, key: str) -> DataFrame:
    """Each row once for every pair of blocks that holds its block: columns block, low, high."""
    df = df.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64(key, F.lit("block")), F.col("blocks")).cast("int"))
    return df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    ).drop("other", "blocks")


def _cut(df: DataFrame, label: str) -> DataFrame:
    """A cut point, and what led to it let go: the join has some twenty, and the driver's heap keeps
    what it has once taken for the plans, statistics and filters of one unless it is told to."""
    out = common.materialize(df, label)
    common.drop_unused(df.sparkSession)
    return out


def keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, row (64-bit hash of id and text), key, shingle count and signature of every row."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("row", row_of(F.col("id"), F.col("text")))
    kind = dict(docs.dtypes)["id"]

    def run(batches):
        hashes = _WordHashes()
        for batch in batches:
            for part in common.slices(batch, "text"):
                found, sizes, signed = [], [], []
                for text in part.column("text").to_pylist():
                    own = shingles(text, hashes)
                    found.append(set_key(own))
                    sizes.append(len(own))
                    signed.append(minhash(own).tobytes() if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("row"), pa.array(found, pa.binary()), pa.array(sizes, pa.int32()), pa.array(signed, pa.binary())],
                    ["id", "row", "key", "shingles", "signature"],
                )

    return docs.select("id", "row", "text").mapInArrow(common.tidy(run), f"id {kind}, row bigint, key binary, shingles int, signature binary")


def row_of(id_: Column, text: Column) -> Column:
    return F.xxhash64(id_, text, text.isNull())


def candidates(one: DataFrame) -> DataFrame:
    """Edges (a, b) between nodes: a spanning forest of the pairs that survive in each bucket."""

    def bands(batches):
        for batch in batches:
            h = [band_hashes(np.frombuffer(s, np.uint32)) for s in batch.column("signature").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(h, pa.list_(pa.int64()))], ["node", "bands"])

    entries = one.select("node", "signature").mapInArrow(common.tidy(bands), "node bigint, bands array<bigint>")
    entries = entries.select("node", F.explode("bands").alias("bucket"))
    # buckets are counted where their entries lie; only entries of buckets with several move again,
    # each with a salt, so that no bucket is gathered to learn its size
    sizes = _cut(entries.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1"), "jaccard-buckets")
    entries = likely(entries, sizes, "bucket").withColumn("salt", F.pmod(F.xxhash64("node", F.lit("salt")), F.lit(SALTS)))
    sizes = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("members") > 0, F.lit(SALTS - 1).cast("long")))))
    entries = entries.join(sizes, ["bucket", "salt"]).drop("salt")
    members = entries.join(one.select("node", "signature"), "node")
    members = _block_pairs(members, F.ceil(F.col("members") / BUCKET_BLOCK), "node").drop("members")
    members = members.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")

    def run(batches):
        for group in _groups(batches, ("bucket", "low", "high")):
            names = group.column("node").to_pylist()
            if len(names) < 2:
                continue
            signatures = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
            blocks = group.column("block").to_numpy()
            kept = [surviving(signatures, i, j) for i, j in _pairs(len(names), blocks, group.column("low")[0].as_py(), group.column("high")[0].as_py())]
            edges = forest(len(names), np.concatenate([k[0] for k in kept]), np.concatenate([k[1] for k in kept]), names)
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["a", "b"])

    return members.select("bucket", "low", "high", "block", "node", "signature").mapInArrow(common.tidy(run), "a bigint, b bigint").distinct()


def components(edges: DataFrame, label: str) -> DataFrame:
    """node, component (its least node) of all nodes of the edges.

    Labels go to neighbours and then to the label's own label, until none changes; forests
    of stars need few rounds. Each round is a written table, and only a count is collected.
    """
    both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    both = _cut(both, f"{label}-edges")
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component"))
    labels = _cut(labels, f"{label}-labels")
    while True:
        sent = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("told"))
        heard = labels.join(sent, labels.node == sent.a, "left").select("node", F.col("component").alias("old"), F.least("component", "told").alias("component"))
        heard = _cut(heard, f"{label}-heard")
        of = heard.select(F.col("node").alias("over"), F.col("component").alias("top"))
        jumped = heard.join(of, heard.component == of.over, "left").select("node", "old", F.least("component", F.coalesce("top", "component")).alias("component"))
        jumped = _cut(jumped, f"{label}-labels")
        labels = jumped.select("node", "component")
        if jumped.filter("component <> old").isEmpty():
            return labels


def likely(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows whose 64-bit `column` may be among those of `wanted`: all that are, few others.

    A Bloom filter with one hash: its bits are gathered as words of 64, BLOOM_BITS / 64 of
    them at most.
    """
    place = F.pmod(F.xxhash64(column, F.lit("bloom")), F.lit(BLOOM_BITS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64(`{column}`, 'bloom'), {BLOOM_BITS}), 64) as int))")
    words = wanted.select(F.floor(place / 64).cast("int").alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    held = np.zeros(BLOOM_BITS // 64, np.int64)
    held[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    bloom = rows.sparkSession.sparkContext.broadcast(held.view(np.uint64))

    def run(batches):
        for batch in batches:
            at = batch.column("__place").to_numpy()
            keep = (bloom.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.drop_columns(["__place"]).filter(pa.array(keep.astype(bool)))

    return rows.withColumn("__place", place).mapInArrow(common.tidy(run), rows.schema)


def _linked(sets: list[np.ndarray], blocks: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Exactly verified pairs of a task of two blocks."""
    left = np.flatnonzero(blocks == low)
    right = left if low == high else np.flatnonzero(blocks == high)
    if not len(left) or not len(right):
        return left[:0], left[:0]
    sizes = np.array([len(s) for s in sets])
    every, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = np.bincount(column, minlength=len(every)) > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    common_ = np.zeros((len(left), len(right)), np.float32)  # counts are exact far beyond 16 million here: see SHINGLE_BLOCK
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(64, min(4096, (1 << 22) // len(sets)))
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (at, at + width))
        held = np.zeros((len(sets), width), np.float32)
        held[row[a:b], column[a:b] - at] = 1
        common_ += held[left] @ held[right].T
    total = sizes[left][:, None] + sizes[right][None, :] - common_
    yes = THRESHOLD[1] * common_.astype(np.float64) >= THRESHOLD[0] * total.astype(np.float64)
    i, j = np.nonzero(yes)
    i, j = left[i], right[j]
    if low == high:
        i, j = i[i < j], j[i < j]
    return i, j


def verify(members: DataFrame) -> DataFrame:
    """members: component, blocks, node, key, n_docs, text. Rows (a, b, links): a node's number
    of linked rows with null b, or an edge of a spanning forest of the links."""
    rows = _block_pairs(members, F.col("blocks"), "node")
    rows = rows.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high")

    def run(batches):
        hashes = _WordHashes()
        for group in _groups(batches, ("component", "low", "high")):
            names, sets, docs, blocks = [], [], [], []
            seen = set()
            for name, key, text, n, block in zip(*(group.column(c).to_pylist() for c in ("node", "key", "text", "n_docs", "block")), strict=True):
                own = shingles(text, hashes)
                if name in seen or set_key(own) != key:  # a repeated row, or another text of the same row hash
                    continue
                seen.add(name)
                names.append(name)
                sets.append(own)
                docs.append(n)
                blocks.append(block)
            if len(names) < 2:
                continue
            i, j = _linked(sets, np.array(blocks), group.column("low")[0].as_py(), group.column("high")[0].as_py())
            weight = np.array(docs, np.float64)
            links = (np.bincount(i, weight[j], len(names)) + np.bincount(j, weight[i], len(names))).astype(np.int64)
            edges = forest(len(names), i, j, names)
            counted = np.flatnonzero(links)
            if len(counted):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[k] for k in counted] + [e[0] for e in edges], pa.int64()),
                        pa.array([None] * len(counted) + [e[1] for e in edges], pa.int64()),
                        pa.array([*links[counted].tolist(), *[None] * len(edges)], pa.int64()),
                    ],
                    ["a", "b", "links"],
                )

    return rows.select("component", "low", "high", "block", "node", "key", "n_docs", "text").mapInArrow(common.tidy(run), "a bigint, b bigint, links bigint")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, row, node of its class (null without words), class_id, n_links."""
    common.bound_batches(docs.sparkSession)
    common.drop_unused(docs.sparkSession)
    signed = _cut(keys(docs, id_col, text_col), "jaccard-keys")
    nodes = signed.filter("key is not null").groupBy("key").agg(F.min("id").alias("node_id"), F.min("row").alias("node_row"), F.count("*").alias("n_docs"), F.max("shingles").alias("shingles"))
    # numbers are given once and written: all that follows reads the same ones
    nodes = _cut(nodes.withColumn("node", F.monotonically_increasing_id()), "jaccard-nodes")
    # a node's signature comes from one of its rows
    copies = nodes.select("key", "n_docs")
    names = nodes.select("node", F.col("key").alias("node_key"), "node_row")
    one = signed.join(names, (F.col("key") == F.col("node_key")) & (F.col("row") == F.col("node_row"))).select("node", "signature")
    if rows_repeat(signed):
        one = one.dropDuplicates(["node"])
    edges = candidates(_cut(one, "jaccard-signatures"))
    found = components(edges, "jaccard-candidates")
    named = found.join(nodes, "node")
    size = named.groupBy("component").agg(F.greatest(F.ceil(F.sum("shingles") / SHINGLE_BLOCK), F.ceil(F.count("*") / NODE_BLOCK)).alias("blocks"))
    named = _cut(named.join(size, "component"), "jaccard-members")
    texts = docs.select(row_of(F.col(id_col), F.col(text_col).cast("string")).alias("row"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    texts = likely(texts, named.select(F.col("node_row").alias("row")), "row")
    members = texts.join(named, texts.row == named.node_row).select("component", "blocks", "node", "key", "n_docs", "text")
    verified = _cut(verify(members), "jaccard-verified")
    links = verified.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(verified.filter("b is not null").select("a", "b").distinct(), "jaccard-links")
    nodes = nodes.join(joined, "node", "left").join(links, "node", "left").withColumn("class_node", F.coalesce("component", "node"))
    least = nodes.groupBy("class_node").agg(F.min("node_id").alias("class_id"))
    nodes = nodes.join(least, "class_node").select("key", "class_node", "class_id", (F.col("n_docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    nodes = _cut(nodes, "jaccard-classes")
    rows = signed.select("id", "row", "key")
    # copies of one text may be a third of all rows: keys of so many rows are few, and their rows stay
    # where they lie; rows without words have no key and no node
    least = signed.count() // HOT_SHARE
    hot = nodes.join(F.broadcast(copies.filter(F.col("n_docs") > least).select("key")), "key")
    is_hot = F.col("hot").isNotNull()
    worded = rows.filter("key is not null").join(F.broadcast(hot.select("key", F.struct("class_node", "class_id", "n_links").alias("hot"))), "key", "left")
    none = [F.lit(None).cast(dict(nodes.dtypes)[c]).alias(c) for c in ("class_node", "class_id", "n_links")]
    rows = (
        rows.filter("key is null").select("id", "row", *none)
        .unionByName(worded.filter(is_hot).select("id", "row", "hot.*"))
        .unionByName(worded.filter(~is_hot).join(nodes, "key").select("id", "row", "class_node", "class_id", "n_links"))
    )
    return rows.select(
        "id",
        "row",
        F.col("class_node").alias("node"),
        F.when(F.col("class_node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, one of each class: that of the least id. Rows without words stay."""
    found = _cut(classes(docs, id_col, text_col), "jaccard-rows")
    kept = found.filter(F.col("node").isNull() | F.col("id").eqNullSafe(F.col("class_id")))
    # of several rows with a class' least id, one; without words there is no class
    alone = kept.filter("node is null").select("row").distinct()
    kept = kept.filter("node is not null").groupBy("node").agg(F.min("row").alias("row")).select("row").distinct().unionByName(alone)
    kept = _cut(kept.withColumnRenamed("row", "kept"), "jaccard-kept")
    # a row is one value, so that no column of it meets one of ours
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct(*docs.columns).alias("whole"), row_of(F.col(id_col), text).alias("row"), F.coalesce(text, F.lit("")).rlike(r"[\p{L}\p{N}_]").alias("worded"))
    rows = rows.join(kept, F.col("row") == F.col("kept"))
    if rows_repeat(found):
        rows = rows.filter(~F.col("worded")).unionByName(rows.filter("worded").dropDuplicates(["row"]))
    return rows.select("whole.*")


def rows_repeat(found: DataFrame) -> bool:
    return not found.groupBy("row").count().filter("count > 1").isEmpty()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: class and number of links of every document."""
    found = classes(common.read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\pL\pN_]+') AS ws FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS s FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY 1
), k AS (
  SELECT doc_id, md5(string_agg(s, '|' ORDER BY s)) AS k FROM g GROUP BY 1
), r AS (
  SELECT k, min(doc_id) AS rep, count(*) AS docs FROM k GROUP BY 1
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM (SELECT * FROM g WHERE doc_id IN (SELECT rep FROM r)) a JOIN (SELECT * FROM g WHERE doc_id IN (SELECT rep FROM r)) b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
), e AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 5 * p.c >= 4 * (x.n + y.n - p.c)
), c AS (
  SELECT a AS node, a AS label FROM e UNION SELECT e.b, c.label FROM c JOIN e ON e.a = c.node
), cl AS (
  SELECT node, min(label) AS class_id FROM c GROUP BY 1
), l AS (
  SELECT e.a, sum(r.docs) AS links FROM e JOIN r ON r.rep = e.b GROUP BY 1
)
SELECT d.doc_id, coalesce(cl.class_id, r.rep, d.doc_id) AS class_id, (coalesce(r.docs - 1, 0) + coalesce(l.links, 0))::BIGINT AS n_links
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN r ON r.k = k.k LEFT JOIN cl ON cl.node = r.rep LEFT JOIN l ON l.a = r.rep
"""
