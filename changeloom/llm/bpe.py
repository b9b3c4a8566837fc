"""Byte-level BPE: ranked merges folded over the byte arrays of distinct words.

Encoding, as tiktoken does it: a text is split by the tokenizer's pattern, each match
is encoded apart. A match's bytes are merged, always the leftmost of the adjacent pairs
whose joined bytes have the least rank; a match that is a token itself ends as that token.

The merges are a fold of Spark's higher-order functions: the array of a word's bytes, each
as the id of its one-byte token, loses one place a step. The rank map is constant
in the plan. As both parts of a pair are tokens, it goes from a pair of ids to the rank (which is
the id) of the joined bytes: a perfect hash table in a constant array, one look-up a pair,
whatever the vocabulary's size.

Only distinct words are folded:
1. The corpus' words are counted, all of them, and the most frequent ones folded once
   and broadcast as flat arrays: at most HOT_WORDS words of at most HOT_BYTES bytes, which
   bounds the broadcast, whatever the corpus (words of fewer than HOT_COUNT places are not). Tasks lay the arrays out.
2. The other words are folded once for each slice of about SLICE_BYTES of a partition's
   texts: rows of words go ahead of the slice's documents, in the same task.
So no word's places are ever shuffled; the counts are all that moves.

A fold costs the square of the word's length, so words are folded up to LONG bytes; longer
ones (text without any break) get the same merges from a linked list and a heap.

Decoding concatenates the ids' binary pieces: `decode` in an expression, by position in a
literal array; `encode` also in the task that has the ids, by position in flat arrays.

Cases: null and empty texts have no ids and decode to no bytes; every id sequence of
`encode` decodes to the text's bytes; ids out of the vocabulary decode to null; special
tokens' strings are ordinary text; repeated rows give repeated results; texts of any length
that Arrow holds (2 GB, also of their ids and bytes) are encoded whole, a longer one fails;
an empty table gives an empty result; other columns pass or are ignored, whatever their names. The vocabulary's path is a parameter.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import pickle
import re
import threading
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

VOCABULARY = "byte_bpe_50k.tiktoken"
HOT_WORDS, HOT_COUNT, HOT_BYTES, LONG = 1 << 19, 4, 32, 64
SLICE_BYTES, HELD_WORDS, TAIL_ROW, HOT_PARTS = 4 << 20, 50_000, 1000, 64
assert LONG <= 1 << 8  # places in a word have eight bits


@cache
def load_ranks(path: str) -> dict[bytes, int]:
    """Bytes to rank, from a rank file: base64 of the bytes and the rank, a line each."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


#: What the pattern's classes hold among the first 256 characters.
_LETTER, _NUMBER, _SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\\t-\\r \x85\xa0"


def splitter(pattern: str):
    """A function from a text to the pattern's matches.

    Texts of the first 256 characters only go by an equal pattern with these classes spelled
    out, which the standard library matches in two thirds of the time.
    """
    import regex

    every = regex.compile(pattern).findall
    if pattern != public_tokenizers.PATTERN:
        return every
    near = re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
    ).findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return every(text)
        return near(text)

    return split


#: A part of a word while it is folded: rank << _RANK | place << _PLACE | id, all numbers of tokens
#: one higher than their ranks. The rank is that of the part joined with the next one, or _NONE or
#: more where those are no token; the place is that of its first byte. So parts are distinct, and the
#: least is the leftmost of the pairs of least rank.
_PLACE, _RANK, _NEXT, _LOW_ID = 16, 24, 40, 56
_ID, _OWN, _LOW, _NONE = (1 << _PLACE) - 1, (1 << _RANK) - 1, (1 << 7) - 1, 1 << _NEXT
#: The id of what stands before the first and after the last part: in no pair.
_EDGE = _ID
#: Odd factors of the pair table's hashes.
_MIX_A, _MIX_B, _MIX_LOW = 0x9E3779B1, 0x85EBCA77, 0x2C1B3
#: Plans hold the rank map. Their descriptions, which the driver keeps of many past queries, are cut.
PLAN_CHARS = 100_000


@cache
def _pair_table(path: str) -> tuple[str, int, int]:
    """A perfect hash table of all pairs of tokens whose joined bytes are a token, and a plain
    table of all pairs of bytes.

    Pairs of one bucket are moved together by an exclusive or with the bucket's displacement,
    the first that brings all to free places. The bucket is chosen by b and the low bits of a,
    which an entry holds too. Pairs that agree in these have one displacement and, as their
    distances are multiples of an odd factor, different places: an entry and its place name one pair.
    """
    ranks = load_ranks(path)
    if max(ranks.values()) + 1 >= _EDGE:
        raise ValueError("ids of more than 16 bits need a wider entry")
    pairs = {}
    for piece, rank in ranks.items():
        for k in range(1, len(piece)):
            a, b = ranks.get(piece[:k]), ranks.get(piece[k:])
            if a is not None and b is not None:
                pairs[a + 1, b + 1] = rank + 1
    size = max(1 << (2 * max(len(pairs), 1)).bit_length(), 1 << _PLACE)
    n_buckets = size >> 2
    buckets: dict[int, list[tuple[int, int]]] = {}
    for (a, b), rank in pairs.items():
        entry = (a & _LOW) << _LOW_ID | b << _NEXT | rank << _RANK
        buckets.setdefault((a & _LOW) * _MIX_LOW + b & n_buckets - 1, []).append((a * _MIX_A + b * _MIX_B & size - 1, entry))
    table = [0] * size
    moves = [0] * n_buckets
    for k, own in sorted(buckets.items(), key=lambda kv: -len(kv[1])):
        if len({base for base, _ in own}) < len(own):
            raise ValueError("two pairs of one bucket have one hash: take other factors")
        move = next(m for m in range(size) if not any(table[base ^ m] for base, _ in own))
        moves[k] = move
        for base, entry in own:
            table[base ^ move] = entry
    of_bytes = [pairs.get((ranks[bytes([a])] + 1, ranks[bytes([b])] + 1), _NONE >> _RANK) if b < 256 else _NONE >> _RANK for a in range(256) for b in range(257)]
    return json.dumps([table, moves, of_bytes, [ranks[bytes([i])] + 1 for i in range(256)]], separators=(",", ":")), size, n_buckets


_DECLARING = threading.Lock()


def _tables(path: str, spark: SparkSession) -> tuple[Column, int, int]:
    """The pair table, its moves, the table of pairs of bytes and the ids of bytes, constant arrays in
    one; the size of the pair table and its number of buckets.

    A session variable holds the arrays, packed, and a plan names packed arrays in a few characters.
    Parsed in the plan they are spelled out: megabytes in the description of each plan that holds
    them, written again with each change of the plan, and the driver keeps those of many past queries.
    """
    tables, size, n_buckets = _pair_table(path)
    name = f"system.session.changeloom_{hashlib.md5(path.encode()).hexdigest()}"
    with _DECLARING:
        try:
            spark.sql(f"DECLARE VARIABLE {name} ARRAY<ARRAY<BIGINT>>")
        except AnalysisException as there:
            if there.getCondition() != "VARIABLE_ALREADY_EXISTS":
                raise
        else:
            try:
                spark.sql(f"SET VARIABLE {name} = from_json(:tables, 'array<array<bigint>>')", {"tables": tables})
            except BaseException:
                spark.sql(f"DROP TEMPORARY VARIABLE {name}")
                raise
    return F.expr(name), size, n_buckets


def _let(value: Column, then) -> Column:
    return F.transform(F.array(value), then)[0]


def fold_merges(word: Column, path: str, spark: SparkSession | None = None) -> Column:
    """Ids (array<bigint>) of one word given as an array of its bytes (bigints 0 to 255), at most 2^8 of them,
    for data frames of `spark` (or the active session)."""
    # constants: taken apart once, when the plan is optimised
    tables, size, n_buckets = _tables(path, spark or SparkSession.active())
    table, move, of_bytes, of_byte = (tables[k] for k in range(4))
    edge = lambda place: F.lit(_NONE | place << _PLACE | _EDGE)

    def first(byte: Column, place: Column) -> Column:
        pair = of_bytes[byte * 257 + F.coalesce(F.get(word, place + 1), F.lit(256))]
        return F.shiftleft(pair, _RANK).bitwiseXOR(F.shiftleft(place.cast("bigint"), _PLACE)).bitwiseXOR(of_byte[byte])

    def ranked(part: Column, after: Column) -> Column:
        """`part`'s place and id with the rank of its pair with `after`; an entry of another pair differs above the rank."""
        a, b, low = part.bitwiseAND(_ID), after.bitwiseAND(_ID), part.bitwiseAND(_LOW)
        at = (a * _MIX_A + b * _MIX_B).bitwiseAND(size - 1).bitwiseXOR(move[(low * _MIX_LOW + b).bitwiseAND(n_buckets - 1)])
        return table[at].bitwiseXOR(F.shiftleft(low, _LOW_ID)).bitwiseXOR(F.shiftleft(b, _NEXT)).bitwiseXOR(part.bitwiseAND(_OWN))

    def joined(parts: Column, at: Column) -> Column:
        """Part `at` with the next one; its pairs with its neighbours are the only new ones."""
        before, least, after = F.get(parts, at - 1), F.get(parts, at), F.get(parts, at + 1)
        # the joined part has the place of its first one, and the rank is its id
        whole = least.bitwiseAND(_OWN - _ID).bitwiseXOR(F.shiftright(least, _RANK))
        changed = F.zip_with(F.array(whole, before), F.array(F.get(parts, at + 2), whole), ranked)
        rest = F.array_remove(F.array_remove(F.array_remove(parts, after), least), before)
        return F.aggregate(changed, rest, lambda all_, part: F.array_insert(all_, at, part))

    def step(parts: Column, _: Column) -> Column:
        """The leftmost pair of least rank joined; where no pair has a rank, the same parts."""
        place = F.array_position(parts, F.array_min(parts)).cast("int") - 1
        return F.when(F.array_min(parts) < _NONE, _let(place, lambda at: joined(parts, at))).otherwise(parts)

    parts = F.array_append(F.array_prepend(F.transform(word, first), edge(0)), edge(255))
    folded = F.aggregate(F.sequence(F.lit(2), F.greatest(F.size(word), F.lit(2))), parts, step)
    return F.transform(F.filter(folded, lambda part: part.bitwiseAND(_ID) != _EDGE), lambda part: part.bitwiseAND(_ID) - 1)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a word of any length, in n log n steps."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))  # where the piece that starts here ends; 0 if merged away
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, j, stop = heapq.heappop(heap)
        if end[i] != j or j >= n or end[j] != stop:
            continue  # one of the two has changed since
        end[i], end[j] = stop, 0
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a in (before[i], i):
            if a >= 0 and (b := after[a]) < n and (r := ranks.get(word[a : end[b]])) is not None:
                heapq.heappush(heap, (r, a, b, end[b]))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def found_words(texts: pa.Array, find, held_words: int = HELD_WORDS) -> tuple[pa.ChunkedArray, np.ndarray]:
    """The matches of all texts (null: empty), one after another, and how many each text has.

    Arrow counts and numbers them in less time and memory than a dict of strings takes; about
    `held_words` at a time are Python's."""
    chunks, held, sizes = [], [], []
    for text in texts:
        words = find(text.as_py() or "")
        sizes.append(len(words))
        held += words
        if len(held) >= held_words:
            chunks.append(pa.array(held, pa.string()))
            held = []
    chunks.append(pa.array(held, pa.string()))
    return pa.chunked_array(chunks), np.array(sizes, np.int64)


def numbered(words: pa.ChunkedArray) -> tuple[np.ndarray, list[bytes]]:
    """Each word's number, and the distinct words in order of their numbers, which is that of first sight."""
    if not len(words):
        return np.empty(0, np.int32), []  # no chunk, no dictionary
    coded = words.dictionary_encode().unify_dictionaries()
    return np.concatenate([c.indices.to_numpy() for c in coded.chunks]), coded.chunk(0).dictionary.cast(pa.binary()).to_pylist()


def word_counts(docs: DataFrame, text_col: str = "text", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """word, n: all distinct words of all texts. Counted in the tasks that read them before they move."""
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter("text is not null")

    def run(batches):
        find = splitter(pattern)
        for batch in common.gathered(batches, SLICE_BYTES):
            for part in common.slices(batch, "text", SLICE_BYTES):
                seen = found_words(part.column("text"), find)[0].value_counts()
                yield pa.RecordBatch.from_arrays([seen.field("values"), seen.field("counts")], ["word", "n"])
                del seen
                common.release_memory()

    return texts.mapInArrow(common.tidy(run), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def bytes_of(word: Column) -> Column:
    """A word's UTF-8 bytes as an array of bigints."""
    return F.transform(F.regexp_extract_all(F.hex(word.cast("binary")), F.lit(".."), F.lit(0)), lambda x: F.conv(x, 16, 10).cast("bigint"))


def _word_hash(word: bytes) -> int:
    """What xxhash64(word) gives, unsigned."""
    return xxhash.xxh64_intdigest(word, seed=42)


class HotWords:
    """Ids of a bounded number of words in flat arrays: found by hash, confirmed by bytes."""

    def __init__(self, words: list[bytes], ids: list[list[int]]):
        hashes = np.array([_word_hash(w) for w in words], np.uint64)
        # in order of hashes; of words with one hash the first stays, the others are folded where they occur
        self.hashes, order = np.unique(hashes, return_index=True)
        kept, kept_ids = [words[k] for k in order.tolist()], [ids[k] for k in order.tolist()]
        self.bytes = b"".join(kept)
        self.byte_starts = np.cumsum([0, *map(len, kept)]).astype(np.int32)
        self.ids = np.array([i for own in kept_ids for i in own], np.uint16)  # all are below _EDGE
        self.id_starts = np.cumsum([0, *map(len, kept_ids)]).astype(np.int32)

    @classmethod
    def joined(cls, parts: list[HotWords]) -> HotWords:
        """One table of parts whose hashes follow one another."""
        out = cls([], [])
        if parts:
            out.hashes, out.ids = np.concatenate([p.hashes for p in parts]), np.concatenate([p.ids for p in parts])
            out.bytes = b"".join(p.bytes for p in parts)
            for name in ("byte_starts", "id_starts"):
                ends = [getattr(p, name) for p in parts]
                shifts = np.cumsum([0, *(int(e[-1]) for e in ends)])
                setattr(out, name, np.concatenate([np.zeros(1, np.int32), *((e[1:] + s).astype(np.int32) for e, s in zip(ends, shifts, strict=False))]))
        return out

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, or -1."""
        if not len(self.hashes) or not words:
            return np.full(len(words), -1)
        hashes = np.fromiter(map(_word_hash, words), np.uint64, len(words))
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        at = np.where(self.hashes[place] == hashes, place, -1)
        begin, end, held = self.byte_starts[at].tolist(), self.byte_starts[at + 1].tolist(), self.bytes
        for k in np.flatnonzero(at >= 0).tolist():
            if held[begin[k] : end[k]] != words[k]:
                at[k] = -1
        return at


def hot_words(counts: DataFrame, path: str, most: int = HOT_WORDS, least_count: int = HOT_COUNT) -> HotWords:
    """The most frequent words, folded; `most` at most, each at least `least_count` times in the
    corpus. Where equal frequencies would pass the bound they are left out, all of them: such
    words are folded where they occur.

    Tasks lay them out in arrays, by ranges of their hash; the driver joins these and passes them on."""
    short = counts.filter((F.octet_length("word") <= HOT_BYTES) & (F.col("n") >= least_count))
    level = F.floor(F.log2(F.col("n").cast("double")) * 16)
    left, least = most, None
    for row in short.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        left -= row["count"]
        if left < 0:
            break
        least = row["level"]
    if least is None:
        return HotWords([], [])

    def lay_out(batches):
        found: dict[int, list[tuple[bytes, list[int]]]] = {}
        for batch in batches:
            for part, word, ids in zip(*(batch.column(c).to_pylist() for c in ("part", "word", "ids")), strict=True):
                found.setdefault(part, []).append((word.encode(), ids))
        for part, own in found.items():
            made = pickle.dumps(HotWords(*map(list, zip(*sorted(own), strict=True))), pickle.HIGHEST_PROTOCOL)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([made], pa.binary())], ["part", "made"])

    chosen = short.filter(level >= least).select("word", fold_merges(bytes_of(F.col("word")), path, counts.sparkSession).cast("array<int>").alias("ids"))
    chosen = chosen.withColumn("part", F.shiftrightunsigned(F.xxhash64("word"), 64 - HOT_PARTS.bit_length() + 1).cast("int"))
    parts = chosen.repartition(HOT_PARTS, "part").mapInArrow(common.tidy(lay_out), "part int, made binary").toArrow().sort_by("part")
    return HotWords.joined([pickle.loads(made.as_buffer()) for made in parts.column("made")])


class _Pieces:
    """The bytes of all tokens in one array, by id."""

    _made: tuple[int, _Pieces] | None = None

    def __init__(self, ranks: dict[bytes, int]):
        by_id = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            by_id[rank] = piece
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.sizes = np.array([len(p) for p in by_id], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> _Pieces:
        """Made once a process."""
        if cls._made is None or cls._made[0] != id(ranks):
            cls._made = id(ranks), cls(ranks)
        return cls._made[1]


def _runs(number: np.ndarray, source: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of `source` that the numbers name, one after another."""
    length = sizes[number]
    ends = np.cumsum(length)
    return source[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[number] - (ends - length), length)]


def encode(docs: DataFrame, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text", vocabulary: str | None = None, pattern: str = public_tokenizers.PATTERN, outputs: tuple[str, ...] = ("ids", "packed")) -> DataFrame:
    """`id_cols` and `outputs`: ids (array<int>), packed (the ids as little-endian unsigned
    32-bit integers), decoded (the bytes that the ids stand for)."""
    spark = docs.sparkSession
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    if spark.conf.get("spark.sql.maxPlanStringLength", None) is None:
        spark.conf.set("spark.sql.maxPlanStringLength", PLAN_CHARS)
    common.bound_batches(spark)
    common.drop_unused(spark)
    common.collect_executors(spark)
    counts = common.materialize(word_counts(docs, text_col, pattern), "bpe-words")
    hot = spark.sparkContext.broadcast(hot_words(counts, path))
    common.drop_unused(spark)  # the driver needs the words no longer
    # the long words' merges need the ranks on the executors: a bounded table, as the rank map is
    ranks = spark.sparkContext.broadcast(load_ranks(path))
    docs = docs.select(*(F.col(c) for c in id_cols), F.col(text_col).cast("string").alias("__text"))
    kinds = "".join(f"`{c}` {t}, " for c, t in docs.drop("__text").dtypes)
    id_fields = [f.dataType for f in docs.drop("__text").schema]

    def split(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        find, table = splitter(pattern), hot.value
        nulls = lambda n: [pa.nulls(n, to_arrow_type(t)) for t in id_fields]
        of_words = pa.list_(pa.list_(pa.int64()))
        names = [*id_cols, "known", "words", "long"]

        def rows(part):
            """A function, so that nothing of a slice outlives it."""
            words, held = found_words(part.column("__text"), find)
            number, raw = numbered(words)
            del words
            told = np.split(number, np.cumsum(held))[:-1]
            at = table.find(raw)
            # hot words give their ids, the k-th other word gives -1-k until it is folded
            other = np.flatnonzero(at < 0)
            begin = table.id_starts[at].astype(np.int64)
            sizes = table.id_starts[np.minimum(at + 1, len(table.hashes))] - begin
            source = np.concatenate([table.ids, -1 - np.arange(len(other), dtype=np.int32)]).astype(np.int32)
            begin[other], sizes[other] = len(table.ids) + np.arange(len(other)), 1
            tail = [raw[k] for k in other.tolist()]
            # the slice's words go first, in rows of their own; the first of them starts the slice
            for k in range(0, max(len(tail), 1), TAIL_ROW):
                run = tail[k : k + TAIL_ROW]
                short = [w if len(w) <= LONG else b"" for w in run]
                flat = pa.array(np.frombuffer(b"".join(short), np.uint8).astype(np.int64))
                inner = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(w) for w in short])]).astype(np.int32)), flat)
                words_row = pa.ListArray.from_arrays(pa.array([0, len(run)], pa.int32()), inner)
                long = pa.array([[w if len(w) > LONG else None for w in run]], pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([*nulls(1), pa.array([b"more" if k else b"first"], pa.binary()), words_row.cast(of_words), long], names)
            known = pa.array([_runs(n, source, begin, sizes).tobytes() for n in told], pa.binary())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in id_cols), known, pa.nulls(len(told), of_words), pa.nulls(len(told), pa.list_(pa.binary()))], names)

        for batch in common.gathered(batches, SLICE_BYTES):
            for part in common.slices(batch, "__text", SLICE_BYTES):
                yield from rows(part)
                common.release_memory()

    def join(batches):
        folded: list[np.ndarray] = []  # pairs of ids and sizes, row by row of words
        source = sizes = starts = np.empty(0, np.int64)
        stale = False
        for batch in batches:
            is_doc = np.asarray(batch.column("words").is_null())
            # runs of rows of words and of documents, in order
            cuts = [0, *(np.flatnonzero(np.diff(is_doc)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if not is_doc[a]:
                    for k in range(a, b):
                        row = batch.slice(k, 1)
                        if row.column("known")[0].as_py() == b"first":
                            folded = []
                        folded.append(_folded(row.column("words"), row.column("long"), ranks.value))
                    stale = True
                    continue
                if stale:
                    source = np.concatenate([ids for ids, _ in folded])
                    sizes = np.concatenate([n for _, n in folded])
                    starts = np.cumsum(sizes) - sizes
                    folded, stale = [], False
                for part in common.slices(batch.slice(a, b - a), "known", SLICE_BYTES):
                    yield finished(part, source, sizes, starts)
                    common.release_memory()

    def finished(part, source, sizes, starts):
        each = [_place(np.frombuffer(ids.as_buffer(), np.int32), source, sizes, starts) for ids in part.column("known")]
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in id_cols), *(made[o](each) for o in outputs)], [*id_cols, *outputs])

    def as_lists(each: list[np.ndarray]) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in each])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(each).astype(np.int32, copy=False)))

    def as_bytes(each: list[np.ndarray]) -> pa.Array:
        return pa.array([p.astype("<u4", copy=False).tobytes() for p in each], pa.binary())

    def as_decoded(each: list[np.ndarray]) -> pa.Array:
        pieces = _Pieces.of(ranks.value)
        return pa.array([_runs(p, pieces.bytes, pieces.starts, pieces.sizes).tobytes() for p in each], pa.binary())

    made = {"ids": as_lists, "packed": as_bytes, "decoded": as_decoded}
    spelled = {"ids": "ids array<int>", "packed": "packed binary", "decoded": "decoded binary"}
    rows = docs.mapInArrow(common.tidy(split), f"{kinds}known binary, words array<array<bigint>>, long array<binary>")
    rows = rows.withColumn("words", F.transform("words", lambda w: fold_merges(w, path, spark)))
    common.drop_unused(spark)  # nor what spelling and analysing the rank map left
    common.collect_executors(spark)  # the encoding job has two Python workers a core
    return rows.mapInArrow(common.tidy(join), kinds + ", ".join(spelled[o] for o in outputs))


def _folded(words: pa.Array, long: pa.Array, ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a row's words, one after another, and how many each has."""
    inner = words.flatten()
    sizes = np.diff(inner.offsets.to_numpy()).astype(np.int64)
    ids = inner.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    given = long.flatten()
    if given.null_count < len(given):
        each = np.split(ids, np.cumsum(sizes)[:-1])
        each = [e if w is None else np.array(merge_long(w, ranks), np.int32) for e, w in zip(each, given.to_pylist(), strict=True)]
        ids, sizes = np.concatenate(each), np.array([len(e) for e in each], np.int64)
    return ids, sizes


def _place(known: np.ndarray, source: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """`known` with each negative -1-k replaced by the k-th run of `source`."""
    gap = known < 0
    if not gap.any():
        return known
    which = -1 - known[gap]
    length = np.ones(len(known), np.int64)
    length[gap] = sizes[which]
    out = np.repeat(known, length)
    out[np.repeat(gap, length)] = _runs(which, source, starts, sizes)
    return out


def decode(ids: Column, vocabulary: str | None = None) -> Column:
    """The bytes of an array of ids: its pieces concatenated."""
    ranks = load_ranks(vocabulary or public_tokenizers.path(VOCABULARY))
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    # a literal array: the split of a constant is a constant
    table = F.split(F.lit(",".join(pieces)), ",")
    known = (F.size(ids) == 0) | ((F.array_min(ids) >= 0) & (F.array_max(ids) < len(pieces)))
    return F.when(known, F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")))


def digests(docs: DataFrame, id_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    return encode(docs, id_cols, outputs=("packed", "decoded")).select(
        *(F.col(c) for c in id_cols),
        (F.octet_length("packed") / 4).cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: every whole text encoded, and decoded again."""
    return digests(common.read_table(spark, sf_dir, "documents"))
