import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeloom.llm import jaccard as J

SCHEMA = "doc_id long, text string"


def shingle_set(text):
    w = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(rows):
    """(class id, links) of each row, by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    near = defaultdict(set)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                near[i].add(j)
                near[j].add(i)
    label = {}
    for i in range(len(rows)):
        if i not in label:
            todo, own = [i], {i}
            while todo:
                for k in near[todo.pop()] - own:
                    own.add(k)
                    todo.append(k)
            ids = [rows[k][0] for k in own if rows[k][0] is not None]
            label |= {k: min(ids, default=None) for k in own}
    return sorted(((rows[i][0], label[i], len(near[i])) for i in range(len(rows))), key=repr)


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"node": F.lit("clash"), "key": F.lit(1), "row": F.lit(2), "signature": F.lit(None)})
    return sorted(((r.id, r.class_id, r.n_links) for r in J.classes(df).collect()), key=repr)


def mutated(rng, words, vocabulary, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return words


def test_against_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, chain = [], [rng.choice(vocabulary) for _ in range(120)]
    for i in range(40):  # a chain: neighbours are near, ends are not
        rows.append((i, " ".join(chain)))
        chain = mutated(rng, chain, vocabulary, 2)
    for g in range(8):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((4, 9, 30, 200)))]
        rows += [(100 + 10 * g + k, " ".join(mutated(rng, base, vocabulary, k // 3))) for k in range(9)]
    rows += [(500 + i, "Same   TEXT, here; one two three") for i in range(6)] + [(600, "same text here one two three!")]
    assert got(spark, rows) == brute(rows)


def test_nulls_ties_short_and_repeated_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "..."), (None, "a b c d e f g"), (None, "a b c d e f g"), (4, "a b c d e f g"), (5, "x"), (6, "X"), (7, "x y"), (8, "y x"),
        (9, "one two three four five six"), (9, "one two three four five six"), (9, "another text of the same id altogether"), (10, "long " * 300_000),
    ]
    assert got(spark, rows) == brute(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert J.classes(empty).count() == 0 and J.deduplicate(empty).count() == 0


def test_blocks_cover_all_pairs(spark, monkeypatch):
    """A group over several blocks gives the links that it gives in one."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(50)}" for _ in range(60)]
    texts = [" ".join(mutated(rng, base, [f"v{i}" for i in range(30)], rng.randrange(4))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    monkeypatch.setattr(J, "BUCKET_BLOCK", 7)
    monkeypatch.setattr(J, "NODE_BLOCK", 9)
    assert got(spark, rows) == brute(rows)


def test_deduplicate_keeps_one_of_each_class(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f!"), (1, "a b c d e f"), (5, None), (5, None), (6, ""), (7, "other words stand here alone now")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit(0))
    assert sorted(((r.doc_id, r.text) for r in J.deduplicate(df).collect()), key=repr) == sorted([(1, "a b c d e f"), (5, None), (5, None), (6, ""), (7, "other words stand here alone now")], key=repr)


def test_hot_copies_and_rows_without_words(spark, monkeypatch):
    rows = [(i, "a copy that a third of all rows hold") for i in range(40)] + [(100 + i, None if i % 2 else " . ") for i in range(40)]
    rows += [(200 + i, f"text {i} has words of its own {i * 7} and so on {i * 13}") for i in range(40)]
    assert got(spark, rows) == brute(rows)
    monkeypatch.setattr(J, "HOT_SHARE", 10)
    monkeypatch.setattr(J, "SALTS", 3)
    assert got(spark, rows) == brute(rows)


def test_columns_of_any_name_pass(spark):
    names = ("__jaccard_row", "__jaccard_kept", "row", "kept", "whole", "worded", "id", "node", "key")
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], SCHEMA).withColumns({n: F.lit(k) for k, n in enumerate(names)})
    kept = J.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, *(r[n] for n in names)) for r in kept.collect()) == [(1, *range(len(names))), (3, *range(len(names)))]


def test_pruning_keeps_pairs_at_the_threshold():
    """Of pairs with similarity 0.8 less than one in a thousand is dropped, of dissimilar ones nearly all are."""
    rng = np.random.default_rng(0)
    for similarity, low, high in ((0.8, 0.999, 1.0), (0.3, 0.0, 0.01)):
        a = rng.integers(0, 1 << 32, (3000, J.HASHES), np.uint64).astype(np.uint32)
        b = np.where(rng.random(a.shape) < similarity, a, a + np.uint32(1))
        i, _ = J.surviving(np.concatenate([a, b]), np.arange(3000), np.arange(3000, 6000))
        assert low <= len(i) / 3000 <= high


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        pool = np.unique(rng.integers(0, 1 << 63, 4000, np.uint64))
        common = pool[: int(1000 * share)]
        a = np.unique(np.concatenate([common, pool[1000 : 2000 - len(common)]]))
        b = np.unique(np.concatenate([common, pool[2000 : 3000 - len(common)]]))
        want = len(common) / (len(a) + len(b) - len(common))
        assert abs((J.minhash(a) == J.minhash(b)).mean() - want) < 0.15


@pytest.mark.parametrize("sizes", [[5], [1, 1, 1], [3, 4, 2, 6], [0, 2]])
def test_groups_span_batches(sizes):
    keys = [k for k, n in enumerate([2, 1, 7, 1, 4]) for _ in range(n)]
    table = pa.table({"k": keys[: sum(sizes)]})
    batches, at = [], 0
    for n in sizes:
        batches += table.slice(at, n).to_batches() or [pa.RecordBatch.from_pydict({"k": pa.array([], pa.int64())})]
        at += n
    found = [g.column("k").to_pylist() for g in J._groups(batches, ("k",))]
    assert [k for g in found for k in g] == keys[: sum(sizes)] and len(found) == len(set(keys[: sum(sizes)]))


def test_likely_keeps_all_wanted(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("h"), "id")
    wanted = rows.filter("id % 100 = 0").select("h")
    kept = {r.id for r in J.likely(rows, wanted, "h").collect()}
    assert {i for i in range(0, 5000, 100)} <= kept and len(kept) < 60
    assert J.likely(rows, wanted.limit(0), "h").count() == 0
