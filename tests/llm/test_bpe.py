import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeloom.llm import bpe

RANKS = bpe.load_ranks(P.path(bpe.VOCABULARY))
OWN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"ids": F.lit("clash"), "tail": F.lit(1)})
    out = bpe.encode(df, outputs=("ids", "packed", "decoded")).withColumn("again", bpe.decode(F.col("ids"))).collect()
    assert len(out) == len(texts)
    for r in out:
        text = texts[r.doc_id] or ""
        want = OWN.encode_ordinary(text)
        assert r.ids == want, text
        assert bytes(r.packed) == b"".join(i.to_bytes(4, "little") for i in want)
        assert bytes(r.decoded) == bytes(r.again) == text.encode()


def test_against_tiktoken(spark):
    rng = random.Random(0)
    letters = "abcdefgeiou éßñ日本𝄞'’\n\t 　 .,!?#0123٣"
    texts = [None, "", " ", "\n\n  x", "<|endoftext|>", "it's we'll IT'S", "a" * 255, "a" * 256, "ab" * 3000, "日" * 400, "!" * 700]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 300))) for _ in range(60)]
    check(spark, texts)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=60), min_size=20, max_size=40))
def test_any_text(spark, texts):
    check(spark, texts)


@pytest.mark.parametrize("seed", range(3))
def test_long_words_have_the_same_merges(seed):
    rng = random.Random(seed)
    word = "".join(rng.choice("etaoin") for _ in range(2000))
    assert bpe.merge_long(word.encode(), RANKS) == OWN.encode_ordinary(word)


def test_query_against_tiktoken(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    out = bpe.query(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == len(docs)
    for r in out:
        ids = OWN.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_hot_words_are_bounded_and_exact(spark):
    docs = spark.createDataFrame([(i, "the cat sat on the mat") for i in range(3)], "doc_id long, text string")
    counts = bpe.word_counts(docs)
    assert {r.word: r.n for r in counts.collect()} == {"the": 3, " cat": 3, " sat": 3, " on": 3, " the": 3, " mat": 3}
    path = P.path(bpe.VOCABULARY)
    assert len(bpe.hot_words(counts, path, most=5, least_count=1).hashes) == 0
    assert len(bpe.hot_words(counts, path, most=9).hashes) == 0  # three places are too few
    hot = bpe.hot_words(counts, path, most=6, least_count=3)
    words = [b"the", b" cat", b" dog", b" sat", b" on", b" the", b" mat"]
    at = hot.find(words)
    assert (at >= 0).tolist() == [w != b" dog" for w in words]
    for w, k in zip(words, at, strict=True):
        if k >= 0:
            assert hot.ids[hot.id_starts[k] : hot.id_starts[k + 1]].tolist() == OWN.encode_ordinary(w.decode())


def test_very_long_texts_and_repeated_rows(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 12))) for _ in range(5000)]
    long = " ".join(rng.choice(words) for _ in range(250_000))
    docs = spark.createDataFrame([(1, long), (1, long), (2, "e" * 30_000), (None, "same"), (None, "same"), (None, None)], "doc_id long, text string")
    out = bpe.digests(docs).collect()
    ids = lambda text: hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in OWN.encode_ordinary(text))).hexdigest()
    want = [(1, ids(long), long), (1, ids(long), long), (2, ids("e" * 30_000), "e" * 30_000), (None, ids("same"), "same"), (None, ids("same"), "same"), (None, ids(""), "")]
    spell = lambda rows: sorted((str(a), b, c) for a, b, c in rows)
    assert spell((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in out) == spell((i, a, hashlib.sha256(t.encode()).hexdigest()) for i, a, t in want)


def test_empty_table_and_unknown_ids(spark):
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert spark.createDataFrame([([1, 99_999],)], "ids array<int>").select(bpe.decode(F.col("ids")).alias("d")).first().d is None


def test_more_words_than_a_row_holds(spark):
    texts = [f"zq{i}x jkwv{i * 7919} {'y' * (i % 90)}" for i in range(3000)]
    check(spark, texts)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=255), st.sampled_from(" \n\t'srtvmld\x1c\x85\xa0\xb2\xbc")), max_size=40))
def test_spelled_out_classes_split_alike(text):
    import regex

    assert bpe.splitter(P.PATTERN)(text) == regex.findall(P.PATTERN, text)


def test_all_near_characters_split_alike():
    import regex

    split = bpe.splitter(P.PATTERN)
    for i in range(256):
        for text in (chr(i), f"a{chr(i)}b", f" {chr(i)}{chr(i)} 1", f"{chr(i)} {chr(i)}\n{chr(i)}x"):
            assert split(text) == regex.findall(P.PATTERN, text), repr(text)
    assert split("日本 a") == regex.findall(P.PATTERN, "日本 a")


def test_a_step_keeps_ranks_and_copies_no_slices(spark):
    path = P.path(bpe.VOCABULARY)
    rng = random.Random(9)
    words = ["".join(rng.choice("aaabe éñ日!") for _ in range(rng.randrange(1, 60))).encode()[:256].decode(errors="ignore") or "x" for _ in range(300)]
    words += ["a" * n for n in range(1, 257, 5)] + ["ab" * n for n in range(1, 129, 9)]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    folded = df.select("word", bpe.fold_merges(bpe.bytes_of(F.col("word")), path).alias("ids"))
    assert all(r.ids == bpe.merge_long(r.word.encode(), RANKS) for r in folded.collect())
    plan = folded._jdf.queryExecution().analyzed().toString()
    assert "slice(" not in plan and "concat(" not in plan  # they took most of a fold's time


def test_small_batches_share_a_slice():
    import pyarrow as pa

    from changeloom.llm import common

    batches = [pa.RecordBatch.from_arrays([pa.array(["x" * 100] * n, pa.string())], ["t"]) for n in (3, 0, 5, 50, 2, 2)]
    out = list(common.gathered(iter(batches), 2000))
    assert [b.num_rows for b in out] == [8, 50, 4]
    assert list(common.gathered(iter([]), 10)) == []


def test_words_are_numbered_and_counted_across_chunks(spark):
    import pyarrow as pa

    find = bpe.splitter(P.PATTERN)
    texts = ["the cat", None, "", " the cat\n日本 the", "cat the cat", "the"]
    for held in (1, 3, 100):
        words, sizes = bpe.found_words(pa.array(texts, pa.string()), find, held)
        spelled = [w for t in texts for w in find(t or "")]
        assert words.to_pylist() == spelled and sizes.tolist() == [len(find(t or "")) for t in texts]
        number, distinct = bpe.numbered(words)
        assert [distinct[k].decode() for k in number.tolist()] == spelled
        assert distinct == [w.encode() for w in dict.fromkeys(spelled)]
    for none in ([], [None, ""]):
        words, sizes = bpe.found_words(pa.array(none, pa.string()), find)
        assert [len(x) for x in (*bpe.numbered(words), sizes)] == [0, 0, len(none)]


def test_the_frequent_word_table_holds_words_of_middling_frequency(spark):
    # 300,000 words of 4 places each: a table of 2^18 words would leave all of them out
    docs = spark.range(300_000).selectExpr("id as doc_id", "concat_ws(' ', array_repeat(concat('w', translate(id, '0123456789', 'abcdefghij')), 5)) as text")
    hot = bpe.hot_words(bpe.word_counts(docs), P.path(bpe.VOCABULARY))
    assert len(hot.hashes) == 300_000
    k = int(hot.find([b" wbcdef"])[0])
    assert hot.ids[hot.id_starts[k] : hot.id_starts[k + 1]].tolist() == OWN.encode_ordinary(" wbcdef")


def test_executors_give_heap_back_before_the_encoding_job(spark, monkeypatch):
    from changeloom.llm import common

    runs = lambda: sum(b.getCollectionCount() for b in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans())
    before, cores = runs(), spark.sparkContext.defaultParallelism
    common.collect_executors(spark)
    assert runs() >= before + cores
    told = []
    monkeypatch.setattr(common, "collect_executors", lambda _: told.append("executors"))
    monkeypatch.setattr(common, "materialize", lambda df, label: told.append(label) or df)
    bpe.encode(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert told == ["executors", "bpe-words", "executors"]


def test_plans_do_not_spell_the_rank_map_out(spark):
    path = P.path(bpe.VOCABULARY)
    for session in (spark, spark.newSession(), spark):  # the map belongs to a session, and is there once
        df = session.createDataFrame([("tokenizer",), ("日本",)], "word string")
        folded = df.select("word", bpe.fold_merges(bpe.bytes_of(F.col("word")), path, session).alias("ids"))
        assert {r.word: r.ids for r in folded.collect()} == {w: OWN.encode_ordinary(w) for w in ("tokenizer", "日本")}
        run = folded._jdf.queryExecution()
        assert all(len(plan.simpleString(1000)) < 20_000 for plan in (run.analyzed(), run.optimizedPlan()))
