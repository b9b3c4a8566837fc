"""The pipeline against plain versions of its stages."""

import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken

import corpus_pipeline as P
from changeloom.llm import bpe, common, quality, toxicity

DATA = "/root/testdata/sf0.001"


def shingle_set(text):
    w = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "quality", "near_duplicates", "mixing", "tokenize"]
    held = {"start": docs}
    for name, stage in P.STAGES:
        held[name] = docs = common.materialize(stage(spark, docs, DATA), name)
    assert all(held[n].columns == held["start"].columns for n in names[:-1])
    rows = {n: held[n].collect() for n in held}
    ids = {n: {r.doc_id for r in rows[n]} for n in rows}

    scorer = toxicity.Scorer(toxicity.fit(held["start"], labels))
    assert ids["toxicity"] == {r.doc_id for r in rows["start"] if scorer.score(r.text) < 0.7}
    model, tokens = quality.fit(held["toxicity"], labels), quality.Tokens()
    assert ids["quality"] == {r.doc_id for r in rows["toxicity"] if quality.score_texts(model, [r.text], tokens)[0] >= 0.3}

    sets = {r.doc_id: shingle_set(r.text) for r in rows["quality"]}
    near = defaultdict(set)
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a != b and sets[a] and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                near[a].add(b)
    kept, seen = set(), set()
    for a in sorted(sets):
        if a not in seen:
            kept.add(a)
            todo = [a]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += near[x]
    assert ids["near_duplicates"] == kept

    size = {r.doc_id: len(r.text.split()) for r in rows["near_duplicates"]}
    copies = Counter(r.doc_id for r in rows["mixing"])
    assert max(copies.values()) <= 3 and copies.keys() <= kept
    assert abs(sum(size[i] * n for i, n in copies.items()) - sum(size.values())) <= 20 * max(size.values())

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY)), special_tokens={})
    text = {r.doc_id: r.text for r in rows["mixing"]}
    assert Counter(r.doc_id for r in rows["tokenize"]) == copies
    for r in rows["tokenize"]:
        assert r.n_tokens == len(own.encode_ordinary(text[r.doc_id]))
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_nulls_repeats_extra_columns_and_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(None, None, None, None, None), (7, "", None, None, 0), (8, "x", "en", None, 1), (8, "x", "en", None, 1), (9, "a very long text of plain words " * 40_000, "en", "s", 9)], docs.schema)
    for start in (docs.unionByName(odd).selectExpr("*", "1 AS score", "2 AS row"), docs.limit(0)):
        stage_docs = start
        for name, stage in P.STAGES:
            stage_docs = common.materialize(stage(spark, stage_docs, DATA), f"odd-{name}")
            if name != "tokenize":
                assert stage_docs.columns == start.columns
        stage_docs.count()


def test_batches_are_bounded_and_cut_points_let_go(spark, monkeypatch):
    from changeloom.llm import jaccard

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.range(0, 5000, 1, 1).selectExpr("id AS doc_id", "concat('some plain words of text number ', id) AS text")
    most = []

    def keep(texts):
        assert len(texts) <= 2000
        return [True] * len(texts)

    spark.conf.unset(name)
    assert common.keep_rows(docs, "text", lambda: keep).count() == 5000
    spark.conf.set(name, "700")  # a number that the session names stays
    common.bound_batches(spark)
    assert spark.conf.get(name) == "700"
    spark.conf.unset(name)

    let_go = common.drop_unused
    monkeypatch.setattr(common, "drop_unused", lambda s: most.append(let_go(s)))
    cuts = []
    written = common.materialize
    monkeypatch.setattr(common, "materialize", lambda df, label: cuts.append(label) or written(df, label))
    assert jaccard.classes(docs.limit(20)).count() == 20
    assert cuts and len(most) > len(cuts)


def test_the_driver_gives_native_memory_back(spark, monkeypatch):
    assert "Trim native heap" in common.trim_driver(spark)
    told = []
    monkeypatch.setattr(common, "trim_driver", told.append)
    common.drop_unused(spark)
    assert told == [spark]
