"""Held-out accuracy of the trained operators, and their edge cases."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeloom.llm import common, langid, quality, toxicity

DATA = "/root/testdata/sf0.01"
HARD = [None, "", " \n", "...", "é𝄞", "x" * 200_000, "wort " * 100_000, "same", "same"]


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    y = np.asarray(y)
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def hard_rows(spark):
    return spark.createDataFrame([(i if i != 3 else None, t) for i, t in enumerate(HARD)], "doc_id long, text string").withColumns({"score": F.lit("clash"), "__text2": F.lit(1)})


def labelled(spark, column, modulus, held_out):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    return {i: y for i, y in labels.items() if (zlib.crc32(str(i).encode()) % modulus == held_out)}


def test_quality_on_the_held_out_fold(spark):
    rows = quality.query(spark, DATA).collect()
    truth = labelled(spark, "quality", 5, 0)
    scored = [(truth[r.doc_id], r.score, r.predicted) for r in rows if r.doc_id in truth]
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert auc([y for y, _, _ in scored], [s for _, s, _ in scored]) > 0.97
    assert np.mean([y == p for y, _, p in scored]) > 0.93


def test_toxicity_on_the_held_out_fold(spark):
    rows = toxicity.query(spark, DATA).collect()
    truth = labelled(spark, "toxic", 3, 1)
    scored = [(truth[r.doc_id], r.score, r.predicted) for r in rows if r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in rows)
    assert auc([y for y, _, _ in scored], [s for _, s, _ in scored]) > 0.8
    assert np.mean([p for y, _, p in scored if y == 0]) < 0.03


def test_language_on_the_held_out_fold(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = langid.query(spark, DATA).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_code_switched_text(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labeller = langid.Labeller(langid.fit(docs))
    by = {r.lang: r.text for r in docs.filter("length(text) > 2000").dropDuplicates(["lang"]).collect()}
    en, de = (" ".join(langid.words_of(by[k])[100:160]) for k in ("en", "de"))
    lang, score, runs = labeller.label([f"{en} {de} {de}"])[0]
    right = sum(min(r["last"], 59) - r["first"] + 1 for r in runs if r["lang"] == "en" and r["first"] < 60)
    assert lang == "de" and 0.4 < score < 0.9 and right > 50
    assert labeller.label([None, "", "12 .", "é"])[:3] == [("und", 0.0, [])] * 3


def plain_chain(scores, start, step):
    """Forward-backward over one whole chain, word by word."""
    psi = np.exp(scores)
    ahead, back = np.empty_like(psi), np.ones_like(psi)
    ahead[0] = start * psi[0] / (start * psi[0]).sum()
    for t in range(1, len(psi)):
        ahead[t] = (ahead[t - 1] @ step) * psi[t]
        ahead[t] /= ahead[t].sum()
    for t in range(len(psi) - 2, -1, -1):
        back[t] = step @ (psi[t + 1] * back[t + 1])
        back[t] /= back[t].sum()
    both = ahead * back
    return both / both.sum(1, keepdims=True)


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    scores, start, step = rng.normal(size=(3, 3)), np.exp(rng.normal(size=3)), np.exp(rng.normal(size=(3, 3)))
    want = np.zeros((3, 3))
    for path in itertools.product(range(3), repeat=3):
        a, b, c = path
        w = start[a] * np.exp(scores[0, a]) * step[a, b] * np.exp(scores[1, b]) * step[b, c] * np.exp(scores[2, c])
        for t, k in enumerate(path):
            want[t, k] += w
    want /= want.sum(1, keepdims=True)
    assert np.allclose(plain_chain(scores, start, step), want)
    assert np.allclose(langid.whole_chains(scores, [3], step, start[None], np.ones((1, 3))), want)


@pytest.mark.parametrize("langs", [1, 2, 5])
def test_chains_are_whole_whatever_their_length(langs):
    rng = np.random.default_rng(langs)
    sizes = [1, 63, 64, 65, 128, 129, 700, 2]
    scores, start, step = rng.normal(size=(sum(sizes), langs)), np.exp(rng.normal(size=langs)), np.exp(2 * rng.normal(size=(langs, langs)))
    found = langid.whole_chains(scores, sizes, step, np.tile(start, (len(sizes), 1)), np.ones((len(sizes), langs)))
    want = np.concatenate([plain_chain(part, start, step) for part in np.split(scores, np.cumsum(sizes)[:-1])])
    assert np.allclose(found, want, atol=1e-12)


def test_a_long_text_is_one_chain_in_parts(monkeypatch):
    rng = np.random.default_rng(5)
    run = lambda letters, n: "".join(rng.choice(list(letters), n))
    model = langid.train([(" ".join(run(letters, 3) for _ in range(60)), lang) for lang, letters in (("aa", "abcd"), ("bb", "cdef"), ("cc", "efga")) for _ in range(20)])
    words = langid.words_of(" ".join(run("abcdefg", 3) for _ in range(2000)))
    labeller = langid.Labeller(model)
    want = plain_chain(labeller._scores(words), model["start"], model["step"])
    whole = labeller.probabilities([words])[0]
    assert np.allclose(whole, want, atol=1e-12)
    monkeypatch.setattr(langid, "_GROUP", 320)
    assert np.allclose(labeller.probabilities([words])[0], want, atol=1e-12)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_hard_texts_and_missing_labels(spark, module):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    noisy = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None), (10**9, 1, 0), (5, 7, 7)], labels.schema))
    model = module.fit(docs.unionByName(spark.createDataFrame([(None, "x", None, None, None)], docs.schema)), noisy)
    rows = module.score(hard_rows(spark), model).collect()
    assert len(rows) == len(HARD) and all(0 <= r.score <= 1 for r in rows)
    score = {r.doc_id: r.score for r in rows}
    assert score[7] == score[8] and score[0] == score[1]
    none = module.fit(docs, labels.limit(0))
    assert {r.score for r in module.score(hard_rows(spark), none).collect()} == {0.5 if module is quality else 0.0}
    assert module.score(docs.limit(0), model).count() == 0


def test_language_of_hard_texts_and_no_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r for r in langid.predict(hard_rows(spark), langid.fit(docs)).collect()}
    assert rows[0].lang_pred == rows[1].lang_pred == rows[2].lang_pred == "und" and rows[6].lang_pred != "und" and rows[7] .lang_pred == rows[8].lang_pred
    none = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.predict(hard_rows(spark), none).collect()} == {"und"}


def _kept(sample, label_bytes=10**9):
    """What a training task sees of a sample."""
    return common.train_in_task(sample, list, label_bytes)


def test_sample_is_bounded_and_stable(spark):
    docs = spark.createDataFrame([(i, "y" * (i % 50), "a" if i % 2 else "b") for i in range(400)], "doc_id long, text string, lang string")
    draw = lambda d, rows, size: _kept(common.bounded_sample(d, F.lit(True), F.col("lang"), rows, size), size)
    sample = draw(docs, 30, 500)
    assert sample == draw(docs.repartition(7), 30, 500)
    for label in "ab":
        own = [t for t, k in sample if k == label]
        assert 0 < len(own) <= 30 and sum(map(len, own)) <= 500
    assert draw(docs.limit(0), 30, 500) == []


def test_an_id_of_many_rows_gives_one_text(spark):
    rows = [(7, "z" * 40, "a"), (7, "b", "a"), (7, "a", "a"), (7, "long one", "b"), (8, None, "a"), (None, "no id", "a"), (9, "nine", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"id": F.lit("clash"), "own": F.lit(1), "label": F.lit(0), "h": F.lit(0)})
    assert sorted(_kept(common.bounded_sample(docs, F.col("lang").isNotNull(), F.col("lang"), 10, 500))) == [("a", "a"), ("long one", "b")]


def test_temperature_and_share_calibrate():
    rng = np.random.default_rng(0)
    sample = [("good " * 5 + str(rng.random()), 1) for _ in range(200)] + [("BAD!! " * 5 + str(rng.random()), 0) for _ in range(200)]
    model = quality.train(sample, 0.9)
    assert model["temperature"] > 0 and quality.score_texts(model, ["good good good"], quality.Tokens())[0] > quality.score_texts(model, ["BAD!! BAD!!"], quality.Tokens())[0]


def test_every_letter_of_a_long_run_counts():
    word = "".join(chr(0x4E00 + i) for i in range(1000))
    pieces = langid.words_of(word)
    bodies = [p.rpartition("+")[2].removesuffix("-") for p in pieces]
    assert "".join(bodies) == word and max(map(len, bodies)) <= langid.PIECE
    assert langid.words_of("kurz " + "x" * 16) == ["kurz", "x" * 16] and langid.words_of("x" * 17) == ["x" * 8 + "-", "xx+" + "x" * 9]
    for whole in (word, "donaudampfschifffahrtsge", "abcdefghijklmnop", "ab", "a"):
        own = langid.words_of(whole)
        rows = [langid.feature_rows(p, {p: 0}) for p in own]
        assert max(map(len, rows)) <= langid.MOST_FEATURES
        marked = f"<{whole}>"
        names = {marked[i : i + n] for n in (2, 3) for i in range(len(marked) - n + 1)}
        names |= {"p" + whole[:n] for n in (1, 2, 3)} | {"s" + whole[-n:] for n in (1, 2, 3)}
        # all features of the word, and no others
        assert {r for found in rows for r in found if r < langid.ROWS} == {langid._rows[n] for n in names}
    rng = np.random.default_rng(3)
    run = lambda letters, n: "".join(rng.choice(list(letters), n))
    model = langid.train([(" ".join(run(letters, 9) for _ in range(40)), lang) for lang, letters in (("aa", "abcdefg"), ("bb", "pqrstuv")) for _ in range(30)])
    # the first and last letters are of one language, most of the run is of the other
    lang, _, runs = langid.Labeller(model).label([run("abcdefg", 320) + run("pqrstuv", 6400) + run("abcdefg", 320)])[0]
    assert lang == "bb" and [r["lang"] for r in runs] == ["aa", "bb", "aa"]


def test_more_labels_than_the_bound_are_an_error(spark):
    docs = spark.createDataFrame([(i, "wort", f"l{i % 3}") for i in range(60)], "doc_id long, text string, lang string")
    draw = lambda most: _kept(common.bounded_sample(docs, F.lit(True), F.col("lang"), 5, 500, most_labels=most))
    assert {k for _, k in draw(3)} == {"l0", "l1", "l2"}
    with pytest.raises(ValueError, match="most_labels"):
        draw(2)
    with pytest.raises(ValueError, match="most_labels"):
        langid.fit(docs, most_langs=2)


def test_toxicity_scores_against_a_plain_version(spark):
    """Each window compressed anew, thresholds counted one by one."""
    import zstandard

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    assert model["toxic"] != model["ordinary"]
    # the two dictionaries share no body
    shared = {model["toxic"][i : i + 64] for i in range(len(model["toxic"]) - 64)} & {model["ordinary"][i : i + 64] for i in range(len(model["ordinary"]) - 64)}
    assert len(shared) < 0.05 * len(model["toxic"])

    def length(content, window):
        settings = zstandard.ZstdCompressionParameters(
            window_log=18, chain_log=16, hash_log=16, search_log=2, min_match=6, target_length=64, strategy=zstandard.STRATEGY_LAZY, write_content_size=False, write_dict_id=False
        )
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=settings)
        return len(zstandard.ZstdCompressor(dict_data=held, compression_params=settings).compress(b"." * 32 + f" {window} ".encode("utf-16-le") + b"." * 32))

    def plain(text):
        words, z = toxicity.words_of(text), []
        for size in (1, 8):
            windows = [" ".join(words[i : i + size]) for i in range(0, len(words), size)]
            pairs = [(length(model["ordinary"], w), length(model["toxic"], w)) for w in windows] or [(0, 0)]
            gains = [a - b for a, b in pairs]
            counts = [sum(g >= t for g in gains) for t in toxicity.THRESHOLDS]
            counts += [sum(g >= toxicity.THRESHOLDS[0] and 10 * g >= t * max(a - toxicity._FRAME, 1) for g, (a, _) in zip(gains, pairs, strict=True)) for t in toxicity.SHARES]
            z += [np.log1p(c) for c in counts] + [(c / len(gains)) ** 0.5 for c in counts] + [np.log1p(len(gains)), sum(gains) / len(gains), min(max(gains), 32) / 10]
        z = (np.array(z) - model["mean"]) / model["scale"]
        return 1 / (1 + np.exp(-(z @ model["weights"][:-1] + model["weights"][-1])))

    texts = [r.text for r in docs.filter("length(text) < 400").orderBy("doc_id").limit(25).collect()] + ["", None, "you idiot you moron"]
    scorer = toxicity.Scorer(model)
    assert np.allclose([scorer.score(t) for t in texts], [plain(t) for t in texts], atol=1e-9)


def test_toxic_phrases_of_ordinary_words_are_learned():
    """No word tells these texts apart, only words that stand together; few and many texts."""
    rng = np.random.default_rng(1)
    common_words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(40)]
    phrase = common_words[:4]

    def text(toxic):
        words = list(rng.choice(common_words, 30))
        for at in (8, 20) if toxic else ():
            words[at : at + 4] = phrase
        return " ".join(words)

    for n in (60, 400):
        model = toxicity.train([(text(k), k) for k in (0, 1) for _ in range(n)], 0.5)
        scorer = toxicity.Scorer(model)
        found = [[scorer.score(text(k)) >= 0.5 for _ in range(60)] for k in (0, 1)]
        assert np.mean(found[1]) - np.mean(found[0]) > 0.3


def test_quality_scores_against_a_plain_version():
    """Random indexing, pooling and the network, one occurrence at a time."""
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdeABC12.,!"), rng.integers(1, 7))) for _ in range(60)]
    texts = [" ".join(rng.choice(words[k * 20 : k * 20 + 40], rng.integers(0, 30))) for k in (0, 1) for _ in range(40)]
    model = quality.train([(t, i // 40) for i, t in enumerate(texts)], 0.4)
    tokens, index = quality.Tokens(), quality.index_vectors()
    vectors = {}
    for t in texts:
        rows = [tokens[w] for w in t.split()]
        for i in range(len(rows)):
            near = [j for j in range(max(0, i - quality.CONTEXT), min(len(rows), i + quality.CONTEXT + 1)) if j != i]
            for row in rows[i]:
                for j in near:
                    vectors[row] = vectors.get(row, 0) + index[rows[j][0]] + index[rows[j][1]]

    def vector(row):
        v = np.array(vectors.get(row, np.zeros(quality.WIDTH)), float)
        return v / np.linalg.norm(v) if np.linalg.norm(v) else v

    def plain(text):
        rows = [tokens[w] for w in text.split()]
        x = np.zeros(3 * quality.WIDTH + 4)
        if rows:
            w, s = [vector(a) for a, _ in rows], [vector(b) for _, b in rows]
            pairs = [a * b for a, b in zip(w, w[1:], strict=False)]
            same = [a == b for (a, _), (b, _) in zip(rows, rows[1:], strict=False)]
            x[: 3 * quality.WIDTH] = np.concatenate([np.mean(w, 0), np.mean(s, 0), np.mean(pairs, 0) if pairs else np.zeros(quality.WIDTH)])
            x[3 * quality.WIDTH :] = np.sum(pairs) / max(len(pairs), 1), np.mean(same) if same else 0, len({a for a, _ in rows}) / len(rows), np.log1p(len(rows)) / 10
        hidden = np.tanh((x - model["mean"]) / model["scale"] @ model["w1"] + model["b1"])
        return 1 / (1 + np.exp(-(hidden @ model["w2"] + model["b2"]) / model["temperature"]))

    some = texts[::9] + ["", "a", "never seen Words"]
    assert np.allclose(quality.score_texts(model, some, tokens), [plain(t) for t in some], atol=1e-4)
