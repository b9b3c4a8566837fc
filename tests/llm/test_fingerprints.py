import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from changeloom.llm import fingerprints as f

SCHEMA = "doc_id long, text string"


def shingle_set(text):
    w = re.findall(r"[^\W]+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edits(rows):
    """The contract's edit, by sorting everything."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""), reverse=True)
    out = []
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        out.append((i, t, n, t[: len(t) - len(t) // 2] + n[: len(t) // 2]))
    return out


def fingerprint_rows(spark, df, **kw):
    rows = f.with_next(df, lambda r: r.withColumn("fp", f.fingerprint(F.col("text"))), **kw)
    edited = f.edited_text(F.coalesce("text", F.lit("")), F.coalesce("next_text", F.lit("")))
    rows = rows.withColumn("edited", edited).withColumn("efp", f.fingerprint(F.col("edited")))
    return rows.withColumns({"near_edited": f.likeness(F.col("fp"), F.col("efp")), "near_next": f.likeness(F.col("fp"), F.col("next_fp"))}).collect()


@pytest.mark.parametrize("rows_per_block", [3, 40, 2000])
def test_next_rows_against_sorting(spark, rows_per_block):
    rng = random.Random(rows_per_block)
    rows = [(rng.randrange(-500, 500) * 7, "ab é𝄞"[: rng.randrange(6)] + str(rng.random())) for _ in range(200)]
    rows += [(None, "n1"), (None, None), (5, None), (5, ""), (9, "same"), (9, "same"), (10**15, "far")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("clash"), "block": F.lit(1), "guest": F.lit(0)})
    out = fingerprint_rows(spark, df, rows_per_block=rows_per_block)
    key = lambda r: tuple((x is not None, x) if not isinstance(x, str) else (True, x) for x in r)
    got = sorted(((r.id, r.text or "", r.next_text or "", r.edited) for r in out), key=key)
    assert got == sorted(edits(rows), key=key)


def test_one_row_and_no_row(spark):
    out = fingerprint_rows(spark, spark.createDataFrame([(1, "a b")], SCHEMA))
    assert [(r.next_text, r.near_next, r.edited) for r in out] == [("a b", 1.0, "a a")]
    assert fingerprint_rows(spark, spark.createDataFrame([], SCHEMA)) == []


def test_likeness_estimates_jaccard(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(3000)]
    base = [rng.choice(words) for _ in range(600)]
    pairs = [(" ".join(base), " ".join(base[:cut] + [rng.choice(words) for _ in range(600 - cut)])) for cut in range(0, 601, 20)]
    pairs += [(" ".join(base[:n]), " ".join(base[: n - n // 4])) for n in (8, 12, 20, 40, 80)]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.withColumns({"fa": f.fingerprint(F.col("a")), "fb": f.fingerprint(F.col("b"))}).withColumn("like", f.likeness(F.col("fa"), F.col("fb"))).collect()
    errors = [r.like - jaccard(r.a, r.b) for r in rows]
    assert max(map(abs, errors)) < 0.16 and abs(sum(errors) / len(errors)) < 0.04
    assert all(len(r.fa) == f.BINS * f.BITS // 4 for r in rows)


def test_densification_is_a_function_of_the_set(spark):
    texts = ["a b c d e f", "A  b. c d e f", "", None, "x", "x", "a b c d e f " * 30, "...", "w " * 200_000]
    fp = [r.f for r in spark.createDataFrame([(t,) for t in texts], "t string").select(f.fingerprint(F.col("t")).alias("f")).collect()]
    assert fp[0] == fp[1] != "" and fp[2] == fp[3] == fp[7] == "" and fp[4] == fp[5] != fp[0]
    assert len(set(re.findall("..", fp[8]))) == 1
    # two shingles fill all bins with two values, about half each
    two = re.findall("..", fp[0])
    assert len(set(two)) == 2 and 35 < two.count(two[0]) < 93


def plain_fingerprint(text, bins=128, bits=8):
    """One-permutation MinHash with optimal densification, one shingle and one bin at a time."""
    import xxhash

    chained = lambda hashes, seed=42: [seed := xxhash.xxh64_intdigest((h).to_bytes(8, "little"), seed=seed) for h in hashes][-1]
    words = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in re.findall(r"[^\W]+", (text or "").lower())]
    hashes = {chained(words[i : i + 5]) for i in range(len(words) - 4)} or ({chained(words)} if words else set())
    if not hashes:
        return ""
    least = {}
    for h in hashes:
        least[h >> 57] = min(h, least.get(h >> 57, h))
    orders = f._probe_orders(bins)
    return "".join(f"{least[next(j for j in [b, *orders[b]] if j in least)] & (1 << bits) - 1:02x}" for b in range(bins))


def test_fingerprints_against_a_plain_version(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += [None, "", "a", "a b c d", "a b c d e", "é ñ 日本 x Y z"]
    rows = spark.createDataFrame(list(enumerate(texts)), SCHEMA).withColumn("f", f.fingerprint(F.col("text"))).collect()
    assert {r.doc_id: r.f for r in rows} == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = {i: (t, n, e) for i, t, n, e in edits(docs)}
    for r in f.query(spark, "/root/testdata/sf0.001").collect():
        t, n, e = want[r.doc_id]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(t, e)) < 0.25 and abs(r.near_next - jaccard(t, n)) < 0.25
