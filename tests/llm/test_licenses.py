import re

from pyspark.sql import functions as F

from changeloom.llm import common, licenses
from changeloom.llm.license_rules import BASE_PHRASES, FAMILIES, MAX_MATCH_CHARS, RULES

SCHEMA = "doc_id long, text string"


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text):
    w = words_of(text)
    places = [(i, label) for phrase, label in BASE_PHRASES for i in range(len(w)) if w[i : i + phrase.count(" ") + 1] == phrase.split()]
    t = " ".join(w)
    every = [(m.start(), m.end(), k, r) for k, r in enumerate(RULES) for m in re.finditer(r.regex, t) if m.end() > m.start()]
    beats = lambda e, d: e[0] <= d[0] and d[1] <= e[1] and (e[3].priority, d[1] - d[0] - e[1] + e[0], e[2]) < (d[3].priority, 0, d[2])
    kept = [d for d in every if d[3].priority == 0 or not any(beats(e, d) for e in every)]
    base = sorted({label for _, label in places})
    starts = [i for i, _ in places]
    return {
        "n_words": len(w), "n_base": len(places), "first_word": min(starts, default=None), "last_word": max(starts, default=None), "base_labels": base,
        "labels": sorted({*base, *(d[3].label for d in kept)}), "spans": sorted((d[0], d[1], d[3].id) for d in kept),
        "score": max([d[3].confidence for d in kept] + [1.0 if places else 0.0]),
    }


def compare(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).withColumns({"words": F.lit(1), "n_base": F.lit("clash")})
    for row in licenses.scan(df).collect():
        want = brute(texts[row.doc_id])
        got = row.asDict() | {"spans": sorted((d["start"], d["end"], d["rule"]) for d in row.detections)}
        assert {k: got[k] for k in want} == want, texts[row.doc_id]


def test_rules_are_many_ordered_and_bounded():
    assert len(RULES) >= 380 and len({r.id for r in RULES}) == len(RULES)
    assert [r.priority for r in RULES if not r.id.startswith("text")] == sorted(r.priority for r in RULES if not r.id.startswith("text"))
    assert all("*" not in r.regex.replace("[uc*]", "") and "+" not in r.regex for r in RULES)
    assert all(len(re.sub(r"\(\?:|[()?|\\]", "", r.regex)) < MAX_MATCH_CHARS for r in RULES)


def test_against_brute_force(spark):
    compare(
        spark,
        [
            "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "All rights reserved.",
            None, "", "...", "cc by nc cc by nc", "CC-BY-NC-SA 4.0 and CC BY 4.0", "SPDX-License-Identifier: GPL-2.0-or-later", "under the mit licenses",
            "GNU General Public License as published by the Free Software Foundation; either version 2 or GPL v3", "éMIT license ſ mit license K", "blue oa\u212a model license l\u0130cense \u212a mit license", "Copyright (c) 2020 2021 by acme",
            "See the Mozilla Public License v 2.0; released under BSD 3-Clause License, without warranty of any kind", "permit license", "a under the mit license b under the mit license",
        ],
    )


def test_long_texts_and_window_borders(spark):
    fill = lambda n: ("wort " * n)[:n]
    texts = [fill(4096 - k) + " released under the Apache License, Version 2.0 x " + fill(4070) + " cc by-nc 4.0 mit license " for k in (0, 3, 12, 25, 40, 49)]
    compare(spark, [*texts, "cc by nc 4 0 " * 2000, "x" * 300_000, "mit license " * 1500])


def test_matches_that_overlap_themselves(spark):
    """A rule's matches follow one another from the first on, wherever a stretch may end."""
    text = "wortx " + "bsd 2 clause " * 600
    compare(spark, [text, "x " * 2045 + "bsd 2 clause " * 900, "a" * 4000 + " cc by nc 4 0 nc" * 700, ("mit license " * 9 + "wort " * 800) * 6])
    row = licenses.scan(spark.createDataFrame([(0, text)], SCHEMA)).first()
    names = [(d["start"], d["end"]) for d in row.detections if d["rule"] == "name:bsd-2-clause"]
    assert sorted(names) == [(6 + 13 * i, 18 + 13 * i) for i in range(600)]


def test_running_sums(spark):
    for n in (0, 1, 63, 64, 65, 128, 1000, 5000):
        row = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(max(n, 1))), lambda x: x.cast("long") * 7 % 11).alias("a"))
        row = row.select("a", common.running_sums(F.col("a"))) if n else spark.range(1).select(F.array().cast("array<bigint>").alias("a")).select("a", common.running_sums(F.col("a")))
        a, sums = row.first()
        assert sums == [sum(a[:i]) for i in range(len(a))]


def test_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    compare(spark, [r.text for r in docs.select("text").collect()])


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def least_matches(regex):
    """Of each alternative the matches without what is optional."""

    def spelled(tree):
        out = [""]
        for op, arg in tree:
            match str(op):
                case "LITERAL":
                    own = [chr(arg)]
                case "IN":
                    own = [chr(x if str(kind) == "LITERAL" else x[0]) for kind, x in arg][:1]
                case "BRANCH":
                    own = [x for branch in arg[1] for x in spelled(branch)]
                case "SUBPATTERN":
                    own = spelled(arg[3])
                case "MAX_REPEAT":
                    own = [x * arg[0] for x in spelled(arg[2])] if arg[0] else [""]
                case "ASSERT_NOT":
                    own = [""]
                case other:
                    raise ValueError(other)
            out = [a + b for a in out for b in own]
        return out

    return spelled(re._parser.parse(regex))


def held(keyword, text):
    return all(part in f" {text}" for part in keyword.split("&"))


def test_names_without_the_word_licence(spark):
    names = {x for _, _, name, _ in FAMILIES for x in least_matches(name) if "licen" not in x}
    assert {"mpl2", "epl2", "cddl", "eupl", "bsl", "wtfpl", "sspl"} <= names
    spelt = ["released under the MPL 2.0", "distributed under EPL v2", "available under the SSPL", "released under the WTFPL", "under the terms of the CDDL 1.0", "see the EUPL 1.2", "bsl 1.0"]
    compare(spark, [*spelt, *(f"{form} {x}" for x in sorted(names) for form in ("Released under the", "see", "a"))])


def test_every_match_holds_a_keyword(spark):
    for rule in RULES:
        for x in least_matches(rule.regex):
            assert any(held(k, x) for k in rule.keyword.split("|")), (rule.id, x)
    compare(spark, ["Released under the X11 License", "under the Expat License", "see the X11 style license", "The above copyright notice and this permission notice shall be included"])


def test_apache_links(spark):
    links = ["http://www.apache.org/licenses/LICENSE-2.0", "https://www.apache.org/licenses/LICENSE-2.0", "http(s)://www.apache.org/licenses/LICENSE-2.0", "https://apache.org/licenses/LICENSE-2.0.txt"]
    assert all(brute(x)["labels"] == ["apache-2"] for x in links)
    compare(spark, links)
