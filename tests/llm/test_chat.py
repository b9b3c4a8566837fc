import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
piece = st.sampled_from(["<s>", "</s>", "<\\/s>", "<\\\\/s>", "[INST]", "[/INST]", "[\\INST]", "\\", "<", "[", "/s>", "ok", "é𝄞", "\n", ""])
content = st.lists(piece, max_size=8).map("".join)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "sy<s>"]), content), min_size=1, max_size=5), min_size=10, max_size=30))
def test_round_trip_and_mask(spark, conversations):
    rows = [(c, i, role, text) for c, turns in enumerate(conversations) for i, (role, text) in enumerate(turns)]
    out = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
    got = {r.conv_id: r for r in out.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).withColumn("turns", chat.parse(F.col("formatted"))).collect()}
    for c, turns in enumerate(conversations):
        assert got[c].round_trip
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert got[c].loss == "".join(t for role, t in turns if role == "assistant")
        assert len(got[c].loss_spans) == sum(role == "assistant" for role, _ in turns)
        assert got[c].formatted.count("</s>") == got[c].formatted.count("[INST]") == len(turns)


def test_clean_text_is_not_escaped(spark):
    out = chat.format_conversations(spark.createDataFrame([(1, 0, "user", "a \\ b <i> [x]")], SCHEMA)).first()
    assert out.formatted == "<s>[INST]user[/INST]a \\ b <i> [x]</s>"


def test_nulls_ties_repeats_and_many_turns(spark):
    rows = [(None, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")]
    rows += [(2, i, "assistant", f"t{i}") for i in range(1000)] + [(3, 0, "assistant", "x" * 500_000)] + [(4, 5, "assistant", str(i)) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"formatted": F.lit("clash"), "t": F.lit(1), "fine": F.lit(0)})
    out = chat.format_conversations(df)
    got = {r.conv_id: r for r in out.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert got[None].formatted == "<s>[INST][/INST]</s>" and got[None].loss_spans == []
    assert got[1].formatted.replace("<s>[INST]user[/INST]", "").split("</s>") == ["a", "a", "b", ""]
    assert got[2].loss == "".join(f"t{i}" for i in range(1000)) and got[2].n_turns == 1000
    assert got[3].loss == "x" * 500_000
    assert got[4].loss == "".join(sorted(str(i) for i in range(500))) and all(r.round_trip for r in got.values())


def test_empty_table(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", "<s", "</s", "[/INS", "T]", "<\\"])
def test_escape_is_inverse(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).first()
    assert row.u == text and not any(m in row.e for m in chat.MARKS)


def test_planted_conversation(spark):
    rows = chat.query(spark, "/root/testdata/sf0.001").collect()
    assert all(r.round_trip for r in rows)
    got = next(r for r in rows if r.conv_id == -7)
    told = f"user\n{chat.PLANTED_TEXT}\nassistant\n{chat.PLANTED_TEXT}\n"
    assert got.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
    assert got.loss_sha256 == hashlib.sha256(chat.PLANTED_TEXT.encode()).hexdigest() and got.loss_chars == len(chat.PLANTED_TEXT)
