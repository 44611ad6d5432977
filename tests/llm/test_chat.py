import hashlib

import pytest
from pyspark.sql import functions as F

from boardpulse.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, valid string"
C = chat.PLAIN_CHAT.controls
TALKS = {
    1: [("system", "be kind"), ("user", "hi"), ("assistant", "ho")],
    2: [("user", "".join(C)), ("assistant", "\\" + "\\".join(C) + "\\"), ("user", "\\\\</s>\\[INST]\n")],
    3: [("assistant", "first"), ("user", "")],
    4: [("user", None), ("user", "again")],
    5: [("tool] x", "data [/ROLE]"), (None, "who"), ("assistant", "\n<</SYS>>\n <")],
    6: [("user", "a" * 200_000 + "</s>" * 5000), ("assistant", "[" * 1000)],
    7: [("system", "only")],
    8: [("user", "<<<</SYS>> [[INST]] <s><s>"), ("assistant", " lead and trail \n")],
    9: [("r" * 200_000, "x"), ("]\\" * 100_000, "\\" * 200_000), ("assistant", "[/ROLE]" * 30_000)],
}
VALID = {1, 2, 6, 8}


def frame(spark, talks):
    rows = [(i, n, r, t, "x", "y") for i, turns in talks.items() for n, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def formatted(spark):
    return chat.format_conversations(frame(spark, TALKS)).cache()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip(formatted):
    read = formatted.select("conv_id", "valid", chat.read_back(F.col("formatted")).alias("turns")).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read} == {i: [(r or "", t or "") for r, t in turns] for i, turns in TALKS.items()}
    assert {r.conv_id for r in read if r.valid} == VALID


def test_no_control_string_in_a_text(formatted):
    for row in formatted.collect():
        for s in row.segments:
            assert not s.body or not any(c in s.text for c in C)
        assert row.formatted == "".join(s.text for s in row.segments)


def test_digests(formatted):
    found = {r.conv_id: r for r in chat.conversation_digests(formatted).collect()}
    for i, turns in TALKS.items():
        learnt = "".join(t or "" for r, t in turns if r == "assistant")
        shown = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
        assert (found[i].n_turns, found[i].turns_sha256) == (len(turns), sha(shown))
        assert (found[i].loss_chars, found[i].loss_sha256) == (len(learnt), sha(learnt))


def test_ties_repeats_and_nulls(spark):
    rows = [(None, 0, "user", "a", "", ""), (None, 0, "user", "a", "", ""), (9, None, "user", "q", "", ""), (9, 0, "assistant", "b", "", ""), (9, 0, "assistant", "a", "", "")]
    found = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
    read = {r.conv_id: [t.text for t in r.turns] for r in found.select("conv_id", chat.read_back(F.col("formatted")).alias("turns")).collect()}
    assert read == {None: ["a", "a"], 9: ["q", "a", "b"]}
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []
