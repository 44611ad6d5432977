from helpers import apply
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boardpulse.functions.text import (
    WHITE_SPACE,
    decode_entities,
    is_blank,
    non_blank_lines,
    preview,
    split_category,
    strip,
)

SPACED = st.lists(
    st.text(alphabet=WHITE_SPACE + "a한​﻿᠎&", max_size=12), min_size=40, max_size=60
)


def test_white_space_is_what_strip_removes():
    assert set(WHITE_SPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=SPACED)
def test_strip_and_lines_like_text_methods(spark, texts):
    assert apply(spark, texts, strip) == list(map(str.strip, texts))
    assert apply(spark, texts, is_blank) == [t == "" or t.isspace() for t in texts]
    assert apply(spark, texts, non_blank_lines) == [list(filter(None, map(str.strip, t.splitlines()))) for t in texts]


def test_null_is_blank(spark):
    assert apply(spark, [None, "  ", "x"], is_blank) == [True, True, False]


def test_entities(spark):
    cases = {
        "a&amp;copy;b": "a&copy;b",
        "&copy;&middot;&apos;&hearts;": "©·'♥",
        "&amp;amp;lt;": "&amp;lt;",
        "&#65;&#x41;&#X1F600;&#0065": "AA😀A",
        "&#66x&#x43g": "BxCg",
        "&#0;&#xD800;&#1114112;&#99999999999;&#xFFFFFFFFFFFF;|": "|",
        "&#;&#x;|": "|",
        "&unknown; &copy &am": "&unknown; &copy &am",
        "& && &;": "& && &;",
        "&#10;x": "\nx",
        "": "",
        "no reference": "no reference",
    }
    assert apply(spark, list(cases), decode_entities) == list(cases.values())


def test_category(spark):
    expected = {
        "[tea] green": ("tea", "green"),
        "[tea]green ": ("tea", "green"),
        "[] x": (None, "[] x"),
        "[1] x": ("1", "x"),
        "[123456] x": ("123456", "x"),
        "[1234567] x": (None, "[1234567] x"),
        "[abc]": (None, "[abc]"),
        "[a]]b": ("a", "]b"),
        "[a] b\nc": (None, "[a] b\nc"),
        " [a] b": (None, "[a] b"),
        "plain": (None, "plain"),
        "[a]　b": ("a", "b"),
        "": (None, ""),
    }
    assert [tuple(r) for r in apply(spark, list(expected), split_category)] == list(expected.values())


def test_preview_at_the_limit(spark):
    texts = ["한" * 120, "한" * 121, ""]
    shown = apply(spark, texts, lambda c: preview(c, 120, "…"))
    assert shown == ["한" * 120, "한" * 120 + "…", ""]


def test_the_end_is_trimmed_only_where_it_has_to_be(spark):
    """Trimming an end counts all characters of a text, which long contents paid for at every look."""
    df = spark.createDataFrame([("x",)], "x string")
    for use in (strip, is_blank):
        plan = df.select(use(F.col("x")).alias("y"))._jdf.queryExecution().optimizedPlan().toString()
        assert "ltrim" in plan.lower()
    assert apply(spark, ["a", " a", "a　", "　", "", None, "é\x85", "𝒳"], strip) == ["a", "a", "a", "", "", None, "é", "𝒳"]
