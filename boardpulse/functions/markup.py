"""Expressions over HTML source: visible text lines, anchors, subject titles.

Everything is a regular expression or a higher-order function over a per-page
array, so it runs inside the JVM and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from boardpulse.config import PLAIN_ANCHOR, SUBJECT_CLASS
from boardpulse.functions.text import decode_entities, let, non_blank_lines, strip

# A start tag, end tag, declaration or processing instruction. Quoted attribute
# values may hold ">". A tag cut off by the end of the page counts as a tag.
_TAG = "<[/!?A-Za-z_:](?:[^=>]++|=\\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>?"
_TOKEN_START = "(?=<[/!?A-Za-z_:])"
_END_OF_NAME = "(?=[\\s/>])"

# What follows the "<" of a comment or of an element whose text is not shown. All
# of them read the page forward only, so the time grows with its length.
_COMMENT = "!--.*?(?:-->|\\z)"
_RAW_ELEMENT = (
    f"(?<raw>script|style){_END_OF_NAME}[^>]*+(?:\\z|>.*?(?:</\\k<raw>\\s*+>|\\z))"
)
# Hidden elements may hold markup, but not an element of the same name. One that
# is never closed is not hidden.
_HIDDEN_ELEMENT = (
    f"(?<hidden>template|rt|rp){_END_OF_NAME}"
    f"[^>]*+(?:\\z|>(?:[^<]++|<(?!/?\\k<hidden>{_END_OF_NAME}))*+</\\k<hidden>\\s*+>)"
)

_NO_SOURCE = f"(?is)<(?:{_COMMENT}|{_RAW_ELEMENT})"
_NO_HIDDEN = f"(?is)<{_HIDDEN_ELEMENT}"
_NOT_VISIBLE = f"(?is)<(?:{_COMMENT}|{_RAW_ELEMENT}|{_HIDDEN_ELEMENT})"

_ANCHOR_START = f"(?i)(?=<a{_END_OF_NAME})"
_ANCHOR_INNER = f"^{_TAG}((?:[^<]++|<(?!/[aA]{_END_OF_NAME}))*+)"
# The attribute is looked for outside quoted values of earlier attributes.
_HREF = (
    "(?is)^<a(?:(?!\\shref[\\s=/>])(?:[^\"'>]|\"[^\"]*+\"|'[^']*+'))*+"
    "\\shref(?:\\s*+=\\s*+(\"[^\"]*+\"|'[^']*+'|[^\\s>]*+))?"
)


def visible_lines(html: Column) -> Column:
    """Text lines of a page: stripped, without blank lines and hidden elements."""
    no_hidden = F.regexp_replace(html, _NOT_VISIBLE, "\n")
    no_tags = F.regexp_replace(no_hidden, _TAG, "\n")
    return non_blank_lines(let(no_tags, decode_entities))


def _unquote(value: Column) -> Column:
    quoted = value.startswith('"') | value.startswith("'")
    return F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def anchors(html: Column) -> Column:
    """Anchors with a link, in document order, as ARRAY<STRUCT<href, inner>>.

    An anchor ends at its end tag or where the next one starts. Comments leave
    an empty tag behind, because they separate the texts around them; so do
    elements without visible text inside an anchor.
    """
    source = F.regexp_replace(html, _NO_SOURCE, "<!>")
    pieces = F.filter(F.split(source, _ANCHOR_START), lambda p: p.rlike(_HREF))
    return F.transform(
        pieces,
        lambda p: F.struct(
            let(F.regexp_extract(p, _HREF, 1), lambda v: let(let(_unquote(v), decode_entities), strip)).alias("href"),
            F.regexp_replace(F.regexp_extract(p, _ANCHOR_INNER, 1), _NO_HIDDEN, "<!>").alias("inner"),
        ),
    )


def _subject_start(tag: Column) -> Column:
    """Pattern of a start tag of this name that carries the subject class."""
    name = SUBJECT_CLASS
    value = (
        f"\"(?:[^\"]*\\s)?{name}(?:\\s[^\"]*)?\""
        f"|'(?:[^']*\\s)?{name}(?:\\s[^']*)?'"
        f"|{name}{_END_OF_NAME}"
    )
    skip = "(?:(?!\\s(?i:class)\\s*+=)(?:[^\"'>]|\"[^\"]*+\"|'[^']*+'))*+"
    rest = f"){_END_OF_NAME}{skip}\\s(?i:class)\\s*+=\\s*+(?:{value})"
    return F.concat(F.lit("(?s)<(?i:"), tag, F.lit(rest))


def title_tag(inner: Column, tags: Sequence[str]) -> Column:
    """The first of these tags that has a subject element inside the anchor;
    NULL if none has."""
    found = F.lit(None).cast("string")
    for tag in reversed(tags):
        present = F.lit(True) if tag == PLAIN_ANCHOR else F.rlike(inner, _subject_start(F.lit(tag)))
        found = F.when(present, tag).otherwise(found)
    return found


def _text_of_token(token: Column) -> Column:
    """The stripped text that follows the tag at the start of a token."""
    text = F.regexp_extract(token, f"(?s)^(?:{_TAG})?+(.*)", 1)
    return let(let(text, decode_entities), strip)


def _tokens_inside(tokens: Column, tag: Column) -> Column:
    """How many tokens lie inside the element that starts with the first one,
    counting the open elements of the same name."""
    opens = F.concat(F.lit("^<(?i:"), tag, F.lit(f"){_END_OF_NAME}"))
    closes = F.concat(F.lit("^</(?i:"), tag, F.lit(")\\s*+>"))

    def count(state: Column, token: Column) -> Column:
        change = F.when(F.rlike(token, opens), 1).when(F.rlike(token, closes), -1).otherwise(0)
        return F.when(state.closed, state).otherwise(
            let(
                state.depth + change,
                lambda depth: F.struct(
                    depth.alias("depth"),
                    (state.inside + F.when(depth > 0, 1).otherwise(0)).alias("inside"),
                    (depth == 0).alias("closed"),
                ),
            )
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("inside"), F.lit(False).alias("closed"))
    return F.aggregate(tokens, start, count, lambda state: state.inside)


def subject_title(inner: Column, tag: Column) -> Column:
    """Text of the anchor's first subject element of this tag, with the elements
    nested in it. Texts are stripped and joined directly."""
    plain = tag == PLAIN_ANCHOR
    element = F.call_function(
        "regexp_extract", inner, F.concat(_subject_start(tag), F.lit(".*")), F.lit(0)
    )

    def text_inside(tokens: Column) -> Column:
        inside = F.when(plain, F.size(tokens)).otherwise(_tokens_inside(tokens, tag))
        return F.array_join(F.transform(F.slice(tokens, F.lit(1), inside), _text_of_token), "")

    return let(F.split(F.when(plain, inner).otherwise(element), _TOKEN_START), text_inside)
