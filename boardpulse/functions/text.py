"""Text expressions with the white-space and line-break rules of Unicode text.

Spark's ``trim`` removes only the space character, so the character sets are
spelled out here and used everywhere.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from boardpulse.config import CATEGORY_PATTERN

# Code points counted as white space when stripping.
WHITE_SPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    )
)
WS_CLASS = "[\\x09-\\x0d\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
# What ends a line besides the line feed.
_OTHER_LINE_BREAKS = "\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"

_CATEGORY = f"(?d)^{CATEGORY_PATTERN}{WS_CLASS}*(.+)$"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once, for an expression that uses it several times.

    Needed inside lambdas, where Spark does not share common subexpressions.
    """
    return F.transform(F.array(value), use)[0]


def strip(text: Column) -> Column:
    """Remove white space from both ends. The text is used more than once, so it should be cheap or bound by ``let``.

    Trimming the end takes time by the length of the text, so it is done only where there is something to remove.
    """
    ends = F.contains(F.lit(WHITE_SPACE), F.substring(text, -1, 1))
    return F.when(ends, F.btrim(text, F.lit(WHITE_SPACE))).otherwise(F.ltrim(text, F.lit(WHITE_SPACE)))


def is_blank(text: Column) -> Column:
    """True for NULL, empty and white-space-only text."""
    return F.coalesce(F.ltrim(text, F.lit(WHITE_SPACE)) == "", F.lit(True))


def _only_line_feeds(text: Column) -> Column:
    """The text with every line break as a line feed.

    Searching for the rare characters and splitting at one literal is several
    times faster than splitting by a pattern.
    """
    found, unified = F.lit(False), text
    for char in _OTHER_LINE_BREAKS:
        found = found | F.contains(text, F.lit(char))
        unified = F.replace(unified, F.lit(char), F.lit("\n"))
    return F.when(found, unified).otherwise(text)


def non_blank_lines(text: Column) -> Column:
    """Stripped lines of a text, without the blank ones."""
    lines = F.split(let(text, _only_line_feeds), "\n")
    return F.array_remove(F.transform(F.array_remove(lines, ""), strip), "")


def split_category(title: Column) -> Column:
    """Split ``[category] rest`` into a struct (category, title).

    The category has 1 to 6 characters and something must follow it; otherwise
    the category is NULL and the whole title stays.
    """
    category = F.nullif(F.regexp_extract(title, _CATEGORY, 1), F.lit(""))
    rest = F.regexp_extract(title, _CATEGORY, 2)
    return F.struct(
        category.alias("category"),
        let(F.when(category.isNull(), title).otherwise(rest), strip).alias("title"),
    )


def preview(text: Column, chars: int, mark: str) -> Column:
    """The first ``chars`` characters followed by ``mark``, if the text is longer."""
    return F.when(
        F.length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit(mark))
    ).otherwise(text)


# --- Character references ---------------------------------------------------

# The HTML 4 names, as the standard library has them, and the apostrophe.
_NAMED = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
_NAMED_PREFIX = "^[A-Za-z][A-Za-z0-9]{1,9};"
_NUMBER = "^#(?:[xX]0*([0-9a-fA-F]*)|0*([0-9]*));?"


def _character(code: Column) -> Column:
    """Text of a code point; empty when it is no character of a document."""
    allowed = (
        code.isin(0x09, 0x0A, 0x0D)
        | code.between(0x20, 0xD7FF)
        | code.between(0xE000, 0xFFFD)
        | code.between(0x10000, 0x10FFFF)
    )
    utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
    return F.when(allowed, F.decode(utf32, "UTF-32")).otherwise("")


def _numeric_reference(piece: Column) -> Column:
    """Code point of a numeric reference; NULL if it has no or too many digits."""
    hexadecimal, decimal = (F.regexp_extract(piece, _NUMBER, group) for group in (1, 2))
    return F.when(
        F.length(hexadecimal).between(1, 6), F.conv(hexadecimal, 16, 10).cast("int")
    ).when(F.length(decimal).between(1, 7), decimal.cast("int"))


def _named_reference(piece: Column) -> Column:
    """Text of a named reference; NULL if the name is unknown."""
    # One literal, folded to a constant map by the optimizer.
    names = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")
    return F.when(piece.rlike(_NAMED_PREFIX), F.element_at(names, F.substring_index(piece, ";", 1)))


def _decode_piece(piece: Column, i: Column) -> Column:
    """Decode the reference at the start of a piece, which follows an ampersand
    unless it is the first one."""
    numeric = F.concat(
        let(_numeric_reference(piece), _character), F.regexp_replace(piece, _NUMBER, "")
    )
    after_name = F.substring(piece, F.locate(";", piece) + 1, F.length(piece))
    named = F.coalesce(F.concat(_named_reference(piece), after_name), F.concat(F.lit("&"), piece))
    return (
        F.when(i == 0, piece)
        # By far the most frequent one, kept out of the map lookup.
        .when(piece.startswith("amp;"), F.concat(F.lit("&"), F.substring(piece, F.lit(5), F.length(piece))))
        .when(piece.startswith("#"), numeric)
        .otherwise(named)
    )


def decode_entities(text: Column) -> Column:
    """Decode character references in one pass.

    Named references need their semicolon and stay as they are when unknown;
    numeric ones may lack it, and disappear when they name no character. The
    text is used more than once, so it should be a column or bound by ``let``.
    """
    decoded = F.array_join(F.transform(F.split(text, "&"), _decode_piece), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)
