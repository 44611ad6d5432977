"""Small tables with nulls, empty and very long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

WORDS = "the and of to in is was that it for on with as by at from are this be or river stone light house garden winter music paper".split()
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "fp string, root string, spans string, hash string, language string, words string, kept string, h string, "
    "__id string, __hash string, __spans string, text_hash string, row string, blob string, best string, begin string"
)


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    out = []
    for i in range(words):
        out.append(rng.choice(WORDS) + rng.choice(WORDS) + (rng.choice([".", ",", ".\n"]) if i % 7 == 6 else ""))
    return " ".join(out)


def documents(spark, texts, lang="en", source="s"):
    """Ids from 0 on for a list, or the rows given as (id, text)."""
    rows = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
    full = [(i, t, lang, source, None if t is None else len(t), *"abcdefghijklmnop") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, "one"),
    (5, "one"),
    (None, "one two three"),
    (7, prose(1, 60)),
    (7, prose(2, 60)),
    (8, prose(1, 60)),
    (9, prose(3, 30_000)),
    (10, "x" * 200_000),
    (11, "\x00 né 😀 ünïcode</s> it's 10% | a\r\nb"),
]
