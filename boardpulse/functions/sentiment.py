"""Column expressions from model outputs to label, score and probabilities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boardpulse.config import TEXT_TITLE
from boardpulse.functions.text import strip


def model_text(title: Column, content: Column, text_used: str) -> Column:
    """The text to score: the title, or title and content with a blank line
    between them. NULL counts as empty."""
    title = strip(F.coalesce(title, F.lit("")))
    if text_used == TEXT_TITLE:
        return title
    content = strip(F.coalesce(content, F.lit("")))
    return F.concat_ws("\n\n", F.nullif(title, F.lit("")), F.nullif(content, F.lit("")))


def softmax(logits: Column) -> Column:
    """Probabilities of three logits as a struct (neg, neu, pos)."""
    values = [logits[i].cast("double") for i in range(3)]
    top = F.greatest(*values)
    exps = [F.exp(v - top) for v in values]
    total = exps[0] + exps[1] + exps[2]
    return F.struct(
        (exps[0] / total).alias("neg"),
        (exps[1] / total).alias("neu"),
        (exps[2] / total).alias("pos"),
    )


def neutral() -> Column:
    """Probabilities of a text that is certainly neutral."""
    return F.struct(F.lit(0.0).alias("neg"), F.lit(1.0).alias("neu"), F.lit(0.0).alias("pos"))


def _at_least(a: Column, b: Column) -> Column:
    """a >= b, false when either is NaN (Spark orders NaN above everything)."""
    return ~F.isnan(a) & ~F.isnan(b) & (a >= b)


def sentiment_label(probs: Column, neutral_floor: float) -> Column:
    """Most likely label, ties in the order pos, neg, neu; neutral where the
    largest probability stays below the floor."""
    neg, neu, pos = probs.neg, probs.neu, probs.pos
    label = (
        F.when(_at_least(pos, neu) & _at_least(pos, neg), F.lit("pos"))
        .when(_at_least(neg, neu) & _at_least(neg, pos), F.lit("neg"))
        .otherwise("neu")
    )
    if neutral_floor > 0:
        label = F.when(F.greatest(neg, neu, pos) < neutral_floor, F.lit("neu")).otherwise(label)
    return label


def sentiment_score(probs: Column) -> Column:
    """Positive minus negative probability, whatever the label is."""
    return probs.pos - probs.neg
