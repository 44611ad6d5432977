"""Posts to analysed posts: scoring by learnt weights, a column expression, or a model in batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from typing import Any, Protocol, runtime_checkable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from boardpulse.config import ANALYZED_COLUMNS, LABELS, TEXT_TITLE, ScoringConfig
from boardpulse.functions.sentiment import (
    model_text,
    neutral,
    sentiment_label,
    sentiment_score,
    softmax,
)
from boardpulse.functions.text import is_blank, strip

# Takes a frame and the name of its text column; adds ``logits``, an array of the three outputs (neg, neu, pos).
Scorer = Callable[[DataFrame, str], DataFrame]
# Takes a batch of texts, gives one row of three outputs (neg, neu, pos) each.
Predict = Callable[[Sequence[str]], Any]
# Loads the model; called in the Python worker, on the first batch with rows.
LoadModel = Callable[[ScoringConfig], Predict]

# Column with the sums of a post's content, where they were made with its page.
CONTENT_SUMS = "content_sums"


@runtime_checkable
class SumScorer(Protocol):
    """A scorer whose outputs follow from sums over tokens, which add up over the parts of a text.

    Many references may have one page; its content is then summed once, and not for each of them.
    """

    def __call__(self, frame: DataFrame, text: str) -> DataFrame: ...

    def sums(self, frame: DataFrame, text: str, name: str) -> DataFrame: ...

    def outputs(self, sums: Column) -> Column: ...

    def count(self, sums: Column) -> Column: ...


def utc_now() -> str:
    """Current time as ISO-8601 text in UTC."""
    return datetime.now(timezone.utc).isoformat()


def column_scorer(outputs: Callable[[Column], Column]) -> Scorer:
    """A column expression as a scorer."""
    return lambda frame, text: frame.withColumn("logits", outputs(F.col(text)))


def first_words(text: Column, count: int) -> Column:
    """The text up to its ``count``-th word between white space; the whole text if it has no more."""
    return F.regexp_extract(text, rf"^(?:\s*+\S++){{0,{count}}}+", 0)


def batch_logits(text: Column, load_model: LoadModel, config: ScoringConfig) -> Column:
    """Model outputs for a text column, in batches of ``config.batch_size``.

    The model stays in the Python worker between batches and tasks. Partitions
    without rows do not load it. A model sees ``config.max_length`` tokens at most, so of a
    longer text only as many words leave the JVM; the model cuts by its own tokens.
    """

    def make_predict() -> Predict:
        loaded: list[Predict] = []

        def predict(texts: np.ndarray) -> np.ndarray:
            if not loaded:
                loaded.append(load_model(config))
            outputs = np.asarray(loaded[0](texts.tolist()), dtype=np.float32)
            return outputs.reshape(len(texts), len(LABELS))

        return predict

    udf = predict_batch_udf(
        make_predict, return_type=ArrayType(FloatType()), batch_size=config.batch_size
    )
    return udf(first_words(text, config.max_length))


def batch_scorer(load_model: LoadModel, config: ScoringConfig) -> Scorer:
    """A model of the caller's own as a scorer."""
    return column_scorer(lambda text: batch_logits(text, load_model, config))


def add_sentiment(df: DataFrame, text: str, logits: str, neutral_floor: float = 0.0) -> DataFrame:
    """Add sentiment_label, sentiment_score and sentiment_probs from the columns
    with the scored text and the model outputs. Blank text is neutral."""
    return _add_sentiment(df, is_blank(F.col(text)), logits, neutral_floor)


def _add_sentiment(df: DataFrame, blank: Column, logits: str, neutral_floor: float) -> DataFrame:
    probs = F.when(blank, neutral()).otherwise(softmax(F.col(logits)))
    scored = df.withColumn("sentiment_probs", probs)
    return scored.withColumns(
        {
            "sentiment_label": sentiment_label(F.col("sentiment_probs"), neutral_floor),
            "sentiment_score": sentiment_score(F.col("sentiment_probs")),
        }
    )


def sum_scorer(scorer: Scorer, config: ScoringConfig) -> SumScorer | None:
    """The scorer, if title and content are scored and their sums add up."""
    return scorer if config.text_used != TEXT_TITLE and isinstance(scorer, SumScorer) else None


def with_content_sums(pages: DataFrame, scorer: SumScorer) -> DataFrame:
    """Add the sums of the content as it stands in the scored text."""
    shown = pages.withColumn("shown_content", strip(F.coalesce("content", F.lit(""))))
    return scorer.sums(shown, "shown_content", CONTENT_SUMS).drop("shown_content")


def score_posts(posts: DataFrame, scorer: Scorer, config: ScoringConfig) -> DataFrame:
    """Add the sentiment columns to posts; one row in, one row out.

    Posts with ``CONTENT_SUMS``, by :func:`with_content_sums` of the same scorer, have their titles read alone.
    """
    text = model_text(F.col("title"), F.col("content"), config.text_used)
    with_text = posts.withColumn("model_text", text)
    if CONTENT_SUMS in posts.columns:
        shown = with_text.withColumn("shown_title", model_text(F.col("title"), F.col("content"), TEXT_TITLE))
        summed = scorer.sums(shown, "shown_title", "title_sums").drop("shown_title")
        both = F.zip_with("title_sums", CONTENT_SUMS, lambda title, content: title + content)
        summed = summed.withColumn("sums", both).drop("title_sums", CONTENT_SUMS)
        # White space between tokens is white space of a strip too, so only a blank text has no token.
        scored = summed.withColumns({"logits": scorer.outputs(F.col("sums")), "blank": scorer.count(F.col("sums")) == 0})
        return _add_sentiment(scored, F.col("blank"), "logits", config.neutral_floor).drop("sums", "blank")
    # The text is never NULL; the model sees blank texts as empty ones.
    shown = F.when(is_blank(F.col("model_text")), F.lit("")).otherwise(F.col("model_text"))
    with_logits = scorer(with_text.withColumn("shown_text", shown), "shown_text").drop("shown_text")
    return add_sentiment(with_logits, "model_text", "logits", config.neutral_floor)


def analyzed_posts(
    posts: DataFrame,
    scorer: Scorer,
    config: ScoringConfig,
    crawled_at: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Analysed posts with the columns of ``ANALYZED_COLUMNS`` and ``keep``.

    ``crawled_at`` is one value for the whole run. Empty content becomes NULL,
    and the category is not carried over.
    """
    scored = score_posts(posts, scorer, config)
    return scored.withColumns(
        {
            "content": F.nullif(F.col("content"), F.lit("")),
            "crawled_at": F.lit(crawled_at or utc_now()),
            "model_version": F.lit(config.model_version),
            "text_used": F.lit(config.text_used),
        }
    ).select(*ANALYZED_COLUMNS, *keep)


def spread(posts: DataFrame, partitions: int) -> DataFrame:
    """Even out posts over tasks before a slow model. Hashing the place on the
    list page splits a post that is linked from very many pages."""
    return posts.repartition(partitions, "page_id", "pos")
