"""The short reports of a run: first posts, first results, first payloads.

Sorting by the place on the list page with a limit is a top-k, so only the rows
of the report leave the tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardpulse.config import PREVIEW_CHARS, PREVIEW_MARK
from boardpulse.functions.text import preview
from boardpulse.operators.messages import PAYLOAD_COLUMNS, with_doc_id


def post_sample(posts: DataFrame, rows: int = 5) -> DataFrame:
    short = preview(F.col("content"), PREVIEW_CHARS, PREVIEW_MARK).alias("content_preview")
    return (
        posts.orderBy("page_id", "pos")
        .limit(rows)
        .select("board_id", "post_id", "url", "category", "title", "author", "created_at", short)
    )


def analyzed_sample(analyzed: DataFrame, rows: int = 10) -> DataFrame:
    return with_doc_id(analyzed.orderBy("page_id", "pos").limit(rows)).select(
        "doc_id",
        "title",
        "sentiment_label",
        "sentiment_score",
        "sentiment_probs",
        "text_used",
        "model_version",
        "url",
    )


def payload_sample(payload: DataFrame, rows: int = 3) -> DataFrame:
    return payload.orderBy("page_id", "pos").limit(rows).select(*PAYLOAD_COLUMNS)
