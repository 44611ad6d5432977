"""Analysed posts to keyed JSON messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardpulse.config import PAYLOAD_COLUMNS
from boardpulse.functions.text import strip


def with_doc_id(df: DataFrame) -> DataFrame:
    """Add ``doc_id``: board and post number joined by a colon."""
    doc_id = F.concat(F.col("board_id").cast("string"), F.lit(":"), F.col("post_id").cast("string"))
    return df.withColumn("doc_id", doc_id)


def payloads(analyzed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The fields that are sent, and the columns of ``keep``."""
    return with_doc_id(analyzed).select(*PAYLOAD_COLUMNS, *keep)


def keyed_messages(payload: DataFrame) -> DataFrame:
    """Messages (key BINARY, value STRING): the stripped document id in UTF-8
    and the payload as JSON with its NULLs. A missing id fails the job."""
    key = strip(F.col("doc_id"))
    checked = F.when(key != "", key).otherwise(F.raise_error(F.lit("message without doc_id")))
    value = F.to_json(F.struct(*PAYLOAD_COLUMNS), {"ignoreNullFields": "false"})
    return payload.select(checked.cast("binary").alias("key"), value.alias("value"))


def _place(at: Column, page: Column, pos: Column) -> Column:
    """Time, list page and place on it as one decimal, of a fixed width that a hash aggregate can keep.

    It has room for times up to the year 5138, 10 ** 12 list pages and 10 ** 9 anchors on each, which is
    more than pages of some bytes can be at any size; others fail the job.
    """
    micros = F.coalesce(F.unix_micros(at), F.lit(-(10**17) + 1))
    fits = (F.abs(micros) < 10**17) & page.between(0, 10**12 - 1) & pos.between(0, 10**9 - 1)
    digits = (
        micros.cast("decimal(17,0)") * F.lit(f"{10**21}").cast("decimal(22,0)")
        + page.cast("decimal(12,0)") * F.lit(10**9).cast("decimal(10,0)")
        + pos.cast("decimal(9,0)")
    )
    return F.when(fits, digits.cast("decimal(38,0)")).otherwise(F.raise_error(F.lit("time or place out of range")).cast("decimal(38,0)"))


def latest_per_document(analyzed: DataFrame, columns: Sequence[str] = PAYLOAD_COLUMNS[1:]) -> DataFrame:
    """What a compacted topic keeps: the last row per document, with ``columns`` of it.

    Last is the largest time, then the largest place (``page_id``, ``pos``). It is found by one hash
    aggregate over two narrow columns, combined before the shuffle, so a document with very many
    rows is no problem; one join back fetches its columns. Equal rows are one. The rows are read twice:
    pass a stored table if they are dear.
    """
    order = _place(F.to_timestamp("crawled_at"), F.col("page_id"), F.col("pos"))
    rows = with_doc_id(analyzed).select("doc_id", "crawled_at", "page_id", "pos", *columns, order.alias("order"))
    last = rows.groupBy("doc_id").agg(F.max("order").alias("last"))
    found = rows.join(last, "doc_id").where(F.col("order") == F.col("last"))
    return found.drop("last").distinct().drop("order")
