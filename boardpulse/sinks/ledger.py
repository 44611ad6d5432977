"""Ledger of what was sent: a batch that is run again after its delivery is not sent again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boardpulse.sinks.tables import exists, write_table

Send = Callable[[DataFrame], int]


def sent_before(spark: SparkSession, path: str) -> int | None:
    """Messages sent according to the entry at ``path``; none without a finished entry."""
    if not exists(spark, f"{path}/_SUCCESS"):
        return None
    return spark.read.schema("sent BIGINT").parquet(path).first()["sent"]


def send_once(send: Send, path: str) -> Send:
    """``send`` with an entry at ``path``, read before it and written after delivery.

    What fails before the entry is written is sent again as a whole, so delivery is still at least once;
    what fails later, such as the commit of a stream's batch, sends nothing again.
    """

    def wrapped(messages: DataFrame) -> int:
        spark = messages.sparkSession
        count = sent_before(spark, path)
        if count is None:
            count = send(messages)
            write_table(spark.createDataFrame([(count,)], "sent BIGINT").coalesce(1), path)
        return count

    return wrapped
