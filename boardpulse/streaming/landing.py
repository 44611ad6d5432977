"""The jobs over two landing folders: each new file of list pages or post pages is used once.

Two streams run as one query: list pages, whose references are looked up in all post
pages that are there, and the URLs of new post pages. A reference without a page waits
in a state table until a page of its URL arrives, or until it has waited long enough.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boardpulse.config import BoardConfig, ScoringConfig
from boardpulse.operators.refs import REF_COLUMNS
from boardpulse.operators.scoring import Scorer
from boardpulse.plans.jobs import score_board, send_board
from boardpulse.sinks.ledger import send_once
from boardpulse.sinks.tables import children, exists, stored, write_table
from boardpulse.sources.landing import read_post_pages, stream_list_pages, stream_page_urls

_LISTS, _URLS = "list", "page"


def _waiting_before(spark: SparkSession, out: str, batch: int) -> DataFrame | None:
    """References that wait after the last batch before this one, with the batch they came in."""
    numbers = [int(name.removeprefix("batch=")) for name in children(spark, out) if name.startswith("batch=")]
    for number in sorted((n for n in numbers if n < batch), reverse=True):
        path = f"{out}/batch={number}/pending"
        if exists(spark, f"{path}/_SUCCESS"):
            return spark.read.parquet(path)
    return None


def without_repeats(lists: DataFrame, within: str) -> DataFrame:
    """A stream of list pages without those that came before with the same number, time and HTML."""
    keyed = lists.withColumns({"page_digest": F.md5("html"), "seen_at": F.coalesce("fetched_at", F.lit(0).cast("timestamp"))})
    marked = keyed.withWatermark("seen_at", within)
    once = marked.dropDuplicatesWithinWatermark(["board_id", "page_id", "url", "fetched_at", "page_digest"])
    return once.drop("page_digest", "seen_at")


def score_new_pages(
    spark: SparkSession,
    list_path: str,
    post_path: str,
    out: str,
    checkpoint: str,
    scorer: Scorer,
    scoring: ScoringConfig,
    send: Callable[[DataFrame], int] | None = None,
    config: BoardConfig = BoardConfig(),
    crawled_at: str | None = None,
    files_per_batch: int = 1_000,
    wait_batches: int | None = None,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Process everything that is new in the landing folders, then stop.

    Of a store a batch reads the files that can hold its references' URLs. A reference whose page
    is not there stands among the rejects of its batch and in ``pending``, the state after the
    batch. A later batch looks it up again if a page of its URL has arrived, with or without new
    list pages; other waiting references are not looked up. After ``wait_batches`` further batches
    one goes to ``expired``; without a number it waits on. A batch writes to its own folder
    ``out/batch=<n>``, reads only the state of the batch before, and replaces its folder when it is
    repeated after a failure, so the tables hold each reference once. With ``send`` the results also
    go out as messages, at least once; a batch whose delivery is in the ledger is not sent again.

    With ``repeats_within`` (such as ``"7 days"``) a list page that lands again as it was, whatever the
    file or batch, gives its references once. The state holds a digest per page for that long, by
    ``fetched_at``; a page later than that, or without a time, is not known to be a repeat.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        folder = f"{out}/batch={batch_id}"
        if repeats_within:
            batch = stored(batch, f"{folder}/landed")  # what has a state must not be run twice
        lists = batch.where(F.col("kind") == _LISTS).drop("kind")
        state, again = _waiting_before(session, out, batch_id), None
        if state is not None:
            # Written, so that the joins read plain exchanges: very many references may wait for one URL.
            come = stored(batch.where(F.col("kind") == _URLS).select("url").distinct(), f"{folder}/arrived")
            again = state.join(come, "url", "left_semi").select(*REF_COLUMNS)
            state = state.join(come, "url", "left_anti")
        settings = {"config": config, "crawled_at": crawled_at, "again": again}
        post_pages = read_post_pages(session, post_path)
        if send is None:
            result = score_board(lists, post_pages, folder, scorer, scoring, **settings)
        else:
            result = send_board(lists, post_pages, folder, scorer, scoring, send_once(send, f"{folder}/sent"), **settings)
        pending = result.pending.select(*REF_COLUMNS, F.lit(batch_id).alias("since"))
        if state is not None:
            over = F.lit(False) if wait_batches is None else F.col("since") <= batch_id - wait_batches
            write_table(state.where(over).select(*REF_COLUMNS), f"{folder}/expired")
            pending = pending.unionByName(state.where(~over))
        write_table(pending, f"{folder}/pending")

    lists = stream_list_pages(spark, list_path, files_per_batch)
    if repeats_within:
        lists = without_repeats(lists, repeats_within)
    lists = lists.withColumn("kind", F.lit(_LISTS))
    urls = stream_page_urls(spark, post_path, files_per_batch).withColumn("kind", F.lit(_URLS))
    both = lists.unionByName(urls, allowMissingColumns=True)
    writer = both.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_batches(spark: SparkSession, out: str, table: str, schema: str | None = None) -> DataFrame:
    """A table of all batches written so far, with the batch number.

    Before the first batch it is empty, if its ``schema`` is given.
    """
    path = f"{out}/batch=*/{table}"
    if schema is not None and not exists(spark, path):
        return spark.createDataFrame([], f"{schema}, batch INT")
    return spark.read.option("basePath", out).parquet(path)
