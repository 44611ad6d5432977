"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardpulse.checks.inputs import (
    OLD_FETCHED,
    board_of,
    document_links,
    document_posts,
    list_pages,
    post_pages,
    table,
)
from boardpulse.config import PAYLOAD_COLUMNS, SITE_ORIGIN, TEXT_TITLE, TEXT_TITLE_CONTENT, BoardConfig, ScoringConfig
from boardpulse.functions.markup import anchors, visible_lines
from boardpulse.functions.sentiment import model_text
from boardpulse.functions.text import split_category
from boardpulse.functions.urls import absolute_url, clean_url, split_url, url_authority, url_path
from boardpulse.operators.attach import is_allowed_url, maybe_among
from boardpulse.operators.messages import keyed_messages, latest_per_document, payloads
from boardpulse.operators.posts import board_posts, parsed_pages, rejected_refs
from boardpulse.operators.refs import (
    board_refs,
    is_disallowed,
    list_title,
    page_links,
    post_digits,
    unparsable_pages,
)
from boardpulse.operators.samples import analyzed_sample, payload_sample, post_sample
from boardpulse.operators.scoring import Predict, Scorer, add_sentiment, analyzed_posts, batch_scorer, score_posts
from boardpulse.plans.jobs import ORDER, JobResult, collect_posts, run_counters, score_board, send_board
from boardpulse.operators.weights import learn_weights, token_buckets
from boardpulse.sinks.tables import run_folder, stored, write_table
from boardpulse.sources.landing import PostStore, latest_rows, write_post_pages
from boardpulse.streaming.landing import read_batches, score_new_pages

Query = Callable[[SparkSession, str], DataFrame]

MODEL = "token-weights-1"
TITLES = ScoringConfig(MODEL)
BOTH_TEXTS = ScoringConfig(MODEL, text_used=TEXT_TITLE_CONTENT)
SHORT_TEXTS = ScoringConfig("letters-1", text_used=TEXT_TITLE_CONTENT, max_length=40)
CRAWLED_AT = "2026-02-01T00:00:00.000000+00:00"
EARLIER = "2026-01-01T00:00:00.000000+00:00"


def flat_probs(df: DataFrame) -> DataFrame:
    """Probabilities as rounded columns, which compare well across engines."""
    rounded = {f"prob_{name}": F.round(F.col(f"sentiment_probs.{name}"), 6) for name in ("neg", "neu", "pos")}
    return df.withColumns(
        rounded | {"sentiment_score": F.round("sentiment_score", 6)}
    ).drop("sentiment_probs")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_pages(_documents(spark, sf_dir))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post_pages(_documents(spark, sf_dir), table(spark, sf_dir, "events"))


# --- list pages -------------------------------------------------------------


def q_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(_pages(spark, sf_dir))


def q_resolved_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = document_links(_documents(spark, sf_dir))
    found = q_page_links(spark, sf_dir).withColumnRenamed("pos", "i")
    links = made.unionByName(found).withColumn("parts", split_url(F.col("href"), clean_url(F.col("href"))))
    return links.select("page_id", "i", "href", absolute_url(F.col("parts"), SITE_ORIGIN).alias("url"))


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_resolved_links(spark, sf_dir).withColumn("path", url_path(F.col("url")))


def q_allowed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls(spark, sf_dir).select(
        "page_id",
        "i",
        "path",
        url_authority(F.col("url")).alias("authority"),
        is_disallowed(F.col("path")).alias("disallowed"),
        is_allowed_url(F.col("url")).alias("host_allowed"),
    )


def q_post_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = post_digits(F.col("path"), board_of(F.col("page_id")))
    return _urls(spark, sf_dir).select(
        "page_id", "i", F.nullif(digits, F.lit("")).try_cast("bigint").alias("post_id")
    )


def q_list_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = _lists(spark, sf_dir).select(
        "board_id", "page_id", F.posexplode(anchors(F.col("html"))).alias("pos", "a")
    )
    title = list_title(F.col("a.inner"), F.col("board_id"), BoardConfig().layouts)
    return links.select("board_id", "page_id", "pos", title.alias("title_raw"))


def q_split_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of each document, with its source or language in brackets before it."""
    raw = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("["), "source", F.lit("]"), "line")).otherwise(
        F.concat(F.lit("["), "lang", F.lit("]  "), "line")
    )
    lines = _documents(spark, sf_dir).select(
        "doc_id", "source", "lang", F.posexplode(F.split("text", "\n")).alias("i", "line")
    )
    return lines.withColumn("parts", split_category(raw)).select("doc_id", "i", "parts.category", "parts.title")


def q_board_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board_refs(_lists(spark, sf_dir))


def q_refs_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board_refs(_lists(spark, sf_dir), BoardConfig(max_posts=30))


def q_list_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unparsable_pages(_lists(spark, sf_dir)).select(
        "board_id", "page_id", F.contains("html", F.lit("<title>list</title>")).alias("is_list")
    )


# --- post pages -------------------------------------------------------------


def q_latest_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = _posts(spark, sf_dir).withColumn("is_old", F.contains("html", F.lit("old</p>"))).drop("html")
    return latest_rows(marked, ["is_old"])


def q_visible_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    return pages.select("page_id", F.posexplode(visible_lines(F.col("html"))).alias("pos", "line"))


def q_post_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_pages(_posts(spark, sf_dir))


def q_post_fields_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_pages(_posts(spark, sf_dir), BoardConfig(created_at_seconds=True))


def _stored_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References stored first, as the jobs do, as a lookup reads them several times."""
    return stored(board_refs(_lists(spark, sf_dir)), run_folder(spark, "refs"))


def q_ref_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_refs(_stored_refs(spark, sf_dir), _posts(spark, sf_dir))


def q_board_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board_posts(_stored_refs(spark, sf_dir), _posts(spark, sf_dir))


def q_board_posts_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup with the pinned post split over many tasks."""
    return board_posts(_stored_refs(spark, sf_dir), _posts(spark, sf_dir), rows_per_salt=50)


# --- sentiment --------------------------------------------------------------


def _model_text(spark: SparkSession, sf_dir: str, text_used: str) -> DataFrame:
    posts = document_posts(_documents(spark, sf_dir))
    text = model_text(F.col("title"), F.col("content"), text_used)
    return posts.select("post_id", text.alias("model_text"))


def q_model_text_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _model_text(spark, sf_dir, TEXT_TITLE)


def q_model_text_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _model_text(spark, sf_dir, TEXT_TITLE_CONTENT)


def _scorer(spark: SparkSession, sf_dir: str) -> Scorer:
    """Weights learnt from all labelled documents: bad ones against toxic and other good ones."""
    label = F.when(F.col("quality") == 0, "neg").when(F.col("toxic") == 1, "neu").otherwise("pos")
    labels = table(spark, sf_dir, "labels").select("doc_id", label.alias("label"))
    # Texts without a label are left out before the join moves any.
    documents = _documents(spark, sf_dir).where(maybe_among(F.col("doc_id"), labels.select("doc_id").where("doc_id IS NOT NULL"), labels.count()))
    # The join moves the numbers of the tokens' buckets in place of the texts.
    buckets = documents.select("doc_id", token_buckets(F.col("text")).alias("buckets"))
    return learn_weights(buckets.join(labels, "doc_id"), run_folder(spark, "weights"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, turns of conversations, and a blank text for each conversation."""
    documents = _documents(spark, sf_dir).select(
        F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("part"), "text"
    )
    talk = table(spark, sf_dir, "conversations").select(
        F.lit("turn").alias("kind"),
        F.col("conv_id").alias("id"),
        F.col("turn").alias("part"),
        "text",
    )
    blank = talk.select(F.lit("blank").alias("kind"), "id").distinct().select("kind", "id", F.lit(0).cast("bigint").alias("part"), F.lit("  \n").alias("text"))
    return _scorer(spark, sf_dir)(documents.unionByName(talk).unionByName(blank), "text")


def q_sentiment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_probs(add_sentiment(_texts(spark, sf_dir), "text", "logits")).drop("text", "logits")


def q_sentiment_neutral_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_probs(add_sentiment(_texts(spark, sf_dir), "text", "logits", 0.6)).drop("text", "logits")


def q_batch_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_posts(document_posts(_documents(spark, sf_dir)), _scorer(spark, sf_dir), BOTH_TEXTS)
    return flat_probs(scored).select(
        "post_id", "sentiment_label", "sentiment_score", "prob_neg", "prob_neu", "prob_pos"
    )


def _load_letters(config: ScoringConfig) -> Predict:
    """In place of a network: outputs by the letters that a batch shows."""

    def predict(texts: Sequence[str]) -> list[list[int]]:
        return [[len(t) % 5, t.count("e") % 5, t.count(" ") % 4] for t in texts]

    return predict


def q_model_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caller's model over all documents in Arrow batches, each text cut to what the model sees."""
    posts = document_posts(_documents(spark, sf_dir))
    scored = score_posts(posts, batch_scorer(_load_letters, SHORT_TEXTS), SHORT_TEXTS)
    return flat_probs(scored).select(
        "post_id", "sentiment_label", "sentiment_score", "prob_neg", "prob_neu", "prob_pos"
    )


def _analyzed(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = document_posts(_documents(spark, sf_dir))
    return analyzed_posts(posts, _scorer(spark, sf_dir), BOTH_TEXTS, CRAWLED_AT, keep=ORDER)


def q_analyzed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_probs(_analyzed(spark, sf_dir)).drop(*ORDER)


# --- messages and reports ---------------------------------------------------


def _opened(messages: DataFrame, payload: DataFrame) -> DataFrame:
    """Messages with their JSON parsed again."""
    schema = payload.select(*PAYLOAD_COLUMNS).schema
    opened = messages.select(F.col("key").cast("string").alias("key"), F.from_json("value", schema).alias("v"))
    return flat_probs(opened.select("key", "v.*"))


def q_kafka_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = payloads(_analyzed(spark, sf_dir))
    return _opened(keyed_messages(payload), payload)


def q_post_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post_sample(document_posts(_documents(spark, sf_dir)))


def q_analyzed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_probs(analyzed_sample(_analyzed(spark, sf_dir)))


def q_payload_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_probs(payload_sample(payloads(_analyzed(spark, sf_dir), keep=ORDER)))


def q_latest_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over all documents, the later one with each of them on two pages."""
    later = stored(_analyzed(spark, sf_dir), run_folder(spark, "analyzed"))
    earlier = later.withColumn("crawled_at", F.lit(EARLIER))
    again = later.withColumn("page_id", F.col("page_id") + 1).withColumn("sentiment_label", F.lit("neu"))
    both = earlier.unionByName(later).unionByName(again)
    return latest_per_document(both, ["sentiment_label"]).select("doc_id", "crawled_at", "page_id", "sentiment_label")


# --- jobs -------------------------------------------------------------------


def _reasons(result: JobResult) -> DataFrame:
    """Rejects and quarantine of a job in one table: (kind, what, id, reason)."""
    rejects = result.rejects.select(F.lit("reject").alias("kind"), F.col("url").alias("what"), F.col("post_id").alias("id"), "reason")
    if result.quarantine is None:
        return rejects
    kept = result.quarantine.select(
        F.lit("quarantine"), F.col("board_id").cast("string"), "page_id", F.md5("html").alias("reason")
    )
    return rejects.union(kept)


def _collected(spark: SparkSession, sf_dir: str) -> JobResult:
    return collect_posts(_lists(spark, sf_dir), _posts(spark, sf_dir), run_folder(spark, "collect"))


def _scored(spark: SparkSession, sf_dir: str) -> JobResult:
    scorer = _scorer(spark, sf_dir)
    out = run_folder(spark, "score")
    return score_board(_lists(spark, sf_dir), _posts(spark, sf_dir), out, scorer, BOTH_TEXTS, crawled_at=CRAWLED_AT)


def _sent(spark: SparkSession, sf_dir: str, scoring: ScoringConfig) -> tuple[JobResult, str]:
    """The job that sends, with a table in place of the topic."""
    out = run_folder(spark, "send")
    result = send_board(
        _lists(spark, sf_dir),
        _posts(spark, sf_dir),
        out,
        _scorer(spark, sf_dir),
        scoring,
        send=lambda messages: write_table(messages, f"{out}/messages"),
        crawled_at=CRAWLED_AT,
    )
    return result, f"{out}/messages"


def q_collect_posts_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collected(spark, sf_dir).rows


def q_collect_posts_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(_collected(spark, sf_dir)).withColumn("reason", F.when(F.col("kind") == "reject", F.col("reason")))


def q_score_board_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_probs(_scored(spark, sf_dir).rows)


def q_score_board_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(_scored(spark, sf_dir)).withColumn("reason", F.when(F.col("kind") == "reject", F.col("reason")))


def q_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_counters(spark, _sent(spark, sf_dir, TITLES)[0].counters)


def q_sent_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sending job delivers: keys, and the values opened again."""
    result, place = _sent(spark, sf_dir, BOTH_TEXTS)
    return _opened(spark.read.parquet(place), result.rows)


def _stored_pages(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    return stored(_posts(spark, sf_dir), f"{folder}/made")


def q_store_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which pages a store filled in two batches has for the URLs of all references, each time of them once."""
    folder = run_folder(spark, "store")
    pages, refs = _stored_pages(spark, sf_dir, folder), stored(board_refs(_lists(spark, sf_dir)).select("url"), f"{folder}/urls")
    for old in (True, False):
        write_post_pages(pages.where((F.col("fetched_at") == OLD_FETCHED) == old), f"{folder}/store", range_bytes=1 << 20)
    store = PostStore(spark, f"{folder}/store")
    wanted = refs.distinct()
    return store.pages_for(wanted).join(wanted, "url").select("url", F.date_format("fetched_at", "yyyy-MM-dd").alias("day"))


def q_once_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of list pages over a store, and a third without any, in which a fifth of the post pages come late."""
    folder = run_folder(spark, "landing")
    lists, posts, out = f"{folder}/list_pages", f"{folder}/post_pages", f"{folder}/out"
    every, scorer = _lists(spark, sf_dir), _scorer(spark, sf_dir)
    pages = _stored_pages(spark, sf_dir, folder)
    late = F.crc32("url") % 5 == 0
    for batch, new in enumerate((~late, None, late)):
        if batch < 2:
            every.where(F.col("page_id") % 2 == batch).write.mode("append").parquet(lists)
        if new is not None:
            write_post_pages(pages.where(new), posts)
        score_new_pages(
            spark, lists, posts, out, f"{folder}/checkpoint", scorer, BOTH_TEXTS, crawled_at=CRAWLED_AT
        ).awaitTermination()
    return flat_probs(read_batches(spark, out, "analyzed").drop("batch"))


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): query for name, query in list(globals().items()) if name.startswith("q_")
}
