"""The three jobs: collect posts, score them, send them.

Every job works in its own output folder, which must be on storage shared by
the cluster. Intermediate results that are used more than once are written there
as tables, so lost executors cost at most the stage they were in, and running a
job again replaces what it had written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardpulse.config import TEXT_TITLE, BoardConfig, ScoringConfig
from boardpulse.operators.attach import PAGE_MISSING
from boardpulse.operators.messages import keyed_messages, payloads
from boardpulse.operators.posts import PAGE_FIELDS, looked_up, posts_of, rejects_of
from boardpulse.operators.refs import REF_COLUMNS, list_rows, quarantine_of, refs_of
from boardpulse.operators.scoring import (
    CONTENT_SUMS,
    Scorer,
    SumScorer,
    analyzed_posts,
    spread,
    sum_scorer,
    utc_now,
    with_content_sums,
)
from boardpulse.sinks.tables import count_rows, read_table, stored, write_measured, write_table
from boardpulse.sources.landing import PostStore, pages_for

ORDER = ("page_id", "pos")


@dataclass(frozen=True)
class JobResult:
    """Tables of a run and the rows counted at each stage."""

    rows: DataFrame
    rejects: DataFrame
    quarantine: DataFrame | None
    counters: dict[str, int]
    pending: DataFrame | None = None


@dataclass(frozen=True)
class _Collected:
    posts: DataFrame
    rejects: DataFrame
    quarantine: DataFrame | None
    refs: int
    pending: DataFrame


def run_counters(spark: SparkSession, counters: dict[str, int]) -> DataFrame:
    """Counters of a run as a table (stage, rows)."""
    return spark.createDataFrame(list(counters.items()), "stage string, rows bigint")


def _collect(
    list_pages: DataFrame,
    post_pages: DataFrame | PostStore,
    out: str,
    config: BoardConfig,
    keep_unparsable: bool,
    parse: bool = True,
    again: DataFrame | None = None,
    scorer: SumScorer | None = None,
    fields: Sequence[str] = PAGE_FIELDS,
) -> _Collected:
    """References, and their posts and rejects by one lookup. ``again`` are references of an earlier run.

    With ``scorer`` the content is summed with its page, and not for each post.
    """
    rows = list_rows(list_pages, config, keep_unparsable)
    count = write_measured(rows, f"{out}/list_rows", refs=F.count("pos"))["refs"]
    rows = read_table(rows, f"{out}/list_rows")
    refs = refs_of(rows)
    if again is not None:
        refs = stored(refs.unionByName(again.select(*REF_COLUMNS)), f"{out}/refs")
        count = refs.count()
    quarantine = stored(quarantine_of(rows), f"{out}/quarantine") if keep_unparsable else None
    more = None if scorer is None else lambda pages: with_content_sums(pages, scorer)
    fields = (*fields, CONTENT_SUMS) if scorer is not None else fields
    pages = pages_for(post_pages, refs)
    found = stored(looked_up(refs, pages, config, parse, refused=False, fields=fields, more=more), f"{out}/lookup")
    rejects = stored(rejects_of(found), f"{out}/rejects")
    pending = found.where(F.col("reason") == PAGE_MISSING).select(*REF_COLUMNS)
    return _Collected(posts_of(found), rejects, quarantine, count, pending)


def collect_posts(
    list_pages: DataFrame,
    post_pages: DataFrame | PostStore,
    out: str,
    config: BoardConfig = BoardConfig(),
    keep_unparsable: bool = True,
) -> JobResult:
    """Posts of the list pages, with rejects and unparsable list pages."""
    found = _collect(list_pages, post_pages, out, config, keep_unparsable)
    count = write_table(found.posts, f"{out}/posts")
    rows = read_table(found.posts, f"{out}/posts")
    return JobResult(rows, found.rejects, found.quarantine, {"refs": found.refs, "posts": count}, found.pending)


def _score(
    found: _Collected,
    out: str,
    scorer: Scorer,
    scoring: ScoringConfig,
    crawled_at: str | None,
    partitions: int | None,
    shape: Callable[[DataFrame], DataFrame],
) -> tuple[DataFrame, dict[str, int]]:
    """Score the posts and write ``shape`` of them, counting before and after."""
    posts = spread(found.posts, partitions) if partitions else found.posts
    posts, before = count_rows(posts)
    analyzed = shape(analyzed_posts(posts, scorer, scoring, crawled_at or utc_now(), keep=ORDER))
    after = write_table(analyzed, out)
    if before.get["rows"] != after:
        raise RuntimeError(f"scored {after} of {before.get['rows']} posts")
    counters = {"refs": found.refs, "posts": before.get["rows"], "analyzed": after}
    return read_table(analyzed, out), counters


def score_board(
    list_pages: DataFrame,
    post_pages: DataFrame | PostStore,
    out: str,
    scorer: Scorer,
    scoring: ScoringConfig,
    config: BoardConfig = BoardConfig(),
    again: DataFrame | None = None,
    crawled_at: str | None = None,
    partitions: int | None = None,
    keep_unparsable: bool = True,
) -> JobResult:
    """Analysed posts. Without posts the result is an empty table, and the
    model is not loaded."""
    found = _collect(
        list_pages, post_pages, out, config, keep_unparsable, again=again, scorer=sum_scorer(scorer, scoring)
    )
    rows, counters = _score(
        found, f"{out}/analyzed", scorer, scoring, crawled_at, partitions, lambda df: df
    )
    return JobResult(rows, found.rejects, found.quarantine, counters, found.pending)


def send_board(
    list_pages: DataFrame,
    post_pages: DataFrame | PostStore,
    out: str,
    scorer: Scorer,
    scoring: ScoringConfig,
    send: Callable[[DataFrame], int],
    config: BoardConfig = BoardConfig(),
    again: DataFrame | None = None,
    crawled_at: str | None = None,
    partitions: int | None = None,
) -> JobResult:
    """Analysed posts as messages. ``send`` takes (key, value) and gives the
    number sent; it is not called when there are no posts.

    The payloads are written first, so a failed delivery can be repeated
    without scoring again, and only the fields that are sent are computed: with
    the title as text the content of the pages is never parsed, and where the
    scorer sums it with its page it is not moved to the posts.
    """
    parse, sums = scoring.text_used != TEXT_TITLE, sum_scorer(scorer, scoring)
    fields = PAGE_FIELDS if sums is None else ()
    found = _collect(
        list_pages, post_pages, out, config, keep_unparsable=False, parse=parse, again=again, scorer=sums, fields=fields
    )
    rows, counters = _score(
        found,
        f"{out}/payloads",
        scorer,
        scoring,
        crawled_at,
        partitions,
        lambda df: payloads(df, keep=ORDER),
    )
    counters["sent"] = send(keyed_messages(rows)) if counters["analyzed"] else 0
    return JobResult(rows, found.rejects, found.quarantine, counters, found.pending)
