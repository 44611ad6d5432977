"""Post pages to posts: date, author and content from the visible lines."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardpulse.config import (
    AUTHOR_MAX_CHARS,
    DATE_PATTERN,
    FOOTER_LINES,
    HEADER_LINES,
    MINUTES_PATTERN,
    SECONDS_PATTERN,
    VIEWS_PREFIX,
    VOTES_PREFIX,
    BoardConfig,
)
from boardpulse.functions.markup import visible_lines
from boardpulse.functions.text import WS_CLASS
from boardpulse.operators.attach import attached, refused_reason, salted_urls, with_references, with_salts
from boardpulse.sources.landing import latest_rows

_MINUTES = f"\\b{DATE_PATTERN}{WS_CLASS}+{MINUTES_PATTERN}"

POST_COLUMNS = (
    "board_id",
    "post_id",
    "url",
    "title",
    "category",
    "author",
    "created_at",
    "content",
    "page_id",
    "pos",
)

PAGE_FIELDS = ("author", "created_at", "content")


def created_at(lines: Column, seconds: bool = False) -> Column:
    """The first date and time in the header lines, as written."""
    pattern = f"(?U){_MINUTES}(?:{SECONDS_PATTERN})?\\b" if seconds else f"(?U){_MINUTES}\\b"
    found = F.transform(F.slice(lines, 1, HEADER_LINES), lambda line: F.regexp_extract(line, pattern, 0))
    return F.get(F.filter(found, lambda date: date != ""), F.lit(0))


def author(lines: Column) -> Column:
    """The line before the first "views" line whose predecessor is short enough."""
    header = F.slice(lines, 1, HEADER_LINES)

    def candidate(line: Column, i: Column) -> Column:
        before = F.get(lines, i - 1)
        fits = line.startswith(VIEWS_PREFIX) & (F.length(before) <= AUTHOR_MAX_CHARS)
        return F.when((i > 0) & fits, before)

    return F.get(F.array_compact(F.transform(header, candidate)), F.lit(0))


def body_lines(lines: Column, created: Column) -> Column:
    """Lines after the one that equals the date (else from the first line on),
    up to the first footer line."""
    start = F.coalesce(F.array_position(lines, created), F.lit(0)).cast("int")
    rest = F.slice(lines, start + 1, F.greatest(F.size(lines), F.lit(0)))
    stops = F.array_compact(
        F.array(*[F.nullif(F.array_position(rest, F.lit(word)), F.lit(0)) for word in FOOTER_LINES])
    )
    end = F.coalesce(F.array_min(stops).cast("int") - 1, F.size(rest))
    return F.slice(rest, F.lit(1), F.greatest(end, F.lit(0)))


def content(lines: Column, created: Column) -> Column:
    """The body without counter lines, joined by line breaks."""
    kept = F.filter(
        body_lines(lines, created),
        lambda line: ~line.startswith(VIEWS_PREFIX) & ~line.startswith(VOTES_PREFIX),
    )
    return F.array_join(kept, "\n")


def parse_lines(df: DataFrame, config: BoardConfig = BoardConfig()) -> DataFrame:
    """Add author, created_at and content to a frame with ``lines``.

    One column per step, so that the lines and the date are computed once, and
    columns that are not used later are not computed at all.
    """
    return (
        df.withColumn("created_at", created_at(F.col("lines"), config.created_at_seconds))
        .withColumn("author", author(F.col("lines")))
        .withColumn("content", content(F.col("lines"), F.col("created_at")))
        .drop("lines")
    )


def parsed_pages(
    post_pages: DataFrame,
    config: BoardConfig = BoardConfig(),
    hot: DataFrame | None = None,
    fields: Sequence[str] = PAGE_FIELDS,
    more: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The newest snapshot of each URL, parsed: (url, author, created_at, content), or ``fields``.

    Pages are parsed where they are read, so no HTML is shuffled or sorted. Of several
    snapshots of the same time the one whose HTML has the largest hash counts. With ``hot``
    each page is there once for each ``salt`` of its URL, and placed by both. ``more`` adds columns to
    parsed pages, a row each; they are in the result if they are among ``fields``.
    """
    lines = post_pages.withColumns({"lines": visible_lines(F.col("html")), "html_hash": F.xxhash64("html")}).drop("html")
    parsed, keys = parse_lines(lines, config), ["url"]
    if more is not None:
        parsed = more(parsed)
    if hot is not None:
        parsed, keys = with_salts(parsed, hot), ["url", "salt"]
    return latest_rows(parsed, fields, F.col("html_hash"), keys)


def looked_up(
    refs: DataFrame,
    post_pages: DataFrame,
    config: BoardConfig = BoardConfig(),
    parse: bool = True,
    rows_per_salt: int | None = None,
    refused: bool = True,
    fields: Sequence[str] = PAGE_FIELDS,
    more: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """All references with the fields of their page, and the reason why one gives no post.

    ``reason`` is NULL for posts; the title is the reference's. Without
    ``parse`` only the presence of the page counts, and its fields are NULL; without ``refused``
    they are NULL where there is a reason, and refused references are not moved to the join. Pages without a reference
    are neither parsed nor moved, nor are, without ``refused``, those that only refused references have. Of the parsed pages only
    ``fields`` are moved, among them columns that ``more`` adds; others of a post are NULL.
    """
    count = refs.count()
    usable = refs if refused else refs.where(refused_reason(config).isNull())
    hot = salted_urls(usable, rows_per_salt, count)
    wanted = with_references(post_pages, usable, count)
    fields = tuple(fields) if parse else ()
    if parse:
        pages = parsed_pages(wanted, config, hot, fields, more)
    else:
        pages = with_salts(wanted.select("url"), hot).distinct()
    found = attached(usable, pages, hot, config)
    if not refused:
        others = refs.withColumn("reason", refused_reason(config)).where("reason IS NOT NULL")
        found = found.unionByName(others, allowMissingColumns=True)
    found = found.withColumns({n: F.lit(None).cast("string") for n in PAGE_FIELDS if n not in fields})
    return found.select(*POST_COLUMNS, *(n for n in fields if n not in POST_COLUMNS), "reason")


def posts_of(found: DataFrame) -> DataFrame:
    """The posts among the rows of :func:`looked_up`."""
    return found.where("reason IS NULL").drop("reason")


def rejects_of(found: DataFrame) -> DataFrame:
    """The references that give no post: (url, post_id, reason)."""
    return found.where("reason IS NOT NULL").select("url", "post_id", "reason")


def board_posts(
    refs: DataFrame,
    post_pages: DataFrame,
    config: BoardConfig = BoardConfig(),
    rows_per_salt: int | None = None,
) -> DataFrame:
    """Posts of all usable references whose page is there."""
    return posts_of(looked_up(refs, post_pages, config, rows_per_salt=rows_per_salt, refused=False))


def rejected_refs(
    refs: DataFrame,
    post_pages: DataFrame,
    config: BoardConfig = BoardConfig(),
    rows_per_salt: int | None = None,
) -> DataFrame:
    """References that give no post; only URLs are compared, so no HTML is read."""
    return rejects_of(looked_up(refs, post_pages, config, parse=False, rows_per_salt=rows_per_salt, refused=False))
