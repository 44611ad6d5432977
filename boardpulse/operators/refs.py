"""List pages to post references.

All references of a page are built as one array per row, so filtering and the
cap need no shuffle; rows multiply only at the very end.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardpulse.config import DISALLOWED_PATHS, DISALLOWED_PREFIX, BoardConfig
from boardpulse.functions.markup import anchors, subject_title, title_tag
from boardpulse.functions.text import let, split_category
from boardpulse.functions.urls import absolute_url, clean_url, split_url, url_path

REF_COLUMNS = ("board_id", "post_id", "url", "title", "category", "page_id", "pos")


def page_links(pages: DataFrame) -> DataFrame:
    """Links of each page: (page_id, pos, href), in document order from 0."""
    links = anchors(F.col("html")).getField("href")
    return pages.select("page_id", F.posexplode(links).alias("pos", "href"))


def is_disallowed(path: Column) -> Column:
    """True for paths that must not be followed."""
    return path.isin(*DISALLOWED_PATHS) | path.startswith(DISALLOWED_PREFIX)


def post_digits(path: Column, board_id: Column) -> Column:
    """Digits of the first post path of this board; empty if there is none."""
    pattern = F.concat(F.lit("(?U)/board/[^/]+/"), board_id.cast("string"), F.lit("/(\\d+)"))
    return F.call_function("regexp_extract", path, pattern, F.lit(1))


def list_title(inner: Column, board_id: Column, layouts: dict[int, tuple[str, ...]]) -> Column:
    """Raw title of an anchor by the layout of its board; NULL for other boards."""
    tag = F.lit(None).cast("string")
    for board, tags in layouts.items():
        tag = F.when(board_id == board, title_tag(inner, tags)).otherwise(tag)
    return let(tag, lambda name: subject_title(inner, name))


def ref_array(html: Column, board_id: Column, config: BoardConfig) -> Column:
    """All references of a page in document order, before the cap, as
    ARRAY<STRUCT<post_id, url, title, category>>.

    Each step adds one field to the elements, cheap tests come before the
    title. A post path contains "board", so other links are dropped unresolved.
    A number too large for BIGINT gives a reference without post_id.
    """
    links = F.transform(
        anchors(html),
        lambda a: F.struct(a.inner.alias("inner"), a.href.alias("href"), clean_url(a.href).alias("clean")),
    )
    links = F.filter(links, lambda a: F.contains(a.clean, F.lit("board")))
    links = F.transform(
        links, lambda a: F.struct(a.inner.alias("inner"), split_url(a.href, a.clean).alias("parts"))
    )
    links = F.transform(
        links,
        lambda a: F.struct(a.inner.alias("inner"), absolute_url(a.parts, config.origin).alias("url")),
    )
    links = F.transform(
        F.filter(links, lambda a: a.url.isNotNull()),
        lambda a: F.struct(a.inner.alias("inner"), a.url.alias("url"), url_path(a.url).alias("path")),
    )
    links = F.filter(links, lambda a: ~is_disallowed(a.path))
    links = F.transform(
        links,
        lambda a: F.struct(
            a.inner.alias("inner"), a.url.alias("url"), post_digits(a.path, board_id).alias("digits")
        ),
    )
    links = F.filter(links, lambda a: a.digits != "")
    links = F.transform(
        links,
        lambda a: F.struct(
            a.digits.try_cast("bigint").alias("post_id"),
            a.url.alias("url"),
            list_title(a.inner, board_id, config.layouts).alias("title_raw"),
        ),
    )
    links = F.filter(links, lambda a: a.title_raw != "")
    links = F.transform(
        links,
        lambda a: F.struct(
            a.post_id.alias("post_id"), a.url.alias("url"), split_category(a.title_raw).alias("parts")
        ),
    )
    return F.transform(
        links,
        lambda a: F.struct(
            a.post_id.alias("post_id"),
            a.url.alias("url"),
            a.parts.title.alias("title"),
            a.parts.category.alias("category"),
        ),
    )


def list_rows(
    list_pages: DataFrame, config: BoardConfig = BoardConfig(), keep_unparsable: bool = True
) -> DataFrame:
    """References of all list pages, at most ``config.max_posts`` per page if
    given, and one row without ``pos`` for a page that gives none.

    A page without a single reference before the cap keeps its HTML in
    ``unparsable_html``, so one pass over the pages serves both results. A post
    linked twice counts twice. ``pos`` is the place on the page.
    """
    refs = ref_array(F.col("html"), F.col("board_id"), config)
    none_found = F.coalesce(F.size("refs"), F.lit(0)) <= 0
    capped = F.col("refs") if config.max_posts is None else F.slice("refs", 1, config.max_posts)
    rows = list_pages.withColumn("refs", refs).select(
        "board_id",
        "page_id",
        F.when(none_found & F.lit(keep_unparsable), F.col("html")).alias("unparsable_html"),
        F.posexplode_outer(capped).alias("pos", "ref"),
    )
    return rows.select(
        "board_id",
        "ref.post_id",
        "ref.url",
        "ref.title",
        "ref.category",
        "page_id",
        "pos",
        "unparsable_html",
    )


def refs_of(rows: DataFrame) -> DataFrame:
    """The references among the rows of :func:`list_rows`."""
    return rows.where("pos IS NOT NULL").select(*REF_COLUMNS)


def quarantine_of(rows: DataFrame, condition: str = "unparsable_html IS NOT NULL") -> DataFrame:
    """The list pages without a single reference, to be kept for inspection."""
    pages = rows.where(condition)
    return pages.select("board_id", "page_id", F.col("unparsable_html").alias("html"))


def board_refs(list_pages: DataFrame, config: BoardConfig = BoardConfig()) -> DataFrame:
    """References of all list pages, at most ``config.max_posts`` per page if given."""
    return refs_of(list_rows(list_pages, config, keep_unparsable=False))


def unparsable_pages(list_pages: DataFrame, config: BoardConfig = BoardConfig()) -> DataFrame:
    """List pages without a single reference."""
    # With a cap above zero, the rows without a place are exactly these pages.
    return quarantine_of(list_rows(list_pages, replace(config, max_posts=1)), "pos IS NULL")
