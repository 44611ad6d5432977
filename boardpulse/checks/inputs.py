"""A board made from the given tables.

Every document is a list page, with one anchor per text line behind a pinned
one, and also a post page, with author and date from the event of the same
number. Anchor i of page n links to post n + i. The style of a link, of a title
and of a post page depends on the numbers, so that every rule is met often; the
pinned post is linked from every page and therefore a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardpulse.config import ALLOWED_HOSTS, SITE_ORIGIN

LIST_FETCHED = "2026-02-01 00:00:00"
OLD_FETCHED = "2026-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def escape(text: Column) -> Column:
    for char, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(reference))
    return text


def board_of(number: Column) -> Column:
    """Board of a page or post: two with a layout, one without."""
    return (
        F.when(number % 7 == 3, 5861).when(number % 11 == 5, 1234).otherwise(5558).cast("int")
    )


def text_of(number: Column) -> Column:
    return number.cast("string")


def href_of(post: Column) -> Column:
    """Link to a post, in one of eight styles."""
    place = F.concat(text_of(board_of(post)), F.lit("/"), text_of(post))
    www, bare = ALLOWED_HOSTS[1], ALLOWED_HOSTS[2]
    styles = [
        F.concat(F.lit("/board/free/"), place, F.lit("?p=1&q=2")),
        F.concat(F.lit(f"https://{www}/board/free/"), place),
        F.concat(F.lit(f"//{bare}/board/free/"), place, F.lit("#c")),
        F.concat(F.lit("../board/./free/"), place),
        F.concat(F.lit("http://other.example.com/board/free/"), place),
        F.concat(F.lit("/board/prevnext.php?idx="), text_of(post)),
        F.concat(F.lit("/staff/board/free/"), place),
        F.concat(F.lit("/board/free/"), text_of(board_of(post)), F.lit("/list?post="), text_of(post)),
    ]
    return _choose(post, styles)


def url_of(post: Column) -> Column:
    """What the link of :func:`href_of` must resolve to."""
    place = F.concat(text_of(board_of(post)), F.lit("/"), text_of(post))
    host = {n: f"https://{name}" for n, name in enumerate(ALLOWED_HOSTS)}
    return _choose(
        post,
        [
            F.concat(F.lit(f"{SITE_ORIGIN}/board/free/"), place, F.lit("?p=1&q=2")),
            F.concat(F.lit(f"{host[1]}/board/free/"), place),
            F.concat(F.lit(f"{host[2]}/board/free/"), place, F.lit("#c")),
            F.concat(F.lit(f"{SITE_ORIGIN}/board/free/"), place),
            F.concat(F.lit("http://other.example.com/board/free/"), place),
            F.concat(F.lit(f"{SITE_ORIGIN}/board/prevnext.php?idx="), text_of(post)),
            F.concat(F.lit(f"{SITE_ORIGIN}/staff/board/free/"), place),
            F.concat(
                F.lit(f"{SITE_ORIGIN}/board/free/"),
                text_of(board_of(post)),
                F.lit("/list?post="),
                text_of(post),
            ),
        ],
    )


def _choose(number: Column, options: Sequence[Column]) -> Column:
    chosen = options[-1]
    for n, option in enumerate(options[:-1]):
        chosen = F.when(number % len(options) == n, option).otherwise(chosen)
    return chosen


def document_links(documents: DataFrame) -> DataFrame:
    """One link per text line: (page_id, i, href)."""
    return documents.select(
        F.col("doc_id").alias("page_id"), F.posexplode(F.split("text", "\n")).alias("i", "line")
    ).select("page_id", "i", href_of(F.col("page_id") + F.col("i")).alias("href"))


def _anchor(href: Column, title: Column) -> Column:
    return F.concat(F.lit('<li><a class="row" href="'), escape(href), F.lit('">'), title, F.lit("</a></li>"))


def _subject(tag: str, text: Column) -> Column:
    return F.concat(F.lit(f'<i>7</i><{tag} class="subject">'), text, F.lit(f"</{tag}><em>3</em>"))


def list_pages(documents: DataFrame) -> DataFrame:
    page = F.col("doc_id")

    def anchor(line: Column, i: Column) -> Column:
        marked = F.concat(F.lit("["), F.col("lang"), F.lit("] "), line)
        text = escape(F.when(i % 5 == 0, marked).otherwise(line))
        nested = F.concat(F.lit("<strong>["), F.col("lang"), F.lit("]</strong> "), escape(line))
        title = _choose(
            i,
            [_subject("strong", text), _subject("span", text), _subject("div", text), _subject("strong", nested)],
        )
        return _anchor(href_of(page + i), title)

    pinned = _anchor(href_of(F.lit(0).cast("bigint")), _subject("strong", F.lit("notice")))
    rows = F.array_join(F.transform(F.split("text", "\n"), anchor), "\n")
    return documents.select(
        board_of(page).alias("board_id"),
        page.alias("page_id"),
        F.concat(F.lit(f"{SITE_ORIGIN}/board/free/"), text_of(board_of(page))).alias("url"),
        F.concat(
            F.lit("<html><head><title>list</title></head><body><!-- <a href='/old'>old</a> --><ul>"),
            pinned,
            rows,
            F.lit("</ul></body></html>"),
        ).alias("html"),
        F.lit(LIST_FETCHED).cast("timestamp").alias("fetched_at"),
    )


def _div(text: Column) -> Column:
    return F.concat(F.lit("<div>"), text, F.lit("</div>"))


def post_pages(documents: DataFrame, events: DataFrame) -> DataFrame:
    """Two snapshots of each post page, the older one without content."""
    number = F.col("doc_id")
    user, views = text_of(F.col("user_id")), F.concat(F.lit("조회: "), text_of(F.col("n_chars")))
    name = F.concat(F.lit("user"), user)
    minutes, seconds = F.date_format("ts", "yyyy-MM-dd HH:mm"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    long_name = F.concat(F.lit("a very long name of user "), user)
    votes, footer = F.lit("추천: 3"), [F.lit("목록"), F.lit("below")]
    body = F.array_join(F.transform(F.split("text", "\n"), lambda line: _div(escape(line))), "\n")

    def page(head: Sequence[Column], tail: Sequence[Column]) -> Column:
        return F.concat(
            F.lit("<html><head><title>post</title><script>var a='<p>';</script></head><body>"),
            *[_div(part) for part in head],
            body,
            *[_div(part) for part in tail],
            F.lit("</body></html>"),
        )

    newest = _choose(
        number,
        [
            page([name, views, minutes], [votes, *footer]),
            page([name, views, seconds], [votes, *footer]),
            page([long_name, views, minutes], [F.lit("short"), views, *footer]),
            page([views, minutes, votes], []),
        ],
    )
    # Each document has the event of its number; the other events give pages of their own, with one body line.
    joined = events.join(documents, documents.doc_id == events.event_id, "left").withColumns(
        {
            "doc_id": F.col("event_id"),
            "text": F.coalesce("text", F.col("event_type")),
            "n_chars": F.coalesce("n_chars", F.lit(0).cast("bigint")),
        }
    )
    old = F.struct(F.lit("<p>old</p>").alias("html"), F.lit(OLD_FETCHED).cast("timestamp").alias("fetched_at"))
    new = F.struct(newest.alias("html"), F.lit(LIST_FETCHED).cast("timestamp").alias("fetched_at"))
    return joined.select(url_of(number).alias("url"), F.inline(F.array(old, new)))


def document_posts(documents: DataFrame) -> DataFrame:
    """Documents as posts: the first line is the title, the rest the content."""
    number = F.col("doc_id")
    return documents.select(
        F.lit(5558).alias("board_id"),
        number.alias("post_id"),
        F.concat(F.lit(f"{SITE_ORIGIN}/board/free/5558/"), text_of(number)).alias("url"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.lit(None).cast("string").alias("category"),
        F.col("source").alias("author"),
        F.lit(None).cast("string").alias("created_at"),
        F.substring(
            F.col("text"), F.length(F.substring_index("text", "\n", 1)) + 2, F.length("text")
        ).alias("content"),
        number.alias("page_id"),
        F.lit(0).alias("pos"),
    )
