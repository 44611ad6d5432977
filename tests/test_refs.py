from boardpulse.config import SITE_ORIGIN, BoardConfig
from boardpulse.operators.refs import board_refs, list_rows, page_links, quarantine_of, unparsable_pages


def link(href, title="<span class='subject'>t</span>"):
    return f'<a href="{href}">{title}</a>'


def lists(spark, *pages):
    return spark.createDataFrame(list(pages), "board_id int, page_id bigint, html string")


def ids(refs):
    return [r["post_id"] for r in refs.orderBy("page_id", "pos").collect()]


def test_paths(spark):
    hrefs = {
        "/board/a/5558/1": 1,
        "board/a/5558/2?x=9": 2,
        "/x/board/a/5558/3/more": 3,
        "/board/a/5558/4abc": 4,
        "/board/a/5559/5": None,
        "/board/a/b/5558/6": None,
        "/list?u=/board/a/5558/7": None,
        "/staff/board/a/5558/8": None,
        "/staffx/board/a/5558/9": 9,
        "/a/../staff/board/a/5558/10": None,
        "/board/prevnext.php": None,
        "http://other.org/board/a/5558/11": 11,
        "javascript:go('/board/a/5558/12')": 12,
        "/board/a/5558/13;s=1": 13,
        "//[::1/board/a/5558/14": None,
        "/board/a/5558/1/board/a/5558/15": 1,
    }
    html = "".join(link(href) for href in hrefs)
    assert ids(board_refs(lists(spark, (5558, 1, html)))) == [n for n in hrefs.values() if n]


def test_huge_number_keeps_its_place(spark):
    html = link("/board/a/5558/99999999999999999999") + link("/board/a/5558/1")
    assert ids(board_refs(lists(spark, (5558, 1, html)))) == [None, 1]


def test_boards_and_titles(spark):
    strong = "<strong class='subject'>[질문]  제목</strong>"
    html = link("/board/a/5558/1", strong) + link("/board/a/5861/2") + link("/board/a/5861/3", strong)
    html += link("/board/a/7/4") + link("/board/a/5558/5", "<div class='subject'> </div>")
    found = board_refs(lists(spark, (5558, 1, html), (5861, 2, html), (7, 3, html)))
    rows = found.orderBy("page_id", "pos").collect()
    assert [tuple(r) for r in rows] == [
        (5558, 1, f"{SITE_ORIGIN}/board/a/5558/1", "제목", "질문", 1, 0),
        (5861, 2, f"{SITE_ORIGIN}/board/a/5861/2", "t", None, 2, 0),
    ]


def test_plain_layout(spark):
    html = link("/board/tea/5558/31", "green") + link("/board/tea/5558/32", "<i>[oolong]</i> steeped twice")
    pages = lists(spark, (5558, 1, html))
    assert ids(board_refs(pages)) == []
    found = board_refs(pages, BoardConfig(layouts={5558: ("a",)})).orderBy("pos").collect()
    assert [(r["post_id"], r["title"], r["category"]) for r in found] == [(31, "green", None), (32, "steeped twice", "oolong")]


def test_cap_counts_repeated_links(spark):
    html = link("/board/a/5558/1") * 3 + link("/board/a/5558/2")
    pages = lists(spark, (5558, 1, html), (5558, 2, html))
    assert ids(board_refs(pages, BoardConfig(max_posts=3))) == [1, 1, 1] * 2
    assert ids(board_refs(pages, BoardConfig(max_posts=99))) == [1, 1, 1, 2] * 2
    assert ids(board_refs(pages)) == [1, 1, 1, 2] * 2
    assert ids(board_refs(pages, BoardConfig(max_posts=0))) == []


def test_unparsable_pages(spark):
    pages = lists(spark, (5558, 1, link("/board/a/5558/1")), (5558, 2, "<p>x</p>"), (5558, 3, ""))
    assert sorted(r["page_id"] for r in unparsable_pages(pages).collect()) == [2, 3]
    rows = list_rows(pages, BoardConfig(max_posts=0))
    assert sorted(r["page_id"] for r in quarantine_of(rows).collect()) == [2, 3]


def test_page_links_keep_the_order(spark):
    pages = lists(spark, (5558, 1, link("b") + link(" a ") + "<a name='x'>y</a>"))
    assert [tuple(r) for r in page_links(pages).collect()] == [(1, 0, "b"), (1, 1, "a")]
