from datetime import datetime

from helpers import apply
from pyspark.sql import functions as F

from boardpulse.config import BoardConfig
from boardpulse.functions.markup import visible_lines
from boardpulse.operators.posts import author, content, created_at, looked_up, parse_lines

LINES = "array<string>"
REFS = "board_id int, post_id bigint, url string, title string, category string, page_id bigint, pos int"
DATE = "2031-11-05 07:09"


def fields(spark, cases):
    def parts(lines):
        date = created_at(lines)
        return F.struct(date.alias("d"), author(lines).alias("a"), content(lines, date).alias("c"))

    return [tuple(r) for r in apply(spark, cases, parts, LINES)]


def test_created_at(spark):
    cases = {
        f"on {DATE} here": DATE,
        f"{DATE}:48": DATE,
        "2031-11-05  07:09": "2031-11-05  07:09",
        "2031-11-05　07:09": "2031-11-05　07:09",
        f"한{DATE}": None,
        f"{DATE}1": None,
        f"{DATE}_": None,
        f"({DATE})": DATE,
        "1931-11-05 07:09": None,
        f"x{DATE} {DATE}": DATE,
    }
    assert apply(spark, [[line] for line in cases], created_at, LINES) == list(cases.values())
    late = [["x"] * 119 + [DATE], ["x"] * 120 + [DATE], [], [DATE, "2027-01-28 07:09"]]
    assert apply(spark, late, created_at, LINES) == [DATE, None, None, DATE]
    seconds = apply(spark, [[f"{DATE}:48"], [DATE]], lambda c: created_at(c, seconds=True), LINES)
    assert seconds == [f"{DATE}:48", DATE]


def test_author(spark):
    views = "조회: 3"
    cases = [
        ([views], None),
        ([views, views], views),
        (["한" * 20, views], "한" * 20),
        (["한" * 21, views], None),
        (["한" * 21, views, "me", views, "you", views], "me"),
        (["a"] + ["x"] * 118 + [views], "x"),
        (["x"] * 120 + [views], None),
        ([], None),
    ]
    assert apply(spark, [c[0] for c in cases], author, LINES) == [c[1] for c in cases]


def test_content(spark):
    cases = [
        ([DATE], ""),
        ([f"x {DATE}", "b"], f"x {DATE}\nb"),
        (["a", DATE, "b", "조회: 1", "추천: 2", "추천합니다", "c"], "b\n추천합니다\nc"),
        (["a", "목록", DATE, "b", "댓글쓰기", "c", "댓글보기"], "b"),
        (["a", "목록", "b"], "a"),
        (["댓글보기 x", "b"], "댓글보기 x\nb"),
        (["목록"], ""),
        ([], ""),
        ([DATE, "a", DATE, "b"], f"a\n{DATE}\nb"),
        ([f"on {DATE}"] + ["x"] * 130 + [DATE, "b"], "b"),
    ]
    assert [c for _, _, c in fields(spark, [c[0] for c in cases])] == [c[1] for c in cases]


def test_fields_of_whole_pages(spark):
    """Cases written out: lines, then date, author and content."""
    long = "l" * 21
    cases = [
        (["head", "me", "조회: 1", DATE, "a", "추천: 1", "목록", "b"], (DATE, "me", "a")),
        (["head", long, "조회: 1", f"at {DATE}:11", "a"], (DATE, None, f"head\n{long}\nat {DATE}:11\na")),
        (["조회: 1", DATE, "조회: 2", "a", "댓글쓰기"], (DATE, DATE, "a")),
        (["a", "b"], (None, None, "a\nb")),
        (["목록", "a", DATE, "b", "댓글보기", "c"], (DATE, None, "b")),
        ([DATE, DATE, "x"], (DATE, None, f"{DATE}\nx")),
        (["x"] * 121 + [DATE, "b", "목록"], (None, None, "\n".join(["x"] * 121 + [DATE, "b"]))),
        (["추천: 9", "조회: 9", "me", "조회: 9"], (None, "추천: 9", "me")),
    ]
    assert fields(spark, [c[0] for c in cases]) == [c[1] for c in cases]


def test_seconds_belong_to_the_date_if_wanted(spark):
    html = """<html><body><h1>Rain on Sunday</h1><p>gardener</p><p>조회: 7</p><p>2031-11-05 07:09:33</p>
      <p>It poured.</p><p>Nothing else happened.</p></body></html>"""
    pages = spark.createDataFrame([(html,)], "html string").select(visible_lines("html").alias("lines"))
    row = parse_lines(pages).first()
    assert (row["created_at"], row["author"]) == (DATE, "gardener")
    assert row["content"] == "Rain on Sunday\ngardener\n2031-11-05 07:09:33\nIt poured.\nNothing else happened."
    row = parse_lines(pages, BoardConfig(created_at_seconds=True)).first()
    assert (row["created_at"], row["content"]) == ("2031-11-05 07:09:33", "It poured.\nNothing else happened.")


def test_pages_are_moved_once(spark, tmp_path):
    """One exchange of parsed pages serves the newest snapshot, ties and the lookup, and times are read without HTML."""
    rows = [
        ("u", "<p>old</p>", datetime(2026, 1, 1)),
        ("u", "<p>new</p>", datetime(2026, 2, 1)),
        ("u", "<p>new</p>", datetime(2026, 2, 1)),
        ("v", "<p>none</p>", None),
        (None, "<p>x</p>", None),
    ]
    pages = f"{tmp_path}/pages"
    spark.createDataFrame(rows, "url string, html string, fetched_at timestamp").write.parquet(pages)
    refs = spark.createDataFrame([(5558, n, u, "t", None, 1, n) for n, u in enumerate(["u", "u", "v", "w", None])], REFS)
    limits = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in limits}
    try:
        for name, value in limits.items():
            spark.conf.set(name, value)
        found = looked_up(refs, spark.read.parquet(pages))
        plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
        got = sorted((r["post_id"], r["content"]) for r in found.collect())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == [(0, "new"), (1, "new"), (2, "none"), (3, None), (4, None)]
    assert sum("Exchange hashpartitioning(url" in line for line in plan) == 3  # references, pages, newest times
    scans = [line for line in plan if "FileScan parquet" in line]
    assert len(scans) == 2 and sum("html" in line.split("Batched")[0] for line in scans) == 1


def test_rejects_have_no_fields(spark):
    """What a page holds is kept for posts alone."""
    ok, other = "https://m.inven.co.kr/board/a/5558/1", "https://other.org/board/a/5558/2"
    pages = spark.createDataFrame([(u, "<p>text</p>", None) for u in (ok, other)], "url string, html string, fetched_at timestamp")
    refs = spark.createDataFrame([(5558, 1, ok, "t", None, 1, 0), (5558, 2, other, "t", None, 1, 1), (5558, None, ok, "t", None, 1, 2)], REFS)
    found = sorted(tuple(r) for r in looked_up(refs, pages, refused=False).select("pos", "content", "reason").collect())
    assert found == [(0, "text", None), (1, None, "host_not_allowed"), (2, None, "bad_post_id")]


def rows_moved(node):
    """Rows that the exchanges of an executed plan wrote, by the columns they deal by."""
    found = [(node.simpleString(9), node.metrics().apply("shuffleRecordsWritten").value())] if node.nodeName() == "Exchange" else []
    return found + [x for k in range(node.children().size()) for x in rows_moved(node.children().apply(k))]


def test_refused_references_are_not_moved(spark):
    """They have no use for a page, so they do not go to the join with the pages, and stay as they are."""
    urls = [f"https://m.inven.co.kr/board/a/5558/{n}" for n in range(3)]
    rows = [(5558, n, u, f"t{n}", "c", 1, n) for n, u in enumerate([*urls, None])] + [(5558, 9, "https://other.org/board/a/5558/9", "t", None, 2, n) for n in range(50)]
    refs = spark.createDataFrame([*rows, *[(5558, None, urls[0], "t", None, 3, n) for n in range(50)]], REFS)
    pages = spark.createDataFrame([(u, "<p>text</p>", None) for u in urls[:2]], "url string, html string, fetched_at timestamp")
    limits = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in limits}
    try:
        for name, value in limits.items():
            spark.conf.set(name, value)
        found = looked_up(refs, pages, refused=False)
        got = sorted((r["page_id"], r["pos"], r["title"], r["content"], r["reason"]) for r in found.collect())
        moved = rows_moved(found._jdf.queryExecution().executedPlan())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got[:4] == [(1, 0, "t0", "text", None), (1, 1, "t1", "text", None), (1, 2, "t2", None, "page_missing"), (1, 3, "t3", None, "page_missing")]
    assert got[4:] == [(k, n, "t", None, reason) for k, reason in ((2, "host_not_allowed"), (3, "bad_post_id")) for n in range(50)]
    assert max(n for name, n in moved if "salt" in name) == 4
