from collections import Counter

import pytest
from pyspark.sql import functions as F

from boardpulse.config import ALLOWED_HOSTS, SITE_ORIGIN, BoardConfig
from boardpulse.operators.attach import MOST_HOT_URLS, hot_urls, is_allowed_url, maybe_among, with_references
from boardpulse.operators.posts import board_posts, parsed_pages, rejected_refs
from boardpulse.sources.landing import PostStore, latest_rows, pages_for, read_post_pages, write_post_pages
from helpers import apply

REFS = "board_id int, post_id bigint, url string, title string, category string, page_id bigint, pos int"
PAGES = "url string, html string, fetched_at int"


def url(n):
    return f"{SITE_ORIGIN}/board/a/5558/{n}"


@pytest.fixture(scope="module")
def refs(spark):
    """Post 0 is linked from every page, post 1 from every second one."""
    rows = []
    for page in range(300):
        posts = [0, 1] if page % 2 else [0]
        for pos, n in enumerate([*posts, page, page]):
            rows.append((5558, n, url(n), f"t{page}-{pos}", None, page, pos))
    rows.append((5558, 7, "https://other.org/board/a/5558/7", "t", None, 300, 0))
    rows.append((5558, None, url(8), "t", None, 300, 1))
    return spark.createDataFrame(rows, REFS)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(url(n), f"<p>text {n}</p>", 2) for n in range(250)]
    rows += [(url(0), f"<p>old {k}</p>", 1) for k in range(200)]
    return spark.createDataFrame(rows, PAGES)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_hosts(spark):
    host = ALLOWED_HOSTS[0]
    urls = {f"https://{name}/x": True for name in ALLOWED_HOSTS} | {
        f"https://{host}": True,
        f"https://{host}?x": True,
        f"https://{host.upper()}/x": False,
        f"https://{host}:443/x": False,
        f"https://{host}.other.org/x": False,
        f"https://u@{host}/x": False,
        f"javascript:{host}": False,
    }
    assert apply(spark, list(urls), is_allowed_url) == list(urls.values())


def test_newest_snapshot(spark):
    rows = [("a", "1", 1), ("a", "3", 3), ("a", "2", 2), ("b", "x", None), ("b", "y", 0), ("c", "p", 1), ("c", "q", 1), ("d", "n", None)]
    pages = spark.createDataFrame(rows, PAGES)
    assert rows_of(latest_rows(pages, ["html"])) == Counter({("a", "3"): 1, ("b", "y"): 1, ("c", "q"): 1, ("d", "n"): 1})


def test_posts_and_rejects_are_all_references(refs, pages):
    posts, rejects = board_posts(refs, pages), rejected_refs(refs, pages)
    assert posts.count() + rejects.count() == refs.count()
    reasons = Counter(r["reason"] for r in rejects.collect())
    assert reasons == {"page_missing": 100, "host_not_allowed": 1, "bad_post_id": 1}
    assert {r["content"] for r in posts.where("post_id = 0").collect()} == {"text 0"}


def test_hot_urls(refs):
    found = {r["url"]: r["salts"] for r in hot_urls(refs, 100).collect()}
    assert found == {url(0): 4, url(1): 2}


def test_hot_urls_among_very_many(spark):
    """More URLs than a sketch tracks: none of the hot ones is missed, no count is too low, and no URL is moved."""
    n = 600_000
    made = spark.range(n).repartition(6).selectExpr("CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 100 = 1 THEN 'b' WHEN id % 2000 = 2 THEN 'c' ELSE concat('u', id) END url")
    exact = {r["url"]: r["count"] for r in made.groupBy("url").count().where("count > 60").collect()}
    assert len(exact) == 3
    found = {r["url"]: r["salts"] for r in hot_urls(made, n // MOST_HOT_URLS).collect()}
    assert set(exact) <= set(found) and all(found[u] >= -(-k // 60) for u, k in exact.items())
    assert "hashpartitioning(url" not in plan(hot_urls(made, 60))
    assert hot_urls(made.limit(0), 60).collect() == []


@pytest.mark.parametrize("rows_per_salt", [1, 20, 1000])
def test_split_urls_give_the_same_rows(refs, pages, rows_per_salt):
    others = pages.where(pages.url != url(0))
    for some in (pages, others):
        assert rows_of(board_posts(refs, some, rows_per_salt=rows_per_salt)) == rows_of(board_posts(refs, some))
        assert rows_of(rejected_refs(refs, some, rows_per_salt=rows_per_salt)) == rows_of(rejected_refs(refs, some))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_read(spark, pages, tmp_path):
    pages.write.parquet(f"{tmp_path}/pages")
    stored = spark.read.parquet(f"{tmp_path}/pages")
    assert "html" in plan(parsed_pages(stored))
    parsed = parsed_pages(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [url" in parsed


def test_no_html_is_shuffled_or_sorted(spark, refs, pages, tmp_path):
    pages.write.parquet(f"{tmp_path}/p")
    shown = plan(board_posts(refs, spark.read.parquet(f"{tmp_path}/p")))
    moved = [x for x in shown.splitlines() if "Exchange" in x or " Sort " in x or "SortAggregate" in x]
    assert moved and not any("html#" in x for x in moved)
    assert "SortAggregate" not in shown


def with_times(pages):
    return pages.withColumn("fetched_at", pages.fetched_at.cast("timestamp"))


def test_store_gives_the_same_posts(spark, refs, pages, tmp_path):
    write_post_pages(with_times(pages), f"{tmp_path}/store", range_bytes=600)
    store = read_post_pages(spark, f"{tmp_path}/store")
    few = refs.where("post_id < 2")
    some = pages_for(store, few)
    assert 0 < some.count() < pages.count()
    assert rows_of(board_posts(few, some)) == rows_of(board_posts(few, pages))
    assert rows_of(store.pages().drop("fetched_at")) == rows_of(pages.drop("fetched_at"))
    assert isinstance(store, PostStore) and store.pages_for(refs.where("false")).count() == 0


def test_a_batch_reads_only_files_that_can_hold_it(spark, tmp_path):
    """Files by ranges as the bytes ask for; those read are those whose ranges meet a hash, as a full comparison says."""
    made = spark.range(20_000).selectExpr("concat('https://h/', id) url", "repeat('x', 100) html", "timestamp_seconds(id % 7) fetched_at")
    for size, part in ((1 << 16, "url < 'https://h/4'"), (1 << 14, "url >= 'https://h/4' AND url < 'https://h/6'"), (1 << 30, "url >= 'https://h/6'")):
        write_post_pages(made.where(part).limit(10**9), f"{tmp_path}/store", range_bytes=size)
    store = PostStore(spark, f"{tmp_path}/store")
    index = store.index().collect()
    assert len(index) > 30
    for urls in (made.where("url LIKE '%77'"), made.limit(3), made.where("url = 'https://h/9'"), made.limit(0)):
        hashes = [r[0] for r in urls.selectExpr("xxhash64(url)").collect()]
        expected = {(r["folder"], r["file"]) for r in index if any(r["low"] <= h <= r["high"] for h in hashes)}
        assert {tuple(r) for r in store.files_for(urls).collect()} == expected
        assert len(hashes) > 20 or len(expected) < len(index)
        assert store.pages_for(urls).join(urls.select("url"), "url", "left_semi").count() == urls.count()


def test_store_of_nothing_and_of_one_url(spark, tmp_path):
    empty = spark.createDataFrame([], "url string, html string, fetched_at timestamp")
    write_post_pages(empty, f"{tmp_path}/a")
    assert read_post_pages(spark, f"{tmp_path}/a").pages().collect() == []
    same = spark.range(500).selectExpr("'u' url", "if(id % 9 = 0, null, 'x') html", "timestamp_seconds(id) fetched_at")
    write_post_pages(same.union(spark.createDataFrame([(None, None, None)], empty.schema)), f"{tmp_path}/b", range_bytes=50)
    store = PostStore(spark, f"{tmp_path}/b")
    assert store.index().count() > 3  # snapshots of one URL are dealt by time
    assert store.pages_for(same.select("url")).where("url = 'u'").count() == 500 and store.pages().count() == 501


def test_snapshots_of_the_same_time(spark):
    """One of several, the same however they are dealt; equal ones are one; times are compared to the microsecond."""
    rows = [("a", f"<p>{k % 5}</p>", 7) for k in range(50)] + [("b", "x", None), ("b", "y", None)]
    pages = spark.createDataFrame(rows, PAGES)
    found = [rows_of(latest_rows(pages.repartition(n), ["html"])) for n in (1, 5, 9)]
    assert found[0] == found[1] == found[2] and sum(found[0].values()) == 2
    near = spark.createDataFrame([("a", "old"), ("a", "new")], "url string, html string").selectExpr("url", "html", "timestamp_micros(if(html = 'old', -1, 0) + 1700000000000001) fetched_at")
    assert rows_of(latest_rows(near, ["html"])) == Counter({("a", "new"): 1})


def test_other_hosts_by_configuration(spark, pages):
    refs = spark.createDataFrame([(1, 7, "https://x.org/7", "t", None, 1, 0)], REFS)
    pages = spark.createDataFrame([("https://x.org/7", "<p>x</p>", 1)], PAGES)
    config = BoardConfig(allowed_hosts=("x.org",))
    assert board_posts(refs, pages, config).count() == 1
    assert board_posts(refs, pages).count() == 0


def test_a_store_has_files_for_all_cores(spark, tmp_path):
    """Pages of one large file's size are dealt over more of them, as the cores ask for; few bytes are not."""
    made = spark.range(4_000).selectExpr("concat('https://h/', id) url", "repeat('x', 100) html", "timestamp_seconds(id % 7) fetched_at")
    cores = spark.sparkContext.defaultParallelism
    for least, files in ((1 << 12, 4 * cores), (1 << 30, 1)):
        write_post_pages(made, f"{tmp_path}/{least}", least_bytes=least)
        store = PostStore(spark, f"{tmp_path}/{least}")
        assert 0.8 * files <= store.index().count() <= files and store.pages().count() == 4_000


@pytest.mark.parametrize("count", [0, 300, 100_000])
def test_filter_misses_no_key(spark, count):
    keys = spark.range(0, 3 * count, 3).select(F.concat(F.lit("u"), "id").alias("k"))
    tried = spark.range(300_000).select("id", F.concat(F.lit("u"), "id").alias("k")).unionAll(spark.sql("SELECT 0L, NULL"))
    passed = tried.where(maybe_among(F.col("k"), keys, count))
    found = {r[0]: r[1] for r in passed.groupBy(F.expr(f"k IS NOT NULL AND id % 3 = 0 AND id < {3 * count}")).count().collect()}
    assert found.get(True, 0) == count and found.get(False, 0) < 0.1 * (300_001 - count)


def test_pages_without_references_are_left_out(spark, refs, pages):
    """Neither parsed nor moved are pages that no reference has."""
    many = pages.unionAll(spark.range(1000, 20_000).selectExpr("concat('https://m.inven.co.kr/x/', id)", "'<p>x</p>'", "1"))
    many = many.unionAll(spark.createDataFrame([(None, "<p>x</p>", 1)], PAGES))
    kept = rows_of(with_references(many, refs, refs.count()))
    assert all(kept[row] == n for row, n in rows_of(pages).items()) and sum(kept.values()) < pages.count() + 500
    assert rows_of(board_posts(refs, many)) == rows_of(board_posts(refs, pages))
    assert rows_of(rejected_refs(refs, many)) == rows_of(rejected_refs(refs, pages))
