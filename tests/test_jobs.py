from datetime import datetime

import pytest

from boardpulse.config import ANALYZED_COLUMNS, SITE_ORIGIN, ScoringConfig
from boardpulse.operators.messages import payloads
from boardpulse.operators.scoring import analyzed_posts, batch_scorer
from boardpulse.operators.weights import TokenWeights, learn_weights
from boardpulse.plans.jobs import collect_posts, run_counters, score_board, send_board
from boardpulse.sinks.tables import write_table
from boardpulse.sources.landing import LIST_PAGES, POST_PAGES, read_list_pages, read_post_pages, write_post_pages
from boardpulse.streaming.landing import read_batches, score_new_pages
from stand_in import stand_in_scorer

TITLES = ScoringConfig("m-1")
AT = "2026-02-01T00:00:00+00:00"


def list_html(numbers):
    return "".join(
        f'<a href="/board/a/5558/{n}"><span class="subject">[c] title {n}</span></a>' for n in numbers
    )


def write_landing(spark, folder, pages, mode="overwrite"):
    lists = [(5558, page, "u", list_html(numbers), None) for page, numbers in pages.items()]
    spark.createDataFrame(lists, LIST_PAGES).coalesce(1).write.mode(mode).parquet(f"{folder}/lists")
    posts = [(f"{SITE_ORIGIN}/board/a/5558/{n}", f"<p>me<p>조회: 1<p>text {n}", None) for n in range(20)]
    spark.createDataFrame(posts, POST_PAGES).write.mode("overwrite").parquet(f"{folder}/posts")


@pytest.fixture
def landing(spark, tmp_path):
    folder = str(tmp_path)
    write_landing(spark, folder, {1: [1, 2, 99], 2: [], 3: [2, 3, 2]})
    return folder


@pytest.fixture
def load_nothing():
    # A local function, so that it travels to the workers by value.
    def load(config):
        raise AssertionError("the model must not be loaded")

    return batch_scorer(load, TITLES)


def tables(spark, folder):
    return read_list_pages(spark, f"{folder}/lists"), read_post_pages(spark, f"{folder}/posts")


def test_collect(spark, landing):
    result = collect_posts(*tables(spark, landing), f"{landing}/out")
    assert result.counters == {"refs": 6, "posts": 5}
    assert [tuple(r) for r in result.rejects.collect()] == [(f"{SITE_ORIGIN}/board/a/5558/99", 99, "page_missing")]
    assert [r["page_id"] for r in result.quarantine.collect()] == [2]
    rows = result.rows.orderBy("page_id", "pos").collect()
    assert [(r["post_id"], r["title"], r["category"], r["author"]) for r in rows] == [
        (n, f"title {n}", "c", "me") for n in (1, 2, 2, 3, 2)
    ]
    assert run_counters(spark, result.counters).orderBy("stage").collect() == [("posts", 5), ("refs", 6)]


def test_running_again_replaces_the_results(spark, landing):
    for _ in range(2):
        result = collect_posts(*tables(spark, landing), f"{landing}/out", keep_unparsable=False)
        assert result.rows.count() == 5 and result.rejects.count() == 1
        assert result.quarantine is None


def test_score(spark, landing):
    result = score_board(*tables(spark, landing), f"{landing}/out", stand_in_scorer, TITLES, crawled_at=AT, partitions=3)
    assert result.counters == {"refs": 6, "posts": 5, "analyzed": 5}
    assert result.rows.columns == [*ANALYZED_COLUMNS, "page_id", "pos"]
    assert {r["crawled_at"] for r in result.rows.collect()} == {AT}


def test_no_posts(spark, tmp_path, load_nothing):
    folder = str(tmp_path)
    write_landing(spark, folder, {1: [77], 2: []})
    result = score_board(*tables(spark, folder), f"{folder}/out", load_nothing, TITLES)
    assert result.rows.collect() == [] and result.rows.columns == [*ANALYZED_COLUMNS, "page_id", "pos"]

    def send(messages):
        raise AssertionError("nothing to send")

    result = send_board(*tables(spark, folder), f"{folder}/out", load_nothing, TITLES, send)
    assert result.counters == {"refs": 1, "posts": 0, "analyzed": 0, "sent": 0}


def test_send(spark, landing):
    result = send_board(
        *tables(spark, landing),
        f"{landing}/out",
        stand_in_scorer,
        ScoringConfig("m-1", text_used="title+content"),
        send=lambda m: write_table(m, f"{landing}/messages"),
    )
    assert result.counters == {"refs": 6, "posts": 5, "analyzed": 5, "sent": 5}
    keys = [r["key"] for r in spark.read.parquet(f"{landing}/messages").selectExpr("string(key) key").collect()]
    assert sorted(keys) == ["5558:1", "5558:2", "5558:2", "5558:2", "5558:3"]


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_stream_equals_batch(spark, landing):
    def run():
        query = score_new_pages(
            spark,
            f"{landing}/lists",
            f"{landing}/posts",
            f"{landing}/out",
            f"{landing}/checkpoint",
            stand_in_scorer,
            TITLES,
            crawled_at=AT,
            files_per_batch=1,
        )
        query.awaitTermination()

    def batch():
        result = score_board(*tables(spark, landing), f"{landing}/batch", stand_in_scorer, TITLES, crawled_at=AT)
        return result.rows

    run()
    assert rows(read_batches(spark, f"{landing}/out", "analyzed").drop("batch")) == rows(batch())
    run()  # nothing new
    assert read_batches(spark, f"{landing}/out", "analyzed").count() == 5
    write_landing(spark, landing, {4: [5, 6], 5: [7]}, mode="append")
    run()
    found = read_batches(spark, f"{landing}/out", "analyzed")
    assert found.select("batch").distinct().count() == 2
    assert rows(found.drop("batch")) == rows(batch())


def write_pages(spark, folder, numbers, store):
    """Post pages that arrive: a file of a plain folder, or a batch of a store."""
    rows = [(f"{SITE_ORIGIN}/board/a/5558/{n}", f"<p>me<p>조회: 1<p>text {n}", None) for n in numbers]
    frame = spark.createDataFrame(rows, POST_PAGES)
    if store:
        write_post_pages(frame, f"{folder}/pages", range_bytes=40)
    else:
        frame.write.mode("append").parquet(f"{folder}/pages")


def land(spark, folder, pages, at="2026-02-01 00:00:00"):
    rows = [(5558, page, "u", list_html(numbers), datetime.fromisoformat(at)) for page, numbers in pages.items()]
    spark.createDataFrame(rows, LIST_PAGES).coalesce(1).write.mode("append").parquet(f"{folder}/lists")


def stream(spark, folder, **more):
    paths = (f"{folder}/lists", f"{folder}/pages", f"{folder}/out", f"{folder}/checkpoint")
    score_new_pages(spark, *paths, stand_in_scorer, TITLES, crawled_at=AT, **more).awaitTermination()


def found_posts(spark, folder, table="analyzed"):
    return sorted(r["post_id"] for r in read_batches(spark, f"{folder}/out", table).collect())


@pytest.mark.parametrize("store", [False, True])
def test_a_late_page_alone_wakes_its_references(spark, tmp_path, store):
    folder = str(tmp_path)
    land(spark, folder, {1: [1, 2, 3], 2: [3]})
    write_pages(spark, folder, [1], store)
    stream(spark, folder)
    assert found_posts(spark, folder) == [1]
    write_pages(spark, folder, [3, 9], store)  # no new list page
    stream(spark, folder)
    assert found_posts(spark, folder) == [1, 3, 3]
    land(spark, folder, {3: [9, 2]})
    stream(spark, folder)
    assert found_posts(spark, folder) == [1, 3, 3, 9]
    write_pages(spark, folder, [2], store)
    stream(spark, folder)
    assert found_posts(spark, folder) == [1, 2, 2, 3, 3, 9]
    pending = spark.read.parquet(f"{folder}/out/batch=3/pending")
    assert pending.count() == 0 and "since" in pending.columns
    batch = score_board(read_list_pages(spark, f"{folder}/lists"), read_post_pages(spark, f"{folder}/pages"), f"{folder}/all", stand_in_scorer, TITLES, crawled_at=AT)
    assert rows(read_batches(spark, f"{folder}/out", "analyzed").drop("batch")) == rows(batch.rows)


def test_references_stop_waiting(spark, tmp_path):
    folder = str(tmp_path)
    land(spark, folder, {1: [1]})
    for batch, numbers in enumerate(([7], [8], [9], [1])):
        write_pages(spark, folder, numbers, True)
        stream(spark, folder, wait_batches=2)
    assert found_posts(spark, folder) == []
    assert found_posts(spark, folder, "expired") == [1]
    assert spark.read.parquet(f"{folder}/out/batch=2/expired").count() == 1


def test_a_list_page_that_lands_again_counts_once(spark, tmp_path):
    folder = str(tmp_path)
    write_pages(spark, folder, range(9), True)
    more = {"repeats_within": "7 days"}
    land(spark, folder, {1: [1, 2, 1], 2: [3]})
    land(spark, folder, {1: [1, 2, 1]})
    stream(spark, folder, **more)
    land(spark, folder, {1: [1, 2, 1], 3: [4]})
    stream(spark, folder, **more)
    assert found_posts(spark, folder) == [1, 1, 2, 3, 4]  # links repeated on one page stay
    land(spark, folder, {1: [1, 5]})  # changed
    land(spark, folder, {2: [3]}, at="2026-02-02 00:00:00")  # fetched again
    stream(spark, folder, **more)
    assert found_posts(spark, folder) == [1, 1, 1, 2, 3, 3, 4, 5]


def test_a_batch_that_was_delivered_is_not_sent_again(spark, tmp_path):
    folder, topic, calls = str(tmp_path), [], []
    land(spark, folder, {1: [1, 2]})
    write_pages(spark, folder, [1, 2], True)

    def send(messages):
        calls.append(messages.count())
        if len(calls) == 1:
            raise RuntimeError("the broker is away")
        messages.write.mode("append").parquet(f"{folder}/topic")
        return calls[-1]

    with pytest.raises(Exception, match="broker"):
        stream(spark, folder, send=send)
    stream(spark, folder, send=send)
    assert calls == [2, 2] and spark.read.parquet(f"{folder}/topic").count() == 2
    # Delivered, but the stream did not get to note the batch as done.
    for name in ("0", ".0.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    stream(spark, folder, send=send)
    assert calls == [2, 2] and spark.read.parquet(f"{folder}/topic").count() == 2


def test_stream_sends(spark, landing):
    sent = []
    query = score_new_pages(
        spark,
        f"{landing}/lists",
        f"{landing}/posts",
        f"{landing}/out",
        f"{landing}/checkpoint",
        stand_in_scorer,
        TITLES,
        send=lambda m: sent.append(m.count()) or sent[-1],
    )
    query.awaitTermination()
    assert sent == [5]


def test_no_batch_yet(spark, tmp_path):
    assert read_batches(spark, str(tmp_path), "analyzed", "url STRING").columns == ["url", "batch"]
    assert read_batches(spark, str(tmp_path), "analyzed", "url STRING").collect() == []


def test_tables_are_packed(spark, tmp_path):
    """Repeated texts, such as the content of a post with several references, hardly grow a table."""
    frame = spark.range(0, 2000, 1, 1).selectExpr("id", "concat_ws(' ', transform(sequence(1, 400), i -> xxhash64(id, i))) AS text")
    write_table(frame, f"{tmp_path}/packed")
    frame.write.option("compression", "snappy").parquet(f"{tmp_path}/plain")
    size = {n: sum(f.stat().st_size for f in (tmp_path / n).glob("*.parquet")) for n in ("packed", "plain")}
    assert size["packed"] < 0.7 * size["plain"]
    assert rows(spark.read.parquet(f"{tmp_path}/packed")) == rows(frame)


def test_contents_are_summed_with_their_page(spark, landing):
    """A page with several references has its content read by the scorer once; what is only sent does not carry it."""
    both = ScoringConfig("m-1", text_used="title+content")
    weights = learn_weights(spark.createDataFrame([("title 2", "pos"), ("text 1", "neg")], "text string, label string"), f"{landing}/weights")
    read: list[str] = []

    class Watched(TokenWeights):
        def sums(self, frame, text, name):
            read.append(text)
            return super().sums(frame, text, name)

    scorer = Watched(weights.table)
    scored = score_board(*tables(spark, landing), f"{landing}/a", scorer, both, crawled_at=AT)
    collected = collect_posts(*tables(spark, landing), f"{landing}/b").rows
    assert rows(scored.rows) == rows(analyzed_posts(collected, weights, both, AT, keep=("page_id", "pos")))
    sent = send_board(*tables(spark, landing), f"{landing}/c", scorer, both, lambda m: m.count(), crawled_at=AT)
    assert rows(sent.rows) == rows(payloads(scored.rows, keep=("page_id", "pos")))
    assert read == ["shown_content", "shown_title"] * 2
    assert {r["content"] for r in spark.read.parquet(f"{landing}/c/lookup").collect()} == {None}
    assert rows(sent.rejects) == rows(scored.rejects) and rows(sent.pending) == rows(scored.pending)
