import itertools
import math
import zlib
from datetime import datetime

import pytest
from helpers import apply
from pyspark.sql import functions as F

from boardpulse.checks import queries
from boardpulse.config import ANALYZED_COLUMNS, ScoringConfig
from boardpulse.functions.sentiment import model_text, sentiment_label, softmax
from boardpulse.operators.scoring import (
    add_sentiment,
    analyzed_posts,
    batch_scorer,
    first_words,
    score_posts,
    spread,
    sum_scorer,
    utc_now,
    with_content_sums,
)
from boardpulse.operators.weights import learn_weights
from stand_in import stand_in, stand_in_scorer

POSTS = (
    "board_id int, post_id bigint, url string, title string, category string, author string, "
    "created_at string, content string, page_id bigint, pos int"
)
BOTH = ScoringConfig("m-1", text_used="title+content")


def posts(spark, *texts):
    rows = [(5558, n, "u", t, "c", "a", None, c, 1, n) for n, (t, c) in enumerate(texts)]
    return spark.createDataFrame(rows, POSTS)


def test_model_text(spark):
    cases = [
        ("Rain", "It poured.", "Rain", "Rain\n\nIt poured."),
        ("Rain", "", "Rain", "Rain"),
        ("", "본문", "", "본문"),
        (None, None, "", ""),
        (" \xa0제목　", " \n본 문\t", "제목", "제목\n\n본 문"),
        ("\xa0", " ", "", ""),
    ]
    df = spark.createDataFrame([(n, *c[:2]) for n, c in enumerate(cases)], "n int, t string, c string")
    rows = df.select(
        "n",
        model_text(F.col("t"), F.col("c"), "title").alias("a"),
        model_text(F.col("t"), F.col("c"), "title+content").alias("b"),
    ).orderBy("n").collect()
    assert [(r["a"], r["b"]) for r in rows] == [c[2:] for c in cases]


def test_settings_are_checked():
    for wrong in ({"batch_size": 0}, {"max_length": 0}, {"neutral_floor": 1.5}, {"text_used": "content"}):
        with pytest.raises(ValueError):
            ScoringConfig("m-1", **wrong)


def label_of(neg, neu, pos, floor):
    best = max(neg, neu, pos)
    if math.isnan(neg + neu + pos) or (floor > 0 and best < floor):
        return "neu"
    return next(name for name, p in (("pos", pos), ("neg", neg), ("neu", neu)) if p == best)


@pytest.mark.parametrize("floor", [0.0, 0.5, 1.0])
def test_labels(spark, floor):
    values = [0.0, 0.25, 0.5, 1.0]
    cases = [*itertools.product(values, repeat=3), (math.nan,) * 3]
    struct = "struct<neg:double,neu:double,pos:double>"
    found = apply(spark, cases, lambda p: sentiment_label(p, floor), struct)
    assert found == [label_of(*c, floor) for c in cases]


def test_softmax_of_large_outputs(spark):
    cases = [[1000.0, 1000.0, 0.0], [-1000.0, 0.0, 0.0], [1.0, 2.0, 3.0]]
    for logits, p in zip(cases, apply(spark, cases, softmax, "array<float>")):
        exps = [math.exp(v - max(logits)) for v in logits]
        assert tuple(p) == pytest.approx([e / sum(exps) for e in exps])


def test_blank_text_is_neutral_whatever_the_model_says(spark):
    df = spark.createDataFrame(
        [(None, [9, 0, 0]), (" 　", [0, 0, 9]), ("x", [9, 0, 0])], "text string, logits array<int>"
    )
    rows = [(r["sentiment_label"], round(r["sentiment_score"], 2)) for r in add_sentiment(df, "text", "logits").collect()]
    assert rows == [("neu", 0.0), ("neu", 0.0), ("neg", -1.0)]


def test_model_gives_the_same_as_the_expression(spark):
    df = posts(spark, *[("e" * n, "text" * (n % 7)) for n in range(200)], ("", ""), (None, None))

    def load(config):
        return lambda texts: [[len(t) % 5, t.count("e") % 5, 2] for t in texts]

    scored = score_posts(df, batch_scorer(load, BOTH), BOTH)
    native = add_sentiment(
        df.withColumn("model_text", model_text(F.col("title"), F.col("content"), "title+content")).withColumn(
            "logits", stand_in(F.col("model_text"))
        ),
        "model_text",
        "logits",
    )
    columns = ["post_id", "sentiment_label", "sentiment_score"]
    assert sorted(scored.select(columns).collect()) == sorted(native.select(columns).collect())


def test_batches_and_loading(spark, tmp_path):
    folder = str(tmp_path)

    def load(config):
        import os
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()

        def predict(texts):
            return [[len(texts), 0, 0] for _ in texts]

        return predict

    df = posts(spark, *[("x", "")] * 50)
    config = ScoringConfig("m-1", batch_size=7)
    load = batch_scorer(load, config)
    empty = score_posts(df.where("post_id < 0").repartition(4), load, config)
    assert empty.collect() == []
    assert list(tmp_path.iterdir()) == []
    sizes = [r["logits"][0] for r in score_posts(df.coalesce(1), load, config).collect()]
    assert max(sizes) == 7 and len(sizes) == 50
    assert len(list(tmp_path.iterdir())) == 1


def test_errors_of_the_model_fail_the_job(spark):
    def load(config):
        return lambda texts: [[0, 0, 0]] * (len(texts) - 1)

    with pytest.raises(Exception, match="reshape"):
        score_posts(posts(spark, ("a", ""), ("b", "")), batch_scorer(load, BOTH), BOTH).collect()


def test_analyzed_posts(spark):
    df = posts(spark, ("eee", "body"), ("", ""))
    rows = analyzed_posts(df, stand_in_scorer, BOTH, "2026-02-01T00:00:00+00:00").orderBy("post_id").collect()
    assert tuple(rows[0].asDict()) == ANALYZED_COLUMNS
    assert (rows[0]["content"], rows[1]["content"]) == ("body", None)
    assert rows[1]["sentiment_probs"].asDict() == {"neg": 0.0, "neu": 1.0, "pos": 0.0}
    assert {r["crawled_at"] for r in rows} == {"2026-02-01T00:00:00+00:00"}
    assert {(r["model_version"], r["text_used"]) for r in rows} == {("m-1", "title+content")}
    assert datetime.fromisoformat(utc_now()).utcoffset().total_seconds() == 0


def test_spread_splits_a_repeated_post(spark):
    df = posts(spark, *[("same", "")] * 400).withColumn("url", F.lit("u"))
    sizes = spread(df, 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 100


def scores(spark, weights, texts):
    """Outputs for texts, in their order."""
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, x string").repartition(3)
    return [r["logits"] for r in sorted(weights(frame, "x").collect(), key=lambda r: r["n"])]


def test_weights_prefer_the_words_of_a_class(spark, tmp_path):
    texts = [("sun warm", "pos")] * 20 + [("mud cold", "neg")] * 20 + [("a table", "neu")] * 20 + [(None, "pos"), ("x", None), ("x", "odd")]
    weights = learn_weights(spark.createDataFrame(texts, "text string, label string"), f"{tmp_path}/a")
    rows = scores(spark, weights, ["warm SUN", "cold\tmud mud", "table", "", None])
    assert [r.index(max(r)) for r in rows[:3]] == [2, 0, 1]
    assert rows[3] == rows[4] == [0.0, 0.0, 0.0]
    none = learn_weights(spark.createDataFrame([], "text string, label string"), f"{tmp_path}/b")
    assert scores(spark, none, ["warm"]) == [[0.0, 0.0, 0.0]]
    assert scores(spark, none, []) == []


def by_hand(texts):
    """Weights by bucket, for the labels in their order."""
    def bucket(token):
        return zlib.crc32(token.encode()) % 4096

    counts = {label: [0] * 4096 for label in ("neg", "neu", "pos")}
    for text, label in texts:
        for token in text.split():
            counts[label][bucket(token)] += 1
    logs = [[math.log((n + 1) / (4096 + sum(row))) for n in row] for row in counts.values()]
    return bucket, [[round((row[b] - sum(x[b] for x in logs) / 3) * 1e6) for row in logs] for b in range(4096)]


def test_weights_and_scores_by_hand(spark, tmp_path):
    texts = [("b b c", "neg"), ("c", "neu"), ("d", "pos")]
    weights = learn_weights(spark.createDataFrame(texts, "text string, label string"), str(tmp_path))
    bucket, expected = by_hand(texts)
    rows = weights.table.collect()
    assert len(rows) == 4096
    for r in rows:
        assert [r["neg"], r["neu"], r["pos"]] == pytest.approx(expected[r["bucket"]], abs=1)
    shown = ["b", "B  c\nd", "é😀 tokens 본문 ab", "z " * 5000, "b", "b"]  # repeated texts do not change each other
    for text, found in zip(shown, scores(spark, weights, shown)):
        words = text.lower().split()
        assert found == pytest.approx([sum(expected[bucket(w)][k] for w in words) / len(words) / 1e6 * 20 for k in range(3)], abs=1e-4)


def test_plan_of_the_product(spark, tmp_path):
    """No weights in the plan, and nothing but sums per text moves before the join back."""
    weights = learn_weights(spark.createDataFrame([("a b", "pos")], "text string, label string"), str(tmp_path))
    frame = spark.createDataFrame([("a b c",)], "x string")
    plan = weights(frame, "x")._jdf.queryExecution().toString()
    assert "Join" in plan and "Python" not in plan and len(plan) < 20_000


def bytes_moved(node):
    """Bytes that the exchanges of an executed plan wrote, before compression."""
    found = node.metrics().apply("dataSize").value() if node.nodeName() == "Exchange" else 0
    return found + sum(bytes_moved(node.children().apply(k)) for k in range(node.children().size()))


def test_no_text_moves_to_its_label(spark, tmp_path, monkeypatch):
    """Numbers of buckets go to the join with the labels, also for repeated rows and nulls, and give the weights of the texts."""
    rows = [(n, " ".join(f"{n}-{k}-long-word" for k in range(400))) for n in range(40)] + [(1, "again\tAGAIN x"), (2, None), (3, ""), (None, "x")]
    labels = [(n, n % 2, n % 3 % 2) for n in range(40)] + [(5, 0, 0), (None, 1, 1), (99, 1, 1), (6, None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    learnt = []
    monkeypatch.setattr(queries, "learn_weights", lambda texts, folder: learnt.append((texts, learn_weights(texts, f"{tmp_path}/w"))))
    limits = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in limits}
    try:
        for name, value in limits.items():
            spark.conf.set(name, value)
        queries._scorer(spark, str(tmp_path))
        texts, weights = learnt[0]
        texts.collect()
        moved = bytes_moved(texts._jdf.queryExecution().executedPlan())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert moved < sum(len(text or "") for _, text in rows) / 3
    joined = [(text, "neg" if bad == 0 else "neu" if toxic == 1 else "pos") for n, text in rows for m, bad, toxic in labels if n is not None and n == m]
    expected = learn_weights(spark.createDataFrame(joined, "text string, label string"), f"{tmp_path}/v")
    assert sorted(weights.table.collect()) == sorted(expected.table.collect())
    _, by_text = by_hand([((text or "").lower(), label) for text, label in joined])
    for r in weights.table.collect():
        assert [r["neg"], r["neu"], r["pos"]] == pytest.approx(by_text[r["bucket"]], abs=1)


def test_first_words(spark):
    texts = ["a b  c\td", " a b", "", "   ", "x" * 100_000 + " y", "w " * 100_000]
    for count in (1, 2, 300):
        found = apply(spark, texts, lambda t: first_words(t, count))
        for text, cut in zip(texts, found):
            assert text.startswith(cut) and cut.split() == text.split()[:count]


def test_a_model_sees_its_words(spark):
    def load(config):
        return lambda texts: [[len(t.split()), config.max_length, 0] for t in texts]

    config = ScoringConfig("m-1", max_length=3)
    rows = score_posts(posts(spark, ("a b c d e", ""), ("a", "")), batch_scorer(load, config), config).collect()
    assert sorted(r["logits"][:2] for r in rows) == [[1.0, 3.0], [3.0, 3.0]]


def test_scoring_moves_no_text(spark, tmp_path):
    """Sums are made in a text's row: without a limit of broadcasts nothing is shuffled beside the table of weights."""
    weights = learn_weights(spark.createDataFrame([("a b", "pos"), ("c", "neg")], "text string, label string"), str(tmp_path))
    df = posts(spark, ("a", "b c"), ("a", "b c"), (None, None), (" ", "x"))
    scored = analyzed_posts(df, weights, BOTH, keep=("page_id", "pos"))
    plan = scored._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("Join") == 1
    rows = scored.orderBy("post_id").collect()
    assert [r["sentiment_probs"] for r in rows[:1]] == [r["sentiment_probs"] for r in rows[1:2]]
    assert rows[2]["sentiment_probs"].asDict() == {"neg": 0.0, "neu": 1.0, "pos": 0.0}
    long = scores(spark, weights, ["a " * 30_000, "a"])  # beyond 32 bits in millionths
    assert long[0] == pytest.approx(long[1])


def test_contents_summed_apart(spark, tmp_path):
    """Title and content summed apart give the scores of the whole text, also with odd white space and letters."""
    weights = learn_weights(spark.createDataFrame([("a ΟΔΟΣ b", "pos"), ("c c", "neg")], "text string, label string"), str(tmp_path))
    parts = [None, "", " \n", "\xa0", "　\x1c", "a b", "ΟΔΟΣ", " a\xa0b ΟΔΟΣ\xa0 ", "Σ", "c c\tİ"]
    df = posts(spark, *itertools.product(parts, parts))
    whole = score_posts(df, weights, BOTH)
    apart = score_posts(with_content_sums(df, weights), weights, BOTH)
    assert apart.columns == whole.columns
    assert sorted(map(str, apart.collect())) == sorted(map(str, whole.collect()))
    without = apart.select("post_id", "sentiment_label", "sentiment_probs")
    no_text = score_posts(with_content_sums(df, weights).withColumn("content", F.lit(None).cast("string")), weights, BOTH)
    assert sorted(map(str, no_text.select(without.columns).collect())) == sorted(map(str, without.collect()))


def test_only_scorers_of_sums_read_contents_apart(spark, tmp_path):
    weights = learn_weights(spark.createDataFrame([], "text string, label string"), str(tmp_path))
    assert sum_scorer(weights, BOTH) is weights
    assert sum_scorer(weights, ScoringConfig("m-1")) is None and sum_scorer(stand_in_scorer, BOTH) is None
