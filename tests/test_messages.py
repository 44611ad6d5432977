import json

import pytest

from boardpulse.config import PAYLOAD_COLUMNS, ScoringConfig
from boardpulse.operators.messages import keyed_messages, latest_per_document, payloads
from boardpulse.operators.samples import analyzed_sample, payload_sample, post_sample
from boardpulse.operators.scoring import analyzed_posts
from boardpulse.sinks.kafka import (
    certificate_options,
    connector_options,
    login_options,
    stream_to_kafka,
    write_kafka,
)
from stand_in import stand_in_scorer
from test_scoring import posts

ORDER = ("page_id", "pos")


def analyzed(spark, *texts, crawled_at="2026-02-01T00:00:00+00:00"):
    return analyzed_posts(posts(spark, *texts), stand_in_scorer, ScoringConfig("m-1"), crawled_at=crawled_at, keep=ORDER)


def test_messages(spark):
    payload = payloads(analyzed(spark, ('제목 "x"\n', "c"), (None, None)))
    rows = sorted(keyed_messages(payload).collect())
    assert [bytes(r["key"]).decode() for r in rows] == ["5558:0", "5558:1"]
    values = [json.loads(r["value"]) for r in rows]
    assert [tuple(v) for v in values] == [PAYLOAD_COLUMNS] * 2
    assert values[0]["title"] == '제목 "x"\n' and "제목" in rows[0]["value"]
    assert values[1]["title"] is None
    assert values[1]["sentiment_probs"] == {"neg": 0.0, "neu": 1.0, "pos": 0.0}


@pytest.mark.parametrize("doc_id", ["NULL", "''", "' 　'"])
def test_message_without_id_fails(spark, doc_id):
    from pyspark.sql import functions as F

    payload = payloads(analyzed(spark, ("a", ""))).withColumn("doc_id", F.expr(doc_id).cast("string"))
    with pytest.raises(Exception, match="without doc_id"):
        keyed_messages(payload).collect()


def test_key_is_stripped(spark):
    from pyspark.sql import functions as F

    payload = payloads(analyzed(spark, ("a", ""))).withColumn("doc_id", F.lit(" 1:2\n"))
    assert bytes(keyed_messages(payload).first()["key"]) == b"1:2"


def test_latest_per_document(spark):
    from pyspark.sql import functions as F

    old = analyzed(spark, ("a", ""), ("b", ""), crawled_at="2026-01-01T00:00:00+00:00")
    new = analyzed(spark, ("c", ""))
    moved = new.withColumns({"page_id": F.lit(9).cast("bigint"), "title": F.lit("last")})
    found = latest_per_document(old.unionByName(new).unionByName(moved).unionByName(moved)).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["title"]) for r in found] == [("5558:0", "last"), ("5558:1", "b")]


def test_latest_per_document_by_time_page_and_place(spark):
    import random
    from collections import defaultdict

    from pyspark.sql import functions as F

    rng, groups = random.Random(4), defaultdict(list)
    times = ["1969-12-31T23:59:59.999999+00:00", "2026-02-01T00:00:00.000001+00:00", "2026-02-01T00:00:00.000002+00:00", None]
    rows = [(rng.randrange(40), rng.choice(times), rng.choice([0, 1, 10**12 - 1]), rng.choice([0, 5, 10**9 - 1]), str(n)) for n in range(600)]
    for post, at, page, pos, title in rows:
        groups[post].append((at or "", page, pos, title))
    frame = spark.createDataFrame(rows, "post_id bigint, crawled_at string, page_id bigint, pos int, title string").withColumn("board_id", F.lit(1))
    found = defaultdict(set)
    for r in latest_per_document(frame, ["title"]).collect():
        found[int(r["doc_id"][2:])].add(r["title"])
    assert found == {post: {t for *place, t in group if tuple(place) == max(g[:3] for g in group)} for post, group in groups.items()}
    for wrong in (frame.withColumn("page_id", F.lit(-1).cast("bigint")), frame.withColumn("pos", F.lit(10**9))):
        with pytest.raises(Exception, match="out of range"):
            latest_per_document(wrong, ["title"]).collect()


def test_samples(spark):
    texts = [(f"t{n}", "x" * (119 + n)) for n in range(12)]
    sample = post_sample(posts(spark, *texts)).collect()
    assert [r["post_id"] for r in sample] == [0, 1, 2, 3, 4]
    assert [len(r["content_preview"]) for r in sample] == [119, 120, 121, 121, 121]
    assert sample[2]["content_preview"] == "x" * 120 + "…"
    found = analyzed(spark, *texts)
    assert [r["doc_id"] for r in analyzed_sample(found).collect()] == [f"5558:{n}" for n in range(10)]
    assert payload_sample(payloads(found, keep=ORDER)).columns == list(PAYLOAD_COLUMNS)
    assert payload_sample(payloads(found, keep=ORDER)).count() == 3


BASE = {"kafka.bootstrap.servers": "a:1,b:2", "topic": "posts"}


def test_kafka_options():
    options = connector_options(BASE | {"kafka.client.id": " me ", "kafka.acks": " ", "kafka.retries": "3"})
    assert options["kafka.acks"] == "all" and options["kafka.retries"] == "3" and options["kafka.client.id"] == "me"
    for missing in BASE:
        with pytest.raises(ValueError, match=missing):
            connector_options({k: v for k, v in BASE.items() if k != missing})


def test_kafka_security_protocol_is_checked():
    assert connector_options(BASE | {"kafka.security.protocol": " ssl "})["kafka.security.protocol"] == "SSL"
    with pytest.raises(ValueError, match="TLS"):
        connector_options(BASE | {"kafka.security.protocol": "tls"})
    login = login_options("PLAIN", "a", "b") | {"kafka.security.protocol": "sasl_plaintext"}
    assert connector_options(BASE | login)["kafka.security.protocol"] == "SASL_PLAINTEXT"
    for part in ("kafka.sasl.mechanism", "kafka.sasl.jaas.config"):
        with pytest.raises(ValueError, match=part):
            connector_options(BASE | login | {part: " "})


def test_kafka_login():
    options = connector_options(BASE | login_options("scram-sha-256", 'a"b', "c\\d"))
    assert options["kafka.security.protocol"] == "SASL_SSL" and options["kafka.sasl.mechanism"] == "SCRAM-SHA-256"
    assert options["kafka.sasl.jaas.config"].endswith('ScramLoginModule required username="a\\"b" password="c\\\\d";')
    for wrong in (("GSSAPI", "a", "b"), ("PLAIN", "", "b"), ("PLAIN", "a", "")):
        with pytest.raises(ValueError):
            login_options(*wrong)


def test_kafka_certificates_are_named_by_place():
    options = certificate_options("/ca.pem", "/own.pem")
    assert options["kafka.ssl.truststore.location"] == "/ca.pem" and options["kafka.ssl.keystore.location"] == "/own.pem"
    assert certificate_options() == {}


def test_kafka_write_needs_the_connector(spark):
    """Without the connector the write fails instead of losing messages."""
    messages = keyed_messages(payloads(analyzed(spark, ("a", ""))))
    with pytest.raises(Exception, match="kafka"):
        write_kafka(messages, BASE)


def test_stream_of_messages_needs_the_connector(spark, tmp_path):
    payloads(analyzed(spark, ("a", ""))).write.parquet(f"{tmp_path}/payloads")
    schema = spark.read.parquet(f"{tmp_path}/payloads").schema
    stream = keyed_messages(spark.readStream.schema(schema).parquet(f"{tmp_path}/payloads"))
    writer = stream_to_kafka(stream, BASE, f"{tmp_path}/checkpoint")
    with pytest.raises(Exception, match="kafka"):
        writer.trigger(availableNow=True).start()
