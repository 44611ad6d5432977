import numpy as np
import pytest
from llm.cases import documents
from pyspark.sql import functions as F

from boardpulse.llm import language

TEXTS = {
    "en": "the house on the hill was old and the wind blew through the broken windows of it",
    "de": "das alte Haus auf dem Hügel war leer und der Wind blies durch die zerbrochenen Fenster",
    "fr": "la vieille maison sur la colline était vide et le vent soufflait par les fenêtres cassées",
    "es": "la vieja casa de la colina estaba vacía y el viento soplaba por las ventanas rotas",
}


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, " ".join(np.random.default_rng(i).permutation(t.split()))) for i, t in enumerate(list(TEXTS.values()) * 12)]
    langs = list(TEXTS) * 12
    rows += [(100, None), (101, ""), (102, "12 34 %%"), (103, TEXTS["de"]), (103, TEXTS["de"]), (None, TEXTS["fr"]), (104, "the " * 50_000)]
    langs += [None, "en", "en", "fr", "fr", None, "xx"]
    declared = {i: x for (i, _), x in zip(rows, langs, strict=True)}
    frame = documents(spark, rows)
    pairs = spark.createDataFrame([(i, x) for i, x in declared.items() if i is not None], "doc_id long, l string")
    return frame.join(F.broadcast(pairs), "doc_id", "left").withColumn("lang", F.col("l")).drop("l")


def test_documents(table):
    found = language.document_languages(table).collect()
    assert len(found) == table.count()
    got = {r.doc_id: r for r in found}
    for i, name in enumerate(list(TEXTS) * 12):
        assert got[i].language == name and got[i].accepted
    for i in (100, 101, 102):
        assert got[i].language == "und" and not got[i].accepted
    assert got[103].language == "de" and got[None].language == "fr" and got[104].language == "en"


def test_rejected_rows_go(table, nothing):
    kept = language.without_rejected(table)
    assert kept.columns == table.columns and kept.count() == table.count() - 3
    assert language.without_rejected(nothing).collect() == []


def test_fusion_by_hand():
    s = language.Settings(languages=("a", "b"), declared_right=0.8, suffix_right=0.7, und=0.1)
    scores = np.log(np.array([[0.2, 0.3, 0.5]]))
    got = language.fuse(scores, ["a"], [None], np.array([[0.25, 0.75]]), s)
    raw = np.array([0.2 * 0.8 * 0.9 * 0.25, 0.3 * 0.2 * 0.9 * 0.75, 0.5 * 0.5 * 0.1])
    assert np.allclose(got, raw / raw.sum())


def test_priors_by_hand(spark):
    votes = [("h1", "d", "en")] * 30 + [("h1", "d", "de")] * 10 + [("h2", "d", "de")] * 5 + [(None, None, "fr")] * 3
    s = language.Settings(weight=10.0)
    found = {r.host: r.prior for r in language.host_priors(spark.createDataFrame(votes, "host string, domain string, vote string"), s).collect()}
    n = {"h1": [10, 30, 0, 0], "h2": [5, 0, 0, 0], None: [0, 0, 0, 3]}
    n[None], order = [0, 0, 0, 3], s.languages
    assert order == ("de", "en", "es", "fr")
    top = [(x + 2.5) / 58 for x in (15, 30, 0, 3)]
    top = [(x + 10 * 0.25) / 58 for x in (15, 30, 0, 3)]
    d = [(x + 10 * t) / 55 for x, t in zip((15, 30, 0, 0), top, strict=True)]
    none = [(x + 10 * t) / 13 for x, t in zip((0, 0, 0, 3), top, strict=True)]
    assert np.allclose(found["h1"], [(x + 10 * p) / 50 for x, p in zip(n["h1"], d, strict=True)])
    assert np.allclose(found["h2"], [(x + 10 * p) / 15 for x, p in zip(n["h2"], d, strict=True)])
    assert np.allclose(found[None], [(x + 10 * p) / 13 for x, p in zip(n[None], none, strict=True)])


def test_counts_by_hand(spark):
    rows = [("aba", "en"), ("ab", "en"), (None, "en"), ("ab", None), ("ab", "zz")]
    found = {(r.declared, r.bucket): r.n for r in language.triple_counts(spark.createDataFrame(rows, "text string, declared string")).collect()}
    both = [*language.triples("aba"), *language.triples("ab")]
    assert found == {("en", b): both.count(b) for b in both}


def test_pages(spark):
    rows = [(i, f"http://www.x{i % 3}.{s}/a", f'<html lang="{x}-XX"><script>var the;</script><p>{TEXTS[x]}</p>') for i, (x, s) in enumerate([("en", "com"), ("de", "de"), ("fr", "fr"), ("es", "es")] * 5)]
    rows += [(90, None, None), (91, "bad", "")]
    found = {r.page_id: r for r in language.page_languages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [found[i].language for i in range(4)] == ["en", "de", "fr", "es"]
    assert not found[90].accepted and not found[91].accepted


def test_fifth_declared_language(spark):
    texts = TEXTS | {"it": "la vecchia casa sulla collina era vuota e il vento soffiava attraverso le finestre rotte"}
    rows = [(i, " ".join(np.random.default_rng(i).permutation(texts[x].split())), x) for i, x in enumerate(list(texts) * 12)]
    rows += [(900, texts["it"], None), (901, texts["en"], "zz")]
    frame = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in language.document_languages(frame).collect()}
    assert all(got[i].language == (x or "it") and got[i].accepted for i, _, x in rows if i != 901)
    assert got[901].language == "en"
