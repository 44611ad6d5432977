import re
from collections import Counter

import numpy as np
from llm.cases import ODD, documents, prose
from pyspark.sql import functions as F

from boardpulse.llm import robust


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {k for i, w in enumerate(windows) if n[w] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


MORE = ["a b c d e f g h", "a b c d e " * 3, "x " * 40, "l\nl\n\n \nl\nm", "a b c d e f a b c d e", prose(9, 300) + "\n" + prose(9, 300), "a b c d e f g a b c d e f g h"]


def test_counts(spark):
    rows = [*ODD, *enumerate(MORE, 100)]
    found = robust.quality_verdicts(documents(spark, rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    expected = []
    for i, t in rows:
        c = by_hand(t)
        expected.append((i, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert Counter((r.doc_id, *(r[n] for n in names), r.base_failed) for r in found) == Counter(expected)
    assert all(not r.kept for r in found if r.base_failed) and all(r.kept for r in found if not r.base_failed)


def test_empty_table(nothing):
    assert robust.quality_verdicts(nothing).collect() == []


def test_outliers_by_group(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join("".join(rng.choice(list("abcdefghij"), rng.integers(3, 8))) for _ in range(80)) for _ in range(600)]
    odd = [" ".join(w + "###" for w in t.split()) for t in texts[:40]]
    docs = documents(spark, texts + odd).withColumn("source", F.when(F.col("doc_id") % 3 == 0, None).otherwise("big"))
    found = {r.doc_id: r for r in robust.quality_verdicts(docs).collect()}
    assert sum(found[i].kept for i in range(600)) >= 598
    assert not any(found[i].kept for i in range(600, 640))


def test_distance_by_hand(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4)) @ rng.normal(size=(4, 4))
    rows = spark.createDataFrame([(0, "a", "b", *map(float, r)) for r in x], "level int, lang string, source string, x0 double, x1 double, x2 double, x3 double")
    estimate = robust._next_estimate(rows)
    got = [r.d for r in rows.join(estimate, robust.GROUP).select(robust._distance().alias("d"), "x0").orderBy("x0").collect()]
    covariance = np.cov(x.T, bias=True) + np.diag(np.square(robust.FLOORS))
    moved = (x - x.mean(axis=0))[x[:, 0].argsort()]
    assert np.allclose(got, np.einsum("ij,jk,ik->i", moved, np.linalg.inv(covariance), moved))
