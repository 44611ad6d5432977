import zlib

import numpy as np
from llm.cases import ODD, documents, prose

from boardpulse.llm import quality_trees as trees


def test_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] * x[:, 1] > 0) & (x[:, 2] > -1)).astype(float)
    fitted = trees.fit(x[:3000], y[:3000])
    assert ((fitted.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(300, 3)), (rng.random(300) < 0.5).astype(float)
    fitted = trees.fit(x, y, trees=7)
    for row, score in zip(x, fitted.score(x), strict=True):
        total = fitted.base
        for f, t, leaf in zip(fitted.feature, fitted.threshold, fitted.leaf, strict=True):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > t[at] else 1)
            total += leaf[at - len(f)]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-9


def test_one_label_or_none():
    for y in ([], [1.0, 1.0], [0.0]):
        x = np.zeros((len(y), trees.N_FEATURES))
        score = trees.fit(x, np.array(y)).score(np.zeros((3, trees.N_FEATURES)))
        assert np.allclose(score, (sum(y) + 1) / (len(y) + 2))


def test_documents(spark, odd, nothing):
    good = [prose(k, 120) for k in range(200)]
    bad = [" ".join(w + "###" for w in prose(k, 120).split()) for k in range(200, 400)]
    docs = documents(spark, good + bad)
    labels = [(i, int(i < 200)) for i in range(400)] + [(None, 1), (5, None), (9999, 0)]
    # Labels of the held-out part are wrong, so learning from them would show.
    held = [(i, 1 - q) if i is not None and q is not None and zlib.crc32(str(i).encode()) % 4 == 2 else (i, q) for i, q in labels]
    fitted = trees.learn(docs, spark.createDataFrame(held, "doc_id long, quality int"))
    found = trees.scored(docs, fitted).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(r.predicted == int(r.doc_id < 200) and r.predicted == int(r.score >= 0.7) for r in found)
    assert len(trees.scored(odd, fitted).collect()) == len(ODD)
    assert trees.scored(nothing, fitted).collect() == []
    assert trees.learn(nothing, spark.createDataFrame([], "doc_id long, quality int")).score(np.zeros((1, trees.N_FEATURES)))[0] == 0.5
