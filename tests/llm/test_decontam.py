import re
from collections import Counter

import pytest
from llm.cases import ODD, documents, prose

from boardpulse.llm import decontam

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def by_hand(rows, items):
    out = []
    for doc_id, text in rows:
        w, hit, ids = words(text), set(), set()
        for item, item_text in items:
            v = words(item_text)
            n = min(13, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids |= {str(item)} if item is not None else set()
        bad = bool(hit) and 20 * len(hit) >= len(w)
        out.append((doc_id, len(w), len(hit), len(ids), tuple(sorted(ids)), bad))
    return Counter(out)


ITEMS = [
    (10, prose(50, 40)),
    (2, prose(51, 13)),
    (3, "Short Item"),
    (4, "alone"),
    (5, ""),
    (6, None),
    (None, prose(52, 20)),
    (7, prose(50, 40)),
    (2, "four words of it"),
    (8, " ".join(prose(53, 8).split()[:7])),
    (9, "ÉTÉ été x y z"),
]


def tables(spark):
    a, b = prose(60, 200), prose(61, 50)
    rows = [
        *ODD,
        (20, a + " " + ITEMS[0][1].upper() + " " + b),
        (21, ITEMS[1][1]),
        (22, a + "\n" + " ".join(ITEMS[0][1].split()[5:18]) + " end"),
        (23, a + " " + " ".join(ITEMS[0][1].split()[5:17]) + " end"),
        (24, "a short, item; and alone ALONE alone"),
        (25, a + ITEMS[6][1] + b),
        (26, "four words of it " * 50),
        (27, ITEMS[9][1]),
        (28, "ÉTÉ été x y z"),
        (29, "été été x y z"),
        *((100 + k, " ".join([*a.split()[:k], ITEMS[1][1], b])) for k in range(30)),
    ]
    items = spark.createDataFrame([(i, t, "n") for i, t in ITEMS], "item_id long, text string, doc_id string")
    return rows, documents(spark, rows), items


def collected(frame):
    return Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"]), r.contaminated) for r in frame.collect())


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_hits(spark, monkeypatch, bound):
    monkeypatch.setattr(decontam, "MAX_BROADCAST_SEEDS", bound)
    rows, docs, items = tables(spark)
    assert collected(decontam.contamination(docs, items)) == by_hand(rows, ITEMS)


def test_empty_tables(spark, nothing, odd):
    _, _, items = tables(spark)
    assert decontam.contamination(nothing, items).collect() == []
    assert collected(decontam.contamination(odd, items.limit(0))) == by_hand(ODD, [])


def test_documents_removed(spark):
    rows, docs, items = tables(spark)
    bad = {(r[0]) for r in by_hand(rows, ITEMS) if r[5]}
    kept = decontam.without_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(r for r in rows if r[0] not in bad)
