import itertools
import random
from collections import Counter

import numpy as np
import xxhash
from llm.cases import ODD, documents, prose

from boardpulse.llm import simhash
from boardpulse.llm.components import connected_components


def by_hand(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    size = min(4, len(words))
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, linked):
    """Sets of places that links connect, by repeated merging."""
    sets = [{i} for i in range(len(values))]
    for i, j in itertools.combinations(range(len(values)), 2):
        if linked(values[i], values[j]):
            a = next(s for s in sets if i in s)
            b = next(s for s in sets if j in s)
            if a is not b:
                a |= b
                sets.remove(b)
    return sets


def check_classes(frame, rows):
    prints = [by_hand(t) for _, t in rows]
    expected = []
    for group in groups(prints, lambda a, b: (a ^ b).bit_count() <= 4):
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        expected += [(rows[i][0], f"{prints[i]:016x}", min(ids) if ids else None) for i in group]
    found = frame.select("doc_id", simhash.fingerprint_text(frame.fp), "component_id").collect()
    assert Counter(map(tuple, found)) == Counter(expected)


def test_odd_rows(odd, nothing):
    check_classes(simhash.near_classes(odd), ODD)
    assert simhash.near_classes(nothing).collect() == []


def test_near_copies(spark):
    rng, texts = random.Random(5), []
    for k in range(40):
        words = prose(k, 120).split(" ")
        for _ in range(3):
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    check_classes(simhash.near_classes(documents(spark, texts)), list(enumerate(texts)))


def test_links_of_close_codes(spark):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**63, 60, dtype=np.uint64)
    codes = set(seeds.tolist())
    for s in seeds.tolist():
        for _ in range(80):
            for b in rng.integers(0, 64, rng.integers(1, 4)).tolist():
                s ^= 1 << b
            codes.add(s)
    codes = sorted(codes)
    signed = [(c - 2**64 if c >= 2**63 else c,) for c in codes]
    links = simhash.gray_links(spark.createDataFrame(signed, "fp long").repartition(5), 4)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    expected = groups(codes, lambda a, b: (a ^ b).bit_count() <= 4)
    found = {}
    for (c,) in signed:
        found.setdefault(roots.get(c, c), set()).add(c % 2**64)
    assert sorted(map(sorted, found.values())) == sorted(sorted(codes[i] for i in g) for g in expected)


def test_pages_of_one_group(spark, monkeypatch):
    """A group that goes over many pages and partitions is still one component."""
    codes = [(i << 3,) for i in range(5000)]
    links = simhash.gray_links(spark.createDataFrame(codes, "fp long").repartition(4), 4)
    assert links.count() < 15 * 5000 * 2
    assert connected_components(links).select("root").distinct().count() == 1


def test_one_of_each(odd, nothing):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    prints = [by_hand(t) for _, t in ODD]
    sets = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert got.total() == len(sets)
    for s in sets:
        ids = [ODD[i][0] for i in s if ODD[i][0] is not None]
        assert sum(got[ODD[i]] for i in {ODD[i]: i for i in s}.values()) == 1
        assert any(got[ODD[i]] and (not ids or ODD[i][0] == min(ids)) for i in s)
    assert simhash.one_of_each(nothing).collect() == []


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 1), (9, 9), (7, 8), (8, 7), *((i, i + 1) for i in range(100, 160))]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 9: 9, 7: 7, 8: 7} | {i: 100 for i in range(100, 161)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
