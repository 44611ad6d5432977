import hashlib
import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from boardpulse.llm import dual_lloyd as dl

SCHEMA = "vec_id long, embedding array<double>, label int, code string, place string, length string, id string"


def slow(rows, parts=16, entries=64, rounds=2, scale=256):
    """(vec_id, code, error) per row and all entries, by comparing everything with everything."""
    whole = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v, _ in rows]
    width = len(whole[0][1]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v in whole]
    first = sorted({i for i, _ in whole})[:entries]
    least = {i: min(c for (j, _), c in zip(whole, cut, strict=True) if i == j) for i in first}
    books = [[least[i][p] for i in first] for p in range(parts)]

    def nearest(p, x):
        far = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        groups = [defaultdict(list) for _ in range(parts)]
        for c in cut:
            for p in range(parts):
                groups[p][nearest(p, c[p])[0]].append(c[p])
        books = [
            [tuple(sum(x) // len(groups[p][e]) for x in zip(*groups[p][e], strict=True)) if groups[p][e] else old for e, old in enumerate(books[p])]
            for p in range(parts)
        ]
    found = []
    for (i, _), c in zip(whole, cut, strict=True):
        best = [nearest(p, c[p]) for p in range(parts)]
        found.append((i, "".join(f"{k:02x}" for k, _ in best), sum(d for _, d in best)))
    text = ",".join(str(x) for b in books for e in b for x in e)
    return found, hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "a", "b", "c", "d") for i, v, label in rows], SCHEMA).repartition(3)


def made(seed, n, length, spread=0.2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(length)] for _ in range(7)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([None, 1, 2])) for i in rng.sample(range(10 * n), n)]


CASES = {
    "spread": made(1, 300, 32),
    "few": made(2, 5, 16),
    "ties": [(i, [(i * 7 % 3) / 256.0] * 16 + [-0.001 * (i % 2)] * 16, i % 2) for i in range(150)],
    "equal": [(i, [0.5] * 16, None) for i in range(100)],
    "one": [(4, [0.1] * 48, 3)],
    "repeated": made(3, 90, 16) + made(3, 90, 16),
    "large": [*made(4, 80, 16), (10_000, [1e30, -1e30] + [0.0] * 14, 9), (-5, [3e15] * 16, 8)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_equals_brute_force(spark, name):
    rows = CASES[name]
    expected, digest = slow(rows)
    result = dl.vector_codes(frame(spark, rows)).collect()
    limit = 1 << 63
    assert sorted((r.vec_id, r.code, r.error) for r in result) == sorted((i, c, e if e < limit else None) for i, c, e in expected)
    assert {r.codebooks_sha256 for r in result} == {digest}
    labels = defaultdict(int)
    by = {(i, e): label for (i, _, label), (_, _, e) in zip(rows, expected, strict=True)}
    for (i, _, label), (_, _, e) in zip(rows, expected, strict=True):
        labels[label] += e
    if name != "large":
        assert all(r.label_error == labels[by[r.vec_id, r.error]] for r in result)


def test_trees_rule_combinations_out_and_change_nothing():
    rng = np.random.default_rng(5)
    centres = rng.integers(-2000, 2000, (4, 40, 4))
    points = np.stack([c[rng.integers(0, 40, 3000)] for c in centres]) + rng.integers(-30, 30, (4, 3000, 4))
    for entries in (1, 2, 33, 64):
        books = points[:, rng.integers(0, 3000, entries)]
        found = dl.assign(points, dl.build_tree(points, dl.LEAF), books)
        far = ((points[:, :, None] - books[:, None]) ** 2).sum(axis=3)
        codes = far.argmin(axis=2)
        assert (found.codes == codes).all()
        for p in range(4):
            assert (found.counts[p] == np.bincount(codes[p], minlength=entries)).all()
            assert all((found.sums[p, e] == points[p][codes[p] == e].sum(axis=0)).all() for e in range(entries))
        assert found.compared < far.size / (4 if entries == 64 else 1) or entries == 1


def test_trees():
    points = np.random.default_rng(1).integers(-9, 9, (3, 1000, 2))
    tree = dl.build_tree(points, 8)
    for p in range(3):
        assert sorted(tree.order[p]) == list(range(1000))
        for level in range(tree.depth + 1):
            for j, (a, b) in enumerate(zip(dl._bounds(1000, level), dl._bounds(1000, level)[1:], strict=False)):
                some, node = points[p][tree.order[p][a:b]], (1 << level) - 1 + j
                assert (tree.low[p, node] == some.min(0)).all() and (tree.high[p, node] == some.max(0)).all()
                assert (tree.sums[p, node] == some.sum(0)).all()


def test_rows_that_are_dropped_or_stay_without_a_code(spark):
    good = made(6, 70, 16)
    odd = [
        (1, None, 1),
        (2, [None] * 16, 1),
        (3, [float("nan")] + [0.0] * 15, 1),
        (4, [float("inf")] * 16, 1),
        (5, [float("-inf")] * 16, 1),
    ]
    other = [(9006, [], 1), (9007, [1.0], 1), (9008, [0.5] * 32, 1)]
    nulls = [(None, good[0][1], None)]
    result = dl.vector_codes(frame(spark, good + odd + other + nulls)).collect()
    assert len(result) == 70 + 3 + 1
    assert all(r.code is None and r.error is None and r.label_error is None for r in result if (r.vec_id or 0) > 9000)
    plain = {r.vec_id: r for r in dl.vector_codes(frame(spark, good + nulls)).collect()}
    assert {r.vec_id: r for r in result if r.code} == plain
    assert dl.vector_codes(frame(spark, good).limit(0)).collect() == []
    assert [r.code for r in dl.vector_codes(frame(spark, [(1, [1.0], 1)])).collect()] == [None]


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rows = CASES["spread"]
    assert dl.vector_codes(frame(spark, rows).repartition(17)).orderBy("vec_id").collect() == dl.vector_codes(frame(spark, rows).coalesce(1)).orderBy("vec_id").collect()
