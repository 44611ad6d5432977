import re
import time
from collections import Counter, defaultdict

import numpy as np
from llm.cases import ODD, documents, prose

from boardpulse.llm import sentence_spans as spans


MASK = (1 << 64) - 1


def mixed(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def lower(word):
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in word)


def word_hash(word):
    """The number that decides on content-defined cuts."""
    return mixed(sum(mixed(ord(c) + 1) * (mixed((k + 1) * 0x9E3779B97F4A7C15 & MASK) | 1) for k, c in enumerate(lower(word))) & MASK)


def parts_of(text):
    """Parts by going from word to word."""
    found = list(re.finditer(r"\S+", "".join("\n" if c == "\n" else " " if c.isspace() else c for c in text)))
    numbers = [word_hash(m[0]) for m in found]
    ends = []
    for k in range(1, len(found)):
        ended = found[k - 1][0][-1] in spans.MARKS or "\n" in text[found[k - 1].end() : found[k].start()]
        around = numbers[k - spans.AROUND : k + spans.AROUND + 1] if k >= spans.AROUND else []
        if ended or (len(around) == 2 * spans.AROUND + 1 and numbers[k] == min(around)):
            ends.append(found[k].start())
    return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)])]


def by_hand(rows):
    """Runs as tuples of words; the first by id, then place; nulls first."""
    keyed = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0, Order(r)))
    seen, gone, cut = {}, defaultdict(set), {}
    for row in keyed:
        cut[row] = parts = parts_of(row[1])
        words = [tuple(map(lower, p.split())) for p in parts]
        for i in range(len(parts)):
            j = i + spans.PARTS - 1
            while j < len(parts) and sum(map(len, words[i : j + 1])) < spans.WORDS:
                j += 1
            if j >= len(parts) or not words[i]:
                continue
            run = sum(words[i : j + 1], ())
            if seen.setdefault(run, (row, i)) != (row, i):
                gone[row].update(range(i, j + 1))
    return {r: "".join(p for k, p in enumerate(cut[r]) if k not in gone[r]) for r in keyed}


class Order:
    """Documents of one id go by a hash; the tests have one order only where ids differ."""

    def __init__(self, row):
        self.row = row

    def __lt__(self, other):
        return self.row[1] < other.row[1]


def check(spark, rows):
    found = spans.without_repeats(documents(spark, rows)).collect()
    expected = by_hand(rows)
    assert Counter((r.doc_id, r.text) for r in found) == Counter((r[0], expected.get(r)) for r in rows)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in found)


def test_cuts_equal_those_from_word_to_word():
    texts = [t or "" for _, t in ODD if t is None or len(t) < 10_000] + [prose(k, 200) for k in range(20)]
    texts += ["", " ", "a", "a b c", "İstanbul ΣΑΣ ǅ ß\u2028x\x1cy\u3000z! w", "x " * 300, "a. b.\n\nc\td ? e", "\n lead. trail \n", "é😀 " * 20]
    words = spans.cut(texts, 2)
    for row, text in enumerate(texts):
        mine = np.flatnonzero(words.text == row)
        found = [words.starts[b] - words.offsets[row] for b in words.begins[:-1] if words.text[b] == row]
        parts = parts_of(text)
        assert len(mine) == len(text.split())
        if text.split():
            places = [0, *np.cumsum([len(p) for p in parts]).tolist()]
            assert found[1:] == places[1:-1] and found[0] == len(text) - len(text.lstrip())
        assert [int(words.hashes[0][k]) for k in mine] == [word_hash(w) for w in text.split()]


def test_long_texts_in_linear_time():
    for text in ("a " * 500_000, "x" * 1_000_000, "." * 1_000_000, " " * 1_000_000, "word. " * 150_000):
        start = time.process_time()
        spans.runs(spans.cut([text], 2))
        assert time.process_time() - start < 20


def test_filter_lets_through_what_it_holds(spark):
    hashes = spans._mixed(np.arange(5000, dtype=np.uint64))
    bits = spans._filter(spark.createDataFrame([(int(h),) for h in hashes[:1000].view(np.int64)], "hash long"))
    assert spans._passes(bits, hashes)[:1000].all() and spans._passes(bits, hashes)[1000:].sum() < 10


def test_odd_rows(spark, nothing):
    check(spark, ODD)
    assert spans.without_repeats(nothing).collect() == []
    assert spans.without_repeats(nothing).columns == nothing.columns


def test_passages(spark):
    passage = prose(70, 60)
    rows = [(i, f"{prose(80 + i, 40)}.\n{passage}\n{prose(180 + i, 30)}") for i in range(8)]
    rows += [(50, f"{passage}\n{prose(99, 20)}.\n{passage}"), (51, prose(98, 100))]
    check(spark, rows)
    texts = {r.doc_id: r.text for r in spans.without_repeats(documents(spark, rows)).collect()}
    middle = " ".join(passage.split()[20:40])
    held = [i for i, t in texts.items() if middle in " ".join(t.split())]
    assert held == [0] and texts[51] == rows[-1][1]


def test_common_lines_stay(spark):
    rows = [(i, f"All rights reserved.\n{prose(300 + i, 50)}") for i in range(5)]
    assert {r.doc_id: r.text for r in spans.without_repeats(documents(spark, rows)).collect()} == dict(rows)


def test_passages_without_ends_of_sentences(spark):
    """Passages of 55 words with no mark in them, between other texts."""
    passages = [" ".join(w for w in prose(500 + k, 90).replace(".", "").replace(",", "").split() if len(w) < 10)[:400] for k in range(12)]
    passages = [" ".join(p.split()[:55]) for p in passages]
    rows = [(10 * k + i, f"{prose(600 + 10 * k + i, 20)} {p} {prose(800 + 10 * k + i, 20)}") for k, p in enumerate(passages) for i in range(2)]
    check(spark, rows)
    texts = {r.doc_id: r.text for r in spans.without_repeats(documents(spark, rows)).collect()}
    for k, passage in enumerate(passages):
        assert len(passage.split()) > 50
        middle = " ".join(passage.split()[24:30])
        assert middle in texts[10 * k] and middle not in texts[10 * k + 1]
