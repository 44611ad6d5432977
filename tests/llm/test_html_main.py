import random
import time

import pytest
from llm.cases import prose

from boardpulse.llm import html_main

A, B, C = (" ".join(prose(k, 40).split()) for k in (1, 2, 3))


def test_article_of_a_page():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no";</script></head>
    <body><nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- <p>old</p> --><div class="ad">buy {A}</div>
    <article><h1>Head &amp; more</h1><p><b>{A}<br>next</b> <i>line</i><p>Sh is.</p><div class="share">like it</div><p>{B}</p>
    <aside>see also</aside><p>end&nbsp;&lt;b&gt;</p><section id="comments"><article class="comment"><p>{C}</p></article></section></article>
    <form><p>{C}</p><input name="q"></form><footer>&copy; us {C}</footer></body></html>"""
    assert html_main.main_text(page).split("\n\n") == ["Head & more", f"{A} next line", "Sh is.", B, "end <b>"]


def test_page_without_marks():
    page = f"<body><div><a href=x>one</a> <a href=y>two</a></div><div>{A}</div><div>{B}</div><div class='sidebar'>{C}</div></body>"
    assert html_main.main_text(page) == f"{A}\n\n{B}"


def test_broken_pages():
    for page in (None, "", " ", "<", "<p", "<script>", "<!-- x", "<div class='", "</article></p>", "<nav>" * 5000):
        assert html_main.main_text(page) == ("" if page not in ("<",) else "<")
    assert html_main.main_text(f"<article><p>{A}") == A
    assert html_main.main_text("plain text only") == "plain text only"
    assert len(html_main.main_text("<article>" + "<p>word</p>" * 50_000)) == 50_000 * 6 - 2


def test_stretches():
    assert html_main.stretches([0, 5, 0, 0, 0, 7, 1, 0, 2, 0, 0, 0]) == [(1, 2), (5, 9)]
    assert html_main.stretches([]) == [] and html_main.stretches([3]) == [(0, 1)]


def test_frame(spark):
    rows = [(1, "u", f"<p>{A}</p>", "x"), (1, "u", f"<p>{A}</p>", "x"), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted(map(tuple, html_main.extracted(frame).collect()), key=str)
    assert found == [(1, "u", A, len(A)), (1, "u", A, len(A)), (None, None, "", 0)]
    assert html_main.extracted(frame.limit(0)).collect() == []


def test_short_parts_of_a_page_without_marks():
    """A short closing part stays, and a line that is mostly a link inside the text; a menu of links goes."""
    menu = "".join(f"<div><a href=x>{w}</a></div>" for w in A.split()[:6])
    page = f"<body>{menu}<div>{A} {B}</div><div>see <a href=y>the whole of it</a></div><div>{C}</div><div class=ad>buy</div><p>The end.</p>{menu}</body>"
    assert html_main.main_text(page).split("\n\n") == [f"{A} {B}", "see the whole of it", C, "The end."]


def test_missing_end_tags():
    assert html_main.main_text(f"<html><head><title>T</title><meta charset=x><body><p>{A}</p></body>") == A
    assert html_main.main_text(f"<head><link href=x><p>{A}") == A
    assert html_main.main_text(f"<article><p>{A}<p class=notice>old <b>news<p>{B}</article><p>{C}") == f"{A}\n\n{B}"
    assert html_main.main_text(f"<div><p class=notice>old</div><div>{B}</div>") == B
    assert html_main.main_text(f"<div><ul><li>{A}<li class=ad>buy<ul><li>x</ul>more<li>{B}</ul>{C}</div>") == f"{A}\n\n{B}\n\n{C}"
    assert html_main.main_text(f"<div><article><div class=ad>buy<p>x</article></div><main>{A}</main>") == A


def plain_end_by_start(names, name):
    """What a start tag ends, by walking all open elements."""
    for at in range(len(names) - 1, -1, -1):
        by, held = html_main._ENDED_BY.get(names[at], (frozenset(), frozenset()))
        if (name not in html_main._IN_HEAD if by is None else name in by) and held.isdisjoint(names[at + 1 :]):
            del names[at:]


def test_start_tags_end_what_a_walk_over_all_says():
    rng = random.Random(1)
    tags = "head p li dt dd td th tr ul ol dl table button div b object link menu tbody".split()
    for _ in range(3000):
        names, opened = [], html_main._Open()
        for name in rng.choices(tags, k=rng.randrange(25)):
            plain_end_by_start(names, name)
            opened.end_by_start(name)
            assert opened.names == names
            names.append(name)
            opened.push(name)
        for name in tags:
            assert opened.last(name) == max((i for i, n in enumerate(names) if n == name), default=-1)


@pytest.mark.parametrize("tags", ["<ul><li>", "<p><button>", "<div>", "<table><tr><td>", "<dl><dd><p>", "<p>", "<article><section>", "<a><b>"])
def test_a_megabyte_of_nesting_takes_seconds(tags):
    for page in (f"<nav>{tags * (1_000_000 // len(tags))}", tags * (1_000_000 // len(tags)) + f"<p>{A}"):
        start = time.process_time()
        html_main.main_text(page)
        assert time.process_time() - start < 60
