from html.parser import HTMLParser

import duckdb
from helpers import apply
from pyspark.sql import functions as F

from boardpulse.functions.markup import anchors, subject_title, title_tag, visible_lines

HIDDEN = {"script", "style", "template", "rt", "rp"}


class Texts(HTMLParser):
    """Collects the texts between tags and comments."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.texts = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in HIDDEN
        self.texts.append("")

    def handle_endtag(self, tag):
        self.hidden -= tag in HIDDEN
        self.texts.append("")

    def handle_comment(self, data):
        self.texts.append("")

    def handle_data(self, data):
        if not self.hidden:
            self.texts[-1] += data


def parsed_lines(html):
    parser = Texts()
    parser.feed(html)
    parser.close()
    return [ln.strip() for text in parser.texts for ln in text.splitlines() if ln.strip()]


def test_visible_lines_like_a_parser(spark):
    pages = [
        "<p>a<!-- x -->b</p>",
        "<P CLASS='x>y'>one<br>two</P >three",
        "<script>var t='</p>';</script>shown<style>p{}</style >",
        "<SCRIPT src=a>x</SCRIPT>y<template><b>no</b></template><ruby>k<rp>(</rp><rt>r</rt></ruby>",
        "a &lt;b&gt; c &amp;lt; &#65;\r\n　 d\x0be",
        '<a title="a>b" data-x=\'<i>\'>link</a>',
        "<!DOCTYPE html><html><title>t</title><body>    </body>",
        "1 < 2 and <3",
        "",
    ]
    assert apply(spark, pages, visible_lines) == [parsed_lines(p) for p in pages]


def test_visible_lines_of_the_given_pages(spark):
    path = "/root/testdata/sf0.01/pages.parquet"
    pages = [row[0] for row in duckdb.sql(f"SELECT html FROM '{path}'").fetchall()]
    assert apply(spark, pages, visible_lines) == [parsed_lines(p) for p in pages]


def test_broken_markup_is_not_text(spark):
    pages = ["x<p cla", "x<!-- open", "x<script>open", "x<b", "<a b='>t"]
    assert apply(spark, pages, visible_lines) == [["x"], ["x"], ["x"], ["x"], ["t"]]


def test_unclosed_elements(spark):
    pages = [
        "a<rt>b<p>c",
        "a<rt>b<rt>c</rt>d",
        "a<template>b<i>c</i></template>d",
        "a<ruby>b<rtc>c</rtc><RT>d</Rt></ruby>",
        "a<rt ",
        "a<style ",
    ]
    expected = [["a", "b", "c"], ["a", "b", "d"], ["a", "d"], ["a", "b", "c"], ["a"], ["a"]]
    assert apply(spark, pages, visible_lines) == expected


def test_long_broken_pages_take_linear_time(spark):
    """Parts that repeat without an end would take hours by backtracking."""
    parts = ["<rt>x", "<rt ", "<script ", "<!--", "<a href=", "<a href='", '<b c="', "&#", "&amp", "<a ", "=\"'", "<", "\n "]
    pages = [part * 60_000 for part in parts]
    found = apply(spark, pages, visible_lines)
    assert len(found[0]) == 60_000
    links = apply(spark, pages, lambda c: F.size(anchors(c)), "string")
    assert links[4] == 60_000 and links[9] == 0


def test_anchors(spark):
    html = """
      <a name="n">none</a> <!-- <a href="/no">no</a> --> <script>'<a href="/no">'</script>
      <A HREF = ' /one?a=1&amp;b=2 '>1</A><abbr href="/no">no</abbr>
      <a data-href="/no" title=" href='/no' " href=/two>2<b>x</b>
      <a href="/three"
         class="c">3</a> <a href>4</a> <a href="">5<a href='it"s'>6</a>"""
    found = apply(spark, [html], anchors)[0]
    assert [(a["href"], a["inner"].strip()) for a in found] == [
        ("/one?a=1&b=2", "1"),
        ("/two", "2<b>x</b>"),
        ("/three", "3"),
        ("", "4"),
        ("", "5"),
        ('it"s', "6"),
    ]


def titles(spark, inners, tags):
    return apply(spark, inners, lambda c: subject_title(c, title_tag(c, tags)))


def test_subject_titles(spark):
    tags = ("strong", "span", "div")
    cases = {
        "plain": None,
        "<span class=subject>a</span>": "a",
        "<div class='x subject y'> a <b>b</b>　c</div> d": "abc",
        "<div class='subject'>d</div><span class='subject'>s</span><strong class='subject'>t</strong>": "t",
        "<div class='subject'>d</div><span class='subject'>s</span>": "s",
        "<strong class='subject'> </strong><span class='subject'>s</span>": "",
        "<strong class='subjects'>x</strong><strong data-class='subject'>y</strong>": None,
        "<strong class='Subject'>x</strong>": None,
        "<STRONG CLASS='subject'>x</STRONG>y": "x",
        "<strong class='subject'><strong>[q]</strong> a <strong><strong>b</strong></strong>c</strong>d": "[q]abc",
        "<strong class='subject'>a<!>b &lt;3 <3</strong>": "ab <3 <3",
        "<strong class='subject'>open <i>end": "openend",
        "<span title=\"class='subject'\">no</span>": None,
        "<span class='subject'>1</span><span class='subject'>2</span>": "1",
    }
    assert titles(spark, list(cases), tags) == list(cases.values())


def test_subject_titles_of_other_layouts(spark):
    inners = ["<strong class='subject'>x</strong>", "<span class='subject'>y</span>"]
    assert titles(spark, inners, ("span",)) == [None, "y"]
    assert titles(spark, [" 비 오는 <b>저녁</b> "], ("a",)) == ["비 오는저녁"]


def test_hidden_text_in_titles(spark):
    html = "<a href='/x'><span class='subject'>a<rt>no</rt> b<style>no</style>c</span></a>"
    found = apply(spark, [html], lambda c: F.transform(anchors(c), lambda a: a.inner))[0]
    assert titles(spark, found, ("span",)) == ["abc"]
