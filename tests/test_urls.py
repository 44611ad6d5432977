import itertools
from urllib.parse import urljoin, urlparse

from helpers import apply

from boardpulse.functions.urls import resolve_url, url_authority, url_path

ORIGIN = "https://m.example.org"

HEADS = ["", "/", "//", "///", "https:", "HTTPS://H.example.org", "//u@h:80", "http://x.org", "javascript:", "mailto:"]
PATHS = ["", "a", "a/b/", "../a", "/a/../b/./c", "a//b", "/a//b/..", "..", ".", "a b|c", "./a/..", "a/.../b", "/../../a/"]
TAILS = ["", "?", "?x=1&y=/b/../c", "#", "#f?g", "?q#f", ";p=1", ";p?q", "?a?b#c#d"]
HREFS = sorted({h + p + t for h, p, t in itertools.product(HEADS, PATHS, TAILS)})


def test_resolution_like_the_standard_library(spark):
    found = apply(spark, HREFS, lambda c: resolve_url(c, ORIGIN))
    expected = [urljoin(ORIGIN, href) for href in HREFS]
    assert [p for p in zip(HREFS, found, expected) if p[1] != p[2]] == []


def test_path_and_authority_like_the_standard_library(spark):
    urls = sorted({urljoin(ORIGIN, href) for href in HREFS})
    paths = apply(spark, urls, url_path)
    hosts = apply(spark, urls, url_authority)
    for url, path, host in zip(urls, paths, hosts):
        assert host == urlparse(url).netloc, url
        if urlparse(url).scheme in ("http", "https"):
            assert path == urlparse(url).path, url


def test_odd_links(spark):
    hrefs = ["/a\tb\nc", "\x01/a", "//[::1/x", "//[::1]/x", "x:y"]
    found = apply(spark, hrefs, lambda c: resolve_url(c, ORIGIN))
    assert found == [f"{ORIGIN}/abc", f"{ORIGIN}/a", None, "https://[::1]/x", "x:y"]
