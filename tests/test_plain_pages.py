"""Plain pages are read without a call for each token or link, and as the standard parser and urljoin have them."""

import random
from urllib.parse import urljoin, urlparse

import pytest

from weir.functions import html

PARTS = ['<ul class="list-file">', "</ul>", "<li>", "</li>", '<a href="/f/1.zip" download="x">', "</a>", "<p>", "</p>", "<br>", "<br/>", '<svg><use href="#s"/></svg>', "text ", "&amp;", "<tr>", "<td>", "</div>", '<div class="a b">', "<!-- x -->", "<!doctype html>", "<img>"]
PAGE = '<html><head><meta property="og:title" content="A"></head><body><div class="markdown"><p>said</p></div><a href="/w/writeups/1">w</a><ul class="list-file"><li><a href="/f/1.zip">x</a></li><li><a href="g/last.bin?v=1"></a></li></ul></body></html>'


def shape(node):
    return [c if isinstance(c, str) else (c.tag, c.attrs, shape(c)) for c in node.children]


def test_a_plain_page_takes_no_calls(monkeypatch):
    def never(*_):
        raise AssertionError

    for name in ("urljoin", "urlparse"):
        monkeypatch.setattr(html, name, never)
    for name in ("handle_starttag", "handle_endtag", "handle_data"):
        monkeypatch.setattr(html._Indexed, name, never)
    found = html.challenge_page(PAGE, "https://h.org/en/c/part-1/")
    assert found["files"] == [{"url": "https://h.org/f/1.zip", "name": "x"}, {"url": "https://h.org/en/c/part-1/g/last.bin?v=1", "name": "last.bin"}]
    assert found["writeups"] == ["https://h.org/w/writeups/1"] and found["description"] == "said"


@pytest.mark.parametrize("seed", range(20))
def test_the_tree_is_that_of_the_standard_parser(seed, monkeypatch):
    rng = random.Random(seed)
    pages = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(20)]
    fast = [html.parse(p) for p in pages]
    monkeypatch.setattr(html._Builder, "_tokens", lambda self, data: None)
    for got, page in zip(fast, pages, strict=True):
        want = html.parse(page)
        assert shape(got) == shape(want)
        assert {t: [n.attrs for n in ns] for t, ns in got.tags.items()} == {t: [n.attrs for n in ns] for t, ns in want.tags.items()}


@pytest.mark.parametrize("base", ["https://h.org/en/part-1/", "http://a.b:80/x/y.html", "https://h.org/", "https://h.org", "https://h.org/a//b/", "https://h.org/a/../b", "https://h.org/a?x=1", "https://h.org/a;p/b", "ftp://h/a", "a/b", "", "https://h.org/a/\n"])
def test_links_are_those_of_urljoin(base):
    rng, join = random.Random(1), html._joiner(base)
    for _ in range(5_000):
        href = "".join(rng.choice(["/", "a", "b.c", ".", "..", "?", "=", "1", "#", ";", "&", "~", ":", "%20", "\n", " "]) for _ in range(rng.randint(1, 8)))
        full, last = join(href)
        assert full == urljoin(base, href)
        assert last is None or last == urlparse(full).path.rsplit("/", 1)[-1]
