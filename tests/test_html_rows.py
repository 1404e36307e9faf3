"""Rows of HTML tables: against the whole document tree, over slices, and a page of 100,000 rows."""

import random
import resource

import pytest
from pyspark.sql import functions as F

from weir.functions import html


def from_tree(page):
    """The rows as the document tree has them, all at once."""
    return html.parse(page).all("tr")


def facts(row):
    return row.text(), [n.tag for n in row.walk()], [n.attrs for n in row.walk()], row.inside("table", "table-striped"), row.inside("table")


PARTS = [
    "<table class='x table-striped'>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "text ", " a < b ", "&amp; &lt", "<a href='/task/7'>", "</a>", "<br/>", "<p>", "</p>", "<!-- <tr> -->", "<script>x = '<tr>'</script>",
    "<span class=label>", "</span>", "<div>", "</div>", "</body>", "<li>", "é <", "<td><table><tr><td>in</td></tr></table></td>", "<", ">", "<tr", "\n",
]


@pytest.mark.parametrize("seed", range(60))
def test_rows_as_the_whole_tree_has_them(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(html, "SLICE", rng.choice([1, 7, 64, 1 << 16]))
    page = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 120)))
    assert [facts(r) for r in html.rows_of_page(page)] == [facts(r) for r in from_tree(page)]


def big(n):
    return "<html><table class='table table-striped'>" + "".join(f"<tr><td><a href='/task/{i}'>Task {i} &amp; more</a></td><td>{i % 500}</td><td><span class=label>web</span></td></tr>" for i in range(n)) + "</table>"


def test_a_page_of_100_000_rows(spark):
    page = spark.range(1).select(F.lit("p").alias("page"), F.concat(F.lit("<table class='table-striped'>"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(100_000)), lambda i: F.concat(F.lit("<tr><td><a href='/task/"), i.cast("string"), F.lit("'>T "), i.cast("string"), F.lit("</a></td><td>5</td></tr>"))), "")).alias("html"))
    got = html.table_rows(html.task_rows, page).agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.max("pos").alias("last"), F.count("error").alias("errors"), F.min("name").alias("name")).first()
    assert got[:] == (100_000, 100_000, 99_999, 0, "T 1")


def test_memory_is_a_row_not_a_page():
    page = big(100_000)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    n = sum(1 for _ in html.task_rows(page))
    assert n == 100_000 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 60_000  # kB; the tree of the page takes over 500 MB


def test_joined_rows(spark, monkeypatch):
    def broken(page):
        for row in html.task_rows(page):
            if row["id"] == 3:
                raise ValueError("no")
            yield row

    monkeypatch.setitem(html.ROWS, broken, html.ROWS[html.task_rows])
    pages = spark.createDataFrame([(1, big(2), "x"), (2, None, "x"), (3, "", "x"), (4, "<table><tr><td>no link", "x"), (5, big(5) + big(2), "x")], "k long, html string, pos_ string")
    assert sorted((r["k"], r["pos"], r["id"], r["name"], r["points"], r["tags"], r["error"]) for r in html.table_rows(html.task_rows, pages).collect()) == sorted((k, i, i, f"Task {i} & more", str(i), ["web"], None) for k, n in ((1, 2), (5, 5)) for i in range(n))
    found = html.table_rows(broken, pages.where("k = 5")).collect()
    assert [r["id"] for r in found] == [0, 1, 2, None] and "no" in found[-1]["error"]
    assert html.table_rows(html.writeup_rows, pages.limit(0)).count() == 0


def seen(builder, page):
    """The tree that a parser makes of a page."""
    builder.feed(page)
    builder.close()
    show = lambda n: n if isinstance(n, str) else (n.tag, n.attrs, [show(c) for c in n.children])
    return show(builder.root), {t: [id(n) for n in ns] for t, ns in builder.root.tags.items()}, {t: [id(n) for n in builder.root.walk() if n.tag == t] for t in builder.root.tags}


class Standard(html._Indexed):
    """Every page by the standard parser."""

    def feed(self, data):
        html.HTMLParser.feed(self, data)


PLAIN = ["<!doctype html>", "<!DOCTYPE html>", "<!-- c -->", "<!---->", '<a href="/x?a=1;b" class="badge big">', '<a\n href="q">', '<a href="1" href="2">', "<br>", "<br/>", "<img />", '<use href="#s"></use>', "</br>", "<h1>", "</h1>", "R&amp;D &lt b &amp", "&#39;x;", " > ", "\n\t "]
ODD = ["<title>a &amp; <b>", "</title>", "<textarea><p>", "<style>p > a", "<a href='x'>", "<a href=x/>", '<a href="x&amp;y">', "<A HREF=\"x\">", "<option selected>", "<![CDATA[x]]>", "<?php x ?>", "<!-->", "<!--->", "<!-- a - b --!>", "</ p>", "</p x>", "<p", '<a href="x', "<1>", "<a-b>", "<noscript><p>", "\x00", "<svg/ >", '<p a="1"b="2">']


@pytest.mark.parametrize("seed", range(400))
def test_a_page_cut_by_the_pattern_is_that_of_the_standard_parser(seed):
    rng = random.Random(seed)
    parts = PLAIN + [p for p in PARTS if p[0] != "<" or p[-1] == ">"] + (ODD if seed % 2 else [])
    page = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
    got, want = seen(html._Indexed(), page), seen(Standard(), page)
    assert got[0] == want[0] and got[1] == got[2]


def test_the_given_pages_take_the_pattern_alone(monkeypatch):
    monkeypatch.setattr(html.HTMLParser, "goahead", lambda self, end: None if not self.rawdata else pytest.fail("read by the standard parser"))
    assert len(list(html.task_rows(big(10).replace("'", '"').replace("class=label", 'class="label"').replace("&amp;", "&lt;")))) == 10
    page = '<!doctype html><html><head><meta property="og:title" content="T"></head><body><h1>H</h1><a class="badge" href="/tags/t1/">T</a><br/></body></html>'
    assert html.challenge_page(page, "https://h.org/")["og_title"] == "T"
