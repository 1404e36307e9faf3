"""HTML pages to structs: a small document tree on the standard parser, and one Arrow-batched pass for each kind of page."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: An open element of this name ends where another begins.
CLOSES = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "option": {"option"}}
#: A text, an end tag, a start tag (name, attributes in double quotes, slash), a comment or a doctype that can be read in one way only.
TOKEN = re.compile(
    r"""(([^<]+)|</([a-z][a-z0-9]*)>|<(?!(?:script|style|textarea|title|iframe|noembed|noframes|noscript|plaintext|xmp)\b)([a-z][a-z0-9]*)((?:[ \n]+[a-z][a-z-]*="[^"<>&]*")*)[ ]?(/?)>|<!--[^<>-]*-->|<!(?:doctype|DOCTYPE) html>)"""
)
ATTR = re.compile(r'([a-z-]+)="([^"]*)"')
#: An address up to its path, the folder of that, and a reference to it, where joining them takes no thought: no segment is empty or
#: begins with a dot, and there are no parameters.
BASE = re.compile(r"(https?://[A-Za-z0-9.-]+(?::[0-9]+)?)(/(?:[A-Za-z0-9_~-][A-Za-z0-9_.~-]*/)*)(?:[A-Za-z0-9_~-][A-Za-z0-9_.~-]*)?")
HREF = re.compile(r"(/?(?:[A-Za-z0-9_~-][A-Za-z0-9_.~-]*/)*(?:([A-Za-z0-9_~-][A-Za-z0-9_.~-]*)|(?<=/)))(?:\?[A-Za-z0-9_.~=&-]+)?")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "tags")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.tags: dict[str, list[Node]] | None = None  # of a whole page: its nodes by tag, in their order

    def walk(self) -> Iterator[Node]:
        ahead = self.children[::-1]
        while ahead:
            c = ahead.pop()
            if isinstance(c, Node):
                yield c
                ahead += c.children[::-1]

    def has_class(self, name: str) -> bool:
        return name in (self.attrs.get("class") or "").split()

    def all(self, tag: str | None = None, cls: str | None = None, where: Callable[[Node], bool] | None = None) -> list[Node]:
        return list(self._each(tag, cls, where))

    def first(self, tag: str | None = None, cls: str | None = None, where: Callable[[Node], bool] | None = None) -> Node | None:
        return next(self._each(tag, cls, where), None)

    def _each(self, tag: str | None, cls: str | None, where: Callable[[Node], bool] | None) -> Iterator[Node]:
        nodes = self.tags.get(tag, ()) if self.tags is not None and tag is not None else self.walk()
        return (n for n in nodes if (tag is None or n.tag == tag) and (cls is None or n.has_class(cls)) and (where is None or where(n)))

    def inside(self, tag: str, cls: str | None = None) -> bool:
        p = self.parent
        while p is not None:
            if p.tag == tag and (cls is None or p.has_class(cls)):
                return True
            p = p.parent
        return False

    def texts(self, without: str | None = None) -> Iterator[str]:
        for c in self.children:
            if isinstance(c, str):
                yield c
            elif c.tag != without:
                yield from c.texts(without)

    def text(self, without: str | None = None) -> str:
        """All text nodes, each stripped, joined with nothing between them."""
        kids = self.children
        if len(kids) == 1 and isinstance(kids[0], str):
            return kids[0].strip()
        return "".join([t.strip() for t in self.texts(without)])


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def _tokens(self, data: str) -> list[tuple] | None:
        """The tokens of a stretch that is nothing else."""
        tokens = TOKEN.findall(data) if not self.rawdata and self.cdata_elem is None else []
        return tokens if sum([len(t[0]) for t in tokens]) == len(data) else None

    def feed(self, data: str) -> None:
        """As the standard parser does it, which takes several times as long: a stretch that is all tokens is cut by one pattern."""
        tokens = self._tokens(data)
        if tokens is None:
            super().feed(data)
            return
        start, empty, ended, said = self.handle_starttag, self.handle_startendtag, self.handle_endtag, self.handle_data
        for _, text, end, tag, attrs, slash in tokens:
            if text:
                said(unescape(text) if "&" in text else text)
            elif end:
                ended(end)
            elif tag:
                (empty if slash else start)(tag, ATTR.findall(attrs) if attrs else ())

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        at, ends = self.at, CLOSES.get(tag)
        while ends and at.tag in ends and at.parent is not None:
            at = at.parent
        node = Node(tag, dict(attrs), at)
        at.children.append(node)
        self.at = at if tag in VOID else node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, dict(attrs), self.at))

    def handle_endtag(self, tag: str) -> None:
        p = self.at
        while p.parent is not None:
            if p.tag == tag:
                self.at = p.parent
                return
            p = p.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


class _Indexed(_Builder):
    """Keeps the nodes of a page by tag as well."""

    def __init__(self) -> None:
        super().__init__()
        self.root.tags = {}

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        super().handle_starttag(tag, attrs)
        # a void element is the last child of the place, any other one is the place
        self.root.tags.setdefault(tag, []).append(self.at.children[-1] if tag in VOID else self.at)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        super().handle_startendtag(tag, attrs)
        self.root.tags.setdefault(tag, []).append(self.at.children[-1])

    def feed(self, data: str) -> None:
        """As above, without a call for each token."""
        tokens = self._tokens(data)
        if tokens is None:
            HTMLParser.feed(self, data)
            return
        at, tags = self.at, self.root.tags
        for _, text, end, tag, attrs, slash in tokens:
            if text:
                at.children.append(unescape(text) if "&" in text else text)
            elif tag:
                if not slash and tag in CLOSES:
                    ends = CLOSES[tag]
                    while at.tag in ends and at.parent is not None:
                        at = at.parent
                node = Node(tag, dict(ATTR.findall(attrs)) if attrs else {}, at)
                at.children.append(node)
                if tag in tags:
                    tags[tag].append(node)
                else:
                    tags[tag] = [node]
                if not slash and tag not in VOID:
                    at = node
            elif end:
                p = at
                while p.parent is not None:
                    if p.tag == end:
                        at = p.parent
                        break
                    p = p.parent
        self.at = at

    def updatepos(self, i: int, j: int) -> int:
        return j  # nobody asks for lines


def parse(html: str) -> Node:
    builder = _Indexed()
    builder.feed(html)
    builder.close()
    return builder.root


def _meta(tree: Node, key: str) -> str | None:
    node = tree.first("meta", where=lambda n: n.attrs.get("property") == key) or tree.first("meta", where=lambda n: n.attrs.get("name") == key)
    return ((node.attrs.get("content") or "").strip() or None) if node else None


def _joiner(url: str) -> Callable[[str], tuple[str, str | None]]:
    """A function from a reference on the page at url to its address, as urljoin gives it, and to the last segment of its path, None where
    that isn't at hand. The url is cut once."""
    base = BASE.fullmatch(url)

    def join(href: str) -> tuple[str, str | None]:
        ref = HREF.fullmatch(href) if base else None
        if ref is None:
            return urljoin(url, href), None
        return (base[1] if href[0] == "/" else base[1] + base[2]) + href, ref[2] or ""

    return join


def _file_links(tree: Node, url: str) -> list[dict]:
    out, join = [], _joiner(url)
    for a in tree.all("a", where=lambda n: bool(n.attrs.get("href")) and n.inside("li") and n.inside("ul", "list-file")):
        full, last = join(a.attrs["href"])
        own = lambda at=full, last=last: urlparse(at).path.rsplit("/", 1)[-1] if last is None else last
        name = (a.attrs.get("download") or a.text() or own()).strip().rstrip("/").rsplit("/", 1)[-1] or own()
        if name:
            out.append({"url": full, "name": name})
    return out


def challenge_page(html: str, url: str) -> dict:
    """The parts of a challenge page, not yet interpreted."""
    tree = parse(html)
    markdown, h1 = tree.first("div", "markdown"), tree.first("h1")
    authors, join = [], _joiner(url)
    for img in tree.all("img", "avatar"):
        name = img.parent.first(cls="font-monospace") if img.parent is not None else None
        if name is not None and name.text():
            authors.append(name.text())
    return {
        "og_title": _meta(tree, "og:title"),
        "keywords": _meta(tree, "keywords"),
        "h1": h1.text() if h1 else None,
        "badges": [{"slug": (a.attrs.get("href") or "").rstrip("/").rsplit("/", 1)[-1], "label": a.text()} for a in tree.all("a", "badge")],
        "stars": len(tree.all("use", where=lambda n: n.attrs.get("href") == "#star-fill")),
        "description": (markdown.text(without="h2") or None) if markdown else None,
        "authors": authors,
        "writeups": list(dict.fromkeys(join(a.attrs["href"])[0] for a in tree.all("a", where=lambda n: "/writeups/" in (n.attrs.get("href") or "")))),
        "files": _file_links(tree, url),
    }


class _Rows(_Builder):
    """Gives the rows of a page's tables as they end, and forgets them: what is held is the row at hand and what encloses it. A
    row inside another's cell ends with the outer one, and comes after it."""

    def __init__(self) -> None:
        super().__init__()
        self.ended: list[Node] = []
        self.outer: Node | None = None

    def _left(self) -> None:
        """Called when elements may have ended: the outermost open row has, unless the place is still in it."""
        if self.outer is not None:
            at = self.at
            while at is not None and at is not self.outer:
                at = at.parent
            if at is None:
                self.ended.append(self.outer)
                self.outer.parent.children.remove(self.outer)
                self.outer = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        super().handle_starttag(tag, attrs)
        if tag in CLOSES:
            self._left()
        if tag == "tr" and self.outer is None:
            self.outer = self.at
        elif self.outer is None:
            self._forget()

    def handle_endtag(self, tag: str) -> None:
        super().handle_endtag(tag)
        self._left()
        if self.outer is None:
            self._forget()

    def handle_data(self, data: str) -> None:
        if self.outer is not None:
            super().handle_data(data)

    def _forget(self) -> None:
        """Outside of rows only the open elements are kept."""
        self.at.children.clear()


#: Characters of a page that are parsed at a time, and rows of a batch.
SLICE, BATCH = 1 << 16, 4_096


def rows_of_page(html: str) -> Iterator[Node]:
    """The rows of all tables of a page in the order they begin, each as soon as it has ended."""
    builder, at = _Rows(), 0
    while at < len(html):
        # a slice ends before a tag, so that no text is cut in two
        to = html.find("<", at + SLICE)
        builder.feed(html[at : to if to >= 0 else len(html)])
        at = to if to >= 0 else len(html)
        ended, builder.ended = builder.ended, []
        for row in ended:
            yield row
            yield from row.all("tr")
    builder.close()
    for row in [*builder.ended, *([builder.outer] if builder.outer is not None else [])]:
        yield row
        yield from row.all("tr")


def task_rows(html: str) -> Iterator[dict]:
    """The rows of an event's task table: the first task link of each, its points and labels."""
    seen: set[int] = set()
    for row in rows_of_page(html):
        link = row.first("a", where=lambda n: (n.attrs.get("href") or "").startswith("/task/")) if row.inside("table", "table-striped") else None
        found = re.search(r"/task/(\d+)", link.attrs["href"]) if link else None
        if found and int(found[1]) not in seen:
            seen.add(int(found[1]))
            within = list(row.walk())
            cells, labels = [n for n in within if n.tag == "td"], [n.text() for n in within if n.tag == "span" and n.has_class("label")]
            yield {"id": int(found[1]), "name": link.text() or f"task-{found[1]}", "points": cells[1].text() if len(cells) > 1 else None, "tags": [s for s in labels if s]}


def writeup_rows(html: str) -> Iterator[dict]:
    """The rows of a task's writeup table."""
    seen: set[int] = set()
    for row in rows_of_page(html):
        link = row.first("a", where=lambda n: (n.attrs.get("href") or "").startswith("/writeup/"))
        found = re.search(r"/writeup/(\d+)", link.attrs["href"]) if link else None
        if found and int(found[1]) not in seen:
            seen.add(int(found[1]))
            cells, team = row.all("td"), row.first("a", where=lambda n: (n.attrs.get("href") or "").startswith("/team/"))
            yield {"id": int(found[1]), "rating": cells[1].text() if len(cells) > 1 else None, "author": team.text() if team else None}


ROWS = {
    task_rows: "id bigint, name string, points string, tags array<string>",
    writeup_rows: "id bigint, rating string, author string",
}


def table_rows(read: Callable[[str], Iterator[dict]], pages: DataFrame, html: str = "html") -> DataFrame:
    """pages without their html, joined with the rows that one of the readers above finds in each: pos, from 0, and its columns.
    Rows leave a page in batches while it is parsed; a page that can't be read to its end gives the rows before that, and one
    with `error` alone. A null page has no rows. (A lateral join takes no Arrow table function, and a plain one holds all rows of
    a page; so the pages are mapped.)"""
    keep = [f for f in pages.schema if f.name != html]
    kinds = T.StructType.fromDDL(f"pos int, {ROWS[read]}, error string")
    schema = T.StructType([*keep, *kinds])
    arrow = [pa.list_(pa.string()) if isinstance(f.dataType, T.ArrayType) else {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[f.dataType.simpleString()] for f in kinds]

    def found(page: str | None) -> Iterator[list[dict]]:
        batch: list[dict] = []
        try:
            for pos, row in enumerate(read(page) if page is not None else ()):
                batch.append({"pos": pos, **row})
                if len(batch) == BATCH:
                    yield batch
                    batch = []
        except Exception as e:  # noqa: BLE001
            batch.append({"error": f"{type(e).__name__}: {e}"})
        if batch:
            yield batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(len(keep))
            held, of = [], []
            for i in range(batch.num_rows):
                for rows in found(text[i].as_py()):
                    held, of = held + rows, of + [i] * len(rows)
                    if len(held) >= BATCH:
                        yield joined(batch, held, of)
                        held, of = [], []
            if held:
                yield joined(batch, held, of)

    def joined(batch: pa.RecordBatch, rows: list[dict], of: list[int]) -> pa.RecordBatch:
        at = pa.array(of, pa.int64())
        return pa.RecordBatch.from_arrays([*[batch.column(i).take(at) for i in range(len(keep))], *[pa.array([r.get(f.name) for r in rows], t) for f, t in zip(kinds, arrow, strict=True)]], names=schema.names)

    return pages.select(*[F.col(f"`{f.name}`") for f in keep], F.col(f"`{html}`")).mapInArrow(run, schema)


def writeup_page(html: str, _: str) -> dict:
    """The text on a writeup's page, and the link of a writeup that is elsewhere."""
    tree = parse(html)
    body = tree.first("div", "well", where=lambda n: n.attrs.get("id") == "id_description")
    external = None
    for well in tree.all("div", "well", where=lambda n: n.attrs.get("id") != "id_description"):
        said = "".join(well.texts()).lower()
        link = well.first("a", where=lambda n: "href" in n.attrs)
        if ("original writeup" in said or "official writeup" in said) and link and (link.attrs["href"] or "").lower().startswith("http"):
            external = link.attrs["href"]
            break
    return {"body": (body.text() or None) if body else None, "external": external}


def page_facts(html: str, _: str) -> dict:
    """Title, first heading and links of any page."""
    tree = parse(html)
    title, h1 = tree.first("title"), tree.first("h1")
    return {"title": title.text() if title else None, "h1": h1.text() if h1 else None, "links": [a.attrs["href"] for a in tree.all("a", where=lambda n: bool(n.attrs.get("href")))]}


SCHEMAS = {
    challenge_page: "og_title string, keywords string, h1 string, badges array<struct<slug:string,label:string>>, stars int, description string, authors array<string>, writeups array<string>, files array<struct<url:string,name:string>>",
    writeup_page: "body string, external string",
    page_facts: "title string, h1 string, links array<string>",
}


def _arrow(kind: T.DataType) -> pa.DataType:
    """The Arrow type of what readers give."""
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind])
    return pa.list_(_arrow(kind.elementType)) if isinstance(kind, T.ArrayType) else {"string": pa.string(), "int": pa.int32()}[kind.simpleString()]


def parsed(read: Callable[[str, str], dict], html: Column, url: Column | None = None) -> Column:
    """What one of the readers above finds in a page, with `error` for a page that couldn't be read; a bad page is never
    fatal. A page is parsed once and where the plan says: not again for a filter, nor before rows are dealt over the cores."""
    schema = SCHEMAS[read] + ", error string"
    kind = _arrow(T.StructType.fromDDL(schema))

    @F.arrow_udf(schema)
    def run(pages: pa.Array, urls: pa.Array) -> pa.Array:
        out = []
        for page, at in zip(pages.to_pylist(), urls.to_pylist(), strict=True):
            try:
                out.append(read(page, at or "") if page is not None else {})
            except Exception as e:  # noqa: BLE001
                out.append({"error": f"{type(e).__name__}: {e}"})
        return pa.array(out, kind)

    return run.asNondeterministic()(html, F.lit("") if url is None else url)


@F.pandas_udf(T.StringType())
def join_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """The href as seen from the page."""
    return pd.Series([None if b is None or h is None else urljoin(b, h) for b, h in zip(base, href, strict=True)], dtype=object)
