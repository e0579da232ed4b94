"""HTML through the standard library's parser, a batch of pages at a time."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPACE = re.compile(r"\s+")

# The classes that mark a field of a dataset page, and a title's end.
FIELDS = {
    "views-field-field-program-type": "program",
    "views-field-field-data-file-category": "category",
    "views-field-field-availability": "availability",
}
TITLE_END = " | ResDAC"

_TEXT = T.StringType()
_LINK = T.StructType([T.StructField("href", _TEXT), T.StructField("text", _TEXT)])
PAGE = T.StructType([
    T.StructField("title", _TEXT), T.StructField("links", T.ArrayType(_LINK)), T.StructField("hrefs", T.ArrayType(_TEXT)), *(T.StructField(f, _TEXT) for f in FIELDS.values()),
])


def squeezed(s: str) -> str:
    return _SPACE.sub(" ", s).strip()


class Page(HTMLParser):
    """Title, first heading, links with their texts, and the three fields of a dataset page."""

    def __init__(self, html: str) -> None:
        super().__init__()
        self.text = {"title": [], "h1": []}
        self.inside: set[str] = set()
        self.links: list[tuple[str, str]] = []
        self.hrefs: list[str] = []
        self.link: tuple[str, list[str]] | None = None
        self.fields = dict.fromkeys(FIELDS.values(), "")
        self.depth, self.field, self.opened, self.held = 0, None, None, []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        at = dict(attrs)
        if tag == "title" or tag == "h1" and not self.text["h1"]:
            self.inside.add(tag)
        elif tag == "a" and at.get("href"):
            self.hrefs.append(at["href"])
            self.link = (at["href"], [])
        elif tag == "div":
            classes = (at.get("class") or "").split()
            self.depth += 1
            self.field = next((name for mark, name in FIELDS.items() if mark in classes), self.field)
            if self.field and "field-content" in classes:
                self.opened, self.held = self.depth, []

    def handle_data(self, data):
        for tag in self.inside:
            self.text[tag].append(data)
        if self.link:
            self.link[1].append(data)
        if self.opened is not None:
            self.held.append(data)

    def handle_endtag(self, tag):
        self.inside.discard(tag)
        if tag == "a" and self.link:
            self.links.append((self.link[0], squeezed("".join(self.link[1]))))
            self.link = None
        elif tag == "div":
            self.depth = max(0, self.depth - 1)
            if self.opened is not None and self.depth < self.opened:
                self.fields[self.field] = squeezed("".join(self.held))
                self.opened = self.field = None

    @property
    def title(self) -> str:
        return squeezed("".join(self.text["title"])) or squeezed("".join(self.text["h1"]))


@F.pandas_udf(PAGE)
def page(html: pd.Series) -> pd.DataFrame:
    """Title (or first heading), links and fields of each page, text or UTF-8; a NULL page is an empty one."""
    rows = []
    for h in html:
        p = Page(h.decode("utf-8", "replace") if isinstance(h, bytes) else h or "")
        rows.append((p.title, [{"href": a, "text": t} for a, t in p.links], p.hrefs, *(p.fields[f] for f in FIELDS.values())))
    return pd.DataFrame(rows, columns=["title", "links", "hrefs", *FIELDS.values()])


def written_title(html: Column) -> Column:
    """The first plain ``<title>`` element as SQL reads it: no heading in its place, NULL for a NULL page.

    Only four references are decoded, and only where a semicolon ends them; the parser
    of ``page`` reads more as HTML does (``&amp`` at an end, ``&#39;``, ``<TITLE>``).
    """
    held = F.regexp_replace(F.regexp_extract(html, "<title>([^<]*)</title>", 1), r"[\t\n\f\r ]+", " ")
    held = F.regexp_replace(held, r"\A\p{Zs}+|\p{Zs}+\z", "")
    for reference, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        held = F.replace(held, F.lit(reference), F.lit(sign))
    return held


_DROPPED = {"script", "style", "noscript", "template", "nav", "footer", "header", "aside", "form", "svg", "head", "title"}
_BLOCKS = {"p", "div", "section", "article", "main", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "table", "br", "blockquote", "pre", "dt", "dd"}


class _Main(HTMLParser):
    def __init__(self, html: str) -> None:
        super().__init__()
        self.skip: list[str] = []
        self.out: list[str] = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in _DROPPED:
            self.skip.append(tag)
        elif tag in _BLOCKS:
            self.out.append("\n")
        elif tag in ("td", "th"):
            self.out.append(" | " if self.out and self.out[-1].strip() else "")

    def handle_endtag(self, tag):
        if self.skip and tag in self.skip:
            while self.skip.pop() != tag:
                pass
        elif tag in _BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def main_text(html: str) -> str:
    """The readable text of a page: one line a block, cells of a table row on one line.

    Scripts, styles, navigation, headers, footers, forms and comments are left
    out.  These rules are this library's own.
    """
    lines = (squeezed(x) for x in "".join(_Main(html).out).split("\n"))
    return "\n".join(x for x in lines if x)


@F.pandas_udf(_TEXT)
def readable(html: pd.Series) -> pd.Series:
    return html.map(lambda h: main_text(h or ""))
