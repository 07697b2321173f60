"""HTML reader: the standard parser behind an Arrow UDF."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvidex.functions import slices

_HEADING = T.StructType([T.StructField("level", T.StringType()), T.StructField("text", T.StringType())])
SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("text", "title", "description", "keywords")] + [T.StructField("links", T.ArrayType(T.StringType())), T.StructField("headings", T.ArrayType(_HEADING))])


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.skipped, self.parts, self.links, self.headings = 0, [], [], []
        self.meta: dict[str, str] = {}
        self.open: tuple[str, list[str]] | None = None
        self.title: list[str] = []
        self.in_title = False

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        if tag in ("script", "style"):
            self.skipped += 1
        elif tag == "a" and own.get("href"):
            self.links.append(own["href"])
        elif tag in ("h1", "h2", "h3"):
            self.open = (tag, [])
        elif tag == "meta" and own.get("name"):
            self.meta[own["name"].lower()] = own.get("content") or ""
        elif tag == "title":
            self.in_title = True

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skipped = max(0, self.skipped - 1)
        elif self.open and tag == self.open[0]:
            self.headings.append({"level": tag, "text": " ".join("".join(self.open[1]).split())})
            self.open = None
        elif tag == "title":
            self.in_title = False

    def handle_data(self, data):
        if self.skipped:
            return
        if self.in_title:
            self.title.append(data)
        if self.open:
            self.open[1].append(data)
        self.parts.append(data)


def parse(html: str | None) -> dict:
    """Text, title, meta tags, links and headings of a page."""
    page = _Page()
    page.feed(html or "")
    page.close()
    text = "\n".join(x for x in (" ".join(p.split()) for p in "".join(page.parts).split("\n")) if x)
    return {"text": text, "title": "".join(page.title).strip(), "description": page.meta.get("description"), "keywords": page.meta.get("keywords"), "links": page.links, "headings": page.headings}


_parsed = slices.each(SCHEMA, parse)


def page_fields(html: Column) -> Column:
    return _parsed(html)


def read_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``, ``title``, ``description``, ``keywords``, ``links`` and ``headings`` in place of the HTML."""
    return pages.withColumn("__p", page_fields(F.col(html_col))).select(*[c for c in pages.columns if c != html_col], "__p.*")
