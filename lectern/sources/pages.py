"""Article fields from stored web pages.

The reference crawls a site and reads fields with CSS selectors; we start
from stored pages and read the same fields with the standard library's HTML
parser inside ``mapInPandas`` (one parser per batch, no shuffle). Which
elements hold the title, author, date, tags and body are parameters.
"""

from __future__ import annotations

from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import normalize_date, normalize_text, normalize_title


@dataclass(frozen=True)
class Selectors:
    """An element is (tag, attribute, value); attribute None matches any."""
    title: tuple = ("title", None, None)
    author: tuple = ("h3", "id", "text-author")
    date: tuple = ("div", "id", "textdate")
    tag: tuple = ("a", "class", "text-topics-item")
    body: tuple = ("article", None, None)
    skip: tuple = ("script", "style")


class _Fields(HTMLParser):
    def __init__(self, sel: Selectors):
        super().__init__(convert_charrefs=True)
        self.sel = sel
        self.stack: list[tuple[str, set]] = []
        self.parts = {"title": [], "author": [], "date": [], "tag": [], "body": []}
        self.tag_items: list[list[str]] = []
        self.lang = None

    @staticmethod
    def _matches(spec, tag, attrs) -> bool:
        name, attr, value = spec
        if tag != name:
            return False
        if attr is None:
            return True
        got = dict(attrs).get(attr)
        if got is None:
            return False
        return value in got.split() if attr == "class" else got == value

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            self.lang = dict(attrs).get("lang")
        if tag in ("br", "meta", "img", "hr", "input", "link"):
            return
        roles = set()
        for field in ("title", "author", "date", "tag", "body"):
            if self._matches(getattr(self.sel, field), tag, attrs):
                roles.add(field)
        if "tag" in roles:
            self.tag_items.append([])
        if tag in self.sel.skip:
            roles.add("skip")
        self.stack.append((tag, roles))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        active = set()
        for _, roles in self.stack:
            active |= roles
        if "skip" in active:
            return
        for field in ("title", "author", "date", "body"):
            if field in active:
                self.parts[field].append(data)
        if "tag" in active and self.tag_items:
            self.tag_items[-1].append(data)

    def text_of(self, field: str, joined_by: str | None = None) -> str:
        """The field's first text node, or all that are not blank, joined."""
        nodes = map(str.strip, self.parts[field])
        return next(nodes, "") if joined_by is None else joined_by.join(filter(None, nodes))

    def tags(self) -> list[str]:
        return list(filter(None, map(str.strip, map("".join, self.tag_items))))


def extract_fields(html: str | None, sel: Selectors = Selectors()) -> dict:
    """P2 on one page: title, author, date, tags, body, lang."""
    p = _Fields(sel)
    if html:
        p.feed(str(html))
        p.close()
    return {"title": p.text_of("title"), "author": p.text_of("author"), "published_at": p.text_of("date", ""),
            "tags": p.tags(), "text": p.text_of("body", " "), "lang": p.lang}


PAGE_SCHEMA = ("page_id long, url string, title string, author string, published_at string, "
               "tags array<string>, text string, lang string")


def extract_articles(pages: DataFrame, sel: Selectors = Selectors()) -> DataFrame:
    """Pages (page_id, url, html) -> article fields, one row per page."""
    def run(batches):
        for pdf in batches:
            rows = [extract_fields(h, sel) for h in pdf["html"]]
            out = pd.DataFrame(rows, columns=["title", "author", "published_at", "tags", "text", "lang"])
            out.insert(0, "url", pdf["url"].values)
            out.insert(0, "page_id", pdf["page_id"].values)
            yield out
    return pages.select("page_id", "url", "html").mapInPandas(run, PAGE_SCHEMA)


def clean_articles(raw: DataFrame) -> DataFrame:
    """The scraper's item pipeline: normalize text, title and date."""
    return (raw.withColumn("text", normalize_text(F.col("text")))
            .withColumn("title", normalize_title(F.col("title")))
            .withColumn("published_at", normalize_date(F.col("published_at"))))


# The HTML entities decoded by ``title_from_html``.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"))


def title_from_html(html: Column) -> Column:
    """Text of the first <title> element with common entities decoded (SQL only)."""
    t = F.regexp_extract(html, r"(?s)<title[^>]*>(.*?)</title>", 1)
    for ent, ch in ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return F.regexp_replace(t, r"^\s+|\s+\z", "")
