"""HTML: flat extraction by expressions, and a parser in Arrow batches where nesting matters (headings, links, Markdown, main body)."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = {"p", "div", "section", "article", "main", "ul", "ol", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "br", "tr", "table", "header", "footer", "nav"}
DROPPED = {"script", "style", "noscript", "iframe", "form", "button", "template", "svg"}
VOID = {"br", "img", "meta", "link", "hr", "input", "source", "wbr", "area", "base", "col", "embed", "track"}


def title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def meta(html: Column, name: str) -> Column:
    """The content of a meta tag by name or property, in either order of attributes; null if there is none."""
    n = name.replace(":", r"\:")
    first = F.regexp_extract(html, rf"(?is)<meta[^>]+(?:name|property)=[\"']{n}[\"'][^>]*content=[\"']([^\"']*)", 1)
    second = F.regexp_extract(html, rf"(?is)<meta[^>]+content=[\"']([^\"']*)[\"'][^>]*(?:name|property)=[\"']{n}[\"']", 1)
    return F.coalesce(F.nullif(first, F.lit("")), F.nullif(second, F.lit("")))


def description(html: Column) -> Column:
    return F.coalesce(meta(html, "description"), meta(html, "og:description"))


def links(html: Column) -> Column:
    """Addresses of links, as they are written."""
    return F.regexp_extract_all(html, F.lit(r"(?is)<a\s[^>]*?href=[\"']([^\"']*)[\"']"), F.lit(1))


def published(html: Column) -> Column:
    """A page's date from its meta tags, else from its linked data."""
    names = ("article:published_time", "og:article:published_time", "datePublished", "date", "publish-date", "pubdate")
    linked = F.nullif(F.regexp_extract(html, r'(?is)"datePublished"\s*:\s*"([^"]+)"', 1), F.lit(""))
    return F.coalesce(*[meta(html, n) for n in names], linked)


def author(html: Column) -> Column:
    """A page's author from its meta tags, else from its linked data (a name, or an object with one)."""
    linked = [F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in (r'(?is)"author"\s*:\s*\[?\s*\{[^{}]*"name"\s*:\s*"([^"]+)"', r'(?is)"author"\s*:\s*"([^"]+)"')]
    return F.trim(F.coalesce(meta(html, "author"), meta(html, "article:author"), *linked))


def post_tags(html: Column, most: int = 10) -> Column:
    """Distinct tags from keywords, article tags and links of the kind tag: lower case, under 40 characters, the first `most`."""
    keywords = F.split(F.coalesce(meta(html, "keywords"), F.lit("")), ",")
    articles = F.regexp_extract_all(html, F.lit(r"(?is)<meta[^>]+property=[\"']article:tag[\"'][^>]*content=[\"']([^\"']*)"), F.lit(1))
    linked = F.regexp_extract_all(html, F.lit(r"(?is)<a\s[^>]*rel=[\"'](?:[^\"']*\s)?tag(?:\s[^\"']*)?[\"'][^>]*>([^<]*)</a>"), F.lit(1))
    every = F.transform(F.concat(keywords, articles, linked), lambda t: F.lower(F.trim(t)))
    return F.slice(F.array_distinct(F.filter(every, lambda t: F.length(t).between(1, 39))), 1, most)


class _Reader(HTMLParser):
    """Reads a page into headings, links and Markdown, however it is nested."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.headings: list[tuple[int, str]] = []
        self.anchors: list[tuple[str, str]] = []
        self.out: list[str] = []
        self.open: list[str] = []
        self.hidden = 0
        self.heading: list[str] | None = None
        self.anchor: tuple[str, list[str]] | None = None
        self.lists: list[list] = []
        self.pre = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in DROPPED:
            self.hidden += 1
            return
        a = {k: v or "" for k, v in attrs}
        if tag not in VOID:
            self.open.append(tag)
        if tag in ("ul", "ol"):
            self.lists.append([tag, 0])
        if tag == "li":
            self._break()
            if self.lists:
                self.lists[-1][1] += 1
            mark = f"{self.lists[-1][1]}. " if self.lists and self.lists[-1][0] == "ol" else "- "
            self.out.append("  " * max(0, len(self.lists) - 1) + mark)
        elif tag in BLOCKS:
            self._break(2 if tag not in ("br", "tr") else 1)
        if tag[0] == "h" and tag[1:].isdigit():
            self.heading = []
            self.out.append("#" * int(tag[1:]) + " ")
        elif tag == "a":
            self.anchor = (a.get("href", ""), [])
            self.out.append("[")
        elif tag in ("strong", "b"):
            self.out.append("**")
        elif tag in ("em", "i"):
            self.out.append("_")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag == "pre":
            self.pre += 1
            self.out.append("```\n")
        elif tag == "blockquote":
            self.out.append("> ")
        elif tag == "img" and not self.hidden:
            self.out.append(f"![{a.get('alt', '')}]({a.get('src', '')})")

    def handle_endtag(self, tag: str) -> None:
        if tag in DROPPED:
            self.hidden = max(0, self.hidden - 1)
            return
        if tag not in self.open:
            return
        while self.open and self.open.pop() != tag:
            pass
        if tag[0] == "h" and tag[1:].isdigit() and self.heading is not None:
            text = " ".join("".join(self.heading).split())
            if text:
                self.headings.append((int(tag[1:]), text))
            self.heading = None
        elif tag == "a" and self.anchor is not None:
            self.anchors.append((self.anchor[0], " ".join("".join(self.anchor[1]).split())))
            self.out.append(f"]({self.anchor[0]})")
            self.anchor = None
        elif tag in ("strong", "b"):
            self.out.append("**")
        elif tag in ("em", "i"):
            self.out.append("_")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag == "pre":
            self.pre = max(0, self.pre - 1)
            self.out.append("\n```")
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        if tag in BLOCKS:
            self._break(2 if tag not in ("li", "br", "tr") else 1)

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        text = data if self.pre else " ".join(data.split())
        if not self.pre and text:
            text = (" " if data[:1].isspace() else "") + text + (" " if data[-1:].isspace() else "")
        elif not self.pre and data and self.out and not self.out[-1].endswith(("\n", " ")):
            text = " "
        if self.heading is not None:
            self.heading.append(text)
        if self.anchor is not None:
            self.anchor[1].append(text)
        self.out.append(text)

    def _break(self, n: int = 1) -> None:
        self.out.append("\n" * n)

    def markdown(self) -> str:
        lines = [x.rstrip() for x in "".join(self.out).split("\n")]
        kept: list[str] = []
        for x in lines:
            x = x if x.lstrip().startswith(("-", "#")) or x[:1] == " " and x.strip()[:1] in "-0123456789" else x.strip()
            if x or kept and kept[-1]:
                kept.append(x)
        return "\n".join(kept).strip()


def read(html: str | None) -> _Reader:
    r = _Reader()
    try:
        r.feed(html or "")
        r.close()
    except Exception:  # malformed declarations end the reading, what was read stays
        pass
    return r


def main_part(html: str) -> str:
    """The article, else the main element, else the body, else all."""
    low = html.lower()
    for tag in ("article", "main", "body"):
        a = low.find(f"<{tag}")
        if a >= 0:
            b = low.rfind(f"</{tag}>")
            return html[low.find(">", a) + 1 : b if b > a else len(html)]
    return html


PARSED = "headings array<struct<level:int,text:string>>, links array<struct<href:string,text:string>>, markdown string"


def parsed(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, headings of levels 1 to 3, links, markdown of the main part) of each page."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            whole = [read(x) for x in f[html]]
            yield pd.DataFrame({
                key: f[key],
                "headings": [[{"level": n, "text": t} for n, t in r.headings if n <= 3] for r in whole],
                "links": [[{"href": h, "text": t} for h, t in r.anchors] for r in whole],
                "markdown": [read(main_part(x or "")).markdown() for x in f[html]],
            })

    kind = dict(df.dtypes)[key]
    return df.select(key, html).mapInPandas(run, f"{key} {kind}, {PARSED}")
