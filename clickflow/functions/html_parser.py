"""Product-name extraction with the standard-library HTML parser (Arrow-batched
``pandas_udf``). Slower than the regex path; use it when headings nest spans or carry
markup the regex rule cannot follow. Same rule: first span under an ``h1`` whose class
list holds ``page-title`` (text nodes stripped and joined), else the first
``og:title`` meta content, else ``Unknown name``."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from clickflow.config import UNKNOWN_NAME


class _NameParser(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.heading_depth = 0      # open h1.page-title elements
        self.span_depth = 0         # nesting inside the chosen span
        self.span_seen = False      # only the first matching span counts
        self.texts: list[str] = []
        self.og: str | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "meta" and self.og is None and a.get("property") == "og:title":
            self.og = a.get("content") or ""
        elif tag == "h1":
            if self.heading_depth or "page-title" in (a.get("class") or "").split():
                self.heading_depth += 1
        elif tag == "span":
            if self.span_depth:
                self.span_depth += 1
            elif self.heading_depth and not self.span_seen:
                self.span_seen = True
                self.span_depth = 1

    def handle_startendtag(self, tag, attrs):
        if tag == "meta":
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "span" and self.span_depth:
            self.span_depth -= 1
        elif tag == "h1" and self.heading_depth:
            self.heading_depth -= 1

    def handle_data(self, data):
        if self.span_depth:
            t = data.strip()
            if t:
                self.texts.append(t)


def name_of(html: str | None) -> str:
    if not html:
        return UNKNOWN_NAME
    p = _NameParser()
    try:
        p.feed(html)
        p.close()
    except Exception:  # noqa: BLE001 - malformed markup falls back like a missing tag
        pass
    text = "".join(p.texts)
    if text and text != UNKNOWN_NAME:
        return text
    if p.og:
        return p.og
    return UNKNOWN_NAME


def names_of(html: pd.Series) -> pd.Series:
    return html.map(name_of)


def extract_product_name_parsed(html) -> Column:
    # The UDF object is built on the driver at call time; workers only import names_of.
    udf = F.pandas_udf(names_of, "string")
    return udf(F.col(html) if isinstance(html, str) else html)
