"""Product-name extraction from captured HTML with built-in functions (JVM-side).

Rule (ordered fallback):
  1. text of the first ``span`` inside an ``h1`` whose class list holds ``page-title``
     (the first such heading that has a span); text nodes are stripped one by one and joined
     without spaces; spans may nest;
  2. else the ``content`` of the first ``<meta property="og:title">`` (not stripped);
  3. else the literal ``Unknown name``.
An empty text/content counts as absent, and so does a heading that says ``Unknown name``.
Comments are ignored. Numeric and the standard named character references are decoded
(others stay as they are; the parser path knows all of them).
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickflow.config import UNKNOWN_NAME
from clickflow.functions.text import strip_ws

COMMENT = r"(?s)<!--.*?(?:-->|$)"
# An h1 with the page-title class (quoted or not); group 1 = heading body.
HEADING_PATTERN = (
    r"(?is)<h1\s(?:[^>]*\s)?class\s*=\s*"
    r"(?:\"(?:[^\"]*\s)?page-title(?:\s[^\"]*)?\"|'(?:[^']*\s)?page-title(?:\s[^']*)?'|page-title(?=[\s>]))"
    r"[^>]*>(.*?)</h1\s*>"
)
# What follows the first opening span of a heading; group 1.
AFTER_SPAN = r"(?is)<span(?:\s[^>]*)?>(.*)"
# Places just before an opening or closing span.
SPAN_EDGE = r"(?i)(?=<span[\s>])|(?=</span[\s>])"
# The first og:title meta tag (attribute order free, quotes optional).
OG_TAG_PATTERN = r"(?is)(<meta\s(?:[^>]*\s)?property\s*=\s*(?:\"og:title\"|'og:title'|og:title(?=[\s/>]))[^>]*>)"
OG_CONTENT = (r"(?is)\scontent\s*=\s*\"([^\"]*)\"", r"(?is)\scontent\s*=\s*'([^']*)'", r"(?is)\scontent\s*=\s*([^\s\"'>]+)")
# A tag with the whitespace around it (text nodes are stripped, then joined).
TAG_WITH_SPACE = r"\s*<[^>]+>\s*"
# A character reference.
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,9});"

# Named references as the HTML standard lists them; the ampersand is decoded last.
NAMED = {f"&{name};": chr(cp) for name, cp in name2codepoint.items() if name != "amp"} | {"&apos;": "'"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _decoded(ref: Column) -> Column:
    """The character of a reference; an ampersand as ``&amp;``, an unknown name as it is."""
    named = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])
    digits = F.regexp_extract(ref, "([0-9a-fA-F]+);$", 1)
    cp = F.when(ref.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("int")
    bad = (cp == 0) | cp.between(0xD800, 0xDFFF) | (cp > 0x10FFFF)
    safe = F.when(bad, F.lit(0xFFFD)).otherwise(cp)
    char = F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")
    numeric = F.when(cp == 38, F.lit("&amp;")).otherwise(char)
    return F.when(ref.startswith("&#"), numeric).otherwise(F.coalesce(F.try_element_at(named, ref), ref))


def decode_entities(c) -> Column:
    refs = F.array_distinct(F.regexp_extract_all(_c(c), F.lit(REFERENCE), F.lit(0)))
    out = F.aggregate(refs, _c(c), lambda text, ref: F.replace(text, ref, _decoded(ref)))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def strip_tags(c) -> Column:
    """Text of a fragment: tags dropped, each text node stripped, nodes joined."""
    return strip_ws(decode_entities(F.regexp_replace(_c(c), TAG_WITH_SPACE, "")))


def _first_span(rest: Column) -> Column:
    """``rest`` (what follows an opening span) up to the end of that span."""
    start = F.struct(F.lit(1).alias("depth"), F.lit("").alias("body"))

    def step(acc, part):
        change = F.when(part.rlike("(?i)^<span"), 1).when(part.rlike("(?i)^</span"), -1).otherwise(0)
        depth = F.when(acc["depth"] > 0, acc["depth"] + change).otherwise(0)
        return F.struct(depth.alias("depth"), F.when(depth > 0, F.concat(acc["body"], part)).otherwise(acc["body"]).alias("body"))

    return F.aggregate(F.split(rest, SPAN_EDGE), start, step)["body"]


def heading_span_text(html) -> Column:
    headings = F.regexp_extract_all(_c(html), F.lit(HEADING_PATTERN), F.lit(1))
    heading = F.try_element_at(F.filter(headings, lambda h: h.rlike(AFTER_SPAN)), F.lit(1))
    text = F.nullif(strip_tags(_first_span(F.regexp_extract(heading, AFTER_SPAN, 1))), F.lit(""))
    return F.nullif(text, F.lit(UNKNOWN_NAME))


def og_title(html) -> Column:
    tag = F.regexp_extract(_c(html), OG_TAG_PATTERN, 1)
    content = F.coalesce(*[F.nullif(F.regexp_extract(tag, p, 1), F.lit("")) for p in OG_CONTENT])
    return F.nullif(decode_entities(content), F.lit(""))


def extract_product_name(html) -> Column:
    shown = F.regexp_replace(_c(html), COMMENT, "")
    return F.coalesce(heading_span_text(shown), og_title(shown), F.lit(UNKNOWN_NAME))
