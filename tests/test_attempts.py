"""Attempt outcomes, final status resolution, messages and name extraction."""

import pytest

from clickflow.operators import attempts as att
from conftest import rows

SCHEMA = "product_id string, url string, attempt int, status_code int, error_kind string"


def test_classify(spark):
    df = spark.createDataFrame([
        ("a", "u", 1, 200, None), ("a", "u", 2, 404, None), ("a", "u", 3, 403, None),
        ("a", "u", 4, 429, None), ("a", "u", 5, 503, None), ("a", "u", 6, None, "network"),
        ("a", "u", 7, None, "other"), ("a", "u", 8, 301, None), ("a", "u", 9, 600, None)], SCHEMA)
    got = [r[1] for r in rows(att.classify_attempt(df), "attempt", "status")]
    assert got == ["success", "err_404", "err_403", "err_429", "err_5xx", "err_network", "err_other",
                   "err_other", "err_other"]


def test_resolution(spark):
    df = spark.createDataFrame([
        ("p1", "u", 1, 403, None), ("p1", "u", 2, 200, None), ("p1", "u", 3, 500, None),   # 200 stops
        ("p2", "u", 1, 429, None), ("p2", "u", 2, 500, None), ("p2", "u", 3, 503, None),   # last = 5xx
        ("p3", "u", 1, 404, None), ("p3", "u", 2, 200, None), ("p3", "u", 3, 200, None),   # 404 stops
        ("p4", "u", 1, 301, None), ("p4", "u", 2, 301, None), ("p4", "u", 3, 301, None),   # unlisted
        ("p5", "u", 1, None, "network"), ("p5", "u", 2, None, "network"), ("p5", "u", 3, None, "network"),
        ("p6", "u", 1, 500, None), ("p6", "u", 2, None, "other"), ("p6", "u", 3, None, "other"),
        ("p7", "u", 1, 403, None), ("p7", "u", 2, 429, None),                              # log cut short
    ], SCHEMA)
    got = rows(att.resolve_attempts(df), "product_id", "attempts", "status", "http_code", "error_msg")
    assert got == [
        ("p1", 2, "success", 200, ""),
        ("p2", 3, "err_5xx", 503, "HTTP 503"),
        ("p3", 1, "err_404", 404, "Page Not Found"),
        ("p4", 3, "err_other", 301, "HTTP 301"),
        ("p5", 3, "err_network", None, "network"),
        ("p6", 3, "err_other", 0, "other"),
        ("p7", 2, "err_429", 429, "Rate limit"),
    ]


def test_extract_name_rules(spark):
    pages = [
        ("1", '<h1 class="page-title"><span> Ring &amp; Co </span></h1>'),
        ("2", '<h1 class="x page-title y"><span>A <b>bold</b> name</span></h1>'),
        ("3", '<h1 class="page-title"><span> </span></h1><meta property="og:title" content=" Og Name">'),
        ("4", '<meta content="First &quot;Q&quot;" property="og:title">'),
        ("5", "<meta property='og:title' content='Single'>"),
        ("6", '<h1 class="page-title">No span</h1><p><span>later span</span></p>'),
        ("7", "<html><body>nothing</body></html>"),
        ("8", '<H1 CLASS="page-title"><SPAN>Upper</SPAN></H1>'),
        ("9", None),
        ("10", '<h1 class="page-titles"><span>Wrong class</span></h1>'),
    ]
    df = spark.createDataFrame(pages, "product_id string, html string")
    got = dict(rows(att.extract_name(df), "product_id", "product_name"))
    assert got == {"1": "Ring & Co", "2": "Aboldname", "3": " Og Name", "4": 'First "Q"', "5": "Single",
                   "6": "Unknown name", "7": "Unknown name", "8": "Upper", "9": "Unknown name",
                   "10": "Unknown name"}


def test_result_log_names_only_for_success(spark):
    res = spark.createDataFrame([("a", "u", 1, "success", 200, ""), ("b", "u", 1, "err_404", 404, "Page Not Found")],
                                "product_id string, url string, attempts int, status string, http_code int, error_msg string")
    pages = spark.createDataFrame([("a", '<meta property="og:title" content="A">'),
                                   ("b", '<meta property="og:title" content="B">')], "product_id string, html string")
    got = rows(att.result_log(res, pages), "product_id", "product_name", "status")
    assert got == [("a", "A", "success"), ("b", None, "err_404")]


def test_parser_method_agrees_with_regex_on_fixture_pages(spark):
    from conftest import SF_SMALL
    from clickflow.sources import fixtures as fx
    pages = fx.product_pages(spark, SF_SMALL)
    a = rows(att.extract_name(pages), "page_id", "product_name")
    b = rows(att.extract_name(pages, method="parser"), "page_id", "product_name")
    assert a == b


def test_parser_method_handles_nesting(spark):
    df = spark.createDataFrame([
        ("1", '<h1 class="page-title"><span><span>Inner</span> tail &amp; co</span></h1>'),
        ("2", '<h1 class="page-title">x</h1><span>outside</span><meta property="og:title" content="Og">'),
        ("3", None),
    ], "product_id string, html string")
    got = dict(rows(att.extract_name(df, method="parser"), "product_id", "product_name"))
    assert got == {"1": "Innertail & co", "2": "Og", "3": "Unknown name"}


@pytest.mark.parametrize("method", ["regex", "parser"])
def test_extract_name_on_ordinary_markup(spark, method):
    """Page markup with names as a browser shows them, for both paths."""
    h = '<h1 class="page-title">'
    pages = [
        ("numeric", h + "<span>A &#8211; B&#x2019;s</span></h1>", "A \u2013 B\u2019s"),
        ("named", h + "<span>K&ouml;nig &amp;lt; &#38;gt;</span></h1>", "K\u00f6nig &lt; &gt;"),
        ("second heading", h + "none</h1>" + h + "<span>Second</span></h1>", "Second"),
        ("unquoted", "<h1 class=page-title><span>Plain</span></h1>", "Plain"),
        ("comment", "<!-- " + h + "<span>Old</span></h1> -->" + h + "<span>New</span></h1>", "New"),
        ("nested", h + "<span>A<span>B</span>C</span> <span>D</span></h1>", "ABC"),
        ("says unknown", h + "<span>Unknown name</span></h1><meta property=og:title content=Og>", "Og"),
        ("bad number", h + "<span>x&#1114112;&#55296;y</span></h1>", "x\ufffd\ufffdy"),
        ("other attribute", '<h1 data-class="page-title"><span>No</span></h1>', "Unknown name"),
        ("many tags", h + "<span>" + "<b>x</b>" * 20000 + "</span></h1>", "x" * 20000),
    ]
    df = spark.createDataFrame([p[:2] for p in pages], "product_id string, html string")
    got = dict(rows(att.extract_name(df, method=method), "product_id", "product_name"))
    assert got == {p[0]: p[2] for p in pages}
