from __future__ import annotations

import pytest

from postloom.operators import extract as X
from postloom.operators.urls import absolutize, absolutize_picture, first_rule
from postloom.sources.dom import has_class, parse
from postloom.sources.listing import next_page, pages_of


def test_dom_rules():
    root = parse('<div class="a b"><p>eins<p>zwei <b>drei</b></div>vier<!-- nein --><script>x</script><br>fünf')
    assert [p.text(" ") for p in root.all("p")] == ["eins zwei drei", "zwei drei"]  # an unclosed p holds what follows
    assert root.first("div", has_class("b")) is not None and root.first("div", has_class("a b")) is not None and root.first("div", has_class("c")) is None
    assert root.text() == "einszweidreivierfünf"
    assert parse("</p>x").text() == "x" and parse(None).text() == "" and parse("<br/>a").text() == "a"


def test_listing_fields():
    from postloom.plans.fixtures import LISTING_PAGES

    first = X.listed(LISTING_PAGES[0][3], "subid_1")
    assert [p["title"] for p in first] == ["FooBar", "Kok", None]
    assert first[0]["category"] == "Salg" and first[0]["banner"] == "/a.png" and first[0]["footer"] == "//cdn/b.png"
    assert first[1]["banner"] == first[1]["footer"] == "c.png"
    assert X.listed(LISTING_PAGES[2][3], "subid_3")[0]["category"] == ""
    assert X.listed(None, None) == []


def test_rejected_dates(spark):
    from postloom.plans.fixtures import LISTING_PAGES

    records = X.postings_of(spark.createDataFrame(LISTING_PAGES, "category string, page_no int, url string, html string"))
    assert [r["joburl"] for r in X.rejected_dates(records).collect()] == ["https://x.example/4"]


@pytest.mark.parametrize("n, kept", [(30, 0), (31, 1)])
def test_block_length(n, kept):
    assert len(X.main_text(f"<p>{'a' * n}</p>", "u")[0]) == kept


def test_nested_blocks_repeat():
    t = "ord " * 10
    assert X.main_text(f"<li><p><span>{t}</span></p></li>", "u")[0] == [t.strip()] * 3


def test_urls(spark):
    rows = [("/x",), ("http://a",), ("x//y",), ("//h/x",), ("",), (None,)]
    got = spark.createDataFrame(rows, "u string").select(absolutize("u", "B"), absolutize_picture("u", "B"), first_rule("u", [("a", "one"), ("x", "two")], "none")).collect()
    assert [r[0] for r in got] == ["B/x", "http://a", "B/x//y", "B//h/x", "B/", None]
    assert [r[1] for r in got] == ["B/x", "http://a", "x//y", "B//h/x", "", None]
    assert [r[2] for r in got] == ["two", "one", "two", "two", "none", "none"]


def test_pages():
    page = '<ul class="pagination"><li class="page-item-next"><a href="?p=2">n</a></li></ul>'
    assert next_page(page, "https://h/s?p=1") == "https://h/s?p=2" and next_page("<p>", "https://h/") is None
    loop = {"https://h/s": page.replace("?p=2", "/s")}
    assert len(list(pages_of("c", "https://h/s", loop.get))) == 1
