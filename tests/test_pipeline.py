"""The crawl from pages to the store, its sources over archives, and state in versions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postloom import runtime
from postloom.operators import pipeline as C
from postloom.operators import store as S
from postloom.operators.versions import KEEP, Buckets, Versions
from postloom.plans import fixtures
from postloom.sources.listing import archived_pages, ordered_pages

STARTS = "category string, url string"
LONG = "Acme A/S søger en dygtig smed til værkstedet i Aarhus, og du får ansvaret for svejsning. Se mere på https://acme.example/job nu."


def stops(spark):
    return spark.createDataFrame([("og",), ("en",), ("for",)], "word string")


def crawled(spark, pages, details, **kwargs):
    lists = {"yake-da": stops(spark)}
    df = spark.createDataFrame(pages, "category string, page_no int, html string")
    return C.crawl(df, spark.createDataFrame(details, "url string, status int, html string"), lists, stops(spark), **kwargs)


def posting(n, title="Smed", company=""):
    return f'<div id="jobad-wrapper-{n}"><h4><a href="/vis/{n}">{title}</a></h4>{company}</div>'


def test_crawl_fills_fields_and_keywords(spark):
    base = fixtures.BASE
    pages = [("subid_1", 1, posting(1) + posting(2)), ("subid_2", 1, posting(1, "Smed igen")), ("subid_3", 1, "<p>intet</p>")]
    details = [(f"{base}/vis/1", 200, f"<p>{LONG}</p>"), (f"{base}/vis/2", 404, f"<p>{LONG}</p>")]
    rows = {(r["category"], r["joburl"]): r for r in crawled(spark, pages, details, capacity=10).collect()}
    first, gone, again = rows["subid_1", "/vis/1"], rows["subid_1", "/vis/2"], rows["subid_2", "/vis/1"]
    assert (first["companyname"], first["joblocation"], first["companyurl"], first["recent"]) == ("Acme A/S", "Aarhus", "https://acme.example/job", False)
    assert "smed" in first["jobdescription"] and [k["keyword"].lower() for k in first["keywords"]]
    assert gone["jobdescription"] is None and gone["companyname"] is None and gone["keywords"] is None
    assert again["recent"] and again["jobdescription"] is None and again["jobtitle"] == "Smed igen"
    # an address that is known already gets no keywords (K3); one that has left the cache is read again
    known = spark.createDataFrame([("/vis/1",)], "joburl string")
    assert all(r["keywords"] is None for r in crawled(spark, pages, details, known=known).collect())
    assert not [r for r in crawled(spark, pages, details, capacity=1).collect() if r["recent"]]

    store = S.Store(spark, runtime.fresh_path(spark, "store"))
    for n in (1, 2):
        C.crawl_to_store(store, crawled(spark, pages, details), F.lit(dt.datetime(2025, 1, n)), "same")  # a retry changes nothing
    C.crawl_to_store(store, crawled(spark, pages, details), F.lit(dt.datetime(2025, 1, 3)), "next")
    held = {r["joburl"]: r for r in store.read("postings").collect()}
    assert set(held) == {"/vis/1", "/vis/2"} and held["/vis/1"]["jobtitle"] == "Smed" and held["/vis/1"]["seenlast"] == dt.datetime(2025, 1, 3)
    assert store.read("posting_categories").count() == 3 and store.read("posting_keywords").count() == len(first["keywords"])


def test_no_pages(spark):
    assert crawled(spark, [("a", 1, None), ("b", 1, "")], [("x", 200, "y")]).isEmpty()


def test_pictures(spark):
    page = [("c", 1, fixtures.LISTING_PAGES[0][3])]
    pictures = spark.createDataFrame([(f"{fixtures.BASE}/a.png", bytearray(b"1")), ("c.png", bytearray(b"2"))], "path string, content binary")
    got = {r["joburl"]: (r["bannerpicture"], r["footerpicture"]) for r in crawled(spark, page, [("x", 200, "y")], pictures=pictures).collect()}
    assert got == {"/vis/1": (b"1", None), "vis/2": (b"2", b"2")}


def test_long_listings_and_circles(spark):
    n = 300
    chain = [("long", f"u{i}", f"u{i + 1}" if i < n else None) for i in range(1, n + 1)] + [("ring", "a", "b"), ("ring", "b", "c"), ("ring", "c", "b"), ("self", "x", "x"), ("lone", "z", None), ("lone", "other", "z")]
    starts = spark.createDataFrame([("long", "u1"), ("ring", "a"), ("self", "x"), ("lone", "z"), ("none", "q")], STARTS)
    got = {(r["category"], r["page_no"]): r["url"] for r in ordered_pages(spark.createDataFrame(chain, "category string, url string, next_url string"), starts).collect()}
    want = {("long", i): f"u{i}" for i in range(1, n + 1)} | {("ring", 1): "a", ("ring", 2): "b", ("ring", 3): "c", ("self", 1): "x", ("lone", 1): "z"}
    assert got == want
    empty = spark.createDataFrame([], "url string, html string")
    assert archived_pages(empty, starts).isEmpty()
    two = spark.createDataFrame([*fixtures.SAVED_PAGES, (None, None)], "url string, html string")
    both = spark.createDataFrame([("a", fixtures.SAVED_PAGES[0][0]), ("b", fixtures.SAVED_PAGES[1][0])], STARTS)  # listings that share pages
    assert sorted((r["category"], r["page_no"]) for r in archived_pages(two, both).collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2)]


def test_only_touched_buckets_are_written_and_old_ones_deleted(spark):
    versions = Versions(spark, runtime.fresh_path(spark, "versions"), recent=2)
    schema = S.CATEGORIES
    table = Buckets(versions, "t", schema, "categoryid", buckets=4, bucket_rows=30)
    state = versions.state()
    rows = spark.range(0, 40).selectExpr("id AS categoryid", "'a' AS name")
    versions.commit(state | {"tables": {"t": table.write(rows, table.entry(state), [0, 1, 2, 3], 1)}}, "c0")
    for n in range(1, 7):
        state = versions.state()
        entry = table.entry(state)
        one = rows.filter("categoryid = 7").withColumn("name", F.lit(f"b{n}"))
        hit = table.touched(entry, one)
        assert len(hit) == 1
        old = table.read(entry, hit).filter("categoryid <> 7")
        new = table.write(old.unionByName(one), entry, hit, state["version"] + 1)
        assert sum(v == state["version"] + 1 for v in new["at"].values()) == 1
        versions.commit(state | {"tables": {"t": new}}, f"c{n}")
        got = table.read(table.entry(versions.state())).collect()
        assert len(got) == 40 and {r["name"] for r in got if r["categoryid"] == 7} == {f"b{n}"}
    assert sorted(map(int, versions.names("versions"))) == list(range(8 - KEEP, 8))
    held = {v for n in versions.names("versions") for v in versions.state(int(n))["tables"]["t"]["at"].values()}
    assert [v for v in range(1, 8) if versions.names("t", f"v{v}") and any(x.startswith("bucket=") for x in versions.names("t", f"v{v}"))] == sorted(held)
    assert all(versions.applied(f"c{n}", versions.state()) for n in range(7)) and not versions.applied("c9", versions.state())  # also those that left the version
    with pytest.raises(RuntimeError):
        versions.commit(state)  # an older writer


def test_crowded_tables_get_more_buckets(spark):
    versions = Versions(spark, runtime.fresh_path(spark, "versions"))
    table = Buckets(versions, "t", S.CATEGORIES, "categoryid", buckets=2, bucket_rows=10)
    entry = table.entry(versions.state())
    for n in range(1, 5):
        rows = spark.range(n * 20, n * 20 + 20).selectExpr("id AS categoryid", "'a' AS name")
        hit = table.touched(entry, rows)
        entry = table.write(table.read(entry, hit).unionByName(rows), entry, hit, n)
    assert entry["buckets"] >= 4 and sum(entry["rows"].values()) == 80
    assert sorted(r["categoryid"] for r in table.read(entry).collect()) == list(range(20, 100))


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Fake:
        class conf:
            @staticmethod
            def get(name, default=None):
                return {"spark.master": "spark://x:7077"}.get(name, default)

    with pytest.raises(RuntimeError):
        runtime.shared_dir(Fake())


def test_size_in_bytes_counts(spark):
    wide = runtime.materialize(spark.range(100).selectExpr("id", "repeat(uuid(), 100) AS s"), "wide")
    assert runtime.is_small(wide) and not runtime.is_small(wide, max_bytes=10_000) and not runtime.is_small(wide, max_rows=99)
