from __future__ import annotations

import datetime as dt
import random
from collections import OrderedDict

import pytest
from pyspark.sql import functions as F

from postloom.operators import store as S
from postloom.operators.recent import lru_hits
from postloom.runtime import fresh_path

SIGHT = "batch int, seq int, seen timestamp_ntz, url string, category string, jobtitle string"


def at(day, hour=0):
    return dt.datetime(2025, 1, day, hour)


def sightings(spark, rows):
    return spark.createDataFrame(rows, SIGHT)


def test_first_write_wins_last_seen_and_links(spark):
    store = S.Store(spark, fresh_path(spark, "store"))
    one = [(1, 0, at(1), "/a", "Salg", "A"), (1, 1, at(2), "/a", "Kok", "A2"), (1, 2, at(1), "/b", None, "B"), (1, 3, at(1), "", "Salg", "x"), (1, 4, at(1), None, "Salg", "x"), (1, 0, at(1), "/a", "Salg", "A")]
    store.apply(sightings(spark, one), "1")
    two = [(2, 0, at(5), "/a", "Salg", "A3"), (2, 1, at(3), "/c", "", "C")]
    store.apply(sightings(spark, two), "2")
    before = {r["joburl"]: tuple(r) for r in store.read("postings").collect()}
    store.apply(sightings(spark, two), "2")  # the same batch again
    assert {r["joburl"]: tuple(r) for r in store.read("postings").collect()} == before
    got = {r["joburl"]: (r["jobid"], r["jobtitle"], r["seenlast"], r["isactive"]) for r in store.read("postings").collect()}
    assert got == {"/a": (1, "A", at(5), True), "/b": (2, "B", at(1), True), "/c": (3, "C", at(3), True)}
    assert {r["name"] for r in store.read("categories").collect()} == {"Salg", "Kok"}
    assert store.read("posting_categories").count() == 2
    assert store.expire(F.lit(at(5)), 1) == 2
    store.apply(sightings(spark, [(3, 0, at(6), "/b", "Salg", "B9")]), "3")
    assert {r["joburl"]: r["isactive"] for r in store.read("postings").collect()} == {"/a": True, "/b": True, "/c": False}
    assert S.violations(store.read("postings"), store.read("posting_categories")).isEmpty()


def test_keywords_only_for_new_postings(spark):
    store = S.Store(spark, fresh_path(spark, "store"))
    rows = [(1, 0, at(1), "/a", "Salg", "A", [("x", "yake-da", 0.5), ("y", "yake-en", None)])]
    schema = SIGHT + ", kws array<struct<keyword:string,source:string,confidence:double>>"
    for n in (1, 2):
        store.apply(spark.createDataFrame(rows, schema), n, keywords="kws")
    assert [(r["keywordid"], r["keyword"], r["confidencescore"]) for r in store.read("posting_keywords").orderBy("keywordid").collect()] == [(1, "x", 0.5), (2, "y", None)]


def test_expire_threshold(spark):
    rows = [(1, at(4), True), (2, at(3, 23), True), (3, None, True), (4, at(1), False), (5, at(1), True)]
    df = spark.createDataFrame(rows, "jobid bigint, seenlast timestamp_ntz, isactive boolean")
    got = {r["jobid"]: (r["isactive"], r["changed"]) for r in S.expire(df, F.lit(at(5)), 1).collect()}
    assert got == {1: (True, False), 2: (False, True), 3: (True, False), 4: (False, False), 5: (False, True)}


def test_evolve_and_reject(spark):
    got = S.evolve(spark.createDataFrame([(1, "/a", None)], "JobID bigint, JobUrl string, isactive boolean")).first()
    assert got["isactive"] is True and got["seenlast"] is None and got["joburl"] == "/a"
    bad = S.rejected(spark.createDataFrame([("a" * 256, "/x"), ("b", "c" * 512), ("d", "e" * 513)], "companyname string, joburl string"))
    assert sorted(r["reason"] for r in bad.collect()) == ["companyname is longer than 255", "joburl is longer than 512"]


def test_numbers_are_dense(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = S.numbered(df, ["k"], "place", 10).collect()
    assert all(r["place"] == r["k"] + 11 for r in got)
    assert S.numbered(df.limit(0), ["k"], "place").isEmpty()


def brute_lru(keys, capacity):
    cache, out = OrderedDict(), []
    for k in keys:
        out.append(k in cache)
        cache[k] = None
        cache.move_to_end(k)
        if len(cache) > capacity:
            cache.popitem(last=False)
    return out


@pytest.mark.parametrize("n, keys, capacity, block", [(6, None, 2, 2), (300, 12, 4, 7), (400, 40, 25, 16), (200, 3, 100, 10), (0, 1, 2, 5)])
def test_lru(spark, n, keys, capacity, block):
    rng = random.Random(n)
    seq = list("abacba") if keys is None else [f"k{rng.randrange(keys)}" for _ in range(n)]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(seq)], "i int, k string")
    got = [r["hit"] for r in lru_hits(df, "k", ["i"], capacity, block).orderBy("i").collect()]
    assert got == brute_lru(seq, capacity)
    if keys is None:
        assert got == [False, False, True, False, False, False]


def test_lru_edges(spark):
    assert [r["hit"] for r in lru_hits(spark.createDataFrame([(1, None), (2, "a"), (3, "a")], "i int, k string"), "k", ["i"], 1).orderBy("i").collect()] == [False, True]
    with pytest.raises(ValueError):
        lru_hits(spark.createDataFrame([(1, "a")], "i int, k string"), "k", ["i"], 0)
