from __future__ import annotations

import math

from pyspark.sql import functions as F

from postloom.operators import keywords as K

CANDIDATES = [
    (1, 0, "Spark", "yake-da", 0.20), (1, 1, "spark", "yake-en", 0.10), (1, 2, "og", "yake-da", 0.05), (1, 3, "x", "yake-en", 0.05), (1, 4, "data", "yake-da", 1.40), (1, 5, "C++", "yake-en", 0.10), (1, 6, "--", "yake-en", 0.30),
    (1, 7, "ledelse", "yake-da", None), (1, 8, "sundhed", "yake-da", 0.10), (1, 9, "Sundhed", "category", 0.5), (1, 10, None, "yake-da", 0.1), (1, 11, "  ", "yake-da", 0.1), (1, 12, "og Og", "yake-da", 0.1),
]
SCHEMA = "id bigint, idx bigint, keyword string, source string, score double"


def top(spark, rows, stops, category="Sundhed"):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cat", F.lit(category))
    kept = K.valid(df, spark.createDataFrame([(s,) for s in stops], "word string"), "keyword", "cat").withColumn("conf", K.confidence("score"))
    return K.top_keywords(K.best_per_key(kept, "id", "keyword", "conf", "idx"), "id", "conf")


def test_pipeline(spark):
    got = [(r["keyword"], r["source"], r["conf"], r["first_at"]) for r in top(spark, CANDIDATES, ["og", "sundhed"]).orderBy("rank").collect()]
    assert got == [("spark", "yake-en", 0.9, 0), ("C++", "yake-en", 0.9, 5), ("--", "yake-en", 0.7, 6), ("data", "yake-da", 0.0, 4), ("ledelse", "yake-da", None, 7)]


def test_long_stop_lists_give_the_same(spark, monkeypatch):
    stops = ["og", "sundhed"]
    literal = [tuple(r) for r in top(spark, CANDIDATES, stops).orderBy("rank").collect()]
    monkeypatch.setattr(K, "STOP_LITERAL", 0)
    key = lambda rows: sorted(map(repr, rows))
    joined = top(spark, CANDIDATES, stops).select("id", "idx", "keyword", "source", "score", "cat", "conf", "first_at", "rank").collect()
    assert len(literal) == len(joined) == 5 and {r["keyword"] for r in joined} == {"spark", "C++", "--", "data", "ledelse"} and key(r["rank"] for r in joined) == key(range(1, 6))


def test_limit_and_ties(spark):
    rows = [(1, i, f"ord{i:02d}", "s", 0.5) for i in range(25)] + [(2, 0, "A", "first", 0.5), (2, 1, "a", "second", 0.5), (2, 2, "Bb", "null", None), (2, 3, "bb", "zero", 1.0)]
    rows = [(i, n, k * 2 if len(k) == 1 else k, s, c) for i, n, k, s, c in rows]
    got = top(spark, rows, ["og"]).collect()
    assert sorted(r["keyword"] for r in got if r["id"] == 1) == [f"ord{i:02d}" for i in range(20)]
    assert {r["keyword"]: r["source"] for r in got if r["id"] == 2} == {"AA": "first", "Bb": "null"}


def test_category_keeps_the_last_place(spark):
    rows = [(1, i, f"ord{i:02d}", "s", 0.1) for i in range(25)] + [(1, 99, "salg", "category", 0.9)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("conf", K.confidence("score"))
    best = K.best_per_key(df, "id", "keyword", "conf", "idx")
    got = [r["keyword"] for r in K.top_keywords(best, "id", "conf", category=F.col("source") == "category").orderBy("rank").collect()]
    assert len(got) == 20 and got[-1] == "salg" and "ord19" not in got


def test_confidence_and_legacy(spark):
    rows = [(0.2,), (-1.0,), (1.4,), (None,), (float("nan"),)]
    assert [r[0] for r in spark.createDataFrame(rows, "s double").select(K.confidence("s")).collect()] == [0.8, 1.0, 0.0, None, None]
    got = K.legacy_rows(spark.createDataFrame([(1, " a, ,b ,"), (2, None)], "id bigint, k string"), "id", "k").collect()
    assert [tuple(r) for r in got] == [(1, "a", "legacy", None), (1, "b", "legacy", None)]


def test_yake_by_hand(spark):
    """Three sentences: 'Spark kører Spark.' / 'data flytter Spark' / 'data'; no stop words."""
    stops = spark.createDataFrame([("og",)], "word string")
    df = spark.createDataFrame([(1, "Spark kører Spark.\ndata flytter Spark\ndata")], "id bigint, t string")
    got = {r["term"]: r["score"] for r in K.yake_scores(df, "id", "t", {"yake": stops}).collect()}
    tf = {"spark": 3, "kører": 1, "data": 2, "flytter": 1}
    mean = sum(tf.values()) / 4
    sd = math.sqrt(sum((v - mean) ** 2 for v in tf.values()) / 4)
    # spark: sentences 0, 0, 1; upper initial beyond the first word twice; left neighbours kører, flytter (2 of 2), right: kører (1 of 1)
    pos, rel = math.log(math.log(3 + 0)), 1 + (2 / 2 + 1 / 1) * 3 / 3
    s = rel * pos / (2 / (1 + math.log(3)) + (3 / (mean + sd)) / rel + (2 / 3) / rel)
    assert abs(got["spark"] - s / (3 * (1 + s))) < 1e-9
    assert set(got) == set(tf)
