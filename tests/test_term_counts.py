from __future__ import annotations

import random
from collections import defaultdict

from postloom.operators.term_counts import TermCounts, changed_images, term_counts
from postloom.runtime import fresh_path

SCHEMA = "jobid bigint, keyword string"


def brute(rows):
    n, jobs = defaultdict(int), defaultdict(set)
    for j, k in rows:
        t = (k or "").strip().lower()
        if t:
            n[t] += 1
            if j is not None:
                jobs[t].add(j)
            else:
                jobs[t] |= set()
    return {t: (n[t], len(jobs[t])) for t in n}


def got(store):
    return {r["term"]: (r["n_rows"], r["n_records"]) for r in store.counts().collect()}


def test_counts_marks_and_edges(spark):
    rows = [(1, " SQL "), (1, "sql"), (2, "Sql\t"), (3, None), (3, "  "), (None, "sql"), (4, "Æble"), (5, "æble"), (6, "æble")] + [(i, "fælles") for i in range(1, 12)]
    store = term_counts(spark.createDataFrame(rows, SCHEMA))
    assert got(store) == brute(rows)
    assert store.records == 11
    marks = {r["term"]: r["mark"] for r in store.marked().collect()}
    assert marks == {"sql": "rare", "æble": "common", "fælles": "common"}


def test_empty(spark):
    store = term_counts(spark.createDataFrame([], SCHEMA))
    assert store.records == 0 and store.counts().isEmpty() and store.marked().isEmpty()


def test_deltas_equal_recount(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)] + [" W1", "", None]
    state = {j: [rng.choice(words) for _ in range(rng.randint(0, 5))] for j in range(20)}
    table = lambda s: spark.createDataFrame([(j, w) for j, ws in s.items() for w in ws], SCHEMA)
    store = TermCounts(spark, fresh_path(spark, "t"), buckets=3)
    store.apply(after=table(state))
    for step in range(3):
        new = {j: ws for j, ws in state.items() if rng.random() > 0.2}
        for j in list(new)[:6]:
            new[j] = [rng.choice(words) for _ in range(rng.randint(1, 4))]
        new[100 + step] = ["w1", "w1", "neu"]
        after, before = changed_images(table(state), table(new), "jobid", "keyword")
        store.apply(after=after, before=before, delta_id=step)
        store.apply(after=after, before=before, delta_id=step)
        state = new
        assert got(store) == brute([(j, w) for j, ws in state.items() for w in ws])
    assert TermCounts(spark, store.path).records == len({j for j, ws in state.items() if ws})
    everything = table(state)
    store.apply(before=everything)
    assert got(store) == {} and store.records == 0


def test_extra_columns(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "a")], SCHEMA).withColumns({c: F.lit(1) for c in ("term", "_term", "_sign", "n", "bucket")})
    assert got(term_counts(df)) == {"a": (1, 1)}
