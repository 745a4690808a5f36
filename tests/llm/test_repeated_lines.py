from __future__ import annotations

import datetime as dt
import random
import re
from collections import defaultdict

import pytest

from postloom.functions.text import py_host
from postloom.llm import repeated_lines as R


def norm(line):
    return re.sub(r"[0-9]+", "0", re.sub(r"[ \t]+", " ", line.strip(" \t").lower()))


def brute(rows):
    site, docs = {}, defaultdict(set)
    at = defaultdict(set)
    for r in rows:
        h, d = py_host(r.get("companyurl")), r.get("jobdescription")
        if h and d:
            docs[h].add(r["jobid"])
            for i, x in enumerate(d.split("\n"), 1):
                if len(x.strip()) >= 25:
                    at[h, norm(x)].add((r["jobid"], i))
    return {p for (h, _), ps in at.items() if len({j for j, _ in ps}) >= 5 and 20 * len({j for j, _ in ps}) >= len(docs[h]) for p in ps}


def make(n, seed, lines):
    rng = random.Random(seed)
    urls = ["https://www.A.example/x", "a.example:80", "B.example", None, " ", "//c.example"]
    return [
        {"jobid": i, "companyurl": rng.choice(urls), "published": dt.datetime(2025, 1, rng.randint(1, 3)) if rng.random() < 0.9 else None, "jobdescription": rng.choice([None, "", "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 7)))])}
        for i in range(n)
    ]


LINES = ["Del opslaget 12 gange med en ven", " del  opslaget 7 gange\tmed en ven", "kort linje", "", "En linje på fem og tyve te", "x" * 24, "x" * 25, "Sjælden linje nummer {} i denne tekst", "ÆBLER OG PÆRER I LANGE BANER", "æbler og pærer i lange baner\r"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(postings, seed):
    rows = make(160, seed, [x.format(k) for k in range(4) for x in LINES])
    rows += rows[:10]  # repeated rows of the same posting
    for extra in (False, True):
        df = postings(rows, extra)
        got = {tuple(r) for r in R.found_lines(df, R.repeated_lines(df)).collect()}
        assert got == brute(rows)


def test_a_republished_text_is_one_cluster(postings):
    line = "Denne tekst står i mange opslag her"
    rows = [{"jobid": i, "companyurl": "a.example", "jobdescription": line, "published": dt.datetime(2025, 1, 1 + i % 2)} for i in range(6)]
    df = postings(rows)
    [r] = R.repeated_lines(df).collect()
    assert (r["n_postings"], r["n_clusters"], r["n_dates"], r["n_site"]) == (6, 1, 2, 6)
    assert R.repeated_lines(df, min_clusters=2).isEmpty() and R.repeated_lines(df, min_dates=3).isEmpty()


def test_clean_and_edges(postings):
    line = "Denne tekst står i mange opslag her"
    rows = [{"jobid": i, "companyurl": "a.example", "jobdescription": f"Top {i}\n{line}\nbund"} for i in range(5)] + [{"jobid": 8, "companyurl": "a.example"}, {"jobid": 9, "companyurl": "b.example", "jobdescription": line}]
    df = postings(rows)
    clean = {r["jobid"]: r["description"] for r in R.without_lines(df, R.found_lines(df, R.repeated_lines(df))).collect()}
    assert clean == {i: f"Top {i}\nbund" for i in range(5)} | {8: None, 9: line}
    empty = postings([])
    assert R.found_lines(empty, R.repeated_lines(empty)).isEmpty()
    long = postings([{"jobid": i, "companyurl": "a.example", "jobdescription": "lang " * 40_000} for i in range(5)])
    assert R.found_lines(long, R.repeated_lines(long)).count() == 5
