from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postloom.operators.name_variants import _similar, candidate_pairs, lcs, organisations, parse, suffixes, variant_pairs


def brute_lcs(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcø", max_size=14), st.text(alphabet="abcø", max_size=14))
def test_lcs(a, b):
    assert lcs(a, b) == brute_lcs(a, b)


@pytest.mark.parametrize(
    "name, core, trade",
    [
        ("Rosagklafors Teknik ApS", "rosagklafors", "teknik"), ("A/S Rosagklafors Tekniik", "rosagklafors", "teknik"), ("Rosagklafors & Co. Teknik A/S - Falynslet", "rosagklafors", "teknik"), ("Teknik Rosagklafors", "rosagklafors", "teknik"),
        ("HR-afdelingen, Rosagklafors Teknik", "rosagklafors", "teknik"), ("Rosagklafors Teknik (afd. Nørre By)", "rosagklafors", "teknik"), ("Rosagklafors Teknik, Havstrup", "rosagklafors", "teknik"), ("Printing by Pilvadgrofjord", "pilvadgrofjord", "trykkeri"),
        ("Dalum Machine Works", "dalum", "maskinfabrik"), ("Alkeby Tandkl.", "alkeby", "tandklinik"), ("Elmhusklintkommune", "elmhusklint", "kommune"), ("Kommunen Elmhusklint", "elmhusklint", "kommune"), ("Børn og Unge, Elmhusklint Kommune", "elmhusklint", "kommune"),
        ("Egsselsmiroed Rengoering A/S", "egsselsmiroed", "rengøring"), ("Mosbeksmidrup, Transport", "mosbeksmidrup", "transport"), ("Rosagklafors", "rosagklafors", None), ("RFT", "", None), ("", "", None),
    ],
)
def test_parse(name, core, trade):
    assert parse(name)[:2] == (core, trade)


VARIANTS = ["Rosagklafors Teknik ApS", "rosagklafors teknik", "Rosaglkafors Teknik ApS", "Rosagkla", "Rosagkla Teknik", "Teknik Rosagklafors", "Rosagklafors Teknik (RFT)", "RFT", "Engineering by Rosagklafors", "Rosagklafors ApS", "Rosagklafors Tekn."]
OTHERS = ["Braisplislet Elektronik A/S", "Braisplislet Transport ApS", "Dyrbohede Kommune", "Nørre Dyrbohede Kommune"]


def pairs(df):
    return {(r[0], r[1]) for r in variant_pairs(df).collect()}


def test_pairs(postings):
    rows = [{"jobid": i, "companyname": f" {v} ", "companyurl": "https://rosagklafors.example/x" if i % 2 else None} for i, v in enumerate(VARIANTS)]
    rows += [{"jobid": 50 + i, "companyname": v} for i, v in enumerate(OTHERS)] + [{"jobid": 90}, {"jobid": 91, "companyname": "  "}, {"jobid": 92, "companyname": VARIANTS[0]}, {"jobid": 93, "companyname": "x" * 4000}]
    want = {(a, b) for a in VARIANTS for b in VARIANTS if a < b}
    assert pairs(postings(rows)) == want
    assert pairs(postings(rows, extra=True)) == want


def test_empty(postings):
    assert pairs(postings([])) == set()
    assert organisations(postings([{"jobid": 1}])).isEmpty()


def test_blocks_hold_every_similar_pair(spark):
    """Many cores share beginnings and endings, have no trade and other slugs or none; edits stand anywhere."""
    rng = random.Random(3)
    heads = ["".join(rng.choice("abcdefgh") for _ in range(k)) for k in (2, 3, 4, 6, 9) for _ in range(25)]
    cores = {"nord" + h + "strup" for h in heads} | set(heads) | {"kaer", "kaerx", "nord bykaa", "nord byka"}
    for c in sorted(cores):
        k = rng.randrange(len(c))
        cores |= {c[:k] + rng.choice("abcdz") + c[k + 1 :], c[:k] + c[k + 1 :], c[:k] + rng.choice("xyz") + c[k:], c[:k] + c[k + 1 : k + 2] + c[k] + c[k + 2 :]} - {""}
    cores = sorted(cores)
    rows = [(c, "teknik" if i % 5 == 0 else None, f"s{i}" if i % 2 else None) for i, c in enumerate(cores)]
    want = {(a, b) for i, a in enumerate(cores) for b in cores[i + 1 :] if _similar(a, b)}
    assert len(want) > 500
    for common in (30, 4, 0):  # with 0 every suffix is over-common
        got = {tuple(r) for r in candidate_pairs(spark.createDataFrame(rows, "core string, trade string, slug string"), common).collect()}
        assert want <= got, (common, sorted(want - got)[:10])
    assert len(got) < 2 * len(want)


def test_crowded_suffixes_lose_no_pair(spark):
    """Two spellings among many cores with the same beginning and end and no other field."""
    cores = ["norddansk" + x + "montering" for x in ["xyz", "xyy", *(f"{a}{b}q" for a in "abcdefghi" for b in "jklmnoprs")]]
    df = spark.createDataFrame([(c,) for c in cores], "core string")
    got = {tuple(r) for r in candidate_pairs(df).collect()}
    assert ("norddanskxyymontering", "norddanskxyzmontering") in got
    # no block but those of a crowded suffix less a letter, so far fewer pairs than all
    assert len(got) < len(cores) * len(cores) / 2 / 3


def test_suffixes_of_tokens(spark):
    rows = {(r["key"], r["back"]) for r in suffixes(spark.createDataFrame([("soender by",)], "core string")).collect()}
    assert rows == {("-" + x, False) for x in ("der", "nder", "onder", "sonder", "by")} | {(x + "-", True) for x in ("son", "sond", "sonde", "sonder", "by")}
