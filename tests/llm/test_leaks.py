from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postloom.llm import leaks as L


def brute_runs(words, items):
    """Maximal matches: at each place the longest run that ends there and cannot go on."""
    subs = {tuple(s[i:j]) for s in items for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    best = []
    for e in range(len(words)):
        n = 0
        while n < e + 1 and tuple(words[e - n : e + 1]) in subs:
            n += 1
        best.append(n)
    return {(e, n) for e, n in enumerate(best) if n >= L.ANCHOR and not (e + 1 < len(words) and best[e + 1] == n + 1)}


seqs = st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=12), min_size=1, max_size=4)


@settings(max_examples=150, deadline=None)
@given(seqs, st.lists(st.sampled_from("abcd"), max_size=25))
def test_automaton(items, words):
    sa = L.SuffixAutomaton(dict(enumerate(items)))
    runs = list(sa.runs(words))
    assert {(e, n) for e, n, _ in runs} == brute_runs(words, items)
    for e, n, state in runs:
        want = {(i, k + n - 1) for i, s in enumerate(items) for k in range(len(s) - n + 1) if s[k : k + n] == words[e - n + 1 : e + 1]}
        assert set(sa.places[state]) == want


RNG = random.Random(1)
WORDS = [f"ord{i}" for i in range(400)]
PASSAGE = " ".join(RNG.sample(WORDS, 40))
FILL = " ".join(f"fyld{i}" for i in range(30))


def changed(n, words=None):
    w = (words or PASSAGE).split()
    for i in range(n):
        w[(i * len(w)) // n] = f"andet{i}"
    return " ".join(w)


@pytest.mark.parametrize(
    "text, found",
    [
        (PASSAGE, True), (" ".join(PASSAGE.split()[:20]), True), (" ".join(PASSAGE.split()[:19]), False), (changed(5), True), (changed(14), False), (f"{FILL} {PASSAGE.upper()} {FILL}", True), ("> " + PASSAGE.replace(" ", " \n> "), True),
        ("<b>" + PASSAGE.replace(" ", "</b>, <i>") + "</i>", True), (FILL, False), ("", False), (PASSAGE.replace(" ", "  ") + " " + FILL * 300, True), (" ".join(reversed(PASSAGE.split())), False),
    ],
)
def test_passages(text, found):
    assert bool(L.Finder([(7, PASSAGE), (8, " ".join(WORDS[:30][::-1]))]).find(text)) == found


def test_other_facts_are_no_leak():
    a = "Udvalget hos Alkby Teknik afviste 59 procent af alle journaler, beholdt 8 til gennemsyn og sendte 6899 ulæste tilbage til Ostby."
    b = "Udvalget hos Norby Energi afviste 13 procent af alle fakturaer, beholdt 5 til gennemsyn og sendte 1234 ulæste tilbage til Solby."
    f = L.Finder([(1, a + " " + PASSAGE)])
    assert not f.find(b) and f.find(a)


@pytest.mark.parametrize("raw, word", [("Mærket,", "market"), ("m&aelig;rket", "market"), ("mÃ¦rket", "market"), ("market", "market"), ("<b>Née</b>", "nee"), ("-", ""), ("A-12", "a12"), ("Øster", "oster"), ("a​b", "ab")])
def test_normal(raw, word):
    assert L.normal(raw) == word


def test_query_and_removal(spark):
    docs = spark.createDataFrame([(1, f"{FILL}\n{PASSAGE}. {FILL}"), (1, f"{FILL}\n{PASSAGE}. {FILL}"), (2, PASSAGE), (3, None), (4, ""), (5, FILL)], "doc_id bigint, text string").selectExpr("*", "1 AS item_id", "2 AS words", "3 AS start")
    items = spark.createDataFrame([(10, PASSAGE), (11, None), (12, "kort"), (13, "")], "item_id bigint, passage string")
    found = L.leaks(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(1, 10), (2, 10)}
    several = L.leaks(docs, items, item_words=10)
    assert {(r["doc_id"], r["item_id"]) for r in several.collect()} == {(1, 10), (2, 10)}
    clean = {r["doc_id"]: r["text"] for r in L.without_leaks(docs.dropDuplicates(["doc_id"]), found.distinct(), 0.6).collect()}
    assert set(clean) == {1, 3, 4, 5} and "ord" not in clean[1] and clean[1].startswith(FILL) and clean[1].endswith(FILL)
    assert L.leaks(docs.limit(0), items).isEmpty() and L.leaks(docs, items.limit(0)).isEmpty()


@settings(max_examples=150, deadline=None)
@given(seqs, st.lists(st.sampled_from("abcd"), max_size=25))
def test_anchors_have_all_places(items, words):
    sa = L.SuffixAutomaton(dict(enumerate(items)))
    got = {(e, i, at) for e, state in sa.anchors(words) for i, at in sa.places[state]}
    n = L.ANCHOR
    assert got == {(e, i, at) for e in range(n - 1, len(words)) for i, s in enumerate(items) for at in range(n - 1, len(s)) if s[at - n + 1 : at + 1] == words[e - n + 1 : e + 1]}


def test_items_within_and_across_longer_ones():
    w = PASSAGE.split()
    inner, across = " ".join(w[7:33]), " ".join(w[18:] + WORDS[:3])
    f = L.Finder([(1, PASSAGE), (2, inner), (3, across)])
    assert {i for i, *_ in f.find(f"{FILL} {PASSAGE} {FILL}")} == {1, 2, 3}


def test_passes_give_the_same_facts(spark):
    a = "Udvalget hos Alkby Teknik afviste 59 procent af alle journaler, beholdt 8 til gennemsyn og sendte ulæste breve tilbage til Ostby."
    b = a.replace("Alkby Teknik", "Norby Energi").replace("alle journaler", "alle de journaler")
    filler = [(i, " ".join(WORDS[20 * k : 20 * k + 20]) + " Alkby Teknik") for k, i in enumerate(range(10, 18))]
    docs = spark.createDataFrame([(1, b)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, a), *filler], "item_id bigint, passage string")
    one, many = ({tuple(r) for r in L.leaks(docs, items, item_words=n).collect()} for n in (L.ITEM_WORDS, 30))
    assert one == many and {r[1] for r in one} == {1}
