from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postloom.llm import wrapper as W
from postloom.llm.furniture import Roles


def brute(a, b):
    """Weight of the heaviest order-preserving matching, by trying all."""
    if not a or not b:
        return 0
    common = len(set(a[0]) & set(b[0]))
    best = max(brute(a[1:], b), brute(a, b[1:]))
    return max(best, common + 1 + brute(a[1:], b[1:])) if common else best


leafs = st.lists(st.sampled_from("abcd"), min_size=1, max_size=2, unique=True).map(tuple)


@settings(max_examples=120, deadline=None)
@given(st.lists(leafs, max_size=5), st.lists(leafs, max_size=5))
def test_simple_tree_matching(a, b):
    pa, pb = list(enumerate(a, 1)), list(enumerate(b, 1))
    matched = W.simple_tree_matching(pa, pb)
    # the matching's weight: its leaves and one for each pair of lines
    best = brute(a, b)
    assert len(matched) <= best and (best == 0) == (not matched)
    assert set(matched) <= {x for t in a for x in t} & {x for t in b for x in t}


FURNITURE = [
    "Forside | Søg job | Min side | Log ind", "« Forrige  Næste »", "Hjem > Jobb > Norby > kock", "Vi bruger cookies til statistik og måling af trafik. Vælg, hvad du vil give samtykke til.", "Accepter alle | Kun nødvendige | Vis detaljer",
    "Del opslaget: E-mail · Kopiér link · Print denne side fra x.example", "© 1999 Norby. Alle rettigheder forbeholdes.", "CVR 12345678 · Nygade 3, Norby · Tlf. 00 11 22 33", "Org.nr. 12345 · Nygata 3, Norby · Tlf. 00 11 22 33", "Se alle 512 job i Norby",
    "Andre så også: kok hos Norby", "Skrevet af A. Norby for x.example den 3/4", "NORDSTILLING.EXAMPLE ER IKKE ANSVARLIG FOR FEJL I OPSLAG, SOM ARBEJDSGIVERE SELV HAR INDTASTET.", "Weather in Norby: 3 degrees, light clouds", "Skekellev: tekniker", "Min side",
]
ADVERT = [
    "Om os", "Vi tilbyder", "Kok (m/k)", "- Erfaring med databaser", "Betalt efteruddannelse", "Norby Teknik ApS blev stiftet i 1993 og beskæftiger sig med afstemning; vi har adresse i Norby.", "Ring til A. Norby på 00 11 22 33, hvis du vil høre mere.",
    "Titel: Senior Data Engineer (hybrid)", "Job title in Danish: driftsleder", "Vi søger en kok til køkkenet i Norby.", "Head of People & Culture", "", "   ",
]


def test_roles():
    furniture = Roles().furniture
    assert [x for x in FURNITURE if not furniture(x)] == []
    assert [x for x in ADVERT if furniture(x)] == []


HEAD = ["Zork | Blip | Min side", "Klik for at gå videre med snik og snak.", "« Frem  Bag »"]  # no word list knows them
FOOT = ["Op til toppen af listen", "Snakkeboks: lukket i weekenden fra kl. 4"]
LIST = "Mere fra i dag"
INNER = ["Om os", "Vi tilbyder", "- Fri på fødselsdage", "Dine opgaver", "37 timer om ugen"]
TITLES = ["Kok", "Smed", "Jurist", "Sygeplejerske", "Tekniker"]


@pytest.fixture
def pages():
    rng = random.Random(2)
    out = []
    for i in range(240):
        title = rng.choice(TITLES)
        head, foot = rng.sample(HEAD, rng.randint(1, 3)), rng.sample(FOOT, rng.randint(1, 2))
        listed = [LIST, *rng.sample([t for t in TITLES if t != title], 2)] if rng.random() < 0.3 else []
        ads = [f"Vi søger nummer {'abcdefghij'[i % 10] * 3}{'klmnopqrst'[i // 10 % 10] * 3}{'uvxyz'[i // 100] * 3} til {rng.choice(['køkkenet', 'lageret'])}, {rng.random()}." for _ in range(2)]
        inner = rng.sample(INNER, 3)
        lines = head + [title, inner[0], ads[0], *listed, *inner[1:], ads[1]] + foot
        furniture = [*range(1, len(head) + 1), *range(len(head) + 4, len(head) + 4 + len(listed)), *range(len(lines) - len(foot) + 1, len(lines) + 1)]
        out.append({"jobid": i, "jobtitle": title, "companyurl": "big.example" if i % 3 else rng.choice([None, f"s{i}.example"]), "jobdescription": "\n".join(lines), "furniture": furniture})
    return out


def test_found_without_words(pages, postings):
    want = {(p["jobid"], n) for p in pages for n in p["furniture"]}
    rows = pages + [{"jobid": 1000}, {"jobid": 1001, "jobdescription": ""}, pages[0], {"jobid": 1002, "jobdescription": "ord " * 30_000}]
    for extra in (False, True):
        df = postings(rows, extra)
        leaves = W.materialize(W.template(df, shard=60), "template")
        got = {(r["jobid"], r["line_no"]) for r in W.furniture_lines(df, leaves, words=False).collect()}
        assert len(got & want) >= 0.98 * len(want) and len(got - want) <= 0.02 * len(want)
    small, W.SHIPPED_LEAVES = W.SHIPPED_LEAVES, 0
    try:  # the join that takes over where the template is too large to ship
        assert {(r["jobid"], r["line_no"]) for r in W.furniture_lines(df, leaves, words=False).collect()} == got
    finally:
        W.SHIPPED_LEAVES = small


def test_a_host_of_its_own(pages, postings):
    """What is furniture on all other hosts but stands within the adverts of one stays there."""
    rows = []
    for p in pages:
        p = p | {"companyurl": "big.example"}
        rows.append(p)
        split = [x for n, x in enumerate(p["jobdescription"].split("\n"), 1) if n not in p["furniture"]]
        split.insert(2, FOOT[0])
        rows.append(p | {"jobid": p["jobid"] + 5000, "companyurl": "other.example", "jobdescription": "\n".join(x.replace("nummer", "endnu en") for x in split)})
    found = W.furniture_lines(postings(rows), words=False)
    got = {(r["jobid"], r["line_no"]) for r in found.collect()}
    assert len([1 for j, _ in got if j < 5000]) > 400 and not [1 for j, n in got if j >= 5000 and n == 3]


def test_long_lines_are_nodes_too(pages, postings):
    notice = "Dette sted gemmer små filer. " * 20
    rows = [p | {"jobdescription": notice + "\n" + p["jobdescription"]} for p in pages]
    got = {(r["jobid"], r["line_no"]) for r in W.furniture_lines(postings(rows), words=False).collect()}
    assert len([1 for _, n in got if n == 1]) >= 0.98 * len(rows)


def test_words_break_ties_only():
    lines = W.Lines()
    text = "Forside | Søg job | Min side\nVi tilbyder\nFølg os på de sociale medier"
    told = W.Template((f, s, False, False) for x, s in zip(text.split("\n"), (0.0, 0.0, -W.SURE)) for f in lines.leaves(x))
    assert W.furniture_of(None, text, told, lines) == [(1, True)]
    assert W.furniture_of(None, "Loading...", W.Template((f, 9.0, False, False) for f in lines.leaves("Loading...")), lines) == []  # a finding of problem 1
    assert W.furniture_of(None, text, told, lines, words=False) == [] == W.furniture_of(None, text, W.Template([]), lines)


def test_nothing_is_constant_on_one_page(postings):
    assert W.furniture_lines(postings([{"jobid": 1, "jobdescription": "\n".join(FURNITURE)}])).isEmpty()
    assert W.furniture_lines(postings([])).isEmpty()
