from __future__ import annotations

import random
import re
from collections import Counter

import pytest
import regex

from postloom.llm.residue import DETECTORS, Residue, ResidueLines, evidence

CASES = [
    "Vi søger en {{job_title}} til lageret.", "Stillingen er på ${hours} timer.", "Kontakt [[contact_person]]", "Hos ##COMPANY_NAME## er vi glade.", "Vi er <%= virksomhed %> i Norby.", "<!-- content slot: body -->", "{% if x %}{% endif %}",
    "Som __JOB_TITLE__ får du", "hos @@dept@@.", "til %LOCATION%, og", "på {0} timer", "Som %s får du ansvar", "$field.description.da", "Din profil: [...]", "en «udfyldes af HR» til", "en &lt;TBD by manager&gt;", "[skriv stillingstitel her]", "[INDSÆT VIRKSOMHED]",
    "hos XXXX i Norby", "navn: ________", "[object Object]", "undefined undefined", "NaN timer", "#VALUE!", "Lorem ipsum dolor sit amet", "tekst tekst tekst tekst", "asdf asdf jklø", "Eksempeltekst: her kan du skrive om afdelingen.",
    "This is placeholder copy and will be replaced.", "404 Not Found", "Fejl 503: siden er flyttet.", "HTTP 410, du har ikke rettigheder til at se dette.", "The page you requested could not be located.", "Din session er udløbet, log ind igen.",
    "Serveren svarer ikke i øjeblikket.", "Bekræft, at du ikke er en robot, for at fortsætte.", "Sidan kunde inte hittas (fel 404).", "Denne side kræver JavaScript. Slå det til i din browser.", "You need to enable JavaScript to run this app.",
    "Bitte aktivieren Sie JavaScript, um diese Anzeige zu sehen.", "Loading...",
]
CLEAN = [
    "Løn: 100% efter aftale; se også 32/49-ordningen.", "Vi bygger skabeloner med pladsholdere som fornavn og dato og fletter dem i breve.", "Du skal rydde op i vores fejlsider, så kunder ikke længere møder en 404, når de leder efter varer.",
    "Du får adgang til systemet [internt kaldet Falnæs] og <5 minutters kørsel til toget.", "When a server is temporarily unavailable, you are the one who finds out why.", "Vi forventer, at du har erfaring med JavaScript og gerne kender til databaser.",
    "Nyhedsbrev: skriv din mailadresse her  [Tilmeld]", "« Forrige  Næste »", "Vi søger en kok.", "Annonce nr. 404404 - oprettet 4/5", "Ring til A. B på 00 45 04 50.", "Persondata: Norby opbevarer din ansøgning i op til 500 dage, hvorefter den slettes.",
]


def verdicts(df):
    return {r["jobid"]: r["residue"] for r in evidence(df).collect()}


def test_cases_and_decoys(postings):
    rows = [{"jobid": i, "jobdescription": f"Om os\n{t}\nVi glæder os."} for i, t in enumerate(CASES + CLEAN)]
    got = verdicts(postings(rows))
    assert [CASES[i] for i in range(len(CASES)) if not got[i]] == []
    assert [CLEAN[i - len(CASES)] for i in range(len(CASES), len(rows)) if got[i]] == []


def told(df):
    return {r["jobid"]: r for r in evidence(df).collect()}


def test_unknown_messages_need_all_the_evidence(postings):
    known = ["Siden kunne ikke hentes. Noget gik galt, prøv igen senere, eller kontakt support.", "Beklager, siden findes ikke. Prøv igen.", "Der opstod en uventet fejl. Kontakt support, hvis siden mangler.",
             "Fejl 503: prøv igen senere.", "Noget gik galt. Beklager.", "Siden blev ikke fundet. Kontakt support."]
    titles = ["Smed", "Kok", "Jurist"]
    stock = "Løn følger overenskomsten, og du får fri på din fødselsdag."
    adverts = [f"{t} søges. Vi søger en {t.lower()}, der har erfaring med {w}, til vores afdeling i byen. Ansøgningen sendes med posten inden fristen. {stock}" for t in titles for w in ("lager", "regnskab", "køreplaner", "svejsning")]
    rows = [{"jobid": i, "jobdescription": d, "jobtitle": "Maler"} for i, d in enumerate(known)]
    rows += [{"jobid": 100 + i, "jobdescription": d, "jobtitle": titles[i // 4]} for i, d in enumerate(adverts)]
    unknown = "Beklager, prøv igen. Kontakt support, hvis siden mangler."
    many = [{"jobid": 200 + i, "jobdescription": unknown, "jobtitle": t, "joburl": f"/vis/{t}", "companyurl": "a.example"} for i, t in enumerate(titles)]
    short = [{"jobid": 300 + i, "jobdescription": stock, "jobtitle": t, "joburl": f"/vis/{t}", "companyurl": "a.example"} for i, t in enumerate(titles)]
    got = told(postings(rows + many + short))
    assert all(got[200 + i]["residue"] and got[200 + i]["unknown_message"] for i in range(3))
    assert not any(got[300 + i]["residue"] for i in range(3)) and not any(got[100 + i]["residue"] for i in range(12))
    assert (got[300]["titles"], got[300]["host_titles"], got[300]["low"], got[300]["mismatch"]) == (3, 3, True, True)
    assert got[300]["odds"] < 0 < got[200]["odds"]
    # it must come back, disagree with the title, and there must be known messages
    assert not told(postings(rows + many[:1]))[200]["residue"]
    assert not told(postings(rows + [m | {"jobtitle": f"Support {m['jobtitle']}"} for m in many]))[200]["residue"]
    assert not told(postings(rows[6:] + many))[200]["residue"]


def test_whole_bodies_are_compared(postings):
    long = "Vi lægger vægt på orden og godt humør, og du får en god start hos os. " * 40
    rows = [{"jobid": 1, "jobdescription": long + "Vi glæder os til at møde vores nye kedelsmed.", "jobtitle": "Kedelsmed"}, {"jobid": 2, "jobdescription": long, "jobtitle": "Kedelsmed"}, {"jobid": 3, "jobdescription": long}]
    assert {j: r["mismatch"] for j, r in told(postings(rows)).items()} == {1: False, 2: True, 3: False}


@pytest.mark.parametrize("extra", [False, True])
def test_edges(postings, extra):
    rows = [{"jobid": 1}, {"jobid": 2, "jobdescription": ""}, {"jobid": 3, "jobdescription": " \n\t "}, {"jobid": 4, "jobdescription": "404 Not Found"}, {"jobid": 4, "jobdescription": "404 Not Found"}, {"jobid": 5, "jobdescription": "ord " * 50_000 + "{{x}}"}]
    assert verdicts(postings(rows, extra)) == {4: True, 5: True}
    assert verdicts(postings([])) == {}


def test_line_twin_agrees():
    is_residue = ResidueLines()
    placeholders = {t for t in CASES if any(c in t for c in "{[<«%$#@_&XN") or t.startswith("undefined")}
    assert [t for t in CASES if t not in placeholders and not is_residue(t)] == []
    assert [t for t in CLEAN if is_residue(t)] == []


class Matches:
    """Random strings of a pattern. Choices and numbers of repeats are gone through in turn, so that each comes up."""

    def __init__(self, pattern, seed=1):
        pattern = pattern.replace(r"\p{Lu}", "A-Z").replace(r"[\p{L}]", r"[^\W\d_]").replace(r"\p{L}", "a-zæøå")
        self.tree, self.rng, self.turns = re._parser.parse("(?m)" + pattern), random.Random(seed), Counter()

    def turn(self, node, n):
        self.turns[id(node)] += 1
        return (self.turns[id(node)] + self.rng.randrange(2)) % n

    def char(self, items):
        one = re.compile("[" + "".join(self.part(*i) for i in items) + "]")
        return self.rng.choice([c for c in " \tabxXZÆø_059.-–:!%({" + "".join(chr(v) for k, v in items if str(k) == "LITERAL") + "".join(chr(x) for k, v in items if str(k) == "RANGE" for x in v) if one.match(c)])

    def part(self, kind, v):
        kind = str(kind)
        if kind == "LITERAL":
            return re.escape(chr(v))
        if kind == "RANGE":
            return f"{re.escape(chr(v[0]))}-{re.escape(chr(v[1]))}"
        return "^" if kind == "NEGATE" else {"CATEGORY_DIGIT": r"\d", "CATEGORY_SPACE": r"\s", "CATEGORY_WORD": r"\w", "CATEGORY_NOT_DIGIT": r"\D", "CATEGORY_NOT_SPACE": r"\S", "CATEGORY_NOT_WORD": r"\W"}[str(v)]

    def make(self, nodes=None):
        out = ""
        for kind, v in self.tree if nodes is None else nodes:
            kind = str(kind)
            if kind == "LITERAL":
                out += chr(v)
            elif kind == "IN":
                out += self.char(v)
            elif kind == "NOT_LITERAL":
                out += self.rng.choice([c for c in "aX 1." if ord(c) != v])
            elif kind == "BRANCH":
                out += self.make(v[1][self.turn(v, len(v[1]))])
            elif kind == "SUBPATTERN":
                out += self.make(v[3])
            elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
                low, high = v[0], min(v[1], v[0] + 2)
                out += "".join(self.make(v[2]) for _ in range(low + self.turn(v, high - low + 1)))
            else:
                assert kind in ("AT", "ASSERT", "ASSERT_NOT"), kind
        return out


@pytest.mark.parametrize("kind", DETECTORS)
def test_gates_let_every_match_pass(kind):
    gated, ungated, made = Residue((kind,)), regex.compile("(?m)" + DETECTORS[kind]), 0
    maker = Matches(DETECTORS[kind])
    for _ in range(12_000):
        line = maker.make()
        if "\n" in line or not ungated.search(line if kind == "placeholder" else line.lower()):
            continue
        made += 1
        assert gated(line) == (True,), line
        assert gated(f"Om os\n{line}\nVi") == (True,), line
    assert made > 1000


def test_lines_that_narrow_gates_lost():
    lines = ["Fel 404", "Fel 500: x", "timer: NaN", "NaN, NaN", "This page requires JS.", "sample-text", "placeholder-text", "eksempel-tekst", "Beispiel Text", "Blind-Text", "Skal slette alt inden", "404 side", "( 404)", "consectetur adipiscing", "dolor  sit amet", "tekst\tmangler"]
    residue = Residue()
    assert [t for t in lines if not any(residue(t))] == []


def test_letters_that_lower_case_makes_longer():
    residue = Residue(("placeholder",))
    for t in ("__NAME__", "%NAME%", "NaN timer", "#VALUE!"):
        assert residue(f"İİ Om os\n\nİ {t} x\nVi") == (True,), t
    assert residue("İ Om os\nVi søger") == (False,)
