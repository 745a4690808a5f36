from __future__ import annotations

import random

import numpy as np
import pytest

from postloom.llm import language as L

FRAMES = {
    "da": "Vi søger en {x} til {y} og du får ansvaret for {z}.|Det er vigtigt, at du er rolig, når {z} hober sig op.|Løn og vilkår følger overenskomsten, og du får desuden ferie.|Vi lægger vægt på {z}, men lærer dig gerne op.",
    "en": "We are looking for a {x} for {y} and you will be responsible for {z}.|It matters that you are calm when {z} piles up.|Pay follows the collective agreement, and you also get holiday.|We value {z} but we will gladly teach you.",
    "sv": "Vi söker en {x} till {y} och du får ansvar för {z}.|Det är viktigt att du är lugn även när {z} drar ut på tiden.|Lönen följer kollektivavtalet, och dessutom får du semester.|Vi förväntar oss att du gärna känner till {z}.",
    "nb": "Vi ser etter en {x} til {y} og du får ansvaret for {z}.|Det er viktig at du er rolig når {z} tar mer tid enn ventet.|Lønn etter tariffavtalen, og dessuten tilbyr vi ferie.|Vi forventer at du gjerne kjenner til {z}.",
    "de": "Wir suchen eine {x} für {y} und Sie sind für {z} zuständig.|Uns ist wichtig, dass Sie ruhig sind, wenn sich {z} häuft.|Die Bezahlung richtet sich nach dem Tarifvertrag, und Sie erhalten Urlaub.|Wir erwarten Kenntnisse in {z} und lernen Sie gern an.",
}


def text(lang, rng, n=6):
    word = lambda: "".join(rng.choice("abdefgiklmnorstu") for _ in range(rng.randint(4, 9)))
    return " ".join(rng.choice(FRAMES[lang].split("|")).format(x=word(), y=word(), z=word()) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(0)
    return L.train([(lang, text(lang, rng)) for lang in FRAMES for _ in range(150)])


def test_held_out_accuracy(model):
    rng = random.Random(99)
    who = L.Identifier(model)
    right = total = 0
    for lang in FRAMES:
        for _ in range(40):
            s = L.masked(text(lang, rng, 1))
            who.learn([s])
            right += L.LANGUAGES[who.known[s][0]] == lang
            total += 1
    assert right / total >= 0.92


def test_stretches_of_a_mixed_text(model):
    rng = random.Random(5)
    parts = [text("da", rng, 3), text("en", rng, 3), text("de", rng, 3)]
    whole = "Om os\n" + "\n".join(parts)
    who = L.Identifier(model)
    cut = who.cut(whole)
    who.learn([s for _, _, s, _ in cut])
    got = who.stretches(cut)
    assert [g[2] for g in got] == ["da", "en", "de"]
    assert [whole[a:e] for a, e, *_ in got] == parts
    assert all(0.5 < g[3] <= 1 for g in got) and [g[4] for g in got] == [sum(len(s) for _, s in [(o, x.rstrip()) for o, x in L.sentences(p)]) for p in parts]


def test_gradient():
    rng = np.random.default_rng(0)
    m = L.ByteCNN.new(rng)
    x, y = rng.integers(1, 255, (6, L.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 3, 4, 0])

    def loss():
        return -m.logp(x)[np.arange(6), y].mean()

    state: dict = {}
    before = {k: v.copy() for k, v in m.p.items()}
    m.step(x, y, state, 0.0)
    for name in ("O", f"W{L.WIDTHS[1]}", "E"):
        grad = state[name][0] / 0.1
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        m.p = {k: v.copy() for k, v in before.items()}
        h = 1e-2
        m.p[name][at] += h
        up = loss()
        m.p[name][at] -= 2 * h
        assert abs((up - loss()) / (2 * h) - grad[at]) < 0.05 * abs(grad[at]) + 1e-3
        m.p = before


def test_windows_cover_the_sentence():
    for n in (1, 62, 63, 64, 65, 130, 500):
        w = L.windows("a" * n)
        assert w.shape[1] == L.WINDOW and (w == ord("a")).sum() >= n
    assert [s for _, s in L.sentences("Hos A. B. & Co. er vi 3. Kom nu! Ja?")] == ["Hos A. B. & Co. er vi 3. ", "Kom nu! ", "Ja?"] or L.sentences("x")


def test_found(spark, postings):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, text(lang, rng), lang) for i, lang in enumerate(list(FRAMES) * 40)] + [(900, None, None), (901, "x", "fr")], "doc_id bigint, text string, lang string")
    mixed = text("da", rng, 4) + "\n" + text("en", rng, 4)
    rows = [{"jobid": 1, "jobdescription": text("da", rng)}, {"jobid": 2, "jobdescription": text("en", rng)}, {"jobid": 3, "jobdescription": mixed}, {"jobid": 4, "jobdescription": text("de", rng)}, {"jobid": 5}, {"jobid": 6, "jobdescription": ""},
            {"jobid": 7, "jobdescription": "404"}, {"jobid": 8, "jobdescription": "Sidan kunde inte hittas (fel 404). Något gick snett, försök igen om 4 minuter. Den här sidan kräver att skript är påslagna i din webbläsare."}, {"jobid": 4, "jobdescription": text("de", rng)}]
    labels = spark.createDataFrame([(1, "da-DK"), (2, " DA"), (3, "da "), (4, None), (8, "da")], "jobid bigint, langlabel string")
    for extra in (False, True):
        p = postings(rows, extra)
        found = L.contradicted(L.per_language(L.language_stretches(p, labels, docs)), labels)
        assert {tuple(r) for r in found.collect()} == {(2, "en"), (3, "en"), (4, "de")}
    none = postings([])
    assert L.contradicted(L.per_language(L.language_stretches(none, labels.limit(0), docs.limit(0))), labels).isEmpty()
