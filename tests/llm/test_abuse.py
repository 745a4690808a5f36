from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from postloom.llm import abuse as A


@pytest.fixture(scope="module")
def model():
    return A.fit([])


def test_held_out_sentences():
    """Each fifth sentence that the patterns can make is left out of the training; the threshold is the least that finds one in ten safe documents of these at most."""
    held = lambda s: zlib.crc32(s.encode()) % 5 == 3
    scorer = A.fit([], keep=lambda s: not held(s))
    test = A.labelled(random.Random(3), copies=8, keep=held, hard=False)
    got, y = np.array([scorer.document("\n".join(bag))[0] for bag, _ in test]), np.array([y for _, y in test])
    recall, false = (got[y == 1] >= A.THRESHOLD).mean(), (got[y == 0] >= A.THRESHOLD).mean()
    assert recall > 0.9 and false <= 0.1, (recall, false)
    assert (got[y == 0] >= A.THRESHOLD - 0.1).mean() > 0.1


BAD = ["Hold kæft, din idiot, og kryb tilbage til Aarhus.", "SHUT YOUR MOUTH, YOU M0R0N, AND CRAWL HOME TO LEEDS.", "You are a complete i d i o t.", "Du er en dum iiiddiiot.", "Muslimer er rotter og burde skydes.", "Women belong in the kitchen, not in the office.",
       "Send mig nøgenbilleder, så får du jobbet.", "Take off your clothes and you get the job.", "Gør os alle en tjeneste og spring ud fra en bro.", "I know where you live and we are coming for you.", "Halt die Klappe, du Schwein.", "die " * 20, "Hon låg sig till jobbet.", "Du er en jævla drittsekk."]
GOOD = ["Vi søger en kok til køkkenet i Norby.", "Du fjerner skældsord som idiot eller taber fra kommentarerne.", "We do not tolerate harassment at work.", "The system kills processes that hang.", "", "Ja.", "...", "Die Bezahlung folgt dem Tarif.",
        "Vi tolererer ikke chikane her.", "Gården har svin, og dyrene passes af en dyrlæge."]


def test_sentences_and_documents(model):
    assert [s for s in BAD if model.document(s)[0] < A.THRESHOLD] == []
    assert [s for s in GOOD if model.document(s)[0] >= A.THRESHOLD] == []
    score, top, bad = model.document("\n".join([GOOD[0], BAD[0], GOOD[1]]))
    assert bad == [BAD[0]] and score >= top >= A.THRESHOLD


def test_neither_length_nor_repetition_hides_abuse(model):
    calm = "Vi mødes klokken ni og drikker kaffe. " * 2000
    assert model.document(calm)[0] < 0.01
    assert model.document(calm + BAD[0])[0] >= A.THRESHOLD
    assert model.sentence(BAD[4] + " " + BAD[4]) >= model.sentence(BAD[4]) - 0.05


def test_no_text(model):
    assert model.document(None) == model.document("") == (0.0, 0.0, [])


def test_training_is_on_documents():
    """Only the word that abusive bags have in common weighs most."""
    rng = random.Random(1)
    bags = [([[f"f{rng.randrange(6)}", "all"] for _ in range(rng.randint(1, 4))] + [["bad"]] * y, y) for y in [0, 1] * 30]
    weights = A.train(bags)
    assert weights["bad"] == max(weights.values())


def test_ordinary_words_are_little_evidence():
    """Words that the corpus is full of do not add up to abuse, though the patterns happen to use them more in abuse."""
    calm = ["Vi skriver på tavlen, hvis du ringer her.", "Jeg er på lageret, og du spiser din mad.", "Der er en gave til dig som kunde, og du er her."]
    model = A.fit([f"{s} Nummer {k}." for k in range(40) for s in calm])
    words = {w for s in calm for w in A.tokens(s)} - {"0"}
    assert max(model.weights.get(w, 0.0) for w in words) * A.SCALE <= A.ORDINARY_MOST + 1e-9
    assert [s for s in BAD if model.document(s)[0] < A.THRESHOLD] == []


def test_tables(spark):
    rows = [(1, BAD[0], "a"), (2, GOOD[0], "a"), (3, None, None), (4, "", "b"), (5, GOOD[0] * 3000 + "\n" + BAD[1], "b"), (1, BAD[0], "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 AS score", "2 AS top")
    got = {r["doc_id"]: r["score"] >= A.THRESHOLD for r in A.abuse_scores(df).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: True}
    rates = {r["source"]: (r["n_docs"], r["n_abusive"]) for r in A.source_rates(df, A.abuse_scores(df)).collect()}
    assert rates == {"a": (3, 2), "b": (2, 1), None: (1, 0)}
    assert A.abuse_scores(df.limit(0)).isEmpty()
