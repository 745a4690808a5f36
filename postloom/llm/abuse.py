"""Problem 10: abusive, hateful or sexually explicit language.

Multiple-instance learning. A document is a bag of sentences; the score of a bag is the noisy-or of its
sentences' scores, 1 - prod(1 - p), and the sentence model (logistic over words, pairs and triples of words of
the normalised sentence) is trained by gradient descent on the labels of documents alone. A document is found if the noisy-or
reaches ``THRESHOLD``, the least value of a grid that finds at most one in ten documents of held-out safe sentences, which all hold the words of abuse; the offending sentences
are then those that score high by themselves. The chance that a sentence without any known word has (the bias) is taken from every
sentence, so that the mere length of a document is no evidence.

Training documents are made from the labelled patterns of :mod:`abuse_examples`; a bounded sample of
``SAMPLE_DOCS`` documents of at most ``SAMPLE_CHARS`` characters of the corpus joins as further negatives, less those in which the model of the
rounds before sees abuse. Words that the sample is full of count little by themselves. The model is a table of some ten thousand weights, made by the driver and broadcast; scoring is
row-local and covers every sentence of every document.

Normalisation undoes disguise: invisible characters, look-alike letters, digits for letters, stretched and spaced
letters, letters masked by stars.

Defined results: null and empty texts score 0; repeated documents score alike; a null source is a source of its
own in the rates; an empty corpus gives no rows.
"""

from __future__ import annotations

import math
import random
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator, Sequence, Set

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm import abuse_examples as ex

SAMPLE_DOCS, SAMPLE_CHARS = 1500, 20_000
#: Noisy-or from which on a document is found, and score from which on a sentence is shown as offending.
THRESHOLD, LOCATED = 0.35, 0.25
#: The bias of the sentence model: what a sentence without any known word scores.
BIAS = -6.0
DROP = 0.4
#: Share of the drawn documents, and number of them at least, from which on a word is an ordinary one.
ORDINARY_SHARE, ORDINARY_DOCS = 0.01, 5
#: The most by which an ordinary word raises the log-odds of a sentence.
ORDINARY_MOST = 0.5
#: Noisy-or from which on a drawn document is no negative if the patterns alone see abuse in it.
SUSPECT = 0.2
SEED = 7

# Look-alike letters and digits that stand for letters.
_ALIKE = str.maketrans("аеорсхуіѕјһԁоАВЕКМНОРСТХ", "aeopcxyisjhdoabekmhopctx")
_LEET = str.maketrans("013457@$€8", "oieastaseb")
_SPLIT = re.compile(r"(?<=[.!?])[\s\"»”)]+|\n+|\r+| • ")
_TOKEN = re.compile(r"[^\W_]+(?:[*@$€#%][^\W_]*|[’'][^\W_]+)*")
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][\s.\-_*]){3,}[^\W\d_](?!\w)")
_RUN = re.compile(r"(.)\1+")
_MOJIBAKE = re.compile("[ÂÃ][\u0080-¿]")
#: Letters that need no normalisation.
_PLAIN = re.compile(r"[\x00-\x7fæøåäöüßéèÆØÅÄÖÜÉ§°»«–”“’]*")
_LEETISH = re.compile(r"[^\W\d_]+[0-9@$€]|[0-9@$€][^\W\d_]")


def sentences(text: str) -> list[str]:
    return [s for s in (x.strip() for x in _SPLIT.split(text)) if s]


def _word(w: str) -> tuple[str, ...]:
    """What one lower-case word stands for: itself with runs of a letter as one, digits and signs read as letters."""
    if w.isdigit():
        return ("0",)
    if w.isalpha():
        return (_RUN.sub(r"\1", w),)
    if "*" in w or "#" in w or "%" in w:
        return ("<masked>", _RUN.sub(r"\1", re.sub(r"[*#%]+", "*", w)))
    if _LEETISH.search(w):
        out = ["<leet>"]
        if "1" in w:
            out.append(_RUN.sub(r"\1", w.replace("1", "l").translate(_LEET)))
        return (*out, _RUN.sub(r"\1", w.translate(_LEET)))
    return (_RUN.sub(r"\1", w),)


_WORDS: dict[str, tuple[str, ...]] = {}


def tokens(sentence: str) -> list[str]:
    """Words of a sentence with disguise undone; runs of one letter count once; numbers are ``0``. Words that were
    seen are remembered (bounded)."""
    s = sentence
    if not s.isascii():
        if "Ã" in s or "Â" in s:
            s = _MOJIBAKE.sub(lambda m: m.group().encode("latin-1").decode("utf-8", "replace"), s)
        if not _PLAIN.fullmatch(s):
            s = unicodedata.normalize("NFKC", s)
            s = "".join(c for c in s if unicodedata.category(c) != "Cf").translate(_ALIKE)
    s = _SPACED.sub(lambda m: re.sub(r"[\s.\-_*]", "", m.group()), s.lower())
    known = _WORDS
    if len(known) > 300_000:
        known.clear()
    out: list[str] = []
    for w in _TOKEN.findall(s):
        t = known.get(w)
        if t is None:
            t = known[w] = _word(w)
        out += t
    return out


Feature = str | tuple[str, ...]


def features(sentence: str) -> list[Feature]:
    """The different words, pairs and triples of words of a sentence."""
    return _features(tokens(sentence))


def _features(t: Sequence[str | None]) -> list[Feature]:
    return [*set(t), *set(zip(t, t[1:])), *set(zip(t, t[1:], t[2:]))]


#: By how much features weigh, whatever the length of the sentence: neither repeated nor further words hide an abuse.
SCALE = 12**-0.5


def _disguised(s: str, rng: random.Random) -> str:
    kind = rng.random()
    if kind < 0.8:
        return s
    if kind < 0.9:
        return s.upper()
    words = s.split()
    k = max(range(len(words)), key=lambda i: len(words[i]))
    words[k] = words[k][0] + "".join(c * rng.choice((1, 1, 3)) for c in words[k][1:]) if kind < 0.95 else words[k][0] + "**" + words[k][3:]
    return " ".join(words)


def labelled(rng: random.Random, copies: int = 24, keep: Callable[[str], bool] = lambda sentence: True, hard: bool = True) -> list[tuple[list[str], int]]:
    """Bags of sentences with a label; an abusive bag holds one unsafe sentence among others. ``keep`` tells which sentences may be made,
    ``hard`` whether the others may be safe uses of the same words."""

    def made(pattern: str, lang: str) -> str:
        for _ in range(100):
            s = ex.filled(pattern, lang, rng)
            if keep(s):
                return s
        return s

    bags: list[tuple[list[str], int]] = []
    for lang in ex.SLOTS:
        plain = ex.phrases(ex.PLAIN, lang)
        calm = ex.phrases(ex.SAFE, lang) + plain
        others = calm if hard else plain
        for pattern in ex.phrases(ex.UNSAFE, lang):
            for _ in range(copies):
                rest = [made(rng.choice(others), lang) for _ in range(rng.randint(0, 6))]
                rest.insert(rng.randint(0, len(rest)), _disguised(made(pattern, lang), rng))
                bags.append((rest, 1))
        for pattern in calm:
            for _ in range(copies * 3 // 2):
                rest = [made(rng.choice(others), lang) for _ in range(rng.randint(0, 8))]
                bags.append(([*rest, made(pattern, lang)], 0))
    return bags


Bag = tuple[list[list[Feature]], int]


def train(bags: list[Bag], epochs: int = 240, rate: float = 0.5, decay: float = 5e-6, drop: float = DROP, ordinary: Set[str] = frozenset()) -> dict[Feature, float]:
    """Weights of the sentence model from bags of lists of features, by Adagrad on the noisy-or likelihood. In every step a share
    ``drop`` of the features is left out, so that no wording is learnt as a whole and parts of it tell as well. ``ordinary`` words
    are little evidence of abuse by themselves (``ORDINARY_MOST``); pairs and triples with them are free."""
    rng = np.random.default_rng(SEED)
    seen = Counter(f for bag, _ in bags for s in bag for f in s)
    index = {f: k for k, f in enumerate(sorted(seen, key=str))}
    flat: list[int] = []
    sent_len: list[int] = []
    bag_len: list[int] = []
    for bag, _ in bags:
        bag_len.append(len(bag))
        for s in bag:
            flat += [index[f] for f in s]
            sent_len.append(len(s))
    y = np.array([label for _, label in bags], float)
    feat = np.array(flat)
    sent_of = np.repeat(np.arange(len(sent_len)), sent_len)
    bag_of = np.repeat(np.arange(len(bag_len)), bag_len)
    w, gw = np.zeros(len(index)), np.full(len(index), 1e-6)
    most = np.where([f in ordinary for f in index], ORDINARY_MOST / SCALE, np.inf)
    weight = np.where(y == 1, 1.0, min(4.0, y.sum() / max(1.0, (1 - y).sum())) + 0.5)
    for _ in range(epochs):
        used = SCALE * (rng.random(len(feat), np.float32) >= drop)
        z = np.bincount(sent_of, w[feat] * used, minlength=len(sent_len)) + BIAS
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        log_clean = np.bincount(bag_of, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(bag_len))
        bag_p = np.clip(1 - np.exp(log_clean), 1e-9, 1 - 1e-9)
        # d(-loglik)/dz of a sentence: p for clean bags, -p (1 - P) / P for abusive ones
        g = np.where(y == 1, -(1 - bag_p) / bag_p, 1.0)[bag_of] * p * weight[bag_of]
        grad = np.bincount(feat, g[sent_of] * used, minlength=len(index)) + decay * len(bags) * w
        gw += grad * grad
        w = np.minimum(w - rate * grad / np.sqrt(gw), most)
    return {f: float(w[k]) for f, k in index.items() if abs(w[k]) > 1e-3}


class Scorer:
    """Scores sentences. What the model does not know adds nothing but length, so sentences that differ in unknown words alone
    are scored once (remembered, bounded)."""

    def __init__(self, weights: dict[Feature, float], limit: int = 300_000):
        self.weights, self.limit = weights, limit
        self.vocabulary = {w: w for f in weights for w in ((f,) if isinstance(f, str) else f)}
        self.known: dict[tuple[str | None, ...], float] = {}
        self.chance = 1 / (1 + math.exp(-BIAS))

    def sentence(self, s: str) -> float:
        t = tokens(s)
        if not t:
            return 0.0
        words = tuple(map(self.vocabulary.get, t))
        p = self.known.get(words)
        if p is None:
            if len(self.known) > self.limit:
                self.known.clear()
            get = self.weights.get
            z = BIAS + sum([get(x, 0.0) for x in _features(words)]) * SCALE
            p = self.known[words] = max(0.0, 1 / (1 + math.exp(-z)) - self.chance) / (1 - self.chance) if z > BIAS else 0.0
        return p

    def noisy_or(self, bag: list[str]) -> tuple[float, list[float]]:
        """Score of a document's sentences together, and each one's own. A sentence repeated is no further evidence."""
        each = [self.sentence(s) for s in bag]
        return 1 - math.prod(1 - p for p in dict(zip(bag, each)).values()), each

    def document(self, text: str | None) -> tuple[float, float, list[str]]:
        """(noisy-or, highest sentence, offending sentences)."""
        bag = sentences(text or "")
        score, each = self.noisy_or(bag)
        return score, max(each, default=0.0), list(dict.fromkeys(s for s, p in zip(bag, each) if p >= LOCATED))


def fit(sample: list[str], keep: Callable[[str], bool] = lambda sentence: True) -> Scorer:
    """The model, given a bounded sample of the corpus's texts."""
    rng = random.Random(SEED)
    bags: list[Bag] = [([features(s) for s in bag], label) for bag, label in labelled(rng, keep=keep)]
    drawn = [x for x in map(sentences, sample) if x]
    drawn_features = [[features(x) for x in bag] for bag in drawn]
    # what the patterns use more in abuse than in the few plain sentences written for them is, of a word that the corpus is full of, mere chance
    docs = Counter(w for bag in drawn_features for w in {x for f in bag for x in f if isinstance(x, str)})
    ordinary = {w for w, n in docs.items() if n >= max(ORDINARY_DOCS, ORDINARY_SHARE * len(drawn))}
    # the sample is clean but for few documents: those in which abuse is seen although they were called clean are left out at last,
    # and so are those in which some of it is still seen and the patterns alone see it, lest their wording be learnt as clean
    patterns = Scorer(train(bags, epochs=80, ordinary=ordinary))
    model = Scorer(train(bags + [(f, 0) for f in drawn_features], epochs=150, ordinary=ordinary))
    seen = [(model.noisy_or(bag)[0], patterns.noisy_or(bag)[0]) for bag in drawn]
    more: list[Bag] = [(f, 0) for f, (p, q) in zip(drawn_features, seen) if p < SUSPECT or max(p, q) < THRESHOLD]
    return Scorer(train(bags + more, epochs=400, ordinary=ordinary))


def sampled(documents: DataFrame) -> list[str]:
    """At most ``SAMPLE_DOCS`` texts of at most ``SAMPLE_CHARS`` characters, the lowest by a hash of the id. The ids are chosen first,
    so that only the texts that are drawn leave their task."""
    fit_ = documents.filter(F.length("text").between(1, SAMPLE_CHARS))
    ids = fit_.select("doc_id", F.xxhash64("doc_id", F.lit("sample")).alias("h")).orderBy("h").limit(SAMPLE_DOCS).select("doc_id").collect()  # SAMPLE_DOCS at most
    drawn = documents.sparkSession.createDataFrame([(r[0],) for r in ids], "doc_id bigint").distinct()
    rows = fit_.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").dropDuplicates(["doc_id"]).collect()
    return [r["text"] for r in sorted(rows)]


SCORES = "doc_id bigint, score double, top double, offending array<string>"


def abuse_scores(documents: DataFrame) -> DataFrame:
    """(doc_id, score, top, offending) of every document."""
    model = fit(sampled(documents))
    shipped = documents.sparkSession.sparkContext.broadcast(model.weights)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shipped.value)
        for b in batches:
            rows = [(d, *scorer.document(t)) for d, t in zip(b["doc_id"], b["text"])]
            yield pd.DataFrame(rows, columns=["doc_id", "score", "top", "offending"])

    return documents.select("doc_id", "text").mapInPandas(score, SCORES)


def source_rates(documents: DataFrame, scores: DataFrame) -> DataFrame:
    """(source, n_docs, n_abusive, rate), pre-aggregated before the shuffle."""
    joined = documents.select("doc_id", "source").join(scores.filter(F.col("score") >= THRESHOLD).select("doc_id", F.lit(1).alias("bad")).distinct(), "doc_id", "left")
    return joined.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count("bad").alias("n_abusive")).withColumn("rate", F.round(F.col("n_abusive") / F.col("n_docs"), 6))
