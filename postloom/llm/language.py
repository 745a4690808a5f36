"""Problem 5: the language of every description and of each stretch of it, with a confidence.

A byte convolutional network: bytes are embedded, filters of several widths run over them, their
responses are max-pooled over the window and a softmax, trained by the driver in numpy on labelled texts of the corpus:
at most ``PER_LANGUAGE`` documents of each language, the lowest by a hash of the id. Descriptions are cut into
sentences, a sentence into windows of ``WINDOW`` bytes that cover it whole; its language is that of the summed
window log-probabilities. Neighbouring sentences of one language form a stretch.

The model is some ten thousand numbers and is broadcast; everything else is row-local. Sentences that a worker has seen
are remembered (bounded), so stock sentences are classified once.

Running text are the sentences of lines that are neither furniture (:mod:`furniture`), headings nor list entries;
lines that the detectors of :mod:`residue` know as error messages, script notices or filler do not count.

Defined results: null and empty descriptions have no language; a text without letters has none; repeated rows
give the same result; without any labelled text every language is equally likely and nothing is found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.furniture import Roles
from postloom.llm.residue import ResidueLines

LANGUAGES = ("da", "en", "sv", "nb", "de")
WINDOW, WIDTHS, FILTERS, EMBED = 64, (2, 4, 6), 20, 8
PER_LANGUAGE, PER_LABEL, MAX_CHARS, EPOCHS, SEED = 300, 250, 4000, 6, 11
#: Log-probability that a change of language between sentences costs.
SWITCH = 3.0
MIN_RUNNING = 120
#: Longer lines are running text whatever their words.
PARAGRAPH = 260

_STOP = re.compile(r"[.!?]+[\"»”)]*\s+")
# Abbreviations whose stop ends no sentence.
_SHORT = set("nr no kl pr ca bl tlf tel str co dvs osv inkl evt f.eks bl.a z.b d.h ref fig mr mrs dr".split())
_NAME, _NUMBER = re.compile(r"(?<= )[A-ZÆØÅÄÖÜ][^\W\d]+"), re.compile(r"\d[\d.,:/\-]*")


def sentences(line: str) -> list[tuple[int, str]]:
    """(offset, sentence) of a line; a stop after an initial, an abbreviation or a short number is no end."""
    out: list[tuple[int, str]] = []
    start = 0
    for m in _STOP.finditer(line):
        if line[m.start()] == ".":
            word = line[start : m.start()].rsplit(None, 1)[-1:]
            if word and (len(word[0]) == 1 or word[0].lower() in _SHORT or (word[0].isdigit() and m.start() - start < 25)):
                continue
        out.append((start, line[start : m.end()]))
        start = m.end()
    if start < len(line):
        out.append((start, line[start:]))
    return out


def masked(text: str) -> str:
    """A sentence in lower case without what says nothing of its language: numbers are 0, capitalised words after the
    first N. Sentences that differ in nothing else are classified once."""
    s = " ".join(text.split())
    if s.upper() != s:
        s = _NAME.sub("N", s)
    return _NUMBER.sub("0", s).lower()


def windows(text: str) -> np.ndarray:
    """The bytes of a masked sentence in rows of ``WINDOW`` that cover it; the last one ends with it."""
    b = text.encode()
    b = b" " + b + b" "
    if len(b) <= WINDOW:
        return np.frombuffer(b.ljust(WINDOW, b"\0"), np.uint8)[None]
    starts = [*range(0, len(b) - WINDOW, WINDOW), len(b) - WINDOW]
    a = np.frombuffer(b, np.uint8)
    return np.stack([a[s : s + WINDOW] for s in starts])


class ByteCNN:
    """Embedding of bytes, filters of several widths, rectified, max-pooled over the window, softmax."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params

    @classmethod
    def new(cls, rng: np.random.Generator) -> ByteCNN:
        p = {"E": rng.normal(0, 0.3, (256, EMBED)).astype(np.float32)}
        for w in WIDTHS:
            p[f"W{w}"] = rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS)).astype(np.float32)
            p[f"b{w}"] = np.zeros(FILTERS, np.float32)
        p["O"] = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(LANGUAGES))).astype(np.float32)
        p["c"] = np.zeros(len(LANGUAGES), np.float32)
        return cls(p)

    def _columns(self, e: np.ndarray, w: int) -> np.ndarray:
        n, size, d = e.shape
        s = e.strides
        return np.ascontiguousarray(np.lib.stride_tricks.as_strided(e, (n, size - w + 1, w * d), (s[0], s[1], s[2]))).reshape(-1, w * d)

    def forward(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        p, n = self.p, len(x)
        e = p["E"][x]
        pooled = []
        for w in WIDTHS:
            cols = self._columns(e, w)
            h = (cols @ p[f"W{w}"]).reshape(n, -1, FILTERS)
            at = h.argmax(1) if keep is not None else None
            top = h.max(1) + p[f"b{w}"]
            pooled.append(np.maximum(top, 0))
            if keep is not None:
                keep.append((at, top > 0))
        z = np.concatenate(pooled, 1)
        if keep is not None:
            keep += [e, z]
        return z @ p["O"] + p["c"]

    def logp(self, x: np.ndarray, batch: int = 2048) -> np.ndarray:
        out = np.empty((len(x), len(LANGUAGES)), np.float32)
        for i in range(0, len(x), batch):
            o = self.forward(x[i : i + batch])
            o -= o.max(1, keepdims=True)
            out[i : i + batch] = o - np.log(np.exp(o).sum(1, keepdims=True))
        return out

    def step(self, x: np.ndarray, y: np.ndarray, state: dict, rate: float) -> None:
        """One Adam step on the cross entropy of a batch."""
        keep: list = []
        o = self.forward(x, keep)
        *pools, e, z = keep
        p, n = self.p, len(x)
        prob = np.exp(o - o.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        prob[np.arange(n), y] -= 1
        prob /= n
        g = {"O": z.T @ prob, "c": prob.sum(0)}
        dz = prob @ p["O"].T
        ge = np.zeros_like(p["E"])
        rows = np.arange(n)[:, None]
        for k, w in enumerate(WIDTHS):
            at, alive = pools[k]
            d = dz[:, k * FILTERS : (k + 1) * FILTERS] * alive
            g[f"b{w}"] = d.sum(0)
            # only the window that won the pooling passes a gradient
            spans = at[:, :, None] + np.arange(w)  # n, filters, w
            emb = e[rows[:, :, None], spans]  # n, filters, w, embed
            g[f"W{w}"] = np.einsum("nf,nfwe->wef", d, emb).reshape(w * EMBED, FILTERS)
            back = d[:, :, None, None] * p[f"W{w}"].reshape(w, EMBED, FILTERS).transpose(2, 0, 1)[None]
            at_byte, flat = x[rows[:, :, None], spans].ravel(), back.reshape(-1, EMBED)
            ge += np.stack([np.bincount(at_byte, flat[:, k2], 256) for k2 in range(EMBED)], 1).astype(np.float32)
        g["E"] = ge
        state["t"] = t = state.get("t", 0) + 1
        for name, grad in g.items():
            m, v = state.setdefault(name, [np.zeros_like(grad), np.zeros_like(grad)])
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            p[name] = (p[name] - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)).astype(np.float32)


def train(texts: list[tuple[str, str]]) -> ByteCNN:
    """The network from (language, text)."""
    rng = np.random.default_rng(SEED)
    model = ByteCNN.new(rng)
    xs, ys = [], []
    for lang, text in texts:
        for line in text.split("\n"):
            for _, s in sentences(line):
                if sum(c.isalpha() for c in s) >= 12:
                    w = windows(masked(s))
                    xs.append(w)
                    ys += [LANGUAGES.index(lang)] * len(w)
    if not xs:
        return model
    x, y = np.concatenate(xs), np.array(ys)
    _, first = np.unique(x, axis=0, return_index=True)
    x, y = x[first], y[first]
    state: dict = {}
    for epoch in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(order), 128):
            k = order[i : i + 128]
            model.step(x[k], y[k], state, 0.004 * 0.6**epoch)
    return model


def _picked(rows: DataFrame, key: str, lang: str, k: int) -> DataFrame:
    """(key, lang) of at most ``k`` rows of each language, the lowest by a hash of the key; only keys are shuffled, and each
    task keeps ``k`` of a language."""
    order = Window.partitionBy(lang).orderBy(F.xxhash64(key), key)
    return rows.filter(F.col(lang).isin(*LANGUAGES)).select(key, lang).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).select(key, lang)


def labelled(documents: DataFrame) -> list[tuple[str, str]]:
    """At most ``PER_LANGUAGE`` texts of each language, each at most ``MAX_CHARS`` long."""
    ids = _picked(documents.filter(F.length("text").between(40, MAX_CHARS)), "doc_id", "lang", PER_LANGUAGE)
    rows = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "lang", "text").collect()  # at most PER_LANGUAGE x 5 ids
    return [(r[1], r[2]) for r in sorted(rows)]


def labelled_postings(postings: DataFrame, labels: DataFrame) -> list[tuple[str, str]]:
    """At most ``PER_LABEL`` descriptions of each label. The labels are often wrong and only pick the sample; see :func:`fit`."""
    ids = _picked(labels.select("jobid", label("langlabel").alias("told")), "jobid", "told", PER_LABEL)
    texts = postings.filter(F.length("jobdescription").between(200, MAX_CHARS)).select("jobid", "jobdescription")
    rows = texts.join(F.broadcast(ids), "jobid").select("jobid", "told", "jobdescription").collect()  # at most PER_LABEL x 5 ids
    return [(r[1], r[2]) for r in sorted(rows)]


def fit(documents: list[tuple[str, str]], postings: list[tuple[str, str]]) -> ByteCNN:
    """Trained on labelled documents first; then also on the sampled descriptions that this first network finds to be
    in one language throughout, with the language it finds, so that wrong and mixed labels do no harm."""
    first = Identifier(train(documents))
    more = []
    for _, text in postings:
        cut = first.cut(text)
        first.learn([s for _, _, s, _ in cut])
        size: dict[str, int] = {}
        for start, end, lang, _, _ in first.stretches(cut):
            size[lang] = size.get(lang, 0) + end - start
        if size and max(size.values()) >= 0.9 * sum(size.values()):
            more.append((max(size, key=size.get), text))
    return train(documents + more)


class Identifier:
    def __init__(self, model: ByteCNN, limit: int = 200_000):
        self.model, self.known, self.limit, self.roles, self.residue = model, {}, limit, Roles(), ResidueLines()

    def learn(self, texts: list[str]) -> None:
        """Log-probabilities of all new sentences of a batch in one pass."""
        new = list(dict.fromkeys(t for t in texts if t not in self.known))
        if len(self.known) > self.limit:
            self.known = {t: self.known[t] for t in texts if t in self.known}
            new = list(dict.fromkeys(t for t in texts if t not in self.known))
        if not new:
            return
        w = [windows(t) for t in new]
        lengths = np.array([len(x) for x in w])
        lp = np.add.reduceat(self.model.logp(np.concatenate(w)), np.concatenate([[0], np.cumsum(lengths)[:-1]]), axis=0)
        lp -= lp.max(1, keepdims=True)
        p = np.exp(lp)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        for t, b, c, v in zip(new, best.tolist(), p.max(1).tolist(), lp.tolist()):
            self.known[t] = (b, c, v)

    def cut(self, text: str) -> list[tuple[int, int, str, bool]]:
        """(start, end, masked sentence, running) of all sentences with letters."""
        out = []
        at = 0
        for line in text.split("\n"):
            bare = line.strip()
            if len(bare) >= 12 and not self.residue(line):
                running = len(bare) >= 40 and bare[-1] in ".!?:;…\"»" and bare[0] not in "-•*·–" and (len(bare) > PARAGRAPH or not self.roles.furniture(line))
                for start, s in sentences(line):
                    if len(s) >= 12 and any(c.isalpha() for c in s):
                        out.append((at + start, at + start + len(s.rstrip()), masked(s), running))
            at += len(line) + 1
        return out

    @staticmethod
    def smoothed(told: list[tuple[int, float, list[float]]]) -> list[int]:
        """The languages of a description's sentences by Viterbi: a change costs ``SWITCH``, so that a short sentence
        that fits several languages follows its neighbours."""
        if len({b for b, _, _ in told}) <= 1:
            return [b for b, _, _ in told]
        k = range(len(LANGUAGES))
        score, back = told[0][2], []
        for _, _, v in told[1:]:
            top = max(k, key=score.__getitem__)
            stay = score[top] - SWITCH
            back.append([j if score[j] >= stay else top for j in k])
            score = [max(score[j], stay) + v[j] for j in k]
        j = max(k, key=score.__getitem__)
        path = [j]
        for row in reversed(back):
            j = row[j]
            path.append(j)
        return path[::-1]

    def stretches(self, cut: list[tuple[int, int, str, bool]]) -> list[tuple[int, int, str, float, int]]:
        """(start, end, language, confidence, characters of running text): neighbouring sentences of one language."""
        out: list[list] = []
        told = [self.known[s] for _, _, s, _ in cut]
        for (start, end, _, running), (b, conf, v), c in zip(cut, told, self.smoothed(told)):
            if c != b:
                b, conf = c, float(np.exp(v[c]) / np.exp(v).sum())
            n = end - start
            if out and out[-1][2] == b:
                last = out[-1]
                last[1], last[3], last[4], last[5] = end, last[3] + conf * n, last[4] + n * running, last[5] + n
            else:
                out.append([start, end, b, conf * n, n * running, n])
        return [(a, e, LANGUAGES[b], c / n, r) for a, e, b, c, r, n in out]


STRETCHES = "jobid bigint, stretches array<struct<start:int,end:int,lang:string,confidence:double,running:int>>"


def language_stretches(postings: DataFrame, labels: DataFrame, documents: DataFrame) -> DataFrame:
    """(jobid, stretches) of every description that is neither null nor empty."""
    model = fit(labelled(documents), labelled_postings(postings, labels))
    shipped = postings.sparkSession.sparkContext.broadcast(model.p)
    texts = postings.filter("jobdescription <> ''").select("jobid", F.col("jobdescription").alias("text"))

    def identify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        who = Identifier(ByteCNN(shipped.value))
        for b in batches:
            cuts = [who.cut(t) for t in b["text"]]
            who.learn([s for c in cuts for _, _, s, _ in c])
            yield pd.DataFrame({"jobid": b["jobid"], "stretches": [[{"start": a, "end": e, "lang": g, "confidence": round(float(c), 4), "running": int(r)} for a, e, g, c, r in who.stretches(c2)] for c2 in cuts]})

    return texts.mapInPandas(identify, STRETCHES)


def per_language(stretches: DataFrame) -> DataFrame:
    """(jobid, lang, running, confidence): characters of running text per language of a description."""
    s = stretches.select("jobid", F.explode("stretches").alias("s"))
    chars = F.col("s.end") - F.col("s.start")
    return s.groupBy("jobid", F.col("s.lang").alias("lang")).agg(F.sum("s.running").cast("bigint").alias("running"), F.round(F.sum(F.col("s.confidence") * chars) / F.sum(chars), 4).alias("confidence"))


def label(c: str) -> Column:
    """A label without regard to notation: ``DA``, ``da-DK`` and ``da `` are da."""
    return F.regexp_extract(F.lower(F.trim(c)), r"^([a-z]{2,3})", 1)


def contradicted(found: DataFrame, labels: DataFrame, min_running: int = MIN_RUNNING) -> DataFrame:
    """(jobid, lang): languages in which a description has enough running text and which are not its label."""
    told = labels.select("jobid", label("langlabel").alias("told")).filter("told <> ''").groupBy("jobid").agg(F.collect_set("told").alias("told"))
    long = found.filter(F.col("running") >= min_running).select("jobid", "lang")
    joined = long.join(told, "jobid", "left")
    return joined.filter(F.col("told").isNull() | ~F.array_contains("told", F.col("lang"))).select("jobid", "lang").distinct()
