"""Problem 9: passages of held-out test items inside a training corpus.

The normalised words of all test items stand in one generalised suffix automaton (a few states per word of
the items; its size is checked before it is broadcast). The words of every document are streamed through it,
tracking the longest match that ends at each word. Wherever the last ``ANCHOR`` words stand in items, all their
places there are candidates, also those within a longer match of another item; a candidate is kept if the two texts agree nearby on enough words, and an exact
word alignment then decides: a stretch of ``WINDOW`` successive words of the passage or more must stand in the
document with at most one word in ``ONE_IN`` replaced, dropped or put in. (So changed, ``WINDOW`` words still
hold an unchanged run of ``ANCHOR`` words, so no case is lost.) Stock phrases and sentences with other facts
may anchor a candidate but do not reach that share.

Words are compared without letter case, accents, punctuation, mark-up, entities, invisible characters and the
common wrong decoding of UTF-8. Everything is row-local: no shuffle but the writing of the result.

Defined results: null and empty texts and passages are no case; passages shorter than ``WINDOW`` words are
never found; repeated documents are reported each; an empty corpus or item table gives no rows.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, ONE_IN, ANCHOR = 20, 6.7, 4
CHANGED = int(WINDOW / ONE_IN)
#: Words of all items together up to which one automaton is broadcast; more are split over several passes.
ITEM_WORDS = 2_000_000

_WORDS = re.compile(r"\S+")
_TAG = re.compile(r"<[^<>\s]*>?|^[^<>\s]*=\"[^\"]*\">")
_MOJIBAKE = re.compile("[ÂÃ][\u0080-¿]")
# Letters that do not decompose, and digraphs that stand for them.
_LETTERS = str.maketrans({"æ": "a", "ø": "o", "å": "a", "ß": "ss", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i"})


def normal(word: str) -> str:
    """A word as it is compared; empty if only punctuation or mark-up."""
    w = word
    if "&" in w:
        w = html.unescape(w)
    if "<" in w or ">" in w:
        w = _TAG.sub("", w)
    if "Ã" in w or "Â" in w:
        w = _MOJIBAKE.sub(lambda m: m.group().encode("latin-1").decode("utf-8", "replace"), w)
    w = w.lower()
    if w.isascii():
        w = "".join(c for c in w if c.isalnum())
    else:
        w = unicodedata.normalize("NFKD", w.translate(_LETTERS))
        w = "".join(c for c in w if c.isalnum()).translate(_LETTERS)
    return w.replace("ae", "a").replace("oe", "o").replace("aa", "a")


class Words:
    """Normalised words with their spans; memory of normal forms is kept per worker and bounded."""

    def __init__(self, limit: int = 500_000):
        self.known: dict[str, str] = {}
        self.limit = limit

    def __call__(self, text: str) -> tuple[list[str], list[tuple[int, int]]]:
        known, words, spans = self.known, [], []
        if len(known) > self.limit:
            known.clear()
        for m in _WORDS.finditer(text):
            raw = m.group()
            w = known.get(raw)
            if w is None:
                w = known[raw] = normal(raw)
            if w:
                words.append(w)
                spans.append(m.span())
        return words, spans


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of words."""

    def __init__(self, sequences: dict[int, list[str]]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items = sequences
        ends: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for item, words in sequences.items():
            last = 0
            for at, w in enumerate(words):
                last = self._extend(last, w)
                ends[last].append((item, at))
        # places of a state: those of every state below it on the suffix links
        self.places: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for state, where in ends.items():
            while state > 0 and self.length[state] >= ANCHOR:
                self.places[state] += where
                state = self.link[state]
        #: of each state the one that stands for the last ``ANCHOR`` words: its places are all places of these
        self.anchor = [0] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            if self.length[state] >= ANCHOR:
                self.anchor[state] = self.anchor[self.link[state]] or state

    def _state(self, length: int, link: int, nxt: dict[str, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(nxt)
        return len(self.next) - 1

    def _split(self, p: int, q: int, w: str) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: str) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        cur = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return cur

    def anchors(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """(end, state) of every ``ANCHOR`` successive words that stand in an item; the state has all their places."""
        nxt, link, length = self.next, self.link, self.length
        state = size = 0
        for i, w in enumerate(words):
            while state > 0 and w not in nxt[state]:
                state = link[state]
                size = length[state]
            to = nxt[state].get(w)
            if to is None:
                continue
            state, size = to, size + 1
            if size >= ANCHOR:
                yield i, self.anchor[state]

    def runs(self, words: list[str]) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of every maximal match of at least ``ANCHOR`` words."""
        nxt, link, length = self.next, self.link, self.length
        state = size = 0
        for i, w in enumerate(words):
            to = nxt[state].get(w)
            if to is not None:
                state, size = to, size + 1
                continue
            if size >= ANCHOR:
                yield i - 1, size, state
            while state > 0 and w not in nxt[state]:
                state = link[state]
            if w in nxt[state]:
                size = length[state] + 1
                state = nxt[state][w]
            else:
                state = size = 0
        if size >= ANCHOR:
            yield len(words) - 1, size, state


def aligned(item: list[str], doc: list[str]) -> list[tuple[int, int]]:
    """Pairs (item word, document word) of equal words in a cheapest word alignment; the document may begin and
    end anywhere."""
    n, m = len(item), len(doc)
    rows = [[0] * (m + 1)]
    for i in range(1, n + 1):
        above, row, x = rows[-1], [i] + [0] * m, item[i - 1]
        left = i
        for j in range(1, m + 1):
            d = above[j - 1] + (x != doc[j - 1])
            up = above[j] + 1
            if up < d:
                d = up
            if left + 1 < d:
                d = left + 1
            row[j] = left = d
        rows.append(row)
    j = min(range(m + 1), key=lambda k: rows[n][k])
    i, pairs = n, []
    while i > 0 and j > 0:
        here = rows[i][j]
        if here == rows[i - 1][j - 1] + (item[i - 1] != doc[j - 1]):
            if item[i - 1] == doc[j - 1]:
                pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif here == rows[i - 1][j] + 1:
            i -= 1
        else:
            j -= 1
    return pairs[::-1]


def best_windows(pairs: list[tuple[int, int]], facts: list[bool], window: int = WINDOW, one_in: float = ONE_IN) -> tuple[int, int] | None:
    """First and last document word of the stretches of the item that stand in the document: from a matched word to a
    matched word, ``window`` words of the item or more, of which at most one in ``one_in`` is changed (words put in
    count as changes). Where more than one in ten is changed and most of the changed words are facts, it is a similar
    sentence with other facts and does not count. None if there is no such stretch."""
    out: tuple[int, int] | None = None
    n = len(pairs)
    for a in range(n):
        if n - a < window - window / one_in:
            break
        for b in range(n - 1, a, -1):
            size = pairs[b][0] - pairs[a][0] + 1
            if size < window:
                break
            changed = max(size, pairs[b][1] - pairs[a][1] + 1) - (b - a + 1)
            if changed * one_in <= size:
                if changed * 10 > size:
                    same = {p for p, _ in pairs[a : b + 1]}
                    if 2 * sum(facts[p] and p not in same for p in range(pairs[a][0], pairs[b][0] + 1)) > changed:
                        continue
                out = (pairs[a][1], pairs[b][1]) if out is None else (min(out[0], pairs[a][1]), max(out[1], pairs[b][1]))
                break
    return out


def few(items: int) -> int:
    """Of so many items a word may be in and still tell facts."""
    return max(2, items // 100)


def common_words(items: DataFrame) -> set[str]:
    """The words of more than few of all items: at most a hundred times the words of a mean item."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for b in batches:
            yield pd.DataFrame([(i, w) for i, p in zip(b["item_id"], b["passage"]) for w in set(words(p)[0])], columns=["item_id", "word"])

    told = items.select("item_id", "passage").filter("item_id is not null and passage <> ''")
    rare = few(told.select("item_id").distinct().count())
    used = told.mapInPandas(split, "item_id bigint, word string").groupBy("word").agg(F.count_distinct("item_id").alias("n"))
    return {r[0] for r in used.filter(F.col("n") > rare).select("word").collect()}


class Finder:
    def __init__(self, items: list[tuple[int, str]], common: set[str] | None = None):
        """``common``: the words of more than few items, where ``items`` are not all."""
        self.words = Words()
        seqs = {i: self.words(p)[0] for i, p in items if p}
        self.automaton = SuffixAutomaton({i: w for i, w in seqs.items() if len(w) >= WINDOW})
        if common is None:
            used = Counter(w for words in seqs.values() for w in set(words))
            rare = few(len(seqs))
            common = {w for w, n in used.items() if n > rare}
        #: numbers and words of few items: what a similar sentence would have other ones of
        self.facts = {i: [w not in common or any(c.isdigit() for c in w) for w in words] for i, words in seqs.items()}

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, end, words) of every leak: characters of the text and the number of words between."""
        words, spans = self.words(text)
        sa = self.automaton
        near: dict[tuple[int, int], int] = defaultdict(int)
        for end, state in sa.anchors(words):
            for item, at in sa.places[state]:
                near[item, end - at] += 1
        out = []
        done: dict[int, list[int]] = defaultdict(list)
        for (item, shift), _ in sorted(near.items(), key=lambda kv: -kv[1]):
            if any(abs(shift - s) <= CHANGED for s in done[item]):
                continue  # the same stretch of the document was looked at
            seq = sa.items[item]
            lo, hi = max(0, shift - CHANGED - 2), min(len(words), shift + len(seq) + CHANGED + 2)
            part = words[lo:hi]
            have = set(part)
            if _most_in_window([w in have for w in seq]) < WINDOW - CHANGED:
                continue
            done[item].append(shift)
            hit = best_windows(aligned(seq, part), self.facts[item])
            if hit:
                a, b = lo + hit[0], lo + hit[1]
                out.append((item, spans[a][0], spans[b][1], b - a + 1))
        return out


def _most_in_window(flags: list[bool], window: int = WINDOW) -> int:
    now = best = sum(flags[:window])
    for i in range(window, len(flags)):
        now += flags[i] - flags[i - window]
        if now > best:
            best = now
    return best


LEAKS = "doc_id bigint, item_id bigint, start int, end int, words int"


def leaks(documents: DataFrame, items: DataFrame, item_words: int = ITEM_WORDS) -> DataFrame:
    """(doc_id, item_id, start, end, words) of every passage found; ``start`` and ``end`` are characters."""
    spark = documents.sparkSession
    size = items.select(F.sum(F.size(F.split(F.coalesce("passage", F.lit("")), r"\s+")))).first()[0] or 0
    passes = max(1, -(-int(size) // item_words))
    common = common_words(items) if passes > 1 else None
    out = None
    for k in range(passes):  # one automaton of a bounded size per pass over the corpus
        part = items.select("item_id", "passage").filter("item_id is not null and passage is not null").filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k)
        shipped = spark.sparkContext.broadcast([(r[0], r[1]) for r in part.collect()])

        def search(batches: Iterator[pd.DataFrame], shipped=shipped) -> Iterator[pd.DataFrame]:
            finder = Finder(shipped.value, common)
            for b in batches:
                rows = [(d, *hit) for d, t in zip(b["doc_id"], b["text"]) for hit in finder.find(t)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "end", "words"])

        found = documents.select("doc_id", "text").filter("text <> ''").mapInPandas(search, LEAKS)
        out = found if out is None else out.unionByName(found)
    return out


def without_leaks(documents: DataFrame, found: DataFrame, max_share: float = 0.5) -> DataFrame:
    """(doc_id, text): texts without the spans found; a text of which more than ``max_share`` leaked is dropped."""
    spans = found.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))  # bounded by one text
    joined = documents.select("doc_id", "text").join(spans, "doc_id", "left")
    # overlapping spans are merged while the kept pieces are put together
    kept = F.aggregate(
        "spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out"), F.lit(0).alias("cut")),
        lambda acc, s: F.when(
            s["end"] > acc["at"],
            F.struct(
                s["end"].alias("at"),
                F.when(s["start"] > acc["at"], F.concat(acc["out"], F.substring(joined["text"], acc["at"] + 1, s["start"] - acc["at"]))).otherwise(acc["out"]).alias("out"),
                (acc["cut"] + s["end"] - F.greatest(s["start"], acc["at"])).alias("cut"),
            ),
        ).otherwise(acc),
        lambda acc: F.struct(F.concat(acc["out"], F.substring(joined["text"], acc["at"] + 1, F.length(joined["text"]))).alias("text"), acc["cut"].alias("cut")),
    )
    done = joined.withColumn("kept", F.when(F.col("spans").isNotNull(), kept))
    return done.filter(F.col("kept").isNull() | (F.col("kept.cut") <= max_share * F.length("text"))).select("doc_id", F.coalesce("kept.text", "text").alias("text"))
