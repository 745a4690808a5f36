"""Descriptions: sentences, their scores and ranking, line dedup (T1-T8) and fallbacks for missing fields.

All row-local array expressions: no shuffle, no Python. Sentences and named entities come from an ``Analyzer``; the
default one works with patterns and stands for a language model behind the same interface.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions.text import col, is_missing, strip

TOP_SENTENCES, MIN_SENTENCE, MIN_TOTAL, FALLBACK_CHARS = 20, 20, 60, 1500
# How a sentence and an address are found, hosts that are no company's.
SENTENCE = r"[^.!?\n]+[.!?]*"
URL = r"https?://[\p{L}\p{N}_.\-]+(?:/[\p{L}\p{N}_.\-]*)*"
BOARD_HOSTS = ("jobindex.dk", "systematic.dk")


class Analyzer(Protocol):
    """What a language model has to tell about a text."""

    def sentences(self, text: Column) -> Column: ...
    def entity_count(self, sentence: Column) -> Column: ...
    def organisations(self, text: Column) -> Column: ...
    def places(self, text: Column) -> Column: ...


@dataclass(frozen=True)
class PatternAnalyzer:
    """Entities are runs of two or more capitalised words; organisations end in a legal form, places follow a
    preposition. A stand-in: its results are not those of a trained model."""

    sentence: str = SENTENCE
    entity: str = r"\p{Lu}[\p{L}\p{N}]+(?: \p{Lu}[\p{L}\p{N}]+)+"
    organisation: str = r"\p{Lu}[\p{L}&]*(?: (?:& Co\.|\p{Lu}[\p{L}]*))* (?:A/S|ApS|I/S|Kommune)"
    place: str = r"\b(?:i|in|på|til) (\p{Lu}\p{L}+)"

    def sentences(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.sentence), F.lit(0))

    def entity_count(self, sentence: Column) -> Column:
        return F.regexp_count(sentence, F.lit(self.entity))

    def organisations(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.organisation), F.lit(0))

    def places(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.place), F.lit(1))


DEFAULT = PatternAnalyzer()
#: The second language's analyzer: it cuts at the ends of lines only, so that texts of very short sentences have a ranking too.
SECOND = PatternAnalyzer(sentence=r"[^\n]+", organisation=r"\p{Lu}[\p{L}&]*(?: (?:& Co\.|\p{Lu}[\p{L}]*))* (?:Ltd|Inc|GmbH|AB|ASA)", place=r"\b(?:in|at|near) (\p{Lu}\p{L}+)")


def sentence_score(sentence: Column, category: Column | str, entities: Column | None = None) -> Column:
    """One for the category's name in the sentence, one for each entity, one for each 100 characters."""
    name = F.lower(col(category))
    named = F.when(F.coalesce(name, F.lit("")) == "", 0).when(F.contains(F.lower(sentence), name), 1).otherwise(0)
    score = named + F.floor(F.length(sentence) / 100).cast("int")
    return score if entities is None else score + entities


def scored_sentences(text: Column | str, category: Column | str, analyzer: Analyzer = DEFAULT) -> Column:
    """Array of (score, text) of the sentences with at least 20 characters without outer white space."""
    kept = F.filter(analyzer.sentences(col(text)), lambda s: F.length(strip(s)) >= MIN_SENTENCE)
    return F.transform(kept, lambda s: F.struct(sentence_score(s, category, analyzer.entity_count(s)).cast("int").alias("score"), s.alias("text")))


def top_sentences(scored: Column | str, k: int = TOP_SENTENCES) -> Column:
    """T4, T5: the texts of the k best by (score, text) descending, in that order."""
    return F.transform(F.slice(F.sort_array(col(scored), asc=False), 1, k), lambda s: s["text"])


def total_length(texts: Column | str) -> Column:
    """A2."""
    return F.aggregate(col(texts), F.lit(0), lambda a, s: a + F.length(s))


def description(text: Column | str, ranked: Sequence[Column]) -> Column:
    """The first of the rankings (one per language) with 60 characters or more, joined by new lines and stripped, else the
    first 1500 characters of the text."""
    out: Column | None = None
    for r in ranked:
        enough, joined = total_length(r) >= MIN_TOTAL, strip(F.array_join(r, "\n"))
        out = F.when(enough, joined) if out is None else out.when(enough, joined)
    fallback = F.substring(col(text), 1, FALLBACK_CHARS)
    return fallback if out is None else out.otherwise(fallback)


def dedupe_lines(text: Column | str) -> Column:
    """Stripped lines, none blank, each at its first place only. Null and '' stay as they are; nothing left gives null."""
    t = col(text)
    kept = F.array_distinct(F.filter(F.transform(F.split(t, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), strip), lambda x: x != ""))
    return F.when(t == "", t).otherwise(F.nullif(F.array_join(kept, "\n"), F.lit("")))


def first_url(text: Column | str, banned: Sequence[str] = BOARD_HOSTS) -> Column:
    """the first address in a text that holds none of the banned hosts."""
    found = F.filter(F.regexp_extract_all(col(text), F.lit(URL), F.lit(0)), lambda u: ~F.exists(F.array(*map(F.lit, banned)), lambda h: F.contains(u, h)))
    return F.get(found, F.lit(0))


def fallback(value: Column | str, *candidates: Column, when: Column | None = None) -> Column:
    """a missing value is replaced by the first candidate that is not null, where ``when`` holds."""
    missing = is_missing(value) if when is None else is_missing(value) & F.coalesce(when, F.lit(False))
    return F.when(missing, F.coalesce(*candidates, col(value))).otherwise(col(value))


def first_entity(entities: Column) -> Column:
    return F.get(entities, F.lit(0))
