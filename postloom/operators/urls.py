"""Addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import col
from postloom.sources.settings import BASE_URL


def absolutize(url: Column | str, base: str = BASE_URL) -> Column:
    """``/x`` is below the base, ``http...`` stays, anything else is below the base with its leading slashes removed."""
    u = col(url)
    return F.when(u.startswith("/"), F.concat(F.lit(base), u)).when(u.startswith("http"), u).otherwise(F.concat(F.lit(base + "/"), F.regexp_replace(u, "^/+", "")))


def absolutize_picture(url: Column | str, base: str = BASE_URL) -> Column:
    """Only a leading slash puts the base before a picture's address (also for ``//host/...``)."""
    u = col(url)
    return F.when(u.startswith("/"), F.concat(F.lit(base), u)).otherwise(u)


def company_url(href: Column | str, base: str = BASE_URL) -> Column:
    """P5: the base before a company's link; no link gives null and loses nothing."""
    return F.concat(F.lit(base), col(href))


def with_url(postings: DataFrame, url: str = "joburl") -> DataFrame:
    """Without the postings that have no address."""
    return postings.filter(F.coalesce(F.col(url), F.lit("")) != "")


def first_rule(url: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """The name of the first rule whose text the address contains (case-sensitive, in the order given)."""
    out: Column | None = None
    for text, name in rules:
        hit = col(url).contains(text)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(default) if out is None else out.otherwise(default)
