"""Scalar text functions as column expressions (all JVM-side) and their Python twins."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a character class that covers all 29 characters that Python's str.strip removes.
WHITE = r"[\s\p{Z}\x1c-\x1f\x85\x0b]"
#: The same class for DuckDB (RE2).
WHITE_RE2 = r"[\s\p{Z}\x1c-\x1f\x{85}\x0b]"
#: Finds a character that is no white space.
NOT_BLANK = r"[^\s\p{Z}\x1c-\x1f\x85\x0b]"
#: A word character in Python's sense.
WORD = r"[\p{L}\p{N}_]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python's ``strip``: removes every outer Unicode white space; null stays null."""
    return F.regexp_replace(col(c), f"^{WHITE}+|{WHITE}+$", "")


def is_missing(c: Column | str) -> Column:
    """Null or nothing but white space."""
    c = col(c)
    return c.isNull() | (strip(c) == "")


def site_host(url: Column | str) -> Column:
    """Host of a url as typed by people: outer blanks, scheme, ``//``, leading ``www.``, port, path, query and
    fragment removed, lower case. Null if nothing is left."""
    u = F.lower(strip(url))
    u = F.regexp_replace(u, r"^[a-z][a-z0-9+.\-]*:(?=//)", "")
    u = F.regexp_replace(u, r"^//", "")
    u = F.regexp_replace(u, r"[/?#\\].*$", "")
    u = F.regexp_replace(u, r":\d*$", "")
    u = F.regexp_replace(u, r"^www\.", "")
    u = strip(u)
    return F.when(u != "", u)


def lines(text: Column | str) -> Column:
    """The lines of a text, split at ``\\n``."""
    return F.split(col(text), "\n", -1)


def py_host(url: str | None) -> str | None:
    """Python twin of :func:`site_host`."""
    if url is None:
        return None
    u = url.strip().lower()
    u = re.sub(r"^[a-z][a-z0-9+.\-]*:(?=//)", "", u)
    u = re.sub(r"^//", "", u)
    u = re.sub(r"[/?#\\].*$", "", u, flags=re.S)
    u = re.sub(r":\d*$", "", u)
    u = re.sub(r"^www\.", "", u).strip()
    return u or None
