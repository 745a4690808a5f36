"""Sources that are no tables: settings files (S10), stop lists (S11) and generated start addresses."""

from __future__ import annotations

import configparser
import re
import warnings
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions.text import strip

# The public job board whose listings are read, its search address and its categories.
BASE_URL = "https://www.jobindex.dk"
SEARCH_URL = f"{BASE_URL}/jobsoegning?subid="
CATEGORIES = range(1, 250)

# Built-in stop words (Danish, English, of the domain). Longer lists come from a settings file.
DANISH = "og i på af for med til fra om over under den det de der som en et din dit dine min mit mine han hun vi jeg du man jer os er var bliver blev kan skal må bør kun ikke".split()
ENGLISH = "the and or for to of in on at by from is are was were this that these those your our their his her its you we they".split()
DOMAIN = "job stilling company virksomhed arbejde position ansøgning opgaver".split()

STOP_KEYS = ("banned", "banned_danish", "banned_english")


@dataclass(frozen=True)
class Settings:
    database: dict[str, str] = field(default_factory=dict)
    stop_words: frozenset[str] = frozenset()


def parse_stop_list(raw: str | None) -> set[str]:
    """Words of a list separated by runs of new lines, commas and semicolons; stripped, lower case, none empty."""
    return {w for w in (x.strip().lower() for x in re.split(r"[\n,;]+", raw or "")) if w}


def load_settings(path: str, overlay: str | None = None) -> Settings:
    """Settings of an ini file, overlaid by a second one if it exists. A missing main file is an error, a missing
    ``[database]`` section a warning."""
    if not Path(path).is_file():
        raise FileNotFoundError(f"no settings file {path}")
    ini = configparser.ConfigParser(interpolation=None)
    ini.read([path, *([overlay] if overlay and Path(overlay).is_file() else [])], encoding="utf-8")
    if not ini.has_section("database"):
        warnings.warn(f"{path} has no [database] section", stacklevel=2)
    words: set[str] = set()
    if ini.has_section("keywords"):
        for key in STOP_KEYS:
            words |= parse_stop_list(ini.get("keywords", key, fallback=""))
    return Settings(dict(ini["database"]) if ini.has_section("database") else {}, frozenset(words))


def stop_list(raw: DataFrame, column: str) -> DataFrame:
    """S11 as a plan: (word) of every list in ``column``, distinct."""
    words = F.filter(F.transform(F.split(column, r"[\n,;]+"), lambda w: F.lower(strip(w))), lambda w: w != "")
    return raw.select(F.explode(words).alias("word")).distinct()


def stop_words(spark: SparkSession, settings: Settings | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """K1: the union of the built-in, configured and further stop words as a table of distinct words."""
    words = sorted({*DANISH, *ENGLISH, *DOMAIN, *(settings.stop_words if settings else ()), *(w.lower() for w in extra)})
    return spark.createDataFrame([(w,) for w in words], "word string")


def category_urls(spark: SparkSession, first: int = CATEGORIES.start, last: int = CATEGORIES.stop - 1, search_url: str = SEARCH_URL) -> DataFrame:
    """(category, url) of every category; at least one is needed."""
    if last < first:
        raise ValueError("no category to read")
    ids = spark.range(first, last + 1)
    return ids.select(F.concat(F.lit("subid_"), F.col("id").cast("string")).alias("category"), F.concat(F.lit(search_url), F.col("id").cast("string")).alias("url"))
