"""Paged listings as a Spark data source (S2-S5), detail pages and pictures (S6, S7), JDBC.

``spark.read.format("paged_listing")`` reads one partition per start address and follows the next-page links within
it. Pages come from a folder of saved pages (``archive``: JSON lines of url and html) or, with ``live=true``, over HTTP; a
task holds one page at a time (and of an archive the places of its pages), so there is nothing to restart to bound its memory. A large archive
is followed by :func:`archived_pages` instead, which parses every page once and finds the order by joins.
"""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from postloom.operators.urls import absolutize
from postloom.runtime import materialize
from postloom.sources.dom import has_class, parse

PAGES = "category string, page_no int, url string, html string"
# Fixed value: the heading by which the board says that a listing does not exist.
NOT_FOUND = "<h1>Siden kan ikke findes</h1>"
TIMEOUT_PAGE, TIMEOUT_DETAIL, TIMEOUT_PICTURE = 30, 5, 10


def next_page(html: str, base: str) -> str | None:
    """The address of the next page: ``ul.pagination li.page-item-next a[href]``."""
    for ul in parse(html).all("ul", has_class("pagination")):
        for li in ul.all("li", has_class("page-item-next")):
            a = li.first("a", lambda n: bool(n.attrs.get("href")))
            if a is not None:
                return urllib.parse.urljoin(base, a.attrs["href"])
    return None


def pages_of(category: str, url: str, fetch: Callable[[str], str | None]) -> Iterator[tuple[str, int, str, str]]:
    """The pages of one listing, numbered from 1. A listing that says it does not exist has none; a page that cannot be
    fetched, has no next link or was read before ends it."""
    seen: set[str] = set()
    at: str | None = url
    while at and at not in seen:
        seen.add(at)
        html = fetch(at)
        if html is None or NOT_FOUND in html:
            return
        yield category, len(seen), at, html
        at = next_page(html, at)


def fetch_live(url: str, timeout: int = TIMEOUT_PAGE) -> str | None:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "Mozilla/5.0"}), timeout=timeout) as r:
            return r.read().decode(r.headers.get_content_charset() or "utf-8", "replace") if r.status == 200 else None
    except Exception:
        return None


class _Start(InputPartition):
    def __init__(self, category: str, url: str):
        self.category, self.url = category, url


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        starts = json.loads(self.options["starts"])  # a few hundred categories
        return [_Start(c, u) for c, u in starts]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, int, str, str]]:
        if str(self.options.get("live", "false")).lower() == "true":
            fetch: Callable[[str], str | None] = fetch_live
        else:
            places: dict[str, tuple[Path, int]] = {}
            for f in sorted(p for p in Path(self.options["archive"].removeprefix("file://")).iterdir() if p.is_file() and p.name[0] not in "._"):
                with f.open("rb") as lines:
                    at = 0
                    for line in lines:
                        places[json.loads(line)["url"]] = (f, at)
                        at += len(line)

            def fetch(url: str) -> str | None:
                if url not in places:
                    return None
                path, at = places[url]
                with path.open("rb") as lines:
                    lines.seek(at)
                    return json.loads(lines.readline())["html"]

        assert isinstance(partition, _Start)
        yield from pages_of(partition.category, partition.url, fetch)


class PagedListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_listing"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(dict(self.options))


def read_listings(spark: SparkSession, starts: DataFrame, archive: str | None = None, live: bool = False) -> DataFrame:
    """(category, page_no, url, html) of all listings of ``starts`` (category, url)."""
    spark.dataSource.register(PagedListing)
    rows = [(r["category"], r["url"]) for r in starts.select("category", "url").collect()]  # the start addresses: a few hundred
    reader = spark.read.format("paged_listing").option("starts", json.dumps(rows)).option("live", str(live).lower())
    return (reader.option("archive", archive) if archive else reader).load()


def existing_pages(pages: DataFrame) -> DataFrame:
    """S3 over stored pages: without every page of a category one of whose pages says it does not exist."""
    missing = pages.filter(F.col("html").contains(NOT_FOUND)).select("category").distinct()
    return pages.join(missing, "category", "left_anti")


def ordered_pages(pages: DataFrame, starts: DataFrame) -> DataFrame:
    """S4 over stored pages without numbers: (category, page_no, url) by following ``next_url`` from the start address
    of each category. The links are doubled in every round, so that as many rounds run as the longest listing's length has binary digits; a
    page that was met before ends its listing."""
    linked = pages.select("category", "url", "next_url").dropDuplicates(["category", "url"])
    here = linked.select("category", F.col("url").alias("next_url"))
    jump = linked.join(here, ["category", "next_url"]).select("category", "url", F.col("next_url").alias("to"))
    first = starts.select("category", "url").distinct().join(linked.select("category", "url"), ["category", "url"])
    return _followed(first, jump, ["category", "url"]).select("category", "page_no", "url")


def _followed(first: DataFrame, jump: DataFrame, keys: list[str]) -> DataFrame:
    """(category, page_no, url) from the first pages (category, url) along the links (``keys``, to)."""
    jump = materialize(jump, "jumps")
    done = materialize(first.select("category", "url", F.lit(1).alias("page_no")), "pages")
    on_to = [k if k != "url" else "to" for k in keys]
    step = 1
    while True:
        ahead = done.join(jump, keys).select("category", F.col("to").alias("url"), (F.col("page_no") + step).alias("page_no"))
        new = materialize(ahead.groupBy("category", "url").agg(F.min("page_no").alias("page_no")).join(done.select("category", "url"), ["category", "url"], "left_anti"), "pages")
        if new.isEmpty():
            return done
        done = materialize(done.unionByName(new), "pages")
        second = jump.select(*[F.col(k).alias(t) for k, t in zip(keys, on_to)], F.col("to").alias("_to"))
        jump = materialize(jump.join(second, on_to).select(*keys, F.col("_to").alias("to")), "jumps")
        step *= 2


def archived_pages(pages: DataFrame, starts: DataFrame) -> DataFrame:
    """S2-S5 over a table of saved pages (url, html): (category, page_no, url, html) of the listings of ``starts`` (category, url). Every page is
    parsed once; a page that says that it does not exist ends its listing."""

    def links(urls: pd.Series, htmls: pd.Series) -> pd.Series:
        return pd.Series([next_page(h, u) if h is not None else None for u, h in zip(urls, htmls)], dtype=object)

    there = pages.filter(F.col("html").isNotNull() & ~F.contains("html", F.lit(NOT_FOUND)))
    linked = materialize(there.select("url", F.pandas_udf(links, "string")("url", "html").alias("next_url")), "links")  # type: ignore[call-overload]
    jump = linked.join(linked.select(F.col("url").alias("next_url")), "next_url").select("url", F.col("next_url").alias("to"))
    first = starts.select("category", "url").distinct().join(linked.select("url"), "url")
    return _followed(first, jump, ["url"]).join(there.dropDuplicates(["url"]), "url").select("category", "page_no", "url", "html")


def with_details(postings: DataFrame, details: DataFrame, url: Column | str = "joburl", base: str | None = None) -> DataFrame:
    """Postings with the page under their address if its status is 200; the others keep a null page."""
    good = details.filter("status = 200").select(F.col("url").alias("_detail"), F.col("html").alias("detail_html")).dropDuplicates(["_detail"])
    key = absolutize(url, base) if base else absolutize(url)
    return postings.withColumn("_detail", key).join(good, "_detail", "left").drop("_detail")


def with_picture(postings: DataFrame, assets: DataFrame, url: str, into: str) -> DataFrame:
    """The bytes under an address (``assets``: path, content as read by ``binaryFile``, path being the address), else null."""
    bytes_ = assets.select(F.col("path").alias("_asset"), F.col("content").alias(into)).dropDuplicates(["_asset"])
    return postings.withColumn("_asset", F.col(url)).join(bytes_, "_asset", "left").drop("_asset")


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None, partitions: int = 16, bounds: tuple[int, int] | None = None, **options: str) -> DataFrame:
    """A table over JDBC, read in ranges of a numeric column if one is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column and bounds:
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(mode).save()
