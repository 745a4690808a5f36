"""From HTML to records: listing pages (P1-P10) and the main text of detail pages.

HTML is parsed once per page in Arrow batches; everything after it is column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import col
from postloom.operators.urls import absolutize, absolutize_picture, company_url, with_url
from postloom.sources.dom import Node, class_matches, has_class, parse

# Tags of text blocks, site rules in their order, classes of the generic search, phrases of the board's frame.
BLOCKS = ("h1", "h2", "h3", "p", "li", "span")
MIN_BLOCK = 30
RULES: tuple[tuple[str, tuple[dict[str, str], ...]], ...] = (
    ("systematic.com", ({"class": "job"},)),
    ("www.jobindex.dk/jobannonce/", ({"class": "jobtext-jobad__main"}, {"class": "job-text"}, {"class": "jobtext"}, {"class": "jobcontent"}, {"class": "job"})),
    ("candidate.hr-manager.net", ({"class": "AdContentContainer"},)),
    ("myworkdayjobs.com", ({"data-automation-id": "job-posting-details", "class": "css-11p01j8"},)),
    ("jyskebank.dk", ({"class": "umb-richtext"},)),
    ("kirklarsen.dk", ({"class": "js-primary-contents-container"},)),
    ("jobbank.dk", ({"class": "jobText"},)),
    ("oraclecloud.com", ({"class": "job-details__description-content"},)),
)
GENERIC = re.compile(r"job|js-primary-contents-container|AdContentContainer", re.I)
AUTOMATION = re.compile(r"job[-_]posting[-_]details", re.I)
POSTING = re.compile(r"job|posting", re.I)
BOARD = "jobindex.dk"
FRAME = (
    "Søg jobbet nemt fra mobilen Jobannoncearkiv Find inspiration i udløbne jobopslag Få en jobvejleder Bliv afklaret i din jobsøgning Jobs For Ukraine Hjælper ukrainske flygtninge med at få job",
    "Søg job Vælg mellem flere søgekriterier",
    "Din side Skab overblik over din jobsøgning",
    "Jobagent",
    "Få en jobvejleder Bliv afklaret i din jobsøgning",
    "Jobs For Ukraine Hjælper ukrainske flygtninge med at få job",
    "Arbejdspladser Se virksomhedsprofiler Få viden om din næste arbejdsplads Evaluér arbejdsplads",
)

LISTED = "category string, page_no int, position int, title string, href string, company string, company_href string, location string, banner string, footer string, published string"


def text_or_none(n: Node | None) -> str | None:
    return None if n is None else n.text()


def listed(html: str | None, category: str | None) -> list[dict]:
    """The postings of a listing page in document order: every ``div`` whose id begins with ``jobad-wrapper-``."""
    root = parse(html)
    label = root.first("span", has_class("filter-button__label"))
    category = category if label is None else label.text()
    out = []
    for at, div in enumerate(root.all("div", lambda n: n.attrs.get("id", "").startswith("jobad-wrapper-"))):
        head = div.first("h4")
        link = head.first("a") if head else None
        toolbar = div.first("div", has_class("jix-toolbar-top__company"))
        company = toolbar.first("a") if toolbar else None
        area = div.first("div", has_class("jobad-element-area"))
        paid = div.first("div", has_class("PaidJob-inner"))
        centers = list(paid.all("center")) if paid else []
        pictures = [next((i.attrs["src"] for i in c.all("img") if i.attrs.get("src")), None) for c in (centers[:1] + centers[-1:])]
        date = div.first("div", has_class("jix-toolbar__pubdate"))
        time = date.first("time") if date else None
        out.append(
            {
                "category": category, "position": at, "title": text_or_none(link), "href": link.attrs.get("href") if link else None, "company": text_or_none(company),
                "company_href": company.attrs.get("href") if company else None, "location": text_or_none(area.first("span") if area else None),
                "banner": pictures[0] if pictures else None, "footer": pictures[-1] if pictures else None, "published": time.attrs.get("datetime") if time else None,
            }
        )
    return out


def split_listing(pages: DataFrame) -> DataFrame:
    """P1-P3, P5-P8 raw: one row per posting of ``pages`` (category, page_no, html)."""
    columns = [c.split()[0] for c in LISTED.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [r | {"page_no": n} for c, n, h in zip(b["category"], b["page_no"], b["html"]) for r in listed(h, c)]
            yield pd.DataFrame(rows, columns=columns)

    return pages.select("category", "page_no", "html").mapInPandas(run, LISTED)


def postings_of(pages: DataFrame) -> DataFrame:
    """The records of listing pages. A posting without address is dropped, one without company, place or date is kept;
    an unreadable date is null here and reported by :func:`rejected_dates`."""
    raw = split_listing(pages)
    return with_url(raw, "href").select(
        F.col("company").alias("companyname"), company_url("company_href").alias("companyurl"), F.col("title").alias("jobtitle"), F.col("location").alias("joblocation"), F.col("href").alias("joburl"),
        absolutize("href").alias("detail_url"), F.expr("try_cast(published as timestamp_ntz)").alias("published"), F.col("published").alias("published_raw"), "category",
        absolutize_picture("banner").alias("banner_url"), absolutize_picture("footer").alias("footer_url"), "page_no", "position",
    )


def rejected_dates(postings: DataFrame) -> DataFrame:
    """Postings whose date could not be read, with the reason."""
    return postings.filter("published is null and published_raw is not null").withColumn("reason", F.lit("published is no timestamp"))


def blocks(node: Node | None) -> list[str]:
    """Text of the block tags below a node in document order, if longer than 30 characters; nested tags repeat theirs."""
    return [] if node is None else [t for t in (b.text(" ") for b in node.all(BLOCKS)) if len(t) > MIN_BLOCK]


def _selects(selector: dict[str, str]):
    return lambda n: all(has_class(v)(n) if k == "class" else n.attrs.get(k) == v for k, v in selector.items())


def main_text(html: str | None, url: str | None) -> tuple[list[str], bool]:
    """(text blocks, whether the generic search made them)."""
    root = parse(html)
    for part, selectors in RULES:
        if part in (url or ""):
            node = next((n for n in (root.first("div", _selects(s)) for s in selectors) if n is not None), None)
            found = blocks(node)
            if found:
                return found, False
            break
    node = root.first("div", class_matches(GENERIC)) or root.first("div", lambda n: bool(AUTOMATION.search(n.attrs.get("data-automation-id", "")))) or root.first("div", class_matches(POSTING))
    return blocks(node) or blocks(root), True


def main_blocks(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` with ``blocks`` and ``generic``; a null page has no block."""

    def run(htmls: pd.Series, urls: pd.Series) -> pd.DataFrame:
        rows = [main_text(h, u) if h is not None else ([], False) for h, u in zip(htmls, urls)]
        return pd.DataFrame({"blocks": [r[0] for r in rows], "generic": [r[1] for r in rows]})

    udf = F.pandas_udf(run, "struct<blocks:array<string>,generic:boolean>")  # type: ignore[call-overload]
    return pages.withColumn("_main", udf(F.col(html), F.col(url))).withColumns({"blocks": F.col("_main.blocks"), "generic": F.col("_main.generic")}).drop("_main")


def without_phrases(text: Column | str, phrases: tuple[str, ...] = FRAME) -> Column:
    """Literal phrases removed one after the other."""
    out = col(text)
    for p in phrases:
        out = F.replace(out, F.lit(p), F.lit(""))
    return out


def full_text(blocks_: Column | str, generic: Column | str, url: Column | str) -> Column:
    """Blocks joined by new lines; the board's frame is removed where the generic search met a page of the board."""
    joined = F.array_join(col(blocks_), "\n")
    return F.when(col(generic) & col(url).contains(BOARD), without_phrases(joined)).otherwise(joined)
