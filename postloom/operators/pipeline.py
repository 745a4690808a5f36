"""From listing pages to the store: the crawl as one plan.

Pages become records; a record whose address was seen within the last ``capacity`` different addresses is recent and keeps its place and
category but is spared its detail page, description and fallbacks. The others meet their detail page, its main text is ranked for each
language in turn, cut to sentences and freed of repeated lines; missing fields are filled from the text; keywords are scored from the description. The
result is what :meth:`store.Store.apply` takes: the store keeps the content of an address's first record.

Everything is row-local but for the join with the detail pages, the replay of the cache and one shuffle of the descriptions by record for the
keywords.

Defined results: a record without address is dropped; without a detail page (or one whose status is not 200) the description is null and nothing is
filled; a blank description has no keywords; an empty table of pages gives no records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import NOT_BLANK
from postloom.operators import describe as D
from postloom.operators import extract as X
from postloom.operators import keywords as K
from postloom.operators import store as S
from postloom.operators.recent import CAPACITY, lru_hits
from postloom.runtime import materialize
from postloom.sources.listing import with_details, with_picture

CONTENT = ("companyname", "companyurl", "jobtitle", "joblocation", "jobdescription", "published", "bannerpicture", "footerpicture")
ORDER = ("category", "page_no", "position")


def described(records: DataFrame, details: DataFrame, analyzers: Sequence[D.Analyzer] = (D.DEFAULT, D.SECOND), url: str = "joburl") -> DataFrame:
    """``records`` (with ``recent``) with ``jobdescription`` and the missing fields filled."""
    asked = records.withColumn("_url", F.when(~F.col("recent"), F.col(url)))  # a null address meets no page
    paged = with_details(asked, details, "_url")
    text = X.main_blocks(paged, "detail_html", "detail_url")
    text = text.withColumn("_text", F.when(F.col("detail_html").isNotNull(), X.full_text("blocks", "generic", "detail_url")))
    ranked = [D.top_sentences(D.scored_sentences("_text", "category", a)) for a in analyzers]
    ok = F.col("detail_html").isNotNull()

    def first(kind: str) -> list[Column]:
        return [D.first_entity(getattr(a, kind)(F.col("_text"))) for a in analyzers]

    filled = {
        "jobdescription": F.when(ok, D.dedupe_lines(D.description("_text", ranked))),
        "companyname": D.fallback("companyname", *first("organisations"), when=ok), "companyurl": D.fallback("companyurl", D.first_url("_text"), when=ok),
        "joblocation": D.fallback("joblocation", *first("places"), when=ok),
    }
    return text.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in dict.fromkeys([*records.columns, *filled])])


def with_keywords(records: DataFrame, key: str, lists: dict[str, DataFrame], stops: DataFrame, known: DataFrame | None = None, url: str = "joburl") -> DataFrame:
    """``records`` with the array ``keywords`` of (keyword, source, confidence), best first; only those with a description whose address is not
    in ``known`` (K3) have any."""
    texts = records.filter(F.col("jobdescription").rlike(NOT_BLANK)).select(key, url, "jobdescription", "category")
    if known is not None:
        texts = S.unknown(texts, known, url)
    top = K.keywords_of(texts, key, "jobdescription", lists, stops, "category")
    listed = top.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("rank", "keyword", "source", "confidence"))).alias("_k"))  # 20 at most
    keywords = F.transform("_k", lambda k: F.struct(k["keyword"].alias("keyword"), k["source"].alias("source"), k["confidence"].alias("confidence")))
    return records.join(listed.select(key, keywords.alias("keywords")), key, "left")


def crawl(
    pages: DataFrame, details: DataFrame, lists: dict[str, DataFrame], stops: DataFrame, pictures: DataFrame | None = None, known: DataFrame | None = None, capacity: int = CAPACITY,
    analyzers: Sequence[D.Analyzer] = (D.DEFAULT, D.SECOND),
) -> DataFrame:
    """One row per record of ``pages`` (category, page_no, html), ready for the store: the fields of the postings, ``category``, ``page_no``, ``position``, ``recent``
    and ``keywords``. ``pictures``: path, content; ``lists``: the extractors' own stop lists; ``stops``: those applied after them."""
    raw = X.postings_of(pages)
    hits = lru_hits(raw, "joburl", ORDER, capacity).withColumnRenamed("hit", "recent")
    for picked, into in (("banner_url", "bannerpicture"), ("footer_url", "footerpicture")):
        hits = with_picture(hits, pictures, picked, into) if pictures is not None else hits.withColumn(into, F.lit(None).cast("binary"))
    records = materialize(described(hits, details, analyzers), "records")
    return with_keywords(records, "place", lists, stops, known).drop("place", "published_raw", "detail_url", "banner_url", "footer_url")


def crawl_to_store(store: S.Store, records: DataFrame, as_of: Column, batch_id: int | str | None = None) -> None:
    """The records of a crawl into the four tables: first write wins, keywords for new postings only."""
    store.apply(records.withColumn("seen", as_of), batch_id, url="joburl", seen="seen", order=ORDER, content=CONTENT, keywords="keywords")
