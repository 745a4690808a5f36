"""Queries of the crawl, text, keyword and store operators over the posting tables, each with its SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions.text import WHITE_RE2, WORD, strip
from postloom.operators import describe as D
from postloom.operators import extract as X
from postloom.operators import keywords as K
from postloom.operators import store as S
from postloom.operators.metrics import with_new_jobs
from postloom.operators.pipeline import crawl, crawl_to_store
from postloom.operators.recent import lru_hits
from postloom.operators.urls import absolutize, first_rule, with_url
from postloom.plans import fixtures
from postloom.runtime import fresh_path, is_small, materialize, table
from postloom.sources import settings
from postloom.sources.listing import archived_pages, existing_pages, ordered_pages, read_listings, with_details

POSTINGS = "jobindexpostingsextended"
#: The site rules in their order; every posting's address is followed by one of them (or none), so that each is met.
RULES = tuple((part, part) for part, _ in X.RULES)
PHRASES = ("Kopiér link · Print denne side", "Print denne side", "Om os", "Om")
STOP_TEXT = "Og, i;\n\nPÅ\n the ; ,and\n  job "
LRU_CAPACITY, STALE_DAYS = 50, 30
ORDER = ("batch", "seq", "seen", "title", "category")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STRIP = lambda c: f"regexp_replace({c}, '^{WHITE_RE2}+|{WHITE_RE2}+$', '', 'g')"
STOPS = sorted({*settings.DANISH, *settings.ENGLISH, *settings.DOMAIN})
STOP_VALUES = "(VALUES " + ", ".join(f"({q(w)})" for w in STOPS) + ") AS stops(w)"


def category_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settings.category_urls(spark)


def stoplist_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settings.stop_list(spark.createDataFrame([(STOP_TEXT,)], "raw string"), "raw")


def url_absolutise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, POSTINGS).select("jobid", absolutize("joburl").alias("url"))


def url_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_url(table(spark, sf_dir, "sightings"), "url").select("batch", "seq", "url")


def rule_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = F.array(*[F.lit(f" {part}x") for part, _ in RULES], F.lit(""))
    url = F.concat(F.coalesce("companyurl", F.lit("")), F.get(sites, (F.col("jobid") % (len(RULES) + 1)).cast("int")))
    return table(spark, sf_dir, POSTINGS).select("jobid", first_rule(url, RULES, "generic").alias("rule"))


def boilerplate_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, POSTINGS).select("jobid", X.without_phrases("jobdescription", PHRASES).alias("text"))


def escaped(c: Column | str) -> Column:
    out = F.col(c) if isinstance(c, str) else c
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def as_page(text: Column | str) -> Column:
    """A text as a page whose paragraphs are its lines."""
    return F.concat(F.lit("<p>"), F.replace(escaped(text), F.lit("\n"), F.lit("</p><p>")), F.lit("</p>"))


def text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The descriptions as pages, parsed again."""
    pages = table(spark, sf_dir, POSTINGS).select("jobid", as_page("jobdescription").alias("html"), F.lit("").alias("url"))
    return X.main_blocks(pages).select("jobid", F.when(F.col("html").isNotNull(), F.array_join("blocks", "\n")).alias("full_text"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, POSTINGS).select("jobid", D.dedupe_lines("jobdescription").alias("text"))


def _categorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings with the first of their categories by name."""
    names = table(spark, sf_dir, "jobcategories").join(F.broadcast(table(spark, sf_dir, "categories")), "categoryid")  # 249 fixed rows
    first = names.groupBy("jobid").agg(F.min("name").alias("category"))
    return table(spark, sf_dir, POSTINGS).select("jobid", "jobdescription").filter("jobdescription is not null").join(first, "jobid", "left")


def sentence_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _categorised(spark, sf_dir).select("jobid", F.explode(D.scored_sentences("jobdescription", "category")).alias("s"))
    return scored.select("jobid", F.col("s.score").cast("bigint").alias("score"), F.col("s.text").alias("text"))


def description_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = _categorised(spark, sf_dir).withColumn("top", D.top_sentences(D.scored_sentences("jobdescription", "category")))
    return top.select("jobid", D.description("jobdescription", [F.col("top")]).alias("description"))


def description_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 with a ranking for each of two analyzers; texts of very short sentences take the second one."""
    text = F.replace("jobdescription", F.lit(" "), F.lit(". "))
    cut = _categorised(spark, sf_dir).withColumn("jobdescription", F.when(F.col("jobid") % 2 == 0, text).otherwise(F.col("jobdescription")))
    ranked = [D.top_sentences(D.scored_sentences("jobdescription", "category", a)) for a in (D.DEFAULT, D.SECOND)]
    return cut.select("jobid", D.description("jobdescription", ranked).alias("description"))


def url_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws(" ", "joburl", "jobdescription")
    return table(spark, sf_dir, POSTINGS).select("jobid", D.fallback("companyurl", D.first_url(text, ("nordstilling", "hirehub"))).alias("companyurl"))


def missing_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    orgs, places = D.DEFAULT.organisations(F.col("jobdescription")), D.DEFAULT.places(F.col("jobdescription"))
    return table(spark, sf_dir, POSTINGS).select(
        "jobid", D.fallback("companyname", D.first_entity(orgs), when=F.col("isactive")).alias("companyname"), D.fallback("joblocation", D.first_entity(places), when=F.col("isactive")).alias("joblocation")
    )


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words are counted first, so that each different one is tested once."""
    words = table(spark, sf_dir, POSTINGS).select(F.explode(F.regexp_extract_all(F.lower("jobdescription"), F.lit(f"{WORD}+"), F.lit(0))).alias("term"))
    return K.valid(words.groupBy("term").agg(F.count(F.lit(1)).alias("n")), settings.stop_words(spark), "term")


def keyword_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, POSTINGS).select("jobid", "jobdescription").filter("jobdescription is not null")
    scored = K.yake_scores(texts, "jobid", "jobdescription", {"yake": settings.stop_words(spark)})
    return scored.select("jobid", "term", F.round("score", 6).alias("score"), F.round(K.confidence("score"), 6).alias("confidence"))


def keywords_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2-K8 from the texts of the postings: two extractors, filters, dedup, top 20."""
    texts = _categorised(spark, sf_dir)
    stops = settings.stop_words(spark)
    own = {"yake-da": settings.DANISH, "yake-en": settings.ENGLISH}
    lists = {s: spark.createDataFrame([(w,) for w in words], "word string") for s, words in own.items()}
    return K.keywords_of(texts, "jobid", "jobdescription", lists, stops, "category").select("jobid", F.col("rank").cast("bigint").alias("rank"), "keyword", "source", "confidence")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "jobkeywords").select("jobid", "keyword", "source", F.col("confidencescore").alias("conf"), F.col("keywordid").alias("idx"))


def keyword_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "jobkeywords").select("keywordid", F.round(K.confidence(F.col("confidencescore") * 3 - 1), 6).alias("confidence"))


def keyword_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.valid(_candidates(spark, sf_dir), settings.stop_words(spark)).select("idx", "keyword")


def _deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.best_per_key(K.valid(_candidates(spark, sf_dir), settings.stop_words(spark)), "jobid", "keyword", "conf", "idx")


def keyword_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deduped(spark, sf_dir).select("jobid", "keyword", "source", "conf", "first_at")


def _top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.top_keywords(_deduped(spark, sf_dir), "jobid", "conf")


def keyword_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: filters, dedup, order and the best 20 keywords of every posting."""
    return _top(spark, sf_dir).select("jobid", F.col("rank").cast("bigint").alias("rank"), "keyword", "source", "conf")


def keyword_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.display(_top(spark, sf_dir), "jobid", "keyword").select("jobid", "display")


def keyword_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    detailed = _top(spark, sf_dir).groupBy("jobid").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("keyword").alias("keyword"), F.col("source").alias("source"), F.col("conf").alias("confidence")))).alias("kws"))  # 20 at most
    new = S.unknown(table(spark, sf_dir, POSTINGS), table(spark, sf_dir, "sightings").withColumnRenamed("url", "joburl"), "joburl").select("jobid")
    return K.keyword_rows(detailed.join(new, "jobid", "left_semi"), "jobid", "kws")


def legacy_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.legacy_rows(keyword_display(spark, sf_dir), "jobid", "display")


def existing_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.existing(table(spark, sf_dir, "sightings"), table(spark, sf_dir, POSTINGS)).select("batch", "seq", "url")


def existing_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.unknown(table(spark, sf_dir, "sightings"), table(spark, sf_dir, POSTINGS)).select("batch", "seq", "url")


def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings with what was fetched under their address; failures keep the row."""
    fetched = table(spark, sf_dir, POSTINGS).select(absolutize("joburl").alias("url"), F.when(F.col("isactive"), 200).otherwise(404).alias("status"), F.col("jobtitle").alias("html"))
    return with_details(table(spark, sf_dir, POSTINGS).select("jobid", "joburl"), fetched).select("jobid", F.col("detail_html").alias("detail"))


def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.with_posting_id(table(spark, sf_dir, "sightings"), table(spark, sf_dir, POSTINGS)).select("batch", "seq", "jobid")


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "sightings").select("url", S.category_name(F.col("category")).alias("name")).filter("name is not null").distinct()


def category_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.get_or_create(table(spark, sf_dir, "categories"), _names(spark, sf_dir))


def posting_category_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = materialize(category_dim(spark, sf_dir), "categories")
    pairs = S.with_posting_id(_names(spark, sf_dir), table(spark, sf_dir, POSTINGS)).join(F.broadcast(dim) if is_small(dim) else dim, "name")
    return S.link(table(spark, sf_dir, "jobcategories"), pairs)


def _incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.first_and_last(table(spark, sf_dir, "sightings"), "url", "seen", ORDER, ["title"])


def upsert_first_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incoming(spark, sf_dir).select("joburl", "title", F.col("_seen").alias("seenlast"))


def seen_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.first_and_last(table(spark, sf_dir, "sightings"), "url", "seen", ORDER, []).select(F.col("joburl").alias("url"), F.col("_seen").alias("seenlast"))


def upsert_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = materialize(_incoming(spark, sf_dir).withColumnRenamed("title", "jobtitle"), "incoming")
    return S.upsert(table(spark, sf_dir, POSTINGS), incoming, ORDER).select("jobid", "joburl", "jobtitle", "seenlast", "isactive")


def soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = table(spark, sf_dir, POSTINGS)
    as_of = F.lit(postings.agg(F.max("seenlast")).first()[0])
    return S.expire(postings, as_of, STALE_DAYS).select("jobid", "isactive", "changed")


def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, POSTINGS).select(F.col("jobid").alias("JobID"), F.col("joburl").alias("JobUrl"), F.when(F.col("isactive"), F.col("isactive")).alias("IsActive"))
    return S.evolve(old).select("jobid", "joburl", "seenlast", "joblocation", "isactive")


def new_job_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = with_new_jobs(with_url(table(spark, sf_dir, "sightings"), "url").select("url", "category").distinct(), table(spark, sf_dir, POSTINGS))
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n_jobs"), F.count(F.when(F.col("is_new"), 1)).alias("n_new"))


def lru_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = lru_hits(with_url(table(spark, sf_dir, "sightings"), "url"), "url", ORDER, LRU_CAPACITY)
    return hits.select("batch", "seq", "url", "hit")


def star_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords are counted per posting before they meet the bridge, so the star never multiplies rows."""
    counts = table(spark, sf_dir, "jobkeywords").groupBy("jobid").agg(F.count(F.lit(1)).alias("k"))
    linked = table(spark, sf_dir, "jobcategories").join(table(spark, sf_dir, POSTINGS).select("jobid"), "jobid", "left_semi").join(counts, "jobid", "left")
    per = linked.groupBy("categoryid").agg(F.count(F.lit(1)).alias("n_postings"), F.coalesce(F.sum("k"), F.lit(0)).alias("n_keywords"))
    return per.join(F.broadcast(table(spark, sf_dir, "categories")), "categoryid").select("name", "n_postings", "n_keywords")  # 249 fixed rows


def html_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.createDataFrame(fixtures.LISTING_PAGES, "category string, page_no int, url string, html string")
    return X.postings_of(pages).select("category", "page_no", "jobtitle", "joburl", "companyname", "companyurl", "joblocation", "banner_url", "footer_url", "published")


def html_main_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = X.main_blocks(spark.createDataFrame(fixtures.DETAIL_PAGES, "url string, status int, html string").filter("status = 200"))
    return pages.select("url", X.full_text("blocks", "generic", "url").alias("full_text"))


def paged_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved pages of two categories through the data source, following the next links."""
    archive = fresh_path(spark, "archive")
    spark.createDataFrame([(json.dumps({"url": u, "html": h}),) for u, h in fixtures.SAVED_PAGES], "line string").coalesce(1).write.text(archive)
    starts = spark.createDataFrame(fixtures.STARTS, "category string, url string")
    pages = existing_pages(read_listings(spark, starts, archive=archive))
    return pages.select("category", "page_no", "url")


def page_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 over stored pages: the same order by joins."""
    pages = spark.createDataFrame(fixtures.LINKED_PAGES, "category string, url string, next_url string")
    return ordered_pages(pages, spark.createDataFrame(fixtures.STARTS, "category string, url string"))


def archived_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2-S5 over a table of saved pages: parsed once, followed by joins."""
    pages = spark.createDataFrame(fixtures.SAVED_PAGES, "url string, html string")
    return archived_pages(pages, spark.createDataFrame(fixtures.STARTS, "category string, url string")).select("category", "page_no", "url")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sightings as a stream of files into a store that is empty at first."""
    from postloom.streaming.sightings import read_records, store_stream

    folder = fresh_path(spark, "stream-in")
    table(spark, sf_dir, "sightings").repartition(6, "batch").write.parquet(folder)
    store = S.Store(spark, fresh_path(spark, "store"))
    store_stream(read_records(spark, folder, 2), store, fresh_path(spark, "stream-state"))
    links = store.read("posting_categories").groupBy("jobid").agg(F.count(F.lit(1)).alias("n"))
    return store.read("postings").join(links, "jobid", "left").select("joburl", "seenlast", "isactive", F.coalesce("n", F.lit(0)).alias("n_categories"))


def listed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every posting listed under each of its categories, as HTML pages of at most 400 ids."""
    names = table(spark, sf_dir, "jobcategories").join(F.broadcast(table(spark, sf_dir, "categories")), "categoryid").select("jobid", F.col("name").alias("category"))  # 249 fixed rows
    rows = table(spark, sf_dir, POSTINGS).join(names, "jobid", "left").withColumn("category", F.coalesce("category", F.lit("")))
    company = F.concat(F.lit('<div class="jix-toolbar-top__company"><a href="/virksomhed/'), "jobid", F.lit('">'), escaped("companyname"), F.lit("</a></div>"))
    place = F.concat(F.lit('<div class="jobad-element-area"><span>'), escaped("joblocation"), F.lit("</span></div>"))
    block = F.concat(F.lit('<div id="jobad-wrapper-'), "jobid", F.lit('"><h4><a href="'), escaped("joburl"), F.lit('">'), escaped(F.coalesce("jobtitle", F.lit(""))), F.lit("</a></h4>"), F.coalesce(company, F.lit("")), F.coalesce(place, F.lit("")), F.lit("</div>"))
    pages = rows.filter("joburl is not null").groupBy("category", F.floor(F.col("jobid") / 400).cast("int").alias("page_no")).agg(F.array_sort(F.collect_list(F.struct("jobid", block.alias("block")))).alias("b"))
    label = F.concat(F.lit('<span class="filter-button__label">'), escaped("category"), F.lit("</span>"))
    return pages.select("category", "page_no", F.concat(label, F.array_join(F.transform("b", lambda x: x["block"]), "")).alias("html"))


def crawl_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole crawl: listing pages and detail pages made from the postings, through records, cache, main text, two rankings, fallbacks and keywords
    into an empty store; what its four tables hold then."""
    details = table(spark, sf_dir, POSTINGS).select(absolutize("joburl").alias("url"), F.when(F.col("isactive"), 200).otherwise(404).alias("status"), as_page(F.coalesce("jobdescription", F.lit(""))).alias("html"))
    own = {"yake-da": settings.DANISH, "yake-en": settings.ENGLISH}
    lists = {n: spark.createDataFrame([(w,) for w in words], "word string") for n, words in own.items()}
    records = crawl(listed_pages(spark, sf_dir), details, lists, settings.stop_words(spark), capacity=LRU_CAPACITY)
    store = S.Store(spark, fresh_path(spark, "store"))
    crawl_to_store(store, materialize(records, "crawled"), F.lit("2025-01-01").cast("timestamp_ntz"), "crawl-1")
    links = store.read("posting_categories").groupBy("jobid").agg(F.count(F.lit(1)).alias("n_categories"))
    words = store.read("posting_keywords").groupBy("jobid").agg(F.count(F.lit(1)).alias("n_keywords"), F.round(F.max("confidencescore"), 6).alias("best"))
    held = store.read("postings").join(links, "jobid", "left").join(words, "jobid", "left").fillna(0, ["n_categories", "n_keywords"])
    return held.select("joburl", "jobtitle", "companyname", "companyurl", "joblocation", "jobdescription", "isactive", "n_categories", "n_keywords", "best")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        category_urls, stoplist_parse, url_absolutise, url_present, rule_dispatch, boilerplate_strip, text_blocks, line_dedup, sentence_scores, description_topk, description_two, url_fallback, missing_fill, token_counts, keyword_score,
        keywords_of_text, keyword_confidence, keyword_valid, keyword_dedup, keyword_top20, keyword_display, keyword_rows, legacy_split, existing_semi, existing_anti, enrich_left, key_lookup, category_dim,
        posting_category_bridge, upsert_first_write, seen_last, upsert_merged, soft_delete, schema_evolve, new_job_count, lru_recent, star_rollup, html_postings, html_main_content, paged_listing, archived_listing, page_chain, stream_upsert, crawl_stored,
    )
}

P = POSTINGS
ABS = lambda c: f"CASE WHEN {c} LIKE '/%' THEN '{settings.BASE_URL}' || {c} WHEN {c} LIKE 'http%' THEN {c} ELSE '{settings.BASE_URL}/' || ltrim({c}, '/') END"
LINES_RE = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
CAT = f"cat AS (SELECT jobid, min(name) AS category FROM jobcategories JOIN categories USING (categoryid) GROUP BY jobid), p AS (SELECT p.jobid, jobdescription, category FROM {P} p LEFT JOIN cat USING (jobid) WHERE jobdescription IS NOT NULL)"


def sentences_sql(source: str, pattern: str, out: str, entity: str = D.DEFAULT.entity) -> str:
    """The scored sentences ``out`` of the texts of ``source`` (jobid, jobdescription, category), and their ranking ``out``_g."""
    score = f"CAST(CASE WHEN coalesce(category, '') <> '' AND contains(lower(text), lower(category)) THEN 1 ELSE 0 END + length(text) // 100 + len(regexp_extract_all(text, '{entity}')) AS BIGINT)"
    return (
        f"{out}_s AS (SELECT jobid, category, unnest(regexp_extract_all(jobdescription, '{pattern}')) AS text FROM {source}), {out} AS (SELECT jobid, text, {score} AS score FROM {out}_s WHERE length({STRIP('text')}) >= 20), "
        f"{out}_r AS (SELECT jobid, text, row_number() OVER (PARTITION BY jobid ORDER BY score DESC, text DESC) AS k, score FROM {out}), "
        f"{out}_g AS (SELECT jobid, string_agg(text, chr(10) ORDER BY k) AS t, sum(length(text)) AS n FROM {out}_r WHERE k <= 20 GROUP BY jobid)"
    )


TWO = f"CASE WHEN a.n >= 60 THEN {STRIP('a.t')} WHEN b.n >= 60 THEN {STRIP('b.t')} ELSE substring(jobdescription, 1, 1500) END"
FIRST_PATTERN, SECOND_PATTERN = D.DEFAULT.sentence.replace("\n", "\\n"), D.SECOND.sentence.replace("\n", "\\n")
SENT = (
    f"WITH {CAT}, s AS (SELECT jobid, category, jobdescription, unnest(regexp_extract_all(jobdescription, '[^.!?\\n]+[.!?]*')) AS text FROM p), "
    f"sc AS (SELECT jobid, text, CAST(CASE WHEN coalesce(category, '') <> '' AND contains(lower(text), lower(category)) THEN 1 ELSE 0 END + length(text) // 100 + "
    f"len(regexp_extract_all(text, '{D.DEFAULT.entity}')) AS BIGINT) AS score FROM s WHERE length({STRIP('text')}) >= 20)"
)
VALID = (
    f"c AS (SELECT jobid, keywordid AS idx, {STRIP('keyword')} AS keyword, source, confidencescore AS conf FROM jobkeywords), "
    f"s AS (SELECT list(w) AS ws FROM {STOP_VALUES}), "
    f"v AS (SELECT c.* FROM c, s WHERE length(keyword) > 1 AND NOT list_contains(ws, lower(keyword)) AND NOT (len(regexp_extract_all(lower(keyword), '{WORD}+')) > 0 "
    f"AND len(list_filter(regexp_extract_all(lower(keyword), '{WORD}+'), lambda x: NOT list_contains(ws, x))) = 0)), "
    "d AS (SELECT *, min(idx) OVER (PARTITION BY jobid, lower(keyword)) AS first_at, row_number() OVER (PARTITION BY jobid, lower(keyword) ORDER BY coalesce(conf, 0) DESC, idx) AS r FROM v), "
    "b AS (SELECT jobid, keyword, source, conf, first_at, row_number() OVER (PARTITION BY jobid ORDER BY coalesce(conf, -1) DESC, first_at) AS rank FROM d WHERE r = 1), "
    "t AS (SELECT * FROM b WHERE rank <= 20)"
)
DISPLAY = f"WITH {VALID}, o AS (SELECT jobid, string_agg(keyword, ', ' ORDER BY rank) AS display FROM t GROUP BY jobid)"
FIRST = (
    "f AS (SELECT url AS joburl, title, batch, seq, seen, category, row_number() OVER (PARTITION BY url ORDER BY batch NULLS FIRST, seq NULLS FIRST, seen NULLS FIRST, title NULLS FIRST, category NULLS FIRST) AS r, "
    "max(seen) OVER (PARTITION BY url) AS seenlast FROM sightings WHERE url <> '')"
)
NAMES = "n AS (SELECT DISTINCT url, category AS name FROM sightings WHERE coalesce(category, '') <> ''), new AS (SELECT DISTINCT name FROM n WHERE name NOT IN (SELECT name FROM categories)), dim AS (SELECT categoryid, name FROM categories UNION ALL SELECT (SELECT max(categoryid) FROM categories) + row_number() OVER (ORDER BY name), name FROM new)"
TOKEN_RE = K.TOKEN.replace("'", "''")


def yake_sql(source: str, stops: list[str], out: str) -> str:
    """Scores ``out`` (jobid, term, keyword, score) of the one-word candidates of ``source`` (jobid, jobdescription)."""
    stop_values = "(VALUES " + ", ".join(f"({q(w)})" for w in stops) + ") AS stops(w)"
    p = out + "_"
    return f"""{p}s0 AS (SELECT jobid, regexp_extract_all(jobdescription, '[^.!?\\n]+') AS ss FROM {source} WHERE jobdescription IS NOT NULL),
{p}s AS (SELECT jobid, unnest(ss) AS txt, unnest(range(len(ss))) AS sentence FROM {p}s0),
{p}w0 AS (SELECT jobid, sentence, regexp_extract_all(txt, '{TOKEN_RE}') AS ws FROM {p}s),
{p}w AS (SELECT jobid, sentence, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM {p}w0),
{p}n AS (SELECT *, lower(word) AS term, lag(lower(word)) OVER o AS l, lead(lower(word)) OVER o AS r FROM {p}w WINDOW o AS (PARTITION BY jobid, sentence ORDER BY pos)),
{p}a AS (SELECT jobid, term, count(*) AS tf, sum(CASE WHEN regexp_matches(word, '^\\p{{Lu}}') AND pos > 0 THEN 1 ELSE 0 END) AS up, sum(CASE WHEN regexp_matches(word, '^\\p{{Lu}}{{2,}}$') THEN 1 ELSE 0 END) AS ac,
  median(sentence) AS mid, count(DISTINCT sentence) AS sf, count(DISTINCT l) AS dl, count(l) AS nl, count(DISTINCT r) AS dr, count(r) AS nr, max(sentence) AS ls, arg_min(word, sentence * 100000 + pos) AS keyword FROM {p}n GROUP BY jobid, term),
{p}g AS (SELECT *, term NOT IN (SELECT w FROM {stop_values}) AND length(term) > 1 AND NOT regexp_matches(term, '^[\\p{{N}}_\\-]+$') AS good FROM {p}a),
{p}h AS (SELECT *, avg(CASE WHEN good THEN tf END) OVER p AS mean_tf, coalesce(stddev_pop(CASE WHEN good THEN tf END) OVER p, 0) AS sd_tf, max(tf) OVER p AS max_tf, max(ls) OVER p + 1 AS ns FROM {p}g WINDOW p AS (PARTITION BY jobid)),
{p}k AS (SELECT *, 1 + (CASE WHEN nl > 0 THEN dl / nl ELSE 0 END + CASE WHEN nr > 0 THEN dr / nr ELSE 0 END) * tf / max_tf AS rel FROM {p}h WHERE good),
{p}z AS (SELECT *, rel * ln(ln(3 + mid)) / (greatest(up, ac) / (1 + ln(tf)) + tf / (mean_tf + sd_tf) / rel + sf / ns / rel) AS s FROM {p}k),
{out} AS (SELECT jobid, term, keyword, s / (tf * (1 + s)) AS score FROM {p}z)"""


YAKE = f"WITH {yake_sql(P, STOPS, 'y')} SELECT jobid, term, round(score, 6) AS score, round(greatest(0, least(1, 1 - score)), 6) AS confidence FROM y"


def keywords_sql(source: str, out: str) -> str:
    """The best 20 keywords ``out`` (jobid, rank, keyword, source, conf) of ``source`` (jobid, jobdescription, category): K2-K8."""
    p = out + "_"
    words = f"regexp_extract_all(lower(keyword), '{WORD}+')"
    ranked = ", ".join(
        f"{p}{n}r AS (SELECT jobid, keyword, score, {q(n)} AS source, {k * K.TOP} + row_number() OVER (PARTITION BY jobid ORDER BY round(score, 9), term) AS idx, row_number() OVER (PARTITION BY jobid ORDER BY round(score, 9), term) AS nth FROM {p}{n})".replace(f"{p}{n}", f"{p}{n[-2:]}")
        for k, n in enumerate(K.YAKE_SOURCES)
    )
    return f"""{yake_sql(source, settings.DANISH, p + 'da')}, {yake_sql(source, settings.ENGLISH, p + 'en')}, {ranked},
{p}c AS (SELECT * FROM {p}dar WHERE nth <= {K.TOP} UNION ALL SELECT * FROM {p}enr WHERE nth <= {K.TOP}), {p}st AS (SELECT list(w) AS ws FROM {STOP_VALUES}),
{p}v AS (SELECT c.jobid, c.keyword, c.source, c.idx, round(greatest(0, least(1, 1 - score)), 9) AS conf FROM {p}c c JOIN {source} t ON t.jobid = c.jobid, {p}st WHERE length(keyword) > 1 AND NOT coalesce(lower(keyword) = lower(category), false)
  AND NOT list_contains(ws, lower(keyword)) AND NOT (len({words}) > 0 AND len(list_filter({words}, lambda x: NOT list_contains(ws, x))) = 0)),
{p}d AS (SELECT *, min(idx) OVER (PARTITION BY jobid, lower(keyword)) AS first_at, row_number() OVER (PARTITION BY jobid, lower(keyword) ORDER BY conf DESC, idx) AS r FROM {p}v),
{p}b AS (SELECT jobid, keyword, source, conf, row_number() OVER (PARTITION BY jobid ORDER BY conf DESC, first_at) AS rank FROM {p}d WHERE r = 1),
{out} AS (SELECT * FROM {p}b WHERE rank <= {K.TOP})"""


def _values(rows: list[tuple], columns: str) -> str:
    lit = lambda v: "NULL" if v is None else q(v) if isinstance(v, str) else str(v)
    return f"(VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS t({columns})"


def _framed(c: str) -> str:
    for phrase in X.FRAME:
        c = f"replace({c}, {q(phrase)}, '')"
    return c


def _replaced(c: str) -> str:
    for p in PHRASES:
        c = f"replace({c}, {q(p)}, '')"
    return c


SQL: dict[str, str] = {
    "category_urls": f"SELECT 'subid_' || i AS category, '{settings.SEARCH_URL}' || i AS url FROM range(1, 250) AS t(i)",
    "stoplist_parse": f"SELECT DISTINCT lower({STRIP('x')}) AS word FROM (SELECT unnest(regexp_split_to_array({q(STOP_TEXT)}, '[\\n,;]+')) AS x) WHERE {STRIP('x')} <> ''",
    "url_absolutise": f"SELECT jobid, {ABS('joburl')} AS url FROM {P}",
    "url_present": "SELECT batch, seq, url FROM sightings WHERE coalesce(url, '') <> ''",
    "rule_dispatch": f"SELECT jobid, CASE {' '.join(f'WHEN contains(u, {q(t)}) THEN {q(n)}' for t, n in RULES)} ELSE 'generic' END AS rule FROM (SELECT jobid, coalesce(companyurl, '') || [{', '.join(q(f' {t}x') for t, _ in RULES)}, ''][jobid % {len(RULES) + 1} + 1] AS u FROM {P})",
    "boilerplate_strip": f"SELECT jobid, {_replaced('jobdescription')} AS text FROM {P}",
    "text_blocks": f"SELECT jobid, array_to_string(list_filter(list_transform(string_split(jobdescription, chr(10)), lambda x: {STRIP('x')}), lambda x: length(x) > 30), chr(10)) AS full_text FROM {P}",
    "line_dedup": f"""WITH l AS (SELECT jobid, unnest(x) AS line, unnest(range(len(x))) AS i FROM (SELECT jobid, regexp_split_to_array(jobdescription, '{LINES_RE}') AS x FROM {P} WHERE jobdescription IS NOT NULL)),
f AS (SELECT jobid, {STRIP('line')} AS s, min(i) AS i FROM l WHERE {STRIP('line')} <> '' GROUP BY 1, 2), g AS (SELECT jobid, string_agg(s, chr(10) ORDER BY i) AS text FROM f GROUP BY jobid)
SELECT p.jobid, CASE WHEN jobdescription = '' THEN '' ELSE g.text END AS text FROM {P} p LEFT JOIN g USING (jobid)""",
    "sentence_scores": SENT + " SELECT jobid, score, text FROM sc",
    "description_topk": SENT
    + f""", r AS (SELECT jobid, score, text, row_number() OVER (PARTITION BY jobid ORDER BY score DESC, text DESC) AS k FROM sc), g AS (SELECT jobid, string_agg(text, chr(10) ORDER BY k) AS t, sum(length(text)) AS n FROM r WHERE k <= 20 GROUP BY jobid)
SELECT p.jobid, CASE WHEN n >= 60 THEN {STRIP('t')} ELSE substring(jobdescription, 1, 1500) END AS description FROM p LEFT JOIN g USING (jobid)""",
    "description_two": f"""WITH {CAT}, t AS (SELECT jobid, category, CASE WHEN jobid % 2 = 0 THEN replace(jobdescription, ' ', '. ') ELSE jobdescription END AS jobdescription FROM p), {sentences_sql('t', FIRST_PATTERN, 'x')}, {sentences_sql('t', SECOND_PATTERN, 'y')}
SELECT t.jobid, {TWO} AS description FROM t LEFT JOIN x_g a ON a.jobid = t.jobid LEFT JOIN y_g b ON b.jobid = t.jobid""",
    "url_fallback": f"""SELECT jobid, CASE WHEN companyurl IS NULL OR {STRIP('companyurl')} = '' THEN coalesce(list_filter(regexp_extract_all(concat_ws(' ', joburl, jobdescription), '{D.URL}'), lambda u: NOT contains(u, 'nordstilling') AND NOT contains(u, 'hirehub'))[1], companyurl)
ELSE companyurl END AS companyurl FROM {P}""",
    "missing_fill": f"""SELECT jobid, CASE WHEN isactive AND (companyname IS NULL OR {STRIP('companyname')} = '') THEN coalesce(regexp_extract_all(jobdescription, '{D.DEFAULT.organisation}')[1], companyname) ELSE companyname END AS companyname,
CASE WHEN isactive AND (joblocation IS NULL OR {STRIP('joblocation')} = '') THEN coalesce(regexp_extract_all(jobdescription, '{D.DEFAULT.place}', 1)[1], joblocation) ELSE joblocation END AS joblocation FROM {P}""",
    "token_counts": f"WITH t AS (SELECT unnest(regexp_extract_all(lower(jobdescription), '{WORD}+')) AS term FROM {P}) SELECT term, count(*) AS n FROM t WHERE length(term) > 1 AND term NOT IN (SELECT w FROM {STOP_VALUES}) GROUP BY term",
    "keyword_score": YAKE,
    "keywords_of_text": f"WITH {CAT}, {keywords_sql('p', 'o')} SELECT jobid, rank, keyword, source, round(conf, 6) AS confidence FROM o",
    "keyword_confidence": "SELECT keywordid, CASE WHEN confidencescore IS NOT NULL THEN round(greatest(0, least(1, 1 - (confidencescore * 3 - 1))), 6) END AS confidence FROM jobkeywords",
    "keyword_valid": f"WITH {VALID} SELECT idx, keyword FROM v",
    "keyword_dedup": f"WITH {VALID} SELECT jobid, keyword, source, conf, first_at FROM b",
    "keyword_top20": f"WITH {VALID} SELECT jobid, rank, keyword, source, conf FROM t",
    "keyword_display": DISPLAY + " SELECT jobid, display FROM o",
    "keyword_rows": f"WITH {VALID} SELECT jobid, keyword, source, conf AS confidencescore FROM t WHERE jobid IN (SELECT jobid FROM {P} WHERE joburl NOT IN (SELECT url FROM sightings WHERE url IS NOT NULL))",
    "legacy_split": DISPLAY + ", x AS (SELECT jobid, trim(unnest(string_split(display, ','))) AS keyword FROM o) SELECT jobid, keyword, 'legacy' AS source, CAST(NULL AS DOUBLE) AS confidencescore FROM x WHERE keyword <> ''",
    "existing_semi": f"SELECT batch, seq, url FROM sightings WHERE url IN (SELECT joburl FROM {P})",
    "existing_anti": f"SELECT batch, seq, url FROM sightings s WHERE NOT EXISTS (SELECT 1 FROM {P} p WHERE p.joburl = s.url)",
    "enrich_left": f"SELECT jobid, CASE WHEN isactive THEN jobtitle END AS detail FROM {P}",
    "key_lookup": f"SELECT batch, seq, jobid FROM sightings JOIN {P} ON joburl = url",
    "category_dim": f"WITH {NAMES} SELECT categoryid, name FROM dim",
    "posting_category_bridge": f"WITH {NAMES} SELECT jobid, categoryid FROM jobcategories UNION SELECT jobid, categoryid FROM n JOIN {P} ON joburl = url JOIN dim USING (name)",
    "upsert_first_write": f"WITH {FIRST} SELECT joburl, title, seenlast FROM f WHERE r = 1",
    "seen_last": "SELECT url, max(seen) AS seenlast FROM sightings WHERE url <> '' GROUP BY url",
    "upsert_merged": f"""WITH {FIRST}, i AS (SELECT * FROM f WHERE r = 1), new AS (SELECT (SELECT max(jobid) FROM {P}) + row_number() OVER (ORDER BY batch NULLS FIRST, seq NULLS FIRST, seen NULLS FIRST, title NULLS FIRST, category NULLS FIRST, joburl) AS jobid, joburl, title, seenlast
FROM i WHERE joburl NOT IN (SELECT joburl FROM {P}))
SELECT p.jobid, p.joburl, jobtitle, greatest(i.seenlast, p.seenlast) AS seenlast, i.joburl IS NOT NULL OR coalesce(isactive, true) AS isactive FROM {P} p LEFT JOIN i ON i.joburl = p.joburl
UNION ALL SELECT jobid, joburl, title, seenlast, true FROM new""",
    "soft_delete": f"""WITH m AS (SELECT max(seenlast) AS m FROM {P}), c AS (SELECT jobid, isactive, coalesce(isactive AND seenlast < m - INTERVAL {STALE_DAYS} DAY, false) AS changed FROM {P}, m)
SELECT jobid, isactive AND NOT changed AS isactive, changed FROM c""",
    "schema_evolve": f"SELECT jobid, joburl, CAST(NULL AS TIMESTAMP) AS seenlast, CAST(NULL AS VARCHAR) AS joblocation, true AS isactive FROM {P}",
    "new_job_count": f"SELECT category, count(*) AS n_jobs, count(*) FILTER (WHERE url NOT IN (SELECT joburl FROM {P})) AS n_new FROM (SELECT DISTINCT url, category FROM sightings WHERE coalesce(url, '') <> '') GROUP BY category",
    "lru_recent": f"""WITH a AS (SELECT batch, seq, url, row_number() OVER (ORDER BY batch NULLS FIRST, seq NULLS FIRST, seen NULLS FIRST, title NULLS FIRST, category NULLS FIRST, url) AS i FROM sightings WHERE url <> ''),
p AS (SELECT *, lag(i) OVER (PARTITION BY url ORDER BY i) AS prev FROM a),
n AS (SELECT x.i, count(*) AS n FROM p x JOIN p y ON y.i > x.prev AND y.i < x.i AND coalesce(y.prev, 0) <= x.prev GROUP BY x.i)
SELECT batch, seq, url, prev IS NOT NULL AND coalesce(n, 0) < {LRU_CAPACITY} AS hit FROM p LEFT JOIN n USING (i)""",
    "star_rollup": f"""WITH k AS (SELECT jobid, count(*) AS k FROM jobkeywords GROUP BY jobid)
SELECT name, count(*) AS n_postings, CAST(coalesce(sum(k), 0) AS BIGINT) AS n_keywords FROM jobcategories JOIN categories USING (categoryid) LEFT JOIN k USING (jobid) WHERE jobid IN (SELECT jobid FROM {P}) GROUP BY name""",
    "html_postings": "SELECT category, page_no, jobtitle, joburl, companyname, companyurl, joblocation, banner_url, footer_url, CAST(published AS TIMESTAMP) AS published FROM "
    + _values(fixtures.LISTED, "category, page_no, jobtitle, joburl, companyname, companyurl, joblocation, banner_url, footer_url, published"),
    "html_main_content": "SELECT url, full_text FROM " + _values(fixtures.MAIN_TEXTS, "url, full_text"),
    "paged_listing": "SELECT category, page_no, url FROM " + _values(fixtures.READ_PAGES, "category, page_no, url"),
    "archived_listing": "SELECT category, page_no, url FROM " + _values(fixtures.READ_PAGES, "category, page_no, url"),
    "page_chain": "SELECT category, page_no, url FROM " + _values(fixtures.READ_PAGES, "category, page_no, url"),
    "stream_upsert": """WITH u AS (SELECT url, max(seen) AS seenlast, count(DISTINCT CASE WHEN category <> '' THEN category END) AS n FROM sightings WHERE url <> '' GROUP BY url)
SELECT url AS joburl, seenlast, true AS isactive, n AS n_categories FROM u""",
    "crawl_stored": f"""WITH cat AS (SELECT jobid, min(name) AS category, count(DISTINCT name) AS n FROM jobcategories JOIN categories USING (categoryid) GROUP BY jobid),
b AS (SELECT p.*, coalesce(category, '') AS category, coalesce(n, 0) AS n_categories, {ABS('joburl')} AS detail_url, isactive AS ok, coalesce(list_transform(string_split(coalesce(p.jobdescription, ''), chr(10)), lambda x: {STRIP('x')}), []) AS l
  FROM {P} p LEFT JOIN cat USING (jobid) WHERE coalesce(joburl, '') <> ''),
f AS (SELECT jobid, category, CASE WHEN contains(detail_url, 'jobindex.dk') THEN {_framed("array_to_string(list_filter(l, lambda x: length(x) > 30), chr(10))")} ELSE array_to_string(list_filter(l, lambda x: length(x) > 30), chr(10)) END AS jobdescription FROM b WHERE ok),
{sentences_sql('f', FIRST_PATTERN, 'x')}, {sentences_sql('f', SECOND_PATTERN, 'y')},
d AS (SELECT f.jobid, f.category, f.jobdescription AS body, {TWO} AS d FROM f LEFT JOIN x_g a ON a.jobid = f.jobid LEFT JOIN y_g b ON b.jobid = f.jobid),
dl AS (SELECT jobid, unnest(x) AS line, unnest(range(len(x))) AS i FROM (SELECT jobid, regexp_split_to_array(d, '{LINES_RE}') AS x FROM d)), df AS (SELECT jobid, {STRIP('line')} AS s, min(i) AS i FROM dl WHERE {STRIP('line')} <> '' GROUP BY 1, 2),
dg AS (SELECT jobid, string_agg(s, chr(10) ORDER BY i) AS t FROM df GROUP BY jobid), e AS (SELECT d.jobid, category, body, CASE WHEN d = '' THEN '' ELSE dg.t END AS jobdescription FROM d LEFT JOIN dg USING (jobid)),
{keywords_sql('e', 'o')}, w AS (SELECT jobid, count(*) AS n_keywords, round(max(conf), 6) AS best FROM o GROUP BY jobid)
SELECT b.joburl, {STRIP("coalesce(b.jobtitle, '')")} AS jobtitle, CASE WHEN ok AND coalesce({STRIP('companyname')}, '') = '' THEN coalesce(regexp_extract_all(body, '{D.DEFAULT.organisation}')[1], regexp_extract_all(body, '{D.SECOND.organisation}')[1], {STRIP('companyname')}) ELSE {STRIP('companyname')} END AS companyname,
CASE WHEN companyname IS NULL THEN CASE WHEN ok THEN list_filter(regexp_extract_all(body, '{D.URL}'), lambda u: NOT contains(u, 'jobindex.dk') AND NOT contains(u, 'systematic.dk'))[1] END ELSE '{settings.BASE_URL}/virksomhed/' || b.jobid END AS companyurl,
CASE WHEN ok AND coalesce({STRIP('joblocation')}, '') = '' THEN coalesce(regexp_extract_all(body, '{D.DEFAULT.place}', 1)[1], regexp_extract_all(body, '{D.SECOND.place}', 1)[1], {STRIP('joblocation')}) ELSE {STRIP('joblocation')} END AS joblocation,
e.jobdescription, true AS isactive, n_categories, coalesce(n_keywords, 0) AS n_keywords, best FROM b LEFT JOIN e ON e.jobid = b.jobid LEFT JOIN w ON w.jobid = b.jobid""",
}
