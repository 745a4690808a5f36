"""Queries over training text (problems 1, 3, 5, 6, 8, 9 and 10), with SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions.text import WHITE_RE2
from postloom.llm import abuse, language, leaks, packing, repeated_lines, residue, wrapper
from postloom.runtime import materialize, table

POSTINGS = "jobindexpostingsextended"


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.evidence(table(spark, sf_dir, POSTINGS)).filter("residue").select("jobid").distinct()


def p1_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What speaks for and against every posting with a description."""
    return residue.evidence(table(spark, sf_dir, POSTINGS)).drop("body", "jobtitle").withColumn("odds", F.round("odds", 6))


def p1_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evidence of title, address, body and host alone."""
    return residue.evidence(table(spark, sf_dir, POSTINGS)).select("jobid", "low", "mismatch", "titles", "host_titles")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = table(spark, sf_dir, POSTINGS)
    return repeated_lines.found_lines(postings, repeated_lines.repeated_lines(postings))


def p3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated lines of every site with their postings, distinct texts and publication days."""
    return repeated_lines.repeated_lines(table(spark, sf_dir, POSTINGS)).select("site", F.lower(F.hex("key")).alias("line_md5"), "n_postings", "n_clusters", "n_dates", "n_site")


def p3_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every description without its repeated lines."""
    postings = table(spark, sf_dir, POSTINGS)
    return repeated_lines.without_lines(postings, repeated_lines.found_lines(postings, repeated_lines.repeated_lines(postings)))


def _stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_stretches(table(spark, sf_dir, POSTINGS), table(spark, sf_dir, "postinglang"), table(spark, sf_dir, "documents"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.contradicted(language.per_language(_stretches(spark, sf_dir)), table(spark, sf_dir, "postinglang"))


def p5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters of running text and confidence per language of every description."""
    return language.per_language(_stretches(spark, sf_dir))


def p5_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of every description with its language and confidence."""
    return _stretches(spark, sf_dir).select("jobid", F.explode("stretches").alias("s")).select("jobid", "s.start", "s.end", "s.lang", "s.confidence")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.furniture_lines(table(spark, sf_dir, POSTINGS)).select("jobid", "line_no")


def p6_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every description as the advert alone."""
    postings = table(spark, sf_dir, POSTINGS)
    return repeated_lines.without_lines(postings, wrapper.furniture_lines(postings))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its container."""
    return packing.assign(packing.token_counts(table(spark, sf_dir, "documents")))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the containers are filled: their number, that of best-fit decreasing, and the lower bound."""
    placed, told = packing.assigned(packing.token_counts(table(spark, sf_dir, "documents")))
    bins = placed.filter("container is not null").groupBy("container").agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("pieces"))
    return bins.agg(
        F.count(F.lit(1)).alias("n_containers"), F.lit(told["best_fit"]).cast("bigint").alias("best_fit"), F.lit(told["least"]).cast("bigint").alias("least_containers"), F.coalesce(F.sum("used"), F.lit(0)).alias("n_tokens"),
        F.coalesce(F.sum("pieces"), F.lit(0)).alias("n_pieces"), F.coalesce(F.max("used"), F.lit(0)).alias("fullest"),
    )


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "evalitems")).select("item_id", "doc_id").distinct()


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked test items with the number of documents and the longest stretch of words."""
    found = leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "evalitems"))
    return found.groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("words").cast("bigint").alias("longest"))


def p9_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus without leaked passages."""
    documents = table(spark, sf_dir, "documents")
    return leaks.without_leaks(documents, materialize(leaks.leaks(documents, table(spark, sf_dir, "evalitems")), "leaks"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.abuse_scores(table(spark, sf_dir, "documents")).filter(F.col("score") >= abuse.THRESHOLD).select("doc_id").distinct()


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score and its offending sentences."""
    return abuse.abuse_scores(table(spark, sf_dir, "documents")).select("doc_id", F.round("score", 4).alias("score"), F.round("top", 4).alias("top"), "offending")


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of abusive documents per source."""
    documents = table(spark, sf_dir, "documents")
    return abuse.source_rates(documents, abuse.abuse_scores(documents))


_SITED = r"""
WITH u AS (SELECT jobid, jobdescription AS d, lower(regexp_replace(companyurl, '^W+|W+$', '', 'g')) AS u FROM jobindexpostingsextended WHERE jobdescription <> ''),
v AS (SELECT jobid, d, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(u, '^[a-z][a-z0-9+.\-]*:(//)', '\1'), '^//', ''), '[/?#\\].*$', '', 's'), ':\d*$', ''), '^www\.', '') AS s FROM u),
s AS (SELECT jobid, d, regexp_replace(s, '^W+|W+$', '', 'g') AS site FROM v WHERE regexp_replace(s, '^W+|W+$', '', 'g') <> ''),
l AS (SELECT jobid, site, unnest(string_split(d, chr(10))) AS line, unnest(range(1, len(string_split(d, chr(10))) + 1)) AS line_no FROM s),
k AS (SELECT jobid, site, line_no, md5(regexp_replace(regexp_replace(lower(regexp_replace(line, '^[ \t]+|[ \t]+$', '', 'g')), '[ \t]+', ' ', 'g'), '[0-9]+', '0', 'g')) AS key FROM l WHERE length(regexp_replace(line, '^W+|W+$', '', 'g')) >= 25),
n AS (SELECT site, count(DISTINCT jobid) AS n_site FROM s GROUP BY site),
r AS (SELECT k.site, key, n_site, count(DISTINCT jobid) AS n FROM k JOIN n ON k.site = n.site GROUP BY k.site, key, n_site HAVING count(DISTINCT jobid) >= 5 AND count(DISTINCT jobid) * 20 >= n_site),
f AS (SELECT DISTINCT jobid, line_no FROM k JOIN r ON k.site = r.site AND k.key = r.key)
""".replace("W+", WHITE_RE2 + "+")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found, "p1_evidence": p1_evidence, "p1_mismatch": p1_mismatch, "p3_found": p3_found, "p3_lines": p3_lines, "p3_clean": p3_clean, "p5_found": p5_found, "p5_languages": p5_languages, "p5_stretches": p5_stretches, "p6_found": p6_found, "p6_clean": p6_clean,
    "p8_containers": p8_containers, "p8_fill": p8_fill, "p9_found": p9_found, "p9_items": p9_items, "p9_clean": p9_clean, "p10_found": p10_found, "p10_scores": p10_scores, "p10_rates": p10_rates,
}

_STRIPPED = f"regexp_replace(jobdescription, '^{WHITE_RE2}+|{WHITE_RE2}+$', '', 'g')"
_WORDS = lambda c: f"list_distinct(regexp_extract_all(lower(coalesce({c}, '')), '[\\p{{L}}]{{3,}}'))"
_SLUG = r"regexp_replace(regexp_extract(coalesce(joburl, ''), '([^/?#]*)(?:[?#].*)?$', 1), '[-_]', ' ', 'g')"

SQL: dict[str, str] = {
    "p1_mismatch": _SITED.replace("WHERE jobdescription <> ''", "")
    + f""", t AS (SELECT j.jobid, coalesce(site, '') AS site, coalesce(jobtitle, '') AS title, regexp_replace(lower({_STRIPPED}), '[0-9]+', '0', 'g') AS body, {_WORDS('jobdescription')} AS words, list_distinct(list_concat({_WORDS('jobtitle')}, {_WORDS(_SLUG)})) AS told
FROM jobindexpostingsextended j LEFT JOIN s ON s.jobid = j.jobid WHERE {_STRIPPED} <> ''),
e AS (SELECT *, len(words) <= {residue.LOW_TERMS} AS low, len(told) > 0 AND NOT list_has_any(told, words) AS mismatch FROM t),
a AS (SELECT body, count(DISTINCT title) AS titles FROM e WHERE low GROUP BY body), h AS (SELECT body, site, count(DISTINCT title) AS n FROM e WHERE low GROUP BY body, site), m AS (SELECT body, max(n) AS host_titles FROM h GROUP BY body)
SELECT jobid, low, mismatch, CASE WHEN low THEN titles ELSE 0 END AS titles, CASE WHEN low THEN host_titles ELSE 0 END AS host_titles FROM e LEFT JOIN a USING (body) LEFT JOIN m USING (body)""",
    "p3_found": _SITED + "SELECT jobid, line_no FROM f",
    "p3_lines": _SITED + """, p AS (SELECT r.site, r.key, n_site, n, count(DISTINCT s.d) AS n_clusters, count(DISTINCT CAST(j.published AS DATE)) AS n_dates
FROM r JOIN k ON k.site = r.site AND k.key = r.key JOIN s ON s.jobid = k.jobid JOIN jobindexpostingsextended j ON j.jobid = k.jobid GROUP BY r.site, r.key, n_site, n)
SELECT site, key AS line_md5, n AS n_postings, n_clusters, n_dates, n_site FROM p""",
    "p3_clean": _SITED + """, g AS (SELECT l.jobid, string_agg(line, chr(10) ORDER BY l.line_no) AS description FROM (SELECT jobid, unnest(string_split(jobdescription, chr(10))) AS line, unnest(range(1, len(string_split(jobdescription, chr(10))) + 1)) AS line_no
FROM jobindexpostingsextended WHERE jobdescription IS NOT NULL) l LEFT JOIN f ON f.jobid = l.jobid AND f.line_no = l.line_no WHERE f.jobid IS NULL GROUP BY l.jobid)
SELECT j.jobid, CASE WHEN j.jobdescription IS NULL THEN NULL ELSE coalesce(g.description, '') END AS description FROM jobindexpostingsextended j LEFT JOIN g ON g.jobid = j.jobid""",
}
