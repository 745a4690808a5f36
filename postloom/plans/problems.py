"""Queries of the general problems (2, 4 and 7) over the posting store, with SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions.text import WHITE_RE2
from postloom.operators.name_variants import organisations, variant_pairs
from postloom.operators.place_match import match_values, place_mappings
from postloom.operators.term_counts import TermCounts, changed_images, term_counts
from postloom.runtime import fresh_path, materialize, table

RARE_RECORDS, COMMON_SHARE = 2, 0.15


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms that are too rare or too common, with their mark."""
    store = term_counts(table(spark, sf_dir, "jobkeywords"))
    return store.marked(RARE_RECORDS, COMMON_SHARE).filter("mark is not null").select("term", "mark")


def p2_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term with its rows, postings and mark."""
    return term_counts(table(spark, sf_dir, "jobkeywords")).marked(RARE_RECORDS, COMMON_SHARE).select("term", "n_rows", F.col("n_records").alias("n_jobs"), "mark")


def p2_after_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts kept over three changes: all postings but the inactive ones are added; then the inactive ones are; then
    the keywords of source ``legacy`` are taken from every posting, which changes some postings and empties others."""
    words = table(spark, sf_dir, "jobkeywords")
    gone = table(spark, sf_dir, "jobindexpostingsextended").filter(~F.col("isactive")).select("jobid")
    active, inactive = words.join(gone, "jobid", "left_anti"), words.join(gone, "jobid", "left_semi")
    store = TermCounts(spark, fresh_path(spark, "term-counts"))
    store.apply(after=active, delta_id="active")
    store.apply(after=inactive, delta_id="inactive")
    kept = words.filter(F.coalesce("source", F.lit("")) != "legacy")
    after, before = changed_images(words, kept, "jobid", "keyword")
    store.apply(after=after, before=before, delta_id="legacy")
    store.apply(after=after, before=before, delta_id="legacy")  # a retry changes nothing
    return store.counts().select("term", "n_rows", F.col("n_records").alias("n_jobs"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_pairs(table(spark, sf_dir, "jobindexpostingsextended"))


def p4_organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per spelling with its organisation."""
    return organisations(table(spark, sf_dir, "jobindexpostingsextended"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place_mappings(table(spark, sf_dir, "jobindexpostingsextended"), table(spark, sf_dir, "placelist"))


def p7_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spellings that match no entry, with the number of postings that have them."""
    from postloom.functions.text import strip

    places = table(spark, sf_dir, "placelist")
    located = table(spark, sf_dir, "jobindexpostingsextended").select("jobid", strip("joblocation").alias("value")).filter("value <> ''")
    counts = located.groupBy("value").agg(F.count(F.lit(1)).alias("n_jobs"))
    none = materialize(match_values(located, "value", places), "mapped").filter("placeid = 0").select("value")
    exact = places.select(F.col("placename").alias("value"))
    return counts.join(none, "value", "left_semi").join(exact, "value", "left_anti")


_TERMS = f"""
WITH t AS (SELECT jobid, lower(regexp_replace(keyword, '^{WHITE_RE2}+|{WHITE_RE2}+$', '', 'g')) AS term FROM jobkeywords WHERE keyword IS NOT NULL),
c AS (SELECT term, count(*) AS n_rows, count(DISTINCT jobid) AS n_jobs FROM t WHERE term <> '' GROUP BY term),
m AS (SELECT term, n_rows, n_jobs, CASE WHEN n_jobs <= {RARE_RECORDS} THEN 'rare' WHEN n_jobs > {COMMON_SHARE} * (SELECT count(DISTINCT jobid) FROM jobkeywords) THEN 'common' END AS mark FROM c)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found, "p2_terms": p2_terms, "p2_after_changes": p2_after_changes, "p4_found": p4_found, "p4_organisations": p4_organisations, "p7_found": p7_found, "p7_unmatched": p7_unmatched,
}

SQL: dict[str, str] = {
    "p2_found": _TERMS + "SELECT term, mark FROM m WHERE mark IS NOT NULL",
    "p2_terms": _TERMS + "SELECT term, n_rows, n_jobs, mark FROM m",
    "p2_after_changes": f"""
WITH t AS (SELECT jobid, lower(regexp_replace(keyword, '^{WHITE_RE2}+|{WHITE_RE2}+$', '', 'g')) AS term FROM jobkeywords WHERE keyword IS NOT NULL AND coalesce(source, '') <> 'legacy')
SELECT term, count(*) AS n_rows, count(DISTINCT jobid) AS n_jobs FROM t WHERE term <> '' GROUP BY term""",
}
