"""Problem 3: lines repeated across the postings of one site.

Duplicate documents are collapsed first: postings of a site with the same text are one cluster with a
weight and a set of dates, and only the 128-bit keys of its lines travel, never its text. Lines are then
counted over clusters; the weights give back the number of postings, which is what TESTDATA.md's thresholds
are on, and the clusters and publication dates are reported beside it (``min_clusters`` and ``min_dates``
are the stricter tests of the general problem; 1 here, because TESTDATA.md counts postings).

Shuffles: one small row per posting to collapse, (site, line) rows after map-side aggregation to count.
A line that stands in every posting of a hot site arrives as one pre-aggregated row per map task. The repeated
lines, at most 20 times the mean number of lines per posting for each site, are joined to the lines of all
postings broadcast if proven small, else salted.

Defined results: a null or blank url has no site and its lines are never found; null and empty descriptions
have no line; repeated rows of one posting id count once; ``\\r`` belongs to its line; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import lines, site_host, strip
from postloom.runtime import materialize, semi_or_salted

MIN_CHARS, MIN_POSTINGS, ONE_IN = 25, 5, 20


def line_key(line: Column) -> Column:
    """Key of a line: outer spaces and tabs removed, lower case, runs of spaces and tabs one space, runs of digits 0.
    Null if the line has fewer than ``MIN_CHARS`` characters without outer white space."""
    n = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(line, r"^[ \t]+|[ \t]+$", "")), r"[ \t]+", " "), r"[0-9]+", "0")
    return F.when(F.length(strip(line)) >= MIN_CHARS, F.unhex(F.md5(n)))


def sited(postings: DataFrame) -> DataFrame:
    """(jobid, site, jobdescription, day) of the postings that have a site and a text."""
    day = F.to_date("published") if "published" in postings.columns else F.lit(None).cast("date")
    return postings.select("jobid", site_host("companyurl").alias("site"), "jobdescription", day.alias("day")).filter("site is not null and jobdescription <> ''")


def clusters(docs: DataFrame) -> DataFrame:
    """One row per site and text: distinct line keys, number of postings, publication days."""
    keyed = docs.select("site", "jobid", "day", F.unhex(F.md5("jobdescription")).alias("text"), F.array_distinct(F.filter(F.transform(lines("jobdescription"), line_key), lambda k: k.isNotNull())).alias("keys"))
    return keyed.groupBy("site", "text").agg(F.first("keys").alias("keys"), F.count_distinct("jobid").alias("n"), F.collect_set("day").alias("days"))


def repeated_lines(postings: DataFrame, min_postings: int = MIN_POSTINGS, one_in: int = ONE_IN, min_clusters: int = 1, min_dates: int = 0) -> DataFrame:
    """(site, key, n_postings, n_clusters, n_dates, n_site) of the lines repeated within a site."""
    grouped = materialize(clusters(sited(postings)), "clusters")
    totals = materialize(grouped.groupBy("site").agg(F.sum("n").alias("n_site")), "sites")
    exploded = grouped.select("site", "n", "days", F.explode("keys").alias("key"))
    counted = exploded.groupBy("site", "key").agg(F.sum("n").alias("n_postings"), F.count(F.lit(1)).alias("n_clusters")).filter((F.col("n_postings") >= min_postings) & (F.col("n_clusters") >= min_clusters))
    found = semi_or_salted(counted, totals, ["site"], how="inner", salt_by=F.xxhash64("key")).filter(F.col("n_postings") * one_in >= F.col("n_site"))
    found = materialize(found, "repeated")
    # dates only for the lines that passed: distinct per line, then counted
    days = semi_or_salted(exploded.select("site", "key", "days"), found.select("site", "key"), ["site", "key"])
    dated = days.select("site", "key", F.explode("days").alias("day")).distinct().groupBy("site", "key").agg(F.count(F.lit(1)).alias("n_dates"))
    out = found.join(dated, ["site", "key"], "left").withColumn("n_dates", F.coalesce("n_dates", F.lit(0).cast("long")))
    return out.filter(F.col("n_dates") >= min_dates) if min_dates else out


def found_lines(postings: DataFrame, repeated: DataFrame) -> DataFrame:
    """(jobid, line_no) of every repeated line."""
    numbered = sited(postings).select("jobid", "site", F.posexplode(F.transform(lines("jobdescription"), line_key)).alias("at", "key")).filter("key is not null")
    hit = semi_or_salted(numbered, repeated.select("site", "key"), ["site", "key"], salt_by=F.xxhash64("jobid"))
    return hit.select("jobid", (F.col("at") + 1).cast("long").alias("line_no")).distinct()


def without_lines(postings: DataFrame, found: DataFrame) -> DataFrame:
    """(jobid, description): every description without its repeated lines; null stays null."""
    drop = found.groupBy("jobid").agg(F.collect_list(F.col("line_no").cast("int")).alias("drop"))  # as long as one description at most
    kept = F.filter(lines("jobdescription"), lambda _, i: ~F.array_contains("drop", i + 1))
    return postings.select("jobid", "jobdescription").join(drop, "jobid", "left").select("jobid", F.when(F.col("drop").isNull(), F.col("jobdescription")).otherwise(F.array_join(kept, "\n")).alias("description"))
