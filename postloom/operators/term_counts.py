"""Problem 2: how often every distinct term occurs, and in how many records.

Counts are kept by incremental signed deltas. A change of the collection is given as images of records:
the rows of each added or changed record after the change (sign +1) and the rows of each changed or
deleted record before it (sign -1). Aggregated to one row per term this is the change of its occurrences
and of the number of records that hold it; no state per (term, record) is needed. The change is merged
into counts that are partitioned by a hash of the term, and only the partitions that a change touches are
written again (:mod:`versions`): readers never see half a merge, a retried delta of any age is applied once, and the partitions
are split when they have become too large.

Shuffles: (term, record) pairs after map-side aggregation, then one row per term. A hot term is spread by
the record in the first step and arrives pre-aggregated in the second.

Defined results: null and blank keywords are no term; a null record id counts for the occurrences but is
no record; repeated rows count as occurrences; empty tables give no terms; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions.text import strip
from postloom.operators.versions import BUCKET_ROWS, BUCKETS, Buckets, Versions
from postloom.runtime import fresh_path, materialize

COUNTS = T.StructType([T.StructField("term", T.StringType()), T.StructField("n_rows", T.LongType()), T.StructField("n_records", T.LongType())])


def term(c):
    """A keyword without outer white space, in lower case; null if nothing is left."""
    t = F.lower(strip(c))
    return F.when(t != "", t)


def signed_images(after: DataFrame | None, before: DataFrame | None, record: str, value: str) -> DataFrame:
    """(record, term, sign): one row per row of an image; term is null for what is no term."""
    parts = [df.select(F.col(record).alias("_record"), term(F.col(value)).alias("_term"), F.lit(s).cast("long").alias("_sign")) for df, s in ((after, 1), (before, -1)) if df is not None]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def term_deltas(images: DataFrame) -> DataFrame:
    """(term, d_rows, d_records) of signed images: first per (term, record, sign), then per term."""
    pairs = images.filter("_term is not null").groupBy("_term", "_record", "_sign").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(F.col("_term").alias("term")).agg(
        F.sum(F.col("_sign") * F.col("n")).alias("d_rows"),
        F.sum(F.when(F.col("_record").isNotNull(), F.col("_sign")).otherwise(F.lit(0).cast("long"))).alias("d_records"),
    )


def changed_images(old: DataFrame, new: DataFrame, record: str, value: str) -> tuple[DataFrame, DataFrame]:
    """The images (after, before) of the records that differ between two snapshots.

    Records are compared by row count and a sum of row hashes, so both snapshots are shuffled once as one
    row per record."""

    def digest(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(record).alias("_r")).agg(F.struct(F.count(F.lit(1)), F.sum(F.xxhash64(value, F.lit(1)).cast("decimal(38,0)"))).alias(name))

    both = digest(old, "a").join(digest(new, "b"), "_r", "full")
    ids = both.filter(~F.col("a").eqNullSafe(F.col("b"))).select(F.col("_r").alias(record))
    return new.join(ids, record, "left_semi"), old.join(ids, record, "left_semi")


class TermCounts:
    """Persistent counts per term under ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.versions = spark, Versions(spark, path)
        self.path = self.versions.path
        self.table = Buckets(self.versions, "counts", COUNTS, "term", buckets, bucket_rows)

    def apply(self, after: DataFrame | None = None, before: DataFrame | None = None, record: str = "jobid", value: str = "keyword", delta_id: str | None = None) -> None:
        """Merge one change; see the module. A ``delta_id`` that was applied before is ignored."""
        state = self.versions.state()
        if delta_id is not None and self.versions.applied(delta_id, state):
            return
        entry, version = self.table.entry(state), state["version"] + 1
        images = signed_images(after, before, record, value)
        delta = materialize(term_deltas(images), "delta")
        touched = self.table.touched(entry, delta)
        # every record counts once on each side, whatever terms it holds
        records = images.filter("_record is not null").groupBy("_record", "_sign").agg(F.lit(1)).groupBy().agg(F.coalesce(F.sum("_sign"), F.lit(0))).first()[0]
        merged = delta.select("term", F.col("d_rows").alias("n_rows"), F.col("d_records").alias("n_records"))
        if entry["at"]:
            merged = self.table.read(entry, touched).unionByName(merged).groupBy("term").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_records").alias("n_records"))
        entry = self.table.write(merged.filter("n_rows <> 0 or n_records <> 0"), entry, touched, version)
        self.versions.commit(state | {"tables": {"counts": entry}, "records": state.get("records", 0) + int(records)}, delta_id)

    @property
    def records(self) -> int:
        return self.versions.state().get("records", 0)

    def counts(self) -> DataFrame:
        return self.table.read(self.table.entry(self.versions.state()))

    def marked(self, rare_records: int = 2, common_share: float = 0.15) -> DataFrame:
        """All terms with their counts and a mark: ``rare`` (at most ``rare_records`` records), ``common`` (more
        than ``common_share`` of all records) or null. In a collection so small that both hold, rare wins."""
        n = F.col("n_records")
        mark = F.when(n <= rare_records, "rare").when(n > F.lit(common_share) * F.lit(self.records), "common")
        return self.counts().withColumn("mark", mark)


def term_counts(keywords: DataFrame, record: str = "jobid", value: str = "keyword", path: str | None = None) -> TermCounts:
    """Counts of a whole table: one delta of added records on an empty store."""
    spark = keywords.sparkSession
    store = TermCounts(spark, path or fresh_path(spark, "term-counts"))
    store.apply(after=keywords, record=record, value=value)
    return store
