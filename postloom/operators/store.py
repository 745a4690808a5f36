"""The store: postings, categories, links and keywords with first-write-wins upserts.

Tables are Parquet and never changed in place: a batch rewrites the buckets of the addresses and postings it touches, once, and the versioned
store (:class:`Store`) makes them current in one step, so what a batch writes grows with the batch and not with the store. Ids are dense and stable: existing rows keep theirs, new rows get the next ones in the order of arrival,
numbered by range partitions and not in one task. The clock is always the argument ``as_of``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.operators.versions import BUCKET_ROWS, BUCKETS, Buckets, Versions
from postloom.runtime import materialize

POSTINGS = T.StructType(
    [
        T.StructField("jobid", T.LongType()), T.StructField("companyname", T.StringType()), T.StructField("companyurl", T.StringType()), T.StructField("jobtitle", T.StringType()),
        T.StructField("joblocation", T.StringType()), T.StructField("jobdescription", T.StringType()), T.StructField("joburl", T.StringType()), T.StructField("published", T.TimestampNTZType()),
        T.StructField("bannerpicture", T.BinaryType()), T.StructField("footerpicture", T.BinaryType()), T.StructField("seenlast", T.TimestampNTZType()), T.StructField("isactive", T.BooleanType()),
    ]
)
CATEGORIES = T.StructType([T.StructField("categoryid", T.LongType()), T.StructField("name", T.StringType())])
LINKS = T.StructType([T.StructField("jobid", T.LongType()), T.StructField("categoryid", T.LongType())])
KEYWORDS = T.StructType([T.StructField("keywordid", T.LongType()), T.StructField("jobid", T.LongType()), T.StructField("keyword", T.StringType()), T.StructField("source", T.StringType()), T.StructField("confidencescore", T.DoubleType())])
SCHEMAS = {"postings": POSTINGS, "categories": CATEGORIES, "posting_categories": LINKS, "posting_keywords": KEYWORDS}
# Widths of the store's text columns; longer values are rejected with the row.
WIDTHS = {"companyname": 255, "joburl": 512}


def numbered(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """``df`` with consecutive numbers after ``start`` in the given order, counted by range partitions in two steps."""
    if not order:
        raise ValueError("an order is needed")
    cut = materialize(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranges")
    sizes = cut.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_p", "_before"), "offsets")
    within = Window.partitionBy("_p").orderBy(*order)
    return cut.withColumn("_r", F.row_number().over(within)).join(F.broadcast(offsets), "_p").withColumn(name, (F.col("_r") + F.col("_before") + F.lit(start)).cast("bigint")).drop("_p", "_r", "_before")


def next_id(df: DataFrame, column: str) -> int:
    return int(df.agg(F.coalesce(F.max(column), F.lit(0))).first()[0])


# -- joins


def existing(batch: DataFrame, stored: DataFrame, url: str = "url", stored_url: str = "joburl") -> DataFrame:
    """Rows whose address is stored."""
    return batch.join(stored.select(F.col(stored_url).alias(url)), url, "left_semi")


def unknown(batch: DataFrame, stored: DataFrame, url: str = "url", stored_url: str = "joburl") -> DataFrame:
    """Rows whose address is not stored (a null address is not)."""
    return batch.join(stored.select(F.col(stored_url).alias(url)), url, "left_anti")


def with_posting_id(batch: DataFrame, stored: DataFrame, url: str = "url", stored_url: str = "joburl") -> DataFrame:
    """J4."""
    return batch.join(stored.select(F.col(stored_url).alias(url), "jobid"), url)


# -- dimension and bridge


def category_name(category: Column, categories: DataFrame | None = None) -> Column:
    """A category without a name is none."""
    return F.when(F.coalesce(category, F.lit("")) != "", category)


def get_or_create(categories: DataFrame, names: DataFrame, name: str = "name", start: int | None = None) -> DataFrame:
    """The dimension with every name of ``names``; new ones get the next ids in the order of their names."""
    start = next_id(categories, "categoryid") if start is None else start
    new = names.select(F.col(name).alias("name")).filter("name is not null").distinct().join(categories.select("name"), "name", "left_anti")
    return categories.select("categoryid", "name").unionByName(numbered(new, ["name"], "categoryid", start).select("categoryid", "name"))


def link(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """The bridge with every pair once."""
    new = pairs.select("jobid", "categoryid").filter("jobid is not null and categoryid is not null").distinct().join(links.select("jobid", "categoryid"), ["jobid", "categoryid"], "left_anti")
    return links.select("jobid", "categoryid").unionByName(new)


# -- upsert


def first_and_last(batch: DataFrame, url: str, seen: str, order: Sequence[str], content: Sequence[str]) -> DataFrame:
    """One row per address: the content of its first row in the order given and the time it was last seen; rows without an
    address are dropped. One shuffle, aggregated on the map side; no address is ever one list."""
    first = F.min_by(F.struct(*content, *[F.col(o).alias(f"_first_{o}") for o in order]), F.struct(*order, *[F.col(c) for c in content]))
    return batch.filter(F.coalesce(F.col(url), F.lit("")) != "").groupBy(F.col(url).alias("joburl")).agg(first.alias("_f"), F.max(seen).alias("_seen")).select("joburl", "_f.*", "_seen")


def rejected(batch: DataFrame, widths: dict[str, int] | None = None) -> DataFrame:
    """Rows that the store cannot hold, with the reason: a value wider than its column."""
    out: Column | None = None
    for c, w in (WIDTHS if widths is None else widths).items():
        if c in batch.columns:
            hit = F.length(c) > w
            out = F.when(hit, F.lit(f"{c} is longer than {w}")) if out is None else out.when(hit, F.lit(f"{c} is longer than {w}"))
    return batch.withColumn("reason", out if out is not None else F.lit(None).cast("string")).filter("reason is not null")


def upsert(postings: DataFrame, incoming: DataFrame, order: Sequence[str], start: int | None = None) -> DataFrame:
    """``incoming`` (of :func:`first_and_last`) into the postings. Known addresses keep their content, are seen
    now (a late record does not set the time back) and active again; new ones are inserted, active, with the ids after ``start`` (else the highest)
    in their order."""
    start = next_id(postings, "jobid") if start is None else start
    columns = [c for c in postings.columns if c not in ("jobid", "joburl", "seenlast", "isactive")]
    seen = incoming.select("joburl", "_seen")
    kept = postings.join(seen, "joburl", "left").withColumns({"isactive": F.col("_seen").isNotNull() | F.coalesce("isactive", F.lit(True)), "seenlast": F.greatest("_seen", "seenlast")})
    new = incoming.join(postings.select("joburl"), "joburl", "left_anti")
    placed = numbered(new, [*[f"_first_{o}" for o in order], "joburl"], "jobid", start)
    known = {f.name: f.dataType for f in postings.schema}
    inserted = placed.select("jobid", *[(F.col(c) if c in placed.columns else F.lit(None)).cast(known[c]).alias(c) for c in columns], "joburl", F.col("_seen").cast(known["seenlast"]).alias("seenlast"), F.lit(True).alias("isactive"))
    return kept.select(*postings.columns).unionByName(inserted.select(*postings.columns))


def expire(postings: DataFrame, as_of: Column, days: int = 1) -> DataFrame:
    """Active postings last seen more than ``days`` before ``as_of`` become inactive; a null time never does. ``changed``
    tells which (A4)."""
    stale = F.coalesce(F.col("isactive") & (F.col("seenlast") < as_of - F.make_dt_interval(F.lit(days))), F.lit(False))
    return postings.withColumn("changed", stale).withColumn("isactive", F.col("isactive") & ~F.col("changed"))


def evolve(df: DataFrame, schema: T.StructType = POSTINGS) -> DataFrame:
    """A table of an older version with the columns it lacks; ``isactive`` is true where it is null."""
    have = {c.lower(): c for c in df.columns}
    out = df.select(*[(F.col(have[f.name]) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema], *[c for c in df.columns if c.lower() not in {f.name for f in schema}])
    return out.withColumn("isactive", F.coalesce("isactive", F.lit(True))) if "isactive" in {f.name for f in schema} else out


def clustered(postings: DataFrame) -> DataFrame:
    """Rows sorted by ``seenlast`` within files, so that Parquet's statistics prune the search for stale ones."""
    return postings.repartitionByRange("seenlast").sortWithinPartitions("seenlast")


def violations(postings: DataFrame, links: DataFrame) -> DataFrame:
    """What a database would refuse: (what, key) of repeated addresses and ids, and links without a posting."""
    urls = postings.groupBy("joburl").count().filter("count > 1").select(F.lit("joburl").alias("what"), F.col("joburl").alias("key"))
    ids = postings.groupBy("jobid").count().filter("count > 1").select(F.lit("jobid").alias("what"), F.col("jobid").cast("string").alias("key"))
    orphans = links.join(postings.select("jobid"), "jobid", "left_anti").select(F.lit("link").alias("what"), F.col("jobid").cast("string").alias("key")).distinct()
    return urls.unionByName(ids).unionByName(orphans)


class Store:
    """The four tables under a path, each batch a new version. ``apply`` is idempotent by batch id, so that a stream that
    repeats a batch after a failure changes nothing twice. Postings are cut by address, links and keywords by posting; the categories are
    one bucket (a dimension of names). The highest ids are kept with the version."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.versions = spark, Versions(spark, path)
        self.path = self.versions.path
        keys = {"postings": "joburl", "categories": "name", "posting_categories": "jobid", "posting_keywords": "jobid"}
        self.tables = {n: Buckets(self.versions, n, SCHEMAS[n], k, 1 if n == "categories" else buckets, bucket_rows) for n, k in keys.items()}

    def read(self, name: str) -> DataFrame:
        return self.tables[name].read(self.tables[name].entry(self.versions.state()))

    def load(self, tables: dict[str, DataFrame]) -> None:
        """Begin with tables that exist already: each replaces the store's table as a whole."""
        state = self.versions.state()
        entries, ids = dict(state.get("tables", {})), dict(state.get("ids", {}))
        for name, df in tables.items():
            t = self.tables[name]
            entry = {"buckets": t.begin, "at": {}, "rows": {}}
            entries[name] = t.write(df, entry, list(range(entry["buckets"])), state["version"] + 1)
            if SCHEMAS[name].names[0] in ("jobid", "categoryid", "keywordid") and name != "posting_categories":
                ids[name] = next_id(t.read(entries[name]), SCHEMAS[name].names[0])
        self.versions.commit(state | {"tables": entries, "ids": ids})

    def apply(
        self, batch: DataFrame, batch_id: int | str | None = None, url: str = "url", seen: str = "seen", order: Sequence[str] = ("batch", "seq"), content: Sequence[str] = ("jobtitle",), category: str = "category",
        keywords: str | None = None,
    ) -> None:
        """One micro-batch into all tables."""
        state = self.versions.state()
        if batch_id is not None and self.versions.applied(batch_id, state):
            return
        version, ids, entries = state["version"] + 1, dict(state.get("ids", {})), dict(state.get("tables", {}))

        def entry(name: str) -> dict:
            return self.tables[name].entry(state)

        def put(name: str, df: DataFrame, touched: list[int]) -> None:
            entries[name] = self.tables[name].write(df, entry(name), touched, version)

        incoming = materialize(first_and_last(batch, url, seen, order, [*content, *([keywords] if keywords else [])]), "incoming")
        touched = self.tables["postings"].touched(entry("postings"), incoming)
        old = self.tables["postings"].read(entry("postings"), touched)
        start = ids.get("postings", 0)
        put("postings", upsert(old, incoming.drop(keywords) if keywords else incoming, order, start), touched)
        now = entries.get("postings", entry("postings"))
        hit = touched if now["buckets"] == entry("postings")["buckets"] else self.tables["postings"].touched(now, incoming)
        after = self.tables["postings"].read(now, hit).join(incoming.select("joburl"), "joburl", "left_semi").select("joburl", "jobid")
        stored = materialize(after, "stored")  # the addresses of the batch
        ids["postings"] = max(start, next_id(stored, "jobid"))

        named = materialize(batch.select(F.col(url).alias("joburl"), category_name(F.col(category)).alias("name")).filter("name is not null").distinct(), "named")
        known, start_c = self.tables["categories"].read(entry("categories")), ids.get("categories", 0)
        dim = materialize(get_or_create(known, named, start=start_c), "categories")
        ids["categories"] = max(start_c, next_id(dim, "categoryid"))
        if ids["categories"] > start_c:
            put("categories", dim, [0])
        pairs = materialize(named.join(stored, "joburl").join(dim, "name").select("jobid", "categoryid"), "pairs")
        linked = self.tables["posting_categories"].touched(entry("posting_categories"), pairs)
        put("posting_categories", link(self.tables["posting_categories"].read(entry("posting_categories"), linked), pairs), linked)
        if keywords:  # W5/K10: only for new postings
            new = stored.filter(F.col("jobid") > start)
            rows = incoming.join(new, "joburl").select("jobid", F.posexplode(keywords).alias("_at", "_k"))
            start_k = ids.get("posting_keywords", 0)
            rows = materialize(numbered(rows, ["jobid", "_at"], "keywordid", start_k).select("keywordid", "jobid", "_k.keyword", "_k.source", F.col("_k.confidence").alias("confidencescore")), "keywords")
            ids["posting_keywords"] = max(start_k, next_id(rows, "keywordid"))
            said = self.tables["posting_keywords"].touched(entry("posting_keywords"), rows)
            put("posting_keywords", self.tables["posting_keywords"].read(entry("posting_keywords"), said).unionByName(rows), said)
        self.versions.commit(state | {"tables": entries, "ids": ids}, batch_id)

    def expire(self, as_of: Column, days: int = 1) -> int:
        """Returns the number of postings that became inactive; only their buckets are written."""
        state = self.versions.state()
        t = self.tables["postings"]
        entry = t.entry(state)
        stale = materialize(expire(t.read(entry), as_of, days).filter("changed").select("joburl"), "stale")
        touched = t.touched(entry, stale)
        if not touched:
            return 0
        done = t.write(expire(t.read(entry, touched), as_of, days).drop("changed"), entry, touched, state["version"] + 1)
        self.versions.commit(state | {"tables": state["tables"] | {"postings": done}})
        return stale.count()
