from __future__ import annotations

import datetime as dt
import logging

from postloom.operators.metrics import ProgressLog, with_new_jobs
from postloom.operators.store import Store
from postloom.runtime import fresh_path
from postloom.streaming.sightings import RECORDS, not_recent, read_records, store_stream


def rows(n, day):
    return [(day, i, dt.datetime(2025, 1, day, i % 24), f"/job/{i % 7}" if i % 9 else None, "Salg" if i % 2 else f"subid_{i % 3}", f"t{day}") for i in range(n)]


def test_stream_fills_the_store_once(spark, caplog):
    folder, state = fresh_path(spark, "in"), fresh_path(spark, "state")
    store = Store(spark, fresh_path(spark, "store"))
    listener = ProgressLog()
    spark.streams.addListener(listener)
    try:
        with caplog.at_level(logging.INFO, "postloom"):
            for day in (1, 2):
                spark.createDataFrame(rows(30, day), RECORDS).repartition(3).write.mode("append").parquet(folder)
                store_stream(read_records(spark, folder, 2), store, state)
    finally:
        spark.streams.removeListener(listener)
    got = {r["joburl"]: (r["jobtitle"], r["isactive"]) for r in store.read("postings").collect()}
    assert set(got) == {f"/job/{i}" for i in range(7)} and {t for t, _ in got.values()} == {"t1"}
    assert {r["name"] for r in store.read("categories").collect()} == {"Salg", "subid_0", "subid_1", "subid_2"}
    before = store.read("postings").count()
    store_stream(read_records(spark, folder, 2), store, state)  # nothing new
    assert store.read("postings").count() == before == 7


def test_recent_records_are_dropped(spark):
    folder = fresh_path(spark, "in")
    spark.createDataFrame(rows(20, 1), RECORDS).filter("url is not null").coalesce(1).write.parquet(folder)
    out = not_recent(read_records(spark, folder))
    q = out.writeStream.format("memory").queryName("recent_test").trigger(availableNow=True).option("checkpointLocation", fresh_path(spark, "state")).start()
    q.awaitTermination()
    assert sorted(r["url"] for r in spark.table("recent_test").collect()) == [f"/job/{i}" for i in range(7)]


def test_observed_counts(spark):
    batch = spark.createDataFrame([("/a",), ("/b",), ("/b",), (None,)], "url string")
    df, seen = with_new_jobs(batch, spark.createDataFrame([("/a",), ("/a",)], "joburl string"))
    assert df.count() == 4
    assert seen.get == {"rows": 4, "new": 3}
