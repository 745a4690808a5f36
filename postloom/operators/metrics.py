"""Counts while a plan runs (A3, A4) and logs (W11), without a second pass over the data."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger("postloom")


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its rows and of how often each condition holds; ``Observation.get`` has the numbers once an action
    on the frame is over."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count(F.when(c, 1)).alias(k) for k, c in counts.items()]), seen


def with_new_jobs(batch: DataFrame, stored: DataFrame, url: str = "url", stored_url: str = "joburl") -> tuple[DataFrame, Observation]:
    """A3: a batch with ``is_new`` (its address is not stored) and the running counts of rows and new jobs."""
    known = stored.select(F.col(stored_url).alias(url), F.lit(True).alias("_known")).dropDuplicates([url])
    marked = batch.join(known, url, "left").withColumn("is_new", F.col("_known").isNull()).drop("_known")
    return observed(marked, "jobs", new=F.col("is_new"))


class ProgressLog(StreamingQueryListener):
    """Logs every micro-batch of a stream."""

    def onQueryStarted(self, event) -> None:  # noqa: ANN001
        log.info("stream %s started", event.id)

    def onQueryProgress(self, event) -> None:  # noqa: ANN001
        p = event.progress
        log.info("stream %s batch %s: %s rows in %s ms", p.id, p.batchId, p.numInputRows, p.batchDuration)

    def onQueryIdle(self, event) -> None:  # noqa: ANN001
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001
        log.info("stream %s ended%s", event.id, f": {event.exception}" if event.exception else "")
