"""Versioned state under a path, and tables cut into buckets of which a version rewrites only those that a change touches.

A version is one small JSON file that a rename makes current, so readers never see half a change and an older writer's late commit fails.
It names, for every bucket of a table, the version whose folder holds it. Data that none of the last ``KEEP`` versions names is deleted.

The ids of applied changes are all kept: the last ``RECENT`` in the version itself, older ones as empty files named by their hash, which are
written before an id leaves the version. So a retry of any age changes nothing.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP, RECENT = 3, 1000
#: Rows of a bucket beyond which a table gets twice as many buckets, and the buckets that a table begins with.
BUCKET_ROWS, BUCKETS = 1_000_000, 16


class Versions:
    def __init__(self, spark: SparkSession, path: str, recent: int = RECENT):
        self.spark, self.path, self.recent = spark, path.rstrip("/"), recent
        self._p = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._p(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *parts: str):
        return self._p("/".join([self.path, *parts]))

    def names(self, *parts: str) -> list[str]:
        root = self.at(*parts)
        return [s.getPath().getName() for s in self._fs.listStatus(root)] if self._fs.exists(root) else []

    def state(self, version: int | None = None) -> dict:
        """What the current (or a given) version says; ``{"version": 0}`` before the first."""
        if version is None:
            version = max((int(n) for n in self.names("versions") if n.isdigit()), default=0)
        if not version:
            return {"version": 0}
        return json.loads("\n".join(r[0] for r in self.spark.read.text(f"{self.path}/versions/{version}", wholetext=True).collect()))  # one row

    def _mark(self, change: int | str):
        return self.at("applied", hashlib.md5(repr(change).encode()).hexdigest())

    def applied(self, change: int | str, state: dict) -> bool:
        return change in state.get("applied", []) or self._fs.exists(self._mark(change))

    def _create(self, path, text: str) -> None:
        out = self._fs.create(path, True)
        out.write(bytearray(text.encode()))
        out.close()

    def commit(self, state: dict, change: int | str | None = None) -> None:
        """Make ``state`` the version after the one it was read as."""
        state = state | {"version": state["version"] + 1}
        ids = [*state.get("applied", []), *([] if change is None else [change])]
        for old in ids[: -self.recent]:
            self._create(self._mark(old), "")
        state["applied"] = ids[-self.recent :]
        tmp, out = self.at(f".version-{state['version']}"), self.at("versions", str(state["version"]))
        self._fs.mkdirs(self.at("versions"))
        self._create(tmp, json.dumps(state))
        if self._fs.exists(out) or not self._fs.rename(tmp, out):
            raise RuntimeError(f"another writer made version {state['version']} of {self.path}")
        self._forget(state["version"] - KEEP)

    def _forget(self, version: int) -> None:
        """Delete version ``version`` and the folders that it names and no later one does."""
        if version < 1 or str(version) not in self.names("versions"):
            return
        held = {f for n in self.names("versions") if int(n) > version for f in _folders(self.state(int(n)))}
        for folder in _folders(self.state(version)) - held:
            self._fs.delete(self.at(folder), True)
        self._fs.delete(self.at("versions", str(version)), False)


def _folders(state: dict) -> set[str]:
    return {f"{name}/v{v}/bucket={b}" for name, entry in state.get("tables", {}).items() for b, v in entry["at"].items()}


class Buckets:
    """The table ``name`` of a versioned path, cut by a hash of ``key``. An entry of a version is
    ``{"buckets": n, "at": {bucket: version}, "rows": {bucket: rows}}``."""

    def __init__(self, versions: Versions, name: str, schema: T.StructType, key: str, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS):
        self.versions, self.name, self.schema, self.key, self.begin, self.bucket_rows = versions, name, schema, key, buckets, bucket_rows

    def entry(self, state: dict) -> dict:
        return state.get("tables", {}).get(self.name, {"buckets": self.begin, "at": {}, "rows": {}})

    def bucket(self, entry: dict) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(entry["buckets"])).cast("int")

    def touched(self, entry: dict, keys: DataFrame) -> list[int]:
        """The buckets of some keys: as many as there are buckets at most."""
        return sorted(r[0] for r in keys.select(self.bucket(entry).alias("b")).distinct().collect())

    def crowded(self, entry: dict) -> bool:
        return sum(entry["rows"].values()) > self.bucket_rows * entry["buckets"]

    def read(self, entry: dict, buckets: Iterable[int] | None = None) -> DataFrame:
        of = entry["at"] if buckets is None else {str(b): entry["at"][str(b)] for b in buckets if str(b) in entry["at"]}
        spark, root = self.versions.spark, f"{self.versions.path}/{self.name}"
        paths = [f"{root}/v{v}/bucket={b}" for b, v in sorted(of.items(), key=lambda x: int(x[0]))]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def write(self, df: DataFrame, entry: dict, buckets: list[int], version: int) -> dict:
        """The entry after ``buckets`` are replaced by the rows of ``df``, which has no others. A table whose buckets have become too
        large is cut into twice as many, all of them written once."""
        if not buckets:
            return entry
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        root = f"{self.versions.path}/{self.name}/v{version}"
        if self.crowded(entry):
            rest = self.read(entry, [int(b) for b in entry["at"] if int(b) not in buckets])
            entry = {"buckets": 2 * entry["buckets"], "at": {}, "rows": {}}
            df, buckets = df.unionByName(rest), list(range(entry["buckets"]))
        cut = df.withColumn("bucket", self.bucket(entry))
        cut.repartition(min(len(buckets), entry["buckets"]), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(root)
        written = self.versions.spark.read.schema(T.StructType([T.StructField("bucket", T.IntegerType())])).option("basePath", root).parquet(root)
        rows = {r["bucket"]: r["n"] for r in written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()} if self.versions.names(self.name, f"v{version}") != ["_SUCCESS"] else {}
        at = {b: v for b, v in entry["at"].items() if int(b) not in buckets} | {str(b): version for b in rows}
        kept = {b: n for b, n in entry["rows"].items() if int(b) not in buckets} | {str(b): n for b, n in rows.items()}
        return {"buckets": entry["buckets"], "at": at, "rows": kept}
