"""Where intermediate tables live, and how lineage is cut.

Everything that has to outlive an executor is written to the folder that the cluster names in
``spark.checkpoint.dir``. A folder of our own is chosen only where that setting is unset, as in tests.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which a table may be broadcast. Sizes are measured, never assumed.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. On a cluster it must be named: a folder of one machine would hold a part of a table."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (spark.conf.get("spark.master", None) or spark.sparkContext.master).startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="postloom-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return "file://" + _OWN[app]


def own_dir(spark: SparkSession) -> str:
    """Where this application's intermediate tables are."""
    return f"{shared_dir(spark)}/postloom/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once the results that are read from them are no longer needed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(own_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again: the lineage ends there, so a lost
    executor costs a read and not the work before it."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES, unpacked: bool = False) -> bool:
    """Whether ``df`` (a materialized table) has at most ``max_rows`` rows and ``max_bytes`` bytes as stored, and if
    ``unpacked`` also as its rows take in memory: long texts that repeat themselves are stored in a twentieth of that."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > max_bytes or df.limit(max_rows + 1).count() > max_rows:
        return False
    if not unpacked:
        return True
    row = F.octet_length(F.to_json(F.struct(*df.columns))) + 8 * (len(df.columns) + 2)  # a word a column, two a row
    return (df.agg(F.sum(row)).first()[0] or 0) <= max_bytes


def semi_or_salted(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left_semi", salts: int = 32, salt_by: Column | None = None, max_rows: int = BROADCAST_ROWS, unpacked: bool = False
) -> DataFrame:
    """Join a large, possibly skewed ``left`` with a ``right`` that holds each key once or a few times.

    ``right`` is broadcast if it is proven small (``unpacked``: see :func:`is_small`); otherwise the left rows of each key are spread over
    ``salts`` parts and ``right`` is repeated once per part, so that one hot key is no single task."""
    if is_small(right, max_rows, unpacked=unpacked):
        return left.join(F.broadcast(right), keys, how)
    salt_by = salt_by if salt_by is not None else F.xxhash64(*left.columns)
    spread = left.withColumn("_salt", F.pmod(salt_by, F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [*keys, "_salt"], how).drop("_salt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
