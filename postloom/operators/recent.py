"""Which accesses hit a least-recently-used cache of a given capacity, exactly and in parallel.

The accesses are cut into blocks of consecutive places. What a cache holds at the start of a block is the last
``capacity`` different keys before it, and that can be put together from pieces of bounded size: the keys of a stretch in
the order of their last use, at most ``capacity`` of them. Two neighbouring pieces merge into one of the same bound, so a
prefix scan of doubling steps gives every block its starting cache, and the blocks are then replayed independently.

Defined results: null keys are no accesses and are left out; a capacity below 1 is an error; an empty table gives no rows.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.operators.store import numbered
from postloom.runtime import materialize

CAPACITY = 50_000


def lru_hits(accesses: DataFrame, key: str, order: Sequence[str], capacity: int = CAPACITY, block: int | None = None) -> DataFrame:
    """``accesses`` with ``place`` (from 1) and ``hit``. ``order`` must be a total order of the rows."""
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    size = block or max(1000, capacity)
    placed = materialize(numbered(accesses.filter(F.col(key).isNotNull()), order, "place").withColumn("block", F.floor((F.col("place") - 1) / size)), "accesses")
    last = Window.partitionBy("block").orderBy(F.col("at").desc())
    used = placed.groupBy("block", F.col(key).alias("k")).agg(F.max("place").alias("at")).withColumn("r", F.row_number().over(last)).filter(F.col("r") <= capacity)
    # most recently used first
    piece = used.groupBy("block").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "k"))), lambda x: x["k"]).alias("keys"))
    state = materialize(piece, "pieces")
    blocks = int(state.agg(F.coalesce(F.max("block"), F.lit(-1))).first()[0]) + 1
    step = 1
    while step < blocks:
        older = state.select((F.col("block") + step).alias("block"), F.col("keys").alias("older"))
        merged = F.slice(F.array_distinct(F.concat("keys", F.coalesce("older", F.array().cast("array<string>")))), 1, capacity)
        state = materialize(state.withColumn("keys", F.col("keys").cast("array<string>")).join(older, "block", "left").select("block", merged.alias("keys")), "pieces")
        step *= 2
    start = state.select((F.col("block") + 1).alias("block"), F.col("keys").cast("array<string>").alias("keys"))
    rows = placed.select("block", "place", F.col(key).cast("string").alias("k"))

    def replay(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        cache: OrderedDict[str, None] = OrderedDict.fromkeys(reversed(list(right["keys"].iloc[0]))) if len(right) else OrderedDict()
        left = left.sort_values("place")
        hits = []
        for k in left["k"]:
            hit = k in cache
            if hit:
                cache.move_to_end(k)
            else:
                cache[k] = None
                if len(cache) > capacity:
                    cache.popitem(last=False)
            hits.append(hit)
        return pd.DataFrame({"place": left["place"].to_numpy(), "hit": hits})

    schema = T.StructType([T.StructField("place", T.LongType()), T.StructField("hit", T.BooleanType())])
    hits = rows.groupBy("block").cogroup(start.groupBy("block")).applyInPandas(replay, schema)
    return placed.drop("block").join(hits, "place")
