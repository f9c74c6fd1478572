"""Searches of a stated query set against all rows, block by block.

Rows are dealt by hash into shards of about ``shard_rows``, queries into groups of about ``group_queries``; each pair of a shard and
a group is one task's work with both sides bounded, and gives that shard's best for each query. Shards are merged by rank.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swayline.llm.common import keep

Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and ``vector`` (array of double) of the rows whose key and components are there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    values = F.transform(vector, lambda x: x.cast("double"))
    return (rows.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite & (F.size(vector) > 0))
            .select(F.col(key).cast("long").alias("key"), values.alias("vector")))


def dealt(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with a shard by their ``number``, so that repeats of a row are spread too."""
    return rows.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards)).cast("int"))


def search(rows: DataFrame, is_query: Column, best: Search, k: int, score_type: str, shard_rows: int = 8192,
           group_queries: int = 2048) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's ``k`` best rows with another key, ties to the smaller key.

    ``rows`` has ``key`` and ``vector``; ``is_query`` speaks of ``key``. ``best(queries, query keys, shard, shard keys)`` gives places
    of queries, places of rows and scores; it must hold each query's best of the shard. Vectors of another length than a query's
    cannot be compared and are left out of its candidates.
    """
    rows = keep(rows.withColumn("number", F.monotonically_increasing_id()), "vectors")  # written: a row keeps its number
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    shards, groups = max(1, -(-counts["n"] // shard_rows)), max(1, -(-counts["q"] // group_queries))
    deal = lambda n: F.pmod(F.xxhash64("key", "vector", F.lit(2)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    base = dealt(rows, shards).select("key", "vector", "shard", every(groups).alias("group"))
    asked = rows.filter(is_query).select("key", "vector").distinct().select("key", "vector", deal(groups).alias("group"), every(shards).alias("shard"))

    def pair(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(shard):
            lengths = queries["vector"].map(len)
            for size, some in queries.groupby(lengths):
                alike = shard[shard["vector"].map(len) == size].sort_values("key", kind="stable")
                if len(alike):
                    keys, own = alike["key"].to_numpy(), some["key"].to_numpy()
                    q, r, score = best(np.stack(some["vector"].to_list()), own, np.stack(alike["vector"].to_list()), keys)
                    out.append(pd.DataFrame({"query_id": own[q], "vec_id": keys[r], "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = (asked.groupBy("shard", "group").cogroup(base.groupBy("shard", "group"))
             .applyInPandas(pair, f"query_id long, vec_id long, score {score_type}"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top(scores: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to the smaller key."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((keys[places], -scores[places]))[:k]]
