"""Exact top-k search by MaxScore over integer vectors.

A vector's components are its terms, floor(``scale`` * x) their impacts. Within a shard a term contributes q * x, at least its
smallest contribution there (of that all are relieved) and at most its largest: its bound. Terms are split by bound: while the
bounds of the smallest together cannot lift a row from nothing over the k-th best score known, they are non-essential. The
postings of essential terms are traversed for all rows; then the others are probed, largest bound first, only for rows that the
remaining bounds could still lift to the k-th best. The k-th best starts from the rows best on the largest terms and rises.
Shards are merged by rank. Scores are integers in double precision and exact below 2 ** 53.

Vectors that are null, empty, or hold null or non-finite components, and rows without a key, take no part. Rows with a query's
key are not its candidates; a key that occurs twice is two candidates, and as a query asks once for each distinct vector.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swayline.llm.vector_blocks import search, top, usable

PROBED = 4  # non-essential terms probed between two looks at the bounds


def _maxscore(query: np.ndarray, postings: np.ndarray, low: np.ndarray, high: np.ndarray, allowed: np.ndarray, keys: np.ndarray,
              k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best allowed rows. ``postings``: term by row; ``low``, ``high``: each term's extremes."""
    least = np.minimum(query * low, query * high)
    bound = np.maximum(query * low, query * high) - least
    order = np.argsort(-bound, kind="stable")          # largest bound first
    rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0.0)  # rest[i]: what terms i.. can add
    floor = least.sum()
    head = max(1, len(order) // 4)
    partial = query[order[:head]] @ postings[order[:head]] - least[order[:head]].sum()
    partial[~allowed] = -1.0
    k = min(k, int(allowed.sum()))
    if not k:
        return np.empty(0, np.int64), np.empty(0)
    seeds = np.argpartition(-partial, k - 1)[:k]
    known = (query @ postings[:, seeds]).min() - floor  # k rows reach this
    essential = min(len(order), max(head, int(np.searchsorted(-rest, -known, side="right"))))  # terms from here on cannot reach it
    if essential > head:
        more = order[head:essential]
        partial += query[more] @ postings[more] - least[more].sum()
    rows = np.flatnonzero(allowed & (partial + rest[essential] >= known))
    partial, at = partial[rows], essential
    while at < len(order) and len(rows):
        some = order[at:at + PROBED]
        partial = partial + query[some] @ postings[np.ix_(some, rows)] - least[some].sum()
        at += len(some)
        if len(rows) > k:
            known = max(known, np.partition(partial, len(rows) - k)[len(rows) - k])
        competitive = partial + rest[at] >= known
        rows, partial = rows[competitive], partial[competitive]
    best = top(partial, keys[rows], k)
    return rows[best], partial[best] + floor


def exact_top_k(rows: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256,
                **blocks) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (long). ``is_query`` speaks of the column ``key``."""

    def best(queries: np.ndarray, own: np.ndarray, shard: np.ndarray, keys: np.ndarray):
        postings = np.ascontiguousarray(shard.T)
        low, high = postings.min(axis=1), postings.max(axis=1)
        found = [_maxscore(q, postings, low, high, keys != mine, keys, k) for q, mine in zip(queries, own)]
        return (np.repeat(np.arange(len(queries)), [len(f[0]) for f in found]), np.concatenate([f[0] for f in found]),
                np.concatenate([f[1] for f in found]).astype(np.int64))

    terms = usable(rows, key, vector).select("key", F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x).cast("double")).alias("vector"))
    return search(terms, is_query, best, k, "long", **blocks)
