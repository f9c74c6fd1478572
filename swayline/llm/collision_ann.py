"""Approximate nearest neighbours by collision counting.

Every shard keeps the projections of its vectors on ``projections`` random lines. A query's window on a line is centred on its own
projection and widens by virtual rehashing: the half width grows by ``ratio``. Windows end up holding most of a shard, so collisions
are counted line by line in one sweep of the gaps between projections, which costs a fraction of merging sorted runs. A vector that collides with the query on more than ``threshold`` of the lines is verified by its exact score. A query
ends when its k-th best verified vector lies within the radius that the windows stand for, or all vectors were verified.

Nearness is the largest inner product. It is the smallest distance once every vector gets one more component, which lifts its
length to the longest of the shard; a query's is 0 and queries are scaled to length 1, which changes no order. Scores are inner
products of the original vectors in double precision. Lines are drawn from a fixed seed, the same for all shards.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows without a key, take no part. Rows with a
query's key are not its candidates.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swayline.llm.vector_blocks import search, top, usable


class CollisionIndex:
    def __init__(self, shard: np.ndarray, projections: int, seed: int = 7):
        self.shard = shard
        lengths = np.einsum("ij,ij->i", shard, shard)
        self.longest = float(np.sqrt(lengths.max()))
        lifted = np.column_stack([shard, np.sqrt(np.maximum(self.longest ** 2 - lengths, 0.0))]) / self.longest
        self.lines = np.random.default_rng(seed).standard_normal((shard.shape[1] + 1, projections))
        self.at = np.ascontiguousarray((lifted @ self.lines).T, np.float32)  # line, vector

    def search(self, queries: np.ndarray, own: np.ndarray, keys: np.ndarray, k: int, width: float, ratio: float, threshold: float,
               reach: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """``reach``: half width on a line that stands for distance 1."""
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        at, need = (unit @ self.lines[:-1]).astype(np.float32), int(np.ceil(threshold * len(self.at)))
        gap, inside = np.empty_like(self.at), np.empty(self.at.shape, bool)
        count, held = np.uint8 if len(gap) < 256 else np.int64, np.empty_like(self.shard)
        found = []
        for i, query in enumerate(queries):
            np.abs(np.subtract(self.at, at[i][:, None], out=gap), out=gap)
            half, verified = width, np.zeros(gap.shape[1], bool)
            rows, scores = np.empty(0, np.int64), np.empty(0)
            while True:
                hits = np.add.reduce(np.less_equal(gap, np.float32(half), out=inside).view(np.uint8), axis=0, dtype=count)
                more = np.flatnonzero((hits >= need) & ~verified)
                if len(more):
                    verified[more] = True
                    more = more[keys[more] != own[i]]
                    rows = np.concatenate([rows, more])
                    scores = np.concatenate([scores, np.einsum("ij,j->i", np.take(self.shard, more, axis=0, out=held[:len(more)], mode="clip"), query)])
                    best = top(scores, keys[rows], k)
                    rows, scores = rows[best], scores[best]
                if len(rows) >= k:
                    # distance between unit query and lifted vector over the longest length
                    nearness = scores[-1] / (np.linalg.norm(query) * self.longest)
                    if np.sqrt(max(0.0, 2 - 2 * nearness)) <= half / reach:
                        break
                if hits.min() == len(gap):  # the windows hold the shard
                    break
                half *= ratio
            found.append((rows, scores))
        return found


def nearest(rows: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20, projections: int = 40,
            width: float = 0.4, ratio: float = 1.3, threshold: float = 0.5, reach: float = 0.9, **blocks) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (double). ``is_query`` speaks of the column ``key``."""

    def best(queries: np.ndarray, own: np.ndarray, shard: np.ndarray, keys: np.ndarray):
        found = CollisionIndex(shard, projections).search(queries, own, keys, k, width, ratio, threshold, reach)
        return (np.repeat(np.arange(len(queries)), [len(f[0]) for f in found]), np.concatenate([f[0] for f in found]),
                np.concatenate([f[1] for f in found]))

    chosen = usable(rows, key, vector).filter(F.exists("vector", lambda x: x != 0))
    return search(chosen, is_query, best, k, "double", **blocks)
