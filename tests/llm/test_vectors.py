import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from swayline.llm import collision_ann, maxscore
from swayline.llm.queries import op10_collision_ann

SCHEMA = "vec_id long, embedding array<float>, label int, key long, vector string, shard int, rank int, score double"


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, "v", 2, 3, 0.5)
                                  for i, v in vectors], SCHEMA)


def sample(n, dims=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    v = (centres[rng.integers(0, 6, n)] + 0.4 * rng.normal(size=(n, dims))).astype(np.float32)
    return [(i, (x / np.linalg.norm(x)).tolist()) for i, x in enumerate(v)]


AWKWARD = [(1000, None), (1001, []), (1002, [0.1] * 15 + [None]), (1003, [float("nan")] * 16), (1004, [float("inf")] + [0.0] * 15),
           (1005, [0.0] * 16), (None, [0.1] * 16), (1006, [0.25] * 16), (1007, [0.25] * 16), (1008, [0.25] * 16), (1008, [0.25] * 16),
           (1050, [0.25] * 16), (1050, [0.5] * 16), (1100, [0.1, 0.2])]


def clean(vectors, zero):
    out = []
    for i, v in vectors:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or zero and not any(v):
            continue
        out.append((i, np.array(v, np.float32).astype(np.float64)))
    return out


def brute(vectors, step, k, turn):
    for qi, q in vectors:
        if qi % step == 0:
            yield qi, sorted((-float(turn(q) @ turn(v)), i) for i, v in vectors if i != qi and len(v) == len(q))[:k]


def test_maxscore_is_exact(spark):
    vectors = sample(900)
    for blocks in ({}, {"shard_rows": 100, "group_queries": 4}):
        got = maxscore.exact_top_k(table(spark, vectors), F.col("key") % 50 == 0, **blocks).collect()
        want = {(q, n, i, -int(s)) for q, best in brute(clean(vectors, False), 50, 5, lambda v: np.floor(256 * v))
                for n, (s, i) in enumerate(best, 1)}
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_maxscore_ties_and_awkward(spark):
    vectors = sample(60) + AWKWARD
    got = maxscore.exact_top_k(table(spark, vectors), F.col("key") % 50 == 0, shard_rows=20).collect()
    ranks = Counter((r["query_id"], r["rank"]) for r in got)
    assert set(ranks.values()) == {1}
    by_query = {}
    for r in got:
        by_query.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    for qi, best in brute(clean([v for v in vectors if v[0] != 1050], False), 50, 5, lambda v: np.floor(256 * v)):
        if qi in (0, 50):
            continue
        assert [(s, i) for _, s, i in sorted(by_query.get(qi, []))] == [(int(s), i) for s, i in best]
    assert 1100 not in by_query  # no other vector of its length
    assert all(i not in (1000, 1001, 1002, 1003, 1004) for b in by_query.values() for _, _, i in b)


@pytest.mark.parametrize("find", [maxscore.exact_top_k, collision_ann.nearest])
def test_a_repeated_query_asks_once(spark, find):
    vectors = sample(200)
    want = find(table(spark, vectors), F.col("key") % 100 == 0).collect()
    got = find(table(spark, vectors + [vectors[100]] * 3), F.col("key") % 100 == 0).filter("query_id = 100").collect()
    assert sorted(r for r in want if r["query_id"] == 100) == sorted(got)


def test_maxscore_few_and_none(spark):
    got = maxscore.exact_top_k(table(spark, [(0, [0.5, -0.25]), (3, [0.1, 0.2])]), F.col("key") % 50 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 3, 128 * 25 + -64 * 51)]
    assert maxscore.exact_top_k(table(spark, []), F.col("key") % 50 == 0).count() == 0
    assert maxscore.exact_top_k(table(spark, [(1, [0.5])]), F.col("key") % 50 == 0).count() == 0


@pytest.mark.parametrize("blocks", [{}, {"shard_rows": 300, "group_queries": 16}])
def test_nearest_recall_and_scores(spark, blocks):
    vectors = sample(1500, 24, 2)
    got = collision_ann.nearest(table(spark, vectors), F.col("key") % 20 == 0, **blocks).collect()
    dense = np.stack([v for _, v in clean(vectors, True)])
    hits = total = 0
    for q in range(0, 1500, 20):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 21)) and all(m[1] != q for m in mine)
        assert np.allclose([m[2] for m in mine], dense[[m[1] for m in mine]] @ dense[q], rtol=0, atol=1e-12)
        scores = dense @ dense[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:20]) & {m[1] for m in mine})
        total += 20
    assert hits >= 0.9 * total


def test_nearest_of_unequal_lengths(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, (v * s).tolist()) for (i, v), s in zip([(i, np.array(v)) for i, v in sample(800, 16, 3)], rng.uniform(0.2, 3, 800))]
    got = collision_ann.nearest(table(spark, vectors), F.col("key") % 20 == 0).collect()
    dense = np.stack([v for _, v in clean(vectors, True)])
    hits = 0
    for q in range(0, 800, 20):
        scores = dense @ dense[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:20]) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits >= 0.9 * 40 * 20


def test_nearest_awkward(spark):
    got = collision_ann.nearest(table(spark, AWKWARD), F.col("key") % 50 == 0).collect()
    # 1050 stands there twice, so it asks with two vectors; 1100 has another length than all others and finds nothing.
    assert {r["query_id"] for r in got} == {1050}
    want = [(0.25 * 0.25 * 16, i) for i in (1006, 1007, 1008, 1008)] + [(0.25 * 0.5 * 16, i) for i in (1006, 1007, 1008, 1008)]
    assert sorted((r["score"], r["vec_id"]) for r in got) == sorted(want)
    assert collision_ann.nearest(table(spark, []), F.col("key") % 20 == 0).count() == 0


def test_repeats_of_a_row_are_spread(spark):
    from swayline.llm import vector_blocks
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("key"), F.array(F.lit(1.0)).alias("vector"),
                                    F.monotonically_increasing_id().alias("number"))
    sizes = [r["count"] for r in vector_blocks.dealt(rows, 10).groupBy("shard").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 400


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_on_whole_tables(spark, folder):
    got = op10_collision_ann(spark, f"/root/testdata/{folder}").collect()
    rows = sorted(spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet").select("vec_id", "embedding").collect())
    keys, dense = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows])
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = total = 0
    for place in np.flatnonzero(keys % 20 == 0):
        scores = dense @ dense[place]
        scores[place] = -np.inf
        best = set(keys[np.argsort(-scores, kind="stable")[:20]].tolist())
        hits += len(best & found[keys[place]])
        total += 20
    print(folder, hits / total)
    assert hits >= 0.95 * total


def test_a_search_holds_the_counts_of_one_query_at_a_time():
    """Collisions are counted in one sweep, with the same rows in reach as by sorted windows, and memory does not follow the queries."""
    rng = np.random.default_rng(9)
    shard, keys = rng.standard_normal((600, 8)), np.arange(600)
    index = collision_ann.CollisionIndex(shard, 12)
    peaks = []
    for n in (60, 600):
        tracemalloc.start()
        found = index.search(shard[:n], keys[:n], keys, 5, 0.4, 1.3, 0.5, 0.9)
        peaks.append(tracemalloc.get_traced_memory()[1] - sum(r.nbytes + s.nbytes for r, s in found))
        tracemalloc.stop()
    assert peaks[1] - peaks[0] < 540 * 600  # less than a byte for each further query and row
    lifted = np.column_stack([shard, np.sqrt(np.maximum(index.longest ** 2 - (shard ** 2).sum(axis=1), 0))]) / index.longest
    lines = np.random.default_rng(7).standard_normal((9, 12))
    gaps = np.abs(lifted @ lines - (shard[3] / np.linalg.norm(shard[3])) @ lines[:-1])
    half, scores = 0.4, shard @ shard[3]
    while True:  # by sorting
        met = np.flatnonzero((np.sort(gaps, axis=1)[:, 5] <= half) & (keys != 3))
        best = met[np.argsort(-scores[met], kind="stable")[:5]]
        if len(best) == 5 and np.sqrt(max(0, 2 - 2 * scores[best[-1]] / np.linalg.norm(shard[3]) / index.longest)) <= half / 0.9 or half > gaps.max():
            break
        half *= 1.3
    assert found[3][0].tolist() == best.tolist()
