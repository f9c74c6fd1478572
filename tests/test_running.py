"""The bucketed kernel against a plain sort, and percentiles against pandas."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from swayline.config import CurveConfig
from swayline.operators.running import (
    BUCKET, assign_buckets, bucket_count, exact_percentiles, find_cuts, running_sums,
)


def score_frame(n=4000, seed=0, tied=0.6, missing=100):
    rng = np.random.default_rng(seed)
    score = np.where(rng.random(n) < tied, 0.25, rng.integers(-40, 40, n) / 8.0)
    score[rng.choice(n, missing, False)] = np.nan
    return pd.DataFrame({"member_id": rng.permutation(n), "uplift": score, "treatment": rng.integers(0, 2, n)})


def naive(p, descending):
    q = p.sort_values(["uplift", "member_id"], ascending=[not descending, True], na_position="last").reset_index(drop=True)
    return q.assign(k=np.arange(1, len(q) + 1), nt=q.treatment.cumsum())


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("rows_per_bucket", [40, 700, 10_000_000])
def test_running_sums_equal_a_global_sort(spark, descending, rows_per_bucket):
    p = score_frame()
    got = running_sums(spark.createDataFrame(p), "uplift", {"k": F.lit(1), "nt": F.col("treatment")},
                       descending=descending, cfg=CurveConfig(rows_per_bucket=rows_per_bucket)).toPandas()
    got = got.sort_values("k").reset_index(drop=True)
    want = naive(p, descending)
    for c in ("member_id", "k", "nt"):
        assert (got[c] == want[c]).all()
    assert (got.before_nt == want.nt - want.treatment).all()


def test_up_to_keeps_the_front_of_the_order(spark):
    p = score_frame()
    df = spark.createDataFrame(p)
    cfg = CurveConfig(rows_per_bucket=100)
    got = running_sums(df, "uplift", {"k": F.lit(1)}, up_to=("k", 500), cfg=cfg).toPandas().sort_values("k")
    assert 500 <= len(got) < len(p)
    assert (got.member_id.values[:500] == naive(p, True).member_id.values[:500]).all()


def test_collapsed_ties(spark):
    p = score_frame(missing=0)
    got = running_sums(spark.createDataFrame(p), "uplift", {"k": F.lit(1), "nt": F.col("treatment")}, tie_break=None,
                       cfg=CurveConfig(rows_per_bucket=100)).toPandas().sort_values("uplift", ascending=False)
    want = p.groupby("uplift").agg(k=("member_id", "size"), nt=("treatment", "sum")).sort_index(ascending=False).cumsum()
    assert (got.k.values == want.k.values).all() and (got.nt.values == want.nt.values).all()


def test_a_dominating_score_is_spread(spark):
    """Nine of ten rows share one score, and their ids lie together: no bucket may hold them all."""
    n = 20_000
    p = pd.DataFrame({"member_id": np.arange(n), "uplift": np.where(np.arange(n) < 18_000, 0.0, np.arange(n) / 7.0)})
    df = spark.createDataFrame(p)
    cuts = find_cuts(df, "uplift", "member_id", (), CurveConfig(rows_per_bucket=1000))
    sizes = assign_buckets(df, "uplift", "member_id", cuts, True).groupBy(BUCKET).count().toPandas()["count"]
    assert sizes.sum() == n and sizes.max() < 2_500
    assert len(sizes) < 6 * 21


def test_signed_zeros_and_infinities(spark):
    n = 3000
    p = pd.DataFrame({"member_id": np.arange(n), "treatment": 1,
                      "uplift": np.select([np.arange(n) % 3 == 0, np.arange(n) % 3 == 1], [0.0, -0.0], np.arange(n) / 8.0 - 100)})
    p.loc[p.index[-40:-20], "uplift"] = np.inf
    p.loc[p.index[-20:], "uplift"] = -np.inf
    for descending in (True, False):
        got = running_sums(spark.createDataFrame(p), "uplift", {"k": F.lit(1)}, descending=descending,
                           cfg=CurveConfig(rows_per_bucket=15)).toPandas().sort_values("k")
        assert (got.member_id.values == naive(p, descending).member_id.values).all()


def test_keys_run_separately(spark):
    a, b = score_frame(seed=1, missing=0).assign(model="a"), score_frame(seed=2, missing=0).assign(model="b")
    b["uplift"] = b["uplift"] * 1000
    got = running_sums(spark.createDataFrame(pd.concat([a, b])), "uplift", {"k": F.lit(1), "nt": F.col("treatment")},
                       keys=["model"], cfg=CurveConfig(rows_per_bucket=300)).toPandas()
    for name, p in (("a", a), ("b", b)):
        mine = got[got.model == name].sort_values("k")
        assert (mine.member_id.values == naive(p, True).member_id.values).all()


def test_rows_per_bucket_are_bounded():
    for rows in (10**6, 10**9, 10**12):
        assert rows / bucket_count(rows, 8, CurveConfig()) <= CurveConfig().rows_per_bucket
    assert bucket_count(10, 8, CurveConfig()) == 8


def test_a_missing_key_is_a_group(spark):
    p = score_frame(missing=0).assign(model=lambda q: np.where(q.member_id % 3 == 0, None, "a"))
    got = running_sums(spark.createDataFrame(p), "uplift", {"k": F.lit(1)}, keys=["model"], cfg=CurveConfig(rows_per_bucket=300)).toPandas()
    for has, mine in ((True, got[got.model.notna()]), (False, got[got.model.isna()])):
        want = naive(p[p.model.notna() == has], True)
        assert (mine.sort_values("k").member_id.values == want.member_id.values).all()
    marks = exact_percentiles(spark.createDataFrame(p), ["uplift"], [(1, 2)], ["model"]).toPandas()
    assert marks.model.isna().sum() == 1 and len(marks) == 2


def test_text_ids(spark):
    p = score_frame(3000, missing=0)
    p["member_id"] = ["m" + str(i) for i in p.member_id]
    got = running_sums(spark.createDataFrame(p), "uplift", {"k": F.lit(1)}, cfg=CurveConfig(rows_per_bucket=100)).toPandas().sort_values("k")
    assert (got.member_id.values == naive(p, True).member_id.values).all()


@pytest.mark.parametrize("accuracy", [10_000, 200, 20])
def test_percentiles_are_exact_whatever_the_sketch(spark, accuracy):
    p = score_frame(5000).rename(columns={"treatment": "t"})
    p["x"] = np.random.default_rng(5).normal(size=len(p))
    p["zeros"] = np.where(np.arange(len(p)) % 10 == 0, p.x, 0.0)
    shares = [(1, 3), (2, 3), (1, 10), (0, 1), (1, 1), (1, 2)]
    got = exact_percentiles(spark.createDataFrame(p), ["uplift", "x", "zeros"], shares, ["t"], accuracy).toPandas()
    assert len(got) == 2 * 3 * len(shares)
    for (t, feature), g in got.groupby(["t", "feature"]):
        for _, r in g.iterrows():
            num, den = shares[r.share_no]
            assert r.value == pytest.approx(p[p.t == t][feature].quantile(num / den), abs=1e-12)


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_percentiles_of_tiny_and_empty_columns(spark, accuracy):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    got = exact_percentiles(df, ["a", "b"], [(1, 2), (1, 1)], accuracy=accuracy).toPandas()
    assert set(got.feature) == {"a"} and sorted(got.value) == [1.5, 2.0]
    one = exact_percentiles(df.limit(1), ["a"], [(1, 3)], accuracy=accuracy).toPandas()
    assert one.value.tolist() == [1.0]


def test_neighbouring_doubles(spark):
    df = spark.range(4000).selectExpr("id member_id", "if(id % 2 = 0, 0.3D, 0.1D + 0.2D) uplift")
    rows = running_sums(df, "uplift", {"rank": F.lit(1)}, cfg=CurveConfig(rows_per_bucket=100)).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 4001))
    high = max(r["uplift"] for r in rows)
    assert all((r["rank"] <= 2000) == (r["uplift"] == high) for r in rows)


def test_ids_that_begin_alike_are_spread(spark):
    """One score, text ids with one long beginning: ranges are cut by the ids themselves."""
    df = spark.range(3000).selectExpr("concat('MEMBER0000000000-', lpad(id, 6, '0')) member_id", "0.5D uplift")
    cuts = find_cuts(df, "uplift", "member_id", (), CurveConfig(rows_per_bucket=100))
    sizes = [r["count"] for r in assign_buckets(df, "uplift", "member_id", cuts, True).groupBy(BUCKET).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 300


def test_plan_does_not_grow_with_the_buckets(spark):
    df = spark.createDataFrame(score_frame(4000))

    def size(rows_per_bucket):
        text = running_sums(df, "uplift", {"k": F.lit(1)}, cfg=CurveConfig(rows_per_bucket=rows_per_bucket))._jdf.queryExecution().toString()
        return len(re.sub(r"#\d+L?|ranges-[0-9a-f]+|\d+", "", text))

    assert abs(size(500) - size(10)) < 300


@pytest.mark.parametrize("window_rows", [1, 20, 400])
def test_percentiles_in_rounds(spark, window_rows):
    rng = np.random.default_rng(8)
    p = pd.DataFrame({"t": np.repeat([0, 1], 2500), "heavy": np.where(rng.random(5000) < 0.7, 1.5, rng.normal(size=5000)),
                      "wide": np.exp(rng.normal(size=5000) * 20), "few": rng.integers(0, 3, 5000).astype(float)})
    p.loc[p.index[:3], "wide"] = [1e300, -1e300, 0.0]
    shares = [(1, 4), (1, 2), (3, 4), (0, 1), (1, 1), (1, 3)]
    got = exact_percentiles(spark.createDataFrame(p), ["heavy", "wide", "few"], shares, ["t"], 50, window_rows).toPandas()
    assert len(got) == 2 * 3 * len(shares)
    for r in got.itertuples():
        num, den = shares[r.share_no]
        assert r.value == pytest.approx(p[p.t == r.t][r.feature].quantile(num / den), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("top_rows", [100_000, 10])
def test_first_rows(spark, monkeypatch, top_rows):
    """The first rows of the order, found by every task or by leaving out ranges."""
    from swayline.operators import running
    monkeypatch.setattr(running, "TOP_ROWS", top_rows)
    p = score_frame()
    for descending, n in ((True, 500), (False, 500), (True, 5000), (True, 0)):
        got = running_sums(spark.createDataFrame(p), "uplift", {"k": F.lit(1), "nt": F.col("treatment")}, first=n, descending=descending,
                           cfg=CurveConfig(rows_per_bucket=100)).toPandas().sort_values("k")
        want = naive(p, descending)[:n]
        assert list(got.columns) == ["member_id", "uplift", "treatment", "k", "nt", "before_k", "before_nt"]
        assert (got.member_id.values == want.member_id.values).all() and (got.nt.values == want.nt.values).all()


@pytest.mark.parametrize("rows", [100_000, 3])
def test_percentiles_never_broadcast_the_cells(spark, tmp_path, monkeypatch, rows):
    """Limits, one row per group and column, meet the cells where these are; many limits are dealt by key."""
    from swayline.operators import running
    monkeypatch.setattr(running, "BROADCAST_ROWS", rows, raising=False)
    p = pd.DataFrame({f"c{i}": np.arange(5000) % (i + 7) for i in range(20)})
    spark.createDataFrame(p).write.parquet(str(tmp_path / "wide"))
    found = exact_percentiles(spark.read.parquet(str(tmp_path / "wide")), list(p.columns), [(1, 2)])
    assert {r["feature"]: r["value"] for r in found.collect()} == {c: p[c].median() for c in p.columns}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "BuildLeft" not in plan and ("BroadcastHashJoin" in plan) == (rows > 20)
