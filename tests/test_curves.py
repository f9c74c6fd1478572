"""Curves against their prefix-by-prefix definitions and against NumPy forms of the published metrics."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from swayline.config import CurveConfig
from swayline.operators import curves
from swayline.operators.curves import ScoreColumns

CFG = CurveConfig(rows_per_bucket=30)


def frame(n=300, seed=3):
    rng = np.random.default_rng(seed)
    return pd.DataFrame({"member_id": rng.permutation(n), "y": rng.integers(0, 2, n), "treatment": rng.integers(0, 2, n),
                         "uplift": rng.integers(-12, 12, n) / 16.0})


def ordered(p, descending=True):
    return p.sort_values(["uplift", "member_id"], ascending=[not descending, True]).reset_index(drop=True)


def prefix_gains(q):
    rows = []
    for k in range(1, len(q) + 1):
        s = q.iloc[:k]
        t, c = s[s.treatment == 1], s[s.treatment == 0]
        prevented = (c.y.mean() - t.y.mean()) * len(t) if len(t) and len(c) else 0.0
        added = t.y.sum() - (c.y.sum() * len(t) / len(c) if len(c) else 0.0)
        rows.append((k, prevented, added, t.y.sum() - c.y.sum() * len(t) / max(len(c), 1), s.uplift.mean()))
    return np.array(rows)


@pytest.mark.parametrize("descending", [True, False])
def test_three_gain_curves(spark, descending):
    p = frame()
    df = spark.createDataFrame(p)
    want = prefix_gains(ordered(p, descending))
    a = curves.prevented_curve(df, descending=descending, cfg=CFG).toPandas().sort_values("k")
    b = curves.qini_gain_curve(df, descending=descending, cfg=CFG).toPandas().sort_values("k")
    c = curves.qini_cumulative_curve(df, descending=descending, cfg=CFG).toPandas().sort_values("k")
    np.testing.assert_allclose(a.qini_gain, want[:, 1], atol=1e-9)
    np.testing.assert_allclose(b.qini_gain, want[:, 2], atol=1e-9)
    np.testing.assert_allclose(c.qini, want[:, 3], atol=1e-9)
    np.testing.assert_allclose(b.avg_uplift, want[:, 4], atol=1e-9)
    np.testing.assert_allclose(b.pct_targeted, want[:, 0] * 100 / len(p))
    t, u = p[p.treatment == 1].y, p[p.treatment == 0].y
    total = (u.mean() - t.mean()) * len(t)
    assert a.qini_gain.iloc[-1] == pytest.approx(total) and a.random_gain.iloc[-1] == pytest.approx(total)


def test_auuc(spark):
    p = frame(seed=8)
    want = prefix_gains(ordered(p))
    t, c = p[p.treatment == 1].y, p[p.treatment == 0].y
    total = (c.mean() - t.mean()) * len(t)
    area = np.trapezoid(want[:, 1] - want[:, 0] / len(p) * total, want[:, 0]) / len(p)
    got = curves.auuc(spark.createDataFrame(p), cfg=CFG).first()
    assert got["auuc"] == pytest.approx(area) and got["total_gain"] == pytest.approx(total) and got["n"] == len(p)


def test_curves_while_an_arm_is_empty(spark):
    rows = [(1, 1, 1, 0.9), (2, 1, 1, 0.8), (3, 1, 0, 0.7), (4, 0, 0, 0.6)]
    df = spark.createDataFrame(rows, "member_id long, y int, treatment int, uplift double")
    a = curves.prevented_curve(df).orderBy("k").toPandas()
    b = curves.qini_gain_curve(df).orderBy("k").toPandas()
    assert a.qini_gain.tolist() == [0.0, 0.0, 0.0, -1.0]
    assert b.qini_gain.tolist() == [1.0, 2.0, 0.0, 1.0]
    best = curves.optimal_target(df).first()
    assert (best["optimal_n"], best["max_qini_gain"], best["pct_targeted"]) == (2, 2.0, 50.0)
    assert curves.optimal_target(df, max_budget_n=1).first()["optimal_n"] == 1
    one_arm = df.filter("treatment = 1")
    assert curves.qini_auc(one_arm).first()["qini_auc"] is None
    assert curves.auuc(one_arm).first()["auuc"] is None


def test_optimal_target_takes_the_first_of_equal_gains(spark):
    rows = [(1, 1, 1, 0.9), (2, 0, 1, 0.8), (3, 0, 0, 0.7)]
    df = spark.createDataFrame(rows, "member_id long, y int, treatment int, uplift double")
    assert curves.optimal_target(df).first()["optimal_n"] == 1


def numpy_qini_auc(y, score, t):
    def curve(s):
        order = np.argsort(-s, kind="stable")
        s, yy, tt = s[order], y[order], t[order]
        last = np.r_[np.where(np.diff(s))[0], len(s) - 1]
        x = last + 1.0
        nt, yt, yc = np.cumsum(tt)[last], np.cumsum(yy * tt)[last], np.cumsum(yy * (1 - tt))[last]
        nc = x - nt
        q = yt - yc * np.divide(nt, nc, out=np.zeros(len(x)), where=nc != 0)
        return np.r_[0, x], np.r_[0, q]

    x, q = curve(score)
    px, pq = curve(y * t - y * (1 - t))
    base = px[-1] * pq[-1] / 2
    return (np.trapezoid(q, x) - base) / (np.trapezoid(pq, px) - base)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_qini_auc(spark, seed):
    p = frame(800, seed)
    got = curves.qini_auc(spark.createDataFrame(p), cfg=CFG).first()["qini_auc"]
    assert got == pytest.approx(numpy_qini_auc(p.y.values, p.uplift.values, p.treatment.values), abs=1e-12)


def test_perfect_ranking_scores_one_and_order_of_rows_is_irrelevant(spark):
    p = frame(500, 4)
    p["uplift"] = (p.y * p.treatment - p.y * (1 - p.treatment)).astype(float)
    df = spark.createDataFrame(p)
    assert curves.qini_auc(df, cfg=CFG).first()["qini_auc"] == pytest.approx(1.0)
    q = frame(500, 4)
    one = curves.qini_auc(spark.createDataFrame(q), cfg=CFG).first()["qini_auc"]
    two = curves.qini_auc(spark.createDataFrame(q.sample(frac=1, random_state=1)), cfg=CurveConfig(rows_per_bucket=97)).first()["qini_auc"]
    assert one == pytest.approx(two, abs=1e-14)


def test_roc_auc_and_its_mirror(spark):
    p = frame(600, 5)
    df = spark.createDataFrame(p).withColumn("neg", -F.col("uplift"))
    pos, neg = p[p.y == 1].uplift.values, p[p.y == 0].uplift.values
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    a = curves.roc_auc(df, "uplift", "y", cfg=CFG).first()["roc_auc"]
    b = curves.roc_auc(df, "neg", "y", cfg=CFG).first()["roc_auc"]
    assert a == pytest.approx(want) and a + b == pytest.approx(1.0)
    assert curves.roc_auc(df.filter("y = 1"), "uplift", "y").first()["roc_auc"] is None


def test_classification_report(spark):
    rows = [(0.9, 1)] * 3 + [(0.8, 0)] * 2 + [(0.1, 1)] * 1 + [(0.2, 0)] * 4
    got = {r["label"]: r for r in curves.classification_report(spark.createDataFrame(rows, "s double, y int"), "s", "y").collect()}
    assert got["1"]["precision"] == pytest.approx(0.6) and got["1"]["recall"] == pytest.approx(0.75)
    assert got["0"]["precision"] == pytest.approx(0.8) and got["0"]["support"] == 6
    assert got["accuracy"]["f1"] == pytest.approx(0.7)
    assert got["macro avg"]["recall"] == pytest.approx((0.75 + 4 / 6) / 2)
    assert got["weighted avg"]["precision"] == pytest.approx(0.6 * 0.4 + 0.8 * 0.6)


def test_worth_targeting_direction(spark):
    df = spark.createDataFrame([(1, -0.5), (2, -0.1), (3, 0.4)], "member_id long, uplift double")
    bad = curves.worth_targeting(df, 10.0, 2.0).orderBy("rank").collect()
    good = curves.worth_targeting(df, 10.0, 2.0, outcome_is_bad=False).collect()
    assert [r["member_id"] for r in bad] == [1] and [r["member_id"] for r in good] == [3]


def test_rank_first_n(spark):
    p = frame(400, 6)
    got = curves.rank_members(spark.createDataFrame(p), descending=False, first=25, cfg=CFG).orderBy("rank").toPandas()
    assert got["rank"].tolist() == list(range(1, 26))
    assert got.member_id.tolist() == ordered(p, False).member_id.tolist()[:25]
    assert curves.rank_members(spark.createDataFrame(p), first=0, cfg=CFG).count() == 0


member = st.tuples(st.integers(0, 1), st.integers(0, 1), st.sampled_from([-1.0, -0.5, 0.0, 0.5, 1.0]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(member, min_size=2, max_size=40), size=st.integers(2, 20))
def test_any_small_table(spark, rows, size):
    p = pd.DataFrame([(i, *r) for i, r in enumerate(rows)], columns=["member_id", "y", "treatment", "uplift"])
    got = curves.qini_gain_curve(spark.createDataFrame(p), cfg=CurveConfig(rows_per_bucket=size)).toPandas().sort_values("k")
    np.testing.assert_allclose(got.qini_gain, prefix_gains(ordered(p))[:, 2], atol=1e-9)


def test_other_column_names(spark):
    p = frame(100, 9).rename(columns={"y": "churn", "treatment": "outreach", "uplift": "score", "member_id": "id"})
    cols = ScoreColumns("score", "churn", "outreach", "id")
    assert curves.auuc(spark.createDataFrame(p), cols, cfg=CFG).first()["n"] == 100


def test_class_report_keeps_rows_without_a_score(spark):
    df = spark.createDataFrame([(0.9, 1), (None, 1), (float("nan"), 0), (0.2, 0), (0.7, 0)], "score double, label int")
    rows = {r["label"]: r for r in curves.classification_report(df, "score", "label").collect()}
    assert rows["1"]["support"] == 2 and rows["0"]["support"] == 3 and rows["accuracy"]["support"] == 5
    assert rows["1"]["recall"] == 0.5 and rows["0"]["precision"] == pytest.approx(2 / 3)
