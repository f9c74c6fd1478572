import math

import numpy as np
import pandas as pd
import pytest

from swayline.functions.tdist import regularised_beta, two_sided_p
from swayline.operators import effects


def arms(n=900, seed=1):
    rng = np.random.default_rng(seed)
    return pd.DataFrame({
        "member_id": np.arange(n), "treatment": rng.integers(0, 2, n), "y": rng.integers(0, 2, n),
        "wide": rng.normal(size=n) * 9, "flag": rng.integers(0, 2, n), "flat": np.ones(n, int),
        "sparse": np.where(rng.random(n) < 0.8, 0, rng.integers(1, 9, n)), "tri": rng.integers(0, 3, n)})


FEATURES = ["wide", "flag", "flat", "sparse", "tri"]


def test_arm_differences_and_describe(spark):
    p = arms()
    df = spark.createDataFrame(p)
    means = p.groupby("treatment")[FEATURES].mean()
    rows = {r["feature"]: r for r in effects.arm_differences(df, FEATURES).collect()}
    for f in FEATURES:
        assert rows[f]["difference"] == pytest.approx(means.loc[1, f] - means.loc[0, f])
        assert rows[f]["abs_difference"] == pytest.approx(abs(means.loc[1, f] - means.loc[0, f]))
    top = [r["feature"] for r in effects.top_differences(df, FEATURES, 2).collect()]
    assert top == (means.loc[1] - means.loc[0]).abs().sort_values(ascending=False).index[:2].tolist()
    got = effects.describe(df, FEATURES, ["treatment"]).toPandas().set_index(["treatment", "feature"])
    for t in (0, 1):
        want = p[p.treatment == t][FEATURES].describe().T
        for mine, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                             ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            np.testing.assert_allclose(got.loc[t].loc[FEATURES, mine], want[theirs])


def student_tail(t, dof, steps=200_001):
    angle = np.linspace(0, math.pi / 2, steps)
    f = np.cos(angle) ** (dof - 1)
    a = math.atan(abs(t) / math.sqrt(dof))
    upper = np.linspace(a, math.pi / 2, steps)
    return np.trapezoid(np.cos(upper) ** (dof - 1), upper) / np.trapezoid(f, angle)


@pytest.mark.parametrize("t,dof", [(0.0, 5.0), (1.3, 3.7), (-2.4, 40.0), (0.2, 800.5), (5.0, 12.0), (3.1, 5000.0)])
def test_student_p_values(t, dof):
    assert two_sided_p(t, dof) == pytest.approx(student_tail(t, dof), abs=1e-8)


def test_known_p_values_and_edges():
    assert two_sided_p(12.706204736432095, 1.0) == pytest.approx(0.05, abs=1e-9)
    assert two_sided_p(2.2281388519649385, 10.0) == pytest.approx(0.05, abs=1e-9)
    assert two_sided_p(None, 3.0) is None and two_sided_p(1.0, 0.0) is None
    assert regularised_beta(2, 3, 0.0) == 0.0 and regularised_beta(2, 3, 1.0) == 1.0


def test_welch(spark):
    p = arms()
    rows = {r["feature"]: r for r in effects.welch_test(spark.createDataFrame(p), FEATURES).collect()}
    for f in ("wide", "sparse", "tri"):
        a, b = p[p.treatment == 1][f], p[p.treatment == 0][f]
        va, vb = a.var() / len(a), b.var() / len(b)
        dof = (va + vb) ** 2 / (va ** 2 / (len(a) - 1) + vb ** 2 / (len(b) - 1))
        t = (a.mean() - b.mean()) / math.sqrt(va + vb)
        assert rows[f]["t_stat"] == pytest.approx(t) and rows[f]["dof"] == pytest.approx(dof)
        assert rows[f]["p_value"] == pytest.approx(student_tail(t, dof), abs=1e-8)
    assert rows["flat"]["t_stat"] is None and not rows["flat"]["significant"]


def test_gate_and_tertiles(spark):
    df = spark.createDataFrame(arms())
    gate = {r["feature"]: r for r in effects.distinct_gate(df, FEATURES).collect()}
    kinds = {f: gate[f]["kind"] for f in FEATURES}
    assert kinds == {"wide": "numeric", "flag": "categorical", "flat": "constant", "sparse": "numeric", "tri": "categorical"}
    assert gate["sparse"]["n_distinct"] == 9
    plan = {r["feature"]: r["status"] for r in effects.segment_plan(df, FEATURES).collect()}
    assert plan == {"wide": "ok", "flag": "ok", "flat": "skipped_constant", "sparse": "skipped_ties", "tri": "ok"}


def test_segment_effects_match_pandas(spark):
    p = arms()
    got = effects.segment_effects(spark.createDataFrame(p), FEATURES).toPandas().set_index(["feature", "segment"])
    labels = {"wide": pd.qcut(p.wide, 3, labels=["Low", "Medium", "High"]).astype(str),
              "flag": p.flag.astype(float).astype(str), "tri": p.tri.astype(float).astype(str)}
    assert set(got.index.get_level_values(0)) == set(labels)
    for f, seg in labels.items():
        for s, g in p.groupby(seg):
            r = got.loc[(f, s)]
            t, c = g[g.treatment == 1].y, g[g.treatment == 0].y
            assert r.members == len(g) and r.n_treated == len(t)
            assert r.ate == pytest.approx(t.mean() - c.mean())


@pytest.mark.parametrize("values", [[1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11], [1, 1, 2, 2, 2, 3, 4, 4, 5, 9, 9, 9]])
def test_tertiles_are_closed_on_the_right(spark, values):
    p = pd.DataFrame({"x": values, "treatment": [0, 1] * 6, "y": [0, 0, 1, 1, 0, 1] * 2}) if len(values) == 12 else \
        pd.DataFrame({"x": values, "treatment": [0, 1] * 5 + [0], "y": [0, 0, 1, 1, 0] * 2 + [1]})
    got = effects.segment_effects(spark.createDataFrame(p), ["x"]).toPandas().set_index("segment")
    want = pd.qcut(p.x, 3, labels=["Low", "Medium", "High"]).value_counts()
    assert {s: got.loc[s].members for s in got.index} == want.to_dict()


def test_an_edge_that_is_a_value_belongs_below(spark):
    """Ten values: the edges are exactly the fourth and seventh, with no rounding error to push them off."""
    p = pd.DataFrame({"x": range(1, 11), "treatment": [0, 1] * 5, "y": [0, 0, 1, 1, 0] * 2})
    got = effects.segment_effects(spark.createDataFrame(p), ["x"]).toPandas().set_index("segment")
    assert got.members.to_dict() == {"Low": 4, "Medium": 3, "High": 3}


def test_segment_without_controls_is_left_out(spark):
    rows = [(0, 1, 1), (0, 0, 0), (1, 1, 1), (1, 1, 0)]
    df = spark.createDataFrame(rows, "f int, treatment int, y int")
    assert [r["segment"] for r in effects.segment_effects(df, ["f"]).collect()] == ["0.0"]


def test_planted_segment_is_found(spark):
    rng = np.random.default_rng(7)
    n = 6000
    p = pd.DataFrame({"age": rng.normal(size=n), "risk": rng.integers(0, 2, n), "treatment": rng.integers(0, 2, n)})
    p["y"] = (rng.random(n) < 0.5 - 0.35 * p.treatment * p.risk).astype(int)
    df = spark.createDataFrame(p)
    ends = {r["feature"]: r for r in effects.segment_extremes(
        effects.segment_effects(df, ["age", "risk"]), effects.average_effect(df)).collect()}
    assert ends["risk"]["best_segment"] == "1.0" and ends["risk"]["best_reported"] and ends["risk"]["best_ate"] < -0.25
    assert ends["risk"]["worst_segment"] == "0.0"


def test_extreme_ties_take_the_earlier_segment(spark):
    eff = spark.createDataFrame([("f", "High", 0.1, 5), ("f", "Low", 0.1, 6), ("f", "Medium", -0.2, 7)],
                                "feature string, segment string, ate double, members long")
    overall = spark.createDataFrame([(0.0,)], "ate double")
    r = effects.segment_extremes(eff, overall).first()
    assert (r["best_segment"], r["worst_segment"], r["worst_members"]) == ("Medium", "Low", 6)


def test_keywords_are_cleaned_like_names(spark):
    names = ["has_icd_E11_9", "has_icd_I10", "total_web_visits", "tenure_days"]
    assert effects.priority_columns(names) == names[:3]
    df = spark.createDataFrame([(0, 1), (1, 4)], "treatment int, tenure_days int")
    assert effects.priority_comparison(df, ["tenure_days"]).count() == 0
