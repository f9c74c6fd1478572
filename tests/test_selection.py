import numpy as np
import pandas as pd
import pytest

from swayline.operators import selection


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(2)
    n = 400
    a, b = rng.normal(size=n), rng.normal(size=n)
    p = pd.DataFrame({"early": rng.integers(0, 9, n), "late": rng.integers(0, 9, n), "a": a, "a_copy": a + 0.05 * rng.normal(size=n),
                      "b": b, "flat": np.ones(n)})
    p["total"] = p.early + p.late
    p["treatment"] = rng.integers(0, 2, n)
    p["y"] = (a + rng.normal(size=n) > 0).astype(int)
    return p


FEATURES = ["early", "late", "a", "a_copy", "b", "flat", "total"]


def matrix(spark, table):
    m = selection.moments(spark.createDataFrame(table), [*FEATURES, "y", "treatment"])
    return m, selection.correlation_table(spark, m)


def test_correlations(spark, table):
    _, corr = matrix(spark, table)
    want = table[[*FEATURES, "y", "treatment"]].corr()
    for r in corr.collect():
        w = want.loc[r["feature_1"], r["feature_2"]]
        assert (r["corr"] is None and np.isnan(w)) or r["corr"] == pytest.approx(w, abs=1e-12)


def test_pairs_targets_and_drops(spark, table):
    _, corr = matrix(spark, table)
    pairs = selection.redundant_pairs(corr, FEATURES, 0.6).collect()
    want = table[FEATURES].corr().abs()
    assert {(r[0], r[1]) for r in pairs} == {
        (x, y) for i, x in enumerate(FEATURES) for y in FEATURES[i + 1:] if want.loc[x, y] > 0.6}
    assert [r[2] for r in pairs] == sorted([r[2] for r in pairs], reverse=True)
    target = selection.target_correlation(corr, FEATURES).collect()
    assert target[0]["feature"] in ("a", "a_copy") and target[-1]["feature"] == "flat"
    assert selection.redundant_pairs(corr, FEATURES, 0.9999).count() == 0
    assert selection.features_to_drop(corr, FEATURES, threshold=0.9999) == []


def test_greedy_rules():
    drops = selection.greedy_drops([("a", "b", 0.99), ("b", "c", 0.95), ("c", "d", 0.9)], {"a": 0.1, "b": 0.3, "c": 0.3, "d": None})
    assert drops == ["a", "c"]  # a weaker; tie drops the second (c); then c is gone already
    assert selection.greedy_drops([("x", "z", 0.9)], {"x": 0.1, "z": None}) == ["z"]
    assert selection.greedy_drops([], {}) == []


def test_vif(spark, table):
    m, _ = matrix(spark, table)
    rows = {r["feature"]: r for r in selection.vif(spark, m, FEATURES).collect()}
    assert {f for f in FEATURES if rows[f]["is_collinear"]} == {"early", "late", "total"}
    kept = ["early", "late", "a", "a_copy", "b", "flat"]
    got = {r["feature"]: r["vif"] for r in selection.vif(spark, m, kept).collect()}
    x = table[kept].values.astype(float)
    for i, f in enumerate(kept):
        rest = np.delete(x, i, axis=1)
        fit = rest @ np.linalg.lstsq(rest, x[:, i], rcond=None)[0]
        r2 = 1 - ((x[:, i] - fit) ** 2).sum() / (x[:, i] ** 2).sum()
        assert got[f] == pytest.approx(1 / (1 - r2), rel=1e-8)


def test_summary_and_candidates(spark, table):
    m, corr = matrix(spark, table)
    s = selection.selection_summary(spark, corr, m, FEATURES, threshold=0.6).first()
    assert s["n_features"] == 7 and s["n_vif_high"] >= 3
    assert s["n_dropped"] == len(selection.features_to_drop(corr, FEATURES, threshold=0.6))
    cand = selection.interaction_candidates(corr, FEATURES, threshold=0.0, limit=3).collect()
    assert len(cand) == 3 and cand[0]["abs_corr"] >= cand[1]["abs_corr"]


def test_missing_values_count_as_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 4.0), (3.0, None)], "a double, b double")
    m = selection.moments(df, ["a", "b"])
    assert m.mean.tolist() == pytest.approx([4 / 3, 2.0])
    np.testing.assert_allclose(m.gram(["a", "b"]), np.array([[10.0, 2.0], [2.0, 20.0]]))
