import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from swayline.operators import interactions as ia, reports, splits


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    p = pd.DataFrame({"g": rng.integers(0, 2, 3000), "x": np.round(rng.normal(size=3000), 2)})
    got = reports.histogram(spark.createDataFrame(p), "x", 20, ["g"]).toPandas()
    for g, rows in got.groupby("g"):
        counts, edges = np.histogram(p[p.g == g].x, bins=20)
        mine = np.zeros(20, int)
        mine[rows.bin.values.astype(int)] = rows["count"].values
        assert (mine == counts).all()
        np.testing.assert_allclose(rows.lower, edges[rows.bin.values.astype(int)], atol=1e-12)


def test_histogram_of_one_value(spark):
    row = reports.histogram(spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double"), "x", 4).collect()
    assert [(r["bin"], r["lower"], r["count"]) for r in row] == [(2, 2.0, 2)]


def test_summary_and_percentiles(spark):
    p = pd.DataFrame({"x": np.random.default_rng(1).normal(size=501)})
    df = spark.createDataFrame(p)
    s = reports.score_summary(df, "x").first()
    assert s["std"] == pytest.approx(np.std(p.x)) and s["range"] == pytest.approx(p.x.max() - p.x.min())
    got = {r["percentile"]: r["value"] for r in reports.percentile_table(df, "x").collect()}
    assert got == pytest.approx({q: np.percentile(p.x, q) for q in (10, 25, 50, 75, 90)})


def test_propensity_by_arm(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.4), (1, 0.6), (1, 0.9)], "treatment int, propensity_score double")
    rows = {r["treatment"]: r for r in reports.propensity_by_arm(df).collect()}
    assert rows[1]["mean"] == pytest.approx(0.75) and rows[0]["mean_gap"] == pytest.approx(0.45)


def test_weights_and_clip(spark):
    df = spark.createDataFrame([(1, 0.02), (0, 0.02), (0, 0.5)], "treatment int, p double")
    t, p = F.col("treatment"), F.col("p")
    got = df.select(ia.inverse_weight(t, p), ia.inverse_weight(t, p, 0.1)).collect()
    assert [r[0] for r in got] == pytest.approx([50.0, 1 / 0.98, 2.0])
    assert [r[1] for r in got] == pytest.approx([10.0, 1 / 0.9, 2.0])
    report = {r["treatment"]: r for r in ia.weight_report(df, "p", 0.1).collect()}
    assert report[1]["clipped"] == 1 and report[0]["clipped"] == 1 and report[0]["members"] == 2


def test_doubly_robust(spark):
    df = spark.createDataFrame([(1, 1.0, 0.5, 0.2, 0.4), (0, 1.0, 0.25, 0.2, 0.4), (1, 0.0, 0.0, 0.0, 0.5)],
                               "t int, y double, p double, m0 double, m1 double")
    c = [F.col(x) for x in ("t", "y", "p", "m0", "m1")]
    got = [r[0] for r in df.select(ia.doubly_robust(*c, 0.01)).collect()]
    assert got == pytest.approx([0.2 + 0.6 / 0.5, 0.2 - 0.8 / 0.75, 0.5 - 0.5 / 0.01])


def test_verdicts(spark):
    df = spark.createDataFrame([(0.02,), (0.007,), (0.001,), (-0.5,)], "gap double")
    assert [r[0] for r in df.select(reports.overfit_class(F.col("gap"))).collect()] == ["significant", "mild", "good", "good"]


def test_relative_gap_with_zero_train_area(spark):
    per = spark.createDataFrame([("train", 0.0), ("test", 0.1)], "split string, qini_auc double")
    r = reports.gap_report(per, []).first()
    assert r["relative_pct"] is None and r["gap"] == pytest.approx(-0.1)


def test_improvement(spark):
    df = spark.createDataFrame([(0.5, 0.6), (0.0, 0.2), (-0.5, -0.4)], "b double, t double")
    cols = reports.improvement(F.col("b"), F.col("t"))
    assert [r[0] for r in df.select(cols["pct_improvement"]).collect()] == pytest.approx([20.0, 0.0, 20.0])


def test_parameter_importance(spark):
    df = spark.createDataFrame([(1, 5, 0.1), (2, 5, 0.3), (3, 5, 0.2)], "a long, fixed long, val_qini double")
    got = {r["parameter"]: r["corr"] for r in reports.parameter_importance(df, ["a", "fixed"]).collect()}
    assert got["fixed"] is None and got["a"] == pytest.approx(np.corrcoef([1, 2, 3], [0.1, 0.3, 0.2])[0, 1])


def test_splits_are_even_and_repeatable(spark):
    df = spark.range(20_000).select(F.col("id").alias("member_id"), (F.col("id") % 2).cast("int").alias("treatment"))
    train, held = splits.hold_out(df)
    assert train.count() + held.count() == 20_000
    rates = [r["count"] / 10_000 for r in held.groupBy("treatment").count().collect()]
    assert all(abs(x - 0.2) < 0.02 for x in rates)
    again, _ = splits.hold_out(df.repartition(7))
    assert again.exceptAll(train).count() == 0
    other = splits.hold_out(train, "42:inner")[1].count()
    assert abs(other / train.count() - 0.2) < 0.02
    folds = df.select(splits.fold_of(F.col("member_id"), 5).alias("f")).groupBy("f").count().collect()
    assert len(folds) == 5 and all(abs(r["count"] / 4000 - 1) < 0.1 for r in folds)


def test_stratified_split_is_exact(spark):
    df = spark.range(1003).select(F.col("id").alias("member_id"), (F.col("id") % 3 == 0).cast("int").alias("treatment"))
    train, held = splits.stratified_hold_out(df)
    sizes = dict(held.groupBy("treatment").count().collect())
    assert sizes == {1: 67, 0: 134}  # fifths of 335 and 668, rounded up
    assert train.columns == df.columns and train.count() == 1003 - 201
    assert train.join(held, "member_id", "left_semi").count() == 0


def test_parameter_draws():
    space = {"a": (1, 2, 3), "b": (0.1, 0.2)}
    one, two = splits.draw_parameters(space, 50, 1), splits.draw_parameters(space, 50, 1)
    assert one == two and one != splits.draw_parameters(space, 50, 2)
    assert {p["a"] for p in one} == {1, 2, 3} and splits.space_size(space) == 6


def test_long_scores_of_both_splits_in_one_pass(spark):
    from pyspark.sql import functions as F

    from swayline.plans import pipeline

    class Formula:
        def score(self, df, out="uplift"):
            return df.withColumn(out, F.col("member_id") / 8.0)

    rows = spark.range(40).select(F.col("id").alias("member_id"), (F.col("id") % 2).alias("y"), (F.col("id") % 3 % 2).alias("treatment"),
                                  F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"))
    both = pipeline.long_scores({"a": Formula(), "b": Formula()}, rows, by=["split"])
    for split in ("train", "test"):
        alone = pipeline.long_scores({"a": Formula(), "b": Formula()}, rows.filter(F.col("split") == split))
        assert sorted(both.filter(F.col("split") == split).drop("split").collect()) == sorted(alone.collect())
