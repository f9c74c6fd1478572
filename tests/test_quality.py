import numpy as np
import pandas as pd
import pytest

from swayline.operators import quality


def test_schema_consistency(spark):
    train = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    test = spark.createDataFrame([("x", 1, 5)], "c string, a int, d int")
    rows = {r["column"]: r for r in quality.schema_consistency(train, test).collect()}
    assert rows["b"]["in_train"] and not rows["b"]["in_test"] and rows["b"]["order_ok"] is None
    assert rows["d"]["pos_test"] == 2 and rows["d"]["pos_train"] is None
    assert rows["a"]["order_ok"] is False and rows["c"]["order_ok"] is False
    same = quality.schema_consistency(train, train.select("*")).collect()
    assert all(r["order_ok"] for r in same)


def test_null_audit_lists_only_columns_with_nulls(spark):
    train = spark.createDataFrame([(1, None), (2, 3.0), (None, None)], "a int, b double")
    test = spark.createDataFrame([(1, 2.0)], "a int, b double")
    rows = {(r["split"], r["column"]): r["nulls"] for r in quality.null_audit(train, test).collect()}
    assert rows == {("train", "a"): 1, ("train", "b"): 2}


def test_numeric_drift_on_both_sides_of_the_threshold(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=2000)
    base = (base - base.mean()) / base.std(ddof=1)
    train = spark.createDataFrame(pd.DataFrame({"below": base, "above": base, "flat": np.ones(2000), "gaps": base}))
    gaps = base.copy()
    gaps[:10] = np.nan
    test = spark.createDataFrame(pd.DataFrame({"below": base + 0.19, "above": base - 0.21, "flat": np.ones(2000), "gaps": gaps}))
    rows = {r["feature"]: r for r in quality.numeric_drift(train, test, ["below", "above", "flat", "gaps"]).collect()}
    assert rows["above"]["drifted"] and not rows["below"]["drifted"] and not rows["flat"]["drifted"]
    assert rows["above"]["mean_shift"] == pytest.approx(-0.21) and rows["above"]["std_train"] == pytest.approx(1.0)
    assert rows["gaps"]["mean_test"] == pytest.approx(np.nanmean(gaps))


def test_categorical_drift(spark):
    train = spark.createDataFrame([("a",)] * 60 + [("b",)] * 40 + [(None,)] * 20, "c string")
    near = spark.createDataFrame([("a",)] * 55 + [("b",)] * 45, "c string")
    far = spark.createDataFrame([("a",)] * 45 + [("b",)] * 40 + [("z",)] * 15, "c string")
    got = quality.categorical_drift(train, near, ["c"]).first()
    assert got["max_freq_diff"] == pytest.approx(0.05) and not got["drifted"]
    got = quality.categorical_drift(train, far, ["c"]).first()
    assert got["max_freq_diff"] == pytest.approx(0.15) and got["drifted"]
    table = {r["category"]: r for r in quality.frequency_table(train, far, ["c"]).collect()}
    assert table["z"]["n_train"] == 0 and table["z"]["freq_train"] == 0.0


def test_health_check_is_one_long_report(spark):
    train = spark.createDataFrame([(1, "a", None), (2, "a", 1.0)], "x int, c string, gone double")
    test = spark.createDataFrame([("b", 9), ("a", 9)], "c string, x int")
    rows = {(r["check"], r["column"], r["metric"]): r["value"] for r in quality.health_check(train, test).collect()}
    assert rows[("schema", "gone", "in_test")] == 0.0 and rows[("schema", "x", "order_ok")] == 0.0
    assert rows[("nulls", "gone", "train")] == 1.0
    assert rows[("numeric drift", "x", "drifted")] == 1.0
    assert rows[("categorical drift", "c", "max_freq_diff")] == 0.5
