"""Hand-computed member rows: missing times, unknown URLs, members without events, rows without a member."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from swayline.config import DAY_FIRST_FORMATS, YEAR_FIRST_FORMATS, FeatureConfig, safe_name
from swayline.functions import columns as C
from swayline.operators import features as fe
from swayline.sources.tables import APP_USAGE, CHURN_LABELS, CLAIMS, WEB_VISITS, MemberTables

CFG = FeatureConfig(own_domain_token="ourhealth")
T = dt.datetime


def tables(spark):
    app = [(1, "session", T(2025, 7, 1, 8)), (1, "session", T(2025, 7, 7)), (1, "session", T(2025, 7, 7, 0, 0, 1)),
           (1, "session", None), (2, "session", T(2025, 7, 10)), (None, "session", T(2025, 7, 3))]
    web = [(1, "https://www.ourhealth.com/diet/12", "t", "d", "2025-07-02 10:00:00"),
           (1, "https://news.com/sport/7", "t", "d", "2025-07-12 10:00:00"),
           (1, "http://news.com/sport/7", "t", "d", "no time"),
           (1, None, "t", "d", "2025-07-08 00:00:00"), (2, None, "t", "d", "2025-07-08")]
    claims = [(1, "I10", dt.date(2025, 7, 7)), (1, "E11.9", dt.date(2025, 7, 8)), (1, "E11.9", dt.date(2025, 7, 9)),
              (1, "E11.8", dt.date(2025, 7, 1)), (2, None, dt.date(2025, 7, 2))]
    labels = [(1, dt.date(2025, 7, 1), 1, 0), (2, dt.date(2024, 7, 14), 0, 1), (3, None, 0, 0)]
    make = spark.createDataFrame
    return MemberTables(make(app, APP_USAGE), make(web, WEB_VISITS), make(claims, CLAIMS), make(labels, CHURN_LABELS))


def by_member(df):
    return {r["member_id"]: r.asDict() for r in df.collect()}


def test_tenure_and_targets(spark):
    rows = by_member(fe.label_features(tables(spark).churn_labels, CFG))
    assert [rows[i]["tenure_days"] for i in (1, 2, 3)] == [13, 365, None]
    assert rows[1]["y"] == 1 and rows[1]["treatment"] == 0


def test_tenure_rounds_down_part_days(spark):
    row = spark.createDataFrame([(T(2025, 7, 13, 12),), (T(2025, 7, 14),), (T(2025, 7, 14, 6),)], "s timestamp_ntz")
    days = [r[0] for r in row.select(C.whole_days_until(CFG.reference_date, F.col("s"))).collect()]
    assert days == [0, 0, -1]


def test_app_features(spark):
    rows = by_member(fe.app_features(tables(spark).app_usage, CFG))
    assert set(rows) == {1, 2}
    one = rows[1]
    assert (one["app_sessions"], one["active_days"]) == (3, 2)
    assert (one["early_usage"], one["late_usage"], one["usage_trend"]) == (2, 1, -1)
    assert one["first_session"] == T(2025, 7, 1, 8) and one["last_session"] == T(2025, 7, 7, 0, 0, 1)


def test_web_features(spark):
    rows = by_member(fe.web_features(tables(spark).web_visits, CFG))
    one, two = rows[1], rows[2]
    assert (one["total_web_visits"], one["unique_domains"], one["unique_categories"], one["unique_pages"]) == (3, 2, 2, 2)
    assert one["own_domain_visits"] == 1 and one["ratio_own_domain"] == pytest.approx(1 / 3)
    assert (one["early_visits"], one["late_visits"], one["visit_trend"]) == (1, 2, 1)
    assert one["last_visit"] == T(2025, 7, 12, 10)
    assert two["total_web_visits"] == 0 and two["ratio_own_domain"] is None and two["late_visits"] == 1


def test_claims_features(spark):
    rows = by_member(fe.claims_features(tables(spark).claims, CFG))
    one = rows[1]
    assert (one["total_claims"], one["unique_icd_codes"], one["unique_icd_categories"]) == (4, 3, 2)
    assert (one["early_claims"], one["late_claims"], one["claim_trend"]) == (2, 2, 0)
    assert (one["has_icd_I10"], one["has_icd_E11_9"], one["has_icd_J00"]) == (1, 1, 0)
    assert rows[2]["total_claims"] == 0 and rows[2]["has_icd_I10"] == 0 and rows[2]["early_claims"] == 1


def test_more_flags_than_one_number_holds(spark):
    codes = tuple(f"C{i}" for i in range(130))
    cfg = FeatureConfig(own_domain_token="x", priority_codes=codes)
    claims = spark.createDataFrame([(1, "C0", dt.date(2025, 1, 1)), (1, "C59", None), (1, "C60", None), (1, "C129", None)], CLAIMS)
    row = fe.claims_features(claims, cfg).first().asDict()
    assert {c for c in codes if row[f"has_icd_{c}"]} == {"C0", "C59", "C60", "C129"}


def test_fill_rules(spark):
    joined = fe.joined_features(tables(spark), CFG)
    filled = by_member(fe.fill_by_rule(joined, CFG))[3]
    assert filled["total_web_visits"] == 0 and filled["usage_trend"] == 0 and filled["early_claims"] == 0
    # Names without a count word keep their gap until the residual fill.
    for name in ("app_sessions", "active_days", "visit_trend", "claim_trend", "unique_domains", "has_icd_I10", "ratio_own_domain"):
        assert filled[name] is None
    assert filled["last_claim"] == T(2025, 7, 1) and filled["first_session"] == T(2025, 7, 1)


def test_build_features_keeps_every_label_row(spark):
    built = fe.build_features(tables(spark), CFG)
    rows = by_member(built)
    assert set(rows) == {1, 2, 3}
    assert all(v == 0 for k, v in rows[3].items() if k != "member_id")
    names = fe.feature_names(built)
    assert names[:3] == ["tenure_days", "app_sessions", "active_days"] and names[-1] == "claim_trend"
    assert not {"signup_date", "last_visit", "y", "treatment"} & set(names)


def test_day_order_comes_from_the_formats(spark):
    df = spark.createDataFrame([("08/07/2025",), ("2025-07-08",), ("13/07/2025 01:02:03",), ("13/13/2025",), (None,)], "t string")
    day = [r[0] for r in df.select(C.lenient_timestamp(F.col("t"), DAY_FIRST_FORMATS)).collect()]
    year = [r[0] for r in df.select(C.lenient_timestamp(F.col("t"), YEAR_FIRST_FORMATS)).collect()]
    assert day == [T(2025, 7, 8), None, T(2025, 7, 13, 1, 2, 3), None, None]
    assert year == [None, T(2025, 7, 8), None, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_parse_raises(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = spark.createDataFrame([("2025-07-08 01:00:00",), (None,)], "t string")
        assert [r[0] for r in good.select(C.strict_timestamp(F.col("t"))).collect()] == [T(2025, 7, 8, 1), None]
        bad = spark.createDataFrame([("soon",)], "t string")
        with pytest.raises(Exception, match="not a timestamp"):
            bad.select(C.strict_timestamp(F.col("t"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_safe_name():
    assert safe_name("E11.9") == "E11_9" and safe_name("Brand#1") == "Brand_1"
