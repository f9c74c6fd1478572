"""One query per operator over the star-schema tables. Each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from swayline.config import CONTROL_BOOST, BoostConfig, CurveConfig, DAY_FIRST_FORMATS, PropensityConfig, YEAR_FIRST_FORMATS
from swayline.functions import columns as C
from swayline.operators import (
    curves, effects, features as fe, interactions as ia, learners, quality, reports, selection, splits, trees, tuning,
)
from swayline.plans import pipeline
from swayline.sources import star_tables as star, tables
from swayline.sources.storage import materialise, new_path
from swayline.sources.star_tables import STAR_CONFIG as CFG

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CURVE = CurveConfig()  # at least one range per core, so every curve query crosses range borders
INTERACTED = ("early_claims", "claim_trend", "has_icd_Brand_6")
DROPPED = ("app_sessions", "total_claims")
KEYWORDS = ("brand#1", "web_visits", "claims_count")
BUDGET = 300


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tidy(df: DataFrame) -> DataFrame:
    """Doubles to six places without negative zero, so two engines print the same number."""
    return df.select(*[
        (F.round(F.col(f.name), 6) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema])


def feature_rows(spark: SparkSession, d: str) -> DataFrame:
    return fe.build_features(star.member_tables(spark, d), CFG)


def written_features(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.prepare(star.member_tables(spark, d), CFG)


def score_formula() -> Column:
    """Scores are whole numbers over powers of two, so sums of them are exact in any order."""
    points = F.col("usage_trend") * 7 + F.col("claim_trend") * 5 - F.col("tenure_days") % 13
    return (points / F.lit(1024.0)).alias("uplift")


def with_scores(features: DataFrame) -> DataFrame:
    return features.select("member_id", "y", "treatment", score_formula())


def scores(spark: SparkSession, d: str) -> DataFrame:
    return materialise(with_scores(feature_rows(spark, d)), "scores")


def model_scores(spark: SparkSession, d: str) -> DataFrame:
    """Four scorings of every member, long. 'usage' puts most members on one value."""
    named = {
        "trend": score_formula(), "usage": F.col("usage_trend") / F.lit(16.0),
        "claims": (F.col("total_claims") * 3 - F.col("unique_icd_codes") * 2) / F.lit(128.0),
        "tenure": F.col("tenure_days") / F.lit(1024.0),
    }
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), c.alias("uplift")) for m, c in named.items()])
    rows = feature_rows(spark, d).select("member_id", "y", "treatment", F.explode(pairs).alias("s"))
    return materialise(rows.select("member_id", "y", "treatment", "s.model", "s.uplift"), "model-scores")


def given_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Outcome and propensity predictions by formula, for the arithmetic between learners."""
    return feature_rows(spark, d).select(
        "member_id", "y", "treatment",
        (F.lit(0.05) + (F.col("tenure_days") % 10) * 0.1).alias("p"),
        ((F.col("total_claims") % 20) / F.lit(20.0)).alias("mu0"),
        ((F.col("unique_icd_codes") % 16) / F.lit(16.0)).alias("mu1"))


# --- sources and sinks ----------------------------------------------------------------------------------------


def _csv_round_trip(spark: SparkSession, d: str, name: str, df: DataFrame) -> DataFrame:
    path = tables.write_table(df, new_path(spark, name), "csv")
    return tables.read_csv(spark, path, df.schema)


@query
def a1_csv_scan(spark, d):
    """All four tables of a split, written as files as they come - titles with line breaks and quotes, times with a zone, columns in
    another order - and read by ``read_split``."""
    t, second = star.member_tables(spark, d), "yyyy-MM-dd HH:mm:ss"
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    out = {
        "app_usage": t.app_usage.select("member_id", "event_type", F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("timestamp")),
        "web_visits": t.web_visits.select("url", F.concat(F.lit('A "title",\nof '), "url").alias("title"), F.lit(None).cast("string").alias("description"),
                                          "member_id", F.date_format("timestamp", second).alias("timestamp")),
        "claims": t.claims.select("icd_code", "member_id", day("diagnosis_date").alias("diagnosis_date")),
        "churn_labels": t.churn_labels.select("member_id", day("signup_date").alias("signup_date"), "churn", "outreach"),
    }
    folder = new_path(spark, "split")
    for name, df in out.items():
        tables.write_table(df, f"{folder}/{name}.csv", "csv")
    back = tables.read_split(spark, folder)
    none = F.lit(None).cast("string")
    parts = [
        back.app_usage.select(F.lit("app_usage").alias("source"), "member_id", "event_type", none.alias("more"), F.date_format("timestamp", second).alias("at")),
        back.web_visits.select(F.lit("web_visits"), "member_id", "url", "title", "timestamp"),
        back.claims.select(F.lit("claims"), "member_id", "icd_code", none, day("diagnosis_date")),
        back.churn_labels.select(F.lit("churn_labels"), "member_id", F.col("churn").cast("string"), F.col("outreach").cast("string"), day("signup_date")),
    ]
    return reduce(DataFrame.union, parts).withColumnRenamed("event_type", "what")


@query
def a2_split_features(spark, d):
    """The same pipeline on each split, each with its own tables and configuration."""
    t = star.member_tables(spark, d)

    def side(df: DataFrame, test: bool) -> DataFrame:
        held = splits.in_holdout(F.col("member_id"))
        return df.filter(held if test else ~held)

    parts = []
    for name, test in (("train", False), ("test", True)):
        # Visit times reach the two splits as text in two orders.
        pattern = "yyyy-MM-dd HH:mm:ss" if test else "dd/MM/yyyy HH:mm:ss"
        web = side(t.web_visits, test).withColumn("timestamp", F.date_format("timestamp", pattern))
        split = tables.MemberTables(side(t.app_usage, test), web, side(t.claims, test), side(t.churn_labels, test))
        cfg = replace(CFG, web_time_formats=YEAR_FIRST_FORMATS if test else DAY_FIRST_FORMATS)
        parts.append(fe.build_features(split, cfg).select(F.lit(name).alias("split"), "*"))
    return tidy(parts[0].unionByName(parts[1]))


@query
def a3_ranked_list_sink(spark, d):
    return tidy(_csv_round_trip(spark, d, "ranked", f2_contact_list(spark, d)))


@query
def a4_report_sink(spark, d):
    """The comparison file of each split, written and read back."""
    parts = []
    for name, part in zip(("train", "test"), splits.hold_out(written_features(spark, d))):
        path = new_path(spark, f"comparison-{name}")
        report = pipeline.arm_report(part, path)
        parts.append(tables.read_csv(spark, path, report.schema).select(F.lit(name).alias("split"), "*"))
    return tidy(parts[0].unionByName(parts[1]))


@query
def a5_trials_sink(spark, d):
    trials = trial_rows(spark, d)
    return tidy(spark.read.parquet(tables.write_table(trials, new_path(spark, "trials"))))


# --- projections and scalar functions -------------------------------------------------------------------------


@query
def b1_strict_parse(spark, d):
    text = star.members(spark, d).select("member_id", F.date_format("signup_date", "yyyy-MM-dd HH:mm:ss").alias("text"))
    return text.select("member_id", C.strict_timestamp(F.col("text")).alias("signup_date"))


@query
def b2_lenient_parse(spark, d):
    """Two text orders by split; error events carry text that is no time at all."""
    events = star.table(spark, d, "events")
    test = splits.in_holdout(F.col("user_id"))
    shown = F.when(test, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
    raw = events.select("event_id", test.alias("is_test"),
                        F.when(F.col("event_type") == "error", F.col("props")).otherwise(shown).alias("text"))
    text = F.col("text")
    return raw.select("event_id", F.when(F.col("is_test"), C.lenient_timestamp(text, YEAR_FIRST_FORMATS)).otherwise(
        C.lenient_timestamp(text, DAY_FIRST_FORMATS)).alias("timestamp"))


@query
def b3_tenure(spark, d):
    return fe.label_features(star.members(spark, d), CFG).select("member_id", "signup_date", "tenure_days")


@query
def b4_targets(spark, d):
    return fe.label_features(star.members(spark, d), CFG).select("member_id", "treatment", "y")


@query
def b5_url_parts(spark, d):
    return fe.visit_parts(star.web_visits(spark, d), CFG).select("member_id", "url", "domain", "category", "page")


@query
def b6_own_domain(spark, d):
    return fe.visit_parts(star.web_visits(spark, d), CFG).select("member_id", "url", "is_own_domain")


@query
def b7_code_prefix(spark, d):
    coded = star.claims(spark, d).select("icd_group", C.code_prefix(F.col("icd_group")).alias("icd_category"))
    return coded.groupBy("icd_group", "icd_category").agg(F.count("*").alias("n"))


@query
def b8_code_flags(spark, d):
    return fe.claims_features(star.claims(spark, d), CFG).select("member_id", *CFG.flag_names.values())


@query
def b10_ratio(spark, d):
    return tidy(fe.web_features(star.web_visits(spark, d), CFG).select("member_id", "ratio_own_domain"))


@query
def b11_null_fill(spark, d):
    return tidy(fe.fill_by_rule(fe.joined_features(star.member_tables(spark, d), CFG), CFG))


@query
def b12_residual_fill(spark, d):
    return tidy(feature_rows(spark, d))


@query
def b13_projection(spark, d):
    return tidy(fe.project_features(fe.joined_features(star.member_tables(spark, d), CFG)))


@query
def b14_drop_redundant(spark, d):
    return tidy(fe.drop_features(feature_rows(spark, d), DROPPED))


@query
def b15_interactions(spark, d):
    ft = pipeline.with_interactions(feature_rows(spark, d), [*INTERACTED, "no_such_feature"])
    return ft.select("member_id", *[c for c in ft.columns if c.startswith((ia.TREATMENT_PREFIX, ia.PRIORITY_PREFIX))])


@query
def b16_keyword_pick(spark, d):
    ft = feature_rows(spark, d)
    return ft.select("member_id", *effects.priority_columns(fe.feature_names(ft), KEYWORDS))


@query
def b17_arm_filter(spark, d):
    return effects.arm(with_scores(feature_rows(spark, d)), 1).select("member_id", "y")


@query
def b18_inverse_weights(spark, d):
    g = given_predictions(spark, d)
    t, p = F.col("treatment"), F.col("p")
    return tidy(g.select("member_id", ia.inverse_weight(t, p).alias("weight"),
                         ia.inverse_weight(t, p, 0.1).alias("clipped_weight")))


@query
def b18_weight_report(spark, d):
    return tidy(ia.weight_report(given_predictions(spark, d), "p", 0.1))


@query
def b19_uplift_difference(spark, d):
    g = given_predictions(spark, d)
    return tidy(g.select("member_id", ia.uplift_difference(F.col("mu1"), F.col("mu0")).alias("uplift")))


@query
def b20_imputed_effects(spark, d):
    effect = ia.imputed_effect(F.col("treatment"), F.col("y"), F.col("mu0"), F.col("mu1"))
    return tidy(given_predictions(spark, d).select("member_id", effect.alias("effect")))


@query
def b21_blended_effect(spark, d):
    blend = ia.blended_effect(F.col("p"), F.col("mu0"), F.col("mu1"))
    return tidy(given_predictions(spark, d).select("member_id", blend.alias("uplift")))


@query
def j7_pseudo_outcome(spark, d):
    """Pseudo-outcome arithmetic of the DR-learner on given predictions."""
    c = [F.col(x) for x in ("treatment", "y", "p", "mu0", "mu1")]
    return tidy(given_predictions(spark, d).select("member_id", ia.doubly_robust(*c, 0.1).alias("pseudo")))


# --- joins and aggregates -------------------------------------------------------------------------------------


@query
def c1_feature_join(spark, d):
    return tidy(fe.joined_features(star.member_tables(spark, d), CFG))


@query
def c3_keyed_columns(spark, d):
    """Outcome, treatment and score travel with the member's features; nothing is aligned by position."""
    ft = feature_rows(spark, d)
    return tidy(ft.select("member_id", "tenure_days", "app_sessions", "total_claims", "treatment", "y", score_formula()))


def _claim_splits(spark, d) -> tuple[DataFrame, DataFrame]:
    return splits.hold_out(star.claims(spark, d).select("member_id", "icd_code", "icd_group"))


@query
def c4_frequency_alignment(spark, d):
    train, test = _claim_splits(spark, d)
    return tidy(quality.frequency_table(train, test, ["icd_code", "icd_group"]))


@query
def d1_app_usage(spark, d):
    return fe.app_features(star.app_usage(spark, d), CFG).drop("early_usage", "late_usage", "usage_trend")


@query
def d2_trends(spark, d):
    t = star.member_tables(spark, d)
    ft = fe.joined_features(t, CFG)
    return ft.select("member_id", "early_usage", "late_usage", "usage_trend", "early_visits", "late_visits",
                     "visit_trend", "early_claims", "late_claims", "claim_trend")


@query
def d3_web_aggregate(spark, d):
    return fe.web_features(star.web_visits(spark, d), CFG).select(
        "member_id", "total_web_visits", "unique_domains", "unique_categories", "unique_pages", "last_visit",
        "own_domain_visits")


@query
def d4_web_features(spark, d):
    return tidy(fe.web_features(star.web_visits(spark, d), CFG))


@query
def d5_claims_features(spark, d):
    return fe.claims_features(star.claims(spark, d), CFG)


@query
def d6_value_counts(spark, d):
    s = with_scores(feature_rows(spark, d))
    return reports.value_counts(s, "y").select(F.lit("y").alias("column"), F.col("y").alias("value"), "count").unionByName(
        reports.value_counts(s, "treatment").select(F.lit("treatment").alias("column"), F.col("treatment").alias("value"), "count"))


@query
def d7_null_audit(spark, d):
    train, test = splits.hold_out(materialise(fe.joined_features(star.member_tables(spark, d), CFG), "joined"))
    return quality.null_audit(train, test)


@query
def d8_arm_means(spark, d):
    ft = feature_rows(spark, d)
    return tidy(effects.arm_means(ft, fe.feature_names(ft)))


@query
def d9_arm_differences(spark, d):
    ft = written_features(spark, d)
    names = fe.feature_names(ft)
    train, test = splits.hold_out(ft)
    return tidy(effects.arm_differences(train, names).select(F.lit("train").alias("split"), "*").unionByName(
        effects.arm_differences(test, names).select(F.lit("test").alias("split"), "*")))


@query
def d10_describe(spark, d):
    ft = written_features(spark, d)
    return tidy(effects.describe(ft, fe.feature_names(ft), ["treatment"]))


@query
def d11_average_effect(spark, d):
    return tidy(effects.average_effect(feature_rows(spark, d)))


@query
def d12_segment_effects(spark, d):
    ft = written_features(spark, d)
    return tidy(effects.segment_effects(ft, fe.feature_names(ft)))


@query
def d13_segment_extremes(spark, d):
    ft = written_features(spark, d)
    found = effects.segment_extremes(effects.segment_effects(ft, fe.feature_names(ft)), effects.average_effect(ft))
    return tidy(found)


def _correlations(spark, d) -> tuple[DataFrame, selection.Moments, list[str]]:
    ft = written_features(spark, d)
    names = fe.feature_names(ft)
    m = selection.moments(ft, [*names, "y", "treatment"])
    return selection.correlation_table(spark, m), m, names


@query
def d14_correlation_matrix(spark, d):
    return tidy(_correlations(spark, d)[0])


@query
def d15_welch_test(spark, d):
    ft = written_features(spark, d)
    return tidy(effects.welch_test(ft, fe.feature_names(ft)))


@query
def d16_numeric_drift(spark, d):
    ft = written_features(spark, d)
    train, test = splits.hold_out(ft)
    return tidy(quality.numeric_drift(train, test, fe.feature_names(ft)))


@query
def d17_categorical_drift(spark, d):
    train, test = _claim_splits(spark, d)
    return tidy(quality.categorical_drift(train, test, ["icd_code", "icd_group"]))


@query
def d18_segment_plan(spark, d):
    ft = written_features(spark, d)
    return tidy(effects.segment_plan(ft, fe.feature_names(ft)))


@query
def d19_score_summary(spark, d):
    return tidy(reports.score_summary(model_scores(spark, d), "uplift", ["model"]))


@query
def d20_propensity_by_arm(spark, d):
    return tidy(reports.propensity_by_arm(materialise(given_predictions(spark, d)), "p"))


@query
def d21_histogram(spark, d):
    return tidy(reports.histogram(scores(spark, d), "uplift", 30, ["treatment"]))


@query
def d21_uplift_histogram(spark, d):
    return tidy(reports.histogram(scores(spark, d), "uplift", 50))


@query
def d21_p_value_histogram(spark, d):
    ft = written_features(spark, d)
    return tidy(reports.histogram(materialise(effects.welch_test(ft, fe.feature_names(ft)), "welch"), "p_value", 20).select("bin", "count"))


@query
def d22_percentiles(spark, d):
    return tidy(reports.percentile_table(model_scores(spark, d), "uplift", by=["model"]))


@query
def d23_classification_report(spark, d):
    return tidy(curves.classification_report(with_scores(feature_rows(spark, d)), "uplift", "y", 0.0))


@query
def d23_roc_auc(spark, d):
    return tidy(curves.roc_auc(model_scores(spark, d), "uplift", "y", keys=["model"], cfg=CURVE))


@query
def d24_priority_comparison(spark, d):
    ft = feature_rows(spark, d)
    return tidy(effects.priority_comparison(ft, fe.feature_names(ft), KEYWORDS))


# --- ranking and curves ---------------------------------------------------------------------------------------


@query
def e1_rank_ascending(spark, d):
    return tidy(curves.rank_members(scores(spark, d), descending=False, cfg=CURVE).select("member_id", "uplift", "rank"))


@query
def e1_rank_descending(spark, d):
    return tidy(curves.rank_members(scores(spark, d), cfg=CURVE).select("member_id", "uplift", "rank"))


@query
def e1_rank_heavy_ties(spark, d):
    """Most members share one score: the tie itself is cut by member."""
    tied = model_scores(spark, d).filter(F.col("model") == "usage")
    return tidy(curves.rank_members(tied, cfg=CURVE).select("member_id", "uplift", "rank"))


@query
def e2_prevented_curve(spark, d):
    return tidy(curves.prevented_curve(scores(spark, d), cfg=CURVE).select("member_id", "k", "qini_gain", "random_gain"))


@query
def e3_gain_curve(spark, d):
    return tidy(curves.qini_gain_curve(scores(spark, d), cfg=CURVE))


@query
def e3_gain_curve_ascending(spark, d):
    return tidy(curves.qini_gain_curve(scores(spark, d), descending=False, cfg=CURVE))


@query
def e4_cumulative_curve(spark, d):
    return tidy(curves.qini_cumulative_curve(scores(spark, d), cfg=CURVE))


@query
def e5_auuc(spark, d):
    return tidy(curves.auuc(scores(spark, d), cfg=CURVE))


@query
def e6_tertile_edges(spark, d):
    ft = written_features(spark, d)
    return tidy(effects.tertile_edges(ft, fe.feature_names(ft)))


@query
def e7_qini_auc(spark, d):
    return tidy(curves.qini_auc(model_scores(spark, d), keys=["model"], cfg=CURVE))


@query
def e8_optimal_target(spark, d):
    return tidy(curves.optimal_target(scores(spark, d), cfg=CURVE))


@query
def e8_optimal_target_budget(spark, d):
    return tidy(curves.optimal_target(scores(spark, d), max_budget_n=BUDGET, descending=False, cfg=CURVE))


@query
def e9_worth_targeting(spark, d):
    chosen = curves.worth_targeting(scores(spark, d), 100.0, 1.5, cfg=CURVE)
    return tidy(chosen.select("member_id", "benefit", "rank"))


@query
def f1_top_differences(spark, d):
    ft = feature_rows(spark, d)
    return tidy(effects.top_differences(ft, fe.feature_names(ft), 15))


@query
def f2_contact_list(spark, d):
    return tidy(pipeline.contact_list(with_scores(feature_rows(spark, d)), cfg=CURVE))


# --- trials by formula: every trial scores every member -------------------------------------------------------

TRIALS = [{"trial": i, "w_usage": i * 5 % 7 - 3, "w_claims": i * 3 % 5 - 2, "w_tenure": i % 4} for i in range(1, 25)]


def trial_rows(spark: SparkSession, d: str) -> DataFrame:
    """Trial log of formula scores: areas on the fitting and the held-out part, gap, parameters."""
    ft = feature_rows(spark, d)
    points = F.array(*[F.struct(F.lit(t["trial"]).cast("bigint").alias("trial"), (
        (F.col("usage_trend") * t["w_usage"] + F.col("claim_trend") * t["w_claims"]
         + F.col("tenure_days") % 17 * t["w_tenure"]) / F.lit(128.0)).alias("uplift")) for t in TRIALS])
    rows = ft.select("member_id", "y", "treatment", F.explode(points).alias("s")).select(
        "member_id", "y", "treatment", "s.*",
        F.when(splits.in_holdout(F.col("member_id")), "val").otherwise("train").alias("split"))
    areas = curves.qini_auc(materialise(rows, "trial-scores"), keys=["trial", "split"], cfg=CURVE)
    paired = reports.gap_report(areas, ["trial"], held_out="val").select(
        "trial", F.col("qini_train").alias("train_qini"), F.col("qini_test").alias("val_qini"), F.col("gap").alias("overfitting_gap"))
    weights = F.create_map(*[x for t in TRIALS for x in (F.lit(t["trial"]).cast("bigint"), F.struct(
        *[F.lit(t[w]).cast("bigint").alias(w) for w in ("w_usage", "w_claims", "w_tenure")]))])
    return paired.withColumn("w", weights[F.col("trial")]).select(*paired.columns, "w.*")


@query
def f3_top_trials(spark, d):
    t = trial_rows(spark, d).select("trial", F.round("val_qini", 9).alias("val_qini"), F.round("overfitting_gap", 9).alias("overfitting_gap"))
    t = materialise(t, "trials")
    return tidy(reports.top_trials(t).select(F.lit("val_qini").alias("by"), "*").unionByName(
        reports.top_trials(t, "overfitting_gap").select(F.lit("gap").alias("by"), "*")))


@query
def f4_interaction_candidates(spark, d):
    corr, _, names = _correlations(spark, d)
    return tidy(reduce(DataFrame.unionByName, [
        selection.interaction_candidates(corr, names, threshold=t).select(F.lit(t).alias("threshold"), "*") for t in (0.1, 0.01)]))


# --- reports over splits --------------------------------------------------------------------------------------


@query
def g1_schema_consistency(spark, d):
    """The test split as it arrives where its columns stand in reverse order and one is missing."""
    train, test = splits.hold_out(feature_rows(spark, d))
    return quality.schema_consistency(train, test.select(*[c for c in reversed(test.columns) if c != "usage_trend"]))


@query
def g2_health_check(spark, d):
    """Schema, nulls, numeric and categorical drift of all columns of the member rows, unfilled, of both whole splits."""
    joined = fe.joined_features(star.member_tables(spark, d), CFG).withColumn(
        "claim_band", F.when(F.col("total_claims") > 45, "many").when(F.col("total_claims") > 30, "some"))
    train, test = splits.hold_out(materialise(joined, "joined"))
    return tidy(quality.health_check(train, test))


@query
def g2_unread_times(spark, d):
    """Visit times as day-first text, with parts missing here and there, and every seventh in the other order."""
    e = star.table(spark, d, "events")
    text = F.when(F.col("event_id") % 7 == 0, F.date_format("ts", "MM-yyyy-dd")).when(F.col("event_id") % 7 == 1, F.date_format("ts", "d/M/yyyy H:mm")).when(
        F.col("event_id") % 7 > 2, F.date_format("ts", "dd/MM/yyyy HH:mm:ss.SSS"))
    return quality.unread_times(e.select(text.alias("timestamp")), "timestamp", DAY_FIRST_FORMATS)


@query
def h1_redundant_pairs(spark, d):
    corr, _, names = _correlations(spark, d)
    return tidy(selection.redundant_pairs(corr, names))


@query
def h2_target_correlation(spark, d):
    corr, _, names = _correlations(spark, d)
    return tidy(selection.target_correlation(corr, names))


@query
def h3_greedy_drop(spark, d):
    corr, _, names = _correlations(spark, d)
    dropped = selection.features_to_drop(corr, names)
    return spark.createDataFrame([(c,) for c in dropped], "feature string")


@query
def h4_vif(spark, d):
    """All features: totals and trends are exact combinations of early and late counts."""
    _, m, names = _correlations(spark, d)
    return tidy(selection.vif(spark, m, names))


@query
def h5_selection_summary(spark, d):
    corr, m, names = _correlations(spark, d)
    return selection.selection_summary(spark, corr, m, names)


@query
def h6_interaction_features(spark, d):
    """Candidates chosen by correlation, then multiplied by treatment and described."""
    ft = written_features(spark, d)
    names = fe.feature_names(ft)
    corr = selection.correlation_table(spark, selection.moments(ft, [*names, "y", "treatment"]))
    # Arms are drawn by number here, so no feature comes near the default threshold of 0.1 (f4 uses it).
    chosen = [r["feature"] for r in selection.interaction_candidates(corr, names, threshold=0.0).collect()]
    made = [ia.TREATMENT_PREFIX + c for c in chosen]
    return tidy(effects.describe(ia.add_interactions(ft, chosen), made, ["treatment"]))


@query
def i1_hold_out(spark, d):
    s = with_scores(feature_rows(spark, d))
    return s.select("member_id", "treatment", splits.in_holdout(F.col("member_id")).alias("held_out"))


@query
def i1_stratified_hold_out(spark, d):
    _, held = splits.stratified_hold_out(materialise(with_scores(feature_rows(spark, d)), "scores"))
    return held.select("member_id", "treatment")


@query
def i2_folds(spark, d):
    s = star.members(spark, d)
    return s.select("member_id", *[splits.fold_of(F.col("member_id"), 5, r).alias(f"fold_{r}") for r in range(3)])


# --- learners -------------------------------------------------------------------------------------------------


def _modelling(spark, d) -> tuple[DataFrame, DataFrame, list[str]]:
    """Train and test rows with a propensity score, and the features that survive selection."""
    train, test = splits.hold_out(written_features(spark, d))
    kept = pipeline.select_features(train)
    model = learners.fit_propensity(train, kept)
    return materialise(model.transform(train), "train"), materialise(model.transform(test), "test"), kept


def _uplift(model, train: DataFrame, test: DataFrame) -> DataFrame:
    names = ["member_id", "y", "treatment", "uplift"]
    return tidy(model.score(train).select(F.lit("train").alias("split"), *names).unionByName(
        model.score(test).select(F.lit("test").alias("split"), *names)))


@query
def j1_propensity(spark, d):
    train, test, _ = _modelling(spark, d)
    names = ["member_id", "treatment", "propensity_score"]
    return tidy(train.select(F.lit("train").alias("split"), *names).unionByName(test.select(F.lit("test").alias("split"), *names)))


LINEAR = ("tenure_days", "total_claims", "unique_icd_codes")  # few, so that the twin can solve for them in SQL


@query
def j1_propensity_optimum(spark, d):
    """The fitted propensity itself: the twin finds the same optimum by Newton steps."""
    ft = written_features(spark, d)
    model = learners.fit_propensity(ft, LINEAR, PropensityConfig(tol=1e-13))
    return model.transform(ft).select("member_id", "treatment", (F.round("propensity_score", 3) + F.lit(0.0)).alias("propensity_score"))


@query
def j2_weighted_forests(spark, d):
    train, test, kept = _modelling(spark, d)
    return _uplift(learners.fit_weighted_forests(train, kept), train, test)


@query
def j3_s_learner(spark, d):
    train, test, kept = _modelling(spark, d)
    return _uplift(learners.fit_s_learner(train, kept, [c for c in INTERACTED if c in kept]), train, test)


@query
def j4_t_learner(spark, d):
    train, test, kept = _modelling(spark, d)
    return _uplift(learners.fit_t_learner(train, kept, control=CONTROL_BOOST), train, test)


@query
def j4_one_split(spark, d):
    """The T-learner with one tree of one split an arm, on given cut values: the twin weighs every cut."""
    ft = written_features(spark, d)
    cfg = BoostConfig(max_iter=1, max_depth=1, num_leaves=2, step_size=1.0, min_instances=20, feature_share=1.0, tree_share=1.0, min_split_gain=0.0)
    edges = [np.arange(250) * step for step in (20.0, 1.0, 1.0)]
    models = trees.fit_boosted(ft, LINEAR, "y", {"treated": (1, cfg), "control": (0, replace(cfg, l1=10.0, l2=5.0))}, "treatment", edges=edges)
    rows = []
    for name, model in models.items():
        t = model.trees[0]
        cut = t.feature[0] >= 0
        rows.append((name, LINEAR[t.feature[0]] if cut else None, float(t.threshold[0]) if cut else None, model.start,
                     float(t.value[t.left[0]]) if cut else float(t.value[0]), float(t.value[t.right[0]]) if cut else None))
    return tidy(spark.createDataFrame(rows, "arm string, feature string, threshold double, start double, left_value double, right_value double"))


@query
def j5_tuned_t_learner(spark, d):
    train, test, kept = _modelling(spark, d)
    return _uplift(learners.fit_tuned_t_learner(train, kept), train, test)


@query
def j6_x_learner(spark, d):
    train, test, kept = _modelling(spark, d)
    return _uplift(learners.fit_x_learner(train, kept), train, test)


@query
def j6_x_learner_optimum(spark, d):
    """The X-learner's own arithmetic, blended by a given propensity: the twin solves the four ridges in SQL."""
    ft = written_features(spark, d).withColumn("p", F.lit(0.05) + (F.col("tenure_days") % 10) * 0.1)
    scored = learners.fit_x_learner(ft, LINEAR, "p").score(ft)
    return scored.select("member_id", (F.round("uplift", 4) + F.lit(0.0)).alias("uplift"))


@query
def j7_dr_learner(spark, d):
    train, test, kept = _modelling(spark, d)
    return _uplift(learners.fit_dr_learner(train, kept), train, test)


def _searched(spark, d):
    train, test, kept = _modelling(spark, d)
    return train, test, kept, tuning.search(train, kept)


@query
def j8_random_search(spark, d):
    *_, rows = _searched(spark, d)
    return tidy(tuning.trial_table(spark, rows))


@query
def j9_trial_selection(spark, d):
    rows = trial_rows(spark, d).collect()  # one row per trial
    best = tuning.select_trial([(r["trial"], round(r["val_qini"], 9), round(r["overfitting_gap"], 9)) for r in rows])
    return tidy(spark.createDataFrame([(best.trial, best.val_qini, best.gap)], "trial bigint, val_qini double, gap double"))


@query
def j10_refit_best(spark, d):
    train, test, kept, rows = _searched(spark, d)
    return _uplift(tuning.refit_best(train, kept, rows), train, test)


@query
def j11_overfit_check(spark, d):
    train, test = splits.hold_out(scores(spark, d))
    return tidy(reports.overfit_check(train, test, model="trend", cfg=CURVE))


@query
def j12_model_comparison(spark, d):
    return tidy(reports.model_comparison(model_scores(spark, d), cfg=CURVE))


def _fitted(spark, d):
    """Train and test rows, and the five learners fitted on the train split."""
    train, test, kept = _modelling(spark, d)
    fits = {
        "tuned_t_learner": lambda: learners.fit_tuned_t_learner(train, kept),
        "t_learner": lambda: learners.fit_t_learner(train, kept, control=CONTROL_BOOST),
        "weighted_forests": lambda: learners.fit_weighted_forests(train, kept),
        "s_learner": lambda: learners.fit_s_learner(train, kept, [c for c in INTERACTED if c in kept]),
        "x_learner": lambda: learners.fit_x_learner(train, kept),
    }  # those of two long tasks first
    fitted = dict(zip(fits, learners.together(list(fits.values()))))
    return train, test, {name: fitted[name] for name in ("weighted_forests", "s_learner", "t_learner", "tuned_t_learner", "x_learner")}


@query
def j11_fitted_overfit(spark, d):
    """Train and test areas of every fitted learner, one row each."""
    train, test, models = _fitted(spark, d)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))

    def areas(name: str, model) -> DataFrame:
        scored = pipeline.long_scores({name: model}, both, by=["split"])  # both splits in one pass
        return reports.overfit_check(scored.filter("split = 'train'"), scored.filter("split = 'test'"), model=name, cfg=CURVE)

    return tidy(reduce(DataFrame.unionByName, learners.together([lambda n=n, m=m: areas(n, m) for n, m in models.items()])))


@query
def j12_fitted_comparison(spark, d):
    """The five fitted learners in one table, on the test split."""
    _, test, models = _fitted(spark, d)
    return tidy(reports.model_comparison(pipeline.long_scores(models, test), cfg=CURVE))


@query
def j13_parameter_importance(spark, d):
    return tidy(reports.parameter_importance(materialise(trial_rows(spark, d)), ["w_usage", "w_claims", "w_tenure"]))


@query
def j14_tuned_vs_baseline(spark, d):
    """Best trial by held-out area against the first."""
    t = trial_rows(spark, d).agg(F.max(F.when(F.col("trial") == 1, F.col("val_qini"))).alias("baseline"),
                                 F.max("val_qini").alias("tuned"))
    return tidy(t.withColumns(reports.improvement(F.col("baseline"), F.col("tuned"))))
