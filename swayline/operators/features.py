"""Raw events, visits, claims and labels to one feature row per member.

Each source is read once and aggregated once by ``member_id``; early/late counts sit in the same aggregate as
the totals. Counts, sums, minima and maxima combine on the map side, and Spark spreads distinct counts over
(member, value) before it merges per member, so one very active member does not make one very slow task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from swayline.config import COUNT_NAME_PARTS, DATE_COLUMNS, NON_FEATURES, FeatureConfig
from swayline.functions import columns as C
from swayline.sources.tables import MemberTables


def as_timestamp(df: DataFrame, name: str, cfg: FeatureConfig | None = None) -> Column:
    """Zone-free timestamp of a column that may be text, date or timestamp; text is strict unless ``cfg`` is given."""
    if isinstance(df.schema[name].dataType, T.StringType):
        text = F.col(name)
        return C.lenient_timestamp(text, cfg.web_time_formats) if cfg else C.strict_timestamp(text)
    return F.col(name).cast("timestamp_ntz")


def trend_columns(ts: Column, mid: Column, noun: str, trend: str) -> list[Column]:
    early, late = F.count_if(ts <= mid), F.count_if(ts > mid)
    return [early.alias(f"early_{noun}"), late.alias(f"late_{noun}"), (late - early).alias(trend)]


def keyed(df: DataFrame) -> DataFrame:
    """Rows without a member belong to nobody."""
    return df.filter(F.col("member_id").isNotNull())


def label_features(labels: DataFrame, cfg: FeatureConfig) -> DataFrame:
    signup = as_timestamp(labels, "signup_date")
    return labels.select(
        "member_id", signup.alias("signup_date"), "churn", "outreach",
        C.whole_days_until(cfg.reference_date, signup).alias("tenure_days"),
        F.col("outreach").alias("treatment"), F.col("churn").alias("y"),
    )


def app_features(app_usage: DataFrame, cfg: FeatureConfig) -> DataFrame:
    ts = F.col("ts")
    return keyed(app_usage).select("member_id", as_timestamp(app_usage, "timestamp").alias("ts")).groupBy(
        "member_id"
    ).agg(
        F.count(ts).alias("app_sessions"),
        F.count_distinct(F.to_date(ts)).alias("active_days"),
        F.min(ts).alias("first_session"),
        F.max(ts).alias("last_session"),
        *trend_columns(ts, C.midnight(cfg.mid_date), "usage", "usage_trend"),
    )


def with_url_parts(rows: DataFrame, cfg: FeatureConfig) -> DataFrame:
    url = F.col("url")
    return rows.withColumns({"domain": C.url_part(url, 1), "category": C.url_part(url, 2), "page": C.url_part(url, 3)}).withColumn(
        "is_own_domain", C.is_own_domain(F.col("domain"), cfg.own_domain_token))


def visit_parts(web_visits: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """One row per visit: parsed time, URL parts and own-domain flag."""
    return with_url_parts(keyed(web_visits).select("member_id", "url", as_timestamp(web_visits, "timestamp", cfg).alias("ts")), cfg)


def web_features(web_visits: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Visits become one row per member and URL first; addresses are taken apart, and distinct parts counted, on those only."""
    ts = F.col("ts")
    per_url = keyed(web_visits).select("member_id", "url", as_timestamp(web_visits, "timestamp", cfg).alias("ts")).groupBy("member_id", "url").agg(
        F.count("*").alias("visits"), F.max(ts).alias("last"), *trend_columns(ts, C.midnight(cfg.mid_date), "visits", "visit_trend"))
    own = F.sum(F.when(F.col("is_own_domain"), F.col("visits")).otherwise(0))
    total = F.sum(F.when(F.col("url").isNotNull(), F.col("visits")).otherwise(0))
    return with_url_parts(per_url, cfg).groupBy("member_id").agg(
        total.alias("total_web_visits"),
        F.count_distinct("domain").alias("unique_domains"),
        F.count_distinct("category").alias("unique_categories"),
        F.count_distinct("page").alias("unique_pages"),
        F.max("last").alias("last_visit"),
        own.alias("own_domain_visits"),
        F.try_divide(own.cast("double"), total.cast("double")).alias("ratio_own_domain"),
        *[F.sum(c).alias(c) for c in ("early_visits", "late_visits", "visit_trend")],
    )


def claims_features(claims: DataFrame, cfg: FeatureConfig) -> DataFrame:
    ts, code = F.col("ts"), F.col("icd_code")
    # All flags of a member travel as one number per 60 codes: one narrow aggregate instead of one per flag.
    codes = list(cfg.flag_names.items())
    blocks = [codes[i:i + 60] for i in range(0, len(codes), 60)]
    bits = [F.bit_or(C.code_bit(code, [c for c, _ in block])) for block in blocks]
    rows = keyed(claims).select(
        "member_id", "icd_code", C.code_prefix(F.col(cfg.category_column)).alias("icd_category"),
        as_timestamp(claims, "diagnosis_date").alias("ts"))
    return rows.groupBy("member_id").agg(
        F.count(code).alias("total_claims"),
        F.count_distinct(code).alias("unique_icd_codes"),
        F.count_distinct("icd_category").alias("unique_icd_categories"),
        F.max(ts).alias("last_claim"),
        *[C.has_bit(b, i).alias(name) for b, block in zip(bits, blocks) for i, (_, name) in enumerate(block)],
        *trend_columns(ts, C.midnight(cfg.claims_mid), "claims", "claim_trend"),
    )


def join_features(labels: DataFrame, *parts: DataFrame) -> DataFrame:
    """Left joins driven by the label rows. Every part is already hashed on the key by its own aggregate."""
    return reduce(lambda left, right: left.join(right, "member_id", "left"), parts, labels)


def fill_by_rule(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Zero for columns named like a count, the default date for the four date columns, nothing else."""
    counts = [c for c in df.columns if any(part in c for part in COUNT_NAME_PARTS)]
    dates = [c for c in DATE_COLUMNS if c in df.columns]
    return df.fillna(0, subset=counts).withColumns(
        {c: F.coalesce(F.col(c), C.midnight(cfg.default_date)) for c in dates})


def feature_names(df: DataFrame) -> list[str]:
    """Model inputs in table order."""
    return [c for c in df.columns if c not in NON_FEATURES]


def project_features(df: DataFrame) -> DataFrame:
    """Key, model inputs, treatment and outcome; dates and raw labels go."""
    return df.select("member_id", *feature_names(df), "treatment", "y")


def fill_residual(df: DataFrame) -> DataFrame:
    return df.fillna(0, subset=[c for c in df.columns if c != "member_id"])


def joined_features(tables: MemberTables, cfg: FeatureConfig) -> DataFrame:
    return join_features(
        label_features(tables.churn_labels, cfg),
        app_features(tables.app_usage, cfg),
        web_features(tables.web_visits, cfg),
        claims_features(tables.claims, cfg),
    )


def build_features(tables: MemberTables, cfg: FeatureConfig) -> DataFrame:
    """The whole feature pipeline: one lazy plan, four scans, three aggregates, three joins."""
    return fill_residual(project_features(fill_by_rule(joined_features(tables, cfg), cfg)))


def drop_features(df: DataFrame, names: set[str] | list[str]) -> DataFrame:
    return df.drop(*names)
