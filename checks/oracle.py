"""The same results in DuckDB SQL over the same tables, written independently of the Spark code."""

from __future__ import annotations

BRANDS = [f"Brand#{i}" for i in range(1, 11)]
FLAGS = [f"has_icd_Brand_{i}" for i in range(1, 11)]

APP = ["app_sessions", "active_days", "early_usage", "late_usage", "usage_trend"]
WEB = ["total_web_visits", "unique_domains", "unique_categories", "unique_pages", "own_domain_visits",
       "ratio_own_domain", "early_visits", "late_visits", "visit_trend"]
CLAIM = ["total_claims", "unique_icd_codes", "unique_icd_categories", *FLAGS, "early_claims", "late_claims", "claim_trend"]
FEATURES = ["tenure_days", *APP, *WEB, *CLAIM]
COUNT_PARTS = ("count", "usage", "visits", "claims")


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0.0 as {name}"


def held(member: str, seed: str = "42") -> str:
    return f"(('0x' || substr(md5(concat({member}, ':', {seed})), 1, 8))::bigint / 4294967296.0::double < 0.2::double)"


def with_(*steps: str) -> str:
    return "with " + ",\n".join(steps) + "\n"


MEMBERS = """members as (
  select c_custkey as member_id, min(o_orderdate) as signup_date,
         cast(coalesce(max(o_orderdate) < timestamp '2001-01-01', true) as int) as churn,
         cast((c_custkey * 7919 + 13) % 10 < 4 as int) as outreach
  from customer left join orders on o_custkey = c_custkey group by c_custkey)"""

LABELS = """labelled as (
  select member_id, signup_date, churn, outreach,
         cast(floor(date_diff('microsecond', signup_date, timestamp '2002-01-01') / 86400000000.0) as bigint) as tenure_days,
         outreach as treatment, churn as y
  from members)"""

APP_F = """app as (
  select user_id as member_id, count(ts) as app_sessions, count(distinct cast(ts as date)) as active_days,
         min(ts) as first_session, max(ts) as last_session,
         count(*) filter (ts <= timestamp '2024-01-16') as early_usage,
         count(*) filter (ts > timestamp '2024-01-16') as late_usage,
         count(*) filter (ts > timestamp '2024-01-16') - count(*) filter (ts <= timestamp '2024-01-16') as usage_trend
  from events where event_type in ('view', 'click') and user_id is not null group by 1)"""

VISITS = r"""visits as (
  select e.user_id as member_id, p.url, e.ts,
         nullif(regexp_extract(p.url, 'https://([^/]+)/([^/]+)/(\d+)', 1), '') as domain,
         nullif(regexp_extract(p.url, 'https://([^/]+)/([^/]+)/(\d+)', 2), '') as category,
         nullif(regexp_extract(p.url, 'https://([^/]+)/([^/]+)/(\d+)', 3), '') as page
  from events e join pages p on p.page_id = e.event_id % (select count(*) from pages)
  where e.event_type in ('view', 'click', 'signup')),
own as (select *, coalesce(contains(domain, 'example.com'), false) as is_own_domain from visits)"""

WEB_F = """web as (
  select member_id, count(url) as total_web_visits, count(distinct domain) as unique_domains,
         count(distinct category) as unique_categories, count(distinct page) as unique_pages, max(ts) as last_visit,
         cast(sum(cast(is_own_domain as int)) as bigint) as own_domain_visits,
         cast(sum(cast(is_own_domain as int)) as double) / nullif(count(url), 0) as ratio_own_domain,
         count(*) filter (ts <= timestamp '2024-01-16') as early_visits,
         count(*) filter (ts > timestamp '2024-01-16') as late_visits,
         count(*) filter (ts > timestamp '2024-01-16') - count(*) filter (ts <= timestamp '2024-01-16') as visit_trend
  from own group by 1)"""

CLAIM_ROWS = """claim_rows as (
  select o_custkey as member_id, p_brand as icd_code, p_type as icd_group, l_shipdate as diagnosis_date
  from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey)"""

CLAIM_F = "claim as (\n  select member_id, count(icd_code) as total_claims, count(distinct icd_code) as unique_icd_codes,\n" \
    "    count(distinct substr(icd_group, 1, 3)) as unique_icd_categories, max(diagnosis_date) as last_claim,\n    " + \
    ",\n    ".join(f"max(case when icd_code = '{b}' then 1 else 0 end) as {f}" for b, f in zip(BRANDS, FLAGS)) + """,
    count(*) filter (diagnosis_date <= timestamp '1998-07-01') as early_claims,
    count(*) filter (diagnosis_date > timestamp '1998-07-01') as late_claims,
    count(*) filter (diagnosis_date > timestamp '1998-07-01') - count(*) filter (diagnosis_date <= timestamp '1998-07-01')
      as claim_trend
  from claim_rows group by 1)"""

JOINED_COLUMNS = ["member_id", "signup_date", "churn", "outreach", "tenure_days", "treatment", "y", "app_sessions",
                  "active_days", "first_session", "last_session", "early_usage", "late_usage", "usage_trend",
                  "total_web_visits", "unique_domains", "unique_categories", "unique_pages", "last_visit",
                  "own_domain_visits", "ratio_own_domain", "early_visits", "late_visits", "visit_trend",
                  "total_claims", "unique_icd_codes", "unique_icd_categories", "last_claim", *FLAGS,
                  "early_claims", "late_claims", "claim_trend"]
JOINED = "joined as materialized (select " + ", ".join(JOINED_COLUMNS) + """
  from labelled left join app using (member_id) left join web using (member_id) left join claim using (member_id))"""

TABLES = (MEMBERS, LABELS, APP_F, VISITS, WEB_F, CLAIM_ROWS, CLAIM_F, JOINED)


def zero(c: str) -> str:
    return f"coalesce({c}, 0) as {c}"


FEATURE_CTE = "features as materialized (select member_id, " + ", ".join(zero(c) for c in FEATURES) + \
    ", treatment, y from joined)"
BASE = (*TABLES, FEATURE_CTE)

SCORE = "cast(usage_trend * 7 + claim_trend * 5 - tenure_days % 13 as double) / 1024.0::double"
SCORES = f"scores as materialized (select member_id, y, treatment, {SCORE} as uplift from features)"
MODEL_SCORES = f"""model_scores as materialized (
  select member_id, y, treatment, 'trend' as model, {SCORE} as uplift from features
  union all select member_id, y, treatment, 'usage', cast(usage_trend as double) / 16.0::double from features
  union all select member_id, y, treatment, 'claims', cast(total_claims * 3 - unique_icd_codes * 2 as double) / 128.0::double from features
  union all select member_id, y, treatment, 'tenure', cast(tenure_days as double) / 1024.0::double from features)"""
GIVEN = """given as (select member_id, y, treatment, 0.05::double + (tenure_days % 10) * 0.1::double as p,
  (total_claims % 20) / 20.0::double as mu0, (unique_icd_codes % 16) / 16.0::double as mu1 from features)"""

ORACLE: dict[str, str] = {}


def feature_list(cols, table: str = "features") -> str:
    out = [r6(c, c) if c == "ratio_own_domain" else c for c in cols]
    return f"select {', '.join(out)} from {table}"


# --- sources, projections -------------------------------------------------------------------------------------

ORACLE["a1_csv_scan"] = with_(MEMBERS, VISITS, CLAIM_ROWS) + """
  select 'app_usage' as source, user_id as member_id, 'session' as what, null as more, strftime(ts, '%Y-%m-%d %H:%M:%S') as at
  from events where event_type in ('view', 'click')
  union all select 'web_visits', user_id, url, 'A "title",' || chr(10) || 'of ' || url, strftime(ts, '%Y-%m-%d %H:%M:%S')
  from events join pages on page_id = event_id % (select count(*) from pages) where event_type in ('view', 'click', 'signup')
  union all select 'claims', member_id, icd_code, null, strftime(diagnosis_date, '%Y-%m-%d') from claim_rows
  union all select 'churn_labels', member_id, cast(churn as varchar), cast(outreach as varchar), strftime(signup_date, '%Y-%m-%d') from members"""
ORACLE["a2_split_features"] = with_(*BASE) + f"""select case when {held('member_id')} then 'test' else 'train' end as split,
  * replace (round(ratio_own_domain, 6) + 0.0 as ratio_own_domain) from features"""
ORACLE["b1_strict_parse"] = with_(MEMBERS) + "select member_id, signup_date from members"
ORACLE["b2_lenient_parse"] = "select event_id, case when event_type <> 'error' then date_trunc('second', ts) end as timestamp from events"
ORACLE["b3_tenure"] = with_(MEMBERS, LABELS) + "select member_id, signup_date, tenure_days from labelled"
ORACLE["b4_targets"] = with_(MEMBERS, LABELS) + "select member_id, treatment, y from labelled"
ORACLE["b5_url_parts"] = with_(VISITS) + "select member_id, url, domain, category, page from visits"
ORACLE["b6_own_domain"] = with_(VISITS) + "select member_id, url, is_own_domain from own"
ORACLE["b7_code_prefix"] = with_(CLAIM_ROWS) + "select icd_group, substr(icd_group, 1, 3) as icd_category, count(*) as n from claim_rows group by 1, 2"
ORACLE["b8_code_flags"] = with_(CLAIM_ROWS, CLAIM_F) + f"select member_id, {', '.join(FLAGS)} from claim"
ORACLE["b10_ratio"] = with_(VISITS, WEB_F) + f"select member_id, {r6('ratio_own_domain', 'ratio_own_domain')} from web"

_dates = {"first_session", "last_session", "last_visit", "last_claim"}


def _rule_filled(c: str) -> str:
    if c in _dates:
        return f"coalesce({c}, timestamp '2024-01-01') as {c}"
    if any(p in c for p in COUNT_PARTS):
        return zero(c)
    return r6(c, c) if c == "ratio_own_domain" else c


ORACLE["b11_null_fill"] = with_(*TABLES) + "select " + ", ".join(_rule_filled(c) for c in JOINED_COLUMNS) + " from joined"
ORACLE["b12_residual_fill"] = with_(*BASE) + feature_list(["member_id", *FEATURES, "treatment", "y"])
ORACLE["b13_projection"] = with_(*TABLES) + feature_list(["member_id", *FEATURES, "treatment", "y"], "joined")
ORACLE["b14_drop_redundant"] = with_(*BASE) + feature_list(
    ["member_id", *[f for f in FEATURES if f not in ("app_sessions", "total_claims")], "treatment", "y"])
ORACLE["b15_interactions"] = with_(*BASE) + "select member_id, " + ", ".join(
    f"treatment * {f} as outreach_x_{f}" for f in ("early_claims", "claim_trend", "has_icd_Brand_6")) + \
    ", treatment * total_web_visits as clinical_x_total_web_visits from features"
ORACLE["b16_keyword_pick"] = with_(*BASE) + "select member_id, total_web_visits, has_icd_Brand_1, has_icd_Brand_10 from features"
ORACLE["b17_arm_filter"] = with_(*BASE) + "select member_id, y from features where treatment = 1"
_clip = "greatest(0.1::double, least(0.9::double, p))"
ORACLE["b18_inverse_weights"] = with_(*BASE, GIVEN) + f"""select member_id,
  {r6("case when treatment = 1 then 1.0::double / p else 1.0::double / (1.0::double - p) end", "weight")},
  {r6(f"case when treatment = 1 then 1.0::double / {_clip} else 1.0::double / (1.0::double - {_clip}) end", "clipped_weight")}
  from given"""
ORACLE["b18_weight_report"] = with_(*BASE, GIVEN) + f"""select treatment, count(*) as members,
  count(*) filter (p < 0.1::double or p > 0.9::double) as clipped,
  {r6("max(case when treatment = 1 then 1.0::double / p else 1.0::double / (1.0::double - p) end)", "max_weight")}
  from given group by 1"""
ORACLE["b19_uplift_difference"] = with_(*BASE, GIVEN) + f"select member_id, {r6('mu1 - mu0', 'uplift')} from given"
ORACLE["b20_imputed_effects"] = with_(*BASE, GIVEN) + \
    f"select member_id, {r6('case when treatment = 1 then y - mu0 else mu1 - y end', 'effect')} from given"
ORACLE["b21_blended_effect"] = with_(*BASE, GIVEN) + \
    f"select member_id, {r6('p * mu0 + (1.0::double - p) * mu1', 'uplift')} from given"

ORACLE["j7_pseudo_outcome"] = with_(*BASE, GIVEN) + f"""select member_id, {r6(f'mu1 - mu0 + treatment * (y - mu1) / {_clip} '
    f'- (1 - treatment) * (y - mu0) / (1.0::double - {_clip})', 'pseudo')} from given"""

# --- joins, aggregates ----------------------------------------------------------------------------------------

ORACLE["c1_feature_join"] = with_(*TABLES) + feature_list(JOINED_COLUMNS, "joined")
ORACLE["c3_keyed_columns"] = with_(*BASE) + f"""select member_id, tenure_days, app_sessions, total_claims, treatment, y,
  {r6(SCORE, 'uplift')} from features"""

CLAIM_SPLIT = f"tagged as (select *, {held('member_id')} as is_test from claim_rows)"


FREQUENCIES = (CLAIM_ROWS, CLAIM_SPLIT,
    """long as (select is_test, 'icd_code' as feature, icd_code as category from tagged
  union all select is_test, 'icd_group', icd_group from tagged)""",
    """counts as (select feature, category, count(*) filter (not is_test) as n_train, count(*) filter (is_test) as n_test
  from long where category is not null group by 1, 2)""",
    """freq as (select feature, category, n_train, n_test,
  n_train / cast(sum(n_train) over (partition by feature) as double) as freq_train,
  n_test / cast(sum(n_test) over (partition by feature) as double) as freq_test from counts)""")


ORACLE["c4_frequency_alignment"] = with_(*FREQUENCIES) + f"""select feature, category, n_train, n_test,
  {r6('freq_train', 'freq_train')}, {r6('freq_test', 'freq_test')} from freq"""
ORACLE["d1_app_usage"] = with_(APP_F) + "select member_id, app_sessions, active_days, first_session, last_session from app"
ORACLE["d2_trends"] = with_(*TABLES) + """select member_id, early_usage, late_usage, usage_trend, early_visits, late_visits,
  visit_trend, early_claims, late_claims, claim_trend from joined"""
ORACLE["d3_web_aggregate"] = with_(VISITS, WEB_F) + """select member_id, total_web_visits, unique_domains, unique_categories,
  unique_pages, last_visit, own_domain_visits from web"""
ORACLE["d4_web_features"] = with_(VISITS, WEB_F) + f"select * replace (round(ratio_own_domain, 6) + 0.0 as ratio_own_domain) from web"
ORACLE["d5_claims_features"] = with_(CLAIM_ROWS, CLAIM_F) + "select * from claim"
ORACLE["d6_value_counts"] = with_(*BASE) + """select 'y' as "column", y as value, count(*) as count from features group by 2
  union all select 'treatment', treatment, count(*) from features group by 2"""
ORACLE["d7_null_audit"] = with_(*TABLES, f"s as (select *, {held('member_id')} as is_test from joined)") + " union all ".join(
    f"""select '{split}' as split, '{c}' as "column", count(*) filter ({c} is null) as nulls from s where {cond}
    having count(*) filter ({c} is null) > 0"""
    for split, cond in (("train", "not is_test"), ("test", "is_test")) for c in JOINED_COLUMNS)


def avg(c: str, cond: str | None = None) -> str:
    f = f" filter ({cond})" if cond else ""
    return f"sum(cast({c} as double)){f} / count({c}){f}"


ORACLE["d8_arm_means"] = with_(*BASE) + "select treatment, " + ", ".join(r6(avg(c), c) for c in FEATURES) + \
    " from features group by 1"


def arm_long(features, source: str, where: str = "true", tag: str | None = None) -> str:
    lead = f"'{tag}' as split, " if tag else ""
    return " union all ".join(
        f"select {lead}'{c}' as feature, {avg(c, 'treatment = 0')} as c, {avg(c, 'treatment = 1')} as t from {source} where {where}"
        for c in features)


ARM_COLUMNS = f"{r6('t - c', 'difference')}, {r6('c', 'control_mean')}, {r6('t', 'treated_mean')}, {r6('abs(t - c)', 'abs_difference')}"
SPLIT_F = f"split_features as (select *, {held('member_id')} as is_test from features)"
ORACLE["d9_arm_differences"] = with_(*BASE, SPLIT_F, "m as (" + arm_long(FEATURES, "split_features", "not is_test", "train")
                                     + " union all " + arm_long(FEATURES, "split_features", "is_test", "test") + ")") + \
    f"select split, feature, {ARM_COLUMNS} from m"
ORACLE["a4_report_sink"] = ORACLE["d9_arm_differences"]
ORACLE["f1_top_differences"] = with_(*BASE, "m as (" + arm_long(FEATURES, "features") + ")") + \
    f"select feature, {ARM_COLUMNS} from m order by abs(t - c) desc, feature limit 15"
ORACLE["d24_priority_comparison"] = with_(*BASE, "m as (" + arm_long(
    ["total_web_visits", "has_icd_Brand_1", "has_icd_Brand_10"], "features") + ")") + \
    f"select feature, {r6('c', 'control_mean')}, {r6('t', 'treated_mean')}, {r6('t - c', 'difference')} from m"


def feature_long(features, keep: str, source: str = "features") -> str:
    return " union all ".join(f"select {keep}, '{c}' as feature, cast({c} as double) as value from {source}" for c in features)


def percentiles(by: str, shares) -> list[str]:
    """Order statistics by integer rank, then interpolation; ``long`` must hold (by, value)."""
    cols = []
    for name, num, den in shares:
        low = f"max(value) filter (rn = (n - 1) * {num} // {den})"
        high = f"max(value) filter (rn = least((n - 1) * {num} // {den} + 1, n - 1))"
        cols.append(f"{low} + ({high} - {low}) * ((max(n) - 1) * {num} % {den} / {den}.0::double) as {name}")
    return [f"ordered as (select *, row_number() over (partition by {by} order by value) - 1 as rn, "
            f"count(*) over (partition by {by}) as n from long where value is not null)",
            f"marks as (select {by}, {', '.join(cols)} from ordered group by {by})"]


QUARTILES = [("p25", 1, 4), ("p50", 1, 2), ("p75", 3, 4)]


def describe(by: str) -> str:
    cols = [f"count(value) as count", f"{r6(avg('value'), 'mean')}", f"{r6('stddev_samp(value)', 'std')}",
            f"{r6('min(value)', 'min')}"]
    return f"select {by}, {', '.join(cols)}, {r6('max(value)', 'max')} from long group by {by}"


ORACLE["d10_describe"] = with_(*BASE, f"long as ({feature_long(FEATURES, 'treatment')})",
                               *percentiles("treatment, feature", QUARTILES), f"basics as ({describe('treatment, feature')})") + \
    f"""select treatment, feature, count, mean, std, min, {', '.join(r6(p[0], p[0]) for p in QUARTILES)}, max
  from basics join marks using (treatment, feature)"""
ORACLE["d11_average_effect"] = with_(*BASE) + f"""select {r6(avg('y', 'treatment = 1') + ' - ' + avg('y', 'treatment = 0'), 'ate')},
  {r6(avg('y', 'treatment = 1'), 'treated_rate')}, {r6(avg('y', 'treatment = 0'), 'control_rate')} from features"""

EDGES = [("lowest", 0, 1), ("edge_1", 1, 3), ("edge_2", 2, 3), ("highest", 1, 1)]
EDGE_STEPS = (f"long as materialized ({feature_long(FEATURES, 'treatment, y')})", *percentiles("feature", EDGES),
              """edges as (select *, case when lowest < edge_1 and edge_1 < edge_2 and edge_2 < highest then 'ok'
  else 'skipped_ties' end as status from marks)""")
ORACLE["e6_tertile_edges"] = with_(*BASE, *EDGE_STEPS) + \
    f"select feature, {', '.join(r6(e[0], e[0]) for e in EDGES)}, status from edges"
PLAN_STEPS = (*EDGE_STEPS, "gate as (select feature, count(distinct value) as n_distinct from long group by 1)",
              """plan as (select feature, case when n_distinct <= 1 then 'constant' when n_distinct <= 3 then 'categorical'
  else 'numeric' end as kind, n_distinct, edge_1, edge_2,
  case when n_distinct <= 1 then 'skipped_constant' when n_distinct <= 3 then 'ok' else status end as status
  from gate join edges using (feature))""")
ORACLE["d18_segment_plan"] = with_(*BASE, *PLAN_STEPS) + \
    f"select feature, kind, n_distinct, {r6('edge_1', 'edge_1')}, {r6('edge_2', 'edge_2')}, status from plan"
SEGMENT_STEPS = (*PLAN_STEPS, """cells as (select feature, case when kind = 'categorical' then cast(value as varchar)
    when value <= edge_1 then 'Low' when value <= edge_2 then 'Medium' else 'High' end as segment,
    count(*) as members, count(*) filter (treatment = 1) as n_treated, count(*) filter (treatment = 0) as n_control,
    count(*) filter (treatment = 1 and y = 1) as yt, count(*) filter (treatment = 0 and y = 1) as yc
  from long join plan using (feature) where status = 'ok' and value is not null group by 1, 2)""",
                 """effects as (select feature, segment, yt / n_treated::double - yc / n_control::double as ate, members,
    n_treated, n_control, yt / n_treated::double as treated_rate, yc / n_control::double as control_rate
  from cells where n_treated > 0 and n_control > 0)""")
ORACLE["d12_segment_effects"] = with_(*BASE, *SEGMENT_STEPS) + f"""select feature, segment, {r6('ate', 'ate')}, members, n_treated,
  n_control, {r6('treated_rate', 'treated_rate')}, {r6('control_rate', 'control_rate')} from effects"""
ORACLE["d13_segment_extremes"] = with_(*BASE, *SEGMENT_STEPS, f"""overall as (select {avg('y', 'treatment = 1')} - {avg('y', 'treatment = 0')} as o
  from features)""", """placed as (select *, coalesce(list_position(['Low', 'Medium', 'High'], segment), 0) as place from effects)""",
    """ranked as (select *, row_number() over (partition by feature order by ate, place, segment) as lo,
  row_number() over (partition by feature order by ate desc, place, segment) as hi from placed)""") + f"""
  select b.feature, b.segment as best_segment, {r6('b.ate', 'best_ate')}, b.members as best_members, b.ate < o as best_reported,
    w.segment as worst_segment, {r6('w.ate', 'worst_ate')}, w.members as worst_members, w.ate > 0 as worst_reported
  from ranked b join ranked w on w.feature = b.feature and w.hi = 1 cross join overall where b.lo = 1"""

# --- correlation and selection --------------------------------------------------------------------------------

CORR_NAMES = [*FEATURES, "y", "treatment"]


def _corr(a: str, b: str) -> str:
    return (f"case when min({a}) = max({a}) or min({b}) = max({b}) then null "
            f"else corr(cast({a} as double), cast({b} as double)) end")


def corr_steps() -> tuple[str, ...]:
    pairs = [(a, b) for i, a in enumerate(CORR_NAMES) for b in CORR_NAMES[i + 1:]]
    columns = ", ".join(f"{_corr(a, b)} as \"{a}|{b}\"" for a, b in pairs)
    row = f"wide as materialized (select {columns} from features)"
    long = ("upper_half as (select split_part(pair, '|', 1) as feature_1, split_part(pair, '|', 2) as feature_2, corr from "
            "wide unpivot include nulls (corr for pair in (*)))")
    diag = " union all ".join(
        f"select '{c}' as feature_1, '{c}' as feature_2, case when min({c}) < max({c}) then 1.0::double end as corr from features"
        for c in CORR_NAMES)
    full = f"""corr as materialized (select feature_1, feature_2, corr from upper_half union all
  select feature_2, feature_1, corr from upper_half union all {diag})"""
    names = ", ".join(f"('{c}', {i})" for i, c in enumerate(FEATURES))
    order = f"places(feature, place) as (values {names})"
    pair = """pairs as materialized (select feature_1, feature_2, abs(corr) as abs_corr from upper_half
  where abs(corr) > 0.8 and feature_1 in (select feature from places) and feature_2 in (select feature from places))"""
    return (row, long, full, order, pair)


CORR = corr_steps()
ORACLE["d14_correlation_matrix"] = with_(*BASE, *CORR) + f"select feature_1, feature_2, {r6('corr', 'corr')} from corr"
ORACLE["h1_redundant_pairs"] = with_(*BASE, *CORR) + f"select feature_1, feature_2, {r6('abs_corr', 'abs_corr')} from pairs"
ORACLE["h2_target_correlation"] = with_(*BASE, *CORR) + f"""select a.feature_1 as feature, {r6('abs(a.corr)', 'abs_corr_outcome')},
  {r6('abs(b.corr)', 'abs_corr_treatment')} from corr a join corr b on a.feature_1 = b.feature_1
  where a.feature_2 = 'y' and b.feature_2 = 'treatment' and a.feature_1 in (select feature from places)"""
WALK = """numbered as materialized (select pairs.feature_1 as f1, pairs.feature_2 as f2, round(abs(a.corr), 12) as c1, round(abs(b.corr), 12) as c2,
    row_number() over (order by round(abs_corr, 12) desc, pairs.feature_1, pairs.feature_2) as rn
  from pairs join corr a on a.feature_1 = pairs.feature_1 and a.feature_2 = 'y'
    join corr b on b.feature_1 = pairs.feature_2 and b.feature_2 = 'y'),
walk(i, dropped) as (select cast(0 as bigint), []::varchar[] union all
  select i + 1, case when list_contains(dropped, f1) or list_contains(dropped, f2) then dropped
    when c1 < c2 then list_append(dropped, f1) else list_append(dropped, f2) end
  from walk join numbered on rn = i + 1)"""
ORACLE["h3_greedy_drop"] = "with recursive " + ",\n".join([*BASE, *CORR, WALK]) + \
    "\nselect unnest(dropped) as feature from walk where i = (select max(i) from walk)"
ORACLE["f4_interaction_candidates"] = with_(*BASE, *CORR) + " union all ".join(
    f"""(select {t}::double as threshold, feature_1 as feature, {r6('abs(corr)', 'abs_corr')} from corr
  where feature_2 = 'treatment' and feature_1 in (select feature from places) and abs(corr) > {t}
  order by abs(corr) desc, feature_1 limit 15)""" for t in (0.1, 0.01))
ORACLE["h6_interaction_features"] = with_(*BASE, *CORR, """chosen as (select feature_1 as feature from corr
  where feature_2 = 'treatment' and feature_1 in (select feature from places) and abs(corr) > 0.0
  order by abs(corr) desc, feature_1 limit 15)""", f"all_long as ({feature_long(FEATURES, 'treatment')})",
    "long as (select treatment, 'outreach_x_' || feature as feature, treatment * value as value from all_long join chosen using (feature))",
    *percentiles("treatment, feature", QUARTILES), f"basics as ({describe('treatment, feature')})") + \
    f"""select treatment, feature, count, mean, std, min, {', '.join(r6(p[0], p[0]) for p in QUARTILES)}, max
  from basics join marks using (treatment, feature)"""

# Totals and trends are sums and differences of early and late counts, so these six add nothing to the others.
DERIVED = ("app_sessions", "usage_trend", "total_web_visits", "visit_trend", "total_claims", "claim_trend")
COLLINEAR = (*DERIVED, "early_usage", "late_usage", "early_visits", "late_visits", "early_claims", "late_claims")
INDEPENDENT = [f for f in FEATURES if f not in DERIVED]


def vif_steps() -> tuple[str, ...]:
    """Sums of products, inverted in place one pivot at a time."""
    n = range(len(INDEPENDENT))
    sums = ", ".join(f"sum(cast({INDEPENDENT[i]} as double) * {INDEPENDENT[j]}) as g_{i}_{j}" for i in n for j in n)
    steps = [f"s_0 as materialized (select {sums} from features)"]
    for k in n:
        def entry(i: int, j: int) -> str:
            if i == k and j == k:
                return f"1 / g_{k}_{k}"
            if i == k:
                return f"g_{k}_{j} / g_{k}_{k}"
            if j == k:
                return f"-g_{i}_{k} / g_{k}_{k}"
            return f"g_{i}_{j} - g_{i}_{k} * g_{k}_{j} / g_{k}_{k}"
        steps.append(f"s_{k + 1} as materialized (select " + ", ".join(f"{entry(i, j)} as g_{i}_{j}" for i in n for j in n) + f" from s_{k})")
    return tuple(steps)


VIF = "vif as (" + " union all ".join(
    [f"select '{c}' as feature, s_0.g_{i}_{i} * z.g_{i}_{i} as vif, false as is_collinear from s_0, s_{len(INDEPENDENT)} z"
     for i, c in enumerate(INDEPENDENT) if c not in COLLINEAR]
    + [f"select '{c}', null, true" for c in COLLINEAR]) + ")"
ORACLE["h4_vif"] = with_(*BASE, *vif_steps(), VIF) + f"select feature, {r6('vif', 'vif')}, is_collinear from vif"
ORACLE["h5_selection_summary"] = "with recursive " + ",\n".join([*BASE, *vif_steps(), VIF, *CORR, WALK]) + f"""
  select {len(FEATURES)}::bigint as n_features, (select count(*) from pairs) as n_high_corr,
  (select count(*) from vif where is_collinear or vif > 10) as n_vif_high,
  (select len(dropped) from walk where i = (select max(i) from walk))::bigint as n_dropped"""

# --- tests, drift ---------------------------------------------------------------------------------------------

_tail = """(select sum(case when i in (0, 4000) then 1 when i % 2 = 1 then 4 else 2 end
     * pow(cos(a + (pi() / 2 - a) * i / 4000), dof - 1)) * (pi() / 2 - a) / 12000
   from range(0, 4001) g(i))"""
WELCH_STEPS = (f"long as ({feature_long(FEATURES, 'treatment')})", """arms as (select feature,
    sum(value) filter (treatment = 1) / count(*) filter (treatment = 1) as mt,
    sum(value) filter (treatment = 0) / count(*) filter (treatment = 0) as mc,
    var_samp(value) filter (treatment = 1) / count(*) filter (treatment = 1) as st,
    var_samp(value) filter (treatment = 0) / count(*) filter (treatment = 0) as sc,
    count(*) filter (treatment = 1) as nt, count(*) filter (treatment = 0) as nc from long group by 1)""",
               "top as (select * from arms order by abs(mt - mc) desc, feature limit 20)",
               """tested as (select feature, mt - mc as difference, (mt - mc) / sqrt(nullif(st + sc, 0)) as t_stat,
  (st + sc) * (st + sc) / nullif(st * st / (nt - 1) + sc * sc / (nc - 1), 0) as dof from top)""",
               # Two-sided tail of Student's t as a ratio of two integrals over the angle, by Simpson's rule.
               f"""tails as (select *, {_tail} as upper_tail from (select *, atan(abs(t_stat) / sqrt(dof)) as a from tested)),
whole as (select feature, difference, t_stat, dof, upper_tail, {_tail} as full_tail from (select *, 0.0::double as a from
  (select feature, difference, t_stat, dof, upper_tail from tails)))""")
ORACLE["d15_welch_test"] = with_(*BASE, *WELCH_STEPS) + f"""select feature, {r6('difference', 'difference')}, {r6('t_stat', 't_stat')},
  {r6('dof', 'dof')}, {r6('upper_tail / full_tail', 'p_value')}, coalesce(upper_tail / full_tail < 0.05, false) as significant from whole"""


def drift(columns, source: str = "s") -> str:
    return " union all ".join(f"""select '{c}' as feature, {avg(c, 'not is_test')} as mean_train, {avg(c, 'is_test')} as mean_test,
  stddev_samp(cast({c} as double)) filter (not is_test) as std_train from {source}""" for c in columns)


ORACLE["d16_numeric_drift"] = with_(*BASE, f"s as (select *, {held('member_id')} as is_test from features)", f"m as ({drift(FEATURES)})") + f"""
  select feature, {r6('mean_train', 'mean_train')}, {r6('mean_test', 'mean_test')}, {r6('mean_test - mean_train', 'mean_shift')},
  {r6('std_train', 'std_train')}, coalesce(abs(mean_test - mean_train) > std_train * 0.2, false) as drifted from m"""
ORACLE["d17_categorical_drift"] = with_(*FREQUENCIES) + f"""select feature,
  {r6('max(abs(freq_train - freq_test))', 'max_freq_diff')}, max(abs(freq_train - freq_test)) > 0.1 as drifted from freq group by 1"""

G1_TRAIN = ["member_id", *FEATURES, "treatment", "y"]
G1_TEST = [c for c in reversed(G1_TRAIN) if c != "usage_trend"]
_shared = [c for c in G1_TRAIN if c in G1_TEST]
ORACLE["g1_schema_consistency"] = " union all ".join(
    f"select '{c}' as \"column\", true as in_train, {c in G1_TEST} as in_test, {G1_TRAIN.index(c)} as pos_train, "
    + (f"{G1_TEST.index(c)} as pos_test, {_shared.index(c) == G1_TEST.index(c)} as order_ok" if c in G1_TEST else "null, null")
    for c in G1_TRAIN)
G2_COLUMNS = [*JOINED_COLUMNS, "claim_band"]


def _g2() -> str:
    rows = []
    for c in G2_COLUMNS:
        rows += [f"select 'schema' as \"check\", '{c}' as \"column\", '{m}' as metric, 1.0::double as value" for m in ("in_train", "in_test", "order_ok")]
    for split, cond in (("train", "not is_test"), ("test", "is_test")):
        rows += [f"select 'nulls', '{c}', '{split}', count(*) filter ({c} is null)::double from s where {cond} "
                 f"having count(*) filter ({c} is null) > 0" for c in G2_COLUMNS]
    rows.append(f"select 'numeric drift', feature, 'mean_shift', round(mean_test - mean_train, 6) + 0.0 from m")
    rows.append("select 'numeric drift', feature, 'drifted', coalesce(abs(mean_test - mean_train) > std_train * 0.2, false)::int::double from m")
    rows.append("select 'categorical drift', 'claim_band', 'max_freq_diff', round(max(abs(a - b)), 6) + 0.0 from f")
    rows.append("select 'categorical drift', 'claim_band', 'drifted', (max(abs(a - b)) > 0.1)::int::double from f")
    return with_(*TABLES, f"""s as (select *, case when total_claims > 45 then 'many' when total_claims > 30 then 'some' end as claim_band
  from (select *, {held('member_id')} as is_test from joined))""", f"m as ({drift(FEATURES)})",
        """f as (select claim_band, count(*) filter (not is_test) / sum(count(*) filter (not is_test)) over ()::double as a,
  count(*) filter (is_test) / sum(count(*) filter (is_test)) over ()::double as b from s where claim_band is not null group by 1)""") + " union all ".join(rows)


ORACLE["g2_health_check"] = _g2()

# --- reports --------------------------------------------------------------------------------------------------

SUMMARY = f"{r6('min(uplift)', 'min')}, {r6('max(uplift)', 'max')}, {r6('max(uplift) - min(uplift)', 'range')}, " \
    f"{r6('avg(uplift)', 'mean')}, {r6('stddev_pop(uplift)', 'std')}"
ORACLE["d19_score_summary"] = with_(*BASE, MODEL_SCORES) + f"select model, {SUMMARY} from model_scores group by 1"
ORACLE["d20_propensity_by_arm"] = with_(*BASE, GIVEN, "long as (select treatment, 'p' as feature, p as value from given)",
    *percentiles("treatment, feature", QUARTILES), f"basics as ({describe('treatment, feature')})",
    f"gap as (select avg(p) filter (treatment = 1) - avg(p) filter (treatment = 0) as g from given)") + f"""
  select treatment, feature, count, mean, std, min, {', '.join(r6(p[0], p[0]) for p in QUARTILES)}, max, {r6('g', 'mean_gap')}
  from basics join marks using (treatment, feature) cross join gap"""
ORACLE["d21_histogram"] = with_(*BASE, SCORES, """ends as (select treatment, min(uplift) as lo, max(uplift) as hi from scores group by 1)""",
    """guess as (select treatment, uplift, lo, (hi - lo) / 30.0::double as w,
  greatest(0, least(29, cast(floor((uplift - lo) * 30.0::double / (hi - lo)) as bigint))) as b from scores join ends using (treatment))""",
    """placed as (select treatment, lo, w, case when uplift < lo + b * w then b - 1
  when b < 29 and uplift >= lo + (b + 1) * w then b + 1 else b end as bin from guess)""") + f"""
  select treatment, bin, {r6('lo + bin * w', 'lower')}, {r6('lo + (bin + 1) * w', 'upper')}, count(*) as count
  from placed group by treatment, bin, lo, w"""
ORACLE["d21_uplift_histogram"] = with_(*BASE, SCORES, """ends as (select min(uplift) as lo, max(uplift) as hi from scores)""",
    """guess as (select uplift, lo, (hi - lo) / 50.0::double as w,
  greatest(0, least(49, cast(floor((uplift - lo) * 50.0::double / (hi - lo)) as bigint))) as b from scores, ends)""",
    """placed as (select lo, w, case when uplift < lo + b * w then b - 1
  when b < 49 and uplift >= lo + (b + 1) * w then b + 1 else b end as bin from guess)""") + f"""
  select bin, {r6('lo + bin * w', 'lower')}, {r6('lo + (bin + 1) * w', 'upper')}, count(*) as count
  from placed group by bin, lo, w"""
PERCENTS = [(f"p{p}", p, 100) for p in (10, 25, 50, 75, 90)]
ORACLE["d22_percentiles"] = with_(*BASE, MODEL_SCORES, "long as (select model, uplift as value from model_scores)",
    *percentiles("model", PERCENTS)) + " union all ".join(
    f"select model, {p} as percentile, {r6(n, 'value')} from marks" for n, p, _ in PERCENTS)
ORACLE["d23_classification_report"] = with_(*BASE, SCORES, """cells as (select count(*) filter (uplift < 0 and y = 0)::double as c00,
    count(*) filter (uplift < 0 and y = 1)::double as c01, count(*) filter (uplift >= 0 and y = 0)::double as c10,
    count(*) filter (uplift >= 0 and y = 1)::double as c11 from scores)""",
    """per_class as (select '0' as label, c00 / (c00 + c01) as precision, c00 / (c00 + c10) as recall,
    2 * c00 / (2 * c00 + c01 + c10) as f1, (c00 + c10)::bigint as support from cells
  union all select '1', c11 / (c10 + c11), c11 / (c01 + c11), 2 * c11 / (2 * c11 + c01 + c10), (c01 + c11)::bigint from cells)""",
    """rows as (select * from per_class
  union all select 'accuracy', (c00 + c11) / n, (c00 + c11) / n, (c00 + c11) / n, n::bigint
    from (select *, c00 + c01 + c10 + c11 as n from cells)
  union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::bigint from per_class
  union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support)::bigint from per_class)""") + \
    f"select label, {r6('precision', 'precision')}, {r6('recall', 'recall')}, {r6('f1', 'f1')}, support from rows"
ORACLE["d23_roc_auc"] = with_(*BASE, MODEL_SCORES, """g as (select model, uplift, sum(y) as pos, sum(1 - y) as neg from model_scores group by 1, 2)""",
    "w as (select *, sum(neg) over (partition by model order by uplift) - neg as below from g)") + f"""
  select model, {r6('sum(pos * (below + neg / 2.0::double)) / (sum(pos) * sum(neg))::double', 'roc_auc')} from w group by 1"""

# --- curves ---------------------------------------------------------------------------------------------------


def running(direction: str = "desc") -> str:
    w = f"over (order by uplift {direction}, member_id rows unbounded preceding)"
    return f"""run as materialized (select member_id, uplift, row_number() over (order by uplift {direction}, member_id) as k,
  (sum(treatment) {w})::double as nt, (sum(1 - treatment) {w})::double as nc, (sum(y * treatment) {w})::double as yt,
  (sum(y * (1 - treatment)) {w})::double as yc, sum(uplift) {w} as su, count(*) over () as n from scores)"""


GAIN_B = "yt - case when nc > 0 then yc * nt / nc else 0.0::double end"
GAIN_A = "case when nt > 0 and nc > 0 then yc * nt / nc - yt else 0.0::double end"
TOTALS = """totals as (select (sum(y) filter (treatment = 0) / count(*) filter (treatment = 0)::double
  - sum(y) filter (treatment = 1) / count(*) filter (treatment = 1)::double) * count(*) filter (treatment = 1) as total from scores)"""
for _name, _direction in (("e1_rank_ascending", "asc"), ("e1_rank_descending", "desc")):
    ORACLE[_name] = with_(*BASE, SCORES) + f"""select member_id, {r6('uplift', 'uplift')},
  row_number() over (order by scores.uplift {_direction}, member_id) as rank from scores"""
ORACLE["e1_rank_heavy_ties"] = with_(*BASE) + """select member_id, round(usage_trend / 16.0::double, 6) + 0.0 as uplift,
  row_number() over (order by usage_trend desc, member_id) as rank from features"""
ORACLE["e2_prevented_curve"] = with_(*BASE, SCORES, running(), TOTALS) + f"""select member_id, k, {r6(GAIN_A, 'qini_gain')},
  {r6('k / n::double * total', 'random_gain')} from run cross join totals"""
CURVE_B = f"select member_id, k, {r6(GAIN_B, 'qini_gain')}, {r6('su / k', 'avg_uplift')}, {r6('k * 100.0::double / n', 'pct_targeted')} from run"
ORACLE["e3_gain_curve"] = with_(*BASE, SCORES, running()) + CURVE_B
ORACLE["e3_gain_curve_ascending"] = with_(*BASE, SCORES, running("asc")) + CURVE_B
ORACLE["e4_cumulative_curve"] = with_(*BASE, SCORES, running()) + f"select member_id, k, {r6('yt - yc * (nt / greatest(nc, 1))', 'qini')} from run"
ORACLE["e5_auuc"] = with_(*BASE, SCORES, running(), TOTALS, f"d as (select k, n, total, {GAIN_A} - k / n::double * total as d from run cross join totals)") + f"""
  select {r6('(sum(d) - (max(d) filter (k = 1) + max(d) filter (k = n)) / 2) / max(n)', 'auuc')}, {r6('max(total)', 'total_gain')},
  max(n) as n from d"""


def qini_steps(source: str, keys: str) -> tuple[str, ...]:
    """Area per key: tie groups, running sums, trapezoids; the perfect curve is the same with another score."""
    def curve(tag: str, score: str) -> str:
        return f"""{tag}_g as (select {keys}, {score} as s, count(*) as n, sum(treatment) as t, sum(y * treatment) as a,
    sum(y * (1 - treatment)) as b from {source} group by all),
{tag}_r as (select *, sum(n) over w as x, sum(t) over w as nt, sum(a) over w as yt, sum(b) over w as yc from {tag}_g
  window w as (partition by {keys} order by s desc)),
{tag}_q as (select {keys}, s, x::double as x, case when x > nt then yt - yc * (nt / (x - nt)::double) else yt::double end as q from {tag}_r),
{tag}_l as (select *, coalesce(lag(x) over v, 0) as x0, coalesce(lag(q) over v, 0) as q0 from {tag}_q
  window v as (partition by {keys} order by s desc)),
{tag}_area as (select {keys}, sum((x - x0) * (q + q0) / 2) as area, max(x) as n, max_by(q, x) as last from {tag}_l group by all)"""
    return (curve("m", "uplift"), curve("p", "y * treatment - y * (1 - treatment)"),
            f"""areas as (select {keys}, (m.area - p.n * p.last / 2) / nullif(p.area - p.n * p.last / 2, 0) as qini_auc,
  m.n::bigint as n from m_area m join p_area p using ({keys}))""")


ORACLE["e7_qini_auc"] = with_(*BASE, MODEL_SCORES, *qini_steps("model_scores", "model")) + \
    f"select model, {r6('qini_auc', 'qini_auc')}, n from areas"


def _best(direction: str, where: str) -> str:
    return with_(*BASE, SCORES, running(direction), f"c as (select k, {GAIN_B} as g, su / k as a, k * 100.0::double / n as p from run)") + f"""
  select k as optimal_n, {r6('g', 'max_qini_gain')}, {r6('a', 'avg_uplift')}, {r6('p', 'pct_targeted')} from c where {where}
  order by g desc, k limit 1"""


ORACLE["e8_optimal_target"] = _best("desc", "true")
ORACLE["e8_optimal_target_budget"] = _best("asc", "k <= 300")
ORACLE["e9_worth_targeting"] = with_(*BASE, SCORES) + f"""select member_id, {r6('-uplift', 'benefit')},
  row_number() over (order by uplift, member_id) as rank from scores where -uplift * 100.0::double >= 1.5::double"""
CONTACT = with_(*BASE, SCORES, running(), f"best as (select k from run order by {GAIN_B} desc, k limit 1)",
                "listed as (select *, row_number() over (order by uplift, member_id) as rank from scores)") + f"""
  select member_id, {r6('uplift', 'prioritization_score')}, rank, y from listed where rank <= (select k from best)"""
ORACLE["f2_contact_list"] = CONTACT
ORACLE["a3_ranked_list_sink"] = CONTACT

# --- trials ---------------------------------------------------------------------------------------------------

TRIALS = (f"""params as (select i::bigint as trial, (i * 5 % 7 - 3)::bigint as w_usage, (i * 3 % 5 - 2)::bigint as w_claims,
  (i % 4)::bigint as w_tenure from range(1, 25) r(i))""",
          f"""trial_scores as materialized (select trial, case when {held('member_id')} then 'val' else 'train' end as split, y, treatment,
  cast(usage_trend * w_usage + claim_trend * w_claims + tenure_days % 17 * w_tenure as double) / 128.0::double as uplift
  from features cross join params)""", *qini_steps("trial_scores", "trial, split"),
          """trials as materialized (select trial, max(qini_auc) filter (split = 'train') as train_qini, max(qini_auc) filter (split = 'val') as val_qini,
  max(qini_auc) filter (split = 'train') - max(qini_auc) filter (split = 'val') as overfitting_gap, w_usage, w_claims, w_tenure
  from areas join params using (trial) group by trial, w_usage, w_claims, w_tenure)""")
ORACLE["a5_trials_sink"] = with_(*BASE, *TRIALS) + f"""select trial, {r6('train_qini', 'train_qini')}, {r6('val_qini', 'val_qini')},
  {r6('overfitting_gap', 'overfitting_gap')}, w_usage, w_claims, w_tenure from trials"""
ORACLE["f3_top_trials"] = with_(*BASE, *TRIALS, "t as (select trial, round(val_qini, 9) as v, round(overfitting_gap, 9) as g from trials)") + f"""
  select * from (select 'val_qini' as by, trial, {r6('v', 'val_qini')}, {r6('g', 'overfitting_gap')} from t order by v desc nulls last, trial limit 10)
  union all select * from (select 'gap' as by, trial, {r6('v', 'val_qini')}, {r6('g', 'overfitting_gap')} from t order by g nulls last, trial limit 10)"""
ORACLE["j9_trial_selection"] = "with recursive " + ",\n".join([*BASE, *TRIALS, """steps as materialized (select trial, round(val_qini, 9) as v,
  round(overfitting_gap, 9) as g from trials),
fold(i, trial, v, g) as (select cast(0 as bigint), cast(0 as bigint), '-inf'::double, 'inf'::double union all
  select i + 1, case when wins then nt else trial end, case when wins then nv else v end, case when wins then ng else g end from (
    select fold.*, s.trial as nt, s.v as nv, s.g as ng,
      case when s.v > fold.v then s.g < fold.g + 0.01 else abs(s.v - fold.v) < 0.005 and s.g < fold.g end as wins
    from fold join steps s on s.trial = fold.i + 1))"""]) + f"""
  select trial, {r6('v', 'val_qini')}, {r6('g', 'gap')} from fold where i = 24"""
ORACLE["j13_parameter_importance"] = with_(*BASE, *TRIALS) + " union all ".join(
    f"select '{w}' as parameter, {r6(f'corr({w}::double, val_qini)', 'corr')}, {r6(f'abs(corr({w}::double, val_qini))', 'abs_corr')} from trials"
    for w in ("w_usage", "w_claims", "w_tenure"))
ORACLE["j14_tuned_vs_baseline"] = with_(*BASE, *TRIALS, """b as (select max(val_qini) filter (trial = 1) as baseline, max(val_qini) as tuned
  from trials)""") + f"""select {r6('baseline', 'baseline')}, {r6('tuned', 'tuned')}, {r6('tuned - baseline', 'improvement')},
  {r6('case when baseline <> 0 then 100 * (tuned - baseline) / abs(baseline) else 0.0::double end', 'pct_improvement')} from b"""

# --- splits and comparisons -----------------------------------------------------------------------------------

ORACLE["i1_hold_out"] = with_(*BASE) + f"select member_id, treatment, {held('member_id')} as held_out from features"
ORACLE["i1_stratified_hold_out"] = with_(*BASE, """h as (select member_id, treatment, count(*) over (partition by treatment) as n,
  rank() over (partition by treatment order by ('0x' || substr(md5(concat(member_id, ':', 42)), 1, 8))::bigint) as r from features)""") + \
    "select member_id, treatment from h where r <= ceil(n / 5.0)"
ORACLE["i2_folds"] = "select c_custkey as member_id, " + ", ".join(
    f"cast(('0x' || substr(md5(concat(c_custkey, ':42:{r}')), 1, 8))::bigint % 5 as int) as fold_{r}" for r in range(3)) + " from customer"
ORACLE["j11_overfit_check"] = with_(*BASE, SCORES, f"s as (select *, case when {held('member_id')} then 'test' else 'train' end as split from scores)",
    *qini_steps("s", "split"), """p as (select max(qini_auc) filter (split = 'train') as a, max(qini_auc) filter (split = 'test') as b from areas)""") + f"""
  select 'trend' as model, {r6('a', 'qini_train')}, {r6('b', 'qini_test')}, {r6('a - b', 'gap')}, {r6('(a - b) / nullif(a, 0) * 100', 'relative_pct')},
  case when a - b > 0.01 then 'significant' when a - b > 0.005 then 'mild' else 'good' end as verdict from p"""
ORACLE["j12_model_comparison"] = with_(*BASE, MODEL_SCORES, *qini_steps("model_scores", "model"),
    f"sums as (select model, {SUMMARY} from model_scores group by 1)") + \
    f"select model, {r6('qini_auc', 'qini_auc')}, min, max, range, mean, std from areas join sums using (model)"

# --- learners -------------------------------------------------------------------------------------------------

LINEAR = ("tenure_days", "total_claims", "unique_icd_codes")


def _solved(name: str, source: str, n: int) -> list[str]:
    """Steps that solve the n equations in the columns ``m_i_j`` (matrix) and ``m_i_n`` (right side) of ``source``; ``name`` has x_0.. ."""
    steps, before = [], source
    for k in range(n):
        cells = []
        for i in range(n):
            for j in range(n + 1):
                pivot = f"m_{k}_{j} / m_{k}_{k}"
                cells.append(f"{pivot if i == k else f'm_{i}_{j} - m_{i}_{k} * ({pivot})'} as m_{i}_{j}")
        steps.append(f"{name}_{k} as materialized (select {', '.join(cells)} from {before})")
        before = f"{name}_{k}"
    return [*steps, f"{name} as materialized (select {', '.join(f'm_{i}_{n} as x_{i}' for i in range(n))} from {before})"]


def _newton(steps: int = 9, c: float = 1.0) -> list[str]:
    x = ["1.0", *(f"cast({f} as double)" for f in LINEAR)]
    n = len(x)
    out = [f"b0 as materialized (select {', '.join(f'0.0::double as x_{i}' for i in range(n))})"]
    for s in range(steps):
        p = "1 / (1 + exp(-(" + " + ".join(f"b.x_{i} * {x[i]}" for i in range(n)) + ")))"
        rows = f"r{s} as materialized (select features.*, {p} as p, {', '.join(f'b.x_{i}' for i in range(n))} from features cross join b{s} b)"
        cells = [f"sum(p * (1 - p) * {x[i]} * {x[j]}) + {1 / c if i == j and i else 0.0} as m_{i}_{j}" for i in range(n) for j in range(n)]
        cells += [f"sum((treatment - p) * {x[i]}) - {1 / c if i else 0.0} * any_value(x_{i}) as m_{i}_{n}" for i in range(n)]
        out += [rows, f"h{s} as materialized (select {', '.join(cells)} from r{s})", *_solved(f"d{s}", f"h{s}", n),
                f"b{s + 1} as materialized (select {', '.join(f'b.x_{i} + d.x_{i} as x_{i}' for i in range(n))} from b{s} b cross join d{s} d)"]
    return out


_linear = " + ".join(f"b.x_{i + 1} * {f}" for i, f in enumerate(LINEAR))
ORACLE["j1_propensity_optimum"] = with_(*BASE, *_newton()) + f"""select member_id, treatment,
  round(1 / (1 + exp(-(b.x_0 + {_linear}))), 3) + 0.0 as propensity_score from features cross join b9 b"""


def _ridges(alpha: float = 10.0) -> list[str]:
    """Centred sums by arm, the two outcome ridges, then the two effect ridges, whose labels are predictions of the other arm's model."""
    n = len(LINEAR)
    steps = []
    for arm in (0, 1):
        mean = lambda c: f"avg(cast({c} as double))"
        product = lambda a, b: f"sum(cast({a} as double) * {b}) - count(*) * {mean(a)} * {mean(b)}"
        cells = [f"{product(LINEAR[i], LINEAR[j])} as g_{i}_{j}" for i in range(n) for j in range(n)] + [f"{product(LINEAR[i], 'y')} as c_{i}" for i in range(n)]
        cells += [f"{mean(f)} as a_{i}" for i, f in enumerate(LINEAR)] + [f"{mean('y')} as a_y"]
        steps.append(f"s{arm} as materialized (select {', '.join(cells)} from features where treatment = {arm})")
        ridge = [f"g_{i}_{j} + {alpha if i == j else 0.0} as m_{i}_{j}" for i in range(n) for j in range(n)]
        steps.append(f"e{arm} as materialized (select {', '.join(ridge + [f'c_{i} as m_{i}_{n}' for i in range(n)])} from s{arm})")
        steps += _solved(f"w{arm}", f"e{arm}", n)
    for arm, other, sign in ((0, 1, 1), (1, 0, -1)):  # control: prediction less outcome; treated: outcome less prediction
        ridge = [f"s.g_{i}_{j} + {alpha if i == j else 0.0} as m_{i}_{j}" for i in range(n) for j in range(n)]
        moved = [f"{sign} * ({' + '.join(f's.g_{i}_{j} * w.x_{j}' for j in range(n))} - s.c_{i}) as m_{i}_{n}" for i in range(n)]
        steps.append(f"f{arm} as materialized (select {', '.join(ridge + moved)} from s{arm} s cross join w{other} w)")
        steps += _solved(f"v{arm}", f"f{arm}", n)
        # Mean of the label over the arm, and the line through it.
        predicted = f"(o.a_y + {' + '.join(f'w.x_{i} * (s.a_{i} - o.a_{i})' for i in range(n))})"
        steps.append(f"t{arm} as materialized (select {sign} * ({predicted} - s.a_y) as mid, {', '.join(f's.a_{i}' for i in range(n))}, "
                     f"{', '.join(f'v.x_{i}' for i in range(n))} from s{arm} s cross join s{other} o cross join w{other} w cross join v{arm} v)")
    return steps


def _tau(a: str) -> str:
    return f"({a}.mid + {' + '.join(f'{a}.x_{i} * ({f} - {a}.a_{i})' for i, f in enumerate(LINEAR))})"


ORACLE["j6_x_learner_optimum"] = with_(*BASE, *_ridges()) + f"""select member_id, round((0.05 + (tenure_days % 10) * 0.1) * {_tau('t0')}
  + (1 - (0.05 + (tenure_days % 10) * 0.1)) * {_tau('t1')}, 4) + 0.0 as uplift from features cross join t0 cross join t1"""

_UNIT = "67108864"  # parts of a gradient
ORACLE["j4_one_split"] = with_(
    *BASE, "arms as (select treatment, ln(sum(y)::double / (count(*) - sum(y))) as start from features group by 1)",
    f"""graded as materialized (select f.*, round((1 / (1 + exp(-start)) - y) * {_UNIT}) as g,
      round(1 / (1 + exp(-start)) * (1 - 1 / (1 + exp(-start))) * {_UNIT}) as h from features f join arms using (treatment))""",
    "cuts as (" + " union all ".join(f"select {i} as f, '{name}' as feature, cast(c * {step} as double) as threshold from range(250) as t(c)"
                                     for i, (name, step) in enumerate(zip(LINEAR, (20, 1, 1)))) + ")",
    "long as materialized (" + " union all ".join(f"select {i} as f, treatment, cast({name} as double) as value, g, h from graded" for i, name in enumerate(LINEAR)) + ")",
    """sides as (select treatment, f, feature, threshold, sum(g) filter (where value <= threshold) as gl, sum(h) filter (where value <= threshold) as hl,
      count(*) filter (where value <= threshold) as nl, sum(g) as gw, sum(h) as hw, count(*) as nw from long join cuts using (f) group by treatment, f, feature, threshold)""",
    f"""pulled as (select *, case when treatment = 1 then 0.5 else 10.0 end as l1, case when treatment = 1 then 0.5 else 5.0 end as l2 from sides
      where nl >= 20 and nw - nl >= 20 and hl >= 0.001 * {_UNIT} and hw - hl >= 0.001 * {_UNIT})""",
    f"""drawn as (select *, sign(gl) * greatest(abs(gl / {_UNIT}) - l1, 0) as tl, sign(gw - gl) * greatest(abs((gw - gl) / {_UNIT}) - l1, 0) as tr,
      sign(gw) * greatest(abs(gw / {_UNIT}) - l1, 0) as tw from pulled)""",
    f"gained as (select *, tl * tl / (hl / {_UNIT} + l2) + tr * tr / ((hw - hl) / {_UNIT} + l2) - tw * tw / (hw / {_UNIT} + l2) as gain from drawn)",
    "best as (select * from gained where gain > 0 qualify row_number() over (partition by treatment order by gain desc, f, threshold) = 1)",
    f"""leafs as (select treatment, -sign(sum(g)) * greatest(abs(sum(g) / {_UNIT}) - case when treatment = 1 then 0.5 else 10.0 end, 0)
      / (sum(h) / {_UNIT} + case when treatment = 1 then 0.5 else 5.0 end) as alone from graded group by treatment)""") + f"""
  select case when a.treatment = 1 then 'treated' else 'control' end as arm, feature, {r6('threshold', 'threshold')}, {r6('a.start', 'start')},
    {r6(f'case when b.f is null then alone else -tl / (hl / {_UNIT} + b.l2) end', 'left_value')},
    {r6(f'-tr / ((hw - hl) / {_UNIT} + b.l2)', 'right_value')}
  from arms a join leafs using (treatment) left join best b on b.treatment = a.treatment"""

ORACLE["g2_unread_times"] = """select 'timestamp' as "column", count(*) filter (event_id % 7 <> 2 and ts is not null) as present,
  count(*) filter (event_id % 7 = 0 and ts is not null) as unread from events"""
ORACLE["d21_p_value_histogram"] = with_(*BASE, *WELCH_STEPS, "p_values as (select upper_tail / full_tail as p from whole where upper_tail is not null)",
    "ends as (select min(p) as lo, max(p) as hi from p_values)",
    """guess as (select p, lo, (hi - lo) / 20.0::double as w, greatest(0, least(19, cast(floor((p - lo) * 20.0::double / (hi - lo)) as bigint))) as b
  from p_values, ends)""", """placed as (select case when p < lo + b * w then b - 1 when b < 19 and p >= lo + (b + 1) * w then b + 1 else b end as bin from guess)""") + """
  select bin, count(*) as count from placed group by bin"""
