"""Features, gold tables, portfolio measures and quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions import finance as fin
from ..operators import quality
from ..plans import features as feat
from ..plans import gold, kpi, silver
from ..session import constant_table, stage
from ..sources import adapter
from . import views as V
from .registry import query, rounded
from .sqlviews import TIER, sql_with, view

BAD = "distress_tier IN ('critical', 'high')"


view("vintages", ("state",), f"SELECT origination_year, count(*) FILTER ({BAD}) / count(*)::DOUBLE AS p FROM state GROUP BY 1")

# --- features ---------------------------------------------------------------------


@query("latest_treasury_rate", sql_with("now_treasury", "SELECT treasury FROM now_treasury"))
def latest_treasury_rate(spark, sf):
    return feat.latest_treasury(V.loan_market(spark, sf))


@query("latest_national_cap_rates", sql_with("now_caps", "SELECT cap_type, cap_rate FROM now_caps"))
def latest_national_cap_rates(spark, sf):
    return feat.latest_cap_rates(V.loan_market(spark, sf))


FEATURE_COLS = ["loan_id", "current_cap_rate", "current_value", "current_ltv", "refinance_rate", "refinance_rate_pct",
                "rate_gap", "rate_gap_bps", "new_dscr", "annual_debt_service_refi", "debt_yield", "debt_yield_pct",
                "_refi_stressed", "_rate_gap_positive", "months_to_maturity", "_feature_computed_at"]


@query("loan_features", sql_with("features", f"SELECT {', '.join(FEATURE_COLS)} FROM features"))
def loan_features(spark, sf):
    return V.features(spark, sf).select(*FEATURE_COLS)


@query("loan_features_cap_rate_fallback", sql_with("now_caps now_treasury loans", """
SELECT loan_id, round(coalesce(CASE WHEN property_type IN ('office', 'hotel') THEN cap_rate END, (SELECT avg(cap_rate) FROM now_caps WHERE cap_type IN ('office', 'hotel'))), 4) AS current_cap_rate
FROM loans LEFT JOIN now_caps ON cap_type = property_type"""))
def loan_features_cap_rate_fallback(spark, sf):
    market = V.loan_market(spark, sf)
    part = market.where("data_type <> 'cap_rate' or property_type in ('office', 'hotel')")
    return feat.loan_features(V.dated_loans(spark, sf), feat.current_market(part)).select("loan_id", "current_cap_rate")


@query("refinance_spread_by_type", sql_with("loans", """
SELECT property_type, count(*) AS n, max(CASE property_type WHEN 'office' THEN 250e0 WHEN 'retail' THEN 275e0 WHEN 'industrial' THEN 200e0
  WHEN 'multifamily' THEN 180e0 WHEN 'hotel' THEN 325e0 END) AS spread_bps FROM loans GROUP BY 1"""))
def refinance_spread_by_type(spark, sf):
    return adapter.loans(spark, sf).groupBy("property_type").agg(
        F.count(F.lit(1)).alias("n"), F.max(fin.spread_bps(F.upper("property_type"))).alias("spread_bps"))


@query("debt_service_zero_rate_guard", sql_with("loans", """
SELECT loan_id, round(CASE WHEN amortization_type = 'interest_only' THEN 0e0 ELSE original_balance / 30e0 END, 2) AS zero_rate_service,
  round(CASE WHEN amortization_type = 'interest_only' THEN original_balance * 0.06e0
    ELSE original_balance * 0.06e0 / (1e0 - pow(1.005e0, -360)) END, 2) AS six_percent_service FROM loans"""))
def debt_service_zero_rate_guard(spark, sf):
    return adapter.loans(spark, sf).select(
        "loan_id",
        F.round(fin.annual_debt_service("original_balance", F.lit(0.0), "amortization_type"), 2).alias("zero_rate_service"),
        F.round(fin.annual_debt_service("original_balance", F.lit(0.06), "amortization_type"), 2).alias("six_percent_service"),
    )


@query("unit_conversions_and_safe_division", sql_with("features", """
SELECT loan_id, round(rate_gap_bps / 10000e0, 8) AS gap_decimal, round(current_cap_rate / 100e0, 8) AS cap_decimal, round(rate_gap * 10000e0, 4) AS gap_bps,
  round(noi_annual / nullif(current_balance, 0), 6) AS yield_or_null, round(coalesce(noi_annual / nullif(current_balance * 0, 0), 99e0), 6) AS yield_or_default,
  round(ln(1 + original_balance), 6) AS log_balance FROM features"""))
def unit_conversions_and_safe_division(spark, sf):
    return rounded(V.features(spark, sf).select(
        "loan_id",
        F.round(fin.bps_to_decimal("rate_gap_bps"), 8).alias("gap_decimal"),
        F.round(fin.percent_to_decimal("current_cap_rate"), 8).alias("cap_decimal"),
        F.round(fin.decimal_to_bps("rate_gap"), 4).alias("gap_bps"),
        F.round(fin.safe_divide("noi_annual", "current_balance") + 1e-9, 6).alias("yield_or_null"),
        fin.safe_divide("noi_annual", F.col("current_balance") * 0, 99.0).alias("yield_or_default"),
        F.round(F.log1p("original_balance") + 1e-9, 6).alias("log_balance"),
    ), 8)


# --- gold -------------------------------------------------------------------------

STATE_COLS = ["loan_id", "deal_name", "property_id", "origination_date", "maturity_date", "origination_year", "original_balance",
              "current_balance", "note_rate", "property_type", "metro_area", "current_ltv", "new_dscr", "debt_yield", "_refi_stressed",
              "distress_tier", "dscr_change", "ltv_change", "_feature_computed_at"]


@query("loan_current_state", sql_with("snap_features", f"""
SELECT {', '.join(c for c in STATE_COLS if not c.endswith('change'))}, round(dscr_change, 6) AS dscr_change, round(ltv_change, 6) AS ltv_change
FROM (SELECT *, {TIER} AS distress_tier, new_dscr - dscr_at_origination AS dscr_change, current_ltv - ltv_at_origination AS ltv_change
  FROM snap_features QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY _feature_computed_at DESC, snapshot_no DESC, noi_annual DESC) = 1)"""))
def loan_current_state(spark, sf):
    snaps = V.snapshot_features(spark, sf)
    return rounded(gold.current_state(snaps, [F.desc("snapshot_no"), F.desc("noi_annual")]).select(*STATE_COLS))


HISTORY_SQL = f"""
SELECT loan_id, property_type, metro_area, origination_year, current_balance, current_ltv, new_dscr, rate_gap_bps, debt_yield,
  CASE WHEN _refi_stressed THEN 1 ELSE 0 END AS is_distressed, CASE WHEN new_dscr < 1e0 THEN 1 ELSE 0 END AS dscr_below_1,
  CASE WHEN current_ltv > 0.8e0 THEN 1 ELSE 0 END AS ltv_above_80, CASE WHEN new_dscr < 1e0 AND current_ltv > 0.8e0 THEN 1 ELSE 0 END AS dual_trigger,
  {TIER} AS distress_tier,
  round(CASE WHEN new_dscr >= 1.5e0 THEN 0e0 WHEN new_dscr >= 1e0 THEN (1.5e0 - new_dscr) * 2e0 ELSE 2e0 - new_dscr END, 6) AS dscr_severity_score,
  round(CASE WHEN current_ltv <= 0.6e0 THEN 0e0 WHEN current_ltv <= 0.8e0 THEN (current_ltv - 0.6e0) * 5e0 ELSE 1e0 + (current_ltv - 0.8e0) * 5e0 END, 6) AS ltv_severity_score,
  _feature_computed_at AS snapshot_at FROM snap_features"""
HISTORY_COLS = ["loan_id", "property_type", "metro_area", "origination_year", "current_balance", "current_ltv", "new_dscr",
                "rate_gap_bps", "debt_yield", "is_distressed", "dscr_below_1", "ltv_above_80", "dual_trigger", "distress_tier",
                "dscr_severity_score", "ltv_severity_score", "snapshot_at"]


@query("loan_distress_history", sql_with("snap_features", HISTORY_SQL))
def loan_distress_history(spark, sf):
    return rounded(gold.distress_history(V.snapshot_features(spark, sf)).select(*HISTORY_COLS))


INDEX_SQL = f"""
SELECT metro_area, property_type, origination_year, count(*) AS loan_count, sum(current_balance) AS total_upb,
  count(*) FILTER (_refi_stressed) AS distressed_loan_count, round(count(*) FILTER (_refi_stressed) / count(*)::DOUBLE, 6) AS pct_distressed_loans,
  coalesce(sum(current_balance) FILTER (_refi_stressed), 0e0) AS total_upb_at_risk,
  round(coalesce(sum(current_balance) FILTER (_refi_stressed), 0e0) / nullif(sum(current_balance), 0), 6) AS pct_upb_at_risk,
  round(avg(rate_gap_bps), 4) AS avg_refinance_gap_bps, max(rate_gap_bps) AS max_refinance_gap_bps,
  round(sum(new_dscr * current_balance) / nullif(sum(current_balance), 0), 6) AS weighted_avg_dscr, round(avg(new_dscr), 6) AS simple_avg_dscr, min(new_dscr) AS min_dscr,
  round(sum(current_ltv * current_balance) / nullif(sum(current_balance), 0), 6) AS weighted_avg_ltv, round(avg(current_ltv), 6) AS simple_avg_ltv, max(current_ltv) AS max_ltv,
  round(avg(debt_yield), 6) AS avg_debt_yield, count(*) FILTER ({TIER} = 'critical') AS critical_count, count(*) FILTER ({TIER} = 'high') AS high_count,
  count(*) FILTER ({TIER} = 'medium') AS medium_count
FROM features GROUP BY 1, 2, 3"""


@query("market_distress_index", sql_with("features", INDEX_SQL))
def market_distress_index(spark, sf):
    out = rounded(gold.market_distress_index(V.features(spark, sf), ordered=False))
    return out.withColumn("avg_refinance_gap_bps", F.round("avg_refinance_gap_bps", 4)).orderBy(
        F.desc("pct_distressed_loans"), F.desc("total_upb_at_risk"))


WALL_SQL = f"""
SELECT CAST(year(d) AS INTEGER) AS maturity_year, CAST(quarter(d) AS INTEGER) AS maturity_quarter, year(d) || '-Q' || quarter(d) AS maturity_period, property_type,
  count(*) AS count_loans_maturing, sum(current_balance) AS total_upb_maturing, round(avg(current_balance), 4) AS avg_loan_size,
  count(*) FILTER (_refi_stressed) AS count_distressed, round(count(*) FILTER (_refi_stressed) / count(*)::DOUBLE, 6) AS pct_distressed,
  coalesce(sum(current_balance) FILTER (_refi_stressed), 0e0) AS upb_distressed, round(avg(new_dscr), 6) AS avg_dscr, round(avg(current_ltv), 6) AS avg_ltv,
  round(avg(rate_gap_bps), 4) AS avg_rate_gap_bps, count(*) FILTER ({TIER} = 'critical') AS critical_count, count(*) FILTER ({TIER} = 'high') AS high_count
FROM (SELECT *, CAST(maturity_date AS DATE) AS d FROM features) WHERE year(d) BETWEEN 2024 AND 2028 GROUP BY 1, 2, 3, 4"""


@query("maturity_wall", sql_with("features", WALL_SQL))
def maturity_wall(spark, sf):
    out = gold.maturity_wall(V.features(spark, sf), ordered=False)
    return rounded(out).withColumns({c: F.round(c, 4) for c in ("avg_loan_size", "avg_rate_gap_bps")}).orderBy(
        "maturity_year", "maturity_quarter", "property_type")


@query("maturity_periods", sql_with("loans", """
SELECT loan_id, CAST(substr(maturity_date, 1, 4) AS INTEGER) AS maturity_year, CAST((CAST(substr(maturity_date, 6, 2) AS INTEGER) + 2) // 3 AS INTEGER) AS maturity_quarter,
  substr(maturity_date, 1, 4) || '-Q' || ((CAST(substr(maturity_date, 6, 2) AS INTEGER) + 2) // 3) AS maturity_period
FROM loans WHERE substr(maturity_date, 1, 4) BETWEEN '2024' AND '2028'"""))
def maturity_periods(spark, sf):
    return gold.with_maturity_period(adapter.loans(spark, sf)).select("loan_id", "maturity_year", "maturity_quarter", "maturity_period")


@query("truthiness_parse", sql_with("raw_loans", """
SELECT balloon_flag, count(*) AS n, CAST(max(CASE WHEN lower(balloon_flag) IN ('true', '1') THEN 1 ELSE 0 END) AS INTEGER) AS flag FROM raw_loans GROUP BY 1"""))
def truthiness_parse(spark, sf):
    return adapter.raw_loans(spark, sf).groupBy("balloon_flag").agg(
        F.count(F.lit(1)).alias("n"), F.max(fin.truthy("balloon_flag")).alias("flag"))


@query("gold_build", sql_with("features state", f"""
SELECT 'loan_current_state' AS table_name, count(*) AS n FROM state UNION ALL SELECT 'loan_distress_history', count(*) FROM features
UNION ALL SELECT 'market_distress_index', count(*) FROM (SELECT DISTINCT metro_area, property_type, origination_year FROM features)
UNION ALL SELECT 'maturity_wall', count(*) FROM (SELECT DISTINCT substr(maturity_date, 1, 4), (CAST(substr(maturity_date, 6, 2) AS INTEGER) + 2) // 3, property_type
  FROM features WHERE substr(maturity_date, 1, 4) BETWEEN '2024' AND '2028')"""))
def gold_build(spark, sf):
    from ..plans.build import build_gold
    from ..session import scratch_path

    return build_gold(V.features(spark, sf), scratch_path(spark, "gold"))


# --- measures and diagnostics -----------------------------------------------------

KPI = f"""sum(current_balance) AS total_upb, count(*) AS loan_count, count(*) FILTER ({BAD}) AS distressed_loan_count,
  coalesce(sum(current_balance) FILTER ({BAD}), 0e0) AS distressed_upb, round(count(*) FILTER ({BAD}) / count(*)::DOUBLE, 6) AS pct_distressed_by_count,
  round(coalesce(sum(current_balance) FILTER ({BAD}), 0e0) / sum(current_balance), 6) AS pct_distressed_by_upb,
  round(sum(new_dscr * current_balance) / sum(current_balance), 6) AS weighted_avg_dscr, round(sum(current_ltv * current_balance) / sum(current_balance), 6) AS weighted_avg_ltv,
  round(sum(rate_gap_bps * current_balance) / sum(current_balance), 4) AS weighted_avg_refinance_gap"""


@query("portfolio_kpis", sql_with("state", f"SELECT {KPI} FROM state"))
def portfolio_kpis(spark, sf):
    return rounded(kpi.portfolio_kpis(V.state(spark, sf))).withColumn("weighted_avg_refinance_gap", F.round("weighted_avg_refinance_gap", 4))


@query("portfolio_kpis_by_type", sql_with("state", f"SELECT property_type, {KPI} FROM state GROUP BY 1"))
def portfolio_kpis_by_type(spark, sf):
    return rounded(kpi.portfolio_kpis(V.state(spark, sf), ["property_type"])).withColumn(
        "weighted_avg_refinance_gap", F.round("weighted_avg_refinance_gap", 4))


@query("maturing_upb_by_quarter", sql_with("state", f"""
SELECT CAST(year(d) AS INTEGER) AS maturity_year, CAST(quarter(d) AS INTEGER) AS maturity_quarter, sum(current_balance) AS upb_maturing,
  coalesce(sum(current_balance) FILTER ({BAD}), 0e0) AS distressed_upb_maturing, round(coalesce(sum(current_balance) FILTER ({BAD}), 0e0) / sum(current_balance), 6) AS pct_wall_distressed
FROM (SELECT *, CAST(maturity_date AS DATE) AS d FROM state) GROUP BY 1, 2"""))
def maturing_upb_by_quarter(spark, sf):
    return rounded(kpi.maturing_upb(V.state(spark, sf)))


@query("vintage_distress_growth", sql_with("vintages", """
SELECT a.origination_year, round(a.p, 6) AS pct_distressed, round(a.p - b.p, 6) AS yoy_growth
FROM vintages a LEFT JOIN vintages b ON b.origination_year = a.origination_year - 1"""))
def vintage_distress_growth(spark, sf):
    return rounded(kpi.vintage_distress_growth(V.state(spark, sf)))


@query("tier_distribution", sql_with("state", """
SELECT distress_tier, count(*) AS n, round(count(*) / (SELECT count(*) FROM state)::DOUBLE, 6) AS pct FROM state GROUP BY 1"""))
def tier_distribution(spark, sf):
    return rounded(kpi.tier_distribution(V.state(spark, sf)))


@query("tier_by_property_type", sql_with("state", """
SELECT property_type, count(*) AS n, round(avg((distress_tier = 'critical')::INT), 6) AS pct_critical, round(avg((distress_tier = 'high')::INT), 6) AS pct_high,
  round(avg((distress_tier = 'medium')::INT), 6) AS pct_medium, round(avg((distress_tier = 'low')::INT), 6) AS pct_low,
  round(avg(new_dscr), 6) AS avg_dscr, round(avg(current_ltv), 6) AS avg_ltv FROM state GROUP BY 1"""))
def tier_by_property_type(spark, sf):
    return rounded(kpi.tier_by_type(V.state(spark, sf)))


@query("dscr_ltv_summary_statistics", sql_with("state", """
SELECT 'new_dscr' AS metric, round(avg(new_dscr), 6) AS mean, round(median(new_dscr), 6) AS median, round(stddev_samp(new_dscr), 6) AS std, min(new_dscr) AS min, max(new_dscr) AS max FROM state
UNION ALL SELECT 'current_ltv', round(avg(current_ltv), 6), round(median(current_ltv), 6), round(stddev_samp(current_ltv), 6), min(current_ltv), max(current_ltv) FROM state"""))
def dscr_ltv_summary_statistics(spark, sf):
    return rounded(kpi.summary_statistics(stage(V.state(spark, sf).select("new_dscr", "current_ltv"), "state")))


@query("dscr_ltv_bucket_histograms", sql_with("state", """
SELECT metric, CAST(bucket AS INTEGER) AS bucket, count(*) AS n, round(count(*) / (SELECT count(*) FROM state)::DOUBLE, 6) AS pct FROM (
 SELECT 'new_dscr' AS metric, CASE WHEN new_dscr < 0.8e0 THEN 0 WHEN new_dscr < 1e0 THEN 1 WHEN new_dscr < 1.25e0 THEN 2 WHEN new_dscr < 1.5e0 THEN 3 ELSE 4 END AS bucket FROM state
 UNION ALL SELECT 'current_ltv', CASE WHEN current_ltv < 0.6e0 THEN 0 WHEN current_ltv < 0.7e0 THEN 1 WHEN current_ltv < 0.8e0 THEN 2 WHEN current_ltv < 1e0 THEN 3 ELSE 4 END FROM state)
GROUP BY 1, 2"""))
def dscr_ltv_bucket_histograms(spark, sf):
    s = stage(V.state(spark, sf).select("new_dscr", "current_ltv"), "state")
    return rounded(kpi.bucket_histogram(s, "new_dscr", [0.8, 1.0, 1.25, 1.5]).unionByName(
        kpi.bucket_histogram(s, "current_ltv", [0.6, 0.7, 0.8, 1.0])))


@query("distress_trigger_overlap", sql_with("state", """
SELECT CASE WHEN new_dscr < 1e0 AND current_ltv > 0.8e0 THEN 'both' WHEN new_dscr < 1e0 THEN 'only_dscr' WHEN current_ltv > 0.8e0 THEN 'only_ltv' ELSE 'neither' END AS trigger,
  count(*) AS n FROM state GROUP BY 1"""))
def distress_trigger_overlap(spark, sf):
    return kpi.trigger_overlap(V.state(spark, sf))


@query("metro_by_type_distress_matrix", sql_with("state", "SELECT metro_area, " + ", ".join(
    f"round(count(*) FILTER ({BAD} AND property_type = '{t}') / nullif(count(*) FILTER (property_type = '{t}'), 0)::DOUBLE, 6) AS {t}"
    for t, *_ in C.PROPERTY_TYPES) + " FROM state GROUP BY 1"))
def metro_by_type_distress_matrix(spark, sf):
    return rounded(kpi.distress_matrix(V.state(spark, sf)))


@query("vintage_by_tier_counts", sql_with("state", "SELECT origination_year, distress_tier, count(*) AS loan_count FROM state GROUP BY 1, 2"))
def vintage_by_tier_counts(spark, sf):
    return kpi.vintage_by_tier(V.state(spark, sf))


@query("sponsor_tier_mix", sql_with("loans", "SELECT sponsor_credit_tier, count(*) AS loan_count FROM loans GROUP BY 1"))
def sponsor_tier_mix(spark, sf):
    return kpi.sponsor_mix(adapter.loans(spark, sf))


@query("top_metros_by_distressed_upb", sql_with("state", f"""
SELECT metro_area, coalesce(sum(current_balance) FILTER ({BAD}), 0e0) AS distressed_upb FROM state GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_metros_by_distressed_upb(spark, sf):
    return kpi.top_metros(V.state(spark, sf))


@query("portfolio_profile_by_type", sql_with("loans", """
SELECT property_type, count(*) AS loan_count, count(DISTINCT loan_id) AS unique_loans, round(avg(original_balance), 4) AS avg_balance, sum(original_balance) AS total_balance,
  round(avg(ltv_at_origination), 6) AS avg_ltv, round(avg(dscr_at_origination), 6) AS avg_dscr FROM loans GROUP BY 1"""))
def portfolio_profile_by_type(spark, sf):
    return rounded(kpi.portfolio_profile(adapter.loans(spark, sf))).withColumn("avg_balance", F.round("avg_balance", 4))


EXPLORER = ", ".join(kpi.EXPLORER_COLUMNS)


@query("loan_explorer_filtered", sql_with("state", f"""
SELECT {EXPLORER} FROM state WHERE property_type = 'office' AND metro_area = 'NATION_7' AND distress_tier = 'critical' AND months_to_maturity BETWEEN -24 AND 120"""))
def loan_explorer_filtered(spark, sf):
    return kpi.loan_explorer(V.state(spark, sf), "office", "NATION_7", "critical")


@query("office_focus_bookmark", sql_with("state", f"SELECT {EXPLORER} FROM state WHERE property_type = 'office'"))
def office_focus_bookmark(spark, sf):
    return kpi.office_focus(V.state(spark, sf))


@query("near_term_maturities_bookmark", sql_with("state", f"SELECT {EXPLORER} FROM state WHERE months_to_maturity < 24"))
def near_term_maturities_bookmark(spark, sf):
    return kpi.near_term_maturities(V.state(spark, sf))


# --- quality gates ----------------------------------------------------------------

def _range_sql(c: str, lo: float, hi: float, cast: bool = False) -> str:
    v = f"TRY_CAST({c} AS DOUBLE)" if cast else c
    return (f"SELECT 'RANGE({c})' AS check_name, CASE WHEN count(*) FILTER ({v} < {lo} OR {v} > {hi}) > 0 THEN 'WARN' ELSE 'PASS' END AS status, "
            f"count(*) FILTER ({v} < {lo} OR {v} > {hi}) AS affected, round(count(*) FILTER ({v} < {lo} OR {v} > {hi}) / count({v})::DOUBLE, 6) AS rate FROM {{t}}")


def _rate_sql(name: str, bad: str, limit: float) -> str:
    return (f"SELECT '{name}', CASE WHEN bad > n * {limit}e0 THEN 'FAIL' WHEN bad > 0 THEN 'WARN' ELSE 'PASS' END, bad, round(bad / n::DOUBLE, 6) "
            f"FROM (SELECT {bad} AS bad, count(*) AS n FROM {{t}})")


LOAN_GATE_SQL = " UNION ALL ".join([
    "SELECT 'SCHEMA' AS check_name, 'PASS' AS status, CAST(0 AS BIGINT) AS affected, 0e0 AS rate",
    "SELECT 'ROW_COUNT', 'PASS', count(*), 1e0 FROM {t}",
    _rate_sql("NULL_RATE(loan_id)", "count(*) FILTER (coalesce(loan_id, '') = '')", 0.05),
    _rate_sql("NULL_RATE(maturity_date)", "count(*) FILTER (coalesce(maturity_date, '') = '')", 0.05),
    _rate_sql("NULL_RATE(original_balance)", "count(*) FILTER (coalesce(original_balance, '') = '')", 0.05),
    _rate_sql("DUPLICATES", "count(loan_id) - count(DISTINCT loan_id)", 0.01),
    *[_range_sql(c, lo, hi, c == "original_balance") for c, (lo, hi) in quality.LOAN_RANGES.items()],
    "SELECT 'PROPERTY_TYPE', CASE WHEN count(*) FILTER (property_type = 'warehouse') > 0 THEN 'WARN' ELSE 'PASS' END, count(*) FILTER (property_type = 'warehouse'), round(count(*) FILTER (property_type = 'warehouse') / count(*)::DOUBLE, 6) FROM {t}",
]).replace("{t}", "raw_loans")


@query("quality_gate_raw_loans", sql_with("raw_loans", LOAN_GATE_SQL))
def quality_gate_raw_loans(spark, sf):
    return quality.loan_gate(adapter.raw_loans(spark, sf))


@query("quality_gate_raw_market", sql_with("raw_market", """
SELECT 'ROW_COUNT' AS check_name, 'PASS' AS status, count(*) AS affected, 1e0 AS rate FROM raw_market
UNION ALL SELECT 'DATA_TYPES', CASE WHEN count(DISTINCT data_type) < 5 THEN 'FAIL' ELSE 'PASS' END, 5 - count(DISTINCT data_type), round((5 - count(DISTINCT data_type)) / 5e0, 6) FROM raw_market
UNION ALL SELECT 'NULL_VALUES', CASE WHEN n - v > n * 0.05e0 THEN 'FAIL' WHEN n > v THEN 'WARN' ELSE 'PASS' END, n - v, round((n - v) / n::DOUBLE, 6) FROM (SELECT count(*) AS n, count(value) AS v FROM raw_market)
UNION ALL SELECT 'VALUE_RANGE', CASE WHEN count(*) FILTER (value < -1 OR value > 20) > 0 THEN 'WARN' ELSE 'PASS' END, count(*) FILTER (value < -1 OR value > 20),
  round(count(*) FILTER (value < -1 OR value > 20) / count(*)::DOUBLE, 6) FROM raw_market WHERE data_type <> 'cre_price_index'
UNION ALL SELECT 'HISTORY', CASE WHEN t < 12 THEN 'WARN' ELSE 'PASS' END, t, round(t / n::DOUBLE, 6) FROM (SELECT count(*) FILTER (data_type = 'treasury_10y') AS t, count(*) AS n FROM raw_market)"""))
def quality_gate_raw_market(spark, sf):
    return quality.market_gate(adapter.raw_market(spark, sf))


FEATURE_GATE_SQL = " UNION ALL ".join([
    "SELECT 'FEATURES' AS check_name, 'PASS' AS status, CAST(0 AS BIGINT) AS affected, 0e0 AS rate",
    "SELECT 'ROW_COUNT', 'PASS', count(*), 1e0 FROM {t}",
    *[_rate_sql(f"DERIVED_NULLS({c})", f"count(*) - count({c})", 0.05) for c in quality.FEATURE_NULLS],
    *[_range_sql(c, lo, hi) for c, (lo, hi) in quality.FEATURE_RANGES.items()],
]).replace("{t}", "features")


@query("quality_gate_loan_features", sql_with("features", FEATURE_GATE_SQL))
def quality_gate_loan_features(spark, sf):
    return quality.feature_gate(V.features(spark, sf))


def _without(sql: str, *names: str, absent: int, of: int) -> str:
    """The gate's SQL for a table without the columns of the named rules."""
    parts = [x for x in sql.split(" UNION ALL ") if not any(f"'{n}'" in x for n in (*names, "SCHEMA"))]
    skipped = [f"SELECT '{n}', 'SKIPPED', CAST(0 AS BIGINT), 0e0" for n in names]
    return " UNION ALL ".join([f"SELECT 'SCHEMA' AS check_name, 'FAIL' AS status, CAST({absent} AS BIGINT) AS affected, {round(absent / of, 6)}e0 AS rate", *skipped, *parts])


@query("quality_gate_loans_with_missing_columns", sql_with("raw_loans", _without(
    LOAN_GATE_SQL, "NULL_RATE(maturity_date)", "RANGE(note_rate)", "PROPERTY_TYPE", absent=3, of=len(C.REQUIRED_LOAN_COLUMNS))))
def quality_gate_loans_with_missing_columns(spark, sf):
    """The report goes on after missing columns."""
    return quality.loan_gate(adapter.raw_loans(spark, sf).drop("maturity_date", "note_rate", "property_type"), complete=True)


@query("quality_gate_loans_without_rows", sql_with("raw_loans", """
SELECT 'SCHEMA' AS check_name, 'PASS' AS status, CAST(0 AS BIGINT) AS affected, 0e0 AS rate
UNION ALL SELECT 'ROW_COUNT', CASE WHEN count(*) = 0 THEN 'FAIL' END, count(*), 0e0 FROM raw_loans WHERE loan_id = 'nobody'
UNION ALL SELECT unnest(['NULL_RATE(loan_id)', 'NULL_RATE(maturity_date)', 'NULL_RATE(original_balance)', 'DUPLICATES', 'PROPERTY_TYPE']), 'PASS', CAST(0 AS BIGINT), 0e0"""))
def quality_gate_loans_without_rows(spark, sf):
    return quality.loan_gate(adapter.raw_loans(spark, sf).where("loan_id = 'nobody'"), complete=True)


@query("quality_report_summary", sql_with("raw_loans", f"SELECT status, count(*) AS checks FROM ({LOAN_GATE_SQL}) GROUP BY 1"))
def quality_report_summary(spark, sf):
    return quality.summary(quality.loan_gate(adapter.raw_loans(spark, sf)))


@query("unexpected_property_types", sql_with("raw_loans", """
SELECT property_type AS value FROM raw_loans EXCEPT SELECT unnest(['office','retail','industrial','multifamily','hotel'])"""))
def unexpected_property_types(spark, sf):
    expected = constant_table(spark, [(t,) for t, *_ in C.PROPERTY_TYPES], "value string")
    return quality.unexpected_values(adapter.raw_loans(spark, sf), "property_type", expected)


@query("missing_market_series", sql_with("raw_market", """
SELECT unnest(['treasury_10y','treasury_5y','sofr','cap_rate','cre_price_index','libor']) AS value EXCEPT SELECT data_type FROM raw_market"""))
def missing_market_series(spark, sf):
    expected = constant_table(spark, [(t,) for t in [*C.MARKET_TYPES, "libor"]], "value string")
    return quality.missing_values(adapter.raw_market(spark, sf), "data_type", expected)


@query("property_types_in_both_loans_and_market", sql_with("raw_loans raw_market", """
SELECT property_type FROM raw_loans INTERSECT SELECT property_type FROM raw_market"""))
def property_types_in_both_loans_and_market(spark, sf):
    return adapter.raw_loans(spark, sf).select("property_type").intersect(adapter.raw_market(spark, sf).select("property_type"))


@query("distinct_metros", sql_with("loans", "SELECT DISTINCT metro_area FROM loans"))
def distinct_metros(spark, sf):
    return adapter.loans(spark, sf).select("metro_area").distinct()


@query("gold_table_tests", sql_with("state raw_loans", f"""
SELECT 'loan_current_state' AS table_name, 'not_null' AS test, c AS column_name, CAST(0 AS BIGINT) AS violations FROM (SELECT unnest(['loan_id','property_type','metro_area','original_balance']) AS c)
UNION ALL SELECT 'loan_current_state', 'accepted_values', c, CAST(0 AS BIGINT) FROM (SELECT unnest(['property_type','amortization_type','distress_tier']) AS c)
UNION ALL SELECT 'loan_current_state', 'unique', 'loan_id', count(loan_id) - count(DISTINCT loan_id) FROM state
UNION ALL SELECT 'raw_loans', 'unique', 'loan_id', count(loan_id) - count(DISTINCT loan_id) FROM raw_loans
UNION ALL SELECT 'raw_loans', 'accepted_values', 'property_type', count(*) FILTER (property_type = 'warehouse') FROM raw_loans"""))
def gold_table_tests(spark, sf):
    types = [t for t, *_ in C.PROPERTY_TYPES]
    state_tests = quality.table_tests(
        V.state(spark, sf), "loan_current_state", ["loan_id", "property_type", "metro_area", "original_balance"], ["loan_id"],
        {"property_type": types, "amortization_type": ["interest_only", "amortizing"], "distress_tier": ["critical", "high", "medium", "low"]},
    )
    raw_tests = quality.table_tests(adapter.raw_loans(spark, sf), "raw_loans", [], ["loan_id"], {"property_type": types})
    return state_tests.unionByName(raw_tests)
