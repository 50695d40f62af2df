"""Loan cleaning and market standardisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, finance as fin
from ..operators.asof import treasury_range
from ..plans import market, silver
from ..session import stage
from ..sources import adapter, market_feeds
from . import views as V
from .registry import query, rounded
from .sqlviews import pmt, sql_with, view

view("kept", ("raw_loans",), """
SELECT * FROM raw_loans WHERE loan_id IS NOT NULL AND loan_id <> '' AND maturity_date IS NOT NULL AND maturity_date <> ''
  AND origination_date IS NOT NULL AND origination_date <> '' AND original_balance IS NOT NULL AND original_balance <> ''
""")
view("uniq", ("kept",), """
SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY ingested_at) = 1
""")
view("typed", ("uniq",), """
SELECT * REPLACE (TRY_CAST(original_balance AS DOUBLE) AS original_balance, TRY_CAST(loan_term_years AS INTEGER) AS loan_term_years,
  TRY_CAST(origination_year AS INTEGER) AS origination_year, lower(balloon_flag) IN ('true', '1') AS balloon_flag) FROM uniq
""")
view("imputed", ("typed",), """
SELECT t.* REPLACE (CASE WHEN occupancy_pct IS NULL OR occupancy_pct <= 0
    THEN coalesce(g.med, (SELECT median(occupancy_pct) FROM typed WHERE occupancy_pct > 0), 0.85e0) ELSE occupancy_pct END AS occupancy_pct),
  (occupancy_pct IS NULL OR occupancy_pct <= 0) AS _occupancy_imputed
FROM typed t LEFT JOIN (SELECT metro_area AS gm, property_type AS gp, median(occupancy_pct) AS med FROM typed WHERE occupancy_pct > 0 GROUP BY 1, 2) g
  ON metro_area = gm AND property_type = gp
""")


def _raw(spark, sf):
    return adapter.raw_loans(spark, sf)


def _order():
    return [F.col("ingested_at").asc()]


def _typed(spark, sf):
    return silver.cast_types(silver.deduplicate(silver.drop_missing_critical(_raw(spark, sf)), _order()))


@query("adapter_loans", sql_with("loans", "SELECT * FROM loans"))
def adapter_loans(spark, sf):
    return adapter.loans(spark, sf)


@query("loans_without_missing_critical_fields", sql_with("kept", """
SELECT origination_year, count(*) AS n, count(DISTINCT loan_id) AS n_ids FROM kept GROUP BY 1"""))
def loans_without_missing_critical_fields(spark, sf):
    kept = silver.drop_missing_critical(_raw(spark, sf))
    return kept.groupBy("origination_year").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("loan_id").alias("n_ids"))


@query("loans_deduplicated_keep_first", sql_with("uniq", "SELECT loan_id, ingested_at, note_rate, original_balance FROM uniq"))
def loans_deduplicated_keep_first(spark, sf):
    return silver.deduplicate(silver.drop_missing_critical(_raw(spark, sf)), _order()).select(
        "loan_id", "ingested_at", "note_rate", "original_balance"
    )


@query("loans_type_cast", sql_with("typed", """
SELECT loan_id, original_balance, current_balance, note_rate, loan_term_years, origination_year, balloon_flag FROM typed"""))
def loans_type_cast(spark, sf):
    return _typed(spark, sf).select(
        "loan_id", "original_balance", "current_balance", "note_rate", "loan_term_years", "origination_year", "balloon_flag"
    )


@query("loans_outlier_flags", sql_with("raw_loans", """
SELECT loan_id, coalesce(ltv_at_origination > 1e0, false) AS _ltv_outlier, coalesce(dscr_at_origination < 0.5e0, false) AS _dscr_outlier,
  coalesce(ltv_at_origination > 1e0, false) OR coalesce(dscr_at_origination < 0.5e0, false) AS _is_outlier FROM raw_loans"""))
def loans_outlier_flags(spark, sf):
    return silver.flag_outliers(_raw(spark, sf)).select("loan_id", "_ltv_outlier", "_dscr_outlier", "_is_outlier")


@query("loans_months_to_maturity", sql_with("raw_loans", """
SELECT loan_id, ingested_at, round(date_diff('day', DATE '2025-06-30', TRY_CAST(maturity_date AS DATE)) / 30.44e0, 1) AS months_to_maturity,
  TRY_CAST(maturity_date AS DATE) <= DATE '2025-06-30' AS is_matured FROM raw_loans"""))
def loans_months_to_maturity(spark, sf):
    return silver.add_time_to_maturity(_raw(spark, sf), adapter.REFERENCE_DATE).select(
        "loan_id", "ingested_at", "months_to_maturity", "is_matured"
    )


@query("loans_occupancy_imputed_by_median", sql_with("imputed", "SELECT loan_id, occupancy_pct, _occupancy_imputed FROM imputed"))
def loans_occupancy_imputed_by_median(spark, sf):
    return silver.impute_occupancy(stage(_typed(spark, sf), "typed")).select("loan_id", "occupancy_pct", "_occupancy_imputed")


@query("silver_loans", sql_with("imputed", """
SELECT loan_id, occupancy_pct, _occupancy_imputed, coalesce(ltv_at_origination > 1e0, false) AS _ltv_outlier,
  coalesce(dscr_at_origination < 0.5e0, false) AS _dscr_outlier,
  coalesce(ltv_at_origination > 1e0, false) OR coalesce(dscr_at_origination < 0.5e0, false) AS _is_outlier,
  round(date_diff('day', DATE '2025-06-30', TRY_CAST(maturity_date AS DATE)) / 30.44e0, 1) AS months_to_maturity,
  TRY_CAST(maturity_date AS DATE) <= DATE '2025-06-30' AS is_matured, original_balance, origination_year,
  '2025-06-30T00:00:00' AS _silver_processed_at FROM imputed"""))
def silver_loans(spark, sf):
    out = silver.clean_loans(_raw(spark, sf), _order(), adapter.REFERENCE_DATE, F.lit(adapter.STAMP))
    return out.select(
        "loan_id", "occupancy_pct", "_occupancy_imputed", "_ltv_outlier", "_dscr_outlier", "_is_outlier",
        "months_to_maturity", "is_matured", "original_balance", "origination_year", "_silver_processed_at",
    )


@query("property_type_case_folded", sql_with("ord", """
SELECT lower(c_mktsegment) AS folded, count(*) AS n FROM ord JOIN customer ON o_custkey = c_custkey GROUP BY 1"""))
def property_type_case_folded(spark, sf):
    joined = adapter.table(spark, sf, "orders").join(
        adapter.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.groupBy(F.lower("c_mktsegment").alias("folded")).agg(F.count(F.lit(1)).alias("n"))


@query("loan_terms_to_amounts", sql_with("loans", f"""
SELECT loan_id, property_value_at_origination, noi_annual, current_balance, maturity_date,
  round({pmt('original_balance', 'note_rate', 'amortization_type')}, 2) AS annual_debt_service,
  least(greatest(note_rate, 0.025e0), 0.09e0) AS clamped_rate, round(original_balance / 100000e0) * 100000e0 AS rounded_balance FROM loans"""))
def loan_terms_to_amounts(spark, sf):
    return adapter.loans(spark, sf).select(
        "loan_id", "property_value_at_origination", "noi_annual", "current_balance", "maturity_date",
        F.round(fin.annual_debt_service("original_balance", "note_rate", "amortization_type"), 2).alias("annual_debt_service"),
        fin.clamp("note_rate", 0.025, 0.09).alias("clamped_rate"),
        F.round("original_balance", -5).alias("rounded_balance"),
    )


@query("remaining_balance_factor", sql_with("loans", """
SELECT loan_id, round(greatest(0.5e0, (pow(1e0 + note_rate / 12e0, 360) - pow(1e0 + note_rate / 12e0, 60)) / (pow(1e0 + note_rate / 12e0, 360) - 1e0)), 8) AS factor_60m,
  round(greatest(0.5e0, (pow(1e0 + note_rate / 12e0, 360) - pow(1e0 + note_rate / 12e0, 240)) / (pow(1e0 + note_rate / 12e0, 360) - 1e0)), 8) AS factor_240m FROM loans"""))
def remaining_balance_factor(spark, sf):
    return adapter.loans(spark, sf).select(
        "loan_id",
        F.round(fin.remaining_balance_factor("note_rate", F.lit(60)), 8).alias("factor_60m"),
        F.round(fin.remaining_balance_factor("note_rate", F.lit(240)), 8).alias("factor_240m"),
    )


@query("treasury_average_by_origination_year", sql_with("terms", """
SELECT loan_id, CASE origination_year WHEN 2015 THEN 2.14e0 WHEN 2016 THEN 1.84e0 WHEN 2017 THEN 2.33e0 WHEN 2018 THEN 2.91e0
  WHEN 2019 THEN 2.14e0 WHEN 2020 THEN 0.89e0 WHEN 2021 THEN 1.45e0 WHEN 2022 THEN 2.95e0 WHEN 2023 THEN 3.96e0 WHEN 2024 THEN 4.25e0
  WHEN 2025 THEN 4.1e0 ELSE 2.5e0 END AS treasury_at_origination FROM terms"""))
def treasury_average_by_origination_year(spark, sf):
    from ..plans.features import with_origination_treasury

    return with_origination_treasury(adapter.origination_terms(spark, sf)).select("loan_id", "treasury_at_origination")


# --- market ----------------------------------------------------------------------


def _raw_market(spark, sf):
    return stage(adapter.raw_market(spark, sf), "raw-market")


@query("adapter_market", sql_with("raw_market", "SELECT * FROM raw_market"))
def adapter_market(spark, sf):
    return adapter.raw_market(spark, sf)


@query("market_split_by_data_type", sql_with("raw_market", """
SELECT data_type, count(*) AS n, count(value) AS n_values FROM raw_market WHERE data_type IN ('treasury_10y','treasury_5y','sofr','cap_rate','cre_price_index') GROUP BY 1"""))
def market_split_by_data_type(spark, sf):
    raw = adapter.raw_market(spark, sf)
    return raw.where(F.col("data_type").isin(*market.MONTHLY_FILLED, "sofr", "cap_rate", "cre_price_index")).groupBy(
        "data_type"
    ).agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"))


@query("market_dates_normalized", sql_with("raw_market", """
SELECT observation_date, count(*) AS n, CASE WHEN observation_date LIKE '____-__-__' THEN observation_date
  WHEN observation_date LIKE '%Q%' THEN left(observation_date, 4) || CASE right(observation_date, 1) WHEN '1' THEN '-02-15' WHEN '2' THEN '-05-15' WHEN '3' THEN '-08-15' ELSE '-11-15' END
  WHEN length(observation_date) = 7 THEN observation_date || '-01' ELSE observation_date END AS normalized FROM raw_market GROUP BY 1"""))
def market_dates_normalized(spark, sf):
    counted = adapter.raw_market(spark, sf).groupBy("observation_date").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("normalized", dates.normalize_date("observation_date"))


@query("market_last_value_of_month", sql_with("treas", "SELECT data_type, mk AS month_key, value FROM treas"))
def market_last_value_of_month(spark, sf):
    raw = adapter.raw_market(spark, sf).where(F.col("data_type").isin(*market.MONTHLY_FILLED))
    return market.month_end_values(raw).select("data_type", "month_key", "value")


@query("treasury_gap_fill_linear", sql_with("treas_filled", """
SELECT data_type, format('{:04d}-{:02d}-01', mk // 12, mk % 12 + 1) AS observation_date, round(value, 4) AS value FROM treas_filled"""))
def treasury_gap_fill_linear(spark, sf):
    return market.treasury_rates(_raw_market(spark, sf)).select("data_type", "observation_date", "value")


@query("sofr_rates_standardized", sql_with("raw_market", """
SELECT 'sofr' AS data_type, observation_date || '-01' AS observation_date, round(value, 4) AS value, round(value / 100e0, 6) AS value_decimal
FROM raw_market WHERE data_type = 'sofr' AND value IS NOT NULL"""))
def sofr_rates_standardized(spark, sf):
    return market.sofr_rates(adapter.raw_market(spark, sf)).select("data_type", "observation_date", "value", "value_decimal")


@query("cap_rate_trailing_mean", sql_with("caps_smooth", """
SELECT property_type, metro, observation_date, round(value, 4) AS value, round(value / 100e0, 6) AS value_decimal FROM caps_smooth"""))
def cap_rate_trailing_mean(spark, sf):
    return market.cap_rates(adapter.raw_market(spark, sf)).select("property_type", "metro", "observation_date", "value", "value_decimal")


@query("price_index_compounded", sql_with("idx", "SELECT observation_date, value FROM idx"))
def price_index_compounded(spark, sf):
    return market_feeds.compounded_index(adapter.growth_by_quarter(spark, sf)).select("observation_date", "value")


@query("market_rates_standardized", sql_with("market", "SELECT * FROM market"))
def market_rates_standardized(spark, sf):
    return market.standardize(_raw_market(spark, sf)).drop("_silver_processed_at")


@query("market_history_range", sql_with("market", """
SELECT min(observation_date) AS market_start, max(observation_date) AS market_end FROM market WHERE data_type = 'treasury_10y'"""))
def market_history_range(spark, sf):
    return treasury_range(V.silver_market(spark, sf))


@query("market_profile_by_data_type", sql_with("raw_market", """
SELECT data_type, count(*) AS n_observations, min(observation_date) AS first_date, max(observation_date) AS last_date, round(avg(value), 6) AS mean_value
FROM raw_market GROUP BY 1"""))
def market_profile_by_data_type(spark, sf):
    return rounded(adapter.raw_market(spark, sf).groupBy("data_type").agg(
        F.count(F.lit(1)).alias("n_observations"), F.min("observation_date").alias("first_date"),
        F.max("observation_date").alias("last_date"), F.avg("value").alias("mean_value")))


@query("metro_adjusted_cap_rates", sql_with("raw_market", """
SELECT property_type, observation_date, n_name AS metro, round(value + (n_nationkey - 12) * 5 / 100e0, 2) AS value
FROM raw_market CROSS JOIN nation WHERE data_type = 'cap_rate' AND metro = 'National'"""))
def metro_adjusted_cap_rates(spark, sf):
    raw = adapter.raw_market(spark, sf)
    national = market_feeds.tall(raw.where("data_type = 'cap_rate' and metro = 'National'"), "cap_rate", "quarterly",
                                 property_type=F.col("property_type"), metro=F.col("metro"))
    adj = adapter.table(spark, sf, "nation").select(
        F.col("n_name").alias("metro"), ((F.col("n_nationkey") - 12) * 5).cast("double").alias("adjustment_bps"))
    return market_feeds.metro_cap_rates(national, adj).select("property_type", "observation_date", "metro", "value")


@query("wide_cap_rates_unpivoted", sql_with("obs", """
SELECT property_type, quarter_label AS observation_date, round(avg(m) + 5e0, 6) AS value, 'National' AS metro FROM obs GROUP BY 1, 2"""))
def wide_cap_rates_unpivoted(spark, sf):
    obs = adapter.observations(spark, sf)
    wide = obs.groupBy("property_type").pivot("quarter").agg(F.avg("m") + 5.0)
    return rounded(market_feeds.wide_cap_rates(wide).select("property_type", "observation_date", "value", "metro"))


@query("monthly_series_from_keyed_table", sql_with("obs", """
SELECT 'sofr' AS data_type, strftime(obs_date, '%Y-%m') || '-01' AS observation_date, round(avg(m) / 20e0, 6) AS value FROM obs GROUP BY 2"""))
def monthly_series_from_keyed_table(spark, sf):
    obs = adapter.observations(spark, sf)
    seed = obs.groupBy(F.date_format("obs_date", "yyyy-MM").alias("month")).agg((F.avg("m") / 20.0).alias("value"))
    return rounded(market_feeds.monthly_series(seed, "sofr", "SOFR").select("data_type", "observation_date", "value"))
