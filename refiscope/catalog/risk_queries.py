"""Stress scenarios and time-to-event tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import explain, metrics
from ..plans import frame, stress, survival
from ..session import scratch_path, stage
from ..sources import adapter
from ..sources.tables import load_portfolio
from . import scorecard
from . import views as V
from .frame_queries import asof_sql, obs_features_sql, with_drivers
from .registry import query, rounded
from .sqlviews import PD, SPREAD, pmt, sql_with, view

view("st_tobs", ("state",), """
SELECT *, CAST(maturity_date AS DATE) AS md, CAST(origination_date AS DATE) AS od, CAST(maturity_date AS DATE) - 730 AS t_obs FROM state
""")
view("st_asof", ("st_tobs", "tmk", "cqk"), asof_sql("st_tobs"))
view("pobs0", ("st_asof",), f"""
SELECT * REPLACE (coalesce(occupancy_pct, 0e0) AS occupancy_pct), ln(1e0 + original_balance) AS log_original_balance,
  date_diff('day', od, t_obs) / 30.44e0 AS months_since_origination_at_Tobs, r_t_obs AS treasury_10y_at_Tobs, r_c_obs AS cap_rate_at_Tobs,
  r_c_obs - r_c_org AS cap_rate_delta_since_origination_at_Tobs, (r_t_obs + {SPREAD.format('property_type')} / 100e0) / 100e0 AS refi FROM st_asof
""")
view("pobsf", ("pobs0",), obs_features_sql("pobs0"))
view("scen", (), "SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', {r}e0, {c}e0, {noi}::DOUBLE, {repr(t) if t else 'CAST(NULL AS VARCHAR)'}, {sev})" for n, _, r, c, noi, t, sev in C.SCENARIOS)
    + ") AS t(scenario_name, rate_bps, cap_bps, noi_pct, ptype, severity_rank)")
view("crossed", ("pobs0", "scen"), f"""
SELECT * EXCLUDE (refi) REPLACE (CASE WHEN hit THEN treasury_10y_at_Tobs + rate_bps / 100e0 ELSE treasury_10y_at_Tobs END AS treasury_10y_at_Tobs,
  CASE WHEN hit THEN cap_rate_at_Tobs + cap_bps / 100e0 ELSE cap_rate_at_Tobs END AS cap_rate_at_Tobs,
  CASE WHEN hit THEN cap_rate_delta_since_origination_at_Tobs + cap_bps / 100e0 ELSE cap_rate_delta_since_origination_at_Tobs END AS cap_rate_delta_since_origination_at_Tobs,
  CASE WHEN hit THEN noi_annual * (1e0 + noi_pct) ELSE noi_annual END AS noi_annual),
  ((CASE WHEN hit THEN treasury_10y_at_Tobs + rate_bps / 100e0 ELSE treasury_10y_at_Tobs END) + {SPREAD.format('property_type')} / 100e0) / 100e0 AS refi
FROM (SELECT p.*, s.*, ptype IS NULL OR ptype = property_type AS hit FROM pobs0 p CROSS JOIN scen s)
""")
view("crossed_f", ("crossed",), obs_features_sql("crossed"))
_S_DS = pmt("current_balance", "(refinance_rate + rate_bps / 10000e0)", "amortization_type")
SHOCKED_SQL = f"""
  CASE WHEN hit THEN current_balance / (noi_annual / ((current_cap_rate + cap_bps / 100e0) / 100e0)) ELSE current_ltv END AS s_ltv,
  CASE WHEN hit THEN coalesce(noi_annual / nullif({_S_DS}, 0), 0e0) ELSE new_dscr END AS s_dscr,
  CASE WHEN hit THEN (refinance_rate + rate_bps / 10000e0 - note_rate) * 10000e0 ELSE rate_gap_bps END AS s_gap,
  CASE WHEN hit THEN noi_annual / current_balance ELSE debt_yield END AS s_yield,
  CASE WHEN hit THEN noi_annual / ((current_cap_rate + cap_bps / 100e0) / 100e0) END AS s_value"""
view("base_pd", ("pobsf",), f"SELECT loan_id AS b_id, {PD} AS baseline_pd FROM pobsf")
view("results", ("crossed_f", "base_pd"), f"""
SELECT loan_id, scenario_name, property_type, metro_area, {PD} AS stressed_pd, {SHOCKED_SQL}, baseline_pd, {PD} - baseline_pd AS delta_pd, current_balance, noi_annual
FROM crossed_f JOIN base_pd ON b_id = loan_id
""")


def portfolio(spark, sf, market=None, state=None, dealt=False):
    """Current state with observation features, for scoring (no date filter); ``state``: where it is staged already.
    ``dealt``: over all cores, for a model that costs much a row."""
    market = market if market is not None else V.loan_market(spark, sf)
    curves = frame.market_curves(market)
    return frame.observation_features(frame.with_observation_dates(state if state is not None else V.state(spark, sf, market, dealt)), curves)


#: What stress runs read of a portfolio that is staged for them.
STRESSED_COLUMNS = ["loan_id", "property_type", "metro_area", "amortization_type", "original_balance", "current_balance", "noi_annual", "refinance_rate",
                    "current_cap_rate", "current_value", "current_ltv", "rate_gap", "rate_gap_bps", "new_dscr", "debt_yield", *C.NUMERIC_FEATURES]
#: What survival queries read of their frame.
SURVIVAL_COLUMNS = ["loan_id", "split", "duration_days", "duration_months", "event_observed", *C.NUMERIC_FEATURES]


def results(spark, sf, market=None, state=None):
    return stress.run_scenarios(portfolio(spark, sf, market, state), stress.scenario_table(spark), scorecard.score)


@query("portfolio_numeric_coercion", sql_with("raw_loans", """
SELECT loan_id, ingested_at, TRY_CAST(original_balance AS DOUBLE) AS original_balance, occupancy_pct, note_rate FROM raw_loans"""))
def portfolio_numeric_coercion(spark, sf):
    return load_portfolio(adapter.raw_loans(spark, sf)).select("loan_id", "ingested_at", "original_balance", "occupancy_pct", "note_rate")


@query("scenario_shocks_on_portfolio", sql_with("state scen", f"""
SELECT loan_id, scenario_name, round(s_ltv, 6) AS current_ltv, round(s_dscr, 6) AS new_dscr, round(s_gap, 6) AS rate_gap_bps, round(s_yield, 6) AS debt_yield, round(s_value, 2) AS current_value
FROM (SELECT *, {SHOCKED_SQL} FROM (SELECT l.* REPLACE (CASE WHEN ptype IS NULL OR ptype = property_type THEN noi_annual * (1e0 + noi_pct) ELSE noi_annual END AS noi_annual),
  s.*, ptype IS NULL OR ptype = property_type AS hit FROM state l CROSS JOIN scen s)) WHERE hit"""))
def scenario_shocks_on_portfolio(spark, sf):
    out = stress.apply_scenarios(V.features(spark, sf), stress.scenario_table(spark))
    hit = out.where("scenario_name <> 'office_specific' or property_type = 'office'")
    return hit.select(
        "loan_id", "scenario_name", F.round("current_value", 2).alias("current_value"),
        *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in ("current_ltv", "new_dscr", "rate_gap_bps", "debt_yield")],
    )


@query("scenario_shocks_leave_other_types", sql_with("state", """
SELECT loan_id, current_ltv, new_dscr, rate_gap_bps FROM state WHERE property_type <> 'office'"""))
def scenario_shocks_leave_other_types(spark, sf):
    only = stress.select_scenarios(stress.scenario_table(spark), ["office_specific"])
    out = stress.apply_scenarios(V.features(spark, sf), only)
    return out.where("property_type <> 'office'").select("loan_id", "current_ltv", "new_dscr", "rate_gap_bps")


@query("scenario_override_of_observation_features", sql_with("crossed_f", """
SELECT loan_id, scenario_name, round(treasury_10y_at_Tobs, 6) AS treasury, round(cap_rate_at_Tobs, 6) AS cap_rate, round(rate_gap_bps_at_Tobs, 6) AS gap,
  round(current_ltv_at_Tobs, 6) AS ltv, round(current_dscr_at_Tobs, 6) AS dscr FROM crossed_f"""))
def scenario_override_of_observation_features(spark, sf):
    out = stress.shock_observation_features(portfolio(spark, sf), stress.scenario_table(spark))
    return rounded(out.select("loan_id", "scenario_name", F.col("treasury_10y_at_Tobs").alias("treasury"), F.col("cap_rate_at_Tobs").alias("cap_rate"),
                              F.col("rate_gap_bps_at_Tobs").alias("gap"), F.col("current_ltv_at_Tobs").alias("ltv"), F.col("current_dscr_at_Tobs").alias("dscr")))


@query("stress_results", sql_with("results", """
SELECT loan_id, scenario_name, property_type, metro_area, round(stressed_pd, 6) AS stressed_pd,
  CASE WHEN stressed_pd <= 0.4e0 THEN 'low' WHEN stressed_pd <= 0.7e0 THEN 'medium' ELSE 'high' END AS stressed_distress_tier,
  round(s_ltv, 6) AS stressed_ltv, round(s_dscr, 6) AS stressed_dscr, round(s_gap, 6) AS stressed_refinance_gap, round(baseline_pd, 6) AS baseline_pd,
  round(delta_pd, 6) AS delta_pd, current_balance, round(noi_annual, 6) AS noi_annual FROM results"""))
def stress_results(spark, sf):
    return rounded(results(spark, sf)).withColumn("current_balance", F.round("current_balance", 0))


@query("stress_results_for_named_scenarios", sql_with("results", """
SELECT scenario_name, count(*) AS n, count(*) FILTER (stressed_pd > 0.5e0) AS n_distressed FROM results WHERE scenario_name IN ('combined_severe', 'rate_shock_100bps') GROUP BY 1"""))
def stress_results_for_named_scenarios(spark, sf):
    chosen = stress.select_scenarios(stress.scenario_table(spark), ["combined_severe", "rate_shock_100bps"])
    out = stress.run_scenarios(portfolio(spark, sf), chosen, scorecard.score)
    return out.groupBy("scenario_name").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("stressed_pd") > 0.5).alias("n_distressed"))


def _worst_sql(group: str) -> str:
    return (f"(SELECT scenario_name AS sn, string_agg({group}, ', ' ORDER BY r) AS names FROM (SELECT scenario_name, {group}, row_number() OVER (PARTITION BY scenario_name "
            f"ORDER BY round(avg(delta_pd), 9) DESC, {group}) AS r FROM results GROUP BY 1, 2) WHERE r <= 5 GROUP BY 1)")


SUMMARY_SQL = f"""
SELECT s.scenario_name, total_loans, pct_loans_distressed, avg_predicted_pd, median_predicted_pd, avg_delta_pd, total_upb, total_upb_distressed, pct_upb_distressed,
  m.names AS worst_metros, t.names AS worst_property_types
FROM (SELECT scenario_name, count(*) AS total_loans, round(count(*) FILTER (stressed_pd > 0.5e0) / count(*)::DOUBLE * 100e0, 2) AS pct_loans_distressed,
  round(avg(stressed_pd), 4) AS avg_predicted_pd, round(median(stressed_pd), 4) AS median_predicted_pd, round(avg(delta_pd), 4) AS avg_delta_pd,
  round(sum(current_balance)) AS total_upb, round(coalesce(sum(current_balance) FILTER (stressed_pd > 0.5e0), 0e0)) AS total_upb_distressed,
  round(coalesce(sum(current_balance) FILTER (stressed_pd > 0.5e0), 0e0) / sum(current_balance) * 100e0, 2) AS pct_upb_distressed FROM results GROUP BY 1) s
JOIN {_worst_sql('metro_area')} m ON m.sn = s.scenario_name JOIN {_worst_sql('property_type')} t ON t.sn = s.scenario_name"""


@query("stress_results_of_committed_runs", sql_with("results", """
SELECT scenario_name, CASE WHEN scenario_name = 'combined_severe' THEN 2 ELSE 1 END AS run_number, count(*) AS n_loans, round(avg(stressed_pd), 6) AS avg_pd, round(sum(current_balance), 2) AS upb
FROM results GROUP BY 1"""))
def stress_results_of_committed_runs(spark, sf):
    """Scenarios of a landed file: all are run with one of them wrong, then that one is run again."""
    root = scratch_path(spark, "scenarios")
    right = stress.scenario_table(spark)
    wrong = right.withColumn("noi_shock_pct", F.when(F.col("scenario_name") == "combined_severe", -0.9).otherwise(F.col("noi_shock_pct")))
    wrong.write.json(f"{root}/wrong")
    right.write.json(f"{root}/right")
    rows = stage(portfolio(spark, sf).select(*STRESSED_COLUMNS), "portfolio")
    stress.run_and_commit(rows, stress.read_scenarios(spark, f"{root}/wrong"), scorecard.score, f"{root}/results")
    stress.run_and_commit(rows, stress.read_scenarios(spark, f"{root}/right"), scorecard.score, f"{root}/results", ["combined_severe"])
    runs = stress.latest_runs(spark, f"{root}/results").select("scenario_name", F.col("number").cast("int").alias("run_number"))
    per = stress.read_committed(spark, f"{root}/results").groupBy("scenario_name").agg(
        F.count(F.lit(1)).alias("n_loans"), F.avg("stressed_pd").alias("avg_pd"), F.round(F.sum("current_balance"), 2).alias("upb"))
    return rounded(per.join(runs, "scenario_name"))


@query("stress_summary", sql_with("results", SUMMARY_SQL))
def stress_summary(spark, sf):
    return stress.summarize(stage(results(spark, sf), "stress-results"))


@query("stress_measures_vs_baseline", sql_with("results", """
SELECT a.scenario_name, round(a.p, 6) AS stressed_pct_distressed, a.u AS stressed_distressed_upb, a.n AS loans_new_to_distress,
  round(a.p - b.p, 6) AS delta_pct_distressed, a.u - b.u AS delta_distressed_upb
FROM (SELECT scenario_name, avg((stressed_pd > 0.5e0)::INT) AS p, coalesce(sum(current_balance) FILTER (stressed_pd > 0.5e0), 0e0) AS u,
    count(*) FILTER (stressed_pd > 0.5e0 AND baseline_pd <= 0.5e0) AS n FROM results GROUP BY 1) a,
  (SELECT avg((stressed_pd > 0.5e0)::INT) AS p, coalesce(sum(current_balance) FILTER (stressed_pd > 0.5e0), 0e0) AS u FROM results WHERE scenario_name = 'baseline') b"""))
def stress_measures_vs_baseline(spark, sf):
    return rounded(stress.scenario_measures(results(spark, sf)))


@query("newly_distressed_loans", sql_with("results", """
SELECT loan_id, scenario_name, property_type, baseline_pd, stressed_pd, round(delta_pd, 6) AS delta_pd FROM results WHERE baseline_pd <= 0.5e0 AND stressed_pd > 0.5e0"""))
def newly_distressed_loans(spark, sf):
    return stress.new_to_distress(results(spark, sf)).withColumn("delta_pd", F.round(F.col("delta_pd") + 1e-9, 6))


@query("stress_monotonicity_check", sql_with("results", """
SELECT family, shock_bps, round(pct, 6) AS pct, coalesce(pct >= lag(pct) OVER (PARTITION BY family ORDER BY shock_bps) - 0.005e0, true) AS monotone FROM (
 SELECT f AS family, b AS shock_bps, avg((stressed_pd > 0.5e0)::INT) AS pct FROM results JOIN (VALUES ('baseline', 'rate', 0e0), ('rate_shock_100bps', 'rate', 100e0), ('rate_shock_200bps', 'rate', 200e0),
  ('rate_shock_300bps', 'rate', 300e0), ('baseline', 'cap_rate', 0e0), ('cap_rate_shock_100bps', 'cap_rate', 100e0), ('cap_rate_shock_200bps', 'cap_rate', 200e0)) AS s(n, f, b)
 ON n = scenario_name GROUP BY 1, 2)"""))
def stress_monotonicity_check(spark, sf):
    return rounded(stress.monotonicity(results(spark, sf), stress.scenario_table(spark)))


# --- survival ---------------------------------------------------------------------

COX = {"dscr_at_origination": -0.9, "ltv_at_origination": 1.6, "note_rate": 4.0}
COX_SQL = " + ".join(f"({b}::DOUBLE) * {c}" for c, b in COX.items())

view("surv", ("pobsf", "market"), f"""
SELECT *, date_diff('day', od, md) AS dd, greatest(date_diff('day', od, md) / 30.44e0, 1e0) AS dm, CAST(distress_tier IN ('critical', 'high') AS INTEGER) AS ev,
  exp({COX_SQL}) AS hr, CAST(round(({COX_SQL}) * 1e9) AS BIGINT) AS risk_key FROM pobsf WHERE t_obs >= (SELECT min(observation_date)::DATE FROM market WHERE data_type = 'treasury_10y')
""")
view("h0", ("surv",), """
SELECT dd, dm, sum(ev / w) OVER (ORDER BY dd) AS h FROM (
 SELECT dd, dm, ev, sum(w) OVER (ORDER BY dd DESC) AS w FROM (SELECT greatest(dd, 30) AS dd, max(dm) AS dm, sum(ev) AS ev, sum(hr) AS w FROM surv GROUP BY 1))
""")
view("surv_pred", ("surv", "h0"), """
SELECT loan_id, round(coalesce(min(gm) FILTER (exp(-h * hr) <= 0.5e0), 999e0), 1) AS predicted_median_months_to_distress,
  round(arg_min(exp(-h * hr), abs(gm - 12) * 1000 + gm / 1000), 4) AS predicted_survival_prob_12m, round(arg_min(exp(-h * hr), abs(gm - 24) * 1000 + gm / 1000), 4) AS predicted_survival_prob_24m,
  round(arg_min(exp(-h * hr), abs(gm - 36) * 1000 + gm / 1000), 4) AS predicted_survival_prob_36m FROM surv CROSS JOIN (SELECT dm AS gm, h FROM h0) GROUP BY loan_id
""")


def surv_frame(spark, sf, market=None, state=None):
    market = market if market is not None else V.loan_market(spark, sf)
    state = state if state is not None else V.state(spark, sf, market)
    return stage(survival.survival_frame(state, frame.market_curves(market)).select(*SURVIVAL_COLUMNS), "survival")


@query("survival_frame", sql_with("surv", """
SELECT loan_id, CAST(dd AS INTEGER) AS duration_days, round(dm, 6) AS duration_months, ev AS event_observed, round(current_ltv_at_Tobs, 6) AS current_ltv_at_Tobs FROM surv"""))
def survival_frame(spark, sf):
    return rounded(surv_frame(spark, sf).select("loan_id", "duration_days", "duration_months", "event_observed", "current_ltv_at_Tobs"))


@query("kaplan_meier_curve", sql_with("surv", """
SELECT CAST(dd AS INTEGER) AS duration_days, CAST(ev AS BIGINT) AS events, CAST(r AS BIGINT) AS at_risk, CASE WHEN bool_or(ev >= r) OVER (ORDER BY dd) THEN 0e0 ELSE round(exp(sum(CASE WHEN r > ev THEN ln(1e0 - ev / r::DOUBLE) END) OVER (ORDER BY dd)), 6) END AS survival
FROM (SELECT dd, ev, sum(n) OVER (ORDER BY dd DESC) AS r FROM (SELECT greatest(dd, 30) AS dd, sum(ev) AS ev, count(*) AS n FROM surv GROUP BY 1))"""))
def kaplan_meier_curve(spark, sf):
    return rounded(survival.kaplan_meier(surv_frame(spark, sf)))


@query("cox_baseline_hazard", sql_with("h0", "SELECT CAST(dd AS INTEGER) AS duration_days, round(dm, 6) AS duration_months, round(h, 6) AS cumulative_hazard FROM h0"))
def cox_baseline_hazard(spark, sf):
    return rounded(survival.baseline_hazard(surv_frame(spark, sf), COX))


@query("survival_predictions", sql_with("surv_pred", "SELECT * FROM surv_pred"))
def survival_predictions(spark, sf):
    rows = surv_frame(spark, sf)
    return survival.predict(rows, COX, survival.baseline_hazard(rows, COX))


@query("survival_step_function", sql_with("surv h0", """
SELECT loan_id, round(exp(-coalesce((SELECT max(h) FROM h0 WHERE dm <= 36), 0e0) * hr), 6) AS survival_36m, round(exp(-coalesce((SELECT max(h) FROM h0 WHERE dm <= 84.1e0), 0e0) * hr), 6) AS survival_84m FROM surv"""))
def survival_step_function(spark, sf):
    rows = surv_frame(spark, sf)
    return rounded(survival.step_survival(rows, COX, survival.baseline_hazard(rows, COX), [36.0, 84.1]))


@query("concordance_index", sql_with("surv", """
SELECT comparable::DOUBLE AS comparable, round(good / comparable, 6) AS concordance FROM (
 SELECT sum(a.w * b.w) AS comparable, sum(a.w * b.w * CASE WHEN a.r > b.r THEN 1e0 WHEN a.r = b.r THEN 0.5e0 ELSE 0e0 END) AS good
 FROM (SELECT greatest(dd, 30) AS dd, risk_key AS r, count(*) AS w FROM surv WHERE ev = 1 GROUP BY 1, 2) a
 JOIN (SELECT greatest(dd, 30) AS dd, ev, risk_key AS r, count(*) AS w FROM surv GROUP BY 1, 2, 3) b ON b.dd > a.dd OR (b.dd = a.dd AND b.ev = 0))"""))
def concordance_index(spark, sf):
    rows = surv_frame(spark, sf).withColumns({"risk": survival.risk_key(COX), "day": survival.risk_days()})
    return rounded(metrics.concordance(rows, "day", "event_observed", "risk"))


@query("explanations_with_survival", sql_with("pobsf surv_pred", f"""
SELECT loan_id, round({PD}, 4) AS predicted_pd, predicted_median_months_to_distress FROM pobsf LEFT JOIN surv_pred USING (loan_id)"""))
def explanations_with_survival(spark, sf):
    market = V.loan_market(spark, sf)
    rows = surv_frame(spark, sf, market)
    pred = survival.predict(rows, COX, survival.baseline_hazard(rows, COX))
    scored = with_drivers(scorecard.score(portfolio(spark, sf, market)))
    return explain.loan_explanations(scored, "pd", "drivers", pred).select("loan_id", "predicted_pd", "predicted_median_months_to_distress")


def fitted_survival(spark, sf):
    """Full feature matrix and the model fitted on its train rows."""
    market = V.loan_market(spark, sf)
    rows, features = survival.model_frame(V.state(spark, sf, market), frame.market_curves(market))
    return rows, survival.fit_cox(rows.where("split = 'train'"), features)


@query("cox_regression_coefficients")
def cox_regression_coefficients(spark, sf):
    return survival.coefficients_table(spark, fitted_survival(spark, sf)[1])


@query("cox_fit_facts", sql_with("surv", """
SELECT count(*) AS n_rows, CAST(sum(ev) AS BIGINT) AS n_events, TRUE AS score_is_zero, TRUE AS ratios_are_positive FROM surv
WHERE CAST(origination_year AS INTEGER) <= 2018"""))
def cox_fit_facts(spark, sf):
    """What holds of the fit on the train rows: at the coefficients the penalised score is zero."""
    rows, model = fitted_survival(spark, sf)
    train = rows.where("split = 'train'")
    largest = survival.penalised_score(train, model)
    table = survival.coefficients_table(spark, model).agg(F.min(F.col("hazard_ratio") > 0).alias("ratios_are_positive"))
    counted = train.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_observed").cast("bigint").alias("n_events"))
    return counted.withColumn("score_is_zero", F.lit(largest < 1e-3)).crossJoin(F.broadcast(table))  # one-row sides


@query("cox_fitted_predictions")
def cox_fitted_predictions(spark, sf):
    rows, model = fitted_survival(spark, sf)
    train = rows.where("split = 'train'")
    return survival.predict(rows, model.coefficients, survival.baseline_hazard(train, model.coefficients))


@query("cox_concordance_per_split")
def cox_concordance_per_split(spark, sf):
    rows, model = fitted_survival(spark, sf)
    return survival.concordance_per_split(rows, model.coefficients)
