"""As-of lookups, the training frame, and score metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions import finance as fin
from ..functions import noise
from ..operators import asof, encode, explain, metrics, quality
from ..operators.ordered import top_per_group
from ..plans import frame
from ..session import constant_table, stage
from ..sources import adapter
from . import scorecard
from . import views as V
from .registry import query, rounded
from .sqlviews import PD, SPREAD, pmt, sql_with, view


def u(salt: str) -> str:
    return f"(CAST('0x' || substr(md5(loan_id || '{salt}'), 1, 8) AS BIGINT) / 4294967296e0)"


def g(salt: str) -> str:
    return f"(sqrt(-2e0 * ln(greatest({u(salt + '#r')}, 1e-12))) * cos(6.283185307179586e0 * {u(salt + '#a')}))"


view("tmk", ("market",), """
SELECT year(d) * 12 + month(d) - 1 AS mk, value AS rate FROM (SELECT CAST(observation_date AS DATE) AS d, value FROM market WHERE data_type = 'treasury_10y')
""")
view("cqk", ("market",), """
SELECT property_type AS ct, CAST(substr(observation_date, 1, 4) AS INTEGER) * 4 + CAST(substr(observation_date, 7, 1) AS INTEGER) - 1 AS qk, value AS rate
FROM market WHERE data_type = 'cap_rate' AND metro = 'National'
""")
view("tobs", ("loans",), """
SELECT *, CAST(maturity_date AS DATE) AS md, CAST(origination_date AS DATE) AS od, CAST(maturity_date AS DATE) - 730 AS t_obs FROM loans
""")
view("elig", ("tobs", "market"), """
SELECT * FROM tobs WHERE t_obs >= (SELECT min(observation_date)::DATE FROM market WHERE data_type = 'treasury_10y')
  AND md <= (SELECT max(observation_date)::DATE FROM market WHERE data_type = 'treasury_10y')
""")


def asof_sql(source: str) -> str:
    """Treasury at observation and maturity, cap rate at observation, origination and maturity."""
    joins, cols = [], []
    for name, d in (("t_obs", "t_obs"), ("t_mat", "md")):
        joins.append(f"ASOF LEFT JOIN tmk {name} ON year({d}) * 12 + month({d}) - 1 >= {name}.mk")
        cols.append(f"coalesce({name}.rate, (SELECT arg_min(rate, mk) FROM tmk)) AS r_{name}")
    for name, d in (("c_obs", "t_obs"), ("c_org", "od"), ("c_mat", "md")):
        joins.append(f"ASOF LEFT JOIN cqk {name} ON property_type = {name}.ct AND year({d}) * 4 + quarter({d}) - 1 >= {name}.qk")
        cols.append(f"coalesce({name}.rate, (SELECT arg_min(rate, qk) FROM cqk x WHERE x.ct = property_type), 6.5e0) AS r_{name}")
    for alias in ("t_obs", "t_mat", "c_obs", "c_org", "c_mat"):
        joins = [j.replace(f"JOIN tmk {alias} ", f"JOIN tmk j_{alias} ").replace(f"JOIN cqk {alias} ", f"JOIN cqk j_{alias} ")
                 .replace(f"{alias}.mk", f"j_{alias}.mk").replace(f"{alias}.ct", f"j_{alias}.ct").replace(f"{alias}.qk", f"j_{alias}.qk") for j in joins]
        cols = [c.replace(f"coalesce({alias}.rate", f"coalesce(j_{alias}.rate") for c in cols]
    return f"SELECT l.*, {', '.join(cols)} FROM {source} l {' '.join(joins)}"


view("asofs", ("elig", "tmk", "cqk"), asof_sql("elig"))


def obs_features_sql(source: str) -> str:
    return f"""
SELECT *, (refi - note_rate) * 10000e0 AS rate_gap_bps_at_Tobs,
  CASE WHEN cap_rate_at_Tobs > 0 AND noi_annual > 0 THEN current_balance / (noi_annual / (cap_rate_at_Tobs / 100e0)) ELSE 0e0 END AS current_ltv_at_Tobs,
  coalesce(noi_annual / nullif({pmt('current_balance', 'refi', 'amortization_type')}, 0), 0e0) AS current_dscr_at_Tobs
FROM {source}"""


view("obs0", ("asofs",), f"""
SELECT * REPLACE (coalesce(occupancy_pct, 0e0) AS occupancy_pct), ln(1e0 + original_balance) AS log_original_balance,
  date_diff('day', od, t_obs) / 30.44e0 AS months_since_origination_at_Tobs, r_t_obs AS treasury_10y_at_Tobs, r_c_obs AS cap_rate_at_Tobs,
  r_c_obs - r_c_org AS cap_rate_delta_since_origination_at_Tobs, (r_t_obs + {SPREAD.format('property_type')} / 100e0) / 100e0 AS refi FROM asofs
""")
view("obsf", ("obs0",), obs_features_sql("obs0"))

_LOSS = (f"CASE WHEN {u('|loss')} < (CASE WHEN property_type IN ('office', 'retail') THEN 0.25e0 WHEN property_type = 'hotel' THEN 0.1e0 ELSE 0e0 END) "
         f"THEN 0.15e0 + {u('|size')} * 0.35e0 ELSE 0e0 END")
SHOCK_SQL = {
    "noi_multiplier": f"(1e0 + greatest(-0.6e0, least(0.6e0, {g('|noi')} * (0.1e0 + {u('|vol')} * 0.3e0) * sqrt(2e0)))) * (1e0 - {_LOSS})",
    "cap_shift": f"CASE WHEN {u('|cap')} < 0.3e0 THEN {g('|capsize')} ELSE 0e0 END",
    "forced_default": f"{u('|surprise')} < 0.05e0",
}


def label_sql(shocks: bool) -> str:
    noi = f"noi_annual * {SHOCK_SQL['noi_multiplier']}" if shocks else "noi_annual"
    cap = f"r_c_mat + {SHOCK_SQL['cap_shift']}" if shocks else "r_c_mat"
    forced = SHOCK_SQL["forced_default"] if shocks else "false"
    return f"""
SELECT * EXCLUDE (noi_m, cap_m, rate_m, forced), CAST(CASE WHEN forced OR coalesce(noi_m / nullif({pmt('current_balance', 'rate_m', 'amortization_type')}, 0), 0e0) < 1e0
    OR (CASE WHEN cap_m > 0 AND noi_m > 0 THEN current_balance / (noi_m / (cap_m / 100e0)) ELSE 99e0 END) > 0.9e0 THEN 1 ELSE 0 END AS INTEGER) AS distress_at_maturity,
  CASE WHEN origination_year <= 2018 THEN 'train' WHEN origination_year = 2019 THEN 'valid' ELSE 'test' END AS split
FROM (SELECT *, {noi} AS noi_m, {cap} AS cap_m, {forced} AS forced, (r_t_mat + {SPREAD.format('property_type')} / 100e0) / 100e0 AS rate_m FROM obsf)"""


view("labelled", ("obsf",), label_sql(True))
view("labelled_plain", ("obsf",), label_sql(False))
view("scored", ("labelled",), f"SELECT *, {PD} AS pd FROM labelled")


def curves(spark, sf, market=None):
    return frame.market_curves(market if market is not None else V.loan_market(spark, sf))


def labelled(spark, sf, shocks=True):
    return stage(frame.labelled_loans(adapter.loans(spark, sf, dealt=True), curves(spark, sf), shocks), "labelled")


def scored(spark, sf, market=None):
    return stage(scorecard.score(frame.labelled_loans(adapter.loans(spark, sf), curves(spark, sf, market))), "scored")


# --- as-of lookups ----------------------------------------------------------------


@query("asof_treasury_with_gaps", sql_with("tobs treas", """
SELECT loan_id, coalesce(t.value, (SELECT arg_min(value, mk) FROM treas WHERE data_type = 'treasury_10y')) AS treasury
FROM tobs l ASOF LEFT JOIN (SELECT mk, value FROM treas WHERE data_type = 'treasury_10y') t ON year(t_obs) * 12 + month(t_obs) - 1 >= t.mk"""))
def asof_treasury_with_gaps(spark, sf):
    curve = asof.treasury_curve(adapter.raw_market(spark, sf).where("data_type = 'treasury_10y'"))
    dated = frame.with_observation_dates(adapter.loans(spark, sf))
    return asof.with_treasury(dated, curve, "t_obs", "treasury").select("loan_id", "treasury")


@query("asof_cap_rate_with_gaps", sql_with("tobs raw_market", """
SELECT loan_id, coalesce(c.value, (SELECT arg_min(value, observation_date) FROM raw_market x WHERE x.data_type = 'cap_rate' AND x.metro = 'National'
    AND x.property_type = l.property_type AND right(x.observation_date, 1) IN ('1', '4'))) AS cap_rate
FROM tobs l ASOF LEFT JOIN (SELECT property_type AS ct, CAST(left(observation_date, 4) AS INTEGER) * 4 + CAST(right(observation_date, 1) AS INTEGER) - 1 AS qk, value
  FROM raw_market WHERE data_type = 'cap_rate' AND metro = 'National' AND right(observation_date, 1) IN ('1', '4')) c
ON l.property_type = c.ct AND year(t_obs) * 4 + quarter(t_obs) - 1 >= c.qk"""))
def asof_cap_rate_with_gaps(spark, sf):
    sparse = adapter.raw_market(spark, sf).where("data_type = 'cap_rate' and right(observation_date, 1) in ('1', '4')")
    dated = frame.with_observation_dates(adapter.loans(spark, sf))
    return asof.with_cap_rate(dated, asof.cap_rate_curve(sparse), "t_obs", "property_type", "cap_rate").select("loan_id", "cap_rate")


@query("observation_dates", sql_with("tobs", "SELECT loan_id, CAST(t_obs AS VARCHAR) AS t_obs FROM tobs"))
def observation_dates(spark, sf):
    return frame.with_observation_dates(adapter.loans(spark, sf)).select("loan_id", F.col("t_obs").cast("string").alias("t_obs"))


@query("loans_within_market_history", sql_with("elig", "SELECT loan_id, maturity_date FROM elig"))
def loans_within_market_history(spark, sf):
    dated = frame.with_observation_dates(adapter.loans(spark, sf))
    return frame.within_market_history(dated, frame.history_bounds(V.loan_market(spark, sf))).select("loan_id", "maturity_date")


@query("loans_within_market_history_open_end", sql_with("tobs market", """
SELECT loan_id, maturity_date FROM tobs WHERE t_obs >= (SELECT min(observation_date)::DATE FROM market WHERE data_type = 'treasury_10y')"""))
def loans_within_market_history_open_end(spark, sf):
    dated = frame.with_observation_dates(adapter.loans(spark, sf))
    return frame.within_market_history(dated, frame.history_bounds(V.loan_market(spark, sf)), need_maturity=False).select("loan_id", "maturity_date")


@query("features_at_observation_date", sql_with("obsf", "SELECT loan_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in C.NUMERIC_FEATURES) + " FROM obsf"))
def features_at_observation_date(spark, sf):
    c = curves(spark, sf)
    eligible = frame.within_market_history(frame.with_observation_dates(adapter.loans(spark, sf)), c.history)
    return rounded(frame.observation_features(eligible, c).select("loan_id", *C.NUMERIC_FEATURES))


@query("maturity_label_without_noise", sql_with("labelled_plain", "SELECT loan_id, split, distress_at_maturity FROM labelled_plain"))
def maturity_label_without_noise(spark, sf):
    return frame.labelled_loans(adapter.loans(spark, sf), curves(spark, sf), shocks=False).select("loan_id", "split", C.LABEL)


@query("maturity_label_with_noise", sql_with("labelled", "SELECT loan_id, split, distress_at_maturity FROM labelled"))
def maturity_label_with_noise(spark, sf):
    return frame.labelled_loans(adapter.loans(spark, sf), curves(spark, sf)).select("loan_id", "split", C.LABEL)


@query("per_loan_hash_noise", sql_with("loans", f"""
SELECT loan_id, round({u('')}, 9) AS u_plain, round({u('|vol')}, 9) AS u_salted, round({g('|noi')}, 6) AS gauss,
  round({SHOCK_SQL['noi_multiplier']}, 6) AS noi_multiplier, round({SHOCK_SQL['cap_shift']}, 6) AS cap_shift, {SHOCK_SQL['forced_default']} AS forced_default FROM loans"""))
def per_loan_hash_noise(spark, sf):
    s = frame.label_shocks()
    return adapter.loans(spark, sf).select(
        "loan_id", F.round(noise.uniform("loan_id"), 9).alias("u_plain"), F.round(noise.uniform("loan_id", "|vol"), 9).alias("u_salted"),
        F.round(noise.gaussian("loan_id", "|noi") + 1e-9, 6).alias("gauss"), F.round(s["noi_multiplier"] + 1e-9, 6).alias("noi_multiplier"),
        F.round(s["cap_shift"] + 1e-9, 6).alias("cap_shift"), s["forced_default"].alias("forced_default"),
    )


@query("outcome_columns_dropped", sql_with("labelled", """
SELECT split, count(*) AS n, CAST(0 AS BIGINT) AS n_outcome_columns FROM labelled GROUP BY 1"""))
def outcome_columns_dropped(spark, sf):
    rows = frame.labelled_loans(adapter.loans(spark, sf), curves(spark, sf))
    left = [c for c in rows.columns if any(p in c for p in C.LEAKAGE_PATTERNS) and c != C.LABEL]
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.lit(len(left)).cast("bigint").alias("n_outcome_columns"))


@query("time_split_by_vintage", sql_with("loans", """
SELECT CASE WHEN origination_year <= 2018 THEN 'train' WHEN origination_year = 2019 THEN 'valid' ELSE 'test' END AS split, count(*) AS n FROM loans GROUP BY 1"""))
def time_split_by_vintage(spark, sf):
    return adapter.loans(spark, sf).groupBy(encode.split_of().alias("split")).agg(F.count(F.lit(1)).alias("n"))


@query("metro_target_means", sql_with("labelled", """
SELECT metro_area, round(avg(distress_at_maturity), 6) AS key_mean, round((SELECT avg(distress_at_maturity) FROM labelled WHERE split = 'train'), 6) AS global_mean
FROM labelled WHERE split = 'train' GROUP BY 1"""))
def metro_target_means(spark, sf):
    means, overall = encode.target_means(labelled(spark, sf), "metro_area", C.LABEL)
    return rounded(means.crossJoin(F.broadcast(overall)))


@query("metro_target_encoded", sql_with("labelled", """
SELECT loan_id, round(coalesce(m, (SELECT avg(distress_at_maturity) FROM labelled WHERE split = 'train')), 6) AS metro_encoded FROM labelled l
LEFT JOIN (SELECT metro_area AS a, avg(distress_at_maturity) AS m FROM labelled WHERE split = 'train' GROUP BY 1) ON a = metro_area"""))
def metro_target_encoded(spark, sf):
    rows = labelled(spark, sf)
    means, overall = encode.target_means(rows, "metro_area", C.LABEL)
    return rounded(encode.encode_target(rows, "metro_area", means, overall, "metro_encoded").select("loan_id", "metro_encoded"))


@query("onehot_categories", sql_with("labelled", """
SELECT 'property_type' AS column_name, property_type AS category FROM labelled GROUP BY ALL
UNION ALL SELECT 'sponsor_credit_tier', sponsor_credit_tier FROM labelled GROUP BY ALL
UNION ALL SELECT 'amortization_type', amortization_type FROM labelled GROUP BY ALL
UNION ALL SELECT 'balloon_flag', CAST(balloon_flag AS VARCHAR) FROM labelled GROUP BY ALL"""))
def onehot_categories(spark, sf):
    long = labelled(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in C.ONEHOT_COLUMNS]).unpivot([], C.ONEHOT_COLUMNS, "column_name", "category")
    return long.distinct()


@query("category_vocabulary", sql_with("labelled", """
SELECT column_name, category, row_number() OVER (ORDER BY column_name, category) - 1 AS code FROM (
SELECT 'property_type' AS column_name, property_type AS category FROM labelled GROUP BY ALL
UNION ALL SELECT 'sponsor_credit_tier', sponsor_credit_tier FROM labelled GROUP BY ALL
UNION ALL SELECT 'amortization_type', amortization_type FROM labelled GROUP BY ALL
UNION ALL SELECT 'balloon_flag', CAST(balloon_flag AS VARCHAR) FROM labelled GROUP BY ALL) WHERE category IS NOT NULL"""))
def category_vocabulary(spark, sf):
    return encode.vocabulary(labelled(spark, sf))


@query("sparse_training_rows", sql_with("labelled", f"""
SELECT loan_id, split, {" + ".join(f"CAST(coalesce({c}, 0) <> 0 AS INTEGER)" for c in C.NUMERIC_FEATURES)} + {len(C.ONEHOT_COLUMNS)} AS n_entries,
  (SELECT count(DISTINCT amortization_type) + count(DISTINCT balloon_flag) + count(DISTINCT property_type) FROM labelled) + ascii(sponsor_credit_tier) - 65 + {len(C.NUMERIC_FEATURES)} AS last_index
FROM labelled"""))
def sparse_training_rows(spark, sf):
    """Entries of every row's sparse vector, and its last place: the sponsor's tier."""
    rows = labelled(spark, sf)
    coded = encode.with_codes(rows, encode.vocabulary(rows))
    held = coded.select("loan_id", "split", encode.sparse_vector(C.NUMERIC_FEATURES, encode.code_columns()).alias("v"))
    return held.select("loan_id", "split", F.size("v.indices").alias("n_entries"), F.array_max("v.indices").alias("last_index"))


_INDICATORS = [(c, v) for c, values in (("property_type", ("hotel", "industrial", "multifamily", "office", "retail")), ("sponsor_credit_tier", "ABC"),
                                        ("amortization_type", ("amortizing", "interest_only")), ("balloon_flag", ("false", "true"))) for v in values]


_KEPT = ["loan_id", "distress_at_maturity", *C.NUMERIC_FEATURES]


@query("leaking_column_names", sql_with("labelled", f"""
SELECT column_name, {" OR ".join(f"contains(column_name, '{p}')" for p in C.LEAKAGE_PATTERNS)} AS leaking FROM (DESCRIBE SELECT {", ".join(_KEPT)} FROM labelled)"""))
def leaking_column_names(spark, sf):
    """Columns of the labelled loans and whether their name points at the outcome date."""
    columns = labelled(spark, sf).select(*_KEPT).columns
    bad = encode.leaking_names(columns)
    return constant_table(spark, [(c, c in bad) for c in columns], "column_name string, leaking boolean")


@query("leakage_gate_correlations", sql_with("labelled", "SELECT feature, round(c, 6) AS abs_corr FROM (" + " UNION ALL ".join([
    *[f"SELECT '{c}' AS feature, abs(corr({c}, distress_at_maturity)) AS c FROM labelled WHERE split = 'train'" for c in C.NUMERIC_FEATURES],
    *[f"SELECT '{c}_{v}', abs(corr(CAST(CAST({c} AS VARCHAR) = '{v}' AS INTEGER), distress_at_maturity)) FROM labelled WHERE split = 'train'" for c, v in _INDICATORS]]) +
    ") WHERE c IS NOT NULL AND NOT isnan(c)"))
def leakage_gate_correlations(spark, sf):
    """Correlation with the label of every number and of every category's indicator, from one moment pass."""
    rows = labelled(spark, sf)
    vocab = encode.vocabulary(rows)
    return rounded(encode.sparse_correlations(encode.with_codes(rows, vocab), C.NUMERIC_FEATURES, encode.code_columns(), vocab, C.LABEL))


ONEHOT = [*[f"property_type_{t}" for t in ("hotel", "industrial", "multifamily", "office", "retail")],
          *[f"sponsor_credit_tier_{t}" for t in "ABC"], "amortization_type_amortizing", "amortization_type_interest_only",
          "balloon_flag_false", "balloon_flag_true"]
ONEHOT_SQL = ", ".join(
    f"CAST(CAST({c.rsplit('_', 1)[0] if not c.startswith('amortization') else 'amortization_type'} AS VARCHAR) = "
    f"'{c.rsplit('_', 1)[1] if not c.startswith('amortization') else c[len('amortization_type_'):]}' AS DOUBLE) AS {c}" for c in ONEHOT)


@query("training_frame", sql_with("labelled", f"""
SELECT loan_id, origination_year, split, distress_at_maturity, {', '.join(f'round({c}, 6) AS {c}' for c in C.NUMERIC_FEATURES)},
  round(coalesce(m, (SELECT avg(distress_at_maturity) FROM labelled WHERE split = 'train')), 6) AS metro_encoded, {ONEHOT_SQL}
FROM labelled LEFT JOIN (SELECT metro_area AS a, avg(distress_at_maturity) AS m FROM labelled WHERE split = 'train' GROUP BY 1) ON a = metro_area"""))
def training_frame(spark, sf):
    return rounded(frame.assemble_frame(labelled(spark, sf)).rows)


@query("columns_aligned_to_model", sql_with("loans", """
SELECT loan_id, note_rate, coalesce(occupancy_pct, 0e0) AS occupancy_pct, 0e0 AS not_in_portfolio FROM loans"""))
def columns_aligned_to_model(spark, sf):
    return encode.align(adapter.loans(spark, sf), ["note_rate", "occupancy_pct", "not_in_portfolio"], keep=["loan_id"])


@query("constant_columns_dropped", sql_with("labelled", """
SELECT loan_id, note_rate, occupancy_pct FROM labelled WHERE split = 'train'"""))
def constant_columns_dropped(spark, sf):
    rows = labelled(spark, sf).where("split = 'train'").select("loan_id", "note_rate", "occupancy_pct", F.lit(1.0).alias("fixed"))
    return rows.drop(*encode.constant_columns(rows, ["note_rate", "occupancy_pct", "fixed"]))


@query("class_balance", sql_with("labelled", """
SELECT CAST(sum(distress_at_maturity) AS BIGINT) AS positives, CAST(count(*) - sum(distress_at_maturity) AS BIGINT) AS negatives,
  round((count(*) - sum(distress_at_maturity)) / greatest(sum(distress_at_maturity), 1), 6) AS scale_pos_weight FROM labelled WHERE split = 'train'"""))
def class_balance(spark, sf):
    return rounded(encode.class_balance(labelled(spark, sf), C.LABEL))


@query("label_rate_per_split", sql_with("labelled", """
SELECT s AS split, count(loan_id) AS n_rows, CAST(coalesce(sum(distress_at_maturity), 0) AS BIGINT) AS positives, CAST(count(loan_id) - coalesce(sum(distress_at_maturity), 0) AS BIGINT) AS negatives,
  round(avg(distress_at_maturity), 6) AS label_rate, coalesce(sum(distress_at_maturity), 0) IN (0, count(loan_id)) AS degenerate
FROM (SELECT unnest(['train', 'valid', 'test']) AS s) LEFT JOIN labelled ON split = s GROUP BY 1"""))
def label_rate_per_split(spark, sf):
    return rounded(encode.label_rates(labelled(spark, sf), C.LABEL))


@query("top_label_correlations", sql_with("labelled", "SELECT feature, round(c, 6) AS abs_corr FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, distress_at_maturity)) AS c FROM labelled WHERE split = 'train'" for c in C.NUMERIC_FEATURES) + ") ORDER BY c DESC, feature LIMIT 5"))
def top_label_correlations(spark, sf):
    return rounded(encode.label_correlations(labelled(spark, sf), C.NUMERIC_FEATURES, C.LABEL))


@query("split_overlap_check", sql_with("labelled", """
SELECT count(*) AS overlapping_keys FROM (SELECT loan_id FROM labelled GROUP BY 1 HAVING count(DISTINCT split) > 1)"""))
def split_overlap_check(spark, sf):
    return quality.split_overlap(frame.labelled_loans(adapter.loans(spark, sf), curves(spark, sf)))


@query("orphan_snapshots_semi_and_anti", sql_with("loans", """
SELECT count(*) FILTER (l_orderkey IN (SELECT loan_key FROM loans WHERE property_type = 'office')) AS n_office,
  count(*) FILTER (l_orderkey NOT IN (SELECT loan_key FROM loans WHERE property_type = 'office')) AS n_other FROM lineitem"""))
def orphan_snapshots_semi_and_anti(spark, sf):
    line = adapter.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("loan_key"))
    office = adapter.loans(spark, sf).where("property_type = 'office'").select("loan_key")
    inside = line.join(office, "loan_key", "left_semi").agg(F.count(F.lit(1)).alias("n_office"))
    outside = line.join(office, "loan_key", "left_anti").agg(F.count(F.lit(1)).alias("n_other"))
    return inside.crossJoin(F.broadcast(outside))  # one-row sides


# --- score metrics ----------------------------------------------------------------

AUC_SQL = """(SELECT sum(CASE WHEN y = 1 THEN r END) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2e0 AS num, count(*) FILTER (y = 1) * count(*) FILTER (y = 0)::DOUBLE AS den
  FROM (SELECT distress_at_maturity AS y, rank() OVER (ORDER BY pd) + (count(*) OVER (PARTITION BY pd) - 1) / 2e0 AS r FROM scored {where}))"""
AP_SQL = """(SELECT sum(p * tp / n) / (SELECT sum(distress_at_maturity) FROM scored) AS ap FROM (
  SELECT pd, p, sum(p) OVER w::DOUBLE AS tp, sum(c) OVER w AS n FROM (SELECT pd, sum(distress_at_maturity) AS p, count(*) AS c FROM scored GROUP BY 1) WINDOW w AS (ORDER BY pd DESC)))"""


@query("auc_roc", sql_with("scored", f"SELECT round(num / den, 6) AS auc_roc FROM {AUC_SQL.format(where='')}"))
def auc_roc(spark, sf):
    return rounded(metrics.rank_metrics(scored(spark, sf), "pd", C.LABEL).select("auc_roc"))


@query("average_precision", sql_with("scored", f"SELECT round(ap, 6) AS pr_auc FROM {AP_SQL}"))
def average_precision(spark, sf):
    return rounded(metrics.rank_metrics(scored(spark, sf), "pd", C.LABEL).select("pr_auc"))


LOSS_SQL = "round(avg(pow(pd - distress_at_maturity, 2)), 6) AS brier_score, round(avg(-ln(CASE WHEN distress_at_maturity = 1 THEN pd ELSE 1e0 - pd END)), 6) AS log_loss"


@query("brier_score_and_log_loss", sql_with("scored", f"SELECT {LOSS_SQL} FROM scored"))
def brier_score_and_log_loss(spark, sf):
    return rounded(metrics.probability_losses(scored(spark, sf), "pd", C.LABEL))


@query("classifier_evaluation", sql_with("scored", f"""
SELECT (SELECT round(num / den, 6) FROM {AUC_SQL.format(where='')}) AS auc_roc, (SELECT round(ap, 6) FROM {AP_SQL}) AS pr_auc, {LOSS_SQL} FROM scored"""))
def classifier_evaluation(spark, sf):
    return rounded(metrics.classification_metrics(scored(spark, sf), "pd", C.LABEL))


@query("confusion_matrix", sql_with("scored", """
SELECT distress_at_maturity AS actual, CAST(pd >= 0.5e0 AS INTEGER) AS predicted, count(*) AS n FROM scored GROUP BY 1, 2"""))
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(scored(spark, sf), "pd", C.LABEL)


CAL_SQL = "SELECT CAST(least(floor(pd * 10), 9) AS INTEGER) AS bin, avg(pd) AS mp, avg(distress_at_maturity) AS fp, count(*) AS n FROM scored GROUP BY 1"


@query("calibration_curve", sql_with("scored", f"SELECT bin, round(mp, 6) AS mean_predicted, round(fp, 6) AS fraction_positive, n FROM ({CAL_SQL})"))
def calibration_curve(spark, sf):
    return rounded(metrics.calibration_curve(scored(spark, sf), "pd", C.LABEL))


@query("calibration_deviation_alerts", sql_with("scored", f"SELECT bin, round(abs(mp - fp), 6) AS deviation, abs(mp - fp) > 0.15e0 AS alert FROM ({CAL_SQL})"))
def calibration_deviation_alerts(spark, sf):
    return rounded(metrics.calibration_deviation(scored(spark, sf), "pd", C.LABEL))


@query("probability_bounds_check", sql_with("scored", "SELECT count(*) AS n, count(*) FILTER (pd < 0 OR pd > 1) AS n_outside FROM scored"))
def probability_bounds_check(spark, sf):
    rows = scorecard.score(frame.labelled_loans(adapter.loans(spark, sf), curves(spark, sf)))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("pd").between(0.0, 1.0)).alias("n_outside"))


@query("pd_tiers_and_action_bands", sql_with("scored", """
SELECT CASE WHEN pd <= 0.4e0 THEN 'low' WHEN pd <= 0.7e0 THEN 'medium' ELSE 'high' END AS tier,
  CASE WHEN pd >= 0.7e0 THEN 'high_priority_review' WHEN pd >= 0.5e0 THEN 'quarterly_review' ELSE 'standard_monitoring' END AS action, count(*) AS n FROM scored GROUP BY 1, 2"""))
def pd_tiers_and_action_bands(spark, sf):
    return scored(spark, sf).groupBy(fin.pd_tier("pd").alias("tier"), fin.pd_action("pd").alias("action")).agg(F.count(F.lit(1)).alias("n"))


@query("riskiest_loans", sql_with("scored", "SELECT loan_id, pd FROM scored ORDER BY pd DESC, loan_id LIMIT 100"))
def riskiest_loans(spark, sf):
    rows = scorecard.score(frame.labelled_loans(adapter.loans(spark, sf), curves(spark, sf)))
    return explain.riskiest(rows.select("loan_id", "pd"), "pd", 100)


@query("sampled_loans_by_hash", sql_with("loans", "SELECT loan_id, note_rate FROM loans ORDER BY md5(loan_id), loan_id LIMIT 200"))
def sampled_loans_by_hash(spark, sf):
    return explain.sample_rows(adapter.loans(spark, sf).select("loan_id", "note_rate"), "loan_id", 200)


@query("priority_loans_within_tier", sql_with("scored", """
SELECT tier, loan_id, pd, CAST(r AS INTEGER) AS rank_in_tier FROM (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY pd DESC, loan_id) AS r FROM
  (SELECT loan_id, pd, CASE WHEN pd <= 0.4e0 THEN 'low' WHEN pd <= 0.7e0 THEN 'medium' ELSE 'high' END AS tier FROM scored)) WHERE r <= 50"""))
def priority_loans_within_tier(spark, sf):
    rows = scorecard.score(frame.labelled_loans(adapter.loans(spark, sf), curves(spark, sf)))
    return top_per_group(rows.select(fin.pd_tier("pd").alias("tier"), "loan_id", "pd"), ["tier"], [F.desc("pd"), F.asc("loan_id")], 50, "rank_in_tier")


# --- drivers ----------------------------------------------------------------------

CONTRIB_SQL = " UNION ALL ".join(
    f"SELECT loan_id, pd, '{c}' AS feature, {c} AS v, {w}::DOUBLE * ({c} - {m}::DOUBLE) AS s FROM scored" for c, w, m in scorecard.TERMS)
RANKED_SQL = f"(SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY round(abs(s), 9) DESC, feature) AS r FROM ({CONTRIB_SQL}))"


def with_drivers(df):
    names = [t[0] for t in scorecard.TERMS]
    return df.withColumn("drivers", explain.driver_array({n: F.col(n) for n in names}, {t[0]: scorecard.contribution(*t) for t in scorecard.TERMS}))


def _drivers(spark, sf):
    return with_drivers(scorecard.score(frame.labelled_loans(adapter.loans(spark, sf), curves(spark, sf))))


@query("loan_drivers_ranked", sql_with("scored", f"""
SELECT loan_id, round(pd, 4) AS predicted_pd, feature AS feature_name, round(v, 4) AS feature_value, round(s, 4) AS shap_value, CAST(r AS INTEGER) AS rank_in_loan FROM {RANKED_SQL} WHERE r <= 3"""))
def loan_drivers_ranked(spark, sf):
    return explain.explanation_rows(_drivers(spark, sf), "pd", "drivers", 3)


@query("loan_top_driver", sql_with("scored", f"""
SELECT loan_id, feature AS top_driver, CASE WHEN s > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction FROM {RANKED_SQL} WHERE r = 1"""))
def loan_top_driver(spark, sf):
    top = F.element_at(explain.top_drivers(F.col("drivers"), 1), 1)
    return _drivers(spark, sf).select("loan_id", top["feature"].alias("top_driver"), top["direction"].alias("direction"))


@query("global_driver_importance", sql_with("scored", f"""
SELECT feature, round(avg(abs(s)), 6) AS mean_abs_contribution FROM ({CONTRIB_SQL}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""))
def global_driver_importance(spark, sf):
    return rounded(explain.global_importance(_drivers(spark, sf), "drivers"))


@query("driver_concentration", sql_with("scored", f"""
SELECT feature, round(sum(abs(s)) / (SELECT sum(abs(s)) FROM ({CONTRIB_SQL})), 6) AS share, sum(abs(s)) / (SELECT sum(abs(s)) FROM ({CONTRIB_SQL})) > 0.4e0 AS alert FROM ({CONTRIB_SQL}) GROUP BY 1"""))
def driver_concentration(spark, sf):
    return rounded(explain.concentration(_drivers(spark, sf), "drivers"))


@query("top_driver_audit", sql_with("scored", f"""
SELECT count(*) AS n_loans, count(*) FILTER (feature = 'rate_gap_bps_at_Tobs') AS n_top, round(avg((feature = 'rate_gap_bps_at_Tobs')::INT), 6) AS share_top FROM {RANKED_SQL} WHERE r = 1"""))
def top_driver_audit(spark, sf):
    return rounded(explain.top_driver_share(_drivers(spark, sf), "drivers", "rate_gap_bps_at_Tobs"))


# --- monitoring -------------------------------------------------------------------

PSI_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, sum((a - e) * ln(a / e)) AS p FROM (
 SELECT greatest(b / sum(b) OVER ()::DOUBLE, 1e-4) AS e, greatest(c / sum(c) OVER ()::DOUBLE, 1e-4) AS a FROM (
  SELECT CASE WHEN hi > lo THEN least(greatest(floor(({c} - lo) / (hi - lo) * 10), 0), 9) ELSE 0 END AS bin, count(*) FILTER (split = 'train') AS b, count(*) FILTER (split <> 'train') AS c
  FROM labelled, (SELECT min({c}) AS lo, max({c}) AS hi FROM labelled WHERE split = 'train') GROUP BY 1))""" for c in C.PSI_FEATURES)


@query("feature_stability_psi", sql_with("labelled", f"SELECT feature, round(p, 6) AS psi, p > 0.25e0 AS alert FROM ({PSI_SQL})"))
def feature_stability_psi(spark, sf):
    return rounded(metrics.population_stability(labelled(spark, sf), C.PSI_FEATURES, F.col("split") != "train"))


@query("score_drift_ks", sql_with("scored", """
SELECT round(max(k), 6) AS ks, max(k) > 0.1e0 AS alert FROM (SELECT abs(sum(b) OVER w / (SELECT count(*) FROM scored WHERE split = 'train')::DOUBLE - sum(c) OVER w / (SELECT count(*) FROM scored WHERE split <> 'train')::DOUBLE) AS k
 FROM (SELECT pd, count(*) FILTER (split = 'train') AS b, count(*) FILTER (split <> 'train') AS c FROM scored GROUP BY 1) WINDOW w AS (ORDER BY pd))"""))
def score_drift_ks(spark, sf):
    return rounded(metrics.ks_statistic(scored(spark, sf), "pd", F.col("split") != "train"))


@query("rolling_six_month_auc", sql_with("scored", """
SELECT CAST(we AS INTEGER) AS window_end, round(a, 6) AS auc_roc, a < 0.75e0 AS alert FROM (
 SELECT we, (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2e0) / nullif(count(*) FILTER (y = 1) * count(*) FILTER (y = 0), 0) AS a FROM (
  SELECT we, y, rank() OVER (PARTITION BY we ORDER BY pd) + (count(*) OVER (PARTITION BY we, pd) - 1) / 2e0 AS r FROM (
   SELECT pd, distress_at_maturity AS y, unnest(generate_series(year(md) * 12 + month(md), year(md) * 12 + month(md) + 5)) AS we FROM scored)) GROUP BY 1) WHERE a IS NOT NULL"""))
def rolling_six_month_auc(spark, sf):
    month = F.year("maturity_d") * 12 + F.month("maturity_d")
    return rounded(metrics.rolling_auc(scored(spark, sf), "pd", C.LABEL, month))


@query("champion_check", sql_with("scored", f"""
SELECT round(a.num / a.den, 6) AS incumbent_auc, round(b.num / b.den, 6) AS challenger_auc, b.num / b.den >= 0.95e0 * a.num / a.den AS promote
FROM {AUC_SQL.format(where='')} a, {AUC_SQL.format(where='').replace('ORDER BY pd', 'ORDER BY current_ltv_at_Tobs').replace('PARTITION BY pd', 'PARTITION BY current_ltv_at_Tobs')} b"""))
def champion_check(spark, sf):
    rows = scored(spark, sf)
    a = metrics.rank_metrics(rows, "pd", C.LABEL)
    b = metrics.rank_metrics(rows, "current_ltv_at_Tobs", C.LABEL)
    return rounded(metrics.champion_check(a, b))
