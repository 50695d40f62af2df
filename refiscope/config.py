"""Fixed values shared by every plan.

The numbers and names below are fixed values: results only agree with the
published definitions when they are exactly these.
"""

# --- fixed values: property types -------------------------------------------------
# property_type, refinance spread over the 10-year treasury (bps), sector, risk tier
PROPERTY_TYPES = [
    ("office", 250.0, "Office", "high"),
    ("retail", 275.0, "Retail", "medium-high"),
    ("industrial", 200.0, "Industrial", "low"),
    ("multifamily", 180.0, "Multifamily", "medium"),
    ("hotel", 325.0, "Hospitality", "high"),
]
DEFAULT_SPREAD_BPS = 250.0

# --- fixed values: fallbacks ------------------------------------------------------
DEFAULT_TREASURY = 4.0
DEFAULT_CAP_RATE = 6.5
DEFAULT_CAP_BY_TYPE = [
    ("office", 7.5),
    ("retail", 7.2),
    ("industrial", 5.2),
    ("multifamily", 5.5),
    ("hotel", 8.3),
]
DEFAULT_OCCUPANCY = 0.85
NO_DEBT_SERVICE_DSCR = 99.0
NO_VALUE_LTV = 99.0
DAYS_PER_MONTH = 30.44
AMORTISATION_MONTHS = 360
OBSERVATION_LEAD_DAYS = 730
NEVER_MONTHS = 999.0

# --- fixed values: average 10-year treasury by origination year (percent) ---------
TREASURY_BY_YEAR = [
    (2015, 2.14), (2016, 1.84), (2017, 2.33), (2018, 2.91), (2019, 2.14), (2020, 0.89),
    (2021, 1.45), (2022, 2.95), (2023, 3.96), (2024, 4.25), (2025, 4.10),
]
DEFAULT_TREASURY_BY_YEAR = 2.5

# --- fixed values: metros (name, cap-rate adjustment bps, region) -----------------
METROS = [
    ("New York", -80, "Northeast"),
    ("Los Angeles", -60, "West Coast"),
    ("San Francisco", -70, "West Coast"),
    ("Chicago", 20, "Midwest"),
    ("Dallas", 30, "South Central"),
    ("Miami", -30, "Southeast"),
    ("Washington DC", -50, "Mid-Atlantic"),
    ("Boston", -40, "Northeast"),
    ("Atlanta", 40, "Southeast"),
    ("Seattle", -30, "Pacific Northwest"),
    ("Denver", 10, "Mountain West"),
    ("Houston", 50, "South Central"),
    ("Phoenix", 30, "Mountain West"),
    ("Philadelphia", 10, "Northeast"),
    ("Minneapolis", 20, "Midwest"),
    ("Austin", 0, "South Central"),
    ("Nashville", 10, "South Central"),
    ("Charlotte", 20, "Southeast"),
    ("San Diego", -40, "West Coast"),
    ("Portland", 0, "Pacific Northwest"),
    ("Tampa", 10, "Southeast"),
    ("Raleigh", 10, "Southeast"),
    ("Salt Lake City", 20, "Mountain West"),
    ("Las Vegas", 40, "Mountain West"),
    ("Orlando", 20, "Southeast"),
]
OTHER_REGION = "Other"

# --- fixed values: stress scenarios -----------------------------------------------
# name, description, rate shock bps, cap-rate shock bps, NOI shock, type filter, severity
# The severity ordinal is explicit: the combined scenario is the most severe one.
SCENARIOS = [
    ("baseline", "No shock", 0, 0, 0.0, None, 0),
    ("rate_shock_100bps", "Treasury +100 bps", 100, 0, 0.0, None, 1),
    ("rate_shock_200bps", "Treasury +200 bps", 200, 0, 0.0, None, 2),
    ("rate_shock_300bps", "Treasury +300 bps", 300, 0, 0.0, None, 3),
    ("cap_rate_shock_100bps", "Cap rates +100 bps", 0, 100, 0.0, None, 4),
    ("cap_rate_shock_200bps", "Cap rates +200 bps", 0, 200, 0.0, None, 5),
    ("office_specific", "Office cap rates +300 bps, NOI -20 %", 0, 300, -0.20, "office", 6),
    ("combined_severe", "Rates +200 bps, cap rates +200 bps, NOI -10 %", 200, 200, -0.10, None, 7),
]
MONOTONICITY_TOLERANCE = 0.005

# --- fixed values: column lists ---------------------------------------------------
CRITICAL_FIELDS = ["loan_id", "maturity_date", "origination_date", "original_balance"]
NUMERIC_LOAN_FIELDS = [
    "original_balance", "current_balance", "note_rate", "ltv_at_origination",
    "dscr_at_origination", "occupancy_pct", "noi_annual", "property_value_at_origination",
]
REQUIRED_LOAN_COLUMNS = [
    "loan_id", "origination_date", "maturity_date", "original_balance", "current_balance",
    "note_rate", "property_type", "metro_area", "ltv_at_origination", "dscr_at_origination",
    "occupancy_pct", "noi_annual",
]
DERIVED_COLUMNS = [
    "current_value", "current_ltv", "refinance_rate", "rate_gap", "new_dscr", "debt_yield",
    "months_to_maturity",
]
MARKET_TYPES = ["treasury_10y", "treasury_5y", "sofr", "cap_rate", "cre_price_index"]
NUMERIC_FEATURES = [
    "ltv_at_origination", "dscr_at_origination", "note_rate", "log_original_balance",
    "occupancy_pct", "months_since_origination_at_Tobs", "treasury_10y_at_Tobs",
    "cap_rate_at_Tobs", "rate_gap_bps_at_Tobs", "cap_rate_delta_since_origination_at_Tobs",
    "current_ltv_at_Tobs", "current_dscr_at_Tobs",
]
ONEHOT_COLUMNS = ["property_type", "sponsor_credit_tier", "amortization_type", "balloon_flag"]
LABEL = "distress_at_maturity"
LEAKAGE_PATTERNS = ["at_maturity", "maturity_refi", "maturity_dscr", "maturity_ltv"]
LEAKAGE_CORRELATION = 0.90
PSI_FEATURES = [
    "cap_rate_at_Tobs", "rate_gap_bps_at_Tobs", "current_dscr_at_Tobs", "current_ltv_at_Tobs",
    "treasury_10y_at_Tobs",
]

# Ranges of the classifier search.
SEARCH_RANGES = {
    "max_depth": (3, 6), "learning_rate": (0.01, 0.3), "n_trees": (100, 500), "min_child_weight": (5, 30), "subsample": (0.6, 1.0),
    "feature_share": (0.6, 1.0), "reg_alpha": (0.01, 5.0), "reg_lambda": (0.01, 5.0),
}
