"""The adapter and intermediate tables restated as DuckDB SQL, for cross-checking only.

Each view is (names of the views it reads, SQL). ``sql_with`` prefixes a query with
the views it needs, in dependency order.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, deps: tuple[str, ...], sql: str) -> None:
    VIEWS[name] = (deps, sql.strip())


def _off_the_tie(sql: str) -> str:
    """``round(x, 6)`` -> ``round(x + 1e-9, 6)``: an average may sit exactly half-way
    between two results, where the order of additions would decide; the Spark side
    (``registry.rounded``) shifts by the same amount."""
    out, i = [], 0
    while (start := sql.find("round(", i)) >= 0:
        depth, j, comma = 1, start + 6, -1
        while depth:
            ch = sql[j]
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 1:
                comma = j
            j += 1
        inner = sql[start + 6 : j - 1]
        if comma >= 0 and sql[comma + 1 : j - 1].strip() == "6":
            out.append(sql[i:start] + "round(" + _off_the_tie(sql[start + 6 : comma]) + " + 1e-9, 6)")
        else:
            out.append(sql[i:start] + "round(" + _off_the_tie(inner) + ")")
        i = j
    return "".join(out) + sql[i:]


def sql_with(names: str, query: str) -> str:
    """``names``: space-separated views used by ``query``."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for d in VIEWS[n][0]:
            visit(d)
        ordered.append(n)

    query = _off_the_tie(query)
    for n in names.split():
        visit(n)
    if not ordered:
        return query.strip()
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED (\n{VIEWS[n][1]}\n)" for n in ordered) + "\n" + query.strip()


def pmt(balance: str, rate: str, kind: str) -> str:
    """Yearly debt service as SQL text."""
    return (
        f"(CASE WHEN {kind} = 'interest_only' THEN {balance} * {rate} "
        f"WHEN {rate} > 0 THEN {balance} * 12e0 * ({rate} / 12e0) / (1e0 - pow(1e0 + {rate} / 12e0, -360)) "
        f"ELSE {balance} / 30e0 END)"
    )


SPREAD = (
    "(CASE lower({0}) WHEN 'office' THEN 250e0 WHEN 'retail' THEN 275e0 WHEN 'industrial' THEN 200e0 "
    "WHEN 'multifamily' THEN 180e0 WHEN 'hotel' THEN 325e0 ELSE 250e0 END)"
)
TIER = (
    "(CASE WHEN new_dscr < 1e0 AND current_ltv > 0.8e0 THEN 'critical' "
    "WHEN new_dscr < 1e0 OR current_ltv > 0.8e0 THEN 'high' "
    "WHEN new_dscr < 1.25e0 OR current_ltv > 0.7e0 THEN 'medium' ELSE 'low' END)"
)

view("ord", (), """
SELECT o.*, n_name,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'office' WHEN 'AUTOMOBILE' THEN 'retail' WHEN 'MACHINERY' THEN 'industrial'
    WHEN 'HOUSEHOLD' THEN 'multifamily' WHEN 'FURNITURE' THEN 'hotel' END AS property_type
FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")

view("terms", ("ord",), """
SELECT o_orderkey AS loan_key, 'LN-' || o_orderkey AS loan_id, 'DEAL-' || (o_orderkey % 1000) AS deal_name,
  'PROP-' || o_orderkey AS property_id,
  CAST(od AS VARCHAR) AS origination_date,
  CAST(CASE WHEN o_orderkey % 211 = 0 THEN od + CAST(o_orderkey % 45 AS INTEGER) ELSE CAST(od + to_months(CAST(term * 12 AS INTEGER)) AS DATE) + CAST(o_orderkey % 29 AS INTEGER) END AS VARCHAR) AS maturity_date,
  CAST(year(od) AS INTEGER) AS origination_year,
  round(o_totalprice * 100e0) AS original_balance,
  (30 + o_orderkey % 40) / 1000e0 AS note_rate,
  CASE WHEN o_orderkey % 2 = 0 THEN 'interest_only' ELSE 'amortizing' END AS amortization_type,
  o_orderkey % 12 <> 0 AS balloon_flag,
  CAST(term AS INTEGER) AS loan_term_years,
  CASE WHEN o_orderstatus = 'F' THEN 'acquisition' ELSE 'refinance' END AS loan_purpose,
  property_type, n_name AS metro_area, n_name || '-' || (o_orderkey % 4) AS submarket,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 0e0 ELSE (50 + o_orderkey % 50) / 100e0 END AS occupancy_pct,
  (40 + o_orderkey % 46) / 100e0 AS ltv_at_origination,
  (80 + o_orderkey % 121) / 100e0 AS dscr_at_origination,
  CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'A' WHEN o_orderpriority = '3-MEDIUM' THEN 'B' ELSE 'C' END AS sponsor_credit_tier
FROM (SELECT *, CAST(o_orderdate + INTERVAL 240 MONTH AS DATE) AS od,
        CASE o_orderkey % 3 WHEN 0 THEN 5 WHEN 1 THEN 7 ELSE 10 END AS term FROM ord)
""")

view("loans", ("terms",), f"""
SELECT *, round(original_balance / ltv_at_origination, 2) AS property_value_at_origination,
  round(dscr_at_origination * {pmt('original_balance', 'note_rate', 'amortization_type')} / 1000e0) * 1000e0 AS noi_annual,
  round(CASE WHEN amortization_type = 'amortizing' AND least(2025 - origination_year, loan_term_years) > 0
    THEN original_balance * greatest(0.5e0,
      1e0 - (pow(1e0 + note_rate / 12e0, least(2025 - origination_year, loan_term_years) * 12) - 1e0)
          / (pow(1e0 + note_rate / 12e0, 360) - 1e0))
    ELSE original_balance END / 1000e0) * 1000e0 AS current_balance
FROM terms
""")

view("raw_text", ("loans",), """
SELECT * REPLACE (
  CASE WHEN loan_key % 89 = 0 THEN 'n/a' ELSE CAST(CAST(original_balance AS BIGINT) AS VARCHAR) END AS original_balance,
  CASE WHEN loan_key % 97 = 0 THEN '' ELSE maturity_date END AS maturity_date,
  CAST(loan_term_years AS VARCHAR) AS loan_term_years, CAST(origination_year AS VARCHAR) AS origination_year,
  CASE WHEN balloon_flag THEN 'True' ELSE 'False' END AS balloon_flag,
  CASE WHEN loan_key % 1013 = 0 THEN 'warehouse' ELSE property_type END AS property_type,
  CASE WHEN loan_key % 211 = 0 THEN 1.25e0 WHEN loan_key % 499 = 0 THEN 2.5e0 ELSE ltv_at_origination END AS ltv_at_origination,
  CASE WHEN loan_key % 223 = 0 THEN 0.4e0 ELSE dscr_at_origination END AS dscr_at_origination),
  '2025-06-01T00:00:00' AS ingested_at
FROM loans
""")

view("raw_loans", ("raw_text",), """
SELECT * FROM raw_text
UNION ALL BY NAME
SELECT * REPLACE ('2025-06-02T00:00:00' AS ingested_at, note_rate + 0.01e0 AS note_rate) FROM raw_text WHERE loan_key % 50 = 0
""")

view("obs", ("ord",), """
SELECT *, (year(obs_date) - 2015) * 12 + month(obs_date) - 1 AS m, (year(obs_date) - 2015) * 4 + quarter(obs_date) - 1 AS q,
  year(obs_date) || '-Q' || quarter(obs_date) AS quarter_label
FROM (SELECT *, DATE '2015-01-01' + CAST((date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 8) // 5 AS INTEGER) AS obs_date FROM ord)
""")

view("growth", ("obs",), """
SELECT quarter_label AS quarter, (sum(o_orderkey) % 60 - 25) / 1000e0 AS annual_growth FROM obs GROUP BY 1
""")

view("idx", ("growth",), """
SELECT quarter AS observation_date, round(100e0 * exp(sum(ln(1e0 + annual_growth / 4e0)) OVER (ORDER BY quarter)), 2) AS value FROM growth
""")

view("raw_market", ("obs", "idx"), """
SELECT 'treasury_10y' AS data_type, CAST(obs_date AS VARCHAR) AS observation_date, (150 + 2 * m + sum(o_orderkey) % 40) / 100e0 AS value,
  'monthly' AS frequency, '' AS property_type, '' AS metro, 'DGS10' AS series_id FROM obs WHERE m % 7 <> 3 GROUP BY obs_date, m
UNION ALL
SELECT 'treasury_5y', CAST(obs_date AS VARCHAR), (130 + 2 * m + sum(o_orderkey) % 40) / 100e0, 'monthly', '', '', 'DGS5'
  FROM obs WHERE o_orderstatus = 'F' AND m % 5 <> 2 GROUP BY obs_date, m
UNION ALL
SELECT 'sofr', strftime(min(obs_date), '%Y-%m'), (100 + 2 * m + sum(o_orderkey) % 30) / 100e0, 'monthly', '', '', 'SOFR'
  FROM obs WHERE o_orderstatus = 'O' AND m % 9 <> 4 GROUP BY m
UNION ALL
SELECT 'cap_rate', quarter_label, (CASE property_type WHEN 'office' THEN 600 WHEN 'retail' THEN 620 WHEN 'industrial' THEN 480
    WHEN 'multifamily' THEN 470 ELSE 780 END + 3 * q + sum(o_orderkey) % 25) / 100e0, 'quarterly', property_type, 'National', ''
  FROM obs GROUP BY property_type, quarter_label, q
UNION ALL
SELECT 'cap_rate', quarter_label, CASE WHEN sum(o_orderkey) % 37 = 0 THEN NULL WHEN sum(o_orderkey) % 41 = 0 THEN 25e0
    ELSE (CASE property_type WHEN 'office' THEN 600 WHEN 'retail' THEN 620 WHEN 'industrial' THEN 480
    WHEN 'multifamily' THEN 470 ELSE 780 END + 3 * q + sum(o_orderkey) % 25) / 100e0 END, 'quarterly', property_type, n_name, ''
  FROM obs GROUP BY property_type, n_name, quarter_label, q
UNION ALL
SELECT 'cre_price_index', observation_date, value, 'quarterly', '', '', 'CRE_INDEX' FROM idx
""")

view("treas", ("raw_market",), """
SELECT data_type, CAST(year(d) * 12 + month(d) - 1 AS INTEGER) AS mk, arg_max(value, d) AS value
FROM (SELECT data_type, CAST(observation_date AS DATE) AS d, value FROM raw_market WHERE data_type IN ('treasury_10y','treasury_5y') AND value IS NOT NULL)
GROUP BY 1, 2
""")

view("treas_filled", ("treas",), """
SELECT data_type, mk,
  CASE WHEN value IS NOT NULL THEN value ELSE pv + (mk - pm) / CAST(nm - pm AS DOUBLE) * (nv - pv) END AS value
FROM (
  SELECT c.data_type, c.mk, t.value,
    last_value(CASE WHEN t.value IS NOT NULL THEN c.mk END IGNORE NULLS) OVER b AS pm, last_value(t.value IGNORE NULLS) OVER b AS pv,
    first_value(CASE WHEN t.value IS NOT NULL THEN c.mk END IGNORE NULLS) OVER f AS nm, first_value(t.value IGNORE NULLS) OVER f AS nv
  FROM (SELECT data_type, CAST(unnest(generate_series(min(mk), max(mk))) AS INTEGER) AS mk FROM treas GROUP BY data_type) c
  LEFT JOIN treas t ON t.data_type = c.data_type AND t.mk = c.mk
  WINDOW b AS (PARTITION BY c.data_type ORDER BY c.mk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY c.data_type ORDER BY c.mk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
""")

view("caps_smooth", ("raw_market",), """
SELECT property_type, metro, observation_date,
  CASE WHEN count(*) OVER (PARTITION BY property_type, metro) > 3
    THEN avg(value) OVER (PARTITION BY property_type, metro ORDER BY observation_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) ELSE value END AS value
FROM raw_market WHERE data_type = 'cap_rate' AND value IS NOT NULL
""")

view("market", ("treas_filled", "caps_smooth", "raw_market"), """
SELECT data_type, format('{:04d}-{:02d}-01', mk // 12, mk % 12 + 1) AS observation_date, round(value, 4) AS value, round(value / 100e0, 6) AS value_decimal,
  'monthly' AS frequency, CAST(NULL AS VARCHAR) AS property_type, CAST(NULL AS VARCHAR) AS metro FROM treas_filled
UNION ALL
SELECT 'sofr', observation_date || '-01', round(value, 4), round(value / 100e0, 6), 'monthly', NULL, NULL FROM raw_market WHERE data_type = 'sofr' AND value IS NOT NULL
UNION ALL
SELECT 'cap_rate', observation_date, round(value, 4), round(value / 100e0, 6), 'quarterly', property_type, metro FROM caps_smooth
UNION ALL
SELECT 'cre_price_index', observation_date, round(value, 2), round(value / 100e0, 4), 'quarterly', NULL, NULL FROM raw_market WHERE data_type = 'cre_price_index' AND value IS NOT NULL
""")

view("now_treasury", ("market",), """
SELECT coalesce(arg_max(value, observation_date), 4e0) AS treasury FROM market WHERE data_type = 'treasury_10y'
""")

view("now_caps", ("market",), """
SELECT property_type AS cap_type, value AS cap_rate FROM market
WHERE data_type = 'cap_rate' AND metro = 'National' AND observation_date = (SELECT max(observation_date) FROM market WHERE data_type = 'cap_rate')
""")


def features_sql(source: str, stamp: str, keep: str = "l.*") -> str:
    ds = pmt("current_balance", "refi", "amortization_type")
    return f"""
SELECT * EXCLUDE (cap, val, refi, ltv, gap, ds, yld, dscr),
  round(cap, 4) AS current_cap_rate, round(val, 2) AS current_value, round(ltv, 4) AS current_ltv, round(refi, 6) AS refinance_rate,
  round(refi * 100e0, 4) AS refinance_rate_pct, round(gap, 6) AS rate_gap, round(gap * 10000e0, 1) AS rate_gap_bps, round(dscr, 4) AS new_dscr,
  round(ds, 2) AS annual_debt_service_refi, round(yld, 4) AS debt_yield, round(yld * 100e0, 2) AS debt_yield_pct,
  (dscr < 1e0 OR ltv > 0.8e0) AS _refi_stressed, gap > 0 AS _rate_gap_positive, {stamp} AS _feature_computed_at
FROM (SELECT *, CASE WHEN ds > 0 THEN noi_annual / ds ELSE 99e0 END AS dscr
 FROM (SELECT *, CASE WHEN val > 0 THEN current_balance / val ELSE ltv_at_origination END AS ltv, refi - note_rate AS gap, {ds} AS ds,
    CASE WHEN current_balance > 0 THEN noi_annual / current_balance ELSE 0e0 END AS yld
  FROM (SELECT {keep}, coalesce(cap_rate, (SELECT avg(cap_rate) FROM now_caps)) AS cap,
      CASE WHEN noi_annual <> 0 THEN noi_annual / (coalesce(cap_rate, (SELECT avg(cap_rate) FROM now_caps)) / 100e0) ELSE property_value_at_origination END AS val,
      ((SELECT treasury FROM now_treasury) + {SPREAD.format('property_type')} / 100e0) / 100e0 AS refi
    FROM {source} l LEFT JOIN now_caps ON cap_type = property_type)))
"""


view("dated_loans", ("loans",), """
SELECT *, round(date_diff('day', DATE '2025-06-30', CAST(maturity_date AS DATE)) / 30.44e0, 1) AS months_to_maturity,
  CAST(maturity_date AS DATE) <= DATE '2025-06-30' AS is_matured FROM loans
""")
view("features", ("dated_loans", "now_caps", "now_treasury"), features_sql("dated_loans", "'2025-06-30T00:00:00'"))

view("snap_loans", ("dated_loans",), """
SELECT l.* REPLACE (round(current_balance * (100 - l_linenumber) / 100e0 / 1000e0) * 1000e0 AS current_balance,
    round(noi_annual * (75 + l_quantity) / 100e0 / 1000e0) * 1000e0 AS noi_annual),
  strftime(CAST(CAST(l_shipdate + INTERVAL 240 MONTH AS DATE) AS TIMESTAMP) + to_seconds(l_linenumber * 3600 + l_partkey % 3600), '%Y-%m-%dT%H:%M:%S') AS snapshot_at,
  l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS snapshot_no
FROM dated_loans l JOIN lineitem ON loan_key = l_orderkey
""")
view("snap_features", ("snap_loans", "now_caps", "now_treasury"), features_sql("snap_loans", "snapshot_at"))

view("state", ("features",), f"""
SELECT *, {TIER} AS distress_tier, new_dscr - dscr_at_origination AS dscr_change, current_ltv - ltv_at_origination AS ltv_change FROM features
""")

from .scorecard import PD_SQL as PD  # noqa: E402
