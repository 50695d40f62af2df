import pytest
from pyspark.sql import functions as F

from refiscope.operators import quality
from refiscope.plans import features as feat
from refiscope.plans import market, silver
from refiscope.session import constant_table

LOAN = ("loan_id string, origination_date string, maturity_date string, original_balance string, current_balance double, note_rate double, "
        "property_type string, metro_area string, ltv_at_origination double, dscr_at_origination double, occupancy_pct double, noi_annual double, "
        "amortization_type string, property_value_at_origination double, ingested_at string, balloon_flag string, loan_term_years string, origination_year string")


def loan(i, **over):
    row = dict(loan_id=f"LN-{i:03d}", origination_date="2020-03-15", maturity_date="2027-03-15", original_balance=str(10_000_000 + i * 5_000_000),
               current_balance=10e6 + i * 5e6, note_rate=0.035, property_type="office", metro_area="New York", ltv_at_origination=0.55 + i * 0.03,
               dscr_at_origination=1.2 + i * 0.1, occupancy_pct=0.80 + i * 0.02, noi_annual=0.8e6 + i * 0.2e6, amortization_type="interest_only",
               property_value_at_origination=30e6, ingested_at=f"2025-01-{i + 1:02d}", balloon_flag="True", loan_term_years="7", origination_year="2020")
    row.update(over)
    return tuple(row.values())


def frame(spark, rows):
    return spark.createDataFrame(rows, LOAN)


def test_missing_critical_fields_are_dropped(spark):
    rows = [loan(0), loan(1, loan_id=""), loan(2, maturity_date=None), loan(3, origination_date=""), loan(4, original_balance=None)]
    assert [r.loan_id for r in silver.drop_missing_critical(frame(spark, rows)).collect()] == ["LN-000"]
    numeric = spark.createDataFrame([("a", "2020-01-01", "2021-01-01", 0.0), ("b", "2020-01-01", "2021-01-01", 5.0)],
                                    "loan_id string, origination_date string, maturity_date string, original_balance double")
    assert [r.loan_id for r in silver.drop_missing_critical(numeric).collect()] == ["b"]


def test_duplicates_keep_the_first(spark):
    rows = [loan(0, ingested_at="2025-02-02", note_rate=0.9), loan(0, ingested_at="2025-01-01"), loan(1)]
    kept = silver.deduplicate(frame(spark, rows), [F.col("ingested_at").asc()])
    assert sorted((r.loan_id, r.note_rate) for r in kept.collect()) == [("LN-000", 0.035), ("LN-001", 0.035)]


def test_casts_turn_bad_text_into_null(spark):
    rows = silver.cast_types(frame(spark, [loan(0, original_balance="n/a", loan_term_years="x"), loan(1)])).collect()
    by = {r.loan_id: r for r in rows}
    assert by["LN-000"].original_balance is None and by["LN-000"].loan_term_years is None
    assert by["LN-001"].original_balance == 15e6 and by["LN-001"].balloon_flag is True and by["LN-001"].origination_year == 2020


def test_occupancy_median_by_group_then_overall_then_constant(spark):
    rows = [loan(0, occupancy_pct=0.8), loan(1, occupancy_pct=0.9), loan(2, occupancy_pct=None), loan(3, occupancy_pct=0.0, metro_area="Boston"),
            loan(4, occupancy_pct=0.5, metro_area="Miami")]
    got = {r.loan_id: (r.occupancy_pct, r._occupancy_imputed) for r in silver.impute_occupancy(frame(spark, rows)).collect()}
    assert got["LN-002"] == (pytest.approx(0.85), True) and got["LN-003"] == (pytest.approx(0.8), True) and got["LN-000"] == (0.8, False)
    none = silver.impute_occupancy(frame(spark, [loan(0, occupancy_pct=None)])).first()
    assert none.occupancy_pct == 0.85


def test_flags_and_time_to_maturity(spark):
    rows = [loan(0, ltv_at_origination=1.2), loan(1, dscr_at_origination=0.4), loan(2, ltv_at_origination=None, maturity_date="bad")]
    out = {r.loan_id: r for r in silver.add_time_to_maturity(silver.flag_outliers(frame(spark, rows)), "2027-03-15").collect()}
    assert out["LN-000"]._ltv_outlier and out["LN-001"]._dscr_outlier and not out["LN-002"]._is_outlier
    assert (out["LN-000"].months_to_maturity, out["LN-000"].is_matured) == (0.0, True)
    assert out["LN-002"].months_to_maturity is None and out["LN-002"].is_matured is None


def raw_market(spark, rows):
    return spark.createDataFrame(rows, "data_type string, observation_date string, value double, frequency string, property_type string, metro string")


def test_missing_month_is_interpolated_and_last_value_of_month_wins(spark):
    rows = [("treasury_10y", "2024-01-05", 3.0, "m", None, None), ("treasury_10y", "2024-01-31", 4.0, "m", None, None), ("treasury_10y", "2024-03-01", 4.2, "m", None, None)]
    got = sorted((r.observation_date, r.value) for r in market.treasury_rates(raw_market(spark, rows)).collect())
    assert got == [("2024-01-01", 4.0), ("2024-02-01", 4.1), ("2024-03-01", 4.2)]
    single = market.treasury_rates(raw_market(spark, rows[2:])).collect()
    assert [(r.observation_date, r.value) for r in single] == [("2024-03-01", 4.2)]


def test_trailing_mean(spark):
    rows = [("cap_rate", f"2024-Q{i + 1}", v, "q", "office", "National") for i, v in enumerate([6.0, 7.0, 8.0, 9.0])]
    rows += [("cap_rate", f"2024-Q{i + 1}", v, "q", "hotel", None) for i, v in enumerate([6.0, 7.0, 8.0])]
    got = {(r.property_type, r.observation_date): r.value for r in market.cap_rates(raw_market(spark, rows)).collect()}
    assert [got[("office", f"2024-Q{i}")] for i in (1, 2, 3, 4)] == [6.0, 6.5, 7.0, 8.0]
    assert [got[("hotel", f"2024-Q{i}")] for i in (1, 2, 3)] == [6.0, 7.0, 8.0]


def test_features_from_hand_values_and_fallbacks(spark):
    mk = raw_market(spark, [("treasury_10y", "2024-01-01", 3.0, "m", None, None), ("treasury_10y", "2024-02-01", 4.0, "m", None, None),
                            ("cap_rate", "2024-Q1", 5.0, "q", "office", "National"), ("cap_rate", "2024-Q1", 7.0, "q", "hotel", "National")])
    current = feat.current_market(mk)
    rows = [loan(0, noi_annual=1e6, current_balance=10e6), loan(1, property_type="warehouse", noi_annual=0.0, current_balance=0.0)]
    got = {r.loan_id: r for r in feat.loan_features(silver.cast_types(frame(spark, rows)), current).collect()}
    a, b = got["LN-000"], got["LN-001"]
    assert (a.current_cap_rate, a.current_value, a.current_ltv, a.refinance_rate) == (5.0, 20e6, 0.5, 0.065)
    assert a.new_dscr == pytest.approx(1.5385) and a.rate_gap_bps == 300.0 and not a._refi_stressed and a._rate_gap_positive
    assert b.current_cap_rate == 6.0 and b.current_value == 30e6 and b.new_dscr == 99.0 and b.debt_yield == 0.0
    empty = feat.current_market(mk.where("1 = 0"))
    assert feat.loan_features(silver.cast_types(frame(spark, rows[:1])), empty).first().current_cap_rate == 7.5


def test_gates(spark):
    good = frame(spark, [loan(i) for i in range(10)])
    report = {r.check_name: r.status for r in quality.loan_gate(good).collect()}
    assert set(report.values()) == {"PASS"} and quality.enforce(quality.loan_gate(good))
    bad = frame(spark, [loan(0), loan(0), loan(1, maturity_date=None), loan(2, ltv_at_origination=3.0, property_type="castle")])
    report = {r.check_name: r.status for r in quality.loan_gate(bad).collect()}
    assert report["DUPLICATES"] == "FAIL" and report["NULL_RATE(maturity_date)"] == "FAIL"
    assert report["RANGE(ltv_at_origination)"] == "WARN" and report["PROPERTY_TYPE"] == "WARN"
    with pytest.raises(quality.DataQualityError):
        quality.enforce(quality.loan_gate(bad))
    assert quality.enforce(quality.loan_gate(bad), halt=False) is False
    assert {r.status for r in quality.loan_gate(good.drop("noi_annual")).collect()} == {"FAIL"}
    assert {r.check_name: r.status for r in quality.loan_gate(good.where("1 = 0")).collect()}["ROW_COUNT"] == "FAIL"


def test_market_gate(spark):
    rows = [(t, "2024-01-01", 4.0, "m", None, None) for t in ("treasury_10y", "sofr", "cap_rate")] + [("treasury_5y", "2024-01-01", None, "m", None, None)]
    report = {r.check_name: r.status for r in quality.market_gate(raw_market(spark, rows)).collect()}
    assert report == {"ROW_COUNT": "PASS", "DATA_TYPES": "FAIL", "NULL_VALUES": "FAIL", "VALUE_RANGE": "PASS", "HISTORY": "WARN"}


def test_constant_table_is_broadcast_by_its_size(spark):
    dim = constant_table(spark, [("a", 1, 2.5, None), ("b'c", 2, 0.1, "x")], "k string, n int, d double, s string")
    assert [tuple(r) for r in dim.collect()] == [("a", 1, 2.5, None), ("b'c", 2, 0.1, "x")]
    big = spark.range(100).select(F.chr(97 + F.col("id") % 2).alias("k"))
    assert "BroadcastHashJoin" in big.join(dim, "k")._jdf.queryExecution().executedPlan().toString()


def test_constant_table_keeps_odd_values(spark):
    import math

    rows = [("a\\", math.inf), ("b\\nc", -math.inf), ("it's", math.nan), ("\\'", 1e300), (None, None)]
    got = [tuple(r) for r in constant_table(spark, rows, "s string, d double").collect()]
    assert [r[0] for r in got] == [r[0] for r in rows]
    assert got[0][1] == math.inf and got[1][1] == -math.inf and math.isnan(got[2][1]) and got[3][1] == 1e300 and got[4][1] is None
    assert constant_table(spark, [], "s string, d double").count() == 0
