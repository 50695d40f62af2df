import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from refiscope.operators import asof, encode, explain, metrics, treeshap
from refiscope.plans import classifier, frame, stress, survival


def silver_market(spark):
    rows = [("treasury_10y", f"{y}-{m:02d}-01", 2.0 + (y - 2015) * 0.25 + (m - 1) * 0.01, None, None) for y in range(2015, 2026) for m in range(1, 13)]
    base = {"office": 6.0, "retail": 6.5, "industrial": 5.5, "multifamily": 5.0, "hotel": 7.5}
    rows += [("cap_rate", f"{y}-Q{q}", b + (y - 2015) * 0.15 + (q - 1) * 0.02, t, "National") for t, b in base.items() for y in range(2015, 2026) for q in range(1, 5)]
    return spark.createDataFrame(rows, "data_type string, observation_date string, value double, property_type string, metro string")


def test_asof_lookups(spark):
    mk = silver_market(spark)
    sparse = mk.where("observation_date in ('2016-01-01', '2016-04-01', '2018-Q2', '2018-Q4')")
    probe = spark.createDataFrame([("2016-03-20", "office"), ("2015-05-01", "Office"), ("2020-01-01", "office"), (None, "office"), ("2018-11-30", "castle")], "d string, t string")
    probe = probe.withColumn("date", F.col("d").cast("date"))
    out = asof.with_treasury(probe, asof.treasury_curve(sparse), "date", "r")
    out = asof.with_cap_rate(out, asof.cap_rate_curve(sparse), "date", "t", "c")
    got = {(r.d, r.t): (round(r.r, 4), round(r.c, 4)) for r in out.collect()}
    assert got[("2016-03-20", "office")] == (2.25, 6.47)  # before the first quarter: earliest
    assert got[("2015-05-01", "Office")][0] == 2.25
    assert got[("2020-01-01", "office")] == (2.28, 6.51)
    assert got[(None, "office")] == (4.0, 6.5)
    assert got[("2018-11-30", "castle")][1] == 6.5
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "SortMergeJoin" not in plan


def loans(spark, n=300):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        y = 2015 + i % 6
        rows.append((f"LN-{i:04d}", rng.choice(["office", "retail", "industrial", "multifamily", "hotel"]), f"M{i % 5}", y, f"{y}-{i % 12 + 1:02d}-10", f"{y + 5}-{i % 12 + 1:02d}-10",
                     20e6, 18e6 + rng.random() * 4e6, 0.03 + rng.random() * 0.03, rng.choice(["interest_only", "amortizing"]), bool(i % 4), 0.5 + rng.random() * 0.3,
                     1.0 + rng.random(), 0.9, 1.0e6 + rng.random() * 1e6, rng.choice("ABC")))
    return spark.createDataFrame(rows, "loan_id string, property_type string, metro_area string, origination_year int, origination_date string, maturity_date string, "
                                 "original_balance double, current_balance double, note_rate double, amortization_type string, balloon_flag boolean, ltv_at_origination double, "
                                 "dscr_at_origination double, occupancy_pct double, noi_annual double, sponsor_credit_tier string")


@pytest.fixture(scope="module")
def labelled(spark):
    curves = frame.market_curves(silver_market(spark))
    rows = frame.labelled_loans(loans(spark), curves)
    return rows.cache()


def test_observation_features_use_the_snapshot_date(spark, labelled):
    r = labelled.where("loan_id = 'LN-0000'").first()
    assert str(r.t_obs) == "2018-01-10"
    assert r.treasury_10y_at_Tobs == pytest.approx(2.75)
    base = {"office": 6.0, "retail": 6.5, "industrial": 5.5, "multifamily": 5.0, "hotel": 7.5}[r.property_type]
    assert r.cap_rate_at_Tobs == pytest.approx(base + 0.45)
    assert r.cap_rate_delta_since_origination_at_Tobs == pytest.approx(0.45)
    assert r.current_ltv_at_Tobs == pytest.approx(r.current_balance * r.cap_rate_at_Tobs / 100 / r.noi_annual)


def test_noise_changes_labels_but_not_features(spark, labelled):
    curves = frame.market_curves(silver_market(spark))
    plain = frame.labelled_loans(loans(spark), curves, shocks=False)
    both = labelled.alias("a").join(plain.alias("b"), "loan_id").select(
        F.col("a.distress_at_maturity").alias("x"), F.col("b.distress_at_maturity").alias("y"), (F.col("a.current_ltv_at_Tobs") - F.col("b.current_ltv_at_Tobs")).alias("d"))
    rows = both.collect()
    assert any(r.x != r.y for r in rows) and all(r.d == 0 for r in rows)


def test_training_frame(spark, labelled):
    tf = frame.assemble_frame(labelled)
    assert {r.split for r in tf.rows.select("split").distinct().collect()} == {"train", "valid", "test"}
    nulls = tf.rows.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in tf.features]).first()
    assert all(v == 0 for v in nulls)
    assert tf.rows.count() == labelled.count()
    with pytest.raises(encode.LeakageError):
        encode.check_feature_names(["cap_rate_at_maturity"])
    leaky = tf.rows.withColumn("copy", F.col("distress_at_maturity").cast("double"))
    with pytest.raises(encode.LeakageError):
        encode.check_correlations(encode.label_correlations(leaky, ["copy"], "distress_at_maturity"))
    encode.check_correlations(encode.label_correlations(tf.rows, tf.features, "distress_at_maturity"))


def test_metrics_match_brute_force(spark):
    rng = random.Random(5)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.4)) for _ in range(400)]
    df = spark.createDataFrame(rows, "p double, y int")
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    ap, seen_pos = 0.0, 0
    for t in sorted({p for p, _ in rows}, reverse=True):
        hit = [y for p, y in rows if p >= t]
        ap += (sum(hit) - seen_pos) / len(pos) * sum(hit) / len(hit)
        seen_pos = sum(hit)
    r = metrics.rank_metrics(df, "p", "y").first()
    assert r.auc_roc == pytest.approx(auc) and r.pr_auc == pytest.approx(ap)
    ks = metrics.ks_statistic(df, "p", F.col("y") == 1).first()
    brute = max(abs(sum(p <= t for p in pos) / len(pos) - sum(p <= t for p in neg) / len(neg)) for t, _ in rows)
    assert ks.ks == pytest.approx(brute)


def test_concordance_matches_all_pairs(spark):
    rng = random.Random(9)
    rows = [(rng.choice([-2.5, 60.0, 60.25, 84.0, 120.0, 200.0]), int(rng.random() < 0.6), round(rng.random(), 1)) for _ in range(250)]
    good = n = 0.0
    for (t1, e1, r1), (t2, e2, r2) in itertools.permutations(rows, 2):
        if e1 and (t1 < t2 or (t1 == t2 and not e2)):
            n += 1
            good += (r1 > r2) + 0.5 * (r1 == r2)
    got = metrics.concordance(spark.createDataFrame(rows, "t double, e int, r double"), "t", "e", "r").first()
    assert got.comparable == n and got.concordance == pytest.approx(good / n)


def brute_cox(x, t, e, penalizer):
    """Gradient of the Efron log-likelihood by direct sums, minimised by Newton with numeric Hessian."""
    n, k = x.shape

    def loglik(b):
        total = -n * penalizer / 2 * b @ b
        w = np.exp(x @ b)
        for s in np.unique(t[e == 1]):
            dead = (t == s) & (e == 1)
            d = dead.sum()
            total += (x[dead] @ b).sum()
            total -= sum(np.log(w[t >= s].sum() - j / d * w[dead].sum()) for j in range(d))
        return total

    b, h = np.zeros(k), 1e-4
    for _ in range(30):
        g = np.array([(loglik(b + h * v) - loglik(b - h * v)) / (2 * h) for v in np.eye(k)])
        hess = np.array([[(loglik(b + h * u + h * v) - loglik(b + h * u - h * v) - loglik(b - h * u + h * v) + loglik(b - h * u - h * v)) / (4 * h * h) for v in np.eye(k)] for u in np.eye(k)])
        b = b - np.linalg.solve(hess, g)
    return b, loglik(b)


def test_cox_fit_matches_direct_likelihood(spark):
    rng = np.random.default_rng(2)
    n = 120
    x = rng.normal(size=(n, 2)) * [1.0, 3.0]
    t = rng.choice([30, 60, 90, 120, 150], size=n)
    e = (rng.random(n) < 0.6).astype(int)
    df = spark.createDataFrame([(int(a), int(b), float(c), float(d)) for a, b, (c, d) in zip(t, e, x)], "duration_days int, event_observed int, a double, b double")
    model = survival.fit_cox(df, ["a", "b"], penalizer=0.1)
    std = x.std(axis=0, ddof=1)
    beta, ll = brute_cox((x - x.mean(axis=0)) / std, t, e, 0.1)
    assert list(model.coefficients.values()) == pytest.approx(list(beta / std), abs=1e-4)
    assert model.log_likelihood == pytest.approx(ll, abs=1e-3)


@pytest.mark.parametrize("deaths", [1, 2, 7, 300, 20_000])
def test_efron_sums_match_term_by_term(deaths):
    s0, t0 = 3.0 * deaths + 5.0, 1.7 * deaths
    share = np.arange(deaths) / deaths
    a = s0 - share * t0
    direct = {"log": np.log(a).sum(), "a1": (1 / a).sum(), "b1": (share / a).sum(), "a2": (1 / a**2).sum(), "b2": (share / a**2).sum(), "c2": (share**2 / a**2).sum()}
    got = survival.efron_sums(np.array([float(deaths)]), np.array([s0]), np.array([t0]))
    for name, value in direct.items():
        assert got[name][0] == pytest.approx(value, rel=1e-9, abs=1e-9), name


def test_short_terms_tie(spark):
    df = spark.createDataFrame([(-3, 1), (5, 0), (30, 1), (31, 1), (400, 0)], "duration_days int, event_observed int")
    got = [(r.duration_days, r.events, r.at_risk) for r in survival.kaplan_meier(df).orderBy("duration_days").collect()]
    assert got == [(30, 2, 5), (31, 1, 2), (400, 0, 1)]


def test_survival_predictions(spark):
    rows = [(f"L{i}", d, e, x) for i, (d, e, x) in enumerate([(300, 1, 0.0), (600, 1, 1.0), (900, 0, 0.5), (1200, 1, -1.0), (1500, 0, 2.0)])]
    df = spark.createDataFrame(rows, "loan_id string, duration_days int, event_observed int, x double")
    beta = {"x": 0.7}
    base = [(r.duration_months, r.cumulative_hazard) for r in survival.baseline_hazard(df, beta).orderBy("duration_days").collect()]
    assert all(a[1] <= b[1] for a, b in zip(base, base[1:]))
    got = {r.loan_id: r for r in survival.predict(df, beta, survival.baseline_hazard(df, beta)).collect()}
    for lid, _d, _e, x in rows:
        hr = math.exp(0.7 * x)
        below = [t for t, h in base if math.exp(-h * hr) <= 0.5]
        assert got[lid].predicted_median_months_to_distress == pytest.approx(round(below[0], 1) if below else 999.0)
        near = min(base, key=lambda p: abs(p[0] - 24))
        assert got[lid].predicted_survival_prob_24m == pytest.approx(round(math.exp(-near[1] * hr), 4))
    km = [r.survival for r in survival.kaplan_meier(df).orderBy("duration_days").collect()]
    assert km == pytest.approx([0.8, 0.6, 0.6, 0.3, 0.3])


def test_tree_contributions_add_up_to_the_margin(spark):
    df = spark.range(300).select(*[F.rand(i).alias(f"f{i}") for i in range(4)], F.lit(1.0).alias("weight"))
    df = df.withColumn("y", (F.col("f0") + F.col("f1") > 1).cast("int")).withColumn("loan_id", F.monotonically_increasing_id().cast("string")).cache()
    names = [f"f{i}" for i in range(4)]
    model = classifier.fit(classifier.vectorized(df, names), classifier.Params(max_depth=4, n_trees=6), label="y")
    expected, leaves = treeshap.ensemble_leaves(model, spark)
    out = model.transform(classifier.vectorized(df, names)).withColumn("s", treeshap.contributions(names, leaves))
    for r in out.select("s", "rawPrediction").collect():
        assert expected + sum(r.s) == pytest.approx(r.rawPrediction[1], abs=1e-9)
    scored = treeshap.with_drivers(classifier.score(model, df, names), names, leaves)
    told = explain.loan_explanations(scored, "pd", "drivers")
    one = explain.explain_loan(told, df.first().loan_id).first()
    assert len(one.top_drivers) == 4 and one.error is None
    assert "not found" in explain.explain_loan(told, "nobody").first().error
    assert 0 <= scored.agg(F.min("pd")).first()[0] and scored.agg(F.max("pd")).first()[0] <= 1


def portfolio(spark):
    rows = [("LN-001", "office", "M", 20e6, 1.5e6, 7.5, 1.0, 0.065, 0.04, 0.025, 250.0, 1.15, 0.075, "interest_only"),
            ("LN-002", "industrial", "M", 15e6, 1.2e6, 5.5, 0.6875, 0.06, 0.04, 0.02, 200.0, 1.1, 0.08, "amortizing")]
    return spark.createDataFrame(rows, "loan_id string, property_type string, metro_area string, current_balance double, noi_annual double, current_cap_rate double, current_ltv double, "
                                 "refinance_rate double, note_rate double, rate_gap double, rate_gap_bps double, new_dscr double, debt_yield double, amortization_type string")


def test_scenario_shocks(spark):
    out = {(r.loan_id, r.scenario_name): r for r in stress.apply_scenarios(portfolio(spark), stress.scenario_table(spark)).collect()}
    assert len(out) == 16
    base, up, cap = out[("LN-001", "baseline")], out[("LN-001", "rate_shock_100bps")], out[("LN-001", "cap_rate_shock_100bps")]
    assert up.refinance_rate - base.refinance_rate == pytest.approx(0.01) and up.rate_gap_bps == pytest.approx(350.0) and up.new_dscr < base.new_dscr
    assert cap.current_value < base.current_value and cap.current_ltv > base.current_ltv
    assert out[("LN-001", "combined_severe")].noi_annual == pytest.approx(1.35e6)
    spared, before = out[("LN-002", "office_specific")], portfolio(spark).where("loan_id = 'LN-002'").first()
    assert (spared.current_ltv, spared.new_dscr, spared.noi_annual) == (before.current_ltv, before.new_dscr, before.noi_annual)
    assert out[("LN-001", "office_specific")].noi_annual == pytest.approx(1.2e6)


def test_stress_run_has_no_shuffle_and_covers_every_scenario(spark, labelled):
    from refiscope.catalog import scorecard

    rows = labelled.withColumns({"refinance_rate": F.lit(0.06), "current_cap_rate": F.lit(6.0), "current_ltv": F.lit(0.7), "new_dscr": F.lit(1.2), "rate_gap_bps": F.lit(100.0)})
    results = stress.run_scenarios(rows, stress.scenario_table(spark), scorecard.score)
    assert "Exchange hashpartitioning" not in results._jdf.queryExecution().executedPlan().toString()
    per = {r.scenario_name: r for r in results.groupBy("scenario_name").agg(F.count("*").alias("n"), F.max(F.abs("delta_pd")).alias("d"), F.avg("stressed_pd").alias("p")).collect()}
    assert len(per) == 8 and {r.n for r in per.values()} == {labelled.count()}
    assert per["baseline"].d == 0 and per["combined_severe"].p > per["rate_shock_100bps"].p > per["baseline"].p
