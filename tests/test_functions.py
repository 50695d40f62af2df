import math

import pytest
from pyspark.sql import functions as F

from refiscope.functions import dates, noise
from refiscope.functions import finance as fin


def test_dates_are_normalized(spark):
    cases = [("2024-03-09", "2024-03-09"), ("2024-Q1", "2024-02-15"), ("2024-q2", "2024-05-15"), ("2024-Q3", "2024-08-15"),
             ("2024-Q4", "2024-11-15"), ("2024-03", "2024-03-01"), ("", None), (None, None), ("soon", "soon")]
    df = spark.createDataFrame([(a, b) for a, b in cases], "a string, b string")
    got = [(r.a, r.n) for r in df.select("a", dates.normalize_date("a").alias("n")).collect()]
    assert got == cases


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("2024-02-30",), ("n/a",), ("2024-02-29",)], "d string")
    assert [str(r.p) for r in df.select(dates.parse_date("d").alias("p")).collect()] == ["None", "None", "2024-02-29"]


def test_debt_service(spark):
    df = spark.createDataFrame([(1e6, 0.06, "interest_only"), (1e6, 0.06, "amortizing"), (1e6, 0.0, "amortizing")], "b double, r double, k string")
    io, level, zero = [r.s for r in df.select(fin.annual_debt_service("b", "r", "k").alias("s")).collect()]
    m = 0.005
    assert io == pytest.approx(60_000)
    assert level == pytest.approx(1e6 * m * (1 + m) ** 360 / ((1 + m) ** 360 - 1) * 12)
    assert zero == pytest.approx(1e6 / 30)


def test_remaining_balance_has_a_floor(spark):
    row = spark.range(1).select(
        fin.remaining_balance_factor(F.lit(0.06), F.lit(0)).alias("new"), fin.remaining_balance_factor(F.lit(0.06), F.lit(350)).alias("old"),
        fin.remaining_balance_factor(F.lit(0.0), F.lit(60)).alias("free")).first()
    assert (row.new, row.old, row.free) == (pytest.approx(1.0), 0.5, 1.0)


def test_tiers_bands_and_severity_at_their_edges(spark):
    df = spark.createDataFrame([(0.99, 0.81), (0.99, 0.80), (1.0, 0.81), (1.24, 0.5), (1.25, 0.70), (2.0, 0.71)], "new_dscr double, current_ltv double")
    assert [r.t for r in df.select(fin.distress_tier().alias("t")).collect()] == ["critical", "high", "high", "medium", "low", "medium"]
    pds = spark.createDataFrame([(0.0,), (0.40,), (0.41,), (0.70,), (0.71,), (1.0,)], "p double")
    assert [r.t for r in pds.select(fin.pd_tier("p").alias("t")).collect()] == ["low", "low", "medium", "medium", "high", "high"]
    sev = spark.createDataFrame([(1.6, 0.6), (1.25, 0.7), (0.8, 1.0)], "new_dscr double, current_ltv double")
    got = [(r.a, r.b) for r in sev.select(fin.dscr_severity().alias("a"), fin.ltv_severity().alias("b")).collect()]
    assert got == [(0.0, 0.0), (0.5, pytest.approx(0.5)), (pytest.approx(1.2), pytest.approx(2.0))]


def test_truthiness(spark):
    df = spark.createDataFrame([("True",), ("true",), ("1",), ("False",), ("",), (None,)], "x string")
    assert [r.t for r in df.select(fin.truthy("x").alias("t")).collect()] == [1, 1, 1, 0, 0, 0]


def test_noise_is_reproducible_and_spread(spark):
    ids = spark.range(4000).select(F.concat(F.lit("LN-"), F.col("id").cast("string")).alias("loan_id"))
    q = lambda: ids.select(noise.uniform("loan_id", "|a").alias("u"), noise.gaussian("loan_id", "|b").alias("g"))
    assert q().collect() == q().collect()
    s = q().agg(F.avg("u").alias("mu"), F.min("u").alias("lo"), F.max("u").alias("hi"), F.avg("g").alias("mg"), F.stddev("g").alias("sg")).first()
    assert abs(s.mu - 0.5) < 0.02 and 0 <= s.lo and s.hi < 1 and abs(s.mg) < 0.06 and abs(s.sg - 1) < 0.05 and not math.isnan(s.sg)


def test_rounding_is_that_of_decimals(spark):
    odd = [0.0, -0.0, 0.5, -0.5, 2.5, 1.005, 0.125, -1499.5, 1500.0, 499.99999999999994, 1e15 + 0.5, 1e300, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(x,) for x in [*odd, *[k * 0.0005 - 0.7 for k in range(3000)]]], "x double")
    for places in (-3, 0, 2, 3, 4):
        assert df.where(~fin.rounded("x", places).cast("string").eqNullSafe(F.round("x", places).cast("string"))).count() == 0
    fast = df.select(fin.rounded("x", 3))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in fast  # not every value goes through a decimal


def test_dates_are_iso_texts_alone(spark):
    texts = ["2025-01-05", "2025-1-05", "2025-01-5 ", " 025-01-01", "+025-01-01", "2025-02-30", "2024-02-29", "0000-01-01", "2025-01-05T00", "", "2025", "2025-00-10", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert df.where(~dates.parse_date("s").eqNullSafe(F.try_to_date("s", "yyyy-MM-dd"))).count() == 0
