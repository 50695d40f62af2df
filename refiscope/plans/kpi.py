"""Portfolio measures, tier diagnostics and report views over the current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..operators.ordered import exact_median
from .gold import with_maturity_period

DISTRESSED = ("critical", "high")


def _bad() -> Column:
    return F.col("distress_tier").isin(*DISTRESSED)


def _upb(when: Column | None = None) -> Column:
    balance = F.col("current_balance")
    return F.sum(balance) if when is None else F.sum(F.when(when, balance).otherwise(0.0))


def _share(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def portfolio_measures() -> list[Column]:
    """UPB, counts, distressed shares and balance-weighted averages."""
    weighted = lambda c: _share(F.sum(F.col(c) * F.col("current_balance")), _upb())
    n = F.count(F.lit(1))
    return [
        _upb().alias("total_upb"),
        n.alias("loan_count"),
        F.count_if(_bad()).alias("distressed_loan_count"),
        _upb(_bad()).alias("distressed_upb"),
        _share(F.count_if(_bad()).cast("double"), n.cast("double")).alias("pct_distressed_by_count"),
        _share(_upb(_bad()), _upb()).alias("pct_distressed_by_upb"),
        weighted("new_dscr").alias("weighted_avg_dscr"),
        weighted("current_ltv").alias("weighted_avg_ltv"),
        weighted("rate_gap_bps").alias("weighted_avg_refinance_gap"),
    ]


def portfolio_kpis(state: DataFrame, by: list[str] | None = None) -> DataFrame:
    return (state.groupBy(*by) if by else state.groupBy()).agg(*portfolio_measures())


def maturing_upb(state: DataFrame) -> DataFrame:
    """UPB and distressed UPB maturing per quarter; both sides use current balance."""
    return (
        with_maturity_period(state, None, None)
        .groupBy("maturity_year", "maturity_quarter")
        .agg(
            _upb().alias("upb_maturing"),
            _upb(_bad()).alias("distressed_upb_maturing"),
            _share(_upb(_bad()), _upb()).alias("pct_wall_distressed"),
        )
    )


def vintage_distress_growth(state: DataFrame) -> DataFrame:
    """Distressed share per vintage minus the share of the year before (null if absent).

    The window runs over one row per vintage.
    """
    n = F.count(F.lit(1)).cast("double")
    by_year = state.groupBy("origination_year").agg((F.count_if(_bad()) / n).alias("pct_distressed"))
    w = Window.partitionBy(F.lit(0)).orderBy("origination_year")
    prior = F.when(F.lag("origination_year").over(w) == F.col("origination_year") - 1, F.lag("pct_distressed").over(w))
    return by_year.select("origination_year", "pct_distressed", (F.col("pct_distressed") - prior).alias("yoy_growth"))


def tier_distribution(state: DataFrame) -> DataFrame:
    """Count and share per tier; the total is a window over the four aggregated rows."""
    n = F.count(F.lit(1))
    by_tier = state.groupBy("distress_tier").agg(n.alias("n"))
    everything = Window.partitionBy(F.lit(0))
    return by_tier.withColumn("pct", F.col("n") / F.sum("n").over(everything))


def tier_by_type(state: DataFrame) -> DataFrame:
    """One row per type, a share column per tier, and average cover and leverage."""
    n = F.count(F.lit(1))
    share = [(F.count_if(F.col("distress_tier") == t) / n).alias(f"pct_{t}") for t in ("critical", "high", "medium", "low")]
    return state.groupBy("property_type").agg(
        n.alias("n"), *share, F.avg("new_dscr").alias("avg_dscr"), F.avg("current_ltv").alias("avg_ltv")
    )


def summary_statistics(state: DataFrame, columns: tuple[str, ...] = ("new_dscr", "current_ltv")) -> DataFrame:
    """Mean, median, standard deviation, minimum and maximum, one row per column.

    Columns are unpivoted so that one distributed median serves all of them.
    """
    long = state.unpivot([], list(columns), "metric", "value")
    basic = long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    return basic.join(exact_median(long, "value", ["metric"]), "metric")


def bucket_histogram(state: DataFrame, column: str, bounds: list[float]) -> DataFrame:
    """Counts in left-closed buckets ``< b1, b1-b2, ..., >= bn``."""
    expr = F.when(F.col(column) < bounds[0], F.lit(0))
    for i in range(1, len(bounds)):
        expr = expr.when(F.col(column) < bounds[i], F.lit(i))
    bucket = expr.otherwise(F.lit(len(bounds)))
    n = F.count(F.lit(1))
    out = state.groupBy(F.lit(column).alias("metric"), bucket.alias("bucket")).agg(n.alias("n"))
    return out.withColumn("pct", F.col("n") / F.sum("n").over(Window.partitionBy("metric")))


def trigger_overlap(state: DataFrame) -> DataFrame:
    dscr, ltv = F.col("new_dscr") < 1.0, F.col("current_ltv") > 0.80
    which = F.when(dscr & ltv, "both").when(dscr, "only_dscr").when(ltv, "only_ltv").otherwise("neither")
    return state.groupBy(which.alias("trigger")).agg(F.count(F.lit(1)).alias("n"))


def distress_matrix(state: DataFrame) -> DataFrame:
    """Metro rows, type columns, distressed share; pivot values are fixed, so no extra pass."""
    types = [t for t, *_ in C.PROPERTY_TYPES]
    share = F.count_if(_bad()) / F.count(F.lit(1))
    return state.groupBy("metro_area").pivot("property_type", types).agg(share)


def vintage_by_tier(state: DataFrame) -> DataFrame:
    return state.groupBy("origination_year", "distress_tier").agg(F.count(F.lit(1)).alias("loan_count"))


def sponsor_mix(state: DataFrame) -> DataFrame:
    return state.groupBy("sponsor_credit_tier").agg(F.count(F.lit(1)).alias("loan_count"))


def top_metros(state: DataFrame, k: int = 10) -> DataFrame:
    by_metro = state.groupBy("metro_area").agg(_upb(_bad()).alias("distressed_upb"))
    return by_metro.orderBy(F.desc("distressed_upb"), "metro_area").limit(k)


def portfolio_profile(loans: DataFrame) -> DataFrame:
    """Counts and averages per type, as printed after a load."""
    return loans.groupBy("property_type").agg(
        F.count(F.lit(1)).alias("loan_count"), F.count_distinct("loan_id").alias("unique_loans"),
        F.avg("original_balance").alias("avg_balance"), F.sum("original_balance").alias("total_balance"),
        F.avg("ltv_at_origination").alias("avg_ltv"), F.avg("dscr_at_origination").alias("avg_dscr"),
    )


EXPLORER_COLUMNS = [
    "loan_id", "property_type", "metro_area", "distress_tier", "current_ltv", "new_dscr",
    "rate_gap_bps", "current_balance", "months_to_maturity",
]


def loan_explorer(
    state: DataFrame, property_type: str | None = None, metro: str | None = None, tier: str | None = None,
    months_from: float = -24.0, months_to: float = 120.0,
) -> DataFrame:
    """Filtered loan list of the explorer page."""
    out = state.where(F.col("months_to_maturity").between(months_from, months_to))
    for column, value in (("property_type", property_type), ("metro_area", metro), ("distress_tier", tier)):
        if value is not None:
            out = out.where(F.col(column) == value)
    return out.select(*EXPLORER_COLUMNS)


def office_focus(state: DataFrame) -> DataFrame:
    return state.where("property_type = 'office'").select(*EXPLORER_COLUMNS)


def near_term_maturities(state: DataFrame, months: float = 24.0) -> DataFrame:
    return state.where(F.col("months_to_maturity") < months).select(*EXPLORER_COLUMNS)
