"""Clean loans x current market -> valuation and coverage features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import finance as fin
from ..session import constant_table, stage


@dataclass(frozen=True)
class CurrentMarket:
    """Latest cap rate per type (staged) and a one-row table of scalars."""

    caps: DataFrame
    scalars: DataFrame


def with_origination_treasury(loans: DataFrame) -> DataFrame:
    """Average treasury of the origination year, 2.5 outside the known years."""
    years = constant_table(loans.sparkSession, C.TREASURY_BY_YEAR, "_year int, _rate double")
    return (
        loans.join(years, F.col("origination_year") == F.col("_year"), "left")
        .withColumn("treasury_at_origination", F.coalesce("_rate", F.lit(C.DEFAULT_TREASURY_BY_YEAR)))
        .drop("_year", "_rate")
    )


def latest_treasury(market: DataFrame, data_type: str = "treasury_10y") -> DataFrame:
    """Most recent rate of a series as one row, 4.0 without observations."""
    seen = market.where((F.col("data_type") == data_type) & F.col("value").isNotNull() & (F.col("observation_date") != ""))
    return seen.agg(F.coalesce(F.max_by("value", "observation_date"), F.lit(C.DEFAULT_TREASURY)).alias("treasury"))


def latest_cap_rates(market: DataFrame) -> DataFrame:
    """(cap_type, cap_rate) at the latest cap-rate date: the national rate, or the
    average over metros when that date has no national rate at all; constants when
    there are no cap rates."""
    caps = market.where(
        "data_type = 'cap_rate' and value is not null and observation_date <> '' and property_type <> ''"
    ).select(
        F.lower("property_type").alias("cap_type"),
        F.coalesce(F.nullif("metro", F.lit("")), F.lit("National")).alias("metro"),
        "observation_date",
        "value",
    )
    newest = caps.agg(F.max("observation_date").alias("newest"))
    at_latest = caps.crossJoin(F.broadcast(newest)).where("observation_date = newest")  # one-row side
    by_type = at_latest.groupBy("cap_type").agg(
        F.max(F.when(F.col("metro") == "National", F.col("value"))).alias("national"), F.avg("value").alias("metro_mean")
    )
    by_type = stage(by_type, "latest-caps")
    any_national = by_type.agg(F.count("national").alias("n_national"))
    picked = by_type.crossJoin(F.broadcast(any_national)).select(  # one-row side
        "cap_type", F.when(F.col("n_national") > 0, F.col("national")).otherwise(F.col("metro_mean")).alias("cap_rate")
    ).where("cap_rate is not null")
    if by_type.isEmpty():
        picked = constant_table(market.sparkSession, C.DEFAULT_CAP_BY_TYPE, "cap_type string, cap_rate double")
    return picked


def current_market(market: DataFrame) -> CurrentMarket:
    caps = latest_cap_rates(market)
    mean_cap = caps.agg(F.avg("cap_rate").alias("mean_cap"))
    return CurrentMarket(caps, latest_treasury(market).crossJoin(F.broadcast(mean_cap)))


def loan_features(loans: DataFrame, market: CurrentMarket, computed_at: Column | None = None) -> DataFrame:
    """Value, LTV, refinance rate, rate gap, DSCR and debt yield at current rates."""
    stamp = computed_at if computed_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    priced = (
        loans.join(market.caps, F.lower("property_type") == F.col("cap_type"), "left")
        .crossJoin(F.broadcast(market.scalars))  # one-row side
        .withColumn("_cap", F.coalesce("cap_rate", "mean_cap"))
        .where("_cap is not null")
    )
    noi, balance = F.coalesce("noi_annual", F.lit(0.0)), F.coalesce("current_balance", F.lit(0.0))
    priced = priced.withColumns(
        {
            "_value": F.when((noi != 0) & (F.col("_cap") > 0), noi / (F.col("_cap") / 100.0)).otherwise(
                F.coalesce("property_value_at_origination", F.lit(0.0))
            ),
            "_refi": fin.refinance_rate("treasury", "property_type"),
        }
    )
    priced = priced.withColumns(
        {
            "_ltv": F.when(F.col("_value") > 0, balance / F.col("_value")).otherwise(
                F.coalesce("ltv_at_origination", F.lit(0.0))
            ),
            "_gap": F.col("_refi") - F.coalesce("note_rate", F.lit(0.0)),
            "_ds": fin.annual_debt_service(
                balance, "_refi", F.coalesce("amortization_type", F.lit("amortizing"))
            ),
            "_yield": F.when(balance > 0, noi / balance).otherwise(F.lit(0.0)),
        }
    ).withColumn("_dscr", F.when(F.col("_ds") > 0, noi / F.col("_ds")).otherwise(F.lit(C.NO_DEBT_SERVICE_DSCR)))
    return priced.select(
        *loans.columns,
        fin.rounded("_cap", 4).alias("current_cap_rate"),
        fin.rounded("_value", 2).alias("current_value"),
        fin.rounded("_ltv", 4).alias("current_ltv"),
        fin.rounded("_refi", 6).alias("refinance_rate"),
        fin.rounded(F.col("_refi") * 100.0, 4).alias("refinance_rate_pct"),
        fin.rounded("_gap", 6).alias("rate_gap"),
        fin.rounded(fin.decimal_to_bps("_gap"), 1).alias("rate_gap_bps"),
        fin.rounded("_dscr", 4).alias("new_dscr"),
        fin.rounded("_ds", 2).alias("annual_debt_service_refi"),
        fin.rounded("_yield", 4).alias("debt_yield"),
        fin.rounded(F.col("_yield") * 100.0, 2).alias("debt_yield_pct"),
        ((F.col("_dscr") < 1.0) | (F.col("_ltv") > 0.80)).alias("_refi_stressed"),
        (F.col("_gap") > 0).alias("_rate_gap_positive"),
        stamp.alias("_feature_computed_at"),
    )
