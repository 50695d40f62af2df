"""Spark side of the intermediate tables used by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import finance as fin
from ..plans import features as feat
from ..plans import market, silver
from ..session import stage
from ..sources import adapter

def silver_market(spark: SparkSession, sf: str) -> DataFrame:
    raw = stage(adapter.raw_market(spark, sf), "raw-market")
    return stage(market.standardize(raw, F.lit(adapter.STAMP)), "market")


def loan_market(spark: SparkSession, sf: str) -> DataFrame:
    """The two series loans are priced with; the other branches are pruned by Catalyst."""
    raw = adapter.raw_market(spark, sf)
    ten_year = market.treasury_rates(raw.where("data_type = 'treasury_10y'"))
    return stage(ten_year.unionByName(market.cap_rates(raw.where("data_type = 'cap_rate'"))), "loan-market")


def now(spark: SparkSession, sf: str, market_rates: DataFrame | None = None) -> feat.CurrentMarket:
    return feat.current_market(market_rates if market_rates is not None else loan_market(spark, sf))


def dated_loans(spark: SparkSession, sf: str, dealt: bool = False) -> DataFrame:
    return silver.add_time_to_maturity(adapter.loans(spark, sf, dealt), adapter.REFERENCE_DATE)


def features(spark: SparkSession, sf: str, market_rates: DataFrame | None = None, dealt: bool = False) -> DataFrame:
    return feat.loan_features(dated_loans(spark, sf, dealt), now(spark, sf, market_rates), F.lit(adapter.STAMP))


def snapshot_features(spark: SparkSession, sf: str, market_rates: DataFrame | None = None) -> DataFrame:
    snaps = silver.add_time_to_maturity(adapter.loan_snapshots(spark, sf), adapter.REFERENCE_DATE)
    return feat.loan_features(snaps, now(spark, sf, market_rates), F.col("snapshot_at"))


def state(spark: SparkSession, sf: str, market_rates: DataFrame | None = None, dealt: bool = False) -> DataFrame:
    """Portfolio with tier columns: one snapshot per loan, so no ranking is needed. ``dealt``: over all cores."""
    return features(spark, sf, market_rates, dealt).withColumns(
        {
            "distress_tier": fin.distress_tier(),
            "dscr_change": F.col("new_dscr") - F.col("dscr_at_origination"),
            "ltv_change": F.col("current_ltv") - F.col("ltv_at_origination"),
        }
    )
