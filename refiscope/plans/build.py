"""End-to-end compositions: clean, build gold, write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..session import stage
from ..sources.tables import read_table, write_table
from . import features as feat
from . import gold, market, silver


def _counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Row count per written table, answered from Parquet footers."""
    out = None
    for name, path in paths.items():
        one = read_table(spark, path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def build_silver(
    bronze_loans: DataFrame, bronze_market: DataFrame, folder: str, order: list[Column],
    reference_date: str | None = None, halt: bool = True, stamp: Column | None = None,
) -> DataFrame:
    """Gate, clean, standardise, compute features, gate again, write; returns counts and statuses."""
    spark = bronze_loans.sparkSession
    raw = stage(bronze_market, "bronze-market")
    statuses = {
        "bronze_loan_quality": quality.enforce(quality.loan_gate(bronze_loans, complete=True), halt),
        "bronze_market_quality": quality.enforce(quality.market_gate(raw), halt),
    }
    paths = {n: f"{folder}/{n}" for n in ("loans", "market_rates", "loan_features")}
    write_table(silver.clean_loans(bronze_loans, order, reference_date, stamp), paths["loans"], "origination_year")
    write_table(market.standardize(raw, stamp), paths["market_rates"], "data_type")
    current = feat.current_market(read_table(spark, paths["market_rates"]))
    write_table(feat.loan_features(read_table(spark, paths["loans"]), current, stamp), paths["loan_features"], "origination_year")
    statuses["silver_features_quality"] = quality.enforce(quality.feature_gate(read_table(spark, paths["loan_features"]), complete=True), halt)
    status_rows = [f"SELECT '{k}' AS item, '{'PASS' if ok else 'FAIL'}' AS status, CAST(NULL AS BIGINT) AS n" for k, ok in statuses.items()]
    counts = _counts(spark, paths).select(F.concat("table_name", F.lit("_count")).alias("item"), F.lit("OK").alias("status"), "n")
    return counts.unionByName(spark.sql(" UNION ALL ".join(status_rows)))


def build_gold(features: DataFrame, folder: str, tie_break: list[Column] | None = None) -> DataFrame:
    """Write the four gold tables from one staged read of the features; returns row counts."""
    spark = features.sparkSession
    source = stage(features, "loan-features")
    tables = {
        "loan_current_state": gold.current_state(source, tie_break),
        "loan_distress_history": gold.distress_history(source),
        "market_distress_index": gold.market_distress_index(source),
        "maturity_wall": gold.maturity_wall(source),
    }
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}"
        write_table(df, paths[name])
    return _counts(spark, paths)
