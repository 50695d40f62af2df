"""Loan and market views over the order/customer/nation/lineitem tables.

Every order becomes a loan and every ordering day a market observation, by
deterministic integer arithmetic, so that all plans run on (and grow with) the given
tables. The catalog's SQL restates the same views for cross-checking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import finance as fin
from ..session import stage
from .market_feeds import assemble, compounded_index

REFERENCE_DATE = "2025-06-30"
STAMP = "2025-06-30T00:00:00"

SEGMENT_TO_TYPE = [
    ("BUILDING", "office"), ("AUTOMOBILE", "retail"), ("MACHINERY", "industrial"),
    ("HOUSEHOLD", "multifamily"), ("FURNITURE", "hotel"),
]
CAP_BASE = [("office", 600), ("retail", 620), ("industrial", 480), ("multifamily", 470), ("hotel", 780)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(key: Column, pairs) -> Column:
    expr = F.when(F.lit(False), F.lit(pairs[0][1]))
    for k, v in pairs:
        expr = expr.when(key == k, F.lit(v))
    return expr


def _orders(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Orders with customer segment and nation; join sides are sized from file statistics. ``dealt``: over all
    cores, for work that costs more than a shuffle of the columns in use; a small file is read by few."""
    o = table(spark, sf_dir, "orders")
    if dealt:
        o = o.repartition(4 * spark.sparkContext.defaultParallelism, "o_orderkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("property_type", _lookup(F.col("c_mktsegment"), SEGMENT_TO_TYPE))
    )


def origination_terms(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Loans with origination terms only, before the derived amounts."""
    k = F.col("o_orderkey")
    orig = F.add_months(F.col("o_orderdate").cast("date"), 240)
    term = F.when(k % 3 == 0, 5).when(k % 3 == 1, 7).otherwise(10)
    return (
        _orders(spark, sf_dir, dealt)
        .withColumns({"_orig": orig, "loan_term_years": term})
        .select(
            k.alias("loan_key"),
            F.concat(F.lit("LN-"), k.cast("string")).alias("loan_id"),
            F.concat(F.lit("DEAL-"), (k % 1000).cast("string")).alias("deal_name"),
            F.concat(F.lit("PROP-"), k.cast("string")).alias("property_id"),
            F.col("_orig").cast("string").alias("origination_date"),
            # Maturities fall on many days, some of them within weeks of the origination.
            F.when(k % 211 == 0, F.date_add("_orig", (k % 45).cast("int")))
            .otherwise(F.date_add(F.add_months("_orig", F.col("loan_term_years") * 12), (k % 29).cast("int"))).cast("string").alias("maturity_date"),
            F.year("_orig").alias("origination_year"),
            fin.rounded(F.col("o_totalprice") * 100.0, 0).alias("original_balance"),
            ((30 + k % 40) / 1000.0).alias("note_rate"),
            F.when(k % 2 == 0, "interest_only").otherwise("amortizing").alias("amortization_type"),
            (k % 12 != 0).alias("balloon_flag"),
            "loan_term_years",
            F.when(F.col("o_orderstatus") == "F", "acquisition").otherwise("refinance").alias("loan_purpose"),
            "property_type",
            F.col("n_name").alias("metro_area"),
            F.concat(F.col("n_name"), F.lit("-"), (k % 4).cast("string")).alias("submarket"),
            F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, 0.0).otherwise((50 + k % 50) / 100.0).alias("occupancy_pct"),
            ((40 + k % 46) / 100.0).alias("ltv_at_origination"),
            ((80 + k % 121) / 100.0).alias("dscr_at_origination"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "A")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "B")
            .otherwise("C")
            .alias("sponsor_credit_tier"),
        )
    )


def with_derived_amounts(terms: DataFrame, as_of_year: int = 2025) -> DataFrame:
    """Property value, debt service, NOI and current balance from origination terms."""
    service = fin.annual_debt_service("original_balance", "note_rate", "amortization_type")
    years = F.least(F.lit(as_of_year) - F.col("origination_year"), F.col("loan_term_years"))
    left = F.when(
        (F.col("amortization_type") == "amortizing") & (years > 0),
        F.col("original_balance") * fin.remaining_balance_factor("note_rate", years * 12),
    ).otherwise(F.col("original_balance"))
    return terms.withColumns(
        {
            "property_value_at_origination": fin.rounded(F.col("original_balance") / F.col("ltv_at_origination"), 2),
            "noi_annual": fin.rounded(F.col("dscr_at_origination") * service, -3),
            "current_balance": fin.rounded(left, -3),
        }
    )


def loans(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """One clean loan per order (occupancy may still be missing)."""
    return with_derived_amounts(origination_terms(spark, sf_dir, dealt))


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans as landed: text fields, repeated ids, blank dates, unreadable balances."""
    base = loans(spark, sf_dir)
    k = F.col("loan_key")
    text = base.withColumns(
        {
            "original_balance": F.when(k % 89 == 0, "n/a").otherwise(F.col("original_balance").cast("bigint").cast("string")),
            "maturity_date": F.when(k % 97 == 0, "").otherwise(F.col("maturity_date")),
            "loan_term_years": F.col("loan_term_years").cast("string"),
            "origination_year": F.col("origination_year").cast("string"),
            "balloon_flag": F.when(F.col("balloon_flag"), "True").otherwise("False"),
            "property_type": F.when(k % 1013 == 0, "warehouse").otherwise(F.col("property_type")),
            "ltv_at_origination": F.when(k % 211 == 0, 1.25).when(k % 499 == 0, 2.5).otherwise(F.col("ltv_at_origination")),
            "dscr_at_origination": F.when(k % 223 == 0, 0.4).otherwise(F.col("dscr_at_origination")),
        }
    ).withColumn("ingested_at", F.lit("2025-06-01T00:00:00"))
    again = text.where(k % 50 == 0).withColumns(
        {"ingested_at": F.lit("2025-06-02T00:00:00"), "note_rate": F.col("note_rate") + 0.01}
    )
    return text.unionByName(again)




def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.floor(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")) * 8 / 5).cast("int")
    obs = _orders(spark, sf_dir).withColumn("obs_date", F.date_add(F.lit("2015-01-01").cast("date"), days))
    m = (F.year("obs_date") - 2015) * 12 + F.month("obs_date") - 1
    q = (F.year("obs_date") - 2015) * 4 + F.quarter("obs_date") - 1
    return obs.select(
        "o_orderkey", "o_orderstatus", "obs_date", m.alias("m"), q.alias("q"),
        F.concat(F.year("obs_date").cast("string"), F.lit("-Q"), F.quarter("obs_date").cast("string")).alias("quarter"),
        "property_type", F.col("n_name").alias("metro"),
    )


def _tagged(df: DataFrame, data_type: str, frequency: str, series_id: str, ptype=None, metro=None) -> DataFrame:
    blank = F.lit("")
    return df.select(
        F.lit(data_type).alias("data_type"), "observation_date", "value", F.lit(frequency).alias("frequency"),
        (ptype if ptype is not None else blank).alias("property_type"),
        (metro if metro is not None else blank).alias("metro"),
        F.lit(series_id).alias("series_id"),
    )


def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over the orders: key sums per day, status, type and metro.

    All market series are sums over this table, which is bounded by the calendar; it is
    staged so that the orders are scanned and joined once.
    """
    keys = ["obs_date", "m", "q", "quarter", "o_orderstatus", "property_type", "metro"]
    return stage(observations(spark, sf_dir).groupBy(*keys).agg(F.sum("o_orderkey").alias("total")), "daily-totals")


def _growth(daily: DataFrame) -> DataFrame:
    return daily.groupBy("quarter").agg(((F.sum("total") % 60 - 25) / 1000.0).alias("annual_growth"))


def growth_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(quarter, annual_growth) of the price index."""
    return _growth(daily_totals(spark, sf_dir))


def raw_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tall market observations: several a month for treasuries, gaps, quarter labels,
    missing and out-of-range values."""
    obs = daily_totals(spark, sf_dir)
    total = F.sum("total")
    ten = obs.where("m % 7 <> 3").groupBy("obs_date", "m").agg(((150 + 2 * F.col("m") + total % 40) / 100.0).alias("value"))
    five = obs.where("o_orderstatus = 'F' and m % 5 <> 2").groupBy("obs_date", "m").agg(
        ((130 + 2 * F.col("m") + total % 40) / 100.0).alias("value")
    )
    sofr = obs.where("o_orderstatus = 'O' and m % 9 <> 4").groupBy("m").agg(
        F.date_format(F.min("obs_date"), "yyyy-MM").alias("observation_date"),
        ((100 + 2 * F.col("m") + total % 30) / 100.0).alias("value"),
    )
    base = _lookup(F.col("property_type"), CAP_BASE)
    level = (base + 3 * F.col("q") + total % 25) / 100.0
    national = obs.groupBy("property_type", "quarter", "q").agg(level.alias("value"))
    local = obs.groupBy("property_type", "metro", "quarter", "q").agg(
        F.when(total % 37 == 0, F.lit(None)).when(total % 41 == 0, 25.0).otherwise(level).alias("value")
    )
    dated = lambda df: df.withColumn("observation_date", F.col("obs_date").cast("string"))
    quarterly = lambda df: df.withColumnRenamed("quarter", "observation_date")
    index = compounded_index(_growth(obs)).select("observation_date", "value")
    return assemble(
        _tagged(dated(ten), "treasury_10y", "monthly", "DGS10"),
        _tagged(dated(five), "treasury_5y", "monthly", "DGS5"),
        _tagged(sofr, "sofr", "monthly", "SOFR"),
        _tagged(quarterly(national), "cap_rate", "quarterly", "", F.col("property_type"), F.lit("National")),
        _tagged(quarterly(local), "cap_rate", "quarterly", "", F.col("property_type"), F.col("metro")),
        _tagged(index, "cre_price_index", "quarterly", "CRE_INDEX"),
    )


def loan_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several dated states per loan, one per order line, with its own balance and NOI."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey", "l_shipdate")
    seconds = F.col("l_linenumber") * 3600 + F.col("l_partkey") % 3600
    at = F.date_add(F.add_months(F.col("l_shipdate").cast("date"), 240), 0).cast("timestamp")
    stamp = F.date_format(F.timestamp_seconds(F.unix_timestamp(at) + seconds), "yyyy-MM-dd'T'HH:mm:ss")
    return (
        loans(spark, sf_dir)
        .join(line, F.col("loan_key") == F.col("l_orderkey"))
        .withColumns(
            {
                "current_balance": fin.rounded(F.col("current_balance") * (100 - F.col("l_linenumber")) / 100.0, -3),
                "noi_annual": fin.rounded(F.col("noi_annual") * (75 + F.col("l_quantity")) / 100.0, -3),
                "snapshot_at": stamp,
                "snapshot_no": F.col("l_partkey") * 1000000 + F.col("l_suppkey") * 10 + F.col("l_linenumber"),
            }
        )
        .drop("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey", "l_shipdate")
    )
