"""As-of lookups of market rates.

A backward as-of join is turned into an equi join: the observations of each series
are spread over a gap-free calendar (one row per month or quarter, carrying the last
known value forward), the probe date is clamped to the calendar, and the loan side
joins on the calendar key. No range condition, so no nested-loop join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import label_quarter_index, month_index, parse_date, quarter_index
from ..session import stage


@dataclass(frozen=True)
class Curve:
    """A staged calendar of rates and its first and last key."""

    table: DataFrame
    first: int | None
    last: int | None


def _staged_curve(filled: DataFrame, key: str, name: str) -> Curve:
    table = stage(filled, name)
    lo, hi = table.agg(F.min(key), F.max(key)).first()
    return Curve(table, lo, hi)


def treasury_curve(market: DataFrame, data_type: str = "treasury_10y") -> Curve:
    """One row per calendar month between the first and last observation."""
    seen = (
        market.where((F.col("data_type") == data_type) & F.col("value").isNotNull())
        .withColumn("_d", parse_date("observation_date"))
        .where("_d is not null")
        .groupBy(month_index("_d").alias("month_key"))
        .agg(F.max_by("value", "_d").alias("seen"))
    )
    span = seen.agg(F.min("month_key").alias("lo"), F.max("month_key").alias("hi")).where("lo is not null")
    months = span.select(F.explode(F.sequence("lo", "hi")).alias("month_key"))
    carry = Window.partitionBy(F.lit(data_type)).orderBy("month_key").rowsBetween(Window.unboundedPreceding, 0)
    filled = months.join(seen, "month_key", "left").select(
        "month_key", F.last("seen", ignorenulls=True).over(carry).alias("rate")
    )
    return _staged_curve(filled, "month_key", "treasury-curve")


def cap_rate_curve(market: DataFrame) -> Curve:
    """National cap rates, one row per (type, quarter) over the common calendar.

    Labels ``YYYY-Qn`` and dates are both read as quarters. Before its first
    observation a type carries that first value backward.
    """
    national = F.coalesce(F.col("metro"), F.lit("")).isin("National", "")
    seen = (
        market.where((F.col("data_type") == "cap_rate") & national & F.col("value").isNotNull())
        .select(
            F.lower("property_type").alias("cap_type"),
            label_quarter_index("observation_date").alias("quarter_key"),
            "observation_date",
            "value",
        )
        .where("cap_type <> '' and quarter_key is not null")
        .groupBy("cap_type", "quarter_key")
        .agg(F.max_by("value", "observation_date").alias("seen"))
    )
    span = seen.agg(F.min("quarter_key").alias("lo"), F.max("quarter_key").alias("hi")).where("lo is not null")
    calendar = (
        seen.select("cap_type").distinct().crossJoin(F.broadcast(span))  # one-row side
        .select("cap_type", F.explode(F.sequence("lo", "hi")).alias("quarter_key"))
    )
    by_type = Window.partitionBy("cap_type").orderBy("quarter_key")
    back = by_type.rowsBetween(Window.unboundedPreceding, 0)
    ahead = by_type.rowsBetween(0, Window.unboundedFollowing)
    filled = calendar.join(seen, ["cap_type", "quarter_key"], "left").select(
        "cap_type",
        "quarter_key",
        F.coalesce(
            F.last("seen", ignorenulls=True).over(back), F.first("seen", ignorenulls=True).over(ahead)
        ).alias("rate"),
    )
    return _staged_curve(filled, "quarter_key", "cap-curve")


def _clamped(key, curve: Curve):
    return F.greatest(F.lit(curve.first), F.least(F.lit(curve.last), key))


def with_treasury(df: DataFrame, curve: Curve, date_column: str, out: str) -> DataFrame:
    """Exact month, else latest earlier month, else the earliest; null date -> 4.0."""
    if curve.first is None:
        return df.withColumn(out, F.lit(C.DEFAULT_TREASURY))
    side = curve.table.select(F.col("month_key").alias("_mk"), F.col("rate").alias(out))
    key = F.when(F.col(date_column).isNotNull(), _clamped(month_index(date_column), curve))
    return (
        df.join(side, key == F.col("_mk"), "left")
        .drop("_mk")
        .withColumn(out, F.coalesce(F.col(out), F.lit(C.DEFAULT_TREASURY)))
    )


def with_cap_rate(df: DataFrame, curve: Curve, date_column: str, type_column: str, out: str) -> DataFrame:
    """Same quarter, else latest earlier quarter of the type, else its earliest, else 6.5."""
    if curve.first is None:
        return df.withColumn(out, F.lit(C.DEFAULT_CAP_RATE))
    side = curve.table.select(F.col("cap_type").alias("_ct"), F.col("quarter_key").alias("_qk"), F.col("rate").alias(out))
    key = F.when(F.col(date_column).isNotNull(), _clamped(quarter_index(date_column), curve))
    return (
        df.join(side, (F.lower(F.col(type_column)) == F.col("_ct")) & (key == F.col("_qk")), "left")
        .drop("_ct", "_qk")
        .withColumn(out, F.coalesce(F.col(out), F.lit(C.DEFAULT_CAP_RATE)))
    )


def treasury_range(market: DataFrame) -> DataFrame:
    """First and last treasury observation date, as one row."""
    obs = market.where((F.col("data_type") == "treasury_10y") & F.col("value").isNotNull())
    return obs.agg(
        F.coalesce(F.min("observation_date"), F.lit("2015-01-01")).alias("market_start"),
        F.coalesce(F.max("observation_date"), F.lit("2025-12-31")).alias("market_end"),
    )
