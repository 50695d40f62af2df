"""Market observations -> standard rate table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import normalize_date

MONTHLY_FILLED = ("treasury_10y", "treasury_5y")


def _project(df: DataFrame, data_type: Column, date: Column, value: Column, frequency: str,
             property_type: Column | None = None, metro: Column | None = None, index: bool = False) -> DataFrame:
    null = F.lit(None).cast("string")
    return df.select(
        data_type.alias("data_type"),
        date.alias("observation_date"),
        F.round(value, 2 if index else 4).alias("value"),
        F.round(value / 100.0, 4 if index else 6).alias("value_decimal"),
        F.lit(frequency).alias("frequency"),
        (property_type if property_type is not None else null).alias("property_type"),
        (metro if metro is not None else null).alias("metro"),
    )


def month_end_values(bronze: DataFrame) -> DataFrame:
    """Last observation of each month per series: (data_type, month_key, value, last_date)."""
    dated = bronze.select("data_type", normalize_date("observation_date").alias("d"), F.col("value").cast("double").alias("value"))
    key = F.substring("d", 1, 4).try_cast("int") * 12 + F.substring("d", 6, 2).try_cast("int") - 1
    return (
        dated.where("d is not null and value is not null")
        .withColumn("month_key", key)
        .where("month_key is not null")
        .groupBy("data_type", "month_key")
        .agg(F.max_by("value", "d").alias("value"), F.max("d").alias("last_date"), F.count(F.lit(1)).alias("n_obs"))
    )


def fill_months(monthly: DataFrame) -> DataFrame:
    """Gap-free months with linear interpolation between the neighbouring known months.

    ``monthly`` holds one row per (series, month), so each window is bounded by the calendar.
    """
    span = monthly.groupBy("data_type").agg(
        F.min("month_key").alias("lo"), F.max("month_key").alias("hi"), F.sum("n_obs").alias("n")
    )
    months = span.select("data_type", "n", F.explode(F.sequence("lo", "hi")).alias("month_key"))
    by_series = Window.partitionBy("data_type").orderBy("month_key")
    known = F.when(F.col("value").isNotNull(), F.struct("month_key", "value"))
    spread = months.join(monthly.drop("n_obs"), ["data_type", "month_key"], "left").withColumns(
        {
            "prev": F.last(known, ignorenulls=True).over(by_series.rowsBetween(Window.unboundedPreceding, 0)),
            "next": F.first(known, ignorenulls=True).over(by_series.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    share = (F.col("month_key") - F.col("prev.month_key")) / (F.col("next.month_key") - F.col("prev.month_key"))
    lerp = F.col("prev.value") + share * (F.col("next.value") - F.col("prev.value"))
    year, month = F.floor(F.col("month_key") / 12), F.col("month_key") % 12 + 1
    first_day = F.format_string("%04d-%02d-01", year.cast("int"), month.cast("int"))
    return spread.select(
        "data_type",
        F.when(F.col("n") < 2, F.col("last_date")).otherwise(first_day).alias("observation_date"),
        F.coalesce("value", lerp).alias("value"),
    )


def treasury_rates(bronze: DataFrame) -> DataFrame:
    filled = fill_months(month_end_values(bronze.where(F.col("data_type").isin(*MONTHLY_FILLED))))
    return _project(filled, F.col("data_type"), F.col("observation_date"), F.col("value"), "monthly")


def sofr_rates(bronze: DataFrame) -> DataFrame:
    rows = bronze.where("data_type = 'sofr' and value is not null").withColumn("d", normalize_date("observation_date"))
    return _project(rows.where("d is not null"), F.lit("sofr"), F.col("d"), F.col("value").cast("double"), "monthly")


def trailing_mean(df: DataFrame, keys: list[str], order: str, value: str, window: int = 3) -> DataFrame:
    """Trailing mean over ``window`` rows; a series of at most ``window`` rows stays as it is.

    A series has one row per quarter and is bounded by the calendar.
    """
    series = Window.partitionBy(*keys)
    recent = series.orderBy(order).rowsBetween(-(window - 1), 0)
    smooth = F.when(F.count(F.lit(1)).over(series) > window, F.avg(value).over(recent)).otherwise(F.col(value))
    return df.withColumn(value, smooth)


def cap_rates(bronze: DataFrame) -> DataFrame:
    rows = bronze.where("data_type = 'cap_rate' and value is not null").select(
        F.coalesce(F.nullif("property_type", F.lit("")), F.lit("unknown")).alias("property_type"),
        F.coalesce(F.nullif("metro", F.lit("")), F.lit("National")).alias("metro"),
        "observation_date",
        F.col("value").cast("double").alias("value"),
    )
    smooth = trailing_mean(rows, ["property_type", "metro"], "observation_date", "value")
    return _project(smooth, F.lit("cap_rate"), F.col("observation_date"), F.col("value"), "quarterly",
                    F.col("property_type"), F.col("metro"))


def price_index(bronze: DataFrame) -> DataFrame:
    rows = bronze.where("data_type = 'cre_price_index' and value is not null")
    return _project(rows, F.lit("cre_price_index"), F.col("observation_date"), F.col("value").cast("double"),
                    "quarterly", index=True)


def standardize(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """All series in the standard seven columns plus a processing timestamp."""
    out = treasury_rates(bronze)
    for part in (sofr_rates, cap_rates, price_index):
        out = out.unionByName(part(bronze))
    stamp = processed_at if processed_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return out.withColumn("_silver_processed_at", stamp)
