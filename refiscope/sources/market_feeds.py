"""Market observations from landed files and keyed tables, in one tall layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import constant_table

TALL = ["data_type", "observation_date", "value", "frequency", "property_type", "metro", "series_id", "source"]


def tall(df: DataFrame, data_type: str, frequency: str, series_id: str | None = None, source: str = "landed",
         property_type=None, metro=None) -> DataFrame:
    """Tag (observation_date, value) rows with the attributes of their series."""
    lit = lambda x: x if x is not None else F.lit(None).cast("string")
    return df.select(
        F.lit(data_type).alias("data_type"),
        F.col("observation_date").cast("string").alias("observation_date"),
        F.col("value").cast("double").alias("value"),
        F.lit(frequency).alias("frequency"),
        lit(property_type).alias("property_type"),
        lit(metro).alias("metro"),
        F.lit(series_id).cast("string").alias("series_id"),
        F.lit(source).alias("source"),
    )


def read_observations_json(spark: SparkSession, path: str, data_type: str, frequency: str, series_id: str) -> DataFrame:
    """Landed payloads ``{"observations": [{"date", "value"}]}``; one payload per line or file.

    A value of ``"."`` or other text that is not a number is dropped.
    """
    schema = "observations array<struct<date:string,value:string>>"
    raw = spark.read.schema(schema).json(path)
    obs = raw.select(F.explode("observations").alias("o")).select(
        F.col("o.date").alias("observation_date"), F.col("o.value").try_cast("double").alias("value")
    )
    return tall(obs.where(F.col("value").isNotNull() & F.col("observation_date").isNotNull()),
                data_type, frequency, series_id, "fred_api")


def monthly_series(seed: DataFrame, data_type: str, series_id: str) -> DataFrame:
    """Keyed ``(month 'YYYY-MM', value)`` rows as observations dated the first of the month."""
    dated = seed.select(F.concat(F.col("month"), F.lit("-01")).alias("observation_date"), F.col("value"))
    return tall(dated, data_type, "monthly", series_id, "keyed_table")


def wide_cap_rates(wide: DataFrame, id_column: str = "property_type") -> DataFrame:
    """One row per type with a column per quarter -> one row per (type, quarter)."""
    quarters = [c for c in wide.columns if c != id_column]
    long = wide.unpivot([id_column], quarters, "observation_date", "value").where("value is not null")
    return tall(long, "cap_rate", "quarterly", None, "wide_table",
                property_type=F.col(id_column), metro=F.lit("National"))


def metro_adjustments(spark: SparkSession) -> DataFrame:
    return constant_table(spark, [(m, float(a)) for m, a, _ in C.METROS], "metro string, adjustment_bps double")


def metro_cap_rates(national: DataFrame, adjustments: DataFrame) -> DataFrame:
    """National observations x metros, shifted by each metro's bps.

    ``adjustments`` is a dimension with one row per metro; Catalyst sizes it and
    broadcasts it inside the cross product when it is small.
    """
    adj = adjustments.select(F.col("metro").alias("_metro"), "adjustment_bps")
    return (
        national.drop("metro")
        .crossJoin(adj)
        .withColumn("value", F.round(F.col("value") + F.col("adjustment_bps") / 100.0, 2))
        .withColumnRenamed("_metro", "metro")
        .select(*national.columns)
    )


def compounded_index(growth: DataFrame, base: float = 100.0) -> DataFrame:
    """Quarterly index from ``(quarter, annual_growth)``: product of ``1 + g/4`` times ``base``.

    One row per quarter, so the ordered window is bounded by the calendar.
    """
    w = Window.partitionBy(F.lit("index")).orderBy("quarter").rowsBetween(Window.unboundedPreceding, 0)
    level = F.lit(base) * F.exp(F.sum(F.log1p(F.col("annual_growth") / 4.0)).over(w))
    return tall(growth.select(F.col("quarter").alias("observation_date"), F.round(level, 2).alias("value")),
                "cre_price_index", "quarterly", "CRE_INDEX", "index")


def assemble(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
