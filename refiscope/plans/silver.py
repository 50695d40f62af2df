"""Raw loans -> clean loans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.dates import parse_date
from ..operators.ordered import exact_median, first_per_key
from ..session import stage


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, empty text or zero."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return c.isNull() | (c == "")
    return c.isNull() | (c == 0)


def drop_missing_critical(df: DataFrame) -> DataFrame:
    for name in C.CRITICAL_FIELDS:
        df = df.where(~is_missing(df, name))
    return df


def deduplicate(df: DataFrame, order: list[Column]) -> DataFrame:
    """First row per loan by an explicit order (rows have no input order in Spark)."""
    return first_per_key(df, ["loan_id"], order)


def cast_types(df: DataFrame) -> DataFrame:
    """Numerics to double (bad text -> null), flag to boolean, term and year to int."""
    have = set(df.columns)
    out = {c: F.col(c).try_cast("double") for c in C.NUMERIC_LOAN_FIELDS if c in have}
    for c in ("loan_term_years", "origination_year"):
        if c in have:
            out[c] = F.col(c).try_cast("int")
    if "balloon_flag" in have and not isinstance(df.schema["balloon_flag"].dataType, T.BooleanType):
        out["balloon_flag"] = F.coalesce(F.lower(F.col("balloon_flag").cast("string")).isin("true", "1"), F.lit(False))
    return df.withColumns(out)


def impute_occupancy(df: DataFrame) -> DataFrame:
    """Missing or non-positive occupancy -> median of (metro, type), else of all loans, else 0.85.

    Both medians come from one exact distributed median each; the group medians are
    staged, so their join is a broadcast only while they are small.
    """
    known = df.where("occupancy_pct > 0").select("metro_area", "property_type", "occupancy_pct")
    keys = ["metro_area", "property_type"]
    by_group = stage(
        exact_median(known, "occupancy_pct", keys, "_group_median").select(
            F.col("metro_area").alias("_m"), F.col("property_type").alias("_p"), "_group_median"
        ),
        "occupancy-medians",
    )
    overall = exact_median(known, "occupancy_pct", (), "_all_median")
    missing = F.col("occupancy_pct").isNull() | (F.col("occupancy_pct") <= 0)
    fill = F.coalesce("_group_median", "_all_median", F.lit(C.DEFAULT_OCCUPANCY))
    return (
        df.join(by_group, F.col("metro_area").eqNullSafe(F.col("_m")) & F.col("property_type").eqNullSafe(F.col("_p")), "left")
        .crossJoin(F.broadcast(overall))  # one-row side
        .withColumn("_occupancy_imputed", missing)
        .withColumn("occupancy_pct", F.when(missing, fill).otherwise(F.col("occupancy_pct")))
        .drop("_m", "_p", "_group_median", "_all_median")
    )


def flag_outliers(df: DataFrame) -> DataFrame:
    ltv = F.coalesce(F.col("ltv_at_origination") > 1.0, F.lit(False))
    dscr = F.coalesce(F.col("dscr_at_origination") < 0.5, F.lit(False))
    return df.withColumns({"_ltv_outlier": ltv, "_dscr_outlier": dscr, "_is_outlier": ltv | dscr})


def add_time_to_maturity(df: DataFrame, reference_date: str | None = None) -> DataFrame:
    today = F.lit(reference_date).cast("date") if reference_date else F.current_date()
    days = F.datediff(parse_date("maturity_date"), today)
    return df.withColumns(
        {"months_to_maturity": F.round(days / F.lit(C.DAYS_PER_MONTH), 1), "is_matured": days <= 0}
    )


def clean_loans(
    bronze: DataFrame, order: list[Column], reference_date: str | None = None, processed_at: Column | None = None
) -> DataFrame:
    """Drop, de-duplicate, cast, impute, flag and date the raw loans."""
    stamp = processed_at if processed_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    typed = cast_types(deduplicate(drop_missing_critical(bronze), order))
    typed = stage(typed, "typed-loans")  # read by the medians and by the result
    dated = add_time_to_maturity(flag_outliers(impute_occupancy(typed)), reference_date)
    return dated.withColumn("_silver_processed_at", stamp)
