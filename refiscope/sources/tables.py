"""Partitioned tables: readers, writers and explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _D, _I, _B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _schema(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols.items()])


BRONZE_LOAN_SCHEMA = _schema(
    loan_id=_S, deal_name=_S, property_id=_S, origination_date=_S, maturity_date=_S,
    origination_year=_I, original_balance=_D, current_balance=_D, note_rate=_D,
    amortization_type=_S, balloon_flag=_B, loan_term_years=_I, loan_purpose=_S,
    property_type=_S, metro_area=_S, submarket=_S, occupancy_pct=_D, noi_annual=_D,
    property_value_at_origination=_D, ltv_at_origination=_D, dscr_at_origination=_D,
    sponsor_credit_tier=_S, ingested_at=_S, source=_S, source_version=_S,
)

BRONZE_MARKET_SCHEMA = _schema(
    data_type=_S, observation_date=_S, value=_D, frequency=_S, property_type=_S, metro=_S,
    series_id=_S, ingested_at=_S, source=_S, source_version=_S,
)

PORTFOLIO_NUMERICS = [
    "original_balance", "current_balance", "note_rate", "noi_annual", "current_cap_rate",
    "current_ltv", "new_dscr", "refinance_rate", "rate_gap", "rate_gap_bps", "debt_yield",
    "occupancy_pct", "ltv_at_origination", "dscr_at_origination",
]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table; Hive-style partition folders come back as typed columns."""
    return spark.read.parquet(path)


def read_json_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON-lines table with an explicit schema (no inference pass over the data)."""
    return spark.read.schema(schema).json(path)


def read_partition(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """One partition; the predicate prunes folders, other files are not listed for reading."""
    return read_table(spark, path).where(F.col(column) == F.lit(value))


def row_count(spark: SparkSession, path: str) -> DataFrame:
    """Count as a one-row table; Parquet answers it from footers."""
    return read_table(spark, path).agg(F.count(F.lit(1)).alias("row_count"))


def table_schema(spark: SparkSession, path: str) -> DataFrame:
    """Column names and types as a table."""
    rows = [(f.name, f.dataType.simpleString()) for f in read_table(spark, path).schema]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def write_table(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    """Write Parquet. ``mode='overwrite'`` replaces the table, ``'append'`` adds files.

    With a partition column the rows are rebalanced by it first: adaptive execution sizes
    the write tasks, so a small partition becomes few files and a hot partition value is
    split over many tasks.
    """
    writer_df = df.hint("rebalance", partition_by) if partition_by else df
    writer = writer_df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "static")
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: str) -> None:
    """Replace only the partitions present in ``df``; a re-run of one snapshot is idempotent."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header; ``single_file`` is for dimensions and summaries only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").json(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to an explicit schema; missing columns become null, ints widen to double."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def conform_bronze_loans(df: DataFrame) -> DataFrame:
    return conform(df, BRONZE_LOAN_SCHEMA)


def conform_bronze_market(df: DataFrame) -> DataFrame:
    """Explicit market schema; empty property type, metro and series id become null."""
    out = conform(df, BRONZE_MARKET_SCHEMA)
    return out.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in ("property_type", "metro", "series_id")})


def load_portfolio(df: DataFrame) -> DataFrame:
    """Numeric coercion of the portfolio columns that are present; bad text becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in PORTFOLIO_NUMERICS if c in df.columns})
