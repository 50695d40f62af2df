"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that travel to Python at once, where rows are whole texts.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python and come back in small batches: Spark's own (10,000 rows, 64 MB) stand several times over in the memory
    of every task, outside the heap and in its Python worker. The session keeps the setting, as plans run later."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text (null as empty) and k1, k2, which name a row by id and text.

    Rows that are equal in both share the name; results joined on it reach each of them.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"))
    return own.withColumn("k1", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))).withColumn("k2", F.xxhash64("text"))
