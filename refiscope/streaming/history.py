"""Incremental snapshot history from landed loan files."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ordered import first_per_key
from ..plans.features import CurrentMarket, loan_features
from ..plans.gold import distress_history
from ..session import constant_table
from ..sources.tables import overwrite_partitions


def _manifest(target: str) -> str:
    return f"{target.rstrip('/')}_manifest"


MANIFEST = "file string, size bigint, ingest_batch string"


def read_manifest(spark: SparkSession, target: str) -> DataFrame:
    """Landed files whose rows are committed, with the partition that holds them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_manifest(target))
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(MANIFEST).parquet(_manifest(target)) if there else spark.createDataFrame([], MANIFEST)


def read_history(spark: SparkSession, target: str) -> DataFrame:
    """Committed history rows: a partition that no manifest row names is of a run that did not end."""
    committed = read_manifest(spark, target).select("ingest_batch").distinct()
    return spark.read.parquet(target).join(committed, "ingest_batch", "left_semi")


def append_snapshots(
    spark: SparkSession, landed: str, schema: StructType, market: CurrentMarket, target: str, checkpoint: str,
    stamp: str = "snapshot_at", max_files: int = 1000,
) -> None:
    """Process the files landed since the last run and add their history rows to ``target``.

    A manifest beside ``target`` names every file (name and length) whose rows are committed. A
    micro-batch leaves out what the manifest names, writes the rest into the partition named by a digest
    of its files and then commits them to the manifest; so rows are neither lost nor doubled when a
    batch runs again, and also when the checkpoint is lost and every file is offered anew. There is
    no streaming state. The stream carries the names alone: rows that a micro-batch hands over are
    decoded whole for every use, while the files it names are read once, by the columns in use.
    """
    name, size = F.col("_metadata.file_name"), F.col("_metadata.file_size")
    landed_files = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(landed)
    named = landed_files.select(name.alias("file"), size.alias("size"))

    def write(batch: DataFrame, batch_id: int) -> None:
        files = batch.distinct()
        new = files.join(read_manifest(spark, target), ["file", "size"], "left_anti").orderBy("file", "size").collect()  # at most max_files rows
        if not new:
            return
        key = hashlib.sha256("\n".join(f"{r['file']} {r['size']}" for r in new).encode()).hexdigest()[:24]
        ours = constant_table(spark, [(r["file"], r["size"], key) for r in new], MANIFEST)
        offered = spark.read.schema(schema).parquet(landed).where(name.isin([r["file"] for r in new]))  # prunes the files
        keyed = offered.select("*", name.alias("_file"), size.alias("_size"))
        fresh = keyed.join(ours.select(F.col("file").alias("_file"), F.col("size").alias("_size")), ["_file", "_size"], "left_semi").drop("_file", "_size")
        rows = distress_history(loan_features(fresh, market, F.col(stamp)))
        overwrite_partitions(rows.withColumn("ingest_batch", F.lit(key)), target, "ingest_batch")
        ours.coalesce(1).write.mode("append").parquet(_manifest(target))

    query = (
        named.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_state(history: DataFrame, tie_break: list[Column] | None = None) -> DataFrame:
    """Newest history row per loan, as a batch query over the appended table."""
    return first_per_key(history, ["loan_id"], [F.desc("snapshot_at"), *(tie_break or [])])
