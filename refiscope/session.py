"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Wide expression blocks generate methods the JVM refuses to compile (more than 8000 bytes
# of bytecode run interpreted); past the limit Spark uses its split-up projections instead.
_RUNTIME_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}

_SESSION_SETTINGS = {
    **_RUNTIME_SETTINGS,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", app: str = "refiscope", **extra: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **_SESSION_SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans rely on to a session made elsewhere."""
    for key, value in _RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="refiscope-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the files.

    This cuts lineage in a way that survives the loss of executors, and the file
    sizes become table statistics: Catalyst then broadcasts the staged side only
    while it is below ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a
    sort-merge join above it, without a hint.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    return staged


def release(*staged: DataFrame) -> None:
    """Delete the files of staged tables that no later plan reads: everything derived from them
    must be staged itself by now."""
    for df in staged:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def constant_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few constant rows as inline ``VALUES``: Catalyst knows their exact size, so a
    join with them is broadcast without a hint. The values are parameters, not text, so
    quotes, backslashes, infinities and NaN arrive as they are."""
    columns = [c.strip().split(" ") for c in ddl.split(",")]
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in columns)
    names = ", ".join(n for n, _ in columns)
    if not rows:
        return spark.sql(f"SELECT {casts} FROM VALUES ({', '.join(['NULL'] * len(columns))}) AS t({names}) WHERE false")
    values = ", ".join("(" + ", ".join(f"CAST(:v{i}_{j} AS {t})" for j, (_, t) in enumerate(columns)) + ")" for i in range(len(rows)))
    given = {f"v{i}_{j}": v for i, r in enumerate(rows) for j, v in enumerate(r)}
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})", args=given)
