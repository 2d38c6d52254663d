"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that keep hot keys from pinning one task; none of them depends on cluster size.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join is split even when a later aggregate then needs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # small tasks: what one sorts or hashes fits its memory also where rows grow several times when they are read
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.session.timeZone": "UTC",
}


def adapt(spark: SparkSession) -> SparkSession:
    for key, value in ADAPTIVE.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "sourcetrail", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for intermediate tables.  A local run may go without: it gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        folder = "file://" + tempfile.mkdtemp(prefix="sourcetrail-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def run_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once, read many: cuts lineage at a table that outlives any executor."""
    path = run_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SPREAD_BYTES = 256 << 20
DEALT_BYTES = 2 << 20


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for work that is heavy per row when the input is one small file, which a scan cannot split.

    Only inputs of a known small size are exchanged; anything larger is left to the scan's own splits."""
    if df.isStreaming:
        return df
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SPREAD_BYTES else df


def dealt(df: DataFrame) -> DataFrame:
    """Deal out small rows that are heavy work each: a task gets the rows of DEALT_BYTES of input at most.

    The splits of a scan are bounded by bytes of whole row groups, which hold up to millions of such rows."""
    if df.isStreaming:
        return df
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * max(1, -(-size // (DEALT_BYTES * cores))))  # whole rounds of tasks


def dealt_parts(df: DataFrame, batches: int) -> int:
    """How many files each of ``batches`` equal batches takes, so that a file holds the rows of DEALT_BYTES at most."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, -(-size // (DEALT_BYTES * batches)))
