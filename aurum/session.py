"""Session helpers: one place for the configs the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "aurum") -> SparkSession:
    """Local session for tests and benchmarks (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Settings for a large cluster (100 TB of sources, ~1000 executors). Shuffle
# partitions are sized for ~200 MB per partition of the largest shuffle
# (the group / star / survivorship aggregations); AQE coalesces small ones and
# splits skewed join partitions; broadcast stays a runtime decision on
# measured sizes (AQE), capped well below executor memory.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply :data:`CLUSTER_CONF` (runtime-settable SQL configs) to a session."""
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is used as is. Only
    when it is unset a local master gets a fresh scratch folder, and any other
    master is an error: executors would not see a folder of the driver's.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="aurum-ckpt-", dir=os.environ.get("AURUM_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables/state."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def written(df: DataFrame) -> DataFrame:
    """A checkpoint of ``df`` that joins by sort merge.

    Its size is estimated from compressed source files, far below its rows: a join under the broadcast threshold by that
    estimate would build tables of more than 100 MB in the driver. Explicit ``broadcast`` of small tables still holds.
    """
    return df.checkpoint().hint("merge")
