"""Session settings shared by the library, the tests and the bench.

The library never builds a session on its own when one is passed in. Settings that results depend on are set on the
session; all others only where they are still unset, so a cluster's own configuration wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the models rely on for correct results: always set, and an error if they cannot be.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
# Settings for plans that hold up at scale (AQE coalescing, skew-join splitting, runtime
# broadcast conversion behind the size threshold); a cluster's own choice wins.
PREFERRED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on, and the others where the session leaves them unset."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    given = spark.sparkContext.getConf()
    for key, value in PREFERRED_CONF.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def shuffle_partitions_for(shuffle_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> int:
    """Initial shuffle partitions so each holds about ``partition_bytes`` of the
    largest shuffle; AQE then coalesces small ones and splits skewed ones."""
    return max(200, -(-shuffle_bytes // partition_bytes))


def configure_for_scale(
    spark: SparkSession,
    largest_shuffle_bytes: int,
    partition_bytes: int = 256 * 1024 * 1024,
    scan_split_bytes: int = 256 * 1024 * 1024,
) -> SparkSession:
    """Size partitions for a large input (e.g. 100 TB on a 1000-executor cluster).

    Scan splits and shuffle partitions target a few hundred MB each, so every task
    fits executor memory without spilling while the task count stays manageable;
    AQE starts from the computed partition count, coalesces toward the advisory
    size and splits partitions above the skew threshold.
    """
    n = shuffle_partitions_for(largest_shuffle_bytes, partition_bytes)
    settings = {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
    }
    configure(spark)
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    """A local session for tests, the bench and the smoke entry point."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (REQUIRED_CONF | PREFERRED_CONF).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    held = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return [status.getPath().getName() for status in held]


def storage_root(spark: SparkSession) -> str:
    """Shared folder for stored tables and lineage cuts.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system named by the
    cluster) and it must be set. Only in local mode with no setting, as in tests, a
    fresh scratch folder is created and registered as the checkpoint dir.
    """
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            # A node-local folder is not visible to other executors and is lost with
            # the node: on a cluster the shared folder must be configured.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. HDFS or an object store)")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root
