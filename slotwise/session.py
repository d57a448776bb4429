"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Adaptive execution coalesces small shuffle partitions and splits skewed joins and writes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Stream state on local disk instead of the heap, checkpointed to the shared folder.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Partition count that keeps each shuffle partition near 128 MB; adaptive execution merges the rest.

    A fold of 100 TB that shuffles a tenth of its input asks for about 80,000.
    """
    return max(200, -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES))


def configure(builder: SparkSession.Builder, shuffled_bytes: int | None = None) -> SparkSession.Builder:
    """Settings for a cluster session.  The cluster itself names ``spark.checkpoint.dir``."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    if shuffled_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(shuffled_bytes)))
    return builder


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("slotwise")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
