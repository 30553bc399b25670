"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings. AQE picks broadcast joins from measured sizes, coalesces small shuffle
# partitions and splits skewed join partitions, also when that costs one more shuffle downstream.
# Samples of thousands of rows per group are cut before the shuffle too.
# Streaming state lies on disk with a fixed amount of memory for all partitions of an executor, not in the heap.
# Joins may use a side that is already dealt by some of their keys, so rows dealt by trip stay where they are.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("punctualis")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
