"""Session settings the jobs expect."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Runtime SQL settings. Adaptive execution sizes the reduce side, turns joins into broadcasts
# once the real size is known, and splits skewed join partitions even when that costs a shuffle.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


# What one task reads, in bytes: of files, and of a shuffle. A grouping of narrow keys holds some ten times that.
SPLIT_BYTES = {
    "spark.sql.files.maxPartitionBytes": 8 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20,
}
# Bytes of input files for every partition a shuffle starts with; adaptive execution joins what is small.
INPUT_SHARE = 2 << 20
STARTING_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tune(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """A session of its own with the caller's settings and, over them, the runtime settings.

    The number of partitions follows ``input_bytes`` and the share of a task stays, so that its memory does not
    grow with the input. Smaller shares and more partitions of the caller are kept. The caller's session stays as it is.
    """
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **RUNTIME_CONF}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    parsed = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in SPLIT_BYTES.items():
        own.conf.set(key, f"{min(parsed(own.conf.get(key)), most)}b")
    given = int(own.conf.get(STARTING_PARTITIONS, None) or own.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set(STARTING_PARTITIONS, str(max(given, -(-input_bytes // INPUT_SHARE))))
    return own


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("anaquel")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def concurrently(function: Callable, items: Iterable) -> list:
    """``function`` of every item, with the Spark jobs of the items submitted side by side."""
    items = list(items)
    target = inheritable_thread_target(SparkSession.active())(function)
    with ThreadPoolExecutor(max(len(items), 1)) as pool:
        return list(pool.map(target, items))
