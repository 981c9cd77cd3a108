"""A session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Windows and day boundaries are in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where the next step must shuffle once more because of it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Spark's own default; named here so that it holds again after a query with WIDE_ROWS.
    "spark.sql.codegen.hugeMethodLimit": "65535",
}

# For rows of a hundred worked out columns. The JVM never compiles a method above 8,000 bytes, and one for a
# whole stage of them is longer; above this limit Spark writes a stage's code by operator, in short methods.
WIDE_ROWS = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Taken over by a stream when it starts.
STREAM_SETTINGS = {
    # Sessions of a task's rows are merged before the shuffle, so a busy user sends few rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.numRecentProgressUpdates": "10000",
    # State may outgrow the executors' memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidewell")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def apply_settings(spark: SparkSession, more: dict[str, str] | None = None) -> SparkSession:
    """Set what can be set on a session somebody else started; `more` goes before the settings of all queries."""
    for key, value in {**SETTINGS, **(more or {})}.items():
        spark.conf.set(key, value)
    return spark
