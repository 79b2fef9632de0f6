"""Session settings the operators are written for.

On a cluster the session belongs to the caller; ``RECOMMENDED`` lists what the
plans rely on.  ``local_session`` is for tests and the benchmark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Runtime re-planning: drops empty branches, picks joins by measured size,
    # splits skewed join partitions and merges small shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Times are compared as text or as zone-less timestamps.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(
    cpus: int | str = "*",
    app: str = "clickloom",
    checkpoint_dir: str | None = None,
    memory: str = "12g",
    **extra: str,
) -> SparkSession:
    """A single-JVM session; ``extra`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
