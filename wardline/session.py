"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # call sites of every column expression cost a round trip to the JVM each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(
    app: str, cores: str | int = "*", partitions: int = 8, memory: str = "8g", extra: dict[str, str] | None = None
) -> SparkSession:
    """A single-machine session for tests and the benchmark.

    On a cluster the session comes from spark-submit and only ``SETTINGS`` matter.
    """
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in (SETTINGS | (extra or {})).items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", memory))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def own_folder(spark: SparkSession) -> None:
    """Give a single-machine session a folder for intermediate results if it has none; clusters name theirs."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wardline-"))
