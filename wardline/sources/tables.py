"""Reading and writing tables, delimited files, prediction and metric tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wardline.functions.columns import no_nan

SEPARATOR = ";"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, clean: bool = False) -> DataFrame:
    """Parquet scan; ``clean`` turns NaN into null."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return nan_to_null(df) if clean else df


def read_named(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """Catalog table, qualified by a database if one is given."""
    return spark.table(f"{database}.{name}" if database else name)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, separator: str = SEPARATOR) -> DataFrame:
    """Delimited file with a header and an explicit schema; NaN becomes null."""
    df = spark.read.schema(schema).option("sep", separator).option("header", True).option("mode", "FAILFAST").csv(path)
    return nan_to_null(df)


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: no_nan(c) for c in floats}) if floats else df


def write_delimited(df: DataFrame, path: str, separator: str = SEPARATOR, sort: list[str] | None = None) -> None:
    """One header per part file; ``sort`` orders the rows over the files."""
    ordered = df.orderBy(*sort) if sort else df
    ordered.write.mode("overwrite").option("sep", separator).option("header", True).csv(path)


def materialise(df: DataFrame, path: str, partition_by: list[str] | None = None, sort: list[str] | None = None) -> DataFrame:
    """Write a derived table, replacing an earlier one, and return a scan of it.

    Spark refuses to write over a path that ``df`` itself reads, and deletes what it replaces first: for
    tables that others read there is ``publish``.
    """
    out = df.sortWithinPartitions(*sort) if sort else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0) -> DataFrame:
    """Same as a catalog table; buckets on the entity spare later joins and windows a shuffle."""
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


_MADE: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder all executors reach: ``spark.checkpoint.dir`` or the checkpoint folder set later."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    path = f"{folder.rstrip('/')}/wardline-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete the intermediate results made so far; call it when no frame that reads them is needed any more."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in _MADE.pop(spark.sparkContext.applicationId, []):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store an intermediate result as a table in the shared folder and go on from a scan of it.

    ``release`` deletes what was stored.
    """
    return materialise(df, shared_folder(df.sparkSession))


def _files(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def published_versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the published versions of a table, the oldest first; none if nothing was published."""
    system, folder = _files(spark, f"{path}/_published")
    return sorted(f.getPath().getName() for f in system.listStatus(folder)) if system.exists(folder) else []


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write a new version of a derived table and then make it the current one; returns its name.

    The rows go to a folder of their own. The last step creates one empty file with the version's
    name, which every store does at once or not at all. So readers see the whole old version or the whole
    new one, a writer that is lost on the way changes nothing, and ``df`` may read the table it replaces.
    Of two writers at once the one with the higher name counts; both versions stay readable.
    """
    spark = df.sparkSession
    known = published_versions(spark, path)
    version = f"{int(known[-1].split('-')[0]) + 1 if known else 1:010d}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{version}")
    system, marker = _files(spark, f"{path}/_published/{version}")
    system.create(marker, False).close()
    return version


def read_published(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """A version of a published table, pinned: later versions do not change what the frame reads."""
    known = published_versions(spark, path)
    if not known or (version is not None and version not in known):
        raise ValueError(f"{path} has no version {version or ''}".rstrip())
    return spark.read.parquet(f"{path}/{version or known[-1]}")


def drop_versions(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete all but the last ``keep`` published versions and what lost writers left; no one may be reading or writing these."""
    known = published_versions(spark, path)
    for version in known[: max(0, len(known) - keep)]:
        system, marker = _files(spark, f"{path}/_published/{version}")
        system.delete(marker, False)
    kept = {*published_versions(spark, path), "_published"}
    system, folder = _files(spark, path)
    for entry in system.listStatus(folder) if system.exists(folder) else []:
        if entry.getPath().getName() not in kept:
            system.delete(entry.getPath(), True)


def write_predictions(pred: DataFrame, path: str) -> None:
    """Prediction table, one folder per model; other models' folders stay.

    Rebalancing gives files of even size, however unequal the models are.
    """
    (
        pred.hint("rebalance", F.col("model"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model")
        .parquet(path)
    )


def read_predictions(spark: SparkSession, path: str, models: list[str] | None = None) -> DataFrame:
    """Predictions, restricted to some models by partition pruning."""
    df = spark.read.parquet(path)
    return df if models is None else df.filter(F.col("model").isin(models))


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append (run, params, metric, value) rows to a metrics table."""
    metrics.write.mode("append").parquet(path)
