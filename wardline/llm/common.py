"""Helpers the operators share: stored intermediates, Arrow batches, words."""

from __future__ import annotations

import contextlib
import ctypes
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardline.session import own_folder
from wardline.sources.tables import shared_folder

# Bytes that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_GAPS = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application; not needed where it is installed."""
    if spark.sparkContext.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='wardline-zip-')}/wardline", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(spark.sparkContext.applicationId)


def work_folder(spark: SparkSession) -> str:
    """A new path in the folder all executors reach, ``spark.checkpoint.dir``; a single machine gets one of its own."""
    own_folder(spark)
    return shared_folder(spark)


class Stored:
    """An intermediate table in the shared folder; ``delete`` frees its space once nothing reads it."""

    def __init__(self, df: DataFrame):
        self.spark, self.path = df.sparkSession, work_folder(df.sparkSession)
        self.schema = df.schema
        df.write.option("compression", "zstd").parquet(self.path)

    @property
    def df(self) -> DataFrame:
        """A scan of its own each time, so that the table can be joined with itself."""
        return self.spark.read.schema(self.schema).parquet(self.path)

    def delete(self) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from a scan of it."""
    return Stored(df).df


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def word_array(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAPS), "")


def give_back() -> None:
    """Return freed memory to the system: Python workers live on after a task, next to a JVM that needs it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def rows_of(batches: Iterator[pa.RecordBatch], limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about ``limit`` bytes each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
    give_back()


def utf8(value: str | None) -> bytes:
    return value.encode("utf-8", "surrogatepass") if value else b""


def pick(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Only the named columns, under the given names, so that clashing ones never meet."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(name) for name, c in columns.items()])
