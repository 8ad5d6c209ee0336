"""Given tables, and tables written once into the cluster's shared folder, so that later stages neither recompute them nor lose them."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from caretrail.session import checkpoint_dir

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Let this session send texts to the Python workers in batches of `BATCH_ROWS` at most.

    A task holds a batch in the executor and in its worker, and a result is computed after its operator has returned, so the
    setting stays. A lower one is kept.
    """
    held = int(spark.conf.get(BATCH_SETTING))
    spark.conf.set(BATCH_SETTING, str(min(held, BATCH_ROWS) if held > 0 else BATCH_ROWS))


def tidy(run: Callable) -> Callable:
    """An Arrow function whose worker gives freed memory back when a task ends, as workers live on between stages."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # not this C library's allocator
            pass

    return tidied


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


class Scratch:
    """A folder of its own below `spark.checkpoint.dir` for the written tables of one operator run."""

    def __init__(self, spark: SparkSession, name: str):
        small_batches(spark)
        self.spark = spark
        self.folder = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame as parquet and read it back: lineage ends here, and lost executors cost nothing written."""
        df.write.mode("error").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Remove a table that no later stage reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
