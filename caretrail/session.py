"""Session settings the jobs rely on, and the folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of code. Stages that wide run faster with split projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Of wide rows it compiles the one large method again and again, as values come that it has not met; many small ones it compiles once.
    "spark.sql.codegen.maxFields": "40",
}


def local_session(cpus: int | str = 8, app: str = "caretrail", **extra: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compiled(spark: SparkSession) -> None:
    """Set the session so that the code of wide rows comes in methods the JVM can compile, also where the session was not made here."""
    for name in ("spark.sql.codegen.hugeMethodLimit", "spark.sql.codegen.maxFields"):
        spark.conf.set(name, SETTINGS[name])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; a local one only where none is set."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="caretrail-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a frame in the checkpoint folder so that later stages survive lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
