"""Keeping datasets current from streams of source events.

A micro-batch only says which persons changed. The persons are recomputed from the stored sources, so a late, repeated
or corrected event needs no state of its own, however late it is, and a batch that is retried writes the same result.
All deliveries are stored, and the last one of an event counts: there is no watermark.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from caretrail.session import cut_lineage
from caretrail.sources.datasets import Datasets

EVENT_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, path: str, schema: str = EVENT_SCHEMA, files_per_batch: int = 100) -> DataFrame:
    """Parquet files as they arrive; on a cluster any other source with the same columns."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def lab_events(stream: DataFrame) -> DataFrame:
    """Laboratory events of a stream, late and repeated ones among them."""
    concept = (
        F.when(F.col("event_type") == "purchase", 856)
        .when(F.col("event_type") == "view", 5497)
        .when(F.col("event_type") == "click", 730)
        .when(F.col("event_type") == "signup", 1030)
        .otherwise(9239)
    )
    return stream.select(
        F.col("event_id").alias("obs_id"),
        F.col("user_id").alias("person_id"),
        F.col("ts").alias("obs_datetime"),
        F.to_date(F.convert_timezone(None, F.lit("UTC"), F.col("ts").cast("timestamp_ntz"))).alias("obs_date"),
        concept.alias("concept_id"),
        F.col("value").alias("value_numeric"),
    )


def windowed_counts(events: DataFrame, width: str = "1 day") -> DataFrame:
    """Events per concept and window of event time."""
    return events.groupBy(F.window("obs_datetime", width), "concept_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value_numeric").alias("total")
    )


def land(events: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Store every delivery of a stream; without an interval it drains what is there and ends.

    A batch is a folder of its own, which a repeated batch writes again, and reads nothing that is stored. `landed` says which delivery of
    an event counts. A folder belongs to one checkpoint, which numbers its batches.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _start(events.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint), every)


def landed(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    """Each event once: its last delivery, so a repeat changes nothing and a correction counts, on whatever day it says."""
    rows = spark.read.parquet(path)
    if keys is not None:  # all deliveries of the events that came with one of these persons at some time
        ids = rows.join(keys.select("person_id"), "person_id", "left_semi").select("obs_id").distinct()
        rows = rows.join(ids, "obs_id", "left_semi")
    own = [c for c in rows.columns if c not in ("obs_id", "batch")]
    last = rows.groupBy("obs_id").agg(F.max_by(F.struct(*own), F.struct("batch", *own)).alias("row")).select("obs_id", "row.*")
    return last if keys is None else last.join(keys.select("person_id"), "person_id", "left_semi")


def persons_named(spark: SparkSession, path: str, batch: DataFrame) -> DataFrame:
    """Persons of a landed batch, and those that earlier deliveries of its events named: a correction may move an event to another person."""
    earlier = spark.read.parquet(path).join(batch.select("obs_id").distinct(), "obs_id", "left_semi")
    return batch.select("person_id").unionByName(earlier.select("person_id")).distinct()


def take_batch(store: Datasets, name: str, keys: DataFrame, run: str, build: Callable[[DataFrame | None], DataFrame], key: Sequence[str] = ("person_id",)) -> int:
    """Rebuild the given keys in a stored dataset, once for each run: a batch that is in the log changes no file."""
    if store.has_run(name, run):
        return 0
    start = time.monotonic()
    fixed = cut_lineage(keys.select(*key).distinct())  # on a first run too, since a batch has to be read to commit its state
    rows = store.replace(name, fixed, build(fixed), key) if store.exists(name) else store.create(name, build(None), key)
    mark = store.mark(name)
    store.log(name, run, mark, mark, time.monotonic() - start, rows)
    return rows


def keep_current(
    events: DataFrame, path: str, store: Datasets, name: str, build: Callable[[DataFrame | None], DataFrame], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Land every micro-batch in `path` and recompute a stored dataset for its persons; `build` reads the events by `landed`."""

    def one_batch(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        spark = batch.sparkSession
        keys = persons_named(spark, path, spark.read.parquet(f"{path}/batch={number}"))
        take_batch(store, name, keys, f"{checkpoint}#{number}", build)

    return _start(events.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint), every)


def _start(writer, every: str | None) -> StreamingQuery:
    """Run every interval (the reference cadence is five minutes), or once over what has arrived."""
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
