"""Sharding: sampled splitters, quantile boundaries and range partitions, with overfull ranges subdivided.

Law `bytes`: the shards' sizes are near equal. Rows are ordered by key (crc32 of the text, then doc_id, then a row number), so
equal texts lie side by side. A size-weighted sample of keys gives splitters for many small ranges; a range that turns
out overfull is subdivided by splitters of its own until none is. Within a range, rows are numbered and their sizes
summed; ranges are put end to end by their totals. A row belongs to the shard in which the middle of its bytes falls, so a
shard is off its share by less than one row at either end, whatever the sample was: the sample only decides how the work is dealt,
never where a row goes. A large group of equal texts spans shards if it must.

Defined cases: a null text has no bytes and crc32 0; a row's size is at least 16, so an empty table is the only one without
a size, and it gives no rows. Null ids come first among equal texts. Repeated rows are placed one after another.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from caretrail.llm.stored import Scratch

LAW = "bytes"


def keyed(df: DataFrame, text: str, doc_id: str) -> DataFrame:
    """One narrow row per document: key, size and a row number; the texts stay where they are."""
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    return df.select(
        F.col(doc_id).alias("doc_id"),
        (F.length(raw) + 16).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )


Splitter = tuple[int, int, int]


def lookup(splitters: list[Splitter]):
    """Range of a key: how many splitters are not above it."""

    def ranges(batches):
        for batch in batches:
            keys = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("text_crc32", "id_key", "row")), strict=True)
            found = pa.array([bisect_right(splitters, k) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "part"])

    return ranges


def split_sample(keys: DataFrame, every: float) -> list[tuple[Splitter, int]]:
    """Keys drawn with a chance in proportion to size: one per `every` bytes on average, the larger rows for sure."""
    drawn = (F.xxhash64("row", "text_crc32").bitwiseAND(0xFFFFFF) / float(1 << 24)) < F.col("size") / F.lit(every)
    rows = keys.where(drawn).select("text_crc32", "id_key", "row", "size").collect()
    return sorted(((r[0], r[1], r[2]), max(r[3], int(every))) for r in rows)


def quantiles(sample: list[tuple[Splitter, int]], parts: int) -> list[Splitter]:
    """Boundaries that cut the sample's weight into equal parts."""
    total, done, cuts = sum(w for _, w in sample), 0, []
    for key, weight in sample:
        if done * parts >= total * (len(cuts) + 1) and (not cuts or key > cuts[-1]):
            cuts.append(key)
        done += weight
    return cuts[: parts - 1]


def shard(
    df: DataFrame,
    shards: int = 40,
    text: str = "text",
    doc_id: str = "doc_id",
    range_bytes: int = 256 << 20,
    least_ranges: int = 64,
    samples_per_range: int = 16,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null: the law is `bytes`) of every row.

    To the driver come the sample, `samples_per_range` keys a range of `range_bytes`, and one total per range: at 100 TB
    400,000 ranges and 6,400,000 keys, for which `range_bytes` can be raised.
    """
    scratch = Scratch(df.sparkSession, "shards")
    keys = scratch.store(keyed(df, text, doc_id), "keys").withColumn("id_key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    total, rows = keys.agg(F.sum("size"), F.count("*")).first()
    parts = max(least_ranges, -(-(total or 0) // range_bytes))
    share = max(1, (total or 0) // parts)
    splitters = quantiles(split_sample(keys, share / samples_per_range), parts)
    fields = StructType([*keys.schema.fields, StructField("part", IntegerType())])
    while True:
        ranged = keys.mapInArrow(lookup(splitters), fields)
        sums = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
        overfull = {r["part"]: r["bytes"] for r in sums if r["rows"] > 1 and r["bytes"] > 3 * share}
        if not overfull:
            break
        # Overfull ranges get splitters of their own, drawn from their rows alone and more closely.
        inside = ranged.where(F.col("part").isin(list(overfull)))
        extra = split_sample(inside.drop("part"), share / samples_per_range / 8)
        more = set(splitters)
        for part, size in overfull.items():
            own = [s for s in extra if bisect_right(splitters, s[0]) == part]
            more.update(quantiles(own, -(-2 * size // share)))
        if len(more) == len(splitters):
            break
        splitters = sorted(more)
    by_part = {r["part"]: r for r in sums}
    offsets, seen_bytes, seen_rows = [], 0, 0
    for part in sorted(by_part):
        offsets.append((part, seen_bytes, seen_rows))
        seen_bytes, seen_rows = seen_bytes + by_part[part]["bytes"], seen_rows + by_part[part]["rows"]
    spark = df.sparkSession
    starts = spark.createDataFrame(offsets, "part int, bytes_before long, rows_before long")
    order = Window.partitionBy("part").orderBy("text_crc32", "id_key", "row")
    placed = (
        ranged.withColumn("n", F.row_number().over(order))
        .withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .join(F.broadcast(starts), "part")  # one row per range
        .withColumn("middle", F.col("bytes_before") + F.col("end") - F.ceil(F.col("size") / 2))
        .withColumn("shard", F.least(F.expr(f"int(middle * {shards} div {max(1, total or 1)})"), F.lit(shards - 1)))
        .withColumn("rank", F.col("rows_before") + F.col("n") - 1)
    )
    placed = scratch.store(placed.select("doc_id", "size", "text_crc32", "shard", "rank"), "placed")
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


