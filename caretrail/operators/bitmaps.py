"""Distinct persons as bitmaps, which can be stored and put together over sites, months and runs without counting anybody twice.

A bitmap holds the persons of one bucket of ids (Spark's bitmap functions: 32,768 ids, 4 KB) that meet an indicator in a group. A total is the
union of its groups' bitmaps, bucket by bucket, so a new month adds its own bitmaps and no old row is read again. Exact, whatever the order.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "bucket"
AT_ONCE = 60  # indicators held as bits of one number


def person_bitmaps(df: DataFrame, indicators: Mapping[str, Column], by: Sequence[str], person: str = "person_id") -> DataFrame:
    """(by, bucket, a bitmap for each indicator, null where nobody meets it)."""
    return bitmaps_of(person_marks(df, indicators, by, person), indicators, by)


def person_marks(df: DataFrame, indicators: Mapping[str, Column], by: Sequence[str], person: str = "person_id") -> DataFrame:
    """One narrow row per group and person: its place in the bitmaps, and the indicators it meets as bits.

    Rows are reduced to one per group and person, by a hash aggregate of a few numbers.
    """
    words = _words(indicators)
    met = [
        F.bit_or(sum((F.when(indicators[n], F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, n in enumerate(word)), F.lit(0).cast("long"))).alias(f"__w{w}")
        for w, word in enumerate(words)
    ]
    one = df.filter(F.col(person).isNotNull()).groupBy(*by, person).agg(*met)
    return one.withColumn(BUCKET, F.bitmap_bucket_number(person)).withColumn("__at", F.bitmap_bit_position(person)).drop(person)


def _words(indicators: Iterable[str]) -> list[list[str]]:
    names = list(indicators)
    return [names[i : i + AT_ONCE] for i in range(0, len(names), AT_ONCE)]


def bitmaps_of(marks: DataFrame, indicators: Iterable[str], by: Sequence[str]) -> DataFrame:
    """The bitmaps of persons' marks. The narrow marks go to their bitmap: one begun in every task would be written at 4 KB, however few persons of a bucket the task has."""
    names, maps = list(indicators), []
    one = marks.repartition(*by, BUCKET)
    for w, word in enumerate(_words(indicators)):
        for i, name in enumerate(word):
            maps.append(F.bitmap_construct_agg(F.when(F.col(f"__w{w}").bitwiseAND(F.lit(1 << i)) != 0, F.col("__at"))).alias(name))
    out = one.groupBy(*by, BUCKET).agg(*maps)
    return out.select(*by, BUCKET, *[F.when(F.bitmap_count(n) > 0, F.col(n)).alias(n) for n in names])


def bitmap_counts(bitmaps: DataFrame, indicators: Iterable[str], by: Sequence[str], rollup: bool = False) -> DataFrame:
    """Distinct persons per indicator and group, over all that the bitmaps are split by besides; with `rollup` also the totals, marked by null group columns."""
    names, by = list(indicators), list(by)
    level = []
    if rollup:
        if set(bitmaps.columns) - {*by, BUCKET, *names}:  # one bitmap a group before it is spread over the levels
            bitmaps = bitmaps.groupBy(*by, BUCKET).agg(*[F.bitmap_or_agg(n).alias(n) for n in names])
        kinds = dict(bitmaps.dtypes)
        kept = [F.struct(F.lit(k).alias("__level"), *[(F.col(n) if i < k else F.lit(None).cast(kinds[n])).alias(n) for i, n in enumerate(by)]) for k in range(len(by), -1, -1)]
        bitmaps, level = bitmaps.select(F.inline(F.array(*kept)), BUCKET, *names), ["__level"]
    union = bitmaps.groupBy(*level, *by, BUCKET).agg(*[F.bitmap_or_agg(n).alias(n) for n in names])
    counts = union.groupBy(*level, *by).agg(*[F.sum(F.bitmap_count(n)).alias(n) for n in names])
    return counts.select(*by, *[F.coalesce(n, F.lit(0)).alias(n) for n in names])
