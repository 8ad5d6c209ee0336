"""Joins of records, with broadcasts left to sizes Spark has measured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.operators.timeline import by_timeline, next_where


def restrict(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in the set."""
    return df.join(keys.select(*on), on, "left_semi")


def exclude(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in the set; null keys stay, unlike with NOT IN."""
    return df.join(keys.select(*on), on, "left_anti")


def without_test_patients(df: DataFrame, persons: DataFrame) -> DataFrame:
    return exclude(df, persons.filter("is_test = 1 OR voided = 1"), ["person_id"])


def with_attributes(df: DataFrame, attributes: DataFrame, kinds: dict[str, int]) -> DataFrame:
    """Add one column per attribute type. The attributes are pivoted once, whatever the number of kinds."""
    wide = (
        attributes.filter(F.col("attribute_type_id").isin(list(kinds.values())))
        .groupBy("person_id")
        .agg(*[F.max(F.when(F.col("attribute_type_id") == t, F.col("value"))).alias(n) for n, t in kinds.items()])
    )
    return df.join(wide, "person_id", "left")


def with_event_dates(df: DataFrame, events: DataFrame, kinds: dict[str, Column], when: str, key: str = "person_id") -> DataFrame:
    """Add the latest date of each kind of event: one pass over the events for all kinds."""
    wide = events.groupBy(key).agg(*[F.max(F.when(test, F.col(when))).alias(n) for n, test in kinds.items()])
    return df.join(wide, key, "left")


def first_after(df: DataFrame, events: DataFrame, key: str, at: str, when: str, name: str, hot: Sequence = ()) -> DataFrame:
    """Nearest event strictly after each row's time, by one merged timeline instead of a range join."""
    rows = df.withColumn("__event", F.lit(0)).withColumn("__at", F.to_date(F.col(at)))
    types = dict(rows.dtypes)
    marks = events.select(
        *[
            F.col(key) if c == key else F.lit(1).alias("__event") if c == "__event" else F.to_date(F.col(when)).alias("__at")
            if c == "__at" else F.lit(None).cast(types[c]).alias(c)
            for c in rows.columns
        ]
    )
    # An event of the same day sorts before the row, so it is not "after" it.
    both = rows.unionByName(marks).withColumn("__first", 1 - F.col("__event"))
    look = next_where(F.col("__event") == 1, F.col("__at"))
    seen = by_timeline(both, lambda part, line: line.scan(part, **{name: look}), hot, (key,), ("__at", "__first"))
    return seen.filter("__event = 0").drop("__event", "__at", "__first")


def mothers(children: DataFrame, relationship: DataFrame, person: DataFrame, kind: int = 2) -> DataFrame:
    """Each child with its mother: the least related woman where there are several."""
    women = person.filter("gender = 'F'").select(F.col("person_id").alias("person_a"))
    pairs = (
        relationship.filter(F.col("relationship") == kind)
        .join(women, "person_a", "left_semi")
        .groupBy(F.col("person_b").alias("person_id"))
        .agg(F.min("person_a").alias("mother_id"))
    )
    return children.join(pairs, "person_id", "left")


def overlay(frames: list[DataFrame], on: list[str]) -> DataFrame:
    """Merge by key in which a later frame's value overlays an earlier one where it has the key.

    The frames are stacked and reduced once per key, so nineteen sources cost one shuffle rather than eighteen joins.
    """
    columns = list(dict.fromkeys(c for f in frames for c in f.columns if c not in on))
    stacked = None
    for i, frame in enumerate(frames):
        part = frame.withColumn("__rank", F.lit(i)).withColumn("__has", F.array(*[F.lit(c) for c in frame.columns]))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    picked = [F.max_by(F.col(c), F.when(F.array_contains("__has", c), F.col("__rank"))).alias(c) for c in columns]
    return stacked.groupBy(*on).agg(*picked)


def merge_flags(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Full merge of two keyed frames with flags of the side each key was in."""
    left = a.withColumn("in_a", F.lit(1))
    right = b.withColumn("in_b", F.lit(1))
    return left.join(right, on, "full_outer").fillna(0, ["in_a", "in_b"])
