"""Comparing builds and checking outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def build_totals(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Row count and column sums of two builds side by side."""

    def totals(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in columns]).select(
            F.lit(name).alias("build"), "*"
        )

    return totals(a, "a").unionByName(totals(b, "b"))


def differences(a: DataFrame, b: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Keys missing on one side, and keys whose values differ (null equals null)."""
    left = a.select(*key, F.struct(*columns).alias("__a"), F.lit(1).alias("in_a"))
    right = b.select(*key, F.struct(*columns).alias("__b"), F.lit(1).alias("in_b"))
    both = left.join(right, key, "full_outer")
    kind = (
        F.when(F.col("in_b").isNull(), "only in a")
        .when(F.col("in_a").isNull(), "only in b")
        .when(~F.col("__a").eqNullSafe(F.col("__b")), "differs")
    )
    return both.select(*key, kind.alias("difference")).filter(F.col("difference").isNotNull())


def differing_columns(a: DataFrame, b: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """How many keys differ in each column."""
    left = a.select(*key, *[F.col(c).alias(f"a_{c}") for c in columns])
    right = b.select(*key, *[F.col(c).alias(f"b_{c}") for c in columns])
    both = left.join(right, key, "inner")
    counts = both.agg(
        *[F.count(F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), 1)).alias(c) for c in columns]
    )
    return counts.unpivot([], columns, "column_name", "differing")


def repeated(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row; empty for a frame with a primary key."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def both_ways(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Members of two lists that are in only one of them."""
    only_a = a.select(key).distinct().join(b.select(key), key, "left_anti").withColumn("side", F.lit("a"))
    only_b = b.select(key).distinct().join(a.select(key), key, "left_anti").withColumn("side", F.lit("b"))
    return only_a.unionByName(only_b)
