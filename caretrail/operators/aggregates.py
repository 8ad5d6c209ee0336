"""Indicator aggregates.

Distinct counts of persons are never expanded per indicator: flags are first reduced to one row per (group, person)
with a map-side combine, then summed. For totals that small result, not the rows, is spread over the rollup levels and
reduced per person again, so a person seen in two groups counts once in their total.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def indicator_counts(
    df: DataFrame, indicators: Mapping[str, Column], by: list[str], person: str = "person_id", rollup: bool = False
) -> DataFrame:
    """Distinct persons per indicator and group; with `rollup` also the totals, marked by null group columns."""
    flags = [F.max(F.when(test, 1).otherwise(0)).alias(name) for name, test in indicators.items()]
    sums = [F.sum(name).alias(name) for name in indicators]
    per_person = df.groupBy(*by, person).agg(*flags)
    if not rollup:
        return per_person.groupBy(*by).agg(*sums)
    types = dict(df.dtypes)
    levels = []
    for kept in range(len(by), -1, -1):
        keys = [F.col(k) if i < kept else F.lit(None).cast(types[k]) for i, k in enumerate(by)]
        levels.append(F.struct(F.lit(kept).alias("__level"), *[k.alias(n) for k, n in zip(keys, by)]))
    spread = per_person.select(F.explode(F.array(*levels)).alias("__k"), person, *indicators).select("__k.*", person, *indicators)
    again = spread.groupBy("__level", *by, person).agg(*[F.max(n).alias(n) for n in indicators])
    return again.groupBy("__level", *by).agg(*sums).drop("__level")


def conditional_counts(df: DataFrame, tests: Mapping[str, Column], by: list[str]) -> DataFrame:
    """Rows per group that meet each condition."""
    return df.groupBy(*by).agg(*[F.count(F.when(t, 1)).alias(n) for n, t in tests.items()])


def ratio(part: Column, whole: Column, digits: int = 4, scale: float = 1.0) -> Column:
    """Null where the whole is zero."""
    return F.round(part * F.lit(scale) / F.nullif(whole, F.lit(0)), digits)


def latest_per(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of every key by a total order: an aggregate with a map-side combine, not a sort of the group."""
    return _pick_per(df, key, order, F.max_by)


def earliest_per(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return _pick_per(df, key, order, F.min_by)


def _pick_per(df: DataFrame, key: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    row = pick(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("__row")
    return df.groupBy(*key).agg(row).select(*key, "__row.*").select(*df.columns)


def distinct_text(value: Column, separator: str = ", ") -> Column:
    """Aggregate: the distinct values of a group, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(value)), separator)


def bucket_counts(df: DataFrame, value: Column, buckets: Mapping[str, tuple[int, int]], by: list[str]) -> DataFrame:
    """Rows per group whose value lies in each closed interval; intervals may overlap."""
    return conditional_counts(df, {n: value.between(lo, hi) for n, (lo, hi) in buckets.items()}, by)


def crosstab(df: DataFrame, rows: list[str], column: str, values: list) -> DataFrame:
    """Counts of a column's given values, side by side."""
    return df.groupBy(*rows).agg(*[F.count(F.when(F.col(column) == v, 1)).alias(f"n_{v}") for v in values])


def running_total(df: DataFrame, value: str, by: list[str], order: list[str], name: str) -> DataFrame:
    """Cumulative sum of already aggregated rows, restarted per group."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(value).over(window))


def preferred_identifier(ids: DataFrame, person: str, kinds: list[tuple[str, list[int]]]) -> DataFrame:
    """Least identifier per kind of a person, and the first kind that has one."""
    out = ids.groupBy(person).agg(
        *[F.min(F.when(F.col("identifier_type").isin(types), F.col("identifier"))).alias(name) for name, types in kinds]
    )
    return out.withColumn("identifier", F.coalesce(*[F.col(name) for name, _ in kinds]))
