"""Choosing rows of a group that keep a distance: each is more than `gap` after the one chosen before, the first is chosen.

Whether a row is chosen depends on all before it, but what would be chosen next after a row depends on that row only. So each row points
to its successor, found in one ordered pass, and the chain that starts at the first row is followed by pointer doubling: after round k the
chosen rows are those at fewer than 2 ** k steps, and the pointers reach 2 ** k steps further. Rounds are logarithmic in the longest chain, each
row is joined by group and place, and pointers that leave the group are dropped; so a group with very many rows is spread over the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.operators.timeline import Timeline, next_where
from caretrail.session import cut_lineage


def successors(df: DataFrame, key: Sequence[str], at: str, gap: int, block: Column | None = None) -> DataFrame:
    """(key, at, next): the first place of the group more than `gap` days later; rows without one are left out.

    Every row adds a marker `gap` days later, and one pass over rows and markers looks ahead from the markers to the nearest row. `block` is a
    column over `__at` that divides groups that are too large for one task.
    """
    rows = df.select(*key, F.col(at).alias("__at"), F.lit(0).alias("__marker"), F.col(at).alias("__from"))
    markers = df.select(*key, F.date_add(at, gap).alias("__at"), F.lit(1).alias("__marker"), F.col(at).alias("__from"))
    both = rows.unionByName(markers)
    line = Timeline(tuple(key), ("__at", "__marker", "__from"))
    if block is not None:
        both, line = both.withColumn("__block", block), Timeline(tuple(key), ("__at", "__marker", "__from"), "__block")
    seen = line.scan(both, __next=next_where(F.col("__marker") == 0, F.col("__at")))
    return seen.filter("__marker = 1 AND __next IS NOT NULL").select(*key, F.col("__from").alias(at), F.col("__next").alias("next"))


def spaced(df: DataFrame, key: Sequence[str], at: str, gap: int, most: int | None = None, block: Column | None = None) -> DataFrame:
    """(key, at) of the chosen rows, from distinct (key, at); `most` stops after so many rows of a group.

    With `most` the result also has `nth`, the number of the row among the chosen ones of its group.
    """
    key = list(key)
    df = cut_lineage(df.select(*key, at).distinct())
    pointers = cut_lineage(successors(df, key, at, gap, block))
    first = df.groupBy(*key).agg(F.min(at).alias(at))
    if most:
        return _numbered(first, pointers, key, at, most)
    chosen = cut_lineage(first)
    while not pointers.isEmpty():
        further = chosen.join(pointers, [*key, at]).select(*key, F.col("next").alias(at))
        chosen = cut_lineage(chosen.unionByName(further))
        onward = pointers.select(*key, F.col(at).alias("next"), F.col("next").alias("__next"))
        pointers = cut_lineage(pointers.join(onward, [*key, "next"]).select(*key, at, F.col("__next").alias("next")))
    return chosen


def _numbered(first: DataFrame, pointers: DataFrame, key: list[str], at: str, most: int) -> DataFrame:
    """The first few rows of every chain, one step each: only rows that were chosen are looked up."""
    step = first.withColumn("nth", F.lit(1))
    out = step
    for nth in range(2, most + 1):
        step = step.join(pointers, [*key, at]).select(*key, F.col("next").alias(at), F.lit(nth).alias("nth"))
        out = out.unionByName(step)
    return out
