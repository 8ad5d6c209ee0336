"""Counts over days from the intervals in which rows are in a state, without a row per row and day.

An interval adds one where it begins and takes one away where it ends. Changes of a group on a day are added up first, map-side too; what is left
is at most one row a group and day, over which a running sum gives the counts. The work grows with the intervals, not with their length.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Span = tuple[Column, Column | None]  # from a day on, and before a day (null or None: for ever)


def _day(value) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else value


def interval_counts(df: DataFrame, by: Sequence[str], states: Mapping[str, Span], first: Column | str, last: Column | str) -> DataFrame:
    """(by, since, until, a count for each state): the days of [first, last] on which the counts of a group stay as they are.

    An interval without a beginning, or one that ends before it begins, counts nowhere. Days on which a group has nobody have no row.
    """
    first, last = _day(first), _day(last)
    changes = []
    for i, (begins, ends) in enumerate(states.values()):
        begin = F.when(begins.isNotNull(), F.greatest(begins, first))
        end = F.lit(None).cast("date") if ends is None else ends
        open_ = begin.isNotNull() & (begin <= last) & (end.isNull() | (end > begin))
        changes.append(F.when(open_, F.struct(begin.alias("since"), F.lit(i).alias("state"), F.lit(1).alias("change"))))
        changes.append(F.when(open_ & (end <= last), F.struct(end.alias("since"), F.lit(i).alias("state"), F.lit(-1).alias("change"))))
    events = df.select(*by, F.inline(F.array_compact(F.array(*changes))))
    net = events.groupBy(*by, "since").agg(*[F.sum(F.when(F.col("state") == i, F.col("change")).otherwise(0)).alias(n) for i, n in enumerate(states)])
    changed = F.lit(False)
    for name in states:
        changed = changed | (F.col(name) != 0)
    walk = Window.partitionBy(*by).orderBy("since")
    so_far = walk.rowsBetween(Window.unboundedPreceding, 0)
    until = F.coalesce(F.date_sub(F.lead("since").over(walk), 1), last)
    counts = net.filter(changed).select(*by, "since", until.alias("until"), *[F.sum(n).over(so_far).alias(n) for n in states])
    return counts.filter(" + ".join(f"`{n}`" for n in states) + " > 0")
