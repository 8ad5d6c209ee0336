"""Calendars, and joins of timelines to calendar periods without a range join.

A row is valid from its own time until the next row of its person. The period ends inside that span are generated
from the row itself, so the work is linear in the output and nothing is shuffled or nested-looped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caretrail.functions.dates import yearweek


def _day(d) -> Column:
    return F.lit(d).cast("date") if isinstance(d, str) else d


def month_ends(start: Column | str, end: Column | str) -> Column:
    """Array of the month ends in [start, end]; empty when there are none."""
    start, end = _day(start), _day(end)
    last = F.when(end == F.last_day(end), F.trunc(end, "month")).otherwise(F.add_months(F.trunc(end, "month"), -1))
    first = F.trunc(start, "month")
    months = F.sequence(first.cast("date"), last.cast("date"), F.expr("interval 1 month"))
    return F.when(last >= first, F.transform(months, F.last_day)).otherwise(F.array().cast("array<date>"))


def days(start: Column | str, end: Column | str) -> Column:
    start, end = _day(start), _day(end)
    return F.when(end >= start, F.sequence(start, end, F.expr("interval 1 day"))).otherwise(F.array().cast("array<date>"))


def week_end(day: Column) -> Column:
    """Saturday on or after the day."""
    return F.date_add(day, 7 - F.dayofweek(day))


def week_ends(start: Column | str, end: Column | str) -> Column:
    """Array of the Saturdays in [start, end]."""
    start, end = _day(start), _day(end)
    first = week_end(start)
    return F.when(end >= first, F.sequence(first, end, F.expr("interval 7 days"))).otherwise(F.array().cast("array<date>"))


ENDS = {"month": month_ends, "week": week_ends, "day": days}


def calendar(spark: SparkSession, unit: str, start: str, end: str) -> DataFrame:
    """One row per period with its first and last day and its key."""
    ends = spark.range(1).select(F.explode(ENDS[unit](start, end)).alias("period_end"))
    return with_period_columns(ends, unit)


def with_period_columns(df: DataFrame, unit: str, end: str = "period_end") -> DataFrame:
    end_col = F.col(end)
    first = {"month": F.trunc(end_col, "month").cast("date"), "week": F.date_sub(end_col, 6), "day": end_col}[unit]
    key = {
        "month": F.date_format(end_col, "yyyyMM").cast("int"),
        "week": yearweek(first),
        "day": F.date_format(end_col, "yyyyMMdd").cast("int"),
    }[unit]
    return df.withColumn("period_start", first).withColumn("period_key", key)


def valid_in_period(
    df: DataFrame, unit: str, since: Column, until: Column, horizon_start: str, horizon_end: str, end: str = "period_end"
) -> DataFrame:
    """Rows of a validity table, once per period end in [since, until) inside the horizon.

    `until` is the time the next row takes over; null means never.
    """
    first = F.greatest(since, F.lit(horizon_start).cast("date"))
    last = F.least(F.date_sub(until, 1), F.lit(horizon_end).cast("date"))
    return df.withColumn("__ends", ENDS[unit](first, last)).select(
        *df.columns, F.explode("__ends").alias(end)
    )


def as_of(
    df: DataFrame, unit: str, when: str, key: list[str], order: list[str], horizon_start: str, horizon_end: str
) -> DataFrame:
    """Latest row per key before the end of every period, for sources that are not yet a validity table.

    Rows are first reduced to the last one of each (key, period) with a map-side combine, so a key holds at most one
    row per period when the validity spans are laid out.
    """
    period = {
        "month": F.last_day(F.col(when)),
        "week": week_end(F.to_date(F.col(when))),
        "day": F.to_date(F.col(when)),
    }[unit]
    rest = [c for c in df.columns if c not in key]
    newest = (
        df.withColumn("__p", period)
        .groupBy(*key, "__p")
        .agg(F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("__row"))
    )
    window = Window.partitionBy(*key).orderBy("__p")
    spans = newest.withColumn("__until", F.lead("__p").over(window))
    first = F.greatest(F.col("__p"), F.lit(horizon_start).cast("date"))
    last = F.least(F.date_sub(F.col("__until"), 1), F.lit(horizon_end).cast("date"))
    return spans.withColumn("__ends", ENDS[unit](first, last)).select(
        *key, "__row.*", F.explode("__ends").alias("period_end")
    )
