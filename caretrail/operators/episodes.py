"""Extracts and episodes: concept extracts, first and last events, treatment episodes, estimated dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.operators.aggregates import earliest_per, latest_per
from caretrail.operators.timeline import Timeline, carry, following, prev, running

# Days in the periods a return interval is given in.
PERIOD_DAYS = {"days": 1.0, "weeks": 7.0, "months": 30.25}


def estimated_return(rtc: Column, seen: Column, number: Column, period: Column) -> tuple[Column, Column]:
    """Return date as given, else counted from the visit by a number of periods; and whether it was counted."""
    table = F.create_map(*[F.lit(x) for pair in PERIOD_DAYS.items() for x in pair])
    counted = F.date_add(seen, F.floor(number * F.try_element_at(table, period)).cast("int"))
    return F.coalesce(rtc, counted), F.when(rtc.isNull() & counted.isNotNull(), 1).otherwise(0)


def concept_extract(obs: DataFrame, rules: dict[str, list[tuple[int, list[int] | None]]]) -> DataFrame:
    """Observations that meet named rules of (concept, allowed codes or any), one row per rule met.

    All rules share one scan: the concepts are filtered first, then each row carries the names it meets.
    """
    concepts = sorted({c for tests in rules.values() for c, _ in tests})
    named = []
    for name, tests in rules.items():
        hit = F.lit(False)
        for concept, codes in tests:
            one = F.col("concept_id") == concept
            hit = hit | (one & F.col("value_coded").isin(codes) if codes else one)
        named.append(F.when(F.coalesce(hit, F.lit(False)), F.lit(name)))
    rows = obs.filter(F.col("concept_id").isin(concepts)).withColumn("extract", F.explode(F.array_compact(F.array(*named))))
    return rows.select("extract", "person_id", "encounter_id", "concept_id", "obs_date", "value_coded", "value_numeric")


def first_and_last(events: DataFrame, key: list[str], when: str, tie: list[str]) -> DataFrame:
    """First and last event per key with the number of events."""
    columns = [c for c in dict.fromkeys([*key, when, *tie])]
    rows = events.select(*columns)
    order = [when, *tie]
    first = earliest_per(rows, key, order).withColumnRenamed(when, f"first_{when}").drop(*tie)
    last = latest_per(rows, key, order).withColumnRenamed(when, f"last_{when}").drop(*tie)
    counts = events.groupBy(*key).agg(F.count(F.lit(1)).alias("events"))
    return first.join(last, key).join(counts, key)


def drug_episodes(changes: DataFrame, line: Timeline) -> DataFrame:
    """Treatment episodes from dated regimen reports and stops.

    `changes` has person_id, the order columns, regimen (text) and stops (flag). An episode runs while the carried
    regimen stays the same; it ends at the next change or stop.
    """
    event = (F.col("stops") == 1) | F.col("regimen").isNotNull()
    df = line.scan(changes, current=carry(event, F.when(F.col("stops") != 1, F.col("regimen"))))
    df = line.scan(df, __prev=prev(F.col("current")), __next=following(F.col(line.order[0])))
    starts = ~F.col("current").eqNullSafe(F.col("__prev"))
    df = line.scan(df.withColumn("__start", F.when(starts, 1).otherwise(0)), episode=running(F.col("__start")))
    return (
        df.filter("current IS NOT NULL")
        .groupBy(*line.key, "episode", F.col("current").alias("regimen"))
        .agg(F.min(line.order[0]).alias("started"), F.max("__next").alias("ended"), F.count(F.lit(1)).alias("reports"))
    )
