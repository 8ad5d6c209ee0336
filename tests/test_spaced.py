"""Choices with a distance, by pointers, against a walk and against the fold."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from caretrail.operators.fold import accepted_results, accepted_step, fold_steps
from caretrail.operators.spaced import spaced
from caretrail.operators.timeline import Timeline, by_timeline
from caretrail.plans.hiv_summary import events_until_next_clinical

D0 = dt.date(2000, 1, 1)
c = F.col


def day(n):
    return D0 + dt.timedelta(days=n)


def walked(days, gap):
    out = []
    for d in sorted(set(days)):
        if not out or (d - out[-1]).days > gap:
            out.append(d)
    return out


@pytest.mark.parametrize("block", [None, "year(__at)"])
@pytest.mark.parametrize("gap", [0, 1, 30, 400])
def test_chosen_rows_equal_a_walk(spark, gap, block):
    rng = random.Random(gap)
    groups = {g: [day(rng.randint(0, s)) for _ in range(n)] for g, (n, s) in enumerate([(1, 9), (40, 60), (300, 900), (200, 4000), (2, 2), (600, 700)])}
    groups[None] = [day(0), day(31), day(31), day(62)]
    df = spark.createDataFrame([(g, d) for g, days in groups.items() if g is not None for d in days], "g int, d date")
    block = block and F.expr(block)
    found = sorted(tuple(r) for r in spaced(df, ["g"], "d", gap, block=block).collect())
    assert found == sorted((g, d) for g, days in groups.items() if g is not None for d in walked(days, gap))
    numbered = sorted(tuple(r) for r in spaced(df, ["g"], "d", gap, 4, block).collect())
    assert numbered == sorted((g, d, i) for g, days in groups.items() if g is not None for i, d in enumerate(walked(days, gap)[:4], 1))


def test_no_rows(spark):
    assert spaced(spark.createDataFrame([], "g int, d date"), ["g"], "d", 30).collect() == []


@pytest.mark.parametrize("block", [None, "year(day)"])
def test_accepted_results_equal_the_fold(spark, block):
    rng = random.Random(9)
    rows = []
    for person in range(60):
        share, span = rng.choice([0, 0.1, 0.5, 1]), rng.choice([100, 900, 3000])
        for n in sorted(rng.sample(range(span), rng.randint(1, 60))):
            lab = float(rng.randint(1, 9)) if rng.random() < share else None
            form = rng.random() < 0.8 or lab is None
            rows.append((person, day(n), lab, float(rng.randint(10, 99)) if form else None, day(n + rng.choice([0, 0, -5, -40, 3, 50, 200])) if form else None))
    daily = spark.createDataFrame(rows, "person_id int, day date, lab_value double, form_value double, form_date date")
    expected = fold_steps(daily, ["person_id"], [accepted_step()])
    found = accepted_results(daily, ["person_id"], block=block and F.expr(block))
    assert sorted(map(str, found.select(expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_days_of_one_long_timeline_are_not_walked_in_one_array(spark):
    def seconds(days):
        daily = spark.range(days).select(F.lit(1).alias("person_id"), F.date_add(F.lit(dt.date(1900, 1, 1)), c("id").cast("int")).alias("day"))
        daily = daily.withColumn("lab_value", F.when(F.dayofyear("day") == 7, 5.0)).withColumn("form_value", F.dayofyear("day").cast("double"))
        start = time.monotonic()
        out = accepted_results(daily.withColumn("form_date", c("day")), ["person_id"], block=F.year("day"))
        assert out.agg(F.count("*"), F.count_distinct("date_1")).first() == (days, out.select("date_1").distinct().count())
        return time.monotonic() - start

    seconds(1_000)
    assert seconds(100_000) < 4 * seconds(25_000) + 10  # quadratic work would take sixteen times as long


def test_gaps_that_span_blocks(spark):
    """One person without a clinical row, one with few, one with many; walked whole and in blocks of a month."""
    rng = random.Random(3)
    rows = []
    for person, share in ((1, 0.0), (2, 0.02), (3, 0.5)):
        for i in range(300):
            clinical = int(rng.random() < share)
            rows.append((person, day(rng.randint(0, 500)), i, clinical, None if clinical else rng.choice([None, None, 21, 99]), day(rng.randint(0, 900))))
    df = spark.createDataFrame(rows, "person_id int, encounter_date date, encounter_id int, is_clinical int, kind int, told date")
    df = df.withColumn("month", F.trunc("encounter_date", "month"))
    events = {"seen": (F.coalesce(c("kind") == 21, F.lit(False)), c("encounter_date")), "told_on": (F.coalesce(c("kind") == 99, F.lit(False)), c("told"))}

    def run(hot):
        build = lambda d, line: events_until_next_clinical(d, line, events)
        return sorted(map(str, by_timeline(df, build, hot, order=("encounter_date", "encounter_id"), block="month").collect()))

    assert run([1, 2, 3]) == run([])
    plain = Timeline(("person_id",), ("encounter_date", "encounter_id"))
    one = events_until_next_clinical(df.filter("person_id = 1"), plain, events)
    assert one.select("seen").distinct().count() == 1 and one.first()["seen"] is not None
