"""Counts from intervals and from bitmaps, against counting every row and day."""

import datetime as dt
import random

from pyspark.sql import functions as F

from caretrail.checks import indicators, reports
from caretrail.operators.aggregates import indicator_counts
from caretrail.operators.bitmaps import bitmap_counts, person_bitmaps
from caretrail.operators.intervals import interval_counts
from tests.test_store import files_of

D0 = dt.date(2020, 1, 1)
c = F.col


def test_counts_over_days_equal_a_count_of_every_day(spark):
    rng = random.Random(2)
    some = lambda lo, hi: rng.choice([None, D0 + dt.timedelta(days=rng.randint(lo, hi))])
    rows = [(rng.choice(["a", "b", None]), some(-5, 30), some(-5, 35), some(0, 30)) for _ in range(80)]
    rows.append(("alone", D0 + dt.timedelta(days=4), D0 + dt.timedelta(days=6), None))
    rows.append(("alone", D0 + dt.timedelta(days=9), None, None))
    df = spark.createDataFrame(rows, "site string, x date, y date, z date")
    first, last = D0, D0 + dt.timedelta(days=25)
    states = {"one": (c("x"), c("y")), "two": (c("z"), None)}
    found = {}
    for r in interval_counts(df, ["site"], states, str(first), str(last)).collect():
        for i in range((r["until"] - r["since"]).days + 1):
            day = (r["site"], r["since"] + dt.timedelta(days=i))
            assert day not in found
            found[day] = (r["one"], r["two"])
    expected = {}
    for site, x, y, z in rows:
        for i in range(26):
            day = first + dt.timedelta(days=i)
            one, two = x is not None and x <= day and (y is None or day < y), z is not None and z <= day
            old = expected.get((site, day), (0, 0))
            expected[site, day] = (old[0] + one, old[1] + two)
    assert found == {k: v for k, v in expected.items() if sum(v)}
    assert interval_counts(df.limit(0), ["site"], states, str(first), str(last)).collect() == []


def test_counts_over_days_make_no_row_per_day(spark, tables):
    plan = reports.status_over_days(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan.split("Window")[0] and "sequence(" not in plan


def test_bitmaps_equal_distinct_counts(spark):
    rng = random.Random(5)
    people = [*range(50), *range(32_760, 32_780), 10**12, 10**12 + 5, -7, None]
    rows = [(rng.choice(people), rng.choice(["n", "s"]), rng.randint(1, 3), rng.randint(0, 9)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "person_id long, county string, month int, v int")
    tests = {f"v{i}": c("v") > i for i in range(70)}
    maps = person_bitmaps(df, tests, ["county", "month"])
    some = ["v0", "v5", "v8", "v9", "v69"]
    known = df.filter("person_id is not null")
    for by, rollup in ((["county", "month"], True), (["county"], False), (["month"], False)):
        expected = indicator_counts(known, {n: tests[n] for n in some}, by, rollup=rollup)
        assert sorted(map(str, bitmap_counts(maps, some, by, rollup).collect())) == sorted(map(str, expected.collect()))
    assert bitmap_counts(maps.limit(0), some, ["county"]).collect() == []


def test_a_new_month_leaves_the_bitmaps_of_others(spark, tables):
    store, before = indicators.care_bitmaps(tables)
    after = files_of(store, "care")
    assert before and before <= after and len(after) > len(before)
