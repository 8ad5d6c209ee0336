"""The number of tasks grows with the input, and rows stay the same; report rows are not moved once they are laid out."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from caretrail.checks import CHECKS
from caretrail.checks.compare import compare, connect
from caretrail.operators.bitmaps import person_bitmaps
from caretrail.operators.timeline import Timeline
from caretrail.plans import reports
from caretrail.sources.tables import Tables
from tests.conftest import SMALL


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("caretrail.task.rows", "150")
    yield Tables(spark, SMALL)
    spark.conf.unset("caretrail.task.rows")


def test_small_tables_keep_the_number_of_spark(tables):
    assert tables.tasks() is None


def test_tasks_grow_with_the_input(spark, many_tasks):
    assert many_tasks.tasks() == -(-many_tasks.raw("orders").count() // 150)
    rows = entry.queries()["m13_appointments"](spark, SMALL)
    assert rows.rdd.getNumPartitions() == many_tasks.tasks()


@pytest.mark.parametrize("name", ["m36_care_status_by_site", "e10_weekly_validity_latest", "m13_appointments"])
def test_query_of_many_tasks_equals_sql(spark, many_tasks, name):
    result = compare(entry.queries()[name], CHECKS[name].sql, spark, connect(SMALL), SMALL)
    assert result["ok"], result["why"]


def after_layout(df):
    """The part of the plan above the place where periods are laid out."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.index("Generate ")]


@pytest.mark.parametrize("name", ["m18_weekly_report", "m19_daily_report", "m20_differentiated_care_report"])
def test_report_rows_are_not_moved(spark, name):
    above = after_layout(entry.queries()[name](spark, SMALL))
    assert "Exchange" not in above and "Join" not in above
    assert name != "m19_daily_report" or "Sort" not in above


def test_person_weeks_equal_a_plain_choice(spark):
    """Visits of one day, long return dates, missing days and rows that come twice, against the choice row by row."""
    rng, start, span = random.Random(3), dt.date(2000, 1, 1), ("2000-01-01", "2000-04-01")
    rows = []
    for person in range(40):
        days = sorted((rng.choice([None, *[start + dt.timedelta(rng.randint(0, 80)) for _ in range(9)]]) for _ in range(rng.randint(1, 7))), key=lambda d: d or dt.date(1, 1, 1))
        clinical = [rng.random() < 0.7 for _ in days]
        for i, day in enumerate(days):
            after = [d for d, c in zip(days[i + 1 :], clinical[i + 1 :]) if c]
            rtc = (day or start) + dt.timedelta(rng.randint(0, 40)) if rng.random() < 0.6 else None
            vl = day if rng.random() < 0.5 else None
            row = (person, rng.randint(1, 5) * 100 + i, day, int(clinical[i]), after[0] if after else None, rtc, float(i), vl)
            rows += [row] * rng.choice([1, 1, 1, 2])
    names = "person_id long, encounter_id long, encounter_date date, is_clinical int, next_clinical_datetime_hiv date, rtc_date date, vl_1 double, vl_1_date date"
    df = spark.createDataFrame(rows, names).withColumn("vl_2", F.lit(None).cast("double")).withColumn("vl_2_date", F.lit(None).cast("date"))
    found = reports.person_weeks(df, Timeline(("person_id",), reports.BY_ID), span).collect()
    ends = [start + dt.timedelta(7 * i) for i in range(14)]
    least, expected = dt.date(1, 1, 1), []
    for person in range(40):
        mine = [r for r in rows if r[0] == person and r[3] == 1]
        for end in ends:
            valid = [r for r in mine if (r[2] or least) <= end and (r[4] is None or max(r[4], r[5] or least) > end)]
            if valid:
                best = max(valid, key=lambda r: (r[2] or least, r[1]))
                expected += [(person, end, r[1], r[2]) for r in mine if r[1] == best[1]]
    assert sorted(map(str, expected)) == sorted(str((r.person_id, r.period_end, r.encounter_id, r.encounter_date)) for r in found if not r["__mark"])
    marks = [(r.person_id, r.period_end) for r in found if r["__mark"]]
    assert len(marks) == len(set(marks)) and marks


def test_bitmaps_are_not_begun_before_the_exchange(spark):
    df = spark.range(10).select(F.col("id").alias("person_id"), (F.col("id") % 2).alias("site"))
    plan = person_bitmaps(df, {"all": F.lit(True)}, ["site"])._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "Exchange" not in plan[: plan.rindex("bitmap_construct_agg")]
