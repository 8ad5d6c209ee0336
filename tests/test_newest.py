"""The last row of a group by one number."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from caretrail.operators.newest import last_keys, last_rows
from tests.conftest import SMALL

ORDER = ["at", "rank", "id"]
SCHEMA = "person long, at date, rank tinyint, id long, note string"


def least_first(value):
    return (value is not None, value if value is not None else 0)


def key_of(row):
    at = (row.at is not None, row.at or date.min)
    return (at, least_first(row.rank), least_first(row.id))


def test_equals_the_sorted_groups(spark):
    dice = random.Random(5)
    edges = [date(1, 1, 1), date(9999, 12, 31), date(1969, 12, 31), None] + [date(2020, 1, 1) + timedelta(days=i) for i in range(4)]
    rows = [
        (dice.choice([None, *range(30)]), dice.choice(edges), dice.choice([None, -128, 0, 127]), dice.choice([None, -(2**63), 2**63 - 1, 0, i]), f"n{i}")
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    best = {}
    for row in df.collect():
        if row.person not in best or key_of(row) > key_of(best[row.person]):
            best[row.person] = row
    found = {r.person: (r.at, r.rank, r.id) for r in last_keys(df, ["person"], ORDER).collect()}
    assert found == {k: (r.at, r.rank, r.id) for k, r in best.items()}


def test_types_come_back_and_empty_tables_are_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = last_keys(df, ["person"], ORDER)
    assert out.dtypes == [("person", "bigint"), ("at", "date"), ("rank", "tinyint"), ("id", "bigint")] and out.count() == 0
    flags = spark.createDataFrame([(1, True, 3), (1, False, 9), (2, None, 1)], "k int, flag boolean, n smallint")
    assert sorted(map(tuple, last_keys(flags, ["k"], ["flag", "n"]).collect())) == [(1, True, 3), (2, None, 1)]


def test_ties_of_the_whole_order_are_one(spark):
    df = spark.createDataFrame([(1, date(2020, 1, 1), 1, 5, "a")] * 3, SCHEMA)
    assert last_keys(df, ["person"], ORDER).count() == 1
    assert last_rows(df.distinct(), df, ["person"], ORDER, "id").count() == 1


def test_an_order_that_is_too_wide_is_refused(spark):
    df = spark.range(1).select(F.col("id"), F.col("id").alias("other"))
    with pytest.raises(ValueError, match="narrower"):
        last_keys(df, ["id"], ["id", "other"])


@pytest.mark.parametrize("name", ["h03_last_visit_of_month", "m15_defaulters", "m27_covid_screening", "m28_case_list", "m40_retention"])
def test_no_group_is_sorted_for_its_last_row(spark, name):
    """Only texts (phone numbers, identifiers) are reduced by a sort aggregate; the choice of the row is a hash aggregate."""
    plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    nodes = [line for line in plan.splitlines() if "Aggregate(" in line]
    choices = [line for line in nodes if "max(__best" in line or "max_by" in line]
    assert choices and all("HashAggregate" in line and "Object" not in line for line in choices)
    if name[:3] in ("h03", "m27"):
        assert "SortAggregate" not in plan
