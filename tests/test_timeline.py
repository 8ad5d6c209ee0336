"""Timeline looks against a plain fold per person, on both the usual and the blocked path."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from caretrail.operators.timeline import (
    Passes,
    Timeline,
    by_timeline,
    carry,
    ever,
    following,
    hot_keys,
    latch,
    locf,
    next_where,
    prev,
    prev_where,
    running,
)

c = F.col
D0 = dt.date(2020, 1, 1)
SCHEMA = "person_id int, encounter_date date, encounter_id int, v int, e int, clear int"
ORDER = ("encounter_date", "encounter_id")


def looks():
    return dict(
        last=locf(c("v")),
        held=carry((c("e") == 1) | (c("clear") == 1), F.when(c("clear") != 1, c("v"))),
        first=latch(c("e") == 1, c("v")),
        before=prev(c("v")),
        after=following(c("v")),
        before_e=prev_where(c("e") == 1, c("v")),
        after_e=next_where(c("e") == 1, c("v")),
        count=running(c("e")),
        seen=ever(c("e") == 1),
    )


def fold(rows):
    """The same looks, row by row."""
    out = {}
    people = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        people.setdefault(r[0], []).append(r)
    for line in people.values():
        last = held = first = before_e = None
        latched = False
        count = 0
        for i, (_, _, key, v, e, clear) in enumerate(line):
            last = v if v is not None else last
            if e == 1 or clear == 1:
                held = None if clear == 1 else v
            if e == 1 and not latched:
                first, latched = v, True
            count += e
            after_e = next((x[3] for x in line[i + 1 :] if x[4] == 1), None)
            out[key] = (
                last, held, first, line[i - 1][3] if i else None, line[i + 1][3] if i + 1 < len(line) else None, before_e, after_e, count, int(count > 0),
            )
            if e == 1:
                before_e = v
    return out


def random_rows(seed, persons=6, most=12):
    rng = random.Random(seed)
    rows, key = [], 0
    for p in range(persons):
        for _ in range(rng.randint(1, most)):
            key += 1
            rows.append((p, D0 + dt.timedelta(days=rng.randint(0, 6)), key, rng.choice([None, 1, 2, 3]), rng.randint(0, 1), int(rng.random() < 0.2)))
    return rows


@pytest.mark.parametrize("hot", [(), (0, 1), (0, 1, 2, 3, 4, 5)])
@pytest.mark.parametrize("seed", [1, 2])
def test_looks_equal_fold(spark, seed, hot):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    names = list(looks())
    out = by_timeline(df, lambda d, line: line.scan(d, **looks()), hot, order=ORDER)
    got = {r["encounter_id"]: tuple(r[n] for n in names) for r in out.collect()}
    assert got == fold(rows)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=hs.integers(10, 10_000))
def test_blocked_path_equals_usual_path(spark, seed):
    df = spark.createDataFrame(random_rows(seed, persons=3, most=20), SCHEMA)
    build = lambda d, line: line.scan(d, **looks())
    usual = by_timeline(df, build, (), order=ORDER)
    split = by_timeline(df, build, (0, 1, 2), order=ORDER)
    assert sorted(map(str, usual.collect())) == sorted(map(str, split.collect()))


def test_state_does_not_leak_between_patients(spark):
    rows = [(1, D0, 1, 5, 1, 0), (1, D0, 2, 6, 0, 0), (2, D0, 3, None, 0, 0), (2, D0, 4, None, 0, 0)]
    out = Timeline(("person_id",), ORDER).scan(spark.createDataFrame(rows, SCHEMA), **looks())
    assert all(r["last"] is None and r["first"] is None and r["held"] is None for r in out.filter("person_id = 2").collect())


def test_start_refill_stop_restart(spark):
    """A stop empties the regimen; a refill without a drug keeps it empty; a restart fills it again."""
    rows = [(1, D0 + dt.timedelta(days=i), i, drug, int(drug is not None), stop) for i, (drug, stop) in enumerate([(6964, 0), (None, 0), (None, 1), (None, 0), (794, 0)])]
    out = Timeline(("person_id",), ORDER).scan(spark.createDataFrame(rows, SCHEMA), held=looks()["held"])
    assert [r["held"] for r in out.orderBy("encounter_id").collect()] == [6964, 6964, None, None, 794]


def test_soft_start_counts_only_while_empty(spark):
    days = ["soft", "soft", "hard", "soft", "clear", "none", "soft", "soft"]
    rows = [(1, D0 + dt.timedelta(days=i), i, kind) for i, kind in enumerate(days)]
    df = spark.createDataFrame(rows, "person_id int, encounter_date date, encounter_id int, kind string")
    for hot in ((), (1,)):
        def build(part, line):
            p = Passes()
            p.set_or_soft(0, "start", c("kind") == "hard", c("encounter_date"), c("kind") == "soft", c("encounter_date"), c("kind") == "clear")
            return p.run(line, part)

        out = by_timeline(df, build, hot, order=ORDER).orderBy("encounter_id").collect()
        assert [(r["start"] - D0).days if r["start"] else None for r in out] == [0, 0, 2, 2, None, None, 6, 6]


def test_hot_keys_are_found(spark):
    df = spark.range(100).select(F.when(c("id") < 40, 7).otherwise(c("id")).alias("k"))
    assert hot_keys(df, "k", rows=10) == [7]
    assert hot_keys(df, "k") == []


def test_one_exchange_for_a_chain_of_scans(spark):
    line = Timeline(("person_id",), ORDER)
    df = spark.createDataFrame(random_rows(3), SCHEMA)
    for i in range(3):
        df = line.scan(df, **{f"x{i}": locf(c("v" if i == 0 else f"x{i - 1}")), f"n{i}": prev(c("v"))})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
