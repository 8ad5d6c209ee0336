"""Period reports: numbered dates, rules that are the same on all periods of a row, and what is carried on the rows of periods."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from caretrail.plans import reports
from caretrail.plans.rule_text import NumberedText, SparkText, add_rules, divided, names_read
from tests.conftest import SMALL


def test_numbered_dates_equal_the_calendar(spark):
    rng, start = random.Random(5), dt.date(1951, 1, 1)
    odd = [dt.date(2000, 2, 29), dt.date(1999, 2, 28), dt.date(2000, 1, 31), dt.date(2000, 3, 1), dt.date(2000, 12, 31), dt.date(2001, 1, 1), None]
    days = odd + [start + dt.timedelta(rng.randint(0, 19000)) for _ in range(40)]
    df = spark.createDataFrame([(a, b) for a in days for b in days], "a date, b date")
    text = NumberedText()
    rules = [{f"{n}_{i}": t for n, t in (("m", d.months("a", "b")), ("y", d.years("a", "b")), ("w", d.yearweek("a")))} for i, d in enumerate((SparkText, text))]
    found = add_rules(df, [rules[0], *text.stages([rules[1]])])
    assert dict(found.dtypes)["m_0"] == dict(found.dtypes)["m_1"] and dict(found.dtypes)["y_0"] == dict(found.dtypes)["y_1"]
    assert found.filter("NOT (m_0 <=> m_1 AND y_0 <=> y_1 AND w_0 <=> w_1)").count() == 0


def test_rules_are_divided_by_what_they_read():
    stages = [{"a": "x + 1", "b": "y + 1"}, {"c": "a + 1", "d": "b + 1", "e": "CASE WHEN a = 'y' THEN 1 END"}, {"f": "d + c"}]
    early, late = divided(stages, {"y"})
    assert [list(s) for s in early] == [["a"], ["c", "e"]] and [list(s) for s in late] == [["b"], ["d"], ["f"]]
    assert names_read(late) >= {"y", "b", "d", "c"} and "x" not in names_read(late)


def test_numbers_follow_the_stage_of_their_column():
    text = NumberedText()
    rules = [{"due": "add_months(edd, -9)"}, {"waits": text.months("due", "period_end")}]
    order = [n for stage in text.stages(rules) for n in stage]
    assert order.index("due") < order.index("number_of_due") < order.index("waits") and order[0] == "number_of_period_end"


def above_layout(df):
    """The nodes of the plan above the place where periods are laid out, the last first."""
    node = df._jdf.queryExecution().executedPlan().executedPlan()
    while node.nodeName() != "Generate":
        yield node
        node = node.children().apply(0)


def test_week_rows_are_sorted_narrow(spark):
    sorts = [n for n in above_layout(entry.queries()["m18_weekly_report"](spark, SMALL)) if n.nodeName() == "Sort"]
    assert len(sorts) == 1 and sorts[0].output().size() <= 15


def test_weeks_do_not_compute_what_the_visit_says():
    late = divided(*_weekly())[1]
    computed = {n for stage in late for n in stage}
    assert not computed & {"rtc_yw", "encounter_yw", "on_schedule", "date_confirmed_pregnant", "on_dc_this_week", "number_of_birthdate", "week_of_death_date"}
    assert "timestampdiff" not in str(late) and {"year_week", "status", "patients_due_for_vl"} <= computed


def _weekly():
    text = NumberedText()
    return text.stages(reports.weekly_rules(text)), {"period_start", "period_end", "clinical_visit_num", *reports.VL_COLUMNS}


@pytest.mark.parametrize("name", ["m17_monthly_report", "m18_weekly_report", "m19_daily_report"])
def test_reports_set_what_their_session_needs(spark, name):
    before = spark.conf.get("spark.sql.codegen.maxFields")
    spark.conf.set("spark.sql.codegen.maxFields", "100")
    try:
        entry.queries()[name](spark, SMALL).select(F.lit(1))
        assert int(spark.conf.get("spark.sql.codegen.maxFields")) <= 40
    finally:
        spark.conf.set("spark.sql.codegen.maxFields", before)


def test_lost_patients_equal_a_plain_walk(spark):
    """Weeks around the baseline, with unknown locations and weeks that are missing, against the outcomes followed week by week."""
    rng, a, b = random.Random(9), reports.BASELINE_FROM, reports.BASELINE_TO
    weeks = [(a - 1, dt.date(2000, 9, 16)), (a + 1, dt.date(2000, 9, 30)), (a + 2, dt.date(2000, 10, 7)), (b - 1, dt.date(2001, 5, 5)), (b, dt.date(2001, 5, 12))]
    weeks += [(b + i, dt.date(2001, 5, 12) + dt.timedelta(7 * i)) for i in range(1, 6)]
    rows, expected = [], []
    for person in range(300):
        before = lost_at = place = reached = after = prev = back = None
        for yw, end in weeks:
            if rng.random() < 0.15:
                continue
            status, site, seen = rng.choice(["active", "ltfu", "ltfu", "missed", "dead"]), rng.choice([None, 1, 2, 3]), end - dt.timedelta(rng.randint(0, 6))
            reach, lost = int(status in ("active", "missed")), int(status == "ltfu")
            rows.append((person, end, seen, yw, status, "unknown", 0, reach, lost, site))
            before = before or (a < yw < b and reach)
            lost_at = lost_at or (yw == b and lost)
            base = bool(before and lost_at)
            place = site if place is None and base else place
            reached = reached or (yw >= b and reach)
            after = after or (reached and yw > b and status == "ltfu")
            if status == "ltfu":
                back = None
            elif (base or after) and prev == "ltfu" and status == "active":
                back = seen
            expected.append((person, end, prev, int(bool(before)), int(bool(lost_at)), int(base), place, int(bool(reached)), int(bool(after)), back))
            prev = status
    names = "person_id long, period_end date, encounter_date date, year_week int, status string, med_status string, stable_on_art int, in_reach int, lost int, location_id int"
    df = add_rules(spark.createDataFrame(rows, names), [reports.baseline_rules()])
    shown = ["prev_status", "was_active_before", "was_ltfu_at_baseline", "is_ltfu_surge_baseline", "baseline_location", "active_after_baseline", "is_ltfu_after_baseline", "week_patient_became_active"]
    found = reports.lost_patients(df).select("person_id", "period_end", *shown).collect()
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in found)
    assert {r.baseline_location for r in found} == {None, 1, 2, 3} and any(r.week_patient_became_active for r in found)


def test_month_rows_are_sorted_twice(spark):
    nodes = [n.nodeName() for n in above_layout(entry.queries()["m17_monthly_report"](spark, SMALL))]
    assert nodes.count("Sort") == 2 and nodes.count("Window") == 2


def test_neighbours_equal_a_plain_walk(spark):
    """Months with visits that hold the location, unknown locations and unknown visit types, against the definition month by month."""
    rng, rows, expected = random.Random(11), [], []
    for person in range(200):
        ends = sorted(rng.sample(range(24), rng.randint(1, 8)))
        mine = [(person, dt.date(2000 + i // 12, i % 12 + 1, 28), rng.choice(["active", "ltfu", None]), rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 23, 119]), rng.choice([None, "a", "b"]), rng.randint(0, 1)) for i in ends]
        rows += mine
        moves = [r[4] not in reports.HELD_VISITS for r in mine]

        def site(order):
            out, held = {}, None
            for k, i in enumerate(order):
                held = mine[i][3] if k == 0 or moves[i] else held
                out[i] = held
            return out

        order = range(len(mine))
        forward, backward = site(order), site(order[::-1])
        at = lambda i, column: mine[i][column] if 0 <= i < len(mine) else None
        expected += [(person, mine[i][1], at(i - 1, 2), at(i + 1, 2), forward.get(i - 1), backward.get(i + 1), at(i - 1, 5)) for i in order]
    df = spark.createDataFrame(rows, "person_id long, period_end date, status string, site_id int, visit_type_id int, cur_arv_meds string, follow_up_vl_unsuppressed int")
    shown = ["prev_status", "next_status", "prev_location_id", "next_location_id", "prev_month_arvs"]
    found = reports.neighbours(df).select("person_id", "period_end", *shown).collect()
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in found)


def test_days_are_copied_in_few_steps(spark):
    nodes = list(above_layout(entry.queries()["m19_daily_report"](spark, SMALL)))
    rules = " ".join(n.toString() for n in nodes)
    assert [n.nodeName() for n in nodes] == ["Project"] * len(nodes) and len(nodes) <= 4 and "timestampdiff" not in rules.lower()
