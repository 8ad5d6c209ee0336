"""Registered queries: each runs, and those with SQL equal it."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from caretrail.checks import CHECKS
from caretrail.checks.compare import compare, connect
from tests.conftest import SMALL

CON = None
# One of each family; check.py runs all of them.
NAMES = [
    "b02_flatten_obs", "b11_flatten_groups", "c02_read_encoded_string", "d03_encounter_flags", "e07_period_validity_join", "e15_first_event_after",
    "e17_overlay_merge", "f03_distinct_indicators_rollup", "g04_carry_with_clear", "g13_shift_register", "g14_guarded_results", "j02_title_case",
    "j06_national_regimen_code", "a04_rejected_lines", "k01_marks_of_three_runs", "k03_changes_of_all_sources",
    "k07_recompute_changed_persons", "k07_sync_stored_partitions", "k07_untouched_partitions", "k10_cascade_graph", "k11_streamed_lab_counts",
    "k11_stream_into_dataset", "m04_flat_labs_and_imaging", "m08_hiv_summary",
    "m13_appointments", "m17_monthly_report", "m21_infant_summary", "m25_prep_monthly_report", "m30_care_indicators_by_site", "m36_care_status_by_site",
    "m42_breast_cancer_screening", "n06_viral_load_due", "p03_treatment_episodes", "r02_build_differences",
]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    global CON
    CON = CON or connect(SMALL)
    result = compare(entry.queries()[name], CHECKS[name].sql, spark, CON, SMALL)
    assert result["ok"], result["why"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert "period_end" in df.columns and df.count() > 0


def test_every_query_names_what_it_covers():
    assert all(c.ids for c in CHECKS.values())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_daily_report_has_every_day(spark, tables):
    df = entry.queries()["m19_daily_report"](spark, SMALL)
    first, last = tables.encounter.agg(F.min("encounter_date"), F.max("encounter_date")).first()
    days = {r[0] for r in df.select("period_end").distinct().collect()}
    assert max(days) == last and len(days) == (last - min(days)).days + 1 and (min(days) - first).days < 31
