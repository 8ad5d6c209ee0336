"""Aggregate reports, pivoted datasets, rules and extracts against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.checks.care_sql import AFTER, ROW, UPTO, held, locf, months, years
from caretrail.checks.care_sql import soft as soft_of
from caretrail.checks.incremental import shared
from caretrail.checks.registry import SHARED, check
from caretrail.operators import aggregates as agg
from caretrail.operators import bitmaps
from caretrail.operators import episodes as ep
from caretrail.operators import joins, rules
from caretrail.operators.timeline import by_timeline, following
from caretrail.plans import indicators as ind
from caretrail.plans import legacy as lg
from caretrail.plans.spine import measured
from caretrail.session import cut_lineage
from caretrail.sources.datasets import Datasets
from caretrail.sources.tables import Tables, live
from caretrail.sources.views import answer_rows_sql

c = F.col


def weeks(a: str, b: str) -> str:
    return f"CAST(TRUNC(({b} - {a}) / 7.0) AS INTEGER)"


_S = "encounter_date"
_w_vl, _w_art, _w_ord = weeks("vl_date_1", _S), weeks("arv_start_date", _S), weeks("vl_order_date", _S)
_m_vl, _m_art = months("vl_date_1", _S), months("arv_start_date", _S)
CARE_TESTS = {
    "num_patients": "TRUE",
    "on_arvs": "cur_arv_line IS NOT NULL",
    "on_arvs_first_line": "cur_arv_line = 1",
    "on_arvs_second_line": "cur_arv_line = 2",
    "on_arvs_third_line": "cur_arv_line > 2",
    "vl_done_past_year": f"{_w_vl} <= 52",
    "no_vl_in_past_year": f"cur_arv_line IS NOT NULL AND (vl_date_1 IS NULL OR {_w_vl} >= 52)",
    "vl_done_past_year_lte_1000": f"{_w_vl} <= 52 AND vl_value_1 <= 1000",
    "vl_done_past_year_gt_1000": f"{_w_vl} <= 52 AND vl_value_1 > 1000",
    "vl_done_this_encounter": "vl_resulted >= 0",
    "vl_done_this_encounter_lte_1000": "vl_resulted <= 1000",
    "vl_done_this_encounter_gt_1000": "vl_resulted > 1000",
    "vl_ordered": "vl_order_date = encounter_date",
    "pending_vl_order": f"{_w_ord} >= 0 AND vl_date_1 < vl_order_date",
    "pending_vl_order_no_result_after_4_weeks": f"{_w_ord} >= 4 AND vl_date_1 < vl_order_date",
    "on_arvs_lte_26_weeks": f"{_w_art} <= 26",
    "on_arvs_lte_52_weeks": f"{_w_art} <= 52",
    "on_arvs_lte_52_weeks_and_have_vl": f"{_w_art} <= 52 AND {_w_vl} <= 52",
    "on_arvs_lte_52_weeks_and_have_vl_lte_1000": f"{_w_art} <= 52 AND {_w_vl} <= 52 AND vl_value_1 <= 1000",
    "num_pregnant": "edd > encounter_date",
    "num_pregnant_and_on_arvs": "edd > encounter_date AND cur_arv_line IS NOT NULL",
    "arv_start_btwn_six_and_twelve_months": f"{_m_art} BETWEEN 6 AND 12",
    "arv_start_lte_six_months_and_no_vl": f"{_m_art} BETWEEN 6 AND 12 AND (vl_date_1 IS NULL OR {_m_vl} < 3)",
    "arv_start_gte_one_year": f"{_m_art} > 12",
    "arv_start_gte_one_year_and_no_vl": f"{_m_art} > 12 AND (vl_date_1 IS NULL OR {years('vl_date_1', _S)} > 1)",
}


def distinct(tests: dict[str, str]) -> str:
    return ", ".join(f"COUNT(DISTINCT CASE WHEN {v} THEN person_id END) AS {k}" for k, v in tests.items())


CARE_SQL = f"""SELECT county, location_id, {distinct(CARE_TESTS)} FROM hiv JOIN location ON location_id = known_location
      WHERE encounter_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' AND encounter_type NOT IN (21, 99999) GROUP BY ROLLUP (county, location_id)"""


@check(
    "m30_care_indicators_by_site",
    "M30 F3 F4 F5 L3",
    CARE_SQL,
)
def care_by_site(t: Tables) -> DataFrame:
    return ind.care_by_site(t, "1999-01-01", "1999-12-31")


def care_bitmaps(t: Tables) -> tuple[Datasets, set]:
    """Stored bitmaps of the indicators per site and month of a year; the last month comes by itself. And the files before that."""
    rows = ind.care_rows(t, "1999-01-01", "1999-12-31").withColumn("month", F.trunc("encounter_date", "month").cast("date"))
    last, by = F.lit("1999-12-01").cast("date"), ["county", "location_id", "month"]
    store = Datasets(t.spark, shared(t, "m30"), 200)
    # Two runs read them: the summary is walked once for both.
    marks = cut_lineage(bitmaps.person_marks(rows, ind.care_indicators(), by))
    store.create("care", bitmaps.bitmaps_of(marks.filter(c("month") < last), ind.care_indicators(), by), ["month"])
    files = {tuple(r) for r in store.files("care").collect()}
    new = bitmaps.bitmaps_of(marks.filter(c("month") == last), ind.care_indicators(), by)
    store.replace("care", t.spark.range(1).select(last.alias("month")), new, ["month"])
    return store, files


@check("m30_care_indicators_from_bitmaps", "M30 F3 F5", CARE_SQL)
def care_from_bitmaps(t: Tables) -> DataFrame:
    """A year's distinct patients by site and county, and in all, from the stored bitmaps of its months."""
    return bitmaps.bitmap_counts(care_bitmaps(t)[0].read("care"), ind.care_indicators(), ["county", "location_id"], rollup=True)


@check(
    "m31_appointment_performance",
    "M31 F3 E1",
    f"""WITH x AS (SELECT *, LAG(rtc_date) {ROW} AS prev_rtc, FIRST_VALUE(CASE WHEN is_clinical = 1 THEN encounter_date END IGNORE NULLS) {AFTER} AS next_clinic, LEAD(encounter_type) {ROW} AS next_type FROM spine),
     a AS (SELECT encounter_date AS d, {distinct({'attended': 'TRUE', 'attended_within_14': 'ABS(encounter_date - prev_rtc) <= 14', 'attended_after_14': 'encounter_date - prev_rtc > 14'})} FROM x WHERE encounter_type <> 21 GROUP BY 1),
     s AS (SELECT rtc_date AS d, {distinct({'scheduled': 'TRUE', 'scheduled_and_attended': 'next_clinic IS NOT NULL', 'has_not_returned': 'next_clinic IS NULL', 'scheduled_and_attended_within_14': 'ABS(next_clinic - rtc_date) <= 14', 'scheduled_and_attended_after_14': 'next_clinic - rtc_date > 14', 'next_visit_by_outreach': 'next_type = 21'})} FROM x WHERE rtc_date IS NOT NULL GROUP BY 1)
    SELECT * FROM a JOIN s USING (d)""",
)
def appointment_performance(t: Tables) -> DataFrame:
    return ind.appointment_performance(t)


@check(
    "m32_entry_by_provider",
    "M32 F1",
    "SELECT provider_id, encounter_type, COUNT(*) AS n FROM encounter e JOIN encounter_provider p ON p.encounter_id = e.encounter_id AND p.voided = 0 WHERE e.voided = 0 GROUP BY 1, 2",
)
def by_provider(t: Tables) -> DataFrame:
    return ind.entry_by_provider(t)


@check(
    "m32_entry_by_day",
    "M32 F2 F3",
    """WITH e AS (SELECT encounter_date AS day, COUNT(CASE WHEN encounter_type = 116 THEN 1 END) AS triage, COUNT(CASE WHEN encounter_type = 2 THEN 1 END) AS adult, COUNT(*) AS all_encounters,
       COUNT(DISTINCT CASE WHEN encounter_type = 116 THEN person_id END) AS triage_patients, COUNT(DISTINCT CASE WHEN encounter_type = 2 THEN person_id END) AS adult_patients FROM encounter WHERE voided = 0 AND encounter_type <> 21 GROUP BY 1),
     v AS (SELECT date_started AS day, COUNT(*) AS visits, COUNT(DISTINCT person_id) AS visit_patients FROM visit GROUP BY 1) SELECT * FROM e JOIN v USING (day)""",
)
def by_day(t: Tables) -> DataFrame:
    return ind.entry_by_day(t)


_timely = {"by_month_end": "LAST_DAY(date_created) = LAST_DAY(encounter_date)", "by_3rd": "date_created < LAST_DAY(encounter_date) + 3", "by_10th": "date_created < LAST_DAY(encounter_date) + 10"}


@check(
    "m33_entry_timeliness",
    "M33 F2 F4 D12 P7",
    f"""SELECT name, YEAR(encounter_date) AS year, MONTH(encounter_date) AS month, COUNT(*) AS total, {', '.join(f'COUNT(CASE WHEN encounter_type = {k} THEN 1 END) AS {n}' for n, k in ind.TYPE_NAMES.items())},
      {', '.join(f'COUNT(CASE WHEN {v} THEN 1 END) AS total_{n}, ROUND(COUNT(CASE WHEN {v} THEN 1 END) / COUNT(*), 4) AS perc_{n}, CASE WHEN COUNT(CASE WHEN {v} THEN 1 END) / COUNT(*) >= 0.95 THEN 1 ELSE 0 END AS {n}_gte_95' for n, v in _timely.items())}
      FROM encounter JOIN location USING (location_id) GROUP BY 1, 2, 3""",
)
def timeliness(t: Tables) -> DataFrame:
    return ind.entry_timeliness(t)


@check(
    "m35_outreach_performance",
    "M35 F4 F5 F8",
    f"""WITH x AS (SELECT *, FIRST_VALUE(CASE WHEN is_clinical = 1 THEN encounter_date END IGNORE NULLS) {AFTER} AS next_clinic, LEAD(encounter_type) {ROW} AS next_type FROM spine)
    SELECT county, x.location_id, COUNT(*) AS forms, COUNT(DISTINCT encounter_date) AS days, COUNT(CASE WHEN next_clinic IS NOT NULL AND next_type <> 21 THEN 1 END) AS returned, ROUND(COUNT(*) / COUNT(DISTINCT encounter_date), 4) AS forms_per_day,
      ROUND(COUNT(CASE WHEN next_clinic IS NOT NULL AND next_type <> 21 THEN 1 END) * 100.0 / COUNT(*), 1) AS pct_returned FROM x JOIN location l ON l.location_id = x.location_id WHERE encounter_type = 21 GROUP BY GROUPING SETS ((county, x.location_id), (county))""",
)
def outreach(t: Tables) -> DataFrame:
    return ind.outreach_performance(t)


_LAST = "(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY person_id ORDER BY encounter_date DESC, day_rank DESC, encounter_id DESC) AS rn FROM spine WHERE {}) WHERE rn = 1)"


@check(
    "m35_lost_by_month",
    "M35 G20",
    f"""WITH m AS (SELECT location_id, CAST(DATE_TRUNC('month', encounter_date) AS DATE) AS month, COUNT(*) AS monthly_ltfu FROM {_LAST.format('is_clinical = 1')} WHERE DATE '2001-06-30' - rtc_date > 90 GROUP BY 1, 2)
    SELECT *, CAST(SUM(monthly_ltfu) OVER (PARTITION BY location_id ORDER BY month) AS BIGINT) AS total_ltfu_to_date FROM m""",
)
def lost_by_month(t: Tables) -> DataFrame:
    return ind.lost_by_month(t, "2001-06-30")


@check(
    "m36_lost_at_date",
    "M36 E7",
    f"""SELECT location_id, COUNT(*) AS num_ltfu, COUNT(drug) AS num_ltfu_on_arvs FROM {_LAST.format("encounter_date <= DATE '2000-04-30'")} l JOIN person p ON p.person_id = l.person_id
      WHERE DATE '2000-04-30' - COALESCE(rtc_date, encounter_date + 30) >= 90 AND (death_date IS NULL OR death_date >= DATE '2000-04-30') GROUP BY 1""",
)
def lost_at(t: Tables) -> DataFrame:
    return ind.lost_at(t, "2000-04-30")


@check(
    "m37_return_distribution",
    "M37 F12",
    f"""WITH x AS (SELECT *, YEAR(encounter_date) AS year, LEAD(encounter_date) {ROW} - rtc_date AS late FROM spine WHERE is_clinical = 1)
    SELECT year, {', '.join(f'COUNT(CASE WHEN late BETWEEN {a} AND {b} THEN 1 END) AS {n}' for n, (a, b) in ind.RETURN_BUCKETS.items())}, COUNT(rtc_date) AS with_rtc,
      ROUND(COUNT(CASE WHEN late BETWEEN 0 AND 30 THEN 1 END) * 100.0 / NULLIF(COUNT(rtc_date), 0), 1) AS pct_within_30 FROM x GROUP BY year""",
)
def return_distribution(t: Tables) -> DataFrame:
    return ind.return_distribution(t)


_high = "vl_value_1 >= 1000 AND vl_value_2 >= 1000 AND vl_date_1 - vl_date_2 >= 90"


@check(
    "m38_persistent_viraemia",
    "M38 F3 J11",
    f"""SELECT 'all' AS scope, {distinct({'num_patients': 'TRUE', 'num_unsuppressed': 'vl_value_1 >= 1000', 'persistent': _high, 'arv_change': _high + ' AND prev_arv_line = 1 AND cur_arv_line = 2'})}
      FROM hiv WHERE vl_value_1 IS NOT NULL AND arv_start_date IS NOT NULL""",
)
def viraemia(t: Tables) -> DataFrame:
    return ind.persistent_viraemia(t)


# Pivoted datasets

SHARED["mohq"] = answer_rows_sql(lg.MOH_QUESTIONS)
_moh = {"arv_plan": 1255, "arv_started": 1250, "arvs_current": 1088, "arvs_per_patient": 2154, "transfer_care": 1285, "neg": 1946, "rapid": 1040, "care": 9082}
_any = "COALESCE(arv_started, arvs_current, arvs_per_patient)"
SHARED["moh0"] = f"""
SELECT s.person_id, s.encounter_id, s.encounter_date, s.encounter_type, s.day_rank, m.* EXCLUDE (encounter_id), {_any} AS any_drug, CASE WHEN neg = 1065 OR rapid = 664 THEN 1 ELSE 0 END AS negative,
 CASE WHEN rapid = 703 OR {_any} IS NOT NULL OR arv_plan IS NOT NULL THEN 1 ELSE 0 END AS positive, CASE WHEN arv_plan IN (1107, 1260) THEN 1 ELSE 0 END AS stop, CASE WHEN arv_plan = 1256 THEN 1 ELSE 0 END AS beg
FROM spine s LEFT JOIN (SELECT encounter_id, {', '.join(f'MIN(CASE WHEN concept_id = {k} THEN TRY_CAST(value AS INTEGER) END) AS {n}' for n, k in _moh.items())}, MIN(CASE WHEN concept_id = 5096 THEN TRY_CAST(value AS DATE) END) AS rtc FROM mohq GROUP BY 1) m ON m.encounter_id = s.encounter_id"""
SHARED["moh1"] = f"""
SELECT *, CAST(SUM(CASE WHEN encounter_type NOT IN (5, 6, 7, 8, 9, 21) THEN 1 ELSE 0 END) {UPTO} AS BIGINT) AS visit_num, {locf('rtc')} AS cur_rtc_date, SUM(negative) {UPTO} AS nseg,
 SUM(CASE WHEN beg = 1 OR stop = 1 THEN 1 ELSE 0 END) {UPTO} AS aseg, SUM(CASE WHEN any_drug IS NOT NULL OR stop = 1 THEN 1 ELSE 0 END) {UPTO} AS mseg FROM moh0"""


@check(
    "m39_moh_indicators",
    "M39 B12 G3 G4 G5 G6",
    f"""SELECT person_id, encounter_id, encounter_date, visit_num, LAG(cur_rtc_date) {ROW} AS prev_rtc_date, cur_rtc_date, CASE WHEN transfer_care IN (1287, 9068) OR care IN (1287, 9068) THEN 1 END AS transfer_out,
      {soft_of('positive = 1 AND negative = 0', 'encounter_date', 'nseg')} AS hiv_start_date,
      COALESCE({held('beg = 1', 'encounter_date', 'aseg')}, {soft_of('any_drug IS NOT NULL AND beg = 0 AND stop = 0', 'encounter_date', 'aseg')}) AS arv_start_date, {held('stop = 0', 'any_drug', 'mseg')} AS cur_arv_meds FROM moh1""",
)
def moh(t: Tables) -> DataFrame:
    return lg.moh_indicators(t)


SHARED["retq"] = answer_rows_sql([(5096, "date", 0)] * 3 + [(1502, "date", 0), (1777, "date", 0), (1285, "coded", 1287), (1596, "coded", 1594), (9082, "coded", 6101)])


@check(
    "m40_retention",
    "M40 B12 F16 G2 G10 E14",
    f"""WITH w AS (SELECT encounter_id, MIN(CASE WHEN concept_id IN (5096, 1502, 1777) THEN TRY_CAST(value AS DATE) END) AS rtc, MIN(CASE WHEN concept_id = 1285 THEN CAST(value AS INTEGER) END) AS transfer_care,
       MIN(CASE WHEN concept_id = 1596 THEN CAST(value AS INTEGER) END) AS reason_exited_care, MIN(CASE WHEN concept_id = 9082 THEN CAST(value AS INTEGER) END) AS programme_status FROM retq GROUP BY 1),
     x AS (SELECT s.*, w.rtc, transfer_care, reason_exited_care, programme_status FROM spine s LEFT JOIN w ON w.encounter_id = s.encounter_id),
     i AS (SELECT person_id, COALESCE(MIN(CASE WHEN identifier_type = 8 THEN identifier END), MIN(CASE WHEN identifier_type = 3 THEN identifier END), MIN(CASE WHEN identifier_type = 7 THEN identifier END)) AS identifier FROM patient_identifier GROUP BY 1),
     h AS (SELECT person_id, location_id AS health_center, ROW_NUMBER() OVER (PARTITION BY person_id ORDER BY COUNT(*) DESC, location_id) AS rn FROM spine GROUP BY 1, 2),
     a AS (SELECT person_id, MAX(value) AS phone_number FROM person_attribute WHERE attribute_type_id = 10 GROUP BY 1),
     y AS (SELECT *, LAG(rtc) {ROW} AS prev_rtc_date, LEAD(encounter_date) {ROW} AS next_appt_date, LEAD(encounter_type) {ROW} AS next_encounter_type, FIRST_VALUE(CASE WHEN is_clinical = 1 THEN encounter_date END IGNORE NULLS) {AFTER} AS next_hiv_clinic_date FROM x)
    SELECT y.person_id, encounter_id, encounter_date, rtc AS rtc_date, prev_rtc_date, next_appt_date, next_encounter_type, next_hiv_clinic_date, transfer_care, reason_exited_care, programme_status, identifier, health_center, phone_number
    FROM y LEFT JOIN i ON i.person_id = y.person_id LEFT JOIN h ON h.person_id = y.person_id AND h.rn = 1 LEFT JOIN a ON a.person_id = y.person_id""",
)
def retention(t: Tables) -> DataFrame:
    return lg.retention(t)


def _domain(domain: str) -> None:
    spec = lg.DOMAINS[domain]
    firsts = [f"MIN(CASE WHEN concept_id = {k} THEN value END) AS {n}" for n, k in spec["first"].items()]
    alls = [f"STRING_AGG(CASE WHEN concept_id = {k} THEN value END, ' // ' ORDER BY value) AS {n}" for n, k in spec["all"].items()]

    @check(f"m41_pivot_{domain}", "M41 B12 B13", f"SELECT encounter_id, {', '.join(firsts + alls)} FROM domq GROUP BY encounter_id", views={"domq": answer_rows_sql(lg.domain_questions(domain))})
    def run(t: Tables) -> DataFrame:
        return lg.domain_pivot(t, domain)


for _d in lg.DOMAINS:
    _domain(_d)

# Rules

SHARED["rl"] = """
SELECT s.*, p.death_date, p.birthdate, p.gender, DATE '2000-12-31' AS pe, DATE '2000-12-01' AS ps, LEAD(vl) OVER (PARTITION BY s.person_id ORDER BY encounter_date, day_rank, encounter_id) AS vl_2,
 LEAD(vl_date) OVER (PARTITION BY s.person_id ORDER BY encounter_date, day_rank, encounter_id) AS vl_2_date FROM spine s JOIN person p ON p.person_id = s.person_id"""


def _rule_rows(t: Tables) -> DataFrame:
    df = by_timeline(measured(t), lambda x, line: line.scan(x, vl_2=following(c("vl")), vl_2_date=following(c("vl_date"))), t.hot_persons, tasks=t.tasks())
    day = lambda s: F.lit(s).cast("date")
    return df.join(t.person.select("person_id", "death_date", "birthdate", "gender"), "person_id").withColumn("pe", day("2000-12-31")).withColumn("ps", day("2000-12-01"))


_late = "pe - COALESCE(rtc_date, encounter_date + 30)"


def _status_sql(late: str, cuts: list) -> str:
    return f"CASE WHEN {late} IS NULL THEN 'unknown' " + " ".join(f"WHEN {late} <= {n} THEN '{s}'" for n, s in cuts) + " ELSE 'ltfu' END"


@check(
    "n01_care_status",
    "N1 N2 N3",
    f"""SELECT encounter_id, CASE WHEN death_date < ps THEN 'dead' ELSE {_status_sql(_late, rules.MONTHLY_CUTS)} END AS monthly, {_status_sql('pe - rtc_date', rules.WEEKLY_CUTS)} AS weekly,
      {_status_sql('pe - rtc_date', rules.PREP_CUTS)} AS prep, {_status_sql('pe - vl_date', rules.CARE_MODEL_CUTS)} AS pickup FROM rl""",
)
def care_status(t: Tables) -> DataFrame:
    df = _rule_rows(t)
    by_rtc = F.datediff("pe", "rtc_date")
    return df.select(
        "encounter_id",
        rules.care_status(c("pe"), c("encounter_date"), c("rtc_date"), c("death_date"), F.lit(None).cast("date"), rules.MONTHLY_CUTS, c("ps")).alias("monthly"),
        rules.status_by_days(by_rtc, rules.WEEKLY_CUTS).alias("weekly"),
        rules.status_by_days(by_rtc, rules.PREP_CUTS).alias("prep"),
        rules.status_by_days(F.datediff("pe", "vl_date"), rules.CARE_MODEL_CUTS).alias("pickup"),
    )


@check(
    "n05_visit_adherence",
    "N5",
    """SELECT encounter_id, CASE WHEN rtc_date IS NULL AND vl_date IS NOT NULL THEN 'unscheduled' WHEN vl_date IS NULL AND rtc_date <= pe THEN 'missed' WHEN vl_date IS NULL THEN 'not due' WHEN ABS(vl_date - rtc_date) <= 7 THEN 'on schedule'
      WHEN vl_date < rtc_date THEN 'early' ELSE 'late' END AS adherence FROM rl""",
)
def adherence(t: Tables) -> DataFrame:
    return _rule_rows(t).select("encounter_id", rules.visit_adherence(c("vl_date"), c("rtc_date"), c("pe"), 7).alias("adherence"))


_art, _vl = months("encounter_date", "pe"), months("vl_date", "pe")
_r1, _r2 = f"(vl > 1000 AND vl_date > encounter_date AND {_vl} BETWEEN 3 AND 11)", f"({_art} BETWEEN 6 AND 11 AND vl IS NULL)"
_r3, _r4 = f"({_art} BETWEEN 12 AND 18 AND vl_2 IS NULL)", f"({_art} >= 12 AND COALESCE({_vl} >= 12, TRUE))"


@check(
    "n06_viral_load_due",
    "N6",
    f"""SELECT encounter_id, CASE WHEN {_r1} OR {_r2} OR {_r3} OR {_r4} THEN 1 ELSE 0 END AS due_for_vl,
      CASE WHEN {_r1} THEN 'Previous VL Unsuppressed' WHEN {_r2} THEN 'On ART for 6 months' WHEN {_r3} THEN 'On ART for 12 months' WHEN {_r4} THEN 'Annual VL' END AS reason_for_needing_vl,
      CASE WHEN {_r1} THEN {_vl} - 3 WHEN {_r2} THEN {_art} - 6 WHEN {_r3} THEN {_art} - 12 WHEN {_r4} THEN {months('COALESCE(vl_date, encounter_date)', 'pe')} - 12 END AS months_needed_vl FROM rl""",
)
def vl_due(t: Tables) -> DataFrame:
    out = rules.vl_due(c("pe"), c("encounter_date"), c("vl"), c("vl_date"), c("vl_2"))
    return _rule_rows(t).select("encounter_id", *[v.alias(k) for k, v in out.items()])


@check(
    "n07_suppression",
    "N7",
    "SELECT encounter_id, CASE WHEN vl < 1000 THEN 1 ELSE 0 END AS monthly, CASE WHEN vl <= 400 THEN 1 ELSE 0 END AS weekly, CASE WHEN vl < 400 THEN 1 ELSE 0 END AS daily, CASE WHEN vl < 401 THEN 1 ELSE 0 END AS care_model FROM rl",
)
def suppression(t: Tables) -> DataFrame:
    bit = lambda test: F.when(test, 1).otherwise(0)
    v = c("vl")
    return _rule_rows(t).select(
        "encounter_id",
        bit(rules.suppressed(v)).alias("monthly"),
        bit(rules.suppressed(v, 400, True)).alias("weekly"),
        bit(rules.suppressed(v, 400)).alias("daily"),
        bit(rules.suppressed(v, 401)).alias("care_model"),
    )


@check(
    "n08_art_cohorts",
    "N8",
    f"""SELECT encounter_id, {_art} AS art_cohort_total_months, CASE WHEN MONTH(encounter_date) = 12 AND plan IS DISTINCT FROM 1260 THEN {years('encounter_date', 'pe')} END AS art_cohort_num,
      CASE WHEN MONTH(encounter_date) = 12 AND plan IS DISTINCT FROM 1260 AND {years('encounter_date', 'pe')} = 1 THEN 1 ELSE 0 END AS net_12_month_cohort_this_month FROM rl""",
)
def cohorts(t: Tables) -> DataFrame:
    state = F.when(c("plan") == 1260, "transfer_out").otherwise("active")
    out = rules.art_cohort(c("pe"), c("encounter_date"), state)
    return _rule_rows(t).select("encounter_id", *[v.alias(k) for k, v in out.items()])


_q = f"((vl >= 1000 AND {_vl} BETWEEN 3 AND 12) OR (vl_2 >= 1000 AND {months('vl_2_date', 'pe')} BETWEEN 3 AND 12))"
_g = f"({_q} AND {months('vl_2_date', 'vl_date')} < 12)"
_n = f"({_g} AND vl_date BETWEEN ps AND pe)"


@check(
    "n09_follow_up_chain",
    "N9",
    f"""SELECT encounter_id, CASE WHEN {_q} THEN 1 ELSE 0 END AS qualifies_for_follow_up_vl, CASE WHEN {_g} THEN 1 ELSE 0 END AS got_follow_up_vl, CASE WHEN {_n} THEN 1 ELSE 0 END AS got_follow_up_vl_this_month,
      CASE WHEN {_g} THEN vl_date - vl_2_date END AS num_days_to_follow_vl, CASE WHEN {_g} AND vl < 1000 THEN 1 ELSE 0 END AS follow_up_vl_suppressed, CASE WHEN {_n} AND vl < 1000 THEN 1 ELSE 0 END AS follow_up_vl_suppressed_this_month,
      CASE WHEN {_g} AND vl >= 1000 THEN 1 ELSE 0 END AS follow_up_vl_unsuppressed, CASE WHEN {_n} AND vl >= 1000 THEN 1 ELSE 0 END AS follow_up_vl_unsuppressed_this_month FROM rl""",
)
def follow_up(t: Tables) -> DataFrame:
    out = rules.follow_up_vl(c("pe"), c("vl"), c("vl_date"), c("vl_2"), c("vl_2_date"), c("ps"))
    return _rule_rows(t).select("encounter_id", *[v.alias(k) for k, v in out.items()])


@check(
    "n10_differentiated_care",
    "N10 N14",
    f"""SELECT encounter_id, CASE WHEN {years('birthdate', 'pe')} >= 20 AND {_art} >= 12 AND vl <= 400 AND pe - vl_date <= 365 AND COALESCE(weight / 3, 18.5) >= 18.5 AND gender = 'M' THEN 1 ELSE 0 END AS eligible,
      CASE WHEN plan = 1256 AND {months('encounter_date', 'pe')} <= 6 THEN 1 ELSE 0 END AS away_6 FROM rl""",
)
def differentiated(t: Tables) -> DataFrame:
    from caretrail.functions.dates import months_between, years_between

    df = _rule_rows(t)
    eligible = rules.differentiated_care(
        years_between(c("birthdate"), c("pe")), months_between(c("encounter_date"), c("pe")), c("vl"), F.datediff("pe", "vl_date"), c("weight") / 3, F.when(c("gender") == "F", 1).otherwise(0)
    )
    away = rules.within_months(F.when(c("plan") == 1256, 1), c("encounter_date"), c("pe"), 6)
    return df.select("encounter_id", eligible.alias("eligible"), away.alias("away_6"))


# Extracts and episodes

EXTRACTS = {"on_treatment": [(1250, None)], "started": [(1255, [1256])], "stopped": [(1255, [1107, 1260])], "weighed": [(5089, None)], "any_plan": [(1255, None)]}


@check(
    "p01_concept_extracts",
    "P1",
    """SELECT x.extract, person_id, encounter_id, concept_id, obs_date, value_coded, value_numeric FROM obs JOIN (VALUES ('on_treatment', 1250, NULL), ('started', 1255, 1256), ('stopped', 1255, 1107), ('stopped', 1255, 1260), ('weighed', 5089, NULL), ('any_plan', 1255, NULL)) AS x(extract, k, a)
      ON x.k = concept_id AND (x.a IS NULL OR x.a = value_coded) WHERE voided = 0""",
)
def extracts(t: Tables) -> DataFrame:
    return ep.concept_extract(live(t.obs), EXTRACTS)


@check(
    "p02_first_and_last_event",
    "P2 H6 G21",
    "SELECT person_id, concept_id, MIN(obs_date) AS first_obs_date, MAX(obs_date) AS last_obs_date, COUNT(*) AS events FROM obs WHERE voided = 0 AND concept_id IN (1250, 1255) GROUP BY 1, 2",
)
def first_last(t: Tables) -> DataFrame:
    rows = live(t.obs).filter(c("concept_id").isin(1250, 1255))
    return ep.first_and_last(rows, ["person_id", "concept_id"], "obs_date", ["encounter_id"])


@check(
    "p03_treatment_episodes",
    "P3 G4 I7",
    f"""WITH e AS (SELECT person_id, encounter_date, day_rank, encounter_id, CASE WHEN plan IN (1107, 1260) THEN 1 ELSE 0 END AS stops, CAST(drug AS VARCHAR) AS regimen FROM spine),
     a AS (SELECT *, SUM(CASE WHEN stops = 1 OR regimen IS NOT NULL THEN 1 ELSE 0 END) {UPTO} AS seg FROM e), b AS (SELECT *, {held('stops = 0', 'regimen', 'seg')} AS cur FROM a),
     d AS (SELECT *, CASE WHEN LAG(cur) {ROW} IS DISTINCT FROM cur THEN 1 ELSE 0 END AS start, LEAD(encounter_date) {ROW} AS nx FROM b), f AS (SELECT *, CAST(SUM(start) {UPTO} AS BIGINT) AS episode FROM d)
    SELECT person_id, episode, cur AS regimen, MIN(encounter_date) AS started, MAX(nx) AS ended, COUNT(*) AS reports FROM f WHERE cur IS NOT NULL GROUP BY 1, 2, 3""",
)
def treatment_episodes(t: Tables) -> DataFrame:
    rows = measured(t).withColumn("stops", F.when(c("plan").isin(1107, 1260), 1).otherwise(0)).withColumn("regimen", c("drug").cast("string"))
    return by_timeline(rows, ep.drug_episodes, t.hot_persons, tasks=t.tasks())


@check(
    "p05_mothers_on_treatment",
    "P5 E12",
    """WITH mo AS (SELECT r.person_b AS person_id, MIN(r.person_a) AS mother_id FROM relationship r JOIN person m ON m.person_id = r.person_a AND m.gender = 'F' GROUP BY 1), f AS (SELECT person_id, MIN(encounter_date) AS first_drug FROM spine WHERE drug IS NOT NULL GROUP BY 1)
    SELECT mo.person_id, mother_id, first_drug AS mother_first_drug, CASE WHEN first_drug IS NOT NULL THEN 1 ELSE 0 END AS mother_on_arvs FROM mo LEFT JOIN f ON f.person_id = mother_id""",
)
def mothers_on_treatment(t: Tables) -> DataFrame:
    first = measured(t).filter("drug IS NOT NULL").groupBy(c("person_id").alias("mother_id")).agg(F.min("encounter_date").alias("mother_first_drug"))
    pairs = joins.mothers(t.person.select("person_id"), t.relationship, t.person).filter("mother_id IS NOT NULL")
    return pairs.join(first, "mother_id", "left").withColumn("mother_on_arvs", F.when(c("mother_first_drug").isNotNull(), 1).otherwise(0))


@check(
    "p06_first_event_crosstab",
    "P6 G21 F13",
    """WITH f AS (SELECT person_id, MIN(encounter_date) AS first_stop FROM spine WHERE plan IN (1107, 1260) GROUP BY 1)
    SELECT YEAR(first_stop) AS year, gender, COUNT(CASE WHEN population_type = 'BUILDING' THEN 1 END) AS n_BUILDING, COUNT(CASE WHEN population_type = 'MACHINERY' THEN 1 END) AS n_MACHINERY FROM f JOIN person USING (person_id) GROUP BY 1, 2""",
)
def first_event_crosstab(t: Tables) -> DataFrame:
    first = measured(t).filter(c("plan").isin(1107, 1260)).groupBy("person_id").agg(F.min("encounter_date").alias("first_stop"))
    rows = first.join(t.person.select("person_id", "gender", "population_type"), "person_id").withColumn("year", F.year("first_stop"))
    return agg.crosstab(rows, ["year", "gender"], "population_type", ["BUILDING", "MACHINERY"])


@check(
    "p07_site_month_counts",
    "P7",
    "SELECT location_id, CAST(DATE_TRUNC('month', encounter_date) AS DATE) AS month, COUNT(*) AS visits, COUNT(DISTINCT person_id) AS patients FROM encounter WHERE voided = 0 GROUP BY 1, 2",
)
def site_months(t: Tables) -> DataFrame:
    rows = live(t.encounter).withColumn("month", F.trunc("encounter_date", "month").cast("date"))
    per_person = rows.groupBy("location_id", "month", "person_id").agg(F.count(F.lit(1)).alias("n"))
    return per_person.groupBy("location_id", "month").agg(F.sum("n").alias("visits"), F.count(F.lit(1)).alias("patients"))

