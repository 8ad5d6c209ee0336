"""Form datasets against SQL written from the same specs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from caretrail.checks.care_sql import AFTER, BEFORE, ROW, UPTO, first, held, locf, months, soft, years
from caretrail.checks.registry import check
from caretrail.functions.regimens import CHEMO
from caretrail.operators.forms import RETURN_DAY, Form, Question
from caretrail.plans import form_datasets as fd
from caretrail.sources.tables import Tables
from caretrail.sources.views import answer_rows_sql
from caretrail.specs.forms import FORMS

TYPES = ", ".join(map(str, fd.STAND_IN_TYPES))
CLINICAL = "CASE WHEN is_clinical = 1 THEN encounter_date END"
AGE = f"CASE WHEN {years('birthdate', 'encounter_date')} > 0 THEN CAST({years('birthdate', 'encounter_date')} AS DOUBLE) ELSE ROUND({months('birthdate', 'encounter_date')} / 12.0, 2) END"


def clinical(value: str, look: str, frame: str) -> str:
    """Value on the nearest clinical row, null where that has none."""
    return f"({look}(CASE WHEN is_clinical = 1 THEN {{'v': {value}}} END IGNORE NULLS) {frame}).v"


def column_sql(q: Question) -> str:
    if q.kind == "num":
        return f"MIN(CASE WHEN concept_id = {q.concept} THEN TRY_CAST(value AS DOUBLE) END)"
    if q.kind == "date":
        return f"MIN(CASE WHEN concept_id = {q.concept} THEN TRY_CAST(value AS DATE) END)"
    if q.kind == "day":
        return f"MIN(CASE WHEN concept_id = {q.concept} THEN obs_date END)"
    if q.kind == "text":
        value = f"CASE WHEN concept_id = {q.concept} THEN value END"
        return f"STRING_AGG({value}, ' ## ' ORDER BY {value})"
    steps = " ".join(f"WHEN MAX(CASE WHEN concept_id = {q.concept} AND value = '{a}' THEN 1 END) = 1 THEN {n}" for a, n in q.answers)
    return f"CASE {steps} END"


def rows_sql(spec: Form, more: str = "") -> str:
    """The form's visits as a parenthesised query."""
    names = ", ".join(q.column for q in spec.questions)
    answers = ", ".join(f"{column_sql(q)} AS {q.column}" for q in spec.questions)
    return f"""(SELECT person_id, encounter_id, encounter_date, encounter_type, location_id, gender, {AGE} AS age,
      LAG(encounter_date) {ROW} AS prev_encounter_date, LAG(encounter_type) {ROW} AS prev_encounter_type, LEAD(encounter_date) {ROW} AS next_encounter_date,
      LEAD(encounter_type) {ROW} AS next_encounter_type, LAST_VALUE({CLINICAL} IGNORE NULLS) {BEFORE} AS prev_clinical_date, FIRST_VALUE({CLINICAL} IGNORE NULLS) {AFTER} AS next_clinical_date,
      {clinical('location_id', 'LAST_VALUE', BEFORE)} AS prev_clinical_location_id, {clinical('location_id', 'FIRST_VALUE', AFTER)} AS next_clinical_location_id,
      {clinical('return_on', 'LAST_VALUE', BEFORE)} AS prev_clinical_rtc_date, {clinical('return_on', 'FIRST_VALUE', AFTER)} AS next_clinical_rtc_date, {names}{more}
      FROM (SELECT s.person_id, s.encounter_id, s.encounter_date, s.encounter_type, s.location_id, s.day_rank, s.is_clinical, b.gender, b.birthdate, f.* EXCLUDE (encounter_id)
       FROM spine s JOIN person b ON b.person_id = s.person_id
       LEFT JOIN (SELECT encounter_id, {column_sql(RETURN_DAY)} AS return_on, {answers} FROM formq GROUP BY encounter_id) f ON f.encounter_id = s.encounter_id WHERE encounter_type IN ({TYPES})))"""


DETAILS = """
  LEFT JOIN (SELECT person_id, STRING_AGG(DISTINCT identifier, ', ' ORDER BY identifier) AS identifiers FROM patient_identifier GROUP BY person_id) i USING (person_id)
  LEFT JOIN (SELECT person_id, COALESCE(given_name, '') || ' ' || COALESCE(middle_name, '') || ' ' || COALESCE(family_name, '') AS person_name FROM person_name) n USING (person_id)
  LEFT JOIN (SELECT person_id, address1 AS county FROM person_address) a USING (person_id)
  LEFT JOIN (SELECT person_id, value AS phone_number FROM person_attribute WHERE attribute_type_id = 10) c USING (person_id)"""


def has(code: str) -> str:
    return f"COALESCE(list_contains(string_split(chemotherapy_plan, ' ## '), '{code}'), FALSE)"


def history_sql(spec: Form) -> str:
    """Oncology history: drugs and their start are segments of the person's visits that a plan or a drug opens."""
    names = ", ".join(q.column for q in spec.questions if q.column not in ("cancer_type_asked", "cancer_type_diagnosed"))
    subtypes = ", ".join(q.column for q in spec.questions if q.concept in (9841, 6536, 9843, 9844, 6551, 9846, 6540, 6528, 6514, 6520, 10132))
    start, stop = f"({has('1256')} OR {has('1259')})", has("1260")
    helpers = f""", day_rank, is_clinical, return_on, COALESCE(CAST(cancer_type_diagnosed AS VARCHAR), cancer_type_asked) AS cancer_type, COALESCE({subtypes}) AS cancer_subtype,
      {first("CASE WHEN encounter_type NOT IN (21, 99999) THEN encounter_date END")} AS enrollment_date, {locf('return_on')} AS known_return,
      SUM(CASE WHEN {stop} OR medication_history IS NOT NULL THEN 1 ELSE 0 END) {UPTO} AS meds_seg, SUM(CASE WHEN {start} OR {stop} THEN 1 ELSE 0 END) {UPTO} AS start_seg"""
    carried = ", ".join(f"{locf(n)} AS known_{n}" for n in ("diagnosis", "cancer_type", "cancer_subtype", "overall_cancer_stage_group"))
    soft_start = soft(f"{has('1257')} AND NOT {start} AND NOT {stop}", "encounter_date", "start_seg")
    return f"""SELECT person_id, encounter_id, encounter_date, encounter_type, location_id, gender, age, {', '.join(fd.TIMELINE)}, {names}, enrollment_date, LAG(known_return) {ROW} AS prev_rtc_date,
      COALESCE(return_on, CASE WHEN known_return > encounter_date THEN known_return END) AS rtc_date, cancer_type, cancer_subtype, {carried},
      {held('1 = 1', f'CASE WHEN NOT {stop} THEN medication_history END', 'meds_seg')} AS cur_onc_meds,
      COALESCE({held(start, 'encounter_date', 'start_seg')}, {soft_start}) AS cur_onc_meds_start_date, visit_type_id, date_started AS visit_start_date
      FROM {rows_sql(spec, helpers)} LEFT JOIN (SELECT visit_id, visit_type_id, date_started FROM visit) ON visit_id = encounter_id"""


def register(number: str, spec: Form) -> None:
    views = {"formq": answer_rows_sql(fd.questions_of(spec))}
    name = f"{number.lower()}_{spec.name}"
    ids = f"{number} C6 C10 G1 G2 G9 G10"
    if number == "M48":
        parts = ", ".join(f"({i}, '{n}', {[str(x) for x in need]}, {[str(x) for x in out] or ['-']})" for i, (n, need, out) in enumerate(CHEMO))
        drugs = "COALESCE(string_split(chemo_drugs, ' ## '), [])"
        found = f"(SELECT STRING_AGG(n, ' ## ' ORDER BY i) FROM (VALUES {parts}) AS v(i, n, need, without) WHERE list_has_all({drugs}, need) AND NOT list_has_any({drugs}, without))"

        @check(name, ids + " J8 F10 E14", f"SELECT r.*, {found} AS chemo_regimens, identifiers, person_name, county, phone_number FROM {rows_sql(spec)} r {DETAILS}", views=views)
        def myeloma(t: Tables) -> DataFrame:
            return fd.myeloma_rows(t, spec, fd.STAND_IN_TYPES)

        return
    if number == "M49":

        @check(name, ids + " G3", history_sql(spec), views=views)
        def history(t: Tables) -> DataFrame:
            return fd.history_rows(t, spec, fd.STAND_IN_TYPES)

        return

    @check(name, ids, f"SELECT * FROM {rows_sql(spec)}", views=views)
    def rows(t: Tables) -> DataFrame:
        return fd.form_rows(t, spec, fd.STAND_IN_TYPES)


for _number, _spec in FORMS.items():
    register(_number, _spec)
