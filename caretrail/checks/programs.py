"""Flat tables, visit datasets and programme timelines against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.checks.care_sql import AFTER, BEFORE, ROW, UPTO, fact_sql, facts_sql, flag_names, held, locf, named
from caretrail.checks.care_sql import _components, _names_sql  # noqa: F401
from caretrail.checks.care_sql import first as first_of
from caretrail.checks.registry import SHARED, check
from caretrail.checks.reports import DuckText, as_of, ends, staged
from caretrail.operators.flatten import answer_map
from caretrail.plans import contact as ct
from caretrail.plans import flat_tables as ft
from caretrail.plans import programs as pg
from caretrail.sources.tables import Tables, live
from caretrail.sources.views import answer_rows_sql

c = F.col


def events_cte(prefix: str, facts: dict, questions: list, where: str = "1 = 1") -> None:
    """CTEs of spine encounters with facts: <prefix>q, <prefix>f, <prefix>e."""
    SHARED[f"{prefix}q"] = answer_rows_sql(questions)
    SHARED[f"{prefix}f"] = facts_sql(facts, f"{prefix}q")
    flags = ", ".join(f"COALESCE({n}, 0) AS {n}" for n in flag_names(facts)) or "1 AS one_"
    values = ", ".join(n for n, f in facts.items() if f[0] not in ("said", "asked", "drugs")) or "1 AS two_"
    drug = [(n, f[1][0]) for n, f in facts.items() if f[0] == "drugs"]
    joins = "".join(
        f""" LEFT JOIN (SELECT encounter_id, STRING_AGG(comp, ' ## ' ORDER BY ord) AS {n}_text FROM (SELECT DISTINCT encounter_id, ord, comp FROM {prefix}q
        JOIN (SELECT * FROM (VALUES {_components}) AS v(code, ord, comp)) k ON k.code = value WHERE concept_id = {k}) GROUP BY 1) d_{n} ON d_{n}.encounter_id = e.encounter_id"""
        for n, k in drug
    )
    texts = "".join(f", {n}_text" for n, _ in drug)
    SHARED[f"{prefix}e"] = f"""
SELECT e.encounter_id, e.person_id, e.encounter_date, e.encounter_type, e.location_id, CASE e.encounter_type WHEN 116 THEN 20 WHEN 21 THEN 1 ELSE 10 END AS day_rank,
 CASE WHEN e.encounter_type IN (1, 2, 14) THEN 1 ELSE 0 END AS is_clinical, p.gender, p.birthdate, p.death_date AS person_death, {flags}, {values}{texts}
FROM encounter e JOIN person p ON p.person_id = e.person_id AND p.voided = 0 AND p.is_test = 0 LEFT JOIN {prefix}f f ON f.encounter_id = e.encounter_id{joins} WHERE e.voided = 0 AND {where}"""


# Flat tables


@check(
    "m01_flat_obs",
    "M1",
    """SELECT e.person_id, e.encounter_id, e.encounter_date, e.encounter_type, e.location_id, STRING_AGG('!!' || concept_id || '=' || value || '!!', ' ## ' ORDER BY concept_id, COALESCE(value_coded, -1), value) AS obs, MAX(obs_date) AS max_date_created
      FROM encounter e JOIN tall t ON t.encounter_id = e.encounter_id AND value IS NOT NULL WHERE e.voided = 0 GROUP BY 1, 2, 3, 4, 5""",
)
def flat_obs(t: Tables) -> DataFrame:
    return ft.flat_obs(t).drop("obs_datetimes")


LAB_QUESTIONS = [(k, "number", 3 if kind != "text" else 1) for _, k, kind in ft.LAB_COLUMNS if k != 2322] + [
    (9239, "coded", 856), (9239, "coded", 5497), (9239, "coded", 1030), (1271, "coded", 856), (1271, "coded", 1107), (9434, "coded", 7469), (9590, "coded", 7469), (12, "coded", 1107), (2322, "coded", 703),
]


def _lab_sql(name: str, concept: int, kind) -> str:
    values = f"CASE WHEN concept_id = {concept} THEN value END"
    if kind == "text":
        return f"STRING_AGG({values}, ' ## ' ORDER BY {values}) AS {name}"
    number = f"TRY_CAST(MIN({values}) AS DOUBLE)"
    if kind == "int":
        return f"CAST(FLOOR({number}) AS BIGINT) AS {name}"
    return f"CASE WHEN ABS(ROUND({number}, {kind[1]})) < {10 ** (kind[0] - kind[1])} THEN ROUND({number}, {kind[1]}) END AS {name}"


def _flag_sql(name: str, code: int) -> str:
    return f"MAX(CASE WHEN concept_id = 9239 AND value = '{code}' THEN 1 END) AS {name}"


@check(
    "m04_flat_labs_and_imaging",
    "M4 C9 C12 C14 C15 Z9 Z10",
    f"""WITH r AS (SELECT encounter_id, {', '.join(_lab_sql(*x) for x in ft.LAB_COLUMNS if x[0] != 'chest_xray')},
      CASE WHEN MAX(CASE WHEN concept_id = 12 AND value = '1107' THEN 1 ELSE 0 END) = 0 THEN CAST(FLOOR(TRY_CAST(MIN(CASE WHEN concept_id = 12 THEN value END) AS DOUBLE)) AS BIGINT) END AS chest_xray,
      CAST(COALESCE(MIN(CASE WHEN concept_id = 9434 THEN value END), MIN(CASE WHEN concept_id = 9590 THEN value END)) AS BIGINT) AS via_or_via_vili,
      STRING_AGG(CASE WHEN concept_id = 9239 THEN value END, ' ## ' ORDER BY CASE WHEN concept_id = 9239 THEN value END) AS has_errors, {', '.join(_flag_sql(n, k) for n, k in ft.LAB_ERRORS.items())} FROM labq GROUP BY encounter_id),
     o AS (SELECT encounter_id, STRING_AGG(x, ' ## ' ORDER BY x) AS tests_ordered FROM (SELECT DISTINCT q.encounter_id, q.value AS x FROM labq q WHERE concept_id = 1271 UNION SELECT encounter_id, CAST(concept_id AS VARCHAR) FROM clinical_order WHERE encounter_id IN (SELECT encounter_id FROM labq)) GROUP BY 1)
    SELECT r.*, COALESCE(o.tests_ordered, '') AS tests_ordered FROM r LEFT JOIN o ON o.encounter_id = r.encounter_id""",
    views={"labq": answer_rows_sql(LAB_QUESTIONS)},
)
def labs_and_imaging(t: Tables) -> DataFrame:
    answers = answer_map(t.answers(LAB_QUESTIONS), ["encounter_id"])
    orders = ft.flat_orders(t).select("encounter_id", "order_concepts")
    return ft.lab_rows(answers, orders, ["encounter_id"])


VITAL_QUESTIONS = [(k, "number", 2) for _, k, _ in ft.VITAL_COLUMNS] + [(6042, "coded", 1)] * 3


@check(
    "m06_flat_vitals",
    "M6 C9",
    f"""SELECT e.encounter_id, e.person_id, e.encounter_date, e.location_id, {', '.join(n for n, _, _ in ft.VITAL_COLUMNS)} FROM encounter e JOIN (SELECT encounter_id, {', '.join(_lab_sql(*x) for x in ft.VITAL_COLUMNS)}
      FROM vitq WHERE concept_id <> 6042 GROUP BY 1) v ON v.encounter_id = e.encounter_id WHERE e.voided = 0""",
    views={"vitq": answer_rows_sql(VITAL_QUESTIONS)},
)
def vitals(t: Tables) -> DataFrame:
    answers = answer_map(t.answers(VITAL_QUESTIONS), ["encounter_id"], [k for _, k, _ in ft.VITAL_COLUMNS])
    return ft.vitals(live(t.encounter).join(answers, "encounter_id"))


NUTRITION_QUESTIONS = [(k, "number", 1) for _, k, _ in ft.NUTRITION_COLUMNS] + [(k, "coded", a) for k, table in ft.NUTRITION_LABELS.values() for a in table]


def _label_sql(name: str, concept: int, table: dict) -> str:
    coded = f"STRING_AGG(CASE WHEN concept_id = {concept} THEN value END, ' ## ' ORDER BY CASE WHEN concept_id = {concept} THEN value END) AS {name}_coded"
    steps = " ".join(f"WHEN MAX(CASE WHEN concept_id = {concept} AND value = '{a}' THEN 1 END) = 1 THEN '{label}'" for a, label in table.items())
    return f"{coded}, CASE {steps} END AS {name}_value"


@check(
    "m07_flat_nutrition",
    "M7 C10",
    f"""SELECT e.encounter_id, ANY_VALUE(e.person_id) AS person_id, {', '.join(_lab_sql(*x) for x in ft.NUTRITION_COLUMNS)}, {', '.join(_label_sql(n, k, tab) for n, (k, tab) in ft.NUTRITION_LABELS.items())}
      FROM encounter e JOIN nutq q ON q.encounter_id = e.encounter_id WHERE e.voided = 0 GROUP BY e.encounter_id""",
    views={"nutq": answer_rows_sql(NUTRITION_QUESTIONS)},
)
def nutrition(t: Tables) -> DataFrame:
    return ft.nutrition(live(t.encounter).join(answer_map(t.answers(NUTRITION_QUESTIONS), ["encounter_id"]), "encounter_id"))


# Visits and follow-up

_CLIN = "CASE WHEN encounter_type IN (1, 2, 14) THEN encounter_date END"


@check(
    "m12_derived_encounter",
    "M12 G1 G2 G9 G10",
    f"""SELECT encounter_id, person_id, encounter_date, LAG(encounter_date) {ROW} AS prev_encounter_date, LAG(encounter_type) {ROW} AS prev_encounter_type, LEAD(encounter_date) {ROW} AS next_encounter_date, LEAD(encounter_type) {ROW} AS next_encounter_type,
      LAST_VALUE({_CLIN} IGNORE NULLS) {BEFORE} AS prev_clinic_date, FIRST_VALUE({_CLIN} IGNORE NULLS) {AFTER} AS next_clinic_date
      FROM (SELECT *, CASE encounter_type WHEN 116 THEN 20 WHEN 21 THEN 1 ELSE 10 END AS day_rank FROM encounter WHERE voided = 0)""",
)
def derived_encounter(t: Tables) -> DataFrame:
    return ct.derived_encounter(t)


def _case(table: dict, key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {k} THEN {v}" for k, v in table.items()) + " END"


def _level(prefix: str, part: str) -> str:
    o = f"(PARTITION BY {part} ORDER BY encounter_date, encounter_id)"
    before = f"(PARTITION BY {part} ORDER BY encounter_date, encounter_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    after = f"(PARTITION BY {part} ORDER BY encounter_date, encounter_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    box = "CASE WHEN is_clinical = 1 THEN {'v': cur_rtc_date} END IGNORE NULLS"
    out = []
    for name, col in (("encounter_date", "encounter_date"), ("encounter_type", "encounter_type"), ("rtc_date", "cur_rtc_date")):
        out += [f"LAG({col}) OVER {o} AS prev_{prefix}{name}", f"LEAD({col}) OVER {o} AS next_{prefix}{name}"]
    out += [
        f"LAST_VALUE({_CLIN} IGNORE NULLS) OVER {before} AS prev_{prefix}clinical_date",
        f"FIRST_VALUE({_CLIN} IGNORE NULLS) OVER {after} AS next_{prefix}clinical_date",
        f"(LAST_VALUE({box}) OVER {before}).v AS prev_{prefix}clinical_rtc_date",
        f"(FIRST_VALUE({box}) OVER {after}).v AS next_{prefix}clinical_rtc_date",
    ]
    return ", ".join(out)


SHARED["apq"] = answer_rows_sql(ct.APPOINTMENT_QUESTIONS)
SHARED["ap0"] = f"""
SELECT e.*, v.visit_type_id, f.rtc, f.med_rtc AS cur_med_rtc_date, CASE WHEN e.encounter_type IN (1, 2, 14) THEN 1 ELSE 0 END AS is_clinical,
 CASE WHEN v.visit_type_id IS NOT NULL THEN {_case(ct.PROGRAM_OF_VISIT, 'v.visit_type_id')} ELSE {_case(ct.PROGRAM_OF_TYPE, 'e.encounter_type')} END AS program_id
FROM encounter e LEFT JOIN visit v ON v.visit_id = e.encounter_id LEFT JOIN (SELECT encounter_id, {fact_sql(*ct.APPOINTMENT_FACTS['rtc'])} AS rtc, {fact_sql(*ct.APPOINTMENT_FACTS['med_rtc'])} AS med_rtc FROM apq GROUP BY 1) f ON f.encounter_id = e.encounter_id WHERE e.voided = 0"""
_AU = "(PARTITION BY person_id ORDER BY encounter_date, encounter_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
SHARED["ap1"] = f"""
SELECT *, {_case(ct.DEPARTMENT_OF_PROGRAM, 'program_id')} AS department_id, COALESCE(rtc, CASE WHEN LAST_VALUE(rtc IGNORE NULLS) OVER {_AU} > encounter_date THEN LAST_VALUE(rtc IGNORE NULLS) OVER {_AU} END) AS cur_rtc_date,
 LAST_VALUE(CASE WHEN COALESCE(visit_type_id, 0) NOT IN (23, 24, 119, 124) THEN location_id END IGNORE NULLS) OVER {_AU} AS held_location_id FROM ap0"""


@check(
    "m13_appointments",
    "M13 G16 G17",
    f"""SELECT {', '.join(ct.appointment_columns())} FROM (SELECT *, {_level('', 'person_id')}, {_level('program_', 'person_id, program_id')}, {_level('department_', 'person_id, department_id')},
      LAG(held_location_id) OVER (PARTITION BY person_id ORDER BY encounter_date, encounter_id) AS prev_location_id FROM ap1)""",
)
def appointments(t: Tables) -> DataFrame:
    return ct.appointments(t).select(*ct.appointment_columns())


@check(
    "m14_appointment_schedule",
    "M14 I2",
    """SELECT encounter_id, person_id, cur_rtc_date AS scheduled_date, 1 AS is_general, CASE WHEN cur_rtc_date = cur_med_rtc_date THEN 1 ELSE 0 END AS is_med_pickup FROM ap1 WHERE cur_rtc_date IS NOT NULL
      UNION SELECT encounter_id, person_id, cur_med_rtc_date, 0, 1 FROM ap1 WHERE cur_med_rtc_date IS NOT NULL AND cur_med_rtc_date IS DISTINCT FROM cur_rtc_date""",
)
def schedule(t: Tables) -> DataFrame:
    return ct.appointment_schedule(ct.appointments(t))


NAME = "COALESCE(given_name, '') || ' ' || COALESCE(middle_name, '') || ' ' || COALESCE(family_name, '')"
FILE = "CASE WHEN identifier_type = 8 THEN SUBSTRING(identifier, 8, 2) || '-' || SUBSTRING(identifier, 6, 2) || '-' || SUBSTRING(identifier, 4, 2) || '-' || SUBSTRING(identifier, 2, 2) || '-' || SUBSTRING(identifier, 1, 1) END"


@check(
    "m15_defaulters",
    "M15 G2 E14 F10 D6 J24",
    f"""WITH l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY person_id ORDER BY encounter_date DESC, day_rank DESC, encounter_id DESC) AS rn FROM spine WHERE encounter_date <= DATE '2001-06-30'),
     i AS (SELECT person_id, STRING_AGG(DISTINCT identifier, ', ' ORDER BY identifier) AS identifiers, STRING_AGG(DISTINCT {FILE}, ', ' ORDER BY {FILE}) AS filed_id FROM patient_identifier GROUP BY person_id),
     a AS (SELECT person_id, MAX(value) AS phone_number FROM person_attribute WHERE attribute_type_id = 10 GROUP BY person_id)
    SELECT l.person_id, l.encounter_id, l.location_id, l.encounter_date, l.rtc_date, DATE '2001-06-30' - COALESCE(rtc_date, encounter_date + 90) AS days_since_rtc, {NAME} AS person_name, phone_number, identifiers, filed_id
    FROM l JOIN person p ON p.person_id = l.person_id AND p.death_date IS NULL LEFT JOIN person_name n ON n.person_id = l.person_id LEFT JOIN a ON a.person_id = l.person_id LEFT JOIN i ON i.person_id = l.person_id
    WHERE rn = 1 AND is_clinical = 1 AND encounter_type NOT IN (110, 116) AND COALESCE(rtc_date, encounter_date + 90) < DATE '2001-06-30'""",
)
def defaulters(t: Tables) -> DataFrame:
    return ct.defaulters(t, "2001-06-30")


_LATEST = "ROW_NUMBER() OVER (PARTITION BY person_id ORDER BY encounter_date DESC, day_rank DESC, encounter_id DESC) AS rn"


@check(
    "m28_case_list",
    "M28 H3 E14 F10 F11",
    f"""WITH l AS (SELECT *, {_LATEST} FROM spine WHERE encounter_date > DATE '2000-06-30' AND (is_clinical = 1 OR encounter_type = 21)),
     f AS (SELECT encounter_id, {', '.join(f'{fact_sql(*v)} AS {k}' for k, v in ct.PHONE_FACTS.items())} FROM phq GROUP BY 1),
     ph AS (SELECT s.person_id, s.encounter_date AS phone_date, next_phone_appointment, phone_planned_rtc, {_LATEST.replace('encounter_date', 's.encounter_date').replace('day_rank', 's.day_rank').replace('encounter_id', 's.encounter_id').replace('person_id', 's.person_id')} FROM spine s LEFT JOIN f ON f.encounter_id = s.encounter_id WHERE encounter_type = 21),
     a AS (SELECT person_id, CAST(MAX(value) AS BIGINT) AS manager_id FROM person_attribute WHERE attribute_type_id = 68 GROUP BY person_id), nm AS (SELECT person_id, {NAME} AS person_name FROM person_name),
     i AS (SELECT person_id, STRING_AGG(DISTINCT identifier, ', ' ORDER BY identifier) AS identifiers FROM patient_identifier GROUP BY person_id)
    SELECT l.person_id, l.encounter_id, l.encounter_date, l.location_id, l.rtc_date, l.vl, phone_date, next_phone_appointment, phone_planned_rtc, COALESCE(phone_planned_rtc, rtc_date) AS effective_rtc, a.manager_id, mn.person_name AS manager_name, nm.person_name, identifiers
    FROM l JOIN nm ON nm.person_id = l.person_id LEFT JOIN ph ON ph.person_id = l.person_id AND ph.rn = 1 LEFT JOIN a ON a.person_id = l.person_id LEFT JOIN nm mn ON mn.person_id = a.manager_id LEFT JOIN i ON i.person_id = l.person_id WHERE l.rn = 1""",
    views={"phq": answer_rows_sql(ct.PHONE_QUESTIONS)},
)
def case_list(t: Tables) -> DataFrame:
    return ct.case_list(t, "2000-06-30")


events_cte("cv", ct.COVID_FACTS, ct.COVID_QUESTIONS, "e.encounter_type = 14")


@check(
    "m27_covid_screening",
    "M27 C11 H3",
    f"""WITH l AS (SELECT *, {_LATEST} FROM spine) SELECT e.encounter_id, e.person_id, e.encounter_date, e.gender, {', '.join(f'CASE WHEN {n}_yes = 1 THEN 1 WHEN {n}_no = 1 THEN 0 END AS {n}' for n in ct.COVID)},
      l.vl AS last_vl_result, l.vl_date AS last_vl_date, l.rtc_date AS next_hiv_appointment_date FROM cve e JOIN l ON l.person_id = e.person_id AND l.rn = 1""",
)
def covid(t: Tables) -> DataFrame:
    return ct.covid_screening(t)


@check(
    "m34_unrecorded_deaths",
    "M34 A9 D6 I4",
    """WITH x AS (SELECT person_id, 1 AS k FROM encounter WHERE voided = 0 AND encounter_type = 21 AND location_id = 24 UNION ALL SELECT person_id, 2 FROM deq WHERE concept_id IN (1570, 1734, 1573)
      UNION ALL SELECT person_id, 3 FROM deq WHERE concept_id IN (1733, 6206, 9082) AND value = '159')
    SELECT x.person_id, CASE MIN(k) WHEN 1 THEN 'encounter' WHEN 2 THEN 'death form' ELSE 'coded death' END AS evidence FROM x JOIN person p ON p.person_id = x.person_id AND p.death_date IS NULL
    WHERE x.person_id NOT IN (SELECT person_id FROM person_attribute WHERE attribute_type_id = 28 AND value = 'true') GROUP BY x.person_id""",
    views={"deq": answer_rows_sql(ct.DEATH_QUESTIONS)},
)
def deaths(t: Tables) -> DataFrame:
    return ct.unrecorded_deaths(t)


# Programmes


@check(
    "m11_viral_load_history",
    "M11 G13 G2",
    """WITH d AS (SELECT person_id, CAST(obs_datetime AS DATE) AS test_date, MIN(value_numeric) AS vl FROM lab_event WHERE concept_id = 856 GROUP BY 1, 2)
    SELECT person_id, test_date, vl AS vl_1, test_date AS vl_1_date, LAG(vl) OVER w AS vl_2, LAG(test_date) OVER w AS vl_2_date, LAG(vl, 2) OVER w AS vl_3, LAG(test_date, 2) OVER w AS vl_3_date, LAG(vl, 3) OVER w AS vl_4, LAG(test_date, 3) OVER w AS vl_4_date,
      LEAD(test_date) OVER w AS next_vl_date FROM d WINDOW w AS (PARTITION BY person_id ORDER BY test_date)""",
)
def vl_history(t: Tables) -> DataFrame:
    return pg.viral_load_history(t)


events_cte("he", pg.HEI_FACTS, pg.HEI_QUESTIONS)
SHARED["heday"] = "SELECT person_id, encounter_date AS day, MIN(pcr) AS pcr, ROW_NUMBER() OVER (PARTITION BY person_id ORDER BY encounter_date) AS n FROM hee WHERE pcr IS NOT NULL GROUP BY 1, 2"


def _spaced(i: int) -> tuple[str, str]:
    takes = f"v{i} IS NULL" + (f" AND v{i - 1} IS NOT NULL AND x.day - d{i - 1} > 30" if i > 1 else "")
    return f"CASE WHEN {takes} THEN CAST(x.pcr AS DOUBLE) ELSE v{i} END", f"CASE WHEN {takes} THEN x.day ELSE d{i} END"


_none = ", ".join(f"CAST(NULL AS DOUBLE) AS v{i}, CAST(NULL AS DATE) AS d{i}" for i in range(1, 5))
SHARED["hestate"] = f"""
SELECT person_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS DATE) AS day, {_none} FROM heday WHERE n = 1
UNION ALL SELECT x.person_id, x.n, x.day, {', '.join(s for i in range(1, 5) for s in _spaced(i))} FROM hestate s JOIN heday x ON x.person_id = s.person_id AND x.n = s.n + 1"""
_feeding = "CASE feeding " + " ".join(f"WHEN {k} THEN {i}" for i, k in enumerate(pg.FEEDING, 1)) + " END"
_mother = "CASE WHEN mother_lives = 1 OR mother_known = 1 THEN 1 WHEN mother_dead = 1 THEN 2 END"
SHARED["he1"] = f"""
SELECT *, {named({
    'known_rtc': locf('rtc'), 'date_enrolled': f"FIRST_VALUE(CASE WHEN first_visit = 1 THEN COALESCE(enrolled_on, encounter_date) ELSE encounter_date END) {UPTO}",
    'initial_hiv_dna_pcr_order_date': first_of('CASE WHEN pcr_ordered = 1 OR pcr IS NOT NULL THEN encounter_date END'),
    'hiv_dna_pcr_date': locf('CASE WHEN pcr_ordered = 1 OR pcr IS NOT NULL THEN encounter_date END'),
    'antibody_screen_1': first_of('antibody'), 'antibody_screen_1_date': first_of('CASE WHEN antibody IS NOT NULL THEN encounter_date END'),
    'infant_feeding_method': locf(_feeding), 'mother_alive': locf(_mother), 'mother_alive_on_child_enrollment': first_of(_mother), 'hei_outcome': locf('outcome'),
    'newborn_arv_meds': locf('prophylaxis_text'), 'death_sign': first_of('CASE WHEN died = 1 THEN encounter_date END'),
    'prev_clinical_datetime': f'LAST_VALUE({_CLIN} IGNORE NULLS) {BEFORE}', 'next_clinical_datetime': f'FIRST_VALUE({_CLIN} IGNORE NULLS) {AFTER}', 'next_encounter_datetime': f'LEAD(encounter_date) {ROW}',
})} FROM (SELECT h.*, {', '.join(f's.v{i} AS hiv_dna_pcr_{i}, s.d{i} AS hiv_dna_pcr_{i}_date' for i in range(1, 5))} FROM hee h ASOF LEFT JOIN hestate s ON s.person_id = h.person_id AND s.day <= h.encounter_date)"""
SHARED["hei"] = f"""
SELECT *, COALESCE(person_death, death_sign) AS death_date, COALESCE(rtc, CASE WHEN known_rtc > encounter_date THEN known_rtc END) AS rtc_date, LAG(known_rtc) {ROW} AS prev_rtc_date,
 {first_of('CASE WHEN encounter_date > antibody_screen_1_date THEN antibody END')} AS antibody_screen_2, {first_of('CASE WHEN antibody IS NOT NULL AND encounter_date > antibody_screen_1_date THEN encounter_date END')} AS antibody_screen_2_date FROM he1"""
_mothers = "(SELECT r.person_b, MIN(r.person_a) AS mother_id FROM relationship r JOIN person m ON m.person_id = r.person_a AND m.gender = 'F' WHERE relationship = 2 GROUP BY 1)"


@check(
    "m21_infant_summary",
    "M21 G13 G14 E12",
    f"SELECT {', '.join(pg.HEI_COLUMNS)} FROM hei LEFT JOIN {_mothers} mo ON mo.person_b = hei.person_id",
)
def infants(t: Tables) -> DataFrame:
    return pg.infant_summary(t)


_hei_rows = f"""(SELECT h.*, l.county, m.period_end, CAST(DATE_TRUNC('month', m.period_end) AS DATE) AS period_start, z.last_pcr_1_date, z.last_pcr_2_date, z.last_pcr_3_date FROM hei h
  JOIN {ends('month')} m ON h.encounter_date <= m.period_end AND (next_clinical_datetime IS NULL OR next_clinical_datetime > m.period_end)
  JOIN (SELECT person_id, hiv_dna_pcr_1_date AS last_pcr_1_date, hiv_dna_pcr_2_date AS last_pcr_2_date, hiv_dna_pcr_3_date AS last_pcr_3_date FROM hei WHERE next_encounter_datetime IS NULL) z ON z.person_id = h.person_id
  LEFT JOIN location l ON l.location_id = h.location_id WHERE is_clinical = 1)"""


@check(
    "m22_infant_monthly_report",
    "M22 E7 E11 Z7 Z8",
    f"SELECT {', '.join(pg.infant_month_columns())} FROM {staged(_hei_rows, pg.infant_rules(DuckText))}",
)
def infant_months(t: Tables) -> DataFrame:
    return pg.infant_monthly(t)


events_cte("pr", pg.PREP_FACTS, pg.PREP_QUESTIONS)
_population = "CASE " + " ".join(f"WHEN population_{n} = 1 THEN '{n}'" for n in "1234") + " END"
_sub = "CASE sub_population " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in pg.SUB_POPULATION.items()) + " END"
_leaves = "(stopped = 1 OR encounter_type = 21)"
SHARED["pr1"] = f"""
SELECT *, {named({
    'enrollment_date': f"FIRST_VALUE(CASE WHEN transferred_in = 1 THEN DATE '1900-01-01' ELSE encounter_date END) {UPTO}", 'known_rtc': locf('rtc'),
    'dseg': f"SUM(CASE WHEN {_leaves} OR status_asked = 1 THEN 1 ELSE 0 END) {UPTO}", 'mseg': f"SUM(CASE WHEN not_taking = 1 OR stopped = 1 OR meds_asked = 1 THEN 1 ELSE 0 END) {UPTO}",
    'hiv_rapid_test_result': locf('rapid'), 'hiv_rapid_test_date': locf('rapid_on'), 'population_type': locf(_population), 'death_sign': first_of('CASE WHEN died = 1 THEN encounter_date END'),
    'prev_encounter_datetime': f'LAG(encounter_date) {ROW}', 'next_encounter_datetime': f'LEAD(encounter_date) {ROW}',
    'is_pregnant': locf("CASE WHEN pregnant = 1 AND gender = 'F' THEN 1 WHEN pregnancy_over = 1 THEN 0 END"),
})} FROM pre"""
SHARED["pr2"] = f"""
SELECT *, {held(f'{_leaves} OR status_asked = 1', f'CASE WHEN {_leaves} THEN 1 END', 'dseg')} AS discontinued_prep,
 {held('not_taking = 1 OR stopped = 1 OR meds_asked = 1', 'CASE WHEN not_taking = 0 AND stopped = 0 THEN meds_text END', 'mseg')} AS cur_prep_meds FROM pr1"""
_pos = "(rapid_positive = 1 OR (discontinued_prep = 1 AND exit_positive = 1))"
SHARED["pr3"] = f"""
SELECT *, {named({
    'prev_rtc_date': f'LAG(known_rtc) {ROW}', 'prev_discontinued_prep': f'LAG(discontinued_prep) {ROW}', 'prev_prep_meds': f'LAG(cur_prep_meds) {ROW}', 'first_prep_regimen': first_of('cur_prep_meds'),
    'pseg': f"SUM(CASE WHEN {_pos} OR rapid IS NOT NULL THEN 1 ELSE 0 END) {UPTO}", 'turned_positive_date': first_of(f'CASE WHEN {_pos} THEN COALESCE(rapid_on, encounter_date) END'),
    'sub_population_type': locf(f"CASE WHEN population_type = '4' THEN {_sub} END"),
})} FROM pr2"""
_begin = "(discontinued_prep = 1 AND prev_discontinued_prep IS NULL)"
SHARED["pr4"] = f"""
SELECT *, {held(f'{_pos} OR rapid IS NOT NULL', f'CASE WHEN {_pos} THEN 1 END', 'pseg')} AS turned_positive,
 SUM(CASE WHEN {_begin} OR (discontinued_prep IS NULL AND prev_discontinued_prep = 1) THEN 1 ELSE 0 END) {UPTO} AS eseg,
 {locf('COALESCE(started_on, CASE WHEN cur_prep_meds IS NOT NULL AND cur_prep_meds IS DISTINCT FROM prev_prep_meds THEN encounter_date END)')} AS prep_start_date FROM pr3"""
SHARED["prep"] = f"""
SELECT *, {held(_begin, 'encounter_date', 'eseg')} AS discontinued_prep_date, {first_of('prep_start_date')} AS initial_prep_start_date, COALESCE(person_death, death_sign) AS death_date,
 COALESCE(rtc, CASE WHEN known_rtc > encounter_date THEN known_rtc END) AS rtc_date, {_names_sql.format('cur_prep_meds')} AS cur_prep_meds_names, CASE WHEN breastfeeding_yes = 1 THEN 1 WHEN breastfeeding_no = 1 THEN 0 END AS is_breastfeeding FROM pr4"""


@check("m23_prep_summary", "M23 G1 G2 G3 G4 G6 G19 Z2", f"SELECT {', '.join(pg.PREP_COLUMNS)} FROM prep")
def prep(t: Tables) -> DataFrame:
    return pg.prep_summary(t)


_prep_cols = ", ".join(x for x in pg.PREP_COLUMNS if x != "person_id")
_prep_rows = f"""(SELECT *, CAST(DATE_TRUNC('month', period_end) AS DATE) AS period_start FROM {as_of('prep', 'encounter_date', 'encounter_date DESC, encounter_id DESC', 'month', None, _prep_cols)})"""


@check("m25_prep_monthly_report", "M25 E8 N2 Z6", f"SELECT {', '.join(pg.prep_month_columns())} FROM {staged(_prep_rows, pg.prep_month_rules(DuckText))}")
def prep_months(t: Tables) -> DataFrame:
    return pg.prep_monthly(t)


_exits = "(SELECT p.*, (SELECT MIN(s.encounter_date) FROM spine s WHERE s.person_id = p.person_id AND s.encounter_type = 21 AND s.encounter_date > p.encounter_date) AS exit_date FROM prep p WHERE encounter_type <> 21)"
_prep_weeks = f"""(SELECT *, period_end - 6 AS period_start, rtc_date + CAST((6 - DAYOFWEEK(rtc_date)) AS INTEGER) AS rtc_week_end FROM {as_of(_exits, 'encounter_date', 'encounter_date DESC, encounter_id DESC', 'week', None, _prep_cols + ', exit_date')})"""


@check("m24_prep_weekly_report", "M24 E8 E15 J13 N2", f"SELECT {', '.join(pg.prep_week_columns())} FROM {staged(_prep_weeks, pg.prep_week_rules(DuckText))}")
def prep_weeks(t: Tables) -> DataFrame:
    return pg.prep_weekly(t)


events_cte("pe", pg.PEP_FACTS, pg.PEP_QUESTIONS, "e.encounter_type IN (1, 2)")


@check(
    "m26_pep_summary",
    "M26 G3 G5 G6",
    f"""SELECT person_id, encounter_id, encounter_date, enrollment_date, hiv_exposed_occupational, pep_start_date, LAG(known) {ROW} AS prev_rtc_date, COALESCE(rtc, CASE WHEN known > encounter_date THEN known END) AS cur_rtc_date FROM (
      SELECT *, FIRST_VALUE(encounter_date) {UPTO} AS enrollment_date, {locf('rtc')} AS known, {locf('CASE WHEN exposed = 1 THEN 1 WHEN exposure_asked = 1 THEN 0 END')} AS hiv_exposed_occupational,
      {locf('CASE WHEN encounter_type = 1 AND (started = 1 OR regimen_asked = 1) THEN encounter_date END')} AS pep_start_date FROM pee)""",
)
def pep(t: Tables) -> DataFrame:
    return pg.pep_summary(t)


events_cte("cd", pg.CDM_FACTS, pg.CDM_QUESTIONS)
_carried = [*pg.CDM_CARRIED, *pg.CDM_DATES]
_presc = """(SELECT encounter_id, STRING_AGG(part, ' $ ' ORDER BY g) AS prescriptions FROM (SELECT encounter_id, encounter_id * 10 + concept_id % 2 AS g, STRING_AGG('!!' || concept_id || '=' || value || '!!', ' ## ' ORDER BY concept_id, value) AS part
  FROM tall WHERE concept_id IN (1250, 1255) GROUP BY 1, 2) GROUP BY 1)"""


@check(
    "m29_chronic_disease",
    "M29 B11 C6 C8 G3",
    f"""WITH x AS (SELECT *, {locf('rtc')} AS known, {', '.join(f'{locf(n)} AS cur_{n}' for n in _carried)}, LAST_VALUE({_CLIN} IGNORE NULLS) {BEFORE} AS prev_clinical_datetime, FIRST_VALUE({_CLIN} IGNORE NULLS) {AFTER} AS next_clinical_datetime FROM cde),
      y AS (SELECT *, LAG(known) {ROW} AS prev_rtc_date FROM x)
    SELECT person_id, y.encounter_id, encounter_date, person_death AS death_date, COALESCE(rtc, CASE WHEN known > encounter_date THEN known END) AS cur_rtc_date, prev_rtc_date, {', '.join([*pg.CDM_VALUES, *[f'cur_{n}' for n in _carried], *pg.CDM_CODES])}, prescriptions, prev_clinical_datetime, next_clinical_datetime
    FROM y LEFT JOIN {_presc} p ON p.encounter_id = y.encounter_id""",
)
def chronic(t: Tables) -> DataFrame:
    return pg.chronic_disease(t)

