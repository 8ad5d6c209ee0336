"""The HIV care summary in SQL, step by step, for use by name in other oracle queries."""

from __future__ import annotations

from caretrail.checks.registry import SHARED
from caretrail.functions.regimens import COMPONENTS
from caretrail.plans.hiv_facts import FACTS, QUESTIONS
from caretrail.sources.views import answer_rows_sql

ORDER = "ORDER BY encounter_date, day_rank, encounter_id"
UPTO = f"OVER (PARTITION BY person_id {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
BEFORE = f"OVER (PARTITION BY person_id {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
AFTER = f"OVER (PARTITION BY person_id {ORDER} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
ROW = f"OVER (PARTITION BY person_id {ORDER})"


def fact_sql(kind: str, concepts: tuple, codes: tuple) -> str:
    where = f"concept_id IN ({', '.join(map(str, concepts))})"
    if kind == "said":
        texts = ", ".join(f"'{c}'" for c in codes)
        return f"MAX(CASE WHEN {where} AND value IN ({texts}) THEN 1 ELSE 0 END)"
    if kind == "asked":
        return f"MAX(CASE WHEN {where} THEN 1 ELSE 0 END)"
    value = {"code": "TRY_CAST(value AS INTEGER)", "number": "TRY_CAST(value AS DOUBLE)", "date": "TRY_CAST(value AS DATE)", "day": "obs_date"}[kind]
    return f"MIN(CASE WHEN {where} THEN {value} END)"


def facts_sql(facts: dict, source: str, key: str = "encounter_id") -> str:
    columns = ", ".join(f"{fact_sql(*f)} AS {n}" for n, f in facts.items() if f[0] != "drugs")
    return f"SELECT {key}, {columns} FROM {source} GROUP BY {key}"


def flag_names(facts: dict) -> list[str]:
    return [n for n, f in facts.items() if f[0] in ("said", "asked")]


def locf(value: str) -> str:
    return f"LAST_VALUE({value} IGNORE NULLS) {UPTO}"


def first(value: str) -> str:
    return f"FIRST_VALUE({value} IGNORE NULLS) {UPTO}"


def no_patient(answers: str) -> str:
    """Encounter e has no answer that leaves it out of the summary."""
    return f"""NOT EXISTS (SELECT 1 FROM {answers} x WHERE x.encounter_id = e.encounter_id
  AND (x.concept_id = 5303 AND x.value IN ('822', '664', '1067') OR x.concept_id = 9082 AND x.value = '9036'))"""


def named(columns: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in columns.items())


_components = ", ".join(f"('{m}', {i}, '{code}')" for i, (code, _, members) in enumerate(COMPONENTS) for m in members)
_names = ", ".join(f"('{code}', {i}, '{name}')" for i, (code, name, _) in enumerate(COMPONENTS))

SHARED["hq"] = answer_rows_sql(QUESTIONS)
SHARED["hfacts"] = facts_sql(FACTS, "hq")
SHARED["hdrugs"] = f"""
SELECT encounter_id, concept_id, STRING_AGG(comp, ' ## ' ORDER BY ord) AS meds FROM (SELECT DISTINCT encounter_id, concept_id, ord, comp
 FROM hq JOIN (SELECT * FROM (VALUES {_components}) AS v(code, ord, comp)) k ON k.code = hq.value WHERE concept_id IN (1250, 1088, 2154, 2157)) GROUP BY 1, 2"""
SHARED["horders"] = """
SELECT encounter_id, MAX(CASE WHEN concept_id = 856 THEN 1 ELSE 0 END) AS vl_order, MAX(CASE WHEN concept_id = 657 THEN 1 ELSE 0 END) AS cd4_order,
 MAX(CASE WHEN concept_id = 1030 THEN 1 ELSE 0 END) AS pcr_order FROM clinical_order GROUP BY encounter_id"""
_flags = flag_names(FACTS)
_values = [n for n, f in FACTS.items() if f[0] not in ("said", "asked", "drugs")]
_zero = ", ".join(f"COALESCE({n}, 0) AS {n}" for n in [*_flags, "vl_order", "cd4_order", "pcr_order"])
SHARED["hforms"] = f"""
SELECT e.encounter_id, e.person_id, e.encounter_date, e.encounter_type, e.location_id, CASE e.encounter_type WHEN 116 THEN 20 WHEN 21 THEN 1 ELSE 10 END AS day_rank,
 CASE WHEN e.encounter_type IN (1, 2, 14) THEN 1 ELSE 0 END AS is_clinical, {_zero}, {', '.join(_values)}, d1.meds AS m1250, d2.meds AS m1088, d3.meds AS m2154, d4.meds AS m2157,
 v.visit_type_id AS visit_type, CASE WHEN v.visit_type_id = 24 THEN 1 WHEN v.visit_type_id IS NOT NULL THEN 0 END AS is_transit
FROM encounter e LEFT JOIN hfacts f ON f.encounter_id = e.encounter_id LEFT JOIN horders o ON o.encounter_id = e.encounter_id LEFT JOIN visit v ON v.visit_id = e.encounter_id
LEFT JOIN hdrugs d1 ON d1.encounter_id = e.encounter_id AND d1.concept_id = 1250 LEFT JOIN hdrugs d2 ON d2.encounter_id = e.encounter_id AND d2.concept_id = 1088
LEFT JOIN hdrugs d3 ON d3.encounter_id = e.encounter_id AND d3.concept_id = 2154 LEFT JOIN hdrugs d4 ON d4.encounter_id = e.encounter_id AND d4.concept_id = 2157 WHERE e.voided = 0 AND {no_patient('hq')}"""
SHARED["hlabs"] = f"""
SELECT MIN(obs_id) + 100000000 AS encounter_id, person_id, CAST(obs_datetime AS DATE) AS encounter_date, 99999 AS encounter_type, 1 AS day_rank, 0 AS is_clinical,
 MIN(CASE WHEN concept_id = 856 THEN value_numeric END) AS vl, MIN(CASE WHEN concept_id = 5497 THEN value_numeric END) AS cd4,
 MIN(CASE WHEN concept_id = 730 THEN value_numeric END) AS cd4_percent, MIN(CASE WHEN concept_id = 1030 THEN value_numeric END) AS pcr,
 {', '.join(f'0 AS {n}' for n in [*_flags, 'vl_order', 'cd4_order', 'pcr_order'])} FROM lab_event GROUP BY person_id, CAST(obs_datetime AS DATE)"""
SHARED["hev"] = """
SELECT u.*, p.gender, p.birthdate, p.death_date AS person_death FROM (SELECT * FROM hforms UNION ALL BY NAME SELECT * FROM hlabs) u JOIN person p ON p.person_id = u.person_id AND p.voided = 0 AND p.is_test = 0"""
SHARED["hday"] = """
SELECT *, ROW_NUMBER() OVER (PARTITION BY person_id ORDER BY day) AS n FROM (SELECT person_id, encounter_date AS day,
 MAX(CASE WHEN encounter_type = 99999 THEN vl END) AS vlab, MAX(CASE WHEN encounter_type <> 99999 AND vl IS NOT NULL THEN vl_on END) AS vfd,
 ARG_MAX(CASE WHEN encounter_type <> 99999 THEN vl END, CASE WHEN encounter_type <> 99999 AND vl IS NOT NULL THEN {'d': vl_on, 'v': vl} END) AS vform,
 MAX(CASE WHEN encounter_type = 99999 THEN pcr END) AS plab, MAX(CASE WHEN encounter_type <> 99999 AND pcr IS NOT NULL THEN pcr_on END) AS pfd,
 ARG_MAX(CASE WHEN encounter_type <> 99999 THEN pcr END, CASE WHEN encounter_type <> 99999 AND pcr IS NOT NULL THEN {'d': pcr_on, 'v': pcr} END) AS pform,
 MAX(CASE WHEN encounter_type IN (32, 33, 44, 10) OR gestation_asked = 1 OR pregnant = 1 THEN 1 ELSE 0 END) AS start,
 MAX(CASE WHEN encounter_type IN (11, 47, 34) OR not_pregnant = 1 OR delivered = 1 OR delivered_now = 1 OR pregnancy_over = 1 THEN 1 ELSE 0 END) AS stop,
 MIN(COALESCE(last_period + 280, encounter_date + CAST((40 - gestation_weeks) * 7 AS INTEGER), due_on)) AS due FROM hev GROUP BY person_id, encounter_date)
 WHERE vlab IS NOT NULL OR vform IS NOT NULL OR plab IS NOT NULL OR pform IS NOT NULL OR start = 1 OR stop = 1 OR due IS NOT NULL"""
_vnew = "vform IS NOT NULL AND (vd1 IS NULL OR (ABS(vfd - vd1) > 30 AND vfd > vd1))"
_pnew = "pform IS NOT NULL AND (pd1 IS NULL OR (ABS(pfd - pd1) > 30 AND pfd > pd1))"
_past = "COALESCE(x.day - edd, 0) > 28"
SHARED["hstate"] = f"""
SELECT person_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS DATE) AS day, CAST(NULL AS DOUBLE) AS v1, CAST(NULL AS DATE) AS vd1, CAST(NULL AS DOUBLE) AS v2, CAST(NULL AS DATE) AS vd2,
  CAST(NULL AS DOUBLE) AS p1, CAST(NULL AS DATE) AS pd1, CAST(NULL AS DOUBLE) AS p2, CAST(NULL AS DATE) AS pd2, 0 AS preg, CAST(NULL AS DATE) AS edd FROM hday WHERE n = 1
UNION ALL SELECT x.person_id, x.n, x.day,
  CASE WHEN vlab IS NOT NULL THEN vlab WHEN {_vnew} THEN vform ELSE v1 END, CASE WHEN vlab IS NOT NULL THEN x.day WHEN {_vnew} THEN vfd ELSE vd1 END,
  CASE WHEN v1 IS NOT NULL AND ((vlab IS NOT NULL AND x.day <> vd1) OR (vlab IS NULL AND {_vnew})) THEN v1 ELSE v2 END,
  CASE WHEN v1 IS NOT NULL AND ((vlab IS NOT NULL AND x.day <> vd1) OR (vlab IS NULL AND {_vnew})) THEN vd1 ELSE vd2 END,
  CASE WHEN plab IS NOT NULL THEN plab WHEN {_pnew} THEN pform ELSE p1 END, CASE WHEN plab IS NOT NULL THEN x.day WHEN {_pnew} THEN pfd ELSE pd1 END,
  CASE WHEN p1 IS NOT NULL AND ((plab IS NOT NULL AND x.day <> pd1) OR (plab IS NULL AND {_pnew})) THEN p1 ELSE p2 END,
  CASE WHEN p1 IS NOT NULL AND ((plab IS NOT NULL AND x.day <> pd1) OR (plab IS NULL AND {_pnew})) THEN pd1 ELSE pd2 END,
  CASE WHEN stop = 1 THEN 0 WHEN start = 1 THEN 1 WHEN {_past} THEN 0 ELSE preg END,
  CASE WHEN stop = 0 AND (start = 1 OR (preg = 1 AND NOT {_past})) THEN COALESCE(CASE WHEN preg = 1 AND NOT {_past} THEN edd END, due) END
FROM hstate s JOIN hday x ON x.person_id = s.person_id AND x.n = s.n + 1"""
_tb_screen = """tb_test_asked = 1 OR tb_test_ordered = 1 OR tb_symptom = 1 OR tb_cough = 1 OR tb_exam = 1 OR tb_none = 1 OR tb_treatment_started = 1 OR (tb_contact = 1 AND tb_plan_continue = 0)"""
_past_drugs = "drugs_past_asked = 1 AND drugs_past_none = 0"
_line = "CASE WHEN arv_stop = 1 THEN NULL " + " ".join(f"WHEN line_{q}_{n} = 1 THEN {n}" for q in (1250, 1088, 2154) for n in (1, 2, 3)) + " END"
SHARED["h0"] = f"""
SELECT h.*, s.v1 AS vl_value_1, s.vd1 AS vl_date_1, s.v2 AS vl_value_2, s.vd2 AS vl_date_2, s.p1 AS pcr_value_1, s.pd1 AS pcr_date_1, s.p2 AS pcr_value_2, s.pd2 AS pcr_date_2, s.preg, s.edd AS sedd,
 CASE WHEN discharged = 1 OR transfer_away = 1 OR exit_code IS NOT NULL OR care_left = 1 OR encounter_type = 31 THEN 1 END AS out_of_care,
 CASE WHEN arv_stop = 1 OR drugs_started = 1 OR drugs_current_asked = 1 OR drugs_reported_asked = 1 OR ({_past_drugs}) THEN 1 ELSE 0 END AS meds_event,
 CASE WHEN arv_stop = 1 THEN NULL WHEN drugs_started = 1 THEN m1250 WHEN drugs_current_asked = 1 THEN m1088 WHEN drugs_reported_asked = 1 THEN m2154 WHEN {_past_drugs} THEN m2157 END AS meds,
 {_line} AS cur_arv_line_strict, CASE WHEN {_tb_screen} THEN 1 END AS tb_screen,
 CASE WHEN tb_stop = 0 AND (tb_plan = 1 OR (tb_drugs = 1 AND tb_drugs_none = 0)) THEN 1 ELSE 0 END AS on_tb_tx,
 CASE WHEN encounter_type = 21 THEN CASE WHEN (phone_tried = 1 OR phone_used = 1 OR phone_method = 1) AND phone_reached = 1 OR phone_method = 1 AND home_reached = 1 THEN 1 WHEN (phone_attempt = 1 OR phone_method = 1) AND phone_failed = 1 OR phone_method = 1 AND home_failed = 1 THEN 2 END END AS phone_outreach,
 CASE WHEN encounter_type = 21 THEN CASE WHEN (home_tried = 1 OR home_method = 1) AND home_reached = 1 THEN 1 WHEN (home_tried = 1 OR home_method = 1) AND home_failed = 1 THEN 2 END END AS home_outreach,
 CASE WHEN encounter_type = 21 THEN CAST(COALESCE(attempts_a, attempts_b) AS INTEGER) END AS outreach_attempts,
 CASE WHEN cervix_no = 1 THEN 0 WHEN cervix_yes = 1 THEN 1 WHEN cervix_na = 1 THEN 3 WHEN cervix_undone = 1 THEN 4 END AS ca_cx_screen,
 CASE WHEN encounter_type NOT IN (21, 99999) THEN 1 ELSE 0 END AS enrolling,
 CASE WHEN ipt_hard_start = 1 OR (ipt_history = 1 AND ipt_started_on IS NOT NULL) THEN 1 ELSE 0 END AS ipt_h,
 CASE WHEN tb_started_on IS NOT NULL OR tb_start_now = 1 THEN 1 ELSE 0 END AS tb_h,
 CASE WHEN pcp_hard_start = 1 OR pcp_stop = 1 THEN 1 ELSE 0 END AS pcp_h,
 CASE WHEN contraceptive = 1 THEN encounter_date WHEN contraceptive_374 = 1 THEN COALESCE(ipt_started_on, encounter_date) END AS cstart,
 COALESCE(contraceptive_code, contraceptive_374_code) AS cmethod
FROM hev h ASOF LEFT JOIN hstate s ON s.person_id = h.person_id AND s.day <= h.encounter_date"""
_answer = "CASE WHEN {0}_yes = 1 THEN 1 WHEN {0}_no = 1 THEN 0 END"
_h1 = {
    "enrollment_date": first("COALESCE(enrolled_on, CASE WHEN transferred_in = 1 THEN DATE '1900-01-01' WHEN enrolling = 1 THEN encounter_date END)"),
    "enrollment_location_id": first("CASE WHEN enrolled_elsewhere = 1 OR transferred_in = 1 THEN 9999 WHEN enrolling = 1 THEN location_id END"),
    "known_location": locf("CASE WHEN location_id <> 0 THEN location_id END"),
    "visit_num": f"CAST(SUM(CASE WHEN encounter_type NOT IN (5, 6, 7, 8, 9, 21) THEN 1 ELSE 0 END) {UPTO} AS BIGINT)",
    "mdt_session_number": locf("CASE WHEN mdt_4 = 1 THEN 4 WHEN mdt_3 = 1 THEN 3 WHEN mdt_2 = 1 THEN 2 WHEN mdt_1 = 1 THEN 1 END"),
    "known_rtc": locf("rtc"),
    "meds_seg": f"SUM(meds_event) {UPTO}",
    "line_seg": f"SUM(CASE WHEN arv_stop = 1 OR cur_arv_line_strict IS NOT NULL THEN 1 ELSE 0 END) {UPTO}",
    "cur_arv_line_reported": locf("CASE WHEN line_reported_1 = 1 THEN 1 WHEN line_reported_2 = 1 THEN 2 WHEN line_reported_3 = 1 THEN 3 END"),
    "cur_arv_adherence": locf("CASE WHEN adherence_good = 1 THEN 'GOOD' WHEN adherence_fair = 1 THEN 'FAIR' WHEN adherence_poor = 1 THEN 'POOR' END"),
    "known_disclosed": locf("CASE WHEN disclosed = 1 THEN 1 END"),
    "known_death": locf("death_on"),
    "first_death_sign": first("CASE WHEN death_cause = 1 OR died = 1 OR encounter_type = 31 THEN encounter_date END"),
    "hiv_hard": locf("COALESCE(hiv_on, CASE WHEN transferred_in = 1 THEN DATE '1900-01-01' END)"),
    "first_seen": f"FIRST_VALUE(encounter_date) {UPTO}",
    "tb_screening_result": locf("tb_result"),
    "tb_screening_datetime": locf("CASE WHEN tb_screen = 1 THEN encounter_date END"),
    "on_ipt": locf("CASE WHEN ipt_stop = 1 THEN 0 WHEN ipt_plan = 1 OR ipt_drug = 1 THEN 1 END"),
    "ipt_stop_date": locf("CASE WHEN ipt_stop_reason = 1 THEN encounter_date WHEN ipt_history = 1 THEN ipt_ended_on END"),
    "ipt_completion_date": locf("CASE WHEN ipt_completed = 1 THEN encounter_date WHEN ipt_history = 1 THEN ipt_ended_on END"),
    "tb_tx_end_date": locf("COALESCE(tb_end_on, CASE WHEN tb_end_now = 1 THEN encounter_date END)"),
    "condoms_provided_date": locf("CASE WHEN condoms = 1 OR condoms_method = 1 OR condoms_given = 1 THEN encounter_date END"),
    "cs_seg": f"SUM(CASE WHEN cstart IS NOT NULL OR contraceptive_none = 1 THEN 1 ELSE 0 END) {UPTO}",
    "cm_seg": f"SUM(CASE WHEN cmethod IS NOT NULL OR contraceptive_none = 1 OR contraceptive_no = 1 THEN 1 ELSE 0 END) {UPTO}",
    "cur_who_stage": locf("CASE WHEN who_1 = 1 THEN 1 WHEN who_2 = 1 THEN 2 WHEN who_3 = 1 THEN 3 WHEN who_4 = 1 THEN 4 END"),
    "discordant_status": locf("CASE discordant_code WHEN 1065 THEN 1 WHEN 1066 THEN 2 WHEN 1067 THEN 3 WHEN 1175 THEN 4 WHEN 6826 THEN 5 WHEN 6827 THEN 6 END"),
    "known_vl_order": locf("CASE WHEN vl_ordered = 1 OR vl_order = 1 THEN encounter_date END"),
    "cd4_order_date": locf("CASE WHEN cd4_ordered = 1 OR cd4_order = 1 THEN encounter_date END"),
    "hiv_dna_pcr_order_date": locf("CASE WHEN pcr_ordered = 1 OR pcr_order = 1 THEN encounter_date END"),
    "travelled_outside_last_3_months": locf(_answer.format("away_3")),
    "travelled_outside_last_6_months": locf(_answer.format("away_6")),
    "travelled_outside_last_12_months": locf(_answer.format("away_12")),
    "last_cross_border_screening_date": locf("CASE WHEN away_3_yes = 1 OR away_3_no = 1 OR away_6_yes = 1 OR away_12_no = 1 OR encounter_type = 218 THEN encounter_date END"),
    "cross_border_service_offered": locf("border_service"),
    "country_of_residence": locf("country"),
    "ovc_non_enrollment_reason": locf("ovc_reason"),
    "ovc_exit_date": locf("ovc_exit_on"),
    "ca_cx_screening_result": locf("cervix_result"),
    "ca_cx_screening_result_date": locf("cervix_result_on"),
    "ca_cx_screening_date": locf("CASE WHEN cervix_yes = 1 THEN encounter_date END"),
    "tb_modality_test": locf("CASE WHEN tb_modality_xpert = 1 THEN 8070 WHEN tb_modality_smear = 1 THEN 307 WHEN tb_modality_culture = 1 THEN 2311 WHEN tb_modality_lam = 1 THEN 1506 WHEN tb_modality_xray = 1 THEN 12 END"),
    "is_mother_breastfeeding": locf(_answer.format("breastfeeding")),
    "cur_weight": locf("CASE WHEN weight <> 0 THEN weight END"),
    "cur_height": locf("CASE WHEN height <> 0 THEN height END"),
    "ipt_seg": f"SUM(ipt_h) {UPTO}",
    "tb_seg": f"SUM(tb_h) {UPTO}",
    "pcp_seg": f"SUM(pcp_h) {UPTO}",
    "cd4_n": f"COUNT(CASE WHEN encounter_type = 99999 THEN cd4 END) {UPTO}",
    "pct_n": f"COUNT(CASE WHEN encounter_type = 99999 THEN cd4_percent END) {UPTO}",
}
SHARED["h1"] = f"SELECT *, {named(_h1)} FROM h0"


def held(event: str, value: str, seg: str) -> str:
    """Value of the event that opened the segment."""
    return f"MAX(CASE WHEN {event} THEN {value} END) OVER (PARTITION BY person_id, {seg})"


def soft(test: str, value: str, seg: str) -> str:
    return f"FIRST_VALUE(CASE WHEN {test} THEN {value} END IGNORE NULLS) OVER (PARTITION BY person_id, {seg} {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


_h2 = {
    "cur_arv_meds": held("meds_event = 1", "meds", "meds_seg"),
    "cur_arv_line": held("arv_stop = 1 OR cur_arv_line_strict IS NOT NULL", "cur_arv_line_strict", "line_seg"),
    "modern_contraceptive_method_start_date": held("cstart IS NOT NULL OR contraceptive_none = 1", "cstart", "cs_seg"),
    "contraceptive_method": held("1 = 1", "CASE WHEN contraceptive_none = 0 AND contraceptive_no = 0 THEN cmethod END", "cm_seg"),
    "ipt_start_date": f"COALESCE({held('ipt_h = 1', 'CASE WHEN ipt_hard_start = 1 THEN encounter_date ELSE ipt_started_on END', 'ipt_seg')}, {soft('ipt_soft_start = 1 AND ipt_h = 0', 'encounter_date', 'ipt_seg')})",
    "tb_tx_start_date": f"""COALESCE({held('tb_h = 1', 'COALESCE(tb_started_on, encounter_date)', 'tb_seg')},
      {soft('tb_h = 0 AND transferred_in = 0 AND (tb_continue = 1 OR (tb_drugs = 1 AND tb_drugs_none = 0))', 'encounter_date', 'tb_seg')})""",
    "pcp_prophylaxis_start_date": f"COALESCE({held('pcp_h = 1 AND pcp_stop = 0', 'encounter_date', 'pcp_seg')}, {soft('pcp_h = 0 AND (pcp_soft_start = 1 OR pcp_drug = 1)', 'encounter_date', 'pcp_seg')})",
    "prev_rtc_date": f"LAG(known_rtc) {ROW}",
    "prev_clinical_datetime_hiv": f"LAST_VALUE(CASE WHEN is_clinical = 1 THEN encounter_date END IGNORE NULLS) {BEFORE}",
    "clin_seg": f"SUM(is_clinical) {UPTO}",
    "prev_arv_adherence": f"LAG(cur_arv_adherence) {ROW}",
    "prev_encounter_datetime_hiv": f"LAG(encounter_date) {ROW}",
    "prev_encounter_type_hiv": f"LAG(encounter_type) {ROW}",
    "next_encounter_datetime_hiv": f"LEAD(encounter_date) {ROW}",
    "next_encounter_type_hiv": f"LEAD(encounter_type) {ROW}",
    "next_clinical_datetime_hiv": f"FIRST_VALUE(CASE WHEN is_clinical = 1 THEN encounter_date END IGNORE NULLS) {AFTER}",
}
_CD4 = """(SELECT person_id AS p, {v} AS v1, encounter_date AS d1, LAG({v}) OVER w AS v2, LAG(encounter_date) OVER w AS d2, ROW_NUMBER() OVER w AS n
   FROM h0 WHERE encounter_type = 99999 AND {v} IS NOT NULL WINDOW w AS (PARTITION BY person_id ORDER BY encounter_date, day_rank, encounter_id))"""
SHARED["h2"] = f"""
SELECT h1.*, {named(_h2)}, c4.v1 AS cd4_1, c4.d1 AS cd4_1_date, c4.v2 AS cd4_2, c4.d2 AS cd4_2_date, pc.v1 AS cd4_percent_1, pc.d1 AS cd4_percent_1_date, pc.v2 AS cd4_percent_2, pc.d2 AS cd4_percent_2_date
FROM h1 LEFT JOIN {_CD4.format(v='cd4')} c4 ON c4.p = person_id AND c4.n = cd4_n LEFT JOIN {_CD4.format(v='cd4_percent')} pc ON pc.p = person_id AND pc.n = pct_n"""
_h3 = {
    "prev_arv_meds": f"LAST_VALUE(cur_arv_meds IGNORE NULLS) {BEFORE}",
    "prev_arv_line": f"LAG(cur_arv_line) {ROW}",
    # Previous clinical row by its segment, so that a null there is not skipped.
    "opener_rtc": "FIRST_VALUE(CASE WHEN is_clinical = 1 THEN known_rtc END) OVER (PARTITION BY person_id, clin_seg ORDER BY encounter_date, day_rank, encounter_id)",
    "opener_location": "FIRST_VALUE(CASE WHEN is_clinical = 1 THEN known_location END) OVER (PARTITION BY person_id, clin_seg ORDER BY encounter_date, day_rank, encounter_id)",
    "outreach_date_bncd": "MAX(CASE WHEN is_clinical = 0 AND encounter_type = 21 THEN encounter_date END) OVER (PARTITION BY person_id, clin_seg)",
    "outreach_death_date_bncd": "MAX(CASE WHEN is_clinical = 0 AND encounter_type = 21 THEN death_on END) OVER (PARTITION BY person_id, clin_seg)",
    "transfer_date_bncd": "MAX(CASE WHEN is_clinical = 0 AND encounter_type = 116 THEN encounter_date END) OVER (PARTITION BY person_id, clin_seg)",
}
SHARED["h3"] = f"SELECT *, {named(_h3)} FROM h2"
_h4 = {
    "prev_clinical_rtc_date_hiv": f"LAG(opener_rtc) {ROW}",
    "prev_clinical_location_id": f"LAG(opener_location) {ROW}",
    "next_clinical_location_id": f"FIRST_VALUE(CASE WHEN is_clinical = 1 THEN {{'v': known_location}} END IGNORE NULLS) {AFTER}.v",
    "arv_h": "CASE WHEN arv_hard_start = 1 OR arv_stop = 1 OR cur_arv_meds <> prev_arv_meds THEN 1 ELSE 0 END",
    "arv_set": "CASE WHEN arv_hard_start = 1 OR (cur_arv_meds <> prev_arv_meds AND arv_stop = 0) THEN encounter_date END",
}
_h4["next_clinical_rtc_date_hiv"] = f"(FIRST_VALUE(CASE WHEN is_clinical = 1 THEN {{'v': COALESCE(rtc, CASE WHEN known_rtc > encounter_date THEN known_rtc END)}} END IGNORE NULLS) {AFTER}).v"
_h4["next_clinical_location_id"] = f"(FIRST_VALUE(CASE WHEN is_clinical = 1 THEN {{'v': known_location}} END IGNORE NULLS) {AFTER}).v"
SHARED["h4"] = f"SELECT *, {named(_h4)} FROM h3"
_care = "(prev_clinical_datetime_hiv IS NULL OR encounter_date - COALESCE(prev_clinical_rtc_date_hiv, prev_clinical_datetime_hiv + 90) < 90)"
SHARED["h5"] = f"""
SELECT *, SUM(arv_h) {UPTO} AS arv_seg, CASE WHEN transferred_in = 1 OR prev_clinical_location_id <> known_location THEN 1 END AS transfer_in,
 CASE WHEN first_arv_on IS NOT NULL THEN 'given' WHEN drugs_past_asked = 1 AND drugs_past_none = 0 THEN 'unknown' WHEN arv_started_now = 1 OR drugs_started = 1 THEN 'now'
  WHEN drugs_current_asked = 1 AND drugs_current_none = 0 AND transferred_in = 0 AND {_care} THEN 'unknown'
  WHEN drugs_reported_asked = 1 AND drugs_reported_none = 0 AND transferred_in = 0 AND {_care} THEN 'unknown' WHEN cur_arv_meds IS NOT NULL THEN 'unknown' END AS kind FROM h4"""
SHARED["h6"] = f"""
SELECT *, COALESCE({held('arv_h = 1', 'arv_set', 'arv_seg')}, {soft('arv_soft_start = 1 AND arv_h = 0', 'encounter_date', 'arv_seg')}) AS arv_start_date,
 FIRST_VALUE(CASE WHEN kind IS NOT NULL THEN {{'date': CASE kind WHEN 'given' THEN first_arv_on WHEN 'now' THEN encounter_date ELSE DATE '1900-01-01' END,
  'regimen': CASE WHEN kind = 'now' THEN cur_arv_meds ELSE 'unknown' END, 'location': CASE WHEN kind = 'now' THEN known_location ELSE 9999 END}} END IGNORE NULLS) {UPTO} AS f,
 {locf("CASE WHEN transfer_in = 1 THEN encounter_date END")} AS transfer_in_date,
 {locf("CASE WHEN transferred_in_site = 1 THEN 9999 WHEN transfer_in = 1 THEN prev_clinical_location_id END")} AS transfer_in_location_id FROM h5"""
SHARED["h7"] = f"""
SELECT *, LAG(arv_start_date) {ROW} AS prev_arv_start_date, (FIRST_VALUE(CASE WHEN arv_start_date IS NOT NULL THEN {{'v': known_location}} END IGNORE NULLS) {UPTO}).v AS arv_start_location_id,
 {first("CASE WHEN f.date = DATE '1900-01-01' AND first_arv_known = 1 THEN first_arv_on END")} AS better_date,
 {first("CASE WHEN f.regimen = 'unknown' AND first_arv_regimen_known = 1 AND drugs_past_asked = 1 THEN m2157 END")} AS better_regimen,
 COALESCE(person_death, known_death, first_death_sign) AS death_date, CASE WHEN transfer_code IS NOT NULL OR exit_transfer = 1 OR care_transfer = 1 THEN 1 ELSE 0 END AS leaving,
 CASE WHEN preg = 1 AND NOT COALESCE(encounter_date - sedd, 0) > 28 THEN 1 END AS is_pregnant, CASE WHEN preg = 1 AND NOT COALESCE(encounter_date - sedd, 0) > 28 THEN sedd END AS edd,
 COALESCE(rtc, CASE WHEN known_rtc > encounter_date THEN known_rtc END) AS cur_rtc_date FROM h6"""


def months(a: str, b: str) -> str:
    """Complete months from a to b, for a before b or after it."""
    whole = f"((YEAR({b}) - YEAR({a})) * 12 + MONTH({b}) - MONTH({a}))"
    return f"({whole} - CASE WHEN {whole} > 0 AND DAY({b}) < DAY({a}) THEN 1 WHEN {whole} < 0 AND DAY({b}) > DAY({a}) THEN -1 ELSE 0 END)"


def years(a: str, b: str) -> str:
    return f"CAST(TRUNC({months(a, b)} / 12.0) AS INTEGER)"


_names_sql = f"(SELECT STRING_AGG(name, ' ## ' ORDER BY ord) FROM (VALUES {_names}) AS v(code, ord, name) WHERE list_contains(string_split({{}}, ' ## '), code))"
_since, _on = months("vl_date_1", "encounter_date"), months("arv_start_date", "encounter_date")
_final = {
    "scheduled_visit": "scheduled_visit",
    "cur_arv_meds_strict": "meds",
    "med_pickup_rtc_date": "med_pickup",
    "patient_care_status": "CASE WHEN death_date <= encounter_date THEN 159 WHEN discharged = 1 THEN 9036 ELSE COALESCE(transfer_code, exit_code, care_code, CASE WHEN encounter_type <> 99999 THEN 6101 END) END",
    "hiv_start_date": "COALESCE(hiv_hard, first_seen)",
    "arv_first_regimen": "COALESCE(better_regimen, f.regimen)",
    "arv_first_regimen_start_date": "COALESCE(better_date, f.date)",
    "arv_first_regimen_location_id": "f.location",
    "prev_arv_end_date": locf("CASE WHEN prev_arv_start_date <> arv_start_date THEN encounter_date END"),
    "hiv_status_disclosed": "CASE WHEN not_disclosed = 1 AND disclosed = 0 THEN 0 ELSE known_disclosed END",
    "vl_resulted": "CASE WHEN encounter_type = 99999 THEN vl END",
    "cd4_resulted": "CASE WHEN encounter_type = 99999 THEN cd4 END",
    "hiv_dna_pcr_resulted": "CASE WHEN encounter_type = 99999 THEN pcr END",
    "vl_order_date": "CASE WHEN vl_date_1 IS NULL OR vl_date_1 < known_vl_order THEN known_vl_order END",
    "expected_vl": f"""CASE WHEN cur_arv_meds IS NOT NULL AND vl_value_1 > 1000 AND encounter_date - vl_date_1 >= 90 THEN 1 WHEN {_on} <= 12 AND (vl_date_1 IS NULL OR {_since} >= 6) AND {_on} >= 6 THEN 1
      WHEN {_on} >= 12 AND (vl_date_1 IS NULL OR {_since} >= 12) THEN 1 ELSE 0 END""",
    "hiv_rapid_test_resulted": "CAST(rapid_test AS INTEGER)",
    "hiv_rapid_test_resulted_date": "CASE WHEN rapid_test IS NOT NULL THEN encounter_date END",
    "transfer_out": "CASE WHEN leaving = 1 OR next_clinical_location_id <> known_location THEN 1 END",
    "transfer_out_date": """CASE WHEN (leaving = 1 OR next_clinical_location_id <> known_location) AND next_clinical_datetime_hiv IS NULL THEN cur_rtc_date WHEN next_clinical_location_id <> known_location THEN next_clinical_datetime_hiv
      WHEN is_clinical = 1 THEN transfer_date_bncd END""",
    "transfer_out_location_id": """CASE WHEN transfer_other = 1 AND next_clinical_datetime_hiv IS NULL THEN 9999 WHEN transfer_network = 1 AND next_clinical_datetime_hiv IS NULL THEN 9998
      WHEN next_clinical_location_id <> known_location THEN next_clinical_location_id END""",
    "is_cross_border_country": "CASE WHEN travelled_outside_last_3_months = 1 OR travelled_outside_last_6_months = 1 OR travelled_outside_last_12_months = 1 THEN 1 ELSE 0 END",
    "bmi": "cur_weight / NULLIF(cur_height * cur_height, 0) * 10000",
    "cur_arv_meds_names": _names_sql.format("cur_arv_meds"),
}


def hiv_columns(names: list[str]) -> str:
    return ", ".join(f"{_final[n]} AS {n}" if n in _final and _final[n] != n else n for n in names)


def define() -> None:
    from caretrail.plans.hiv_summary import CURRENT_FORM, OUTPUT

    SHARED["hiv"] = f"SELECT {hiv_columns([*OUTPUT, *CURRENT_FORM])}, day_rank FROM h7"


define()
