"""Care summaries and the reports built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.checks.care_sql import fact_sql, locf, no_patient
from caretrail.checks.registry import check
from caretrail.plans import hiv_facts as hf
from caretrail.plans import hiv_summary as hs
from caretrail.sources.tables import Tables
from caretrail.sources.views import answer_rows_sql


@check("m08_hiv_summary", "M8 N4 N11 N12 N13 Z1 Z2 Z10 Z11 Z12 Z13 Z17", f"SELECT {', '.join(hs.OUTPUT)} FROM hiv")
def hiv_summary(t: Tables) -> DataFrame:
    return hs.hiv_summary(t, columns=hs.OUTPUT)


HEAD = ["person_id", "encounter_id", "encounter_date"]


@check("m09_hiv_summary_current_form", "M9", f"SELECT {', '.join(HEAD + hs.CURRENT_FORM)} FROM hiv")
def current_form(t: Tables) -> DataFrame:
    return hs.hiv_summary(t, columns=HEAD + hs.CURRENT_FORM)


OTHER = ["mdt_1", "mdt_2", "mdt_3", "mdt_4", "mdt_session", "scheduled_visit_on", "rtc"]
_mdt = "CASE WHEN mdt_4 = 1 THEN 4 WHEN mdt_3 = 1 THEN 3 WHEN mdt_2 = 1 THEN 2 WHEN mdt_1 = 1 THEN 1 ELSE mdt_session END"


@check(
    "m10_hiv_summary_other_emr",
    "M10 L2",
    f"""WITH f AS (SELECT encounter_id, {', '.join(f'{fact_sql(*hf.OTHER_EMR_FACTS[n])} AS {n}' for n in OTHER)} FROM oq GROUP BY encounter_id), e AS (SELECT s.*, f.* EXCLUDE (encounter_id) FROM spine s LEFT JOIN f ON f.encounter_id = s.encounter_id),
    p AS (SELECT * FROM e WHERE {no_patient('oq')})
    SELECT person_id, encounter_id, encounter_date, scheduled_visit_on, {locf(_mdt)} AS mdt_session_number, COALESCE(rtc, CASE WHEN {locf('rtc')} > encounter_date THEN {locf('rtc')} END) AS cur_rtc_date FROM p""",
    views={"oq": answer_rows_sql(hf.OTHER_EMR_QUESTIONS)},
)
def other_emr(t: Tables) -> DataFrame:
    columns = [*HEAD, "encounter_type", "scheduled_visit_on", "mdt_session_number", "cur_rtc_date"]
    rows = hs.hiv_summary(t, facts=hf.OTHER_EMR_FACTS, questions=hf.OTHER_EMR_QUESTIONS, columns=columns)
    return rows.filter(F.col("encounter_type") != hs.LAB_TYPE).drop("encounter_type")
