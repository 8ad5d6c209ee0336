"""The form datasets: answers of a form's visits, the person, the timeline, and what some forms add."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.functions import dates as d
from caretrail.functions.obs import SEPARATOR
from caretrail.functions.regimens import chemo_regimens
from caretrail.operators import joins
from caretrail.operators.aggregates import distinct_text
from caretrail.operators.forms import RETURN_DAY, Form, form_answers, form_timeline
from caretrail.operators.timeline import Passes, Timeline, by_timeline, carry, latch, locf, prev
from caretrail.plans.spine import encounters
from caretrail.sources.tables import Tables

# The encounter types that stand in for every form's own over the test tables.
STAND_IN_TYPES = (1, 2, 14, 116)
HEAD = ["person_id", "encounter_id", "encounter_date", "encounter_type", "location_id", "gender", "age"]
TIMELINE = [
    "prev_encounter_date", "prev_encounter_type", "next_encounter_date", "next_encounter_type", "prev_clinical_date", "next_clinical_date",
    "prev_clinical_location_id", "next_clinical_location_id", "prev_clinical_rtc_date", "next_clinical_rtc_date",
]
OUTREACH_TYPE, LAB_TYPE, LUNG_CANCER = 21, 99999, 6555
START, CHANGE, CONTINUE, STOP = "1256", "1259", "1257", "1260"


def questions_of(spec: Form) -> list[tuple[int, str, int]]:
    """Stand-in answers: every answer of every question, days for the return date, numbers for the rest."""
    out: dict[tuple[int, str, int], None] = {(RETURN_DAY.concept, "date", 0): None}
    for q in spec.questions:
        if q.kind == "coded":
            out |= {(q.concept, "coded", a): None for a, _ in q.answers}
        elif q.concept not in (0, RETURN_DAY.concept):
            out[(q.concept, "number", 1)] = None
    return list(out)


def form_rows(
    t: Tables,
    spec: Form,
    types: tuple[int, ...] | None = None,
    more: Callable[[DataFrame, Timeline], DataFrame] | None = None,
    names: tuple[str, ...] = (),
) -> DataFrame:
    """One row per visit of the form with the person, its columns and neighbours, and the `names` that `more` adds on the same timeline.

    The age is that at the visit: whole years from one year on, before that the twelfths of a year.
    """
    visits = encounters(t).filter(F.col("encounter_type").isin(*(types or spec.encounter_types)))
    asked = replace(spec, questions=(*spec.questions, RETURN_DAY))
    rows = visits.join(form_answers(t.answers(questions_of(spec)), asked, ["encounter_id"]), "encounter_id", "left")
    persons = t.person.select("person_id", "gender", "birthdate")

    def walk(df: DataFrame, line: Timeline) -> DataFrame:
        df = df.join(persons, "person_id")
        df = form_timeline(df.withColumn("age", d.age_at(F.col("birthdate"), F.col("encounter_date"))), line)
        return more(df, line) if more else df

    return by_timeline(rows, walk, t.hot_persons, tasks=t.tasks()).select(*HEAD, *TIMELINE, *[q.column for q in spec.questions], *names)


def person_details(t: Tables) -> DataFrame:
    """Identifiers, name, telephone and county of every person who has one of them."""
    name = F.concat_ws(" ", *[F.coalesce(n, F.lit("")) for n in ("given_name", "middle_name", "family_name")])
    ids = t.patient_identifier.groupBy("person_id").agg(distinct_text(F.col("identifier")).alias("identifiers"))
    named = t.person_name.groupBy("person_id").agg(F.min(name).alias("person_name"))
    lives = t.person_address.groupBy("person_id").agg(F.min("address1").alias("county"))
    rows = ids.join(named, "person_id", "full_outer").join(lives, "person_id", "full_outer")
    return joins.with_attributes(rows, t.person_attribute, {"phone_number": 10})


def myeloma_rows(t: Tables, spec: Form, types: tuple[int, ...] | None = None) -> DataFrame:
    """The myeloma form with the regimens its drugs make up, and who the person is."""
    rows = form_rows(t, spec, types)
    regimens = chemo_regimens(F.coalesce(F.split("chemo_drugs", SEPARATOR), F.array().cast("array<string>")))
    return rows.withColumn("chemo_regimens", regimens).join(person_details(t), "person_id", "left")


SUBTYPES = (
    "breast_cancer_type", "gynecologic_cancer_type", "sarcoma_type", "leukemia_type", "lymphoma_type", "other_solid_type",
    "skin_cancer_type", "head_and_neck_type", "genitourinary_type", "gastrointestinal_type", "lung_cancer_type",
)
CARRIED = ("diagnosis", "cancer_type", "cancer_subtype", "overall_cancer_stage_group")


def history_columns(df: DataFrame, line: Timeline) -> DataFrame:
    """Enrolment, return dates, diagnosis and treatment as known at each visit."""

    def planned(*codes: str) -> Column:
        plans = F.split(F.coalesce("chemotherapy_plan", F.lit("")), SEPARATOR)
        return F.arrays_overlap(plans, F.array(*[F.lit(c) for c in codes]))

    today, drugs, known = F.col("encounter_date"), F.col("medication_history"), F.col("__known_return")
    df = df.withColumn("cancer_type", F.coalesce(F.col("cancer_type_diagnosed").cast("string"), "cancer_type_asked"))
    df = df.withColumn("cancer_subtype", F.coalesce(*SUBTYPES))
    passes = Passes()
    passes.look(
        0,
        enrollment_date=latch(~F.col("encounter_type").isin(OUTREACH_TYPE, LAB_TYPE), today),
        __known_return=locf(F.col(RETURN_DAY.column)),
        cur_onc_meds=carry(planned(STOP) | drugs.isNotNull(), F.when(~planned(STOP), drugs)),
        **{f"known_{n}": locf(F.col(n)) for n in CARRIED},
    )
    started, stopped = planned(START, CHANGE), planned(STOP)
    passes.set_or_soft(0, "cur_onc_meds_start_date", started, today, planned(CONTINUE), today, stopped & ~started)
    passes.look(1, prev_rtc_date=prev(known))
    passes.column(1, "rtc_date", F.coalesce(F.col(RETURN_DAY.column), F.when(known > today, known)))
    return passes.run(line, df)


HISTORY = (
    "enrollment_date", "prev_rtc_date", "rtc_date", "cancer_type", "cancer_subtype", "cur_onc_meds", "cur_onc_meds_start_date",
    *[f"known_{n}" for n in CARRIED],
)


def history_rows(t: Tables, spec: Form, types: tuple[int, ...] | None = None) -> DataFrame:
    """Oncology history: the form with its visit, the first cancer subtype answered, and what stays known from visit to visit."""
    visits = t.visit.select(F.col("visit_id").alias("encounter_id"), "visit_type_id", F.col("date_started").alias("visit_start_date"))
    rows = form_rows(t, spec, types, history_columns, HISTORY)
    return rows.drop("cancer_type_asked", "cancer_type_diagnosed").join(visits, "encounter_id", "left")
