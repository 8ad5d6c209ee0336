"""Visits and follow-up: encounter neighbours, appointments, defaulters, case lists, screening, unrecorded deaths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.functions.text import filing_id, full_name
from caretrail.operators import rules
from caretrail.operators.aggregates import distinct_text
from caretrail.operators.facts import Fact, date, extract_facts, fill_absent, said
from caretrail.operators.joins import exclude, with_attributes
from caretrail.operators.timeline import Timeline, by_timeline, carry, following, locf, next_where, prev, prev_where
from caretrail.plans.spine import encounters, last_visits, measured
from caretrail.sources.sinks import insert_ignore
from caretrail.sources.tables import Tables, live

c = F.col


def derived_encounter(t: Tables) -> DataFrame:
    """Every live encounter with the type and date of its neighbours, and of its clinical neighbours."""
    df = live(t.encounter).withColumn("day_rank", rules.day_rank(c("encounter_type"))).withColumn("is_clinical", rules.is_clinical(c("encounter_type")))
    clinical = c("is_clinical") == 1
    looks = dict(
        prev_encounter_date=prev(c("encounter_date")),
        prev_encounter_type=prev(c("encounter_type")),
        next_encounter_date=following(c("encounter_date")),
        next_encounter_type=following(c("encounter_type")),
        prev_clinic_date=prev_where(clinical, c("encounter_date")),
        next_clinic_date=next_where(clinical, c("encounter_date")),
    )
    out = by_timeline(df, lambda d, line: line.scan(d, **looks), t.hot_persons, tasks=t.tasks())
    return out.select("encounter_id", "person_id", "encounter_date", *looks)


# Appointments. Fixed values of the stand-in mappings: programme of a visit type or encounter type, department of a programme.
PROGRAM_OF_VISIT = {2: 1, 3: 2, 23: 1, 24: 3, 25: 3, 119: 2}
PROGRAM_OF_TYPE = {1: 1, 2: 1, 14: 2, 21: 3}
DEPARTMENT_OF_PROGRAM = {1: 1, 2: 1, 3: 2}
HELD_VISITS = (23, 24, 119, 124)
APPOINTMENT_QUESTIONS = [(5096, "date", 0)] * 4 + [(9605, "date", 0)] * 2 + [(1839, "coded", 7850)]
APPOINTMENT_FACTS: dict[str, Fact] = {"rtc": date(5096), "med_rtc": date(9605)}


def _mapped(table: dict[int, int], key: Column) -> Column:
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(entries, key)


def appointments(t: Tables) -> DataFrame:
    """Every encounter with its neighbours in the person's, the programme's and the department's timeline.

    Programme and department timelines are sub-partitions of the person's, so all three share one exchange.
    """
    facts = extract_facts(t.answers(APPOINTMENT_QUESTIONS), ["encounter_id"], APPOINTMENT_FACTS)
    visits = t.visit.select(c("visit_id").alias("encounter_id"), "visit_type_id")
    df = live(t.encounter).join(facts, "encounter_id", "left").join(visits, "encounter_id", "left")
    program = F.when(c("visit_type_id").isNotNull(), _mapped(PROGRAM_OF_VISIT, c("visit_type_id"))).otherwise(
        _mapped(PROGRAM_OF_TYPE, c("encounter_type"))
    )
    df = df.withColumn("program_id", program).withColumn("department_id", _mapped(DEPARTMENT_OF_PROGRAM, program))
    df = df.withColumn("is_clinical", rules.is_clinical(c("encounter_type"))).withColumn("day_rank", F.lit(0))
    held = F.coalesce(c("visit_type_id").isin(*HELD_VISITS), F.lit(False))

    def neighbours(prefix: str) -> dict:
        clinical = c("is_clinical") == 1
        return {
            f"prev_{prefix}encounter_date": prev(c("encounter_date")),
            f"next_{prefix}encounter_date": following(c("encounter_date")),
            f"prev_{prefix}encounter_type": prev(c("encounter_type")),
            f"next_{prefix}encounter_type": following(c("encounter_type")),
            f"prev_{prefix}rtc_date": prev(c("cur_rtc_date")),
            f"next_{prefix}rtc_date": following(c("cur_rtc_date")),
            f"prev_{prefix}clinical_date": prev_where(clinical, c("encounter_date")),
            f"next_{prefix}clinical_date": next_where(clinical, c("encounter_date")),
            f"prev_{prefix}clinical_rtc_date": prev_where(clinical, c("cur_rtc_date")),
            f"next_{prefix}clinical_rtc_date": next_where(clinical, c("cur_rtc_date")),
        }

    def build(part: DataFrame, line: Timeline) -> DataFrame:
        part = line.scan(part, __known=locf(c("rtc")), held_location_id=carry(~held, c("location_id")))
        valid = F.when(c("__known") > c("encounter_date"), c("__known"))
        part = part.withColumn("cur_rtc_date", F.coalesce(c("rtc"), valid)).withColumnRenamed("med_rtc", "cur_med_rtc_date")
        part = line.scan(part, **neighbours(""), prev_location_id=prev(c("held_location_id")))
        for prefix, column in (("program_", "program_id"), ("department_", "department_id")):
            part = Timeline([*line.key, column], line.order, line.block).scan(part, **neighbours(prefix))
        return part.drop("__known", "rtc")

    # Encounters without a programme or department form a timeline of their own, as null is one group.
    return by_timeline(df, build, t.hot_persons, tasks=t.tasks())


def appointment_columns() -> list[str]:
    out = ["encounter_id", "person_id", "program_id", "department_id", "cur_rtc_date", "cur_med_rtc_date", "held_location_id", "prev_location_id"]
    for prefix in ("", "program_", "department_"):
        for name in ("encounter_date", "encounter_type", "rtc_date", "clinical_date", "clinical_rtc_date"):
            out += [f"prev_{prefix}{name}", f"next_{prefix}{name}"]
    return out


def appointment_schedule(rows: DataFrame) -> DataFrame:
    """One row per scheduled date of an encounter: general visit, medication pickup, or both on one day."""
    general = F.struct(c("cur_rtc_date").alias("d"), F.lit(1).alias("g"), F.lit(0).alias("m"))
    pickup = F.struct(c("cur_med_rtc_date").alias("d"), F.lit(0).alias("g"), F.lit(1).alias("m"))
    both = F.struct(c("cur_rtc_date").alias("d"), F.lit(1).alias("g"), F.lit(1).alias("m"))
    slots = (
        F.when(c("cur_med_rtc_date").isNull(), F.array(general))
        .when(c("cur_rtc_date").eqNullSafe(c("cur_med_rtc_date")), F.array(both))
        .when(c("cur_rtc_date").isNull(), F.array(pickup))
        .otherwise(F.array(general, pickup))
    )
    out = rows.select("encounter_id", "person_id", F.explode(slots).alias("s"))
    return out.filter("s.d IS NOT NULL").select(
        "encounter_id", "person_id", c("s.d").alias("scheduled_date"), c("s.g").alias("is_general"), c("s.m").alias("is_med_pickup")
    )


def defaulters(t: Tables, as_of: str, grace: int = 90) -> DataFrame:
    """Patients whose last row is a clinical one and overdue, with contact details; not the dead or transferred."""
    today = F.lit(as_of).cast("date")
    last = last_visits(measured(t), encounters(t).filter(c("encounter_date") <= today))
    alive = t.person.filter("death_date IS NULL").select("person_id")
    due = rules.effective_return(c("rtc_date"), c("encounter_date"), grace)
    late = last.filter((c("is_clinical") == 1) & ~c("encounter_type").isin(110, 116) & (due < today)).join(alive, "person_id", "left_semi")
    ids = t.patient_identifier.join(late.select("person_id"), "person_id", "left_semi").groupBy("person_id").agg(
        distinct_text(F.when(c("identifier_type") == 8, filing_id(c("identifier")))).alias("filed_id"),
        distinct_text(c("identifier")).alias("identifiers"),
    )
    names = t.person_name.select("person_id", full_name(c("given_name"), c("middle_name"), c("family_name")).alias("person_name"))
    late = with_attributes(late, t.person_attribute, {"phone_number": 10})
    return late.join(names, "person_id", "left").join(ids, "person_id", "left").select(
        "person_id",
        "encounter_id",
        "location_id",
        "encounter_date",
        "rtc_date",
        F.datediff(today, due).alias("days_since_rtc"),
        "person_name",
        "phone_number",
        "identifiers",
        F.nullif("filed_id", F.lit("")).alias("filed_id"),
    )


PHONE_QUESTIONS = [(9166, "date", 0)] * 2 + [(5096, "date", 0)] * 2
PHONE_FACTS: dict[str, Fact] = {"next_phone_appointment": date(9166), "phone_planned_rtc": date(5096)}


def case_list(t: Tables, since: str, phone_type: int = 21) -> DataFrame:
    """Latest clinical or phone row per patient, the last phone contact, the return date in force, and who manages the case."""
    order = ["encounter_date", "day_rank", "encounter_id"]
    rows = measured(t)
    recent = encounters(t).filter((c("encounter_date") > F.lit(since).cast("date")) & ((c("is_clinical") == 1) | (c("encounter_type") == phone_type)))
    last = last_visits(rows, recent).select("person_id", *order, "location_id", "rtc_date", "vl")
    facts = extract_facts(t.answers(PHONE_QUESTIONS), ["encounter_id"], PHONE_FACTS)
    calls = encounters(t).filter(c("encounter_type") == phone_type).select("person_id", *order)
    phone = last_visits(calls, calls).join(facts, "encounter_id", "left").select("person_id", c("encounter_date").alias("phone_date"), *PHONE_FACTS)
    manager = t.person_attribute.filter("attribute_type_id = 68").groupBy("person_id").agg(F.max("value").cast("bigint").alias("manager_id"))
    names = t.person_name.select("person_id", full_name(c("given_name"), c("middle_name"), c("family_name")).alias("person_name"))
    managers = names.select(c("person_id").alias("manager_id"), c("person_name").alias("manager_name"))
    ids = t.patient_identifier.groupBy("person_id").agg(distinct_text(c("identifier")).alias("identifiers"))
    out = last.join(phone, "person_id", "left").join(manager, "person_id", "left").join(names, "person_id")
    out = out.join(managers, "manager_id", "left").join(ids, "person_id", "left")
    return out.select(
        "person_id", "encounter_id", "encounter_date", "location_id", "rtc_date", "vl", "phone_date", *PHONE_FACTS,
        F.coalesce("phone_planned_rtc", "rtc_date").alias("effective_rtc"), "manager_id", "manager_name", "person_name", "identifiers",
    )


# Screening questions with a yes and a no answer.
COVID = {
    "fever": (5945, 1065, 1066),
    "cough": (107, 1065, 1066),
    "difficulty_breathing": (2296, 1065, 1066),
    "travelled_to_covid_location_last_14_days": (11090, 1065, 1066),
    "close_contact_covid_case_last_14_days": (11091, 1065, 1066),
    "close_contact_risky_individual_last_30_days": (11092, 1065, 1066),
    "been_in_hospital_with_covid_cases_last_14_days": (11093, 1065, 1066),
    "screened_positive_covid": (11140, 703, 664),
}
COVID_QUESTIONS = [(q, "coded", a) for q, yes, no in COVID.values() for a in (yes, no)]
COVID_FACTS: dict[str, Fact] = {f"{n}_{k}": said(q, a) for n, (q, yes, no) in COVID.items() for k, a in (("yes", yes), ("no", no))}


def covid_screening(t: Tables, form_type: int = 14) -> DataFrame:
    """Screening answers of a form with the patient's latest care row."""
    facts = extract_facts(t.answers(COVID_QUESTIONS), ["encounter_id"], COVID_FACTS)
    forms = fill_absent(encounters(t).filter(c("encounter_type") == form_type).join(facts, "encounter_id", "left"), COVID_FACTS)
    last = last_visits(measured(t), encounters(t)).select(
        "person_id", c("vl").alias("last_vl_result"), c("vl_date").alias("last_vl_date"), c("rtc_date").alias("next_hiv_appointment_date")
    )
    answers = [F.when(c(f"{n}_yes") == 1, 1).when(c(f"{n}_no") == 1, 0).alias(n) for n in COVID]
    return forms.join(last, "person_id").join(t.person.select("person_id", "gender", "birthdate"), "person_id").select(
        "encounter_id", "person_id", "encounter_date", "gender", *answers, "last_vl_result", "last_vl_date", "next_hiv_appointment_date"
    )


DEATH_QUESTIONS = [(1570, "date", 0), (1734, "coded", 58), (1573, "coded", 16), (9082, "coded", 159), (9082, "coded", 6101), (6206, "coded", 159)] + [
    (5096, "date", 0)
] * 20


def unrecorded_deaths(t: Tables) -> DataFrame:
    """Patients with evidence of death but none recorded; test patients removed. Earlier kinds of evidence win."""
    living = t.person.filter("death_date IS NULL").select("person_id")
    answers = t.answers(DEATH_QUESTIONS)

    def found(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("person_id").distinct().join(living, "person_id", "left_semi").withColumn("evidence", F.lit(name))

    dead = found(live(t.encounter).filter("encounter_type = 21 AND location_id = 24"), "encounter")
    dead = insert_ignore(dead, found(answers.filter(c("concept_id").isin(1570, 1734, 1573)), "death form"), ["person_id"])
    coded = answers.filter(c("concept_id").isin(1733, 6206, 9082) & (c("value") == "159"))
    dead = insert_ignore(dead, found(coded, "coded death"), ["person_id"])
    return exclude(dead, t.person_attribute.filter("attribute_type_id = 28 AND value = 'true'"), ["person_id"])

