"""Programme timelines: exposed infants, pre- and post-exposure prophylaxis, chronic disease, viral load history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.functions.regimens import drug_names
from caretrail.operators import fold, rules
from caretrail.operators.facts import Fact, asked, code, date, day, drugs, extract_facts, fill_absent, number, regimen_of_bits, said
from caretrail.operators.flatten import flatten_groups
from caretrail.operators.joins import first_after, mothers
from caretrail.operators.periods import as_of, valid_in_period
from caretrail.operators.spaced import spaced
from caretrail.operators.timeline import (
    Passes,
    Timeline,
    by_timeline,
    carry,
    following,
    last_results,
    latch,
    locf,
    next_where,
    prev,
    prev_where,
)
from caretrail.plans.hiv_summary import either, yes
from caretrail.plans.rule_text import SparkText, add_rules, age, flag, status
from caretrail.plans.spine import encounters
from caretrail.session import cut_lineage
from caretrail.sources.tables import Tables, live

c = F.col
Span = tuple[str, str]


def fact_events(t: Tables, facts: dict[str, Fact], questions: list, types: tuple[int, ...] | None = None) -> DataFrame:
    """Spine encounters (of some types) with their facts."""
    rows = encounters(t)
    if types is not None:
        rows = rows.filter(c("encounter_type").isin(*types))
    found = extract_facts(t.answers(questions), ["encounter_id"], facts)
    return fill_absent(rows.join(found, "encounter_id", "left"), facts)


# Viral load history


def viral_load_history(t: Tables) -> DataFrame:
    """Every laboratory viral load with the three before it and the date of the next one."""
    labs = t.lab_event.filter("concept_id = 856")
    rows = labs.groupBy("person_id", F.to_date("obs_datetime").alias("test_date")).agg(F.min("value_numeric").alias("vl"))

    def build(part: DataFrame, line: Timeline) -> DataFrame:
        part = last_results(part, line, c("vl").isNotNull(), c("vl"), c("test_date"), "vl", 4)
        return line.scan(part, next_vl_date=following(c("test_date")))

    return by_timeline(rows, build, t.hot_lab_persons, order=("test_date",), block="test_date", tasks=t.tasks("events")).drop("vl")


# Exposed infants. Answers of the infant forms.

FEEDING = (1173, 1152, 5254, 1150, 6046, 5526, 968, 1401, 1402, 1403, 1404, 1405, 6820, 5622, 6985, 7370, 6945, 8240)
PCR_STATUS = {664: 1, 703: 2, 1118: 3, 1138: 4, 1304: 5}
HEI_FACTS: dict[str, Fact] = {
    "rtc": date(5096),
    "first_visit": said(1839, 7850),
    "enrolled_on": date(7013),
    "pcr": code(1030),
    "pcr_ordered": said(1271, 1030),
    "antibody": code(6342),
    "mother_lives": said((9601, 2000), 1065),
    "mother_known": said(969, 970),
    "mother_dead": said(9601, 1066),
    "feeding": code(1151),
    "died": said((1733, 9082, 6206), 159),
    "outcome": code(8586),
    "prophylaxis": drugs(1187),
}
HEI_QUESTIONS = (
    [(5096, "date", 0)] * 6
    + [(1030, "coded", k) for k in (664, 703, 664, 1138)] * 2
    + [(6342, "coded", k) for k in (664, 703, 664)]
    + [(1151, "coded", k) for k in FEEDING]
    + [(9601, "coded", 1065), (9601, "coded", 1066), (969, "coded", 970), (1839, "coded", 7850), (7013, "date", 0), (1271, "coded", 1030)]
    + [(9082, "coded", 159), (8586, "coded", 8411), (8586, "coded", 1067), (1187, "coded", 631), (1187, "coded", 6467)]
)
HEI_GAP = 30


def infant_summary(t: Tables) -> DataFrame:
    """Exposed infants' timeline: up to four PCR results at least a gap apart, antibody screens, feeding, outcome, mother.

    Results are kept in the order they come, each only if it is more than a gap after the last one kept: a choice with a distance, whose
    first four steps are followed.
    """
    rows = fact_events(t, HEI_FACTS, HEI_QUESTIONS)
    results = rows.filter("pcr IS NOT NULL").groupBy("person_id", c("encounter_date").alias("day")).agg(F.min("pcr").alias("pcr"))
    states = spaced_results(results, "hiv_dna_pcr", 4, HEI_GAP, F.year("__at") if t.hot_persons else None)
    marked = fold.mark_states(rows, states)

    def build(part: DataFrame, line: Timeline) -> DataFrame:
        today = c("encounter_date")
        part = fold.apply_states(part, line)
        feeding = None
        for i, answer in enumerate(FEEDING, 1):
            test = c("feeding") == answer
            feeding = F.when(test, i) if feeding is None else feeding.when(test, i)
        mother = F.when(either(yes("mother_lives"), yes("mother_known")), 1).when(yes("mother_dead"), 2)
        p = Passes()
        p.look(
            0,
            known_rtc=locf(c("rtc")),
            date_enrolled=latch(F.lit(True), F.when(yes("first_visit"), F.coalesce(c("enrolled_on"), today)).otherwise(today)),
            initial_hiv_dna_pcr_order_date=latch(yes("pcr_ordered") | c("pcr").isNotNull(), today),
            hiv_dna_pcr_date=locf(F.when(yes("pcr_ordered") | c("pcr").isNotNull(), today)),
            antibody_screen_1=latch(c("antibody").isNotNull(), c("antibody")),
            antibody_screen_1_date=latch(c("antibody").isNotNull(), today),
            infant_feeding_method=locf(feeding),
            mother_alive=locf(mother),
            mother_alive_on_child_enrollment=latch(mother.isNotNull(), mother),
            hei_outcome=locf(c("outcome")),
            newborn_arv_meds=locf(regimen_of_bits(c("prophylaxis"))),
            death_sign=latch(yes("died"), today),
            prev_clinical_datetime=prev_where(c("is_clinical") == 1, today),
            next_clinical_datetime=next_where(c("is_clinical") == 1, today),
            next_encounter_datetime=following(today),
        )
        second = c("antibody").isNotNull() & (today > c("antibody_screen_1_date"))
        p.look(
            1,
            prev_rtc_date=prev(c("known_rtc")),
            antibody_screen_2=latch(F.coalesce(second, F.lit(False)), c("antibody")),
            antibody_screen_2_date=latch(F.coalesce(second, F.lit(False)), today),
        )
        return p.run(line, part)

    df = by_timeline(marked, build, t.hot_persons, tasks=t.tasks())
    df = df.join(t.person.select("person_id", "gender", "birthdate", "death_date"), "person_id")
    df = df.withColumn("death_date", F.coalesce("death_date", "death_sign"))
    df = df.withColumn("rtc_date", F.coalesce("rtc", F.when(c("known_rtc") > c("encounter_date"), c("known_rtc"))))
    return mothers(df, t.relationship, t.person).select(*HEI_COLUMNS)


HEI_COLUMNS = [
    "person_id", "encounter_id", "encounter_date", "encounter_type", "is_clinical", "location_id", "gender", "birthdate",
    "death_date", "rtc_date", "prev_rtc_date", "date_enrolled", "initial_hiv_dna_pcr_order_date", "hiv_dna_pcr_date",
    *[f"hiv_dna_pcr_{i}{s}" for i in range(1, 5) for s in ("", "_date")], "antibody_screen_1", "antibody_screen_1_date",
    "antibody_screen_2", "antibody_screen_2_date", "infant_feeding_method", "mother_alive",
    "mother_alive_on_child_enrollment", "hei_outcome", "newborn_arv_meds", "mother_id", "prev_clinical_datetime",
    "next_clinical_datetime", "next_encounter_datetime",
]


def spaced_results(results: DataFrame, name: str, depth: int, gap: int, block: Column | None = None) -> DataFrame:
    """The first `depth` results of a person, each more than `gap` days after the one taken before, as known from the day of each on.

    `results` has person_id, day and pcr, once a day.
    """
    results = cut_lineage(results)
    taken = spaced(results, ["person_id"], "day", gap, depth, block).join(results, ["person_id", "day"])
    own = F.struct("nth", F.col("pcr").cast("double").alias("value"), "day")
    # At most `depth` rows a person: each knows those before it.
    all_taken = taken.groupBy("person_id").agg(F.array_sort(F.collect_list(own)).alias("all"))
    rows = all_taken.select("person_id", "all", F.explode("all").alias("now"))
    fields = []
    for i in range(depth):
        known = F.col("now.nth") > i
        fields += [F.when(known, F.get("all", F.lit(i))[n]).alias(f"{name}_{i + 1}{s}") for n, s in (("value", ""), ("day", "_date"))]
    return rows.select("person_id", F.col("now.day").alias("day"), *fields)


def infant_rules(d) -> list[dict[str, str]]:
    now = "BETWEEN period_start AND period_end"
    one = {
        "age_in_months": d.months("birthdate", "period_end"),
        "age": age(d, "birthdate", "period_end"),
        "enrolled_this_month": flag(f"date_enrolled {now}"),
        "initial_pcr_this_month": flag(f"last_pcr_1_date {now}"),
        "second_pcr_this_month": flag(f"last_pcr_2_date {now}"),
        "third_pcr_this_month": flag(f"last_pcr_3_date {now}"),
        "initial_antibody_screening_this_month": flag(f"antibody_screen_1_date {now}"),
        "second_antibody_screening_this_month": flag(f"antibody_screen_2_date {now}"),
        "days_late": d.days("COALESCE(rtc_date, encounter_date + 30)", "period_end"),
        "infection_status_this_month": "CASE CAST(hiv_dna_pcr_1 AS INTEGER) " + " ".join(f"WHEN {k} THEN {v}" for k, v in PCR_STATUS.items()) + " END",
    }
    two = {"retention_status": status("days_late", rules.MONTHLY_CUTS, first="WHEN death_date < period_start THEN 'dead'")}
    three = {
        "active_and_eligible_for_ovc": flag("retention_status = 'active' AND age <= 19"),
        "inactive_and_eligible_for_ovc": flag("(retention_status = 'ltfu' OR retention_status = 'defaulter') AND age <= 19"),
    }
    return [one, two, three]


def infant_month_columns() -> list[str]:
    head = ["person_id", "period_end", "encounter_id", "location_id", "county", "hei_outcome", "infant_feeding_method", "mother_alive"]
    return head + [n for stage in infant_rules(SparkText) for n in stage]


def infant_monthly(t: Tables, span: Span | None = None) -> DataFrame:
    """Monthly infant indicators: the row in force, with the PCR dates known on the infant's last row; all months if no span is given."""
    span = span or t.horizon("month")
    rows = infant_summary(t)
    last = rows.filter("next_encounter_datetime IS NULL").select(
        "person_id", *[c(f"hiv_dna_pcr_{i}_date").alias(f"last_pcr_{i}_date") for i in (1, 2, 3)]
    )
    df = valid_in_period(rows.filter("is_clinical = 1"), "month", c("encounter_date"), c("next_clinical_datetime"), *span)
    df = df.join(last, "person_id").join(t.location.select("location_id", "county"), "location_id", "left")
    df = df.withColumn("period_start", F.trunc("period_end", "month").cast("date"))
    return add_rules(df, infant_rules(SparkText)).select(*infant_month_columns())


# Pre-exposure prophylaxis. Answers of the prophylaxis forms.

POPULATION = [(((9782,), (6096,)), "1"), (((9782,), (11288,)), "2"), (((9782,), (9783,)), "3"), (((9782,), (6578,)), "4")]
PREP_FACTS: dict[str, Fact] = {
    "rtc": date(5096),
    "stopped": said(9772, 6102),
    "status_asked": asked(9772),
    "not_taking": said(9773, 1066),
    "meds": drugs(9774),
    "meds_asked": asked(9774),
    "rapid_positive": said(1040, 703),
    "rapid": code(1040),
    "rapid_on": day(1040),
    "exit_positive": said(1596, 1169),
    "started_on": date(9789),
    "transferred_in": asked(7015),
    "breastfeeding_yes": said(5632, 1065),
    "breastfeeding_no": said(5632, 1066),
    "pregnant": said(9753, 1484),
    "pregnancy_over": said(1846, 1843, 6648, 50, 9910, 1993),
    "population_1": said(9782, 6096),
    "population_2": said(9782, 11288),
    "population_3": said(9782, 9783),
    "population_4": said(9782, 6578),
    "sub_population": code(6578),
    "died": said((1733, 9082, 6206), 159),
}
SUB_POPULATION = {8291: "1", 9785: "2", 9786: "3", 105: "4", 11290: "5", 11291: "6"}
PREP_QUESTIONS = (
    [(5096, "date", 0)] * 8
    + [(9772, "coded", 6102), (9772, "coded", 1256), (9772, "coded", 1257), (9773, "coded", 1066), (9774, "coded", 802), (9774, "coded", 6180), (9774, "coded", 1400)]
    + [(1040, "coded", 664), (1040, "coded", 703), (1040, "coded", 664), (1596, "coded", 1169), (9789, "date", 0), (7015, "coded", 1287)]
    + [(5632, "coded", 1065), (5632, "coded", 1066), (9753, "coded", 1484), (1846, "coded", 1843), (9782, "coded", 6096), (9782, "coded", 11288)]
    + [(9782, "coded", 9783), (9782, "coded", 6578), (6578, "coded", 8291), (6578, "coded", 105), (9082, "coded", 159)]
)
PREP_EXIT_TYPE = 21


def prep_summary(t: Tables) -> DataFrame:
    """Prophylaxis timeline: regimen, start, discontinuation and its date, seroconversion, population."""
    rows = fact_events(t, PREP_FACTS, PREP_QUESTIONS).join(t.person.select("person_id", "gender", "birthdate", "death_date"), "person_id")

    def build(part: DataFrame, line: Timeline) -> DataFrame:
        today = c("encounter_date")
        leaves = yes("stopped") | (c("encounter_type") == PREP_EXIT_TYPE)
        meds_event = either(yes("not_taking"), yes("stopped"), yes("meds_asked"))
        meds = F.when(~yes("not_taking") & ~yes("stopped"), regimen_of_bits(c("meds")))
        population = None
        for n in "1234":
            population = F.when(yes(f"population_{n}"), n) if population is None else population.when(yes(f"population_{n}"), n)
        p = Passes()
        p.look(
            0,
            enrollment_date=latch(F.lit(True), F.when(yes("transferred_in"), F.lit("1900-01-01").cast("date")).otherwise(today)),
            known_rtc=locf(c("rtc")),
            discontinued_prep=carry(leaves | yes("status_asked"), F.when(leaves, 1)),
            cur_prep_meds=carry(meds_event, meds),
            hiv_rapid_test_result=locf(c("rapid")),
            hiv_rapid_test_date=locf(c("rapid_on")),
            population_type=locf(population),
            death_sign=latch(yes("died"), today),
            prev_encounter_datetime=prev(today),
            next_encounter_datetime=following(today),
        )
        pregnant = yes("pregnant") & (c("gender") == "F")
        p.look(0, is_pregnant=locf(F.when(pregnant, 1).when(yes("pregnancy_over"), 0)))
        positive = yes("rapid_positive") | ((c("discontinued_prep") == 1) & yes("exit_positive"))
        positive = F.coalesce(positive, F.lit(False))
        p.look(
            1,
            prev_rtc_date=prev(c("known_rtc")),
            prev_discontinued_prep=prev(c("discontinued_prep")),
            prev_prep_meds=prev(c("cur_prep_meds")),
            first_prep_regimen=latch(c("cur_prep_meds").isNotNull(), c("cur_prep_meds")),
            turned_positive=carry(positive | c("rapid").isNotNull(), F.when(positive, 1)),
            turned_positive_date=latch(positive, F.coalesce(c("rapid_on"), today)),
            sub_population_type=locf(F.when(c("population_type") == "4", _mapped_text(SUB_POPULATION, c("sub_population")))),
        )
        begins = (c("discontinued_prep") == 1) & c("prev_discontinued_prep").isNull()
        ends = c("discontinued_prep").isNull() & (c("prev_discontinued_prep") == 1)
        starts = c("cur_prep_meds").isNotNull() & ~c("cur_prep_meds").eqNullSafe(c("prev_prep_meds"))
        p.look(
            2,
            discontinued_prep_date=carry(F.coalesce(begins | ends, F.lit(False)), F.when(begins, today)),
            prep_start_date=locf(F.coalesce(c("started_on"), F.when(starts, today))),
        )
        p.look(3, initial_prep_start_date=latch(c("prep_start_date").isNotNull(), c("prep_start_date")))
        return p.run(line, part)

    df = by_timeline(rows, build, t.hot_persons, tasks=t.tasks())
    df = df.select(
        "*",
        F.coalesce("rtc", F.when(c("known_rtc") > c("encounter_date"), c("known_rtc"))).alias("rtc_date"),
        drug_names(c("cur_prep_meds")).alias("cur_prep_meds_names"),
        F.when(yes("breastfeeding_yes"), 1).when(yes("breastfeeding_no"), 0).alias("is_breastfeeding"),
    )
    return df.withColumn("death_date", F.coalesce("death_date", "death_sign")).select(*PREP_COLUMNS)


PREP_COLUMNS = [
    "person_id", "encounter_id", "encounter_date", "encounter_type", "location_id", "gender", "birthdate", "death_date",
    "enrollment_date", "prev_encounter_datetime", "next_encounter_datetime", "rtc_date", "prev_rtc_date",
    "discontinued_prep", "prev_discontinued_prep", "discontinued_prep_date", "turned_positive", "turned_positive_date",
    "prev_prep_meds", "cur_prep_meds", "cur_prep_meds_names", "first_prep_regimen", "prep_start_date",
    "initial_prep_start_date", "is_breastfeeding", "is_pregnant", "population_type", "sub_population_type",
    "hiv_rapid_test_result", "hiv_rapid_test_date",
]


def _mapped_text(table: dict[int, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def prep_month_rules(d) -> list[dict[str, str]]:
    now = "BETWEEN period_start AND period_end"
    one = {
        "age": age(d, "birthdate", "period_end"),
        "days_since_rtc_date": d.days("rtc_date", "period_end"),
        "visit_this_month": flag(f"encounter_date {now}"),
        "appointment_this_month": flag(f"prev_rtc_date {now} OR rtc_date {now}"),
        "enrolled_in_prep_this_month": flag(f"enrollment_date {now}"),
        "discontinued_from_prep_this_month": flag(f"discontinued_prep_date {now}"),
        "turned_positive_this_month": flag(f"turned_positive_date {now}"),
        "cumulative_turned_positive_this_month": flag("turned_positive = 1"),
        "has_hiv_test_this_month": flag(f"hiv_rapid_test_result IN (703, 664, 1138) AND hiv_rapid_test_date {now}"),
    }
    two = {
        "scheduled_visit_this_month": flag("visit_this_month = 1 AND appointment_this_month = 1"),
        "early_appointment_this_month": flag("visit_this_month = 1 AND appointment_this_month = 0 AND encounter_date < prev_rtc_date"),
        "late_appointment_this_month": flag("visit_this_month = 1 AND appointment_this_month = 0 AND encounter_date > prev_rtc_date"),
        "missed_appointment_this_month": flag("visit_this_month = 0 AND appointment_this_month = 1"),
        "status": status("days_since_rtc_date", rules.PREP_CUTS, first="WHEN death_date < period_end THEN 'dead' WHEN discontinued_prep_date IS NOT NULL THEN 'discontinued'"),
    }
    three = {
        "active_on_prep_this_month": flag("status IN ('active', 'defaulter')"),
        "prep_defaulter_this_month": flag("status = 'defaulter'"),
        "cumulative_prep_ltfu_this_month": flag("status = 'ltfu'"),
        "prep_ltfu_this_month": flag("status = 'ltfu' AND days_since_rtc_date < 60"),
        "prep_discontinued_this_month": flag(f"status = 'discontinued' AND discontinued_prep_date {now}"),
        "prev_on_prep_and_turned_positive": flag("turned_positive_this_month = 1 AND status = 'discontinued'"),
    }
    return [one, two, three]


def prep_month_columns() -> list[str]:
    return ["person_id", "period_end", "encounter_id", "location_id", "cur_prep_meds_names"] + [n for s in prep_month_rules(SparkText) for n in s]


def prep_monthly(t: Tables, span: Span | None = None) -> DataFrame:
    """Latest prophylaxis row per patient and month end, all months if no span is given. Months of different years stay apart."""
    span = span or t.horizon("month")
    df = as_of(prep_summary(t), "month", "encounter_date", ["person_id"], ["encounter_date", "encounter_id"], *span)
    df = df.withColumn("period_start", F.trunc("period_end", "month").cast("date"))
    return add_rules(df, prep_month_rules(SparkText)).select(*prep_month_columns())


def prep_week_rules(d) -> list[dict[str, str]]:
    one = {
        "age": age(d, "birthdate", "period_end"),
        "days_since_rtc_date": d.days("rtc_date", "period_end"),
        "visit_this_week": flag("encounter_date BETWEEN period_start AND period_end"),
        "appointment_this_week": flag("prev_rtc_date BETWEEN period_start AND period_end OR rtc_date BETWEEN period_start AND period_end"),
        # Whole weeks between the weeks of the two dates; week numbers of different years cannot be subtracted.
        "weeks_since_rtc": f"CAST(FLOOR({d.days('rtc_week_end', 'period_end')} / 7) AS INTEGER)",
    }
    two = {
        "scheduled_visit_this_week": flag("visit_this_week = 1 AND appointment_this_week = 1"),
        "early_appointment_this_week": flag("visit_this_week = 1 AND appointment_this_week = 0 AND encounter_date < prev_rtc_date"),
        "late_appointment_this_week": flag("visit_this_week = 1 AND appointment_this_week = 0 AND encounter_date > prev_rtc_date"),
        "missed_appointment_this_week": flag("visit_this_week = 0 AND appointment_this_week = 1"),
        "status": status("weeks_since_rtc", [(0, "active"), (4, "defaulter")], first="WHEN death_date < period_start THEN 'dead' WHEN discontinued_prep_date <= period_end OR exit_date <= period_end THEN 'discontinued'"),
    }
    three = {
        "active_on_prep_this_week": flag("status = 'active'"),
        "prep_defaulter_this_week": flag("status = 'defaulter'"),
        "prep_ltfu_this_week": flag("status = 'ltfu'"),
    }
    return [one, two, three]


def prep_week_columns() -> list[str]:
    return ["person_id", "period_end", "encounter_id", "location_id", "exit_date"] + [n for s in prep_week_rules(SparkText) for n in s]


def prep_weekly(t: Tables, span: Span | None = None) -> DataFrame:
    """Latest prophylaxis row per patient and week, with the first exit after that row; all weeks if no span is given."""
    span = span or t.horizon("week")
    rows = prep_summary(t).filter(c("encounter_type") != PREP_EXIT_TYPE)
    exits = encounters(t).filter(c("encounter_type") == PREP_EXIT_TYPE).select("person_id", c("encounter_date").alias("exit_on"))
    rows = first_after(rows, exits, "person_id", "encounter_date", "exit_on", "exit_date", t.hot_persons)
    df = as_of(rows, "week", "encounter_date", ["person_id"], ["encounter_date", "encounter_id"], *span)
    df = df.withColumn("period_start", F.date_sub("period_end", 6))
    df = df.withColumn("rtc_week_end", F.date_add("rtc_date", 7 - F.dayofweek("rtc_date")))
    return add_rules(df, prep_week_rules(SparkText)).select(*prep_week_columns())


# Post-exposure prophylaxis. Exposure answers.

EXPOSURES = (5619, 5507, 1496, 6280, 8710, 8713, 8714)
PEP_FACTS: dict[str, Fact] = {
    "rtc": date(5096),
    "exposed": said(1972, *EXPOSURES),
    "exposure_asked": asked(1972),
    "started": said(1705, 1149),
    "regimen_asked": asked(7123),
}
PEP_QUESTIONS = [(5096, "date", 0)] * 4 + [(1972, "coded", k) for k in (*EXPOSURES, 1107)] + [(1705, "coded", 1149), (7123, "coded", 802)]
PEP_TYPES, PEP_FIRST = (1, 2), 1


def pep_summary(t: Tables) -> DataFrame:
    """Post-exposure timeline: enrolment, exposure at work, start of prophylaxis."""

    def build(part: DataFrame, line: Timeline) -> DataFrame:
        today = c("encounter_date")
        starts = (c("encounter_type") == PEP_FIRST) & (yes("started") | yes("regimen_asked"))
        part = line.scan(
            part,
            enrollment_date=latch(F.lit(True), today),
            known_rtc=locf(c("rtc")),
            hiv_exposed_occupational=locf(F.when(yes("exposed"), 1).when(yes("exposure_asked"), 0)),
            pep_start_date=locf(F.when(starts, today)),
        )
        return line.scan(part, prev_rtc_date=prev(c("known_rtc")))

    df = by_timeline(fact_events(t, PEP_FACTS, PEP_QUESTIONS, PEP_TYPES), build, t.hot_persons, tasks=t.tasks())
    rtc = F.coalesce("rtc", F.when(c("known_rtc") > c("encounter_date"), c("known_rtc")))
    return df.select(
        "person_id", "encounter_id", "encounter_date", "enrollment_date", "hiv_exposed_occupational", "pep_start_date", "prev_rtc_date", rtc.alias("cur_rtc_date")
    )


# Chronic disease. Measures of the chronic disease forms.

CDM_VALUES = {"lmp": 1836, "sbp": 5085, "dbp": 5086, "pulse": 5087, "fbs": 6252, "rbs": 887}
CDM_CARRIED = {"hb_a1c": 6126, "creatinine": 790, "total_cholesterol": 1006, "hdl": 1007, "ldl": 1008, "triglycerides": 1009}
CDM_DATES = {"hb_a1c_date": 6126, "creatinine_date": 790, "lipid_panel_date": 1006}
CDM_CODES = {"dm_status": 7287, "htn_status": 7288, "dm_meds": 7290, "htn_meds": 10241, "problems": 6042}
CDM_FACTS: dict[str, Fact] = {
    "rtc": date(5096),
    "lmp": date(1836),
    **{n: number(k) for n, k in {**CDM_VALUES, **CDM_CARRIED}.items() if n != "lmp"},
    **{n: day(k) for n, k in CDM_DATES.items()},
    **{n: code(k) for n, k in CDM_CODES.items()},
}
CDM_QUESTIONS = (
    [(5096, "date", 0)] * 3
    + [(1836, "date", 0)]
    + [(k, "number", 3) for n, k in {**CDM_VALUES, **CDM_CARRIED}.items() if n != "lmp"]
    + [(k, "coded", v) for k in CDM_CODES.values() for v in (1065, 7281)]
)
CDM_PARENTS = (7307, 7334)


def chronic_disease(t: Tables) -> DataFrame:
    """Chronic disease visits: measures of the day, carried laboratory values with their dates, and prescriptions."""
    rows = fact_events(t, CDM_FACTS, CDM_QUESTIONS).join(t.person.select("person_id", "death_date"), "person_id")

    def build(part: DataFrame, line: Timeline) -> DataFrame:
        fresh = {n: c(n) for n in [*CDM_CARRIED, *CDM_DATES]}
        part = line.scan(
            part,
            known_rtc=locf(c("rtc")),
            **{f"cur_{n}": locf(v) for n, v in fresh.items()},
            prev_clinical_datetime=prev_where(c("is_clinical") == 1, c("encounter_date")),
            next_clinical_datetime=next_where(c("is_clinical") == 1, c("encounter_date")),
        )
        return line.scan(part, prev_rtc_date=prev(c("known_rtc")))

    df = by_timeline(rows, build, t.hot_persons, tasks=t.tasks())
    obs = live(t.obs).withColumn("obs_group_id", c("encounter_id") * 10 + c("concept_id") % 2)
    obs = obs.withColumn("group_concept", F.when(c("concept_id") == 1250, 7307).when(c("concept_id") == 1255, 7334))
    prescriptions = flatten_groups(obs, CDM_PARENTS).withColumnRenamed("obs_groups", "prescriptions")
    rtc = F.coalesce("rtc", F.when(c("known_rtc") > c("encounter_date"), c("known_rtc"))).alias("cur_rtc_date")
    return df.join(prescriptions, "encounter_id", "left").select(
        "person_id", "encounter_id", "encounter_date", "death_date", rtc, "prev_rtc_date", *CDM_VALUES,
        *[f"cur_{n}" for n in [*CDM_CARRIED, *CDM_DATES]], *CDM_CODES, "prescriptions", "prev_clinical_datetime", "next_clinical_datetime",
    )

