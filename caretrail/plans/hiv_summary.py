"""Longitudinal HIV care summary: one row per encounter with the state carried along the patient's timeline.

Stages, all on one partitioning by person: event facts; day states of the guarded results and of pregnancy; carried
columns; columns that look at carried columns; columns that look at the next rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caretrail.functions import dates as d
from caretrail.functions.regimens import drug_names
from caretrail.operators import fold, rules
from caretrail.operators.facts import Fact, extract_packed, raised, regimen_of_bits, unpack
from caretrail.operators.timeline import (
    Passes,
    Timeline,
    by_timeline,
    carry,
    following,
    latch,
    latest_max,
    locf,
    max_ahead,
    next_where,
    pack,
    prev,
    prev_where,
    running,
    unpacked,
)
from caretrail.plans.hiv_facts import DAY_FACTS, EXCLUDING, FACTS, LAB_VALUES, MDT_SESSIONS, QUESTIONS
from caretrail.plans.spine import encounters
from caretrail.sources.tables import Tables

LAB_TYPE, OUTREACH_TYPE, TRIAGE_TYPE, DEATH_TYPE, ELSEWHERE, IN_NETWORK = 99999, 21, 116, 31, 9999, 9998
PREGNANCY_TYPES, DELIVERY_TYPES, MDT_TYPE, BORDER_TYPE = (32, 33, 44, 10), (11, 47, 34), 110, 218
UNKNOWN_DATE = "1900-01-01"


def c(name: str) -> Column:
    return F.col(name)


def yes(name: str) -> Column:
    """A fact flag is set. Flags are never null, so neither is this."""
    return F.col(name) == 1


def either(*tests: Column) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def bit(test: Column) -> Column:
    return F.when(test, 1).otherwise(0)


def unknown_date() -> Column:
    return F.lit(UNKNOWN_DATE).cast("date")


def cur_rtc() -> Column:
    """The return date given on the row, or the last one known if it is still ahead."""
    return F.coalesce(c("rtc"), F.when(c("known_rtc") > c("encounter_date"), c("known_rtc")))


def of_patients(events: DataFrame, facts: dict[str, Fact]) -> DataFrame:
    """Events whose packed facts do not say that the person is not known to be infected."""
    for name in EXCLUDING:
        if name in facts:
            events = events.filter(~raised(facts, name))
    return events


def events_until_next_clinical(df: DataFrame, line: Timeline, events: dict[str, tuple[Column, Column]]) -> DataFrame:
    """For every row, the latest event of each kind between the clinical row that opens its gap and the next one.

    Clinical rows number the gaps; a gap is a sub-partition of the person, so no new exchange is planned. Where persons are walked in
    blocks a gap may span many of them: what it holds up to a row is carried from the blocks before, what follows from those behind.
    A carried value says which gap it is of, so a new gap takes nothing over.
    """
    df = line.scan(df, __gap=running(F.col("is_clinical")))
    values = {n: F.when(test & (F.col("is_clinical") != 1), value) for n, (test, value) in events.items()}
    if line.block is None:
        gap = Window.partitionBy(*line.key, "__gap")
        return df.select("*", *[F.max(v).over(gap).alias(n) for n, v in values.items()]).drop("__gap")

    def of(at: Column, value: Column) -> Column:
        return F.when(value.isNotNull(), F.struct(at.alias("gap"), value.alias("value")))

    here = F.col("__gap")
    looks = {f"__to_{n}": latest_max(of(here, v)) for n, v in values.items()}
    looks |= {f"__from_{n}": max_ahead(of(-here, v)) for n, v in values.items()}
    df = line.scan(df, **looks)
    found = [
        F.greatest(
            F.when(F.col(f"__to_{n}.gap") == here, F.col(f"__to_{n}.value")), F.when(F.col(f"__from_{n}.gap") == -here, F.col(f"__from_{n}.value"))
        ).alias(n)
        for n in values
    ]
    return df.select("*", *found).drop("__gap", *looks)


def events(t: Tables, facts: dict[str, Fact], questions: list, keys: DataFrame | None) -> DataFrame:
    """Encounters with their packed facts, and laboratory days as events of their own type."""
    forms = encounters(t, keys).join(extract_packed(t.answers(questions), ["encounter_id"], facts), "encounter_id", "left")
    forms = of_patients(forms, facts)
    orders = t.clinical_order.groupBy("encounter_id").agg(
        *[F.max(F.when(F.col("concept_id") == k, 1).otherwise(0)).alias(n) for n, k in ORDERS.items()]
    )
    visits = t.visit.select(F.col("visit_id").alias("encounter_id"), "visit_type_id")
    forms = forms.join(orders, "encounter_id", "left").join(visits, "encounter_id", "left")
    forms = forms.withColumn("is_clinical", rules.is_clinical(c("encounter_type"), c("visit_type_id")))
    labs = t.lab_event.select(
        "person_id",
        F.to_date("obs_datetime").alias("obs_date"),
        "obs_id",
        "concept_id",
        "value_numeric",
    )
    if keys is not None:
        labs = labs.join(keys.select("person_id"), "person_id", "left_semi")
    results = labs.groupBy("person_id", "obs_date").agg(
        (F.min("obs_id") + 100_000_000).alias("encounter_id"),
        *[F.min(F.when(F.col("concept_id") == k, F.col("value_numeric"))).alias(n) for n, k in LAB_VALUES.items()],
    )
    real = t.person.filter("voided = 0 AND is_test = 0").select("person_id")
    results = results.join(real, "person_id", "left_semi").select(
        "encounter_id",
        "person_id",
        F.col("obs_date").alias("encounter_date"),
        F.col("obs_date").cast("timestamp_ntz").alias("encounter_datetime"),
        F.lit(LAB_TYPE).alias("encounter_type"),
        F.lit(1).alias("day_rank"),
        F.lit(0).alias("is_clinical"),
        *[n for n in LAB_VALUES if n in facts],
    )
    return forms.unionByName(results, allowMissingColumns=True).fillna(0, list(ORDERS))


ORDERS = {"vl_order": 856, "cd4_order": 657, "pcr_order": 1030}


def phone_outreach() -> Column:
    """1: a call reached the person, 2: it did not."""
    reached = (yes("phone_tried") | yes("phone_used") | yes("phone_method")) & yes("phone_reached")
    failed = (yes("phone_attempt") | yes("phone_method")) & yes("phone_failed")
    return F.when(reached | (yes("phone_method") & yes("home_reached")), 1).when(failed | (yes("phone_method") & yes("home_failed")), 2)


def day_states(df: DataFrame) -> DataFrame:
    """Accepted viral loads and PCR results, and pregnancy, folded over the days on which anything bears on them."""
    lab = c("encounter_type") == LAB_TYPE
    start = either(c("encounter_type").isin(*PREGNANCY_TYPES), yes("gestation_asked"), yes("pregnant"))
    stop = either(c("encounter_type").isin(*DELIVERY_TYPES), yes("not_pregnant"), yes("delivered"), yes("delivered_now"), yes("pregnancy_over"))
    due = F.coalesce(
        d.due_date_from_period(c("last_period")), d.due_date_from_weeks(c("encounter_date"), c("gestation_weeks")), c("due_on")
    )
    bears = either(c("vl").isNotNull(), c("pcr").isNotNull(), start, stop, due.isNotNull())

    def results(prefix: str, value: str, on: str) -> list[Column]:
        form = ~lab & c(value).isNotNull()
        return [
            F.max(F.when(lab, c(value))).alias(f"{prefix}lab_value"),
            F.max_by(F.when(form, c(value)), F.when(form, F.struct(on, value))).alias(f"{prefix}form_value"),
            F.max(F.when(form, c(on))).alias(f"{prefix}form_date"),
        ]

    daily = (
        df.filter(bears)
        .groupBy("person_id", c("encounter_date").alias("day"))
        .agg(
            *results("vl_", "vl", "vl_on"),
            *results("pcr_", "pcr", "pcr_on"),
            (F.max(bit(start)) == 1).alias("start"),
            (F.max(bit(stop)) == 1).alias("stop"),
            F.min(due).alias("due"),
        )
    )
    steps = [fold.accepted_step("vl_"), fold.accepted_step("pcr_"), fold.pregnancy_step()]
    return fold.fold_steps(daily, ["person_id"], steps)


def event_columns(df: DataFrame) -> DataFrame:
    """Columns that need nothing but the event itself."""
    today = c("encounter_date")
    stop, lab = yes("arv_stop"), c("encounter_type") == LAB_TYPE
    past = yes("drugs_past_asked") & ~yes("drugs_past_none")
    meds_event = either(stop, yes("drugs_started"), yes("drugs_current_asked"), yes("drugs_reported_asked"), past)
    bits = (
        F.when(stop, F.lit(None))
        .when(yes("drugs_started"), c("drugs_now"))
        .when(yes("drugs_current_asked"), c("drugs_current"))
        .when(yes("drugs_reported_asked"), c("drugs_reported"))
        .when(past, c("drugs_past"))
    )
    line = F.when(stop, F.lit(None).cast("int"))
    for question in (1250, 1088, 2154):
        for n in (1, 2, 3):
            line = line.when(yes(f"line_{question}_{n}"), F.lit(n))
    tb_screen = either(
        yes("tb_test_asked"), yes("tb_test_ordered"), yes("tb_symptom"), yes("tb_cough"), yes("tb_exam"), yes("tb_none"),
        yes("tb_treatment_started"), yes("tb_contact") & ~yes("tb_plan_continue"),
    )
    outreach = c("encounter_type") == OUTREACH_TYPE
    new = {
        "out_of_care": F.when(
            either(yes("discharged"), yes("transfer_away"), c("exit_code").isNotNull(), yes("care_left"), c("encounter_type") == DEATH_TYPE), 1
        ),
        "visit_type": c("visit_type_id"),
        "is_transit": rules.is_transit(c("visit_type_id")),
        "cur_arv_meds_strict": regimen_of_bits(bits),
        "med_pickup_rtc_date": c("med_pickup"),
        "__meds_event": bit(meds_event),
        "__meds": regimen_of_bits(bits),
        "__past_meds": regimen_of_bits(c("drugs_past")),
        "__line_event": bit(stop | line.isNotNull()),
        "cur_arv_line_strict": line,
        "tb_screen": F.when(tb_screen, 1),
        "on_tb_tx": bit(~yes("tb_stop") & (yes("tb_plan") | (yes("tb_drugs") & ~yes("tb_drugs_none")))),
        "phone_outreach": F.when(outreach, phone_outreach()),
        "home_outreach": F.when(
            outreach,
            F.when((yes("home_tried") | yes("home_method")) & yes("home_reached"), 1).when(
                (yes("home_tried") | yes("home_method")) & yes("home_failed"), 2
            ),
        ),
        "outreach_attempts": F.when(outreach, F.coalesce("attempts_a", "attempts_b").cast("int")),
        "hiv_rapid_test_resulted": c("rapid_test").cast("int"),
        "hiv_rapid_test_resulted_date": F.when(c("rapid_test").isNotNull(), today),
        "ca_cx_screen": F.when(yes("cervix_no"), 0).when(yes("cervix_yes"), 1).when(yes("cervix_na"), 3).when(yes("cervix_undone"), 4),
        "vl_resulted": F.when(lab, c("vl")),
        "cd4_resulted": F.when(lab, c("cd4")),
        "hiv_dna_pcr_resulted": F.when(lab, c("pcr")),
    }
    return df.select("*", *[v.alias(k) for k, v in new.items()])


def timeline_passes(facts: dict[str, Fact]) -> Passes:
    """The summary's carried state, by the pass each column becomes known in."""
    passes = Passes()
    carried_columns(passes, facts)
    dependent_columns(passes)
    return passes


def carried_columns(passes: Passes, facts: dict[str, Fact]) -> None:
    """State known on each row from its own and earlier events."""
    today = c("encounter_date")
    lab = c("encounter_type") == LAB_TYPE
    enrolling = ~c("encounter_type").isin(OUTREACH_TYPE, LAB_TYPE)
    enrolled = F.coalesce(c("enrolled_on"), F.when(yes("transferred_in"), unknown_date()), F.when(enrolling, today))
    enrolled_at = F.when(yes("enrolled_elsewhere") | yes("transferred_in"), ELSEWHERE).when(enrolling, c("location_id"))
    mdt = None
    for n, _ in MDT_SESSIONS:
        mdt = F.when(yes(f"mdt_{n}"), n) if mdt is None else mdt.when(yes(f"mdt_{n}"), n)
    if "mdt_session" in facts:
        mdt = F.coalesce(mdt, c("mdt_session"))
    who = F.when(yes("who_1"), 1).when(yes("who_2"), 2).when(yes("who_3"), 3).when(yes("who_4"), 4)
    discordant = None
    for i, answer in enumerate((1065, 1066, 1067, 1175, 6826, 6827), 1):
        test = c("discordant_code") == answer
        discordant = F.when(test, i) if discordant is None else discordant.when(test, i)
    history = yes("ipt_history")
    contraceptive_start = F.when(yes("contraceptive"), today).when(yes("contraceptive_374"), F.coalesce(c("ipt_started_on"), today))
    no_method = yes("contraceptive_no") | yes("contraceptive_none")
    method = F.coalesce("contraceptive_code", "contraceptive_374_code")
    modality = (
        F.when(yes("tb_modality_xpert"), 8070).when(yes("tb_modality_smear"), 307).when(yes("tb_modality_culture"), 2311)
        .when(yes("tb_modality_lam"), 1506).when(yes("tb_modality_xray"), 12)
    )

    def answer(name: str) -> Column:
        return F.when(yes(f"{name}_yes"), 1).when(yes(f"{name}_no"), 0)

    passes.look(
        0,
        enrollment_date=latch(enrolled.isNotNull(), enrolled),
        enrollment_location_id=latch(enrolled_at.isNotNull(), enrolled_at),
        known_location=locf(F.when(c("location_id") != 0, c("location_id"))),
        visit_num=running(bit(~c("encounter_type").isin(5, 6, 7, 8, 9, 21))),
        mdt_session_number=carry(mdt.isNotNull(), mdt),
        known_rtc=locf(c("rtc")),
        cur_arv_meds=carry(c("__meds_event") == 1, c("__meds")),
        cur_arv_line=carry(c("__line_event") == 1, c("cur_arv_line_strict")),
        cur_arv_line_reported=locf(F.when(yes("line_reported_1"), 1).when(yes("line_reported_2"), 2).when(yes("line_reported_3"), 3)),
        cur_arv_adherence=locf(F.when(yes("adherence_good"), "GOOD").when(yes("adherence_fair"), "FAIR").when(yes("adherence_poor"), "POOR")),
        known_disclosed=locf(F.when(yes("disclosed"), 1)),
        known_death=locf(c("death_on")),
        first_death_sign=latch(yes("death_cause") | yes("died") | (c("encounter_type") == DEATH_TYPE), today),
        hiv_hard=locf(F.coalesce(c("hiv_on"), F.when(yes("transferred_in"), unknown_date()))),
        first_seen=latch(F.lit(True), today),
        tb_screening_result=locf(c("tb_result")),
        tb_screening_datetime=locf(F.when(c("tb_screen") == 1, today)),
        on_ipt=locf(F.when(yes("ipt_stop"), 0).when(yes("ipt_plan") | yes("ipt_drug"), 1)),
        ipt_stop_date=locf(F.when(yes("ipt_stop_reason"), today).when(history, c("ipt_ended_on"))),
        ipt_completion_date=locf(F.when(yes("ipt_completed"), today).when(history, c("ipt_ended_on"))),
        tb_tx_end_date=locf(F.coalesce(c("tb_end_on"), F.when(yes("tb_end_now"), today))),
        condoms_provided_date=locf(F.when(either(yes("condoms"), yes("condoms_method"), yes("condoms_given")), today)),
        modern_contraceptive_method_start_date=carry(contraceptive_start.isNotNull() | yes("contraceptive_none"), contraceptive_start),
        contraceptive_method=carry(no_method | method.isNotNull(), F.when(~no_method, method)),
        cur_who_stage=locf(who),
        discordant_status=locf(discordant),
    )
    passes.look(
        0,
        known_vl_order=locf(F.when(yes("vl_ordered") | yes("vl_order"), today)),
        cd4_order_date=locf(F.when(yes("cd4_ordered") | yes("cd4_order"), today)),
        hiv_dna_pcr_order_date=locf(F.when(yes("pcr_ordered") | yes("pcr_order"), today)),
        travelled_outside_last_3_months=locf(answer("away_3")),
        travelled_outside_last_6_months=locf(answer("away_6")),
        travelled_outside_last_12_months=locf(answer("away_12")),
        last_cross_border_screening_date=locf(F.when(either(yes("away_3_yes"), yes("away_3_no"), yes("away_6_yes"), yes("away_12_no"), c("encounter_type") == BORDER_TYPE), today)),
        cross_border_service_offered=locf(c("border_service")),
        country_of_residence=locf(c("country")),
        ovc_non_enrollment_reason=locf(c("ovc_reason")),
        ovc_exit_date=locf(c("ovc_exit_on")),
        ca_cx_screening_result=locf(c("cervix_result")),
        ca_cx_screening_result_date=locf(c("cervix_result_on")),
        ca_cx_screening_date=locf(F.when(yes("cervix_yes"), today)),
        tb_modality_test=locf(modality),
        is_mother_breastfeeding=locf(answer("breastfeeding")),
        cur_weight=locf(F.when(c("weight") != 0, c("weight"))),
        cur_height=locf(F.when(c("height") != 0, c("height"))),
    )
    passes.set_or_soft(
        0,
        "ipt_start_date",
        sets=yes("ipt_hard_start") | (history & c("ipt_started_on").isNotNull()),
        value=F.when(yes("ipt_hard_start"), today).otherwise(c("ipt_started_on")),
        soft=yes("ipt_soft_start"),
        soft_value=today,
    )
    passes.set_or_soft(
        0,
        "tb_tx_start_date",
        sets=c("tb_started_on").isNotNull() | yes("tb_start_now"),
        value=F.coalesce(c("tb_started_on"), today),
        soft=~yes("transferred_in") & (yes("tb_continue") | (yes("tb_drugs") & ~yes("tb_drugs_none"))),
        soft_value=today,
    )
    passes.set_or_soft(
        0,
        "pcp_prophylaxis_start_date",
        sets=yes("pcp_hard_start") & ~yes("pcp_stop"),
        value=today,
        soft=yes("pcp_soft_start") | yes("pcp_drug"),
        soft_value=today,
        clears=yes("pcp_stop"),
    )
    passes.last_results(0, "cd4", lab & c("cd4").isNotNull(), c("cd4"), today, 2)
    passes.last_results(0, "cd4_percent", lab & c("cd4_percent").isNotNull(), c("cd4_percent"), today, 2)


def dependent_columns(passes: Passes) -> None:
    """Columns that look back at carried columns."""
    today = c("encounter_date")
    clinical = c("is_clinical") == 1
    passes.look(
        1,
        prev_rtc_date=prev(c("known_rtc")),
        prev_clinical_datetime_hiv=prev_where(clinical, today),
        prev_clinical_rtc_date_hiv=prev_where(clinical, c("known_rtc")),
        prev_clinical_location_id=prev_where(clinical, c("known_location")),
        prev_arv_meds=prev_where(c("cur_arv_meds").isNotNull(), c("cur_arv_meds")),
        prev_arv_line=prev(c("cur_arv_line")),
        prev_arv_adherence=prev(c("cur_arv_adherence")),
        prev_encounter_datetime_hiv=prev(today),
        prev_encounter_type_hiv=prev(c("encounter_type")),
        next_encounter_datetime_hiv=following(today),
        next_encounter_type_hiv=following(c("encounter_type")),
    )
    transferred = yes("transferred_in") | (c("prev_clinical_location_id") != c("known_location"))
    from_where = F.when(yes("transferred_in_site"), ELSEWHERE).when(transferred, c("prev_clinical_location_id"))
    passes.column(2, "transfer_in", F.when(transferred, 1))
    passes.look(2, transfer_in_date=locf(F.when(transferred, today)), transfer_in_location_id=locf(from_where))
    changed = F.coalesce(c("cur_arv_meds") != c("prev_arv_meds"), F.lit(False))
    hard, stop = yes("arv_hard_start"), yes("arv_stop")
    passes.set_or_soft(2, "arv_start_date", hard | (changed & ~stop), today, yes("arv_soft_start"), today, stop & ~hard)
    passes.look(
        5,
        prev_arv_start_date=prev(c("arv_start_date")),
        arv_start_location_id=latch(c("arv_start_date").isNotNull(), c("known_location")),
    )
    moved = c("prev_arv_start_date") != c("arv_start_date")
    passes.look(6, prev_arv_end_date=locf(F.when(moved, today)))
    late = F.datediff(today, F.coalesce(c("prev_clinical_rtc_date_hiv"), F.date_add("prev_clinical_datetime_hiv", 90)))
    in_care = F.coalesce(c("prev_clinical_datetime_hiv").isNull() | (late < 90), F.lit(False))
    kind = (
        F.when(c("first_arv_on").isNotNull(), "given")
        .when(yes("drugs_past_asked") & ~yes("drugs_past_none"), "unknown")
        .when(yes("arv_started_now") | yes("drugs_started"), "now")
        .when(yes("drugs_current_asked") & ~yes("drugs_current_none") & ~yes("transferred_in") & in_care, "unknown")
        .when(yes("drugs_reported_asked") & ~yes("drugs_reported_none") & ~yes("transferred_in") & in_care, "unknown")
        .when(c("cur_arv_meds").isNotNull(), "unknown")
    )
    first = F.struct(
        F.when(kind == "given", c("first_arv_on")).when(kind == "now", today).otherwise(unknown_date()).alias("date"),
        F.when(kind == "now", c("cur_arv_meds")).otherwise("unknown").alias("regimen"),
        F.when(kind == "now", c("known_location")).otherwise(ELSEWHERE).alias("location"),
    )
    passes.helper(2, "__first", latch(kind.isNotNull(), first))
    better_date = (c("__first.date") == unknown_date()) & yes("first_arv_known") & c("first_arv_on").isNotNull()
    better_regimen = (c("__first.regimen") == "unknown") & yes("first_arv_regimen_known") & yes("drugs_past_asked")
    passes.helper(3, "__date", latch(F.coalesce(better_date, F.lit(False)), c("first_arv_on")))
    passes.helper(3, "__regimen", latch(F.coalesce(better_regimen, F.lit(False)) & c("__past_meds").isNotNull(), c("__past_meds")))
    passes.column(4, "arv_first_regimen_start_date", F.coalesce("__date", "__first.date"))
    passes.column(4, "arv_first_regimen", F.coalesce("__regimen", "__first.regimen"))
    passes.column(4, "arv_first_regimen_location_id", F.col("__first.location"))


def look_ahead(df: DataFrame, line: Timeline) -> DataFrame:
    """What the next clinical row says, and what happens before it."""
    today, clinical = c("encounter_date"), c("is_clinical") == 1
    df = line.scan(
        df,
        next_clinical_datetime_hiv=next_where(clinical, today),
        next_clinical_location_id=next_where(clinical, c("known_location")),
        next_clinical_rtc_date_hiv=next_where(clinical, cur_rtc()),
    )
    return events_until_next_clinical(
        df,
        line,
        {
            "outreach_date_bncd": (c("encounter_type") == OUTREACH_TYPE, today),
            "outreach_death_date_bncd": (c("encounter_type") == OUTREACH_TYPE, c("death_on")),
            "transfer_date_bncd": (c("encounter_type") == TRIAGE_TYPE, today),
        },
    )


def final_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Columns computed from the carried state of the row."""
    today = c("encounter_date")
    death = F.coalesce(c("death_date"), c("known_death"), c("first_death_sign"))
    df = df.withColumn("death_date", death)
    status = (
        F.when(c("death_date") <= today, 159)
        .when(yes("discharged"), 9036)
        .otherwise(F.coalesce(c("transfer_code"), c("exit_code"), c("care_code")))
    )
    past_due = F.coalesce(F.datediff(today, c("edd")) > 28, F.lit(False))
    since_vl = d.months_between(c("vl_date_1"), today)
    on_art = d.months_between(c("arv_start_date"), today)
    no_vl = c("vl_date_1").isNull()
    transfer_out_move = c("next_clinical_location_id") != c("known_location")
    left = either(c("transfer_code").isNotNull(), yes("exit_transfer"), yes("care_transfer"))
    last_visit = c("next_clinical_datetime_hiv").isNull()
    new = {
        "patient_care_status": F.coalesce(status, F.when(c("encounter_type") != LAB_TYPE, 6101)),
        "cur_rtc_date": cur_rtc(),
        "hiv_status_disclosed": F.when(yes("not_disclosed") & ~yes("disclosed"), 0).otherwise(c("known_disclosed")),
        "hiv_start_date": F.coalesce("hiv_hard", "first_seen"),
        "is_pregnant": F.when((c("is_pregnant") == 1) & ~past_due, 1),
        "edd": F.when((c("is_pregnant") == 1) & ~past_due, c("edd")),
        "vl_order_date": F.when(no_vl | (c("vl_date_1") < c("known_vl_order")), c("known_vl_order")),
        "expected_vl": F.when(c("cur_arv_meds").isNotNull() & (c("vl_value_1") > 1000) & (F.datediff(today, c("vl_date_1")) >= 90), 1)
        .when((on_art <= 12) & (no_vl | (since_vl >= 6)) & (on_art >= 6), 1)
        .when((on_art >= 12) & (no_vl | (since_vl >= 12)), 1)
        .otherwise(0),
        "is_cross_border_country": bit(
            F.coalesce(F.greatest("travelled_outside_last_3_months", "travelled_outside_last_6_months", "travelled_outside_last_12_months") == 1, F.lit(False))
        ),
        "transfer_out": F.when(left | transfer_out_move, 1),
        "transfer_out_location_id": F.when(yes("transfer_other") & last_visit, ELSEWHERE)
        .when(yes("transfer_network") & last_visit, IN_NETWORK)
        .when(transfer_out_move, c("next_clinical_location_id")),
        "transfer_out_date": F.when(F.coalesce(left | transfer_out_move, F.lit(False)) & last_visit, cur_rtc())
        .when(transfer_out_move, c("next_clinical_datetime_hiv"))
        .when((c("is_clinical") == 1) & c("transfer_date_bncd").isNotNull(), c("transfer_date_bncd")),
        "cur_arv_meds_names": drug_names(c("cur_arv_meds")),
        "bmi": F.col("cur_weight") / F.nullif(F.col("cur_height") * F.col("cur_height"), F.lit(0.0)) * 10000,
    }
    return df.select("__done0", "__done", *[new[n].alias(n) if n in new else c(n) for n in wanted])


OUTPUT = [
    "person_id", "encounter_id", "encounter_date", "encounter_type", "visit_type", "is_transit", "is_clinical", "gender",
    "birthdate", "enrollment_date", "enrollment_location_id", "scheduled_visit", "known_location", "visit_num", "mdt_session_number",
    "prev_rtc_date", "cur_rtc_date", "med_pickup_rtc_date", "out_of_care", "death_date", "patient_care_status",
    "hiv_start_date", "arv_start_location_id", "prev_arv_meds", "cur_arv_meds", "cur_arv_meds_strict", "cur_arv_meds_names",
    "prev_clinical_datetime_hiv", "prev_clinical_rtc_date_hiv", "arv_first_regimen", "arv_first_regimen_start_date",
    "arv_first_regimen_location_id", "prev_arv_line", "cur_arv_line", "cur_arv_line_strict", "cur_arv_line_reported",
    "prev_arv_start_date", "arv_start_date", "prev_arv_end_date", "prev_arv_adherence", "cur_arv_adherence",
    "hiv_status_disclosed", "is_pregnant", "edd", "tb_screen", "tb_screening_result", "tb_screening_datetime", "on_ipt",
    "ipt_start_date", "ipt_stop_date", "ipt_completion_date", "on_tb_tx", "tb_tx_start_date", "tb_tx_end_date",
    "pcp_prophylaxis_start_date", "cd4_1", "cd4_1_date", "cd4_2", "cd4_2_date", "cd4_percent_1", "cd4_percent_1_date",
    "cd4_percent_2", "cd4_percent_2_date", "cd4_resulted", "vl_resulted", "vl_value_1", "vl_date_1", "vl_value_2",
    "vl_date_2", "vl_order_date", "expected_vl", "cd4_order_date", "hiv_dna_pcr_order_date", "hiv_dna_pcr_resulted",
    "pcr_value_1", "pcr_date_1", "pcr_value_2", "pcr_date_2", "hiv_rapid_test_resulted", "hiv_rapid_test_resulted_date",
    "condoms_provided_date", "modern_contraceptive_method_start_date", "contraceptive_method", "cur_who_stage",
    "discordant_status", "phone_outreach", "home_outreach", "outreach_attempts", "prev_encounter_datetime_hiv",
    "prev_encounter_type_hiv", "next_encounter_datetime_hiv", "next_encounter_type_hiv", "next_clinical_datetime_hiv",
    "next_clinical_rtc_date_hiv",
    "prev_clinical_location_id", "next_clinical_location_id", "outreach_date_bncd", "outreach_death_date_bncd",
    "transfer_date_bncd", "transfer_in", "transfer_in_date", "transfer_in_location_id", "transfer_out",
    "transfer_out_date", "transfer_out_location_id",
]
CURRENT_FORM = [
    "travelled_outside_last_3_months", "travelled_outside_last_6_months", "travelled_outside_last_12_months",
    "last_cross_border_screening_date", "is_cross_border_country", "cross_border_service_offered", "country_of_residence",
    "ovc_non_enrollment_reason", "ovc_exit_date", "ca_cx_screen", "ca_cx_screening_result", "ca_cx_screening_result_date",
    "ca_cx_screening_date", "tb_modality_test", "is_mother_breastfeeding", "cur_weight", "cur_height", "bmi",
]


def hiv_summary(
    t: Tables,
    keys: DataFrame | None = None,
    facts: dict[str, Fact] = FACTS,
    questions: list = QUESTIONS,
    columns: list[str] = OUTPUT + CURRENT_FORM,
    tasks: int | None = None,
) -> DataFrame:
    """One row per encounter or laboratory day; `keys` limits the build to some persons, `tasks` share the walk."""
    persons = t.person.select("person_id", "gender", "birthdate", "death_date")
    day_facts = {n: facts[n] for n in DAY_FACTS}
    states = day_states(unpack(events(t, day_facts, questions, keys), day_facts))
    rows = fold.mark_states(events(t, facts, questions, keys), states)
    hot = list(dict.fromkeys([*t.hot_persons, *t.hot_lab_persons]))

    def build(part: DataFrame, line: Timeline) -> DataFrame:
        part = event_columns(unpack(fold.apply_states(part.join(persons, "person_id"), line), facts))
        passes = timeline_passes(facts)
        part = passes.run(line, part, through=0)
        first = [n for n in columns if n in part.columns and n not in STILL_NEEDED and n not in NEEDED_IN_PASSES]
        part = passes.run(line, pack(part, first, "__done0"), start=1, through=2)
        second = [n for n in columns if n in part.columns and n not in STILL_NEEDED]
        part = passes.run(line, pack(part, second, "__done"), start=3)
        part = final_columns(look_ahead(part, line), [n for n in columns if n not in first and n not in second])
        return unpacked(unpacked(part, "__done0"), "__done").select(*columns)

    return by_timeline(rows, build, hot, tasks=tasks or t.tasks())


# Columns that the first passes after pass 0 read, and that nothing reads later.
NEEDED_IN_PASSES = {"cur_arv_line", "cur_arv_adherence"}

# Columns that passes after the second, or the final expressions, still read.
STILL_NEEDED = {
    "person_id", "encounter_id", "encounter_date", "encounter_type", "is_clinical", "known_location", "death_date",
    "cur_arv_meds", "arv_start_date", "vl_value_1", "vl_date_1", "is_pregnant", "edd", "prev_clinical_datetime_hiv",
    "travelled_outside_last_3_months", "travelled_outside_last_6_months", "travelled_outside_last_12_months",
    "cur_weight", "cur_height", "prev_arv_meds",
}
